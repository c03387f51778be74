"""Scores, labels and time stamps as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label set in its display order, the link format, the worded date format.
LABELS = ("positive", "negative", "neutral")
LINK_HOST, LINK_PATH = "https://x.com/", "/status/"
WORDED_DATE = "MMM dd HH:mm:ss Z yyyy"


def label_of(score: Column) -> Column:
    return (F.when(score > 0, F.lit("positive"))
            .when(score < 0, F.lit("negative"))
            .otherwise(F.lit("neutral")))


def binary_label(label: Column) -> Column:
    return F.when(label == "positive", F.lit(1)).otherwise(F.lit(0))


def post_url(username: Column, tweet_id: Column) -> Column:
    return F.concat(F.lit(LINK_HOST), username, F.lit(LINK_PATH), tweet_id)


def url_or_default(url: Column, username: Column, tweet_id: Column) -> Column:
    """Ingest rule: a null or empty link is derived."""
    return F.coalesce(F.nullif(url, F.lit("")), post_url(username, tweet_id))


def url_backfill(url: Column, username: Column, tweet_id: Column) -> Column:
    """Migration rule: only a null link is derived, an empty one stays."""
    return F.coalesce(url, post_url(username, tweet_id))


def parse_created_at(text: Column) -> Column:
    """Both source formats as a time stamp; ISO text without an offset counts as UTC.

    The weekday of ``Wed Oct 10 20:19:24 +0000 2018`` is skipped, the parser
    takes none.
    """
    utc = F.concat(text, F.lit("Z")).try_cast("timestamp")
    offset = text.try_cast("timestamp")
    worded = F.try_to_timestamp(F.substring(text, 5, 64), F.lit(WORDED_DATE))
    return F.coalesce(utc, offset, worded)
