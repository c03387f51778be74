"""Work queues, training sets and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean_queue(posts: DataFrame) -> DataFrame:
    return posts.where(F.col("cleaned_text").isNull()).select("tweet_id", "raw_text")


def label_queue(posts: DataFrame) -> DataFrame:
    waiting = F.col("label").isNull() & F.col("cleaned_text").isNotNull()
    return posts.where(waiting).select("tweet_id", "cleaned_text")


def training_set(posts: DataFrame, exclude_neutral: bool = True) -> DataFrame:
    wanted = F.col("label").isin("positive", "negative") if exclude_neutral else F.col("label").isNotNull()
    return posts.where(F.col("cleaned_text").isNotNull() & wanted).select("tweet_id", "cleaned_text", "label")


def preview(posts: DataFrame, label: str | None = None, only_replies: bool = False,
            limit: int = 5) -> DataFrame:
    """The newest rows, optionally of one label and replies only."""
    rows = posts
    if label is not None:
        rows = rows.where(F.col("label") == label)
    if only_replies:
        rows = rows.where(F.col("reply_to_id").isNotNull())
    return (rows.orderBy(F.desc("scraped_at"), F.desc("seq")).limit(limit)
            .select("username", "raw_text", "label", "reply_to_id", "tweet_url"))


def wide_posts(raw: DataFrame, cleaned: DataFrame, labelled: DataFrame, key: str = "tweet_id") -> DataFrame:
    """The stage tables as one row per post; the score is 0 before labelling."""
    return (raw.join(cleaned.select(key, "cleaned_text"), key, "left")
            .join(labelled.select(key, "sentiment_score", "label"), key, "left")
            .withColumn("sentiment_score", F.coalesce("sentiment_score", F.lit(0).cast("long"))))
