"""Cleaning and tokenising as column expressions.

The patterns spell out Unicode classes: Java's shorthand classes cover ASCII
only, while the text rules are defined on Unicode white space and word
characters.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: patterns and word list that define the cleaning rules -----
NON_SPACE = r"[^\s\x1c-\x1f\x85\p{Z}]"
WORD_CHAR = r"[\p{L}\p{N}_]"
URL_PATTERN = rf"https?://{NON_SPACE}+|www\.{NON_SPACE}+"
TAG_PATTERN = rf"[@#]{WORD_CHAR}+"
NON_LETTERS = "[^a-z]+"
CUSTOM_STOPWORDS = (
    "yg", "dg", "rt", "dgn", "ny", "bgt", "dr", "kalo", "amp", "x", "twitter",
    "makan", "bergizi", "gratis", "mbg",
)
# ------------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def case_fold(text: Column | str) -> Column:
    return F.lower(_col(text))


def strip_urls(text: Column | str) -> Column:
    """Drop web addresses up to the next white space; what stands to their left stays glued.

    The byte search in front spares most rows the regular expression.
    """
    t = _col(text)
    return F.when(t.contains("://") | t.contains("www."),
                  F.regexp_replace(t, URL_PATTERN, "")).otherwise(t)


def strip_tags(text: Column | str) -> Column:
    """Drop mentions and hashtags; their neighbours fuse."""
    t = _col(text)
    return F.when(t.contains("@") | t.contains("#"),
                  F.regexp_replace(t, TAG_PATTERN, "")).otherwise(t)


def letters_only(text: Column | str) -> Column:
    """Every run of characters other than a-z becomes one blank (input is lower case)."""
    return F.regexp_replace(_col(text), NON_LETTERS, " ")


def squeeze(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(text), r"[\s\x1c-\x1f\x85\p{Z}]+", " "))


def clean_text(text: Column | str) -> Column:
    """Case fold, drop addresses and tags, keep letters, squeeze; null gives ''."""
    bare = strip_tags(strip_urls(case_fold(text)))
    return F.coalesce(F.trim(letters_only(bare)), F.lit(""))


def tokens(cleaned: Column | str) -> Column:
    """Words of a cleaned text; an empty text has none."""
    return F.array_remove(F.split(F.coalesce(_col(cleaned), F.lit("")), " "), "")


def without_words(words: Column | str, stopwords: Iterable[str]) -> Column:
    """Drop listed words from a token array, keeping order and multiplicity.

    The literal list becomes a hash set, so the cost per token does not grow
    with the list.
    """
    stop = sorted(set(stopwords))
    if not stop:
        return _col(words)
    return F.filter(_col(words), lambda t: ~t.isin(stop))


def each(df: DataFrame, words: Column, name: str, *keep: str) -> DataFrame:
    """One row per element of an array column, next to the columns to keep.

    The outer form with a null filter behind it is deliberate: for a plain
    explode the optimizer infers ``size(array) > 0``, pushes it to the scan and
    so computes the whole cleaning chain twice.
    """
    return df.select(*keep, F.explode_outer(words).alias(name)).where(F.col(name).isNotNull())


def join_words(words: Column | str) -> Column:
    return F.array_join(_col(words), " ")
