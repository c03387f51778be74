"""Counts, percentages and top lists over the wide posts table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentispark.functions.sentiment import LABELS
from sentispark.functions.text import each, tokens
from sentispark.session import cut_lineage

ON_SCREEN_WORDS = 30
EXPORT_WORDS = 50
TABLE_ROWS = 50
MIN_WORD_LENGTH = 3

# Column headings of the exported files.
LABELED_HEADINGS = ("Username", "Tanggal", "Keyword", "Label", "Skor", "Tweet Asli",
                    "Hasil Preprocessing", "URL")
WORD_HEADINGS = ("Label", "Kata", "Frekuensi")


def label_distribution(posts: DataFrame) -> DataFrame:
    """Rows per label; a label without rows counts 0, unlabelled rows are left out."""
    counts = posts.agg(*[F.count_if(F.col("label") == l).alias(l) for l in LABELS])
    return counts.unpivot([], list(LABELS), "label", "n")


def label_distribution_with_null(posts: DataFrame) -> DataFrame:
    return posts.groupBy("label").agg(F.count("*").alias("n"))


def _pct(part, whole):
    return F.when(whole > 0, F.round(part / whole * 100, 1)).otherwise(F.lit(0.0))


def label_stats(posts: DataFrame) -> DataFrame:
    """One row: totals, counts and percentages of the labelled rows."""
    return _with_shares(posts.agg(
        F.count("*").alias("total_tweets"),
        *[F.count_if(F.col("label") == l).alias(l) for l in LABELS]))


def _with_shares(counts: DataFrame) -> DataFrame:
    labelled = sum((F.col(l) for l in LABELS[1:]), F.col(LABELS[0]))
    counts = counts.withColumn("total_labeled", labelled)
    return counts.select("total_tweets", "total_labeled", *LABELS,
                         *[_pct(F.col(l), F.col("total_labeled")).alias(f"{l}_pct") for l in LABELS])


def total_count(posts: DataFrame) -> DataFrame:
    return posts.agg(F.count("*").alias("n"))


def word_counts(posts: DataFrame, min_length: int = MIN_WORD_LENGTH) -> DataFrame:
    """Occurrences per (label, word). Rows without a label yield no words instead of being
    filtered: a filter on a derived label would be pushed down and derive it twice."""
    wanted = F.when(F.col("label").isin(*LABELS), tokens("cleaned_text"))
    words = each(posts, wanted, "term", "label")
    return (words.where(F.length("term") >= min_length)
            .groupBy("label", "term").agg(F.count("*").alias("n")))


def top_words(posts: DataFrame, n: int = ON_SCREEN_WORDS) -> DataFrame:
    """The most frequent words of every label; equal counts in word order.

    Counts combine on the map side and each task forwards at most ``n`` words
    per label to the final ranking.
    """
    return _ranked_words(word_counts(posts), n)


def _ranked_words(counts: DataFrame, n: int) -> DataFrame:
    by_count = Window.partitionBy("label").orderBy(F.desc("n"), F.asc("term"))
    return counts.withColumn("rank", F.row_number().over(by_count)).where(F.col("rank") <= n)


def keyword_counts(posts: DataFrame) -> DataFrame:
    return posts.groupBy("keyword").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "keyword")


def latest_labeled(posts: DataFrame, n: int = TABLE_ROWS) -> DataFrame:
    return (posts.where(F.col("label").isNotNull())
            .orderBy(F.desc("scraped_at"), F.desc("seq")).limit(n)
            .select("username", "raw_text", "cleaned_text", "sentiment_score", "label",
                    "created_at", "tweet_url", "tweet_id"))


def latest_raw(posts: DataFrame, n: int = TABLE_ROWS) -> DataFrame:
    return (posts.orderBy(F.desc("scraped_at"), F.desc("seq")).limit(n)
            .select("username", "raw_text", "keyword", "created_at", "tweet_url", "tweet_id"))


def pending_counts(posts: DataFrame) -> DataFrame:
    cleaned = F.col("cleaned_text").isNotNull()
    return posts.agg(F.count_if(~cleaned).alias("pending_preprocess"),
                     F.count_if(cleaned & F.col("label").isNull()).alias("pending_label"))


def dominant_label(posts: DataFrame) -> DataFrame:
    """The most frequent label with its share; equal counts in label order."""
    rank = F.array_position(F.array(*[F.lit(l) for l in LABELS]), F.col("label"))
    counts = posts.agg(F.count("label").alias("total"),
                       *[F.count_if(F.col("label") == l).alias(l) for l in LABELS])
    return (counts.unpivot(["total"], list(LABELS), "label", "n").where(F.col("total") > 0)
            .orderBy(F.desc("n"), rank).limit(1)
            .select("label", "n", _pct(F.col("n"), F.col("total")).alias("pct")))


def export_labeled(posts: DataFrame) -> DataFrame:
    """All labelled rows under the export headings, newest first."""
    columns = ("username", "created_at", "keyword", "label", "sentiment_score", "raw_text",
               "cleaned_text", "tweet_url")
    return (posts.where(F.col("label").isNotNull()).orderBy(F.desc("scraped_at"), F.desc("seq"))
            .select(*[F.col(c).alias(h) for c, h in zip(columns, LABELED_HEADINGS)]))


def export_words(posts: DataFrame, n: int = EXPORT_WORDS) -> DataFrame:
    label, word, count = WORD_HEADINGS
    return top_words(posts, n).select(F.col("label").alias(label), F.col("term").alias(word),
                                      F.col("n").alias(count))


def tally(posts: DataFrame) -> DataFrame:
    """``keyword, term, label, cleaned, n``: rows counted by keyword, label and whether they are cleaned (``term`` null),
    and words counted by label, in one pass over three columns. Counts combine on the map side."""
    nothing = F.lit(None).cast("string")
    words = F.when(F.col("label").isin(*LABELS), F.filter(tokens("cleaned_text"), lambda w: F.length(w) >= MIN_WORD_LENGTH))
    row = F.array(F.struct(F.lit(True).alias("row"), F.col("keyword"), nothing.alias("term")))
    said = F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda w: F.struct(
        F.lit(False).alias("row"), nothing.alias("keyword"), w.alias("term")))
    cleaned = F.col("cleaned_text").isNotNull().alias("cleaned")
    items = posts.select("label", cleaned, F.inline_outer(F.concat(row, said)))
    return items.groupBy("row", "keyword", "term", "label", "cleaned").agg(F.count("*").alias("n"))


def newest(posts: DataFrame, n: int = TABLE_ROWS) -> DataFrame:
    """The newest ``n`` labelled and the newest ``n`` other rows, in one pass; a task forwards no more than that."""
    order = Window.partitionBy(F.col("label").isNotNull()).orderBy(F.desc("scraped_at"), F.desc("seq"))
    return posts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop("_rank")


def dashboard_blocks(posts: DataFrame) -> dict[str, DataFrame]:
    """Every block of the reporting payload as its own frame; the posts are read twice, for counts and for the newest rows."""
    counts, latest = cut_lineage(tally(posts)), cut_lineage(newest(posts))
    rows, n = counts.where("row"), F.col("n")

    def total(condition, name: str):
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0)).alias(name)

    return {
        "stats": _with_shares(rows.agg(total(F.lit(True), "total_tweets"), *[total(F.col("label") == l, l) for l in LABELS])),
        "wordclouds": _ranked_words(counts.where("NOT row").select("label", "term", "n"), ON_SCREEN_WORDS),
        "per_keyword": rows.groupBy("keyword").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "keyword"),
        "pending": rows.agg(total(~F.col("cleaned"), "pending_preprocess"),
                            total(F.col("cleaned") & F.col("label").isNull(), "pending_label")),
        "raw_tweets": latest_raw(latest),
        "tweets": latest_labeled(latest),
    }
