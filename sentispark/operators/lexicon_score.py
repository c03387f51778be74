"""Lexicon sentiment: the sum of word weights over all word occurrences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentispark.functions.sentiment import label_of
from sentispark.functions.text import each, tokens
from sentispark.operators.lookup import MAX_BROADCAST_ROWS, MAX_LITERAL_WORDS, distinct_texts, literal_map, lookup
from sentispark.operators.dedup import text_key
from sentispark.session import cut_lineage


def word_totals(lexicon: DataFrame) -> DataFrame:
    """One weight per word; a word in both lexica counts with the sum."""
    return lexicon.groupBy("word").agg(F.sum("weight").alias("total"))


def lexicon_overlap(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """Entry counts of the two lexica and of the words they share."""
    p = positive.select("word", F.lit(1).alias("p"))
    n = negative.select("word", F.lit(1).alias("n"))
    both = p.join(n, "word", "full_outer")
    return both.agg(F.count("p").alias("positive_words"), F.count("n").alias("negative_words"),
                    F.count_if(F.col("p").isNotNull() & F.col("n").isNotNull()).alias("shared_words"))


def with_sentiment(df: DataFrame, lexicon: DataFrame, key: str = "tweet_id", text: str = "cleaned_text",
                   max_literal: int = MAX_LITERAL_WORDS, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Add ``sentiment_score`` and ``label``; null and empty texts score 0.

    A lexicon of usual size goes into the plan and scoring is a projection: no
    explode, no shuffle. A larger one is joined token by token for every
    distinct text, and rows find their score by the digest of their text: it
    depends on the text alone, whatever the key and the size of the lexicon.
    """
    totals = word_totals(lexicon)
    weight_of = literal_map(totals, "total", "bigint", max_literal)
    if weight_of is not None:
        none = F.lit(0).cast("long")
        score = F.aggregate(tokens(text), none, lambda acc, w: acc + F.coalesce(weight_of(w), none))
        return df.withColumn("sentiment_score", score).withColumn("label", label_of(F.col("sentiment_score")))
    words = distinct_texts(df, text).select("_d", F.explode_outer(tokens("_text")).alias("word"))
    weighed = lookup(words, cut_lineage(totals), "word", "left", ["_d"], max_rows)
    zero = F.lit(0).cast("long")
    scores = weighed.groupBy("_d").agg(F.sum(F.coalesce("total", zero)).alias("_score"))
    scored = df.withColumn("_d", text_key(text)).join(scores, "_d", "left")
    kept = [c for c in df.columns if c not in ("sentiment_score", "label")]
    return (scored.withColumn("sentiment_score", F.coalesce("_score", zero))
            .withColumn("label", label_of(F.col("sentiment_score"))).select(*kept, "sentiment_score", "label"))


def lexicon_label(df: DataFrame, lexicon: DataFrame, key: str = "tweet_id",
                  text: str = "cleaned_text", **limits) -> DataFrame:
    """(key, sentiment_score, label) for every row."""
    rows = df.select(key, text)
    return with_sentiment(rows, lexicon, key, text, **limits).select(key, "sentiment_score", "label")


def contributions(df: DataFrame, lexicon: DataFrame, key: str = "tweet_id",
                  text: str = "cleaned_text") -> DataFrame:
    """The worked example of a score: every hit word with occurrences, weight and product."""
    words = each(df, tokens(text), "word", key)
    hits = lookup(words, word_totals(lexicon), "word", "inner", [key])
    return (hits.groupBy(key, "word")
            .agg(F.count("*").alias("occurrences"), F.min("total").alias("weight"))
            .withColumn("contribution", F.col("occurrences") * F.col("weight")))
