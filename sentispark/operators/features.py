"""TF-IDF over one- and two-word terms.

The vocabulary holds at most ``max_features`` terms, so the fitted model is a
short list. Turning texts into vectors then happens row by row inside the JVM,
without a shuffle.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentispark.functions.text import each
from sentispark.functions.terms import terms_1_2, vector_tokens

MAX_FEATURES = 5000


class Tfidf(NamedTuple):
    """A fitted vocabulary: terms in name order, their idf, and the training size."""
    terms: list[str]
    idf: list[float]
    n_docs: int


def with_terms(df: DataFrame, text: str = "cleaned_text") -> DataFrame:
    words = df.withColumn("_words", vector_tokens(text))
    return words.withColumn("terms", terms_1_2(F.col("_words"))).drop("_words")


def term_frequency(df: DataFrame, key: str = "tweet_id", text: str = "cleaned_text") -> DataFrame:
    """Occurrences per (row, term)."""
    terms = each(with_terms(df, text), F.col("terms"), "term", key)
    return terms.groupBy(key, "term").agg(F.count("*").alias("tf"))


def vocabulary(train: DataFrame, max_features: int = MAX_FEATURES,
               text: str = "cleaned_text") -> DataFrame:
    """The most frequent terms of the training texts; equal counts in term order.

    Counting needs no row ids, so it combines on the map side by term alone.
    """
    terms = each(with_terms(train, text), F.col("terms"), "term")
    return (terms.groupBy("term").agg(F.count("*").alias("tf"))
            .orderBy(F.desc("tf"), F.asc("term")).limit(max_features))


def smoothed_idf(train: DataFrame, max_features: int = MAX_FEATURES,
                 text: str = "cleaned_text") -> DataFrame:
    """(term, df, n_docs, idf) of the vocabulary, with idf = ln((1 + n) / (1 + df)) + 1.

    One pass over the texts: a row yields all its terms, then its distinct terms,
    told apart by position; the first give the frequency that ranks a term, the
    second its document count.
    """
    rows = with_terms(train, text).select(
        F.size("terms").alias("_n"), F.posexplode_outer(F.concat("terms", F.array_distinct("terms"))).alias("_pos", "term"))
    counts = (rows.where(F.col("term").isNotNull()).groupBy("term")
              .agg(F.count_if(F.col("_pos") < F.col("_n")).alias("_tf"),
                   F.count_if(F.col("_pos") >= F.col("_n")).alias("df"))
              .orderBy(F.desc("_tf"), F.asc("term")).limit(max_features).drop("_tf"))
    return (counts.withColumn("n_docs", train.agg(F.count("*")).scalar())
            .withColumn("idf", F.log((F.col("n_docs") + 1) / (F.col("df") + 1)) + 1))


def fit_tfidf(train: DataFrame, max_features: int = MAX_FEATURES, text: str = "cleaned_text") -> Tfidf:
    """Collect the fitted vocabulary: ``max_features`` rows at most."""
    rows = sorted(smoothed_idf(train, max_features, text).collect(), key=lambda r: r["term"])
    if not rows:
        raise ValueError("the training texts hold no term of two letters or more")
    return Tfidf([r["term"] for r in rows], [r["idf"] for r in rows], rows[0]["n_docs"])


def tfidf(df: DataFrame, model: Tfidf, text: str = "cleaned_text", output: str = "features") -> DataFrame:
    """Add the unit-length weight vector; unknown terms drop out before scaling, a text
    without known terms gets the zero vector."""
    counted = CountVectorizerModel.from_vocabulary(model.terms, inputCol="terms", outputCol="_tf")
    weighed = ElementwiseProduct(scalingVec=Vectors.dense(model.idf), inputCol="_tf", outputCol="_w")
    scaled = Normalizer(p=2.0, inputCol="_w", outputCol=output)
    out = scaled.transform(weighed.transform(counted.transform(with_terms(df, text))))
    return out.drop("terms", "_tf", "_w")


def sparse_parts(features: str = "features"):
    """Index and value arrays of a sparse vector column."""
    inner = F.unwrap_udt(F.col(features))
    return inner["indices"], inner["values"]


def term_weights(vectors: DataFrame, model: Tfidf, key: str = "tweet_id",
                 features: str = "features") -> DataFrame:
    """The vectors in long form: (key, term, weight) for non-zero weights."""
    index, value = sparse_parts(features)
    names = F.broadcast(vectors.sparkSession.createDataFrame(
        list(enumerate(model.terms)), "i int, term string"))
    pairs = vectors.select(key, F.inline_outer(F.arrays_zip(index.alias("i"), value.alias("weight"))))
    return pairs.join(names, "i").select(key, "term", "weight")


def top_mean_terms(train_vectors: DataFrame, model: Tfidf, n: int = 10,
                   features: str = "features") -> DataFrame:
    """Terms with the highest mean training weight, zeros counted; equal means in reverse
    term order. Means are rounded to 12 places before ranking, so summation order
    cannot part equal ones."""
    sums = (term_weights(train_vectors.withColumn("_row", F.lit(0)), model, "_row", features)
            .groupBy("term").agg(F.sum("weight").alias("total")))
    mean = F.round(F.col("total") / model.n_docs, 12)
    return (sums.withColumn("mean", mean).orderBy(F.desc("mean"), F.desc("term")).limit(n)
            .select("term", F.round("mean", 4).alias("weight")))
