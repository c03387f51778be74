"""Multinomial naive Bayes on TF-IDF weights with an unsmoothed class prior.

With two classes the model is linear: the difference of the class scores is a
constant plus a dot product, computed inside the row.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentispark.functions.terms import literal_array
from sentispark.operators.features import Tfidf, sparse_parts

ALPHA = 1.0
CLASSES = (0, 1)


class NaiveBayes(NamedTuple):
    """Log priors and log likelihoods of the negative (0) and positive (1) class."""
    prior: list[float]
    theta: list[list[float]]


def nb_fit(train: DataFrame, y: str = "y", features: str = "features") -> NaiveBayes:
    """Weight sums per class: two rows of ``max_features`` numbers reach the driver."""
    rows = train.groupBy(y).agg(F.count("*").alias("n"),
                                Summarizer.sum(F.col(features)).alias("w")).collect()
    by_class = {r[y]: r for r in rows}
    if set(by_class) != set(CLASSES):
        raise ValueError("training needs both classes")
    total = sum(r["n"] for r in rows)
    prior, theta = [], []
    for c in CLASSES:
        w = by_class[c]["w"].toArray() + ALPHA
        prior.append(math.log(by_class[c]["n"] / total))
        theta.append((np.log(w) - math.log(w.sum())).tolist())
    return NaiveBayes(prior, theta)


def nb_parameters(spark, model: NaiveBayes, vocab: Tfidf) -> DataFrame:
    """The fitted model as rows (y, term, theta, prior)."""
    rows = [(c, t, th, model.prior[c]) for c in CLASSES for t, th in zip(vocab.terms, model.theta[c])]
    return spark.createDataFrame(rows, "y int, term string, theta double, prior double")


def dot(features: str, weights: list[float]) -> Column:
    index, value = sparse_parts(features)
    w = literal_array(weights, "array<double>")
    products = F.zip_with(index, value, lambda i, v: v * F.get(w, i))
    return F.aggregate(products, F.lit(0.0), lambda a, p: a + p)


def nb_margin(model: NaiveBayes, features: str = "features") -> Column:
    """Log odds of the positive class; a row without known terms gets the prior odds."""
    diff = [p - n for n, p in zip(*model.theta)]
    return F.lit(model.prior[1] - model.prior[0]) + dot(features, diff)


def nb_predict(df: DataFrame, model: NaiveBayes, features: str = "features") -> DataFrame:
    """Add ``nb_margin``, ``nb_pred`` (equal scores: negative) and ``nb_proba``."""
    out = df.withColumn("nb_margin", nb_margin(model, features))
    return out.select("*", (F.col("nb_margin") > 0).cast("int").alias("nb_pred"),
                      (1 / (1 + F.exp(-F.col("nb_margin")))).alias("nb_proba"))
