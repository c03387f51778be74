"""Linear support vector machine with Platt-scaled probabilities."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import LinearSVC
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentispark.operators.bayes import dot
from sentispark.operators.split import in_class_parts

C = 1.0
MAX_ITER = 200
TOLERANCE = 1e-4
FOLDS = 5
ROWS_PER_TASK = 20_000  # a solver step on fewer rows is all task overhead
NEWTON_STEPS, NEWTON_GRADIENT, RIDGE = 100, 1e-6, 1e-12


class Linear(NamedTuple):
    """A margin is the intercept plus the weights of a row's terms."""
    weights: list[float]
    intercept: float


class Platt(NamedTuple):
    """P(positive) = 1 / (1 + exp(-(slope * margin + offset)))."""
    slope: float
    offset: float


def svm_fit(train: DataFrame, y: str = "y", features: str = "features", c: float = C,
            max_iter: int = MAX_ITER, tol: float = TOLERANCE) -> Linear:
    """Hinge loss with cost ``c`` per row: the penalty of the averaged loss is 1 / (c n)."""
    counts = {r[y]: r["n"] for r in train.groupBy(y).agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        raise ValueError("training needs both classes")
    n = sum(counts.values())
    parts = math.ceil(n / ROWS_PER_TASK)
    if parts < train.rdd.getNumPartitions():
        train = train.coalesce(parts)
    svc = LinearSVC(featuresCol=features, labelCol=y, regParam=1.0 / (c * n),
                    standardization=False, fitIntercept=True, maxIter=max_iter, tol=tol,
                    rawPredictionCol="_raw", predictionCol="_pred")
    model = svc.fit(train.select(F.col(y).cast("double").alias(y), features))
    return Linear(model.coefficients.toArray().tolist(), float(model.intercept))


def svm_margin(model: Linear, features: str = "features") -> Column:
    return F.lit(model.intercept) + dot(features, model.weights)


def svm_predict(df: DataFrame, model: Linear, features: str = "features") -> DataFrame:
    """Add ``svm_margin`` and ``svm_pred``, the sign of the margin."""
    out = df.withColumn("svm_margin", svm_margin(model, features))
    return out.withColumn("svm_pred", (F.col("svm_margin") > 0).cast("int"))


def held_out_margins(train: DataFrame, id_col: str = "tweet_id", y: str = "y",
                     features: str = "features", folds: int = FOLDS, seed: int = 42) -> DataFrame:
    """Margins of every training row under a model that did not see it; folds fit side by side.

    Every class is dealt evenly over the folds. A fold that holds all rows of a class leaves one class to learn from: the
    margin is then 1 on the side of that class.
    """
    folded, sizes = in_class_parts(train.withColumn("_class", F.col(y).cast("string")), folds, "_class", id_col, seed)

    def one(k: int) -> DataFrame:
        rows = folded.where(F.col("_part") == k)
        left = [c for c, n in sizes.items() if n > n * (k + 1) // folds - n * k // folds]
        if len(left) < 2:
            side = 1.0 if left == ["1"] else -1.0
            return rows.select(id_col, y, F.lit(side).alias("svm_margin"))
        model = svm_fit(folded.where(F.col("_part") != k), y, features)
        return rows.select(id_col, y, svm_margin(model, features).alias("svm_margin"))

    with ThreadPoolExecutor(folds) as pool:
        target = inheritable_thread_target(train.sparkSession)
        parts = list(pool.map(target(one), range(folds)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def platt_fit(margins: DataFrame, y: str = "y") -> Platt:
    """Fit the sigmoid to the margins with Platt's softened targets, by Newton steps on sums over all rows.

    A step asks for the gradient, the curvature and, in the same pass, the loss; one that does not lower the loss is halved.
    Six numbers a step reach the driver.
    """
    rows = margins.select(F.col("svm_margin").alias("m"), (F.col(y) == 1).alias("y")).persist(StorageLevel.MEMORY_AND_DISK)
    n = rows.agg(F.count_if("y").alias("p"), F.count_if(~F.col("y")).alias("q")).first()
    target = F.when(F.col("y"), F.lit((n["p"] + 1) / (n["p"] + 2))).otherwise(F.lit(1 / (n["q"] + 2)))

    def sums(slope: float, offset: float) -> list[float]:
        z = F.col("m") * slope + offset
        p = 1 / (1 + F.exp(-z))
        loss = F.greatest(z, F.lit(0.0)) - target * z + F.log1p(F.exp(-F.abs(z)))
        off, bend = p - target, p * (1 - p)
        return list(rows.agg(*[F.sum(x) for x in (loss, off * F.col("m"), off, bend * F.col("m") * F.col("m"), bend * F.col("m"), bend)]).first())

    at = (0.0, math.log((n["p"] + 1) / (n["q"] + 1)))
    now = sums(*at)
    for _ in range(NEWTON_STEPS):
        _, ga, gb, haa, hab, hbb = now
        if max(abs(ga), abs(gb)) < NEWTON_GRADIENT:
            break
        haa, hbb = haa + RIDGE, hbb + RIDGE
        det = haa * hbb - hab * hab
        step = ((hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det)
        size = 1.0
        while size > 1e-10:
            there = (at[0] - size * step[0], at[1] - size * step[1])
            new = sums(*there)
            if new[0] <= now[0] - 1e-4 * size * (ga * step[0] + gb * step[1]) + 1e-12:
                at, now = there, new
                break
            size /= 2
        else:
            break
    rows.unpersist()
    return Platt(*at)


def svm_proba(df: DataFrame, platt: Platt) -> DataFrame:
    """Add ``svm_proba`` from ``svm_margin``."""
    z = F.col("svm_margin") * platt.slope + platt.offset
    return df.withColumn("svm_proba", 1 / (1 + F.exp(-z)))
