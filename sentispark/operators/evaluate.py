"""Exact evaluation of scored rows (model, id, y, pred, score), all models in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Metric sets compared by the text report and on screen.
REPORT_METRICS = ("accuracy", "precision", "recall", "f1")
SCREEN_METRICS = ("accuracy", "precision", "recall", "f1", "auc")
EQUAL_ACCURACY = 1e-4
SCORE_RANGES = 256


def confusion_counts(scored: DataFrame) -> DataFrame:
    def cell(y: int, p: int, name: str):
        return F.count_if((F.col("y") == y) & (F.col("pred") == p)).alias(name)

    return scored.groupBy("model").agg(cell(0, 0, "tn"), cell(0, 1, "fp"), cell(1, 0, "fn"), cell(1, 1, "tp"))


def metrics_of(confusion: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class; 0 where undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return confusion.select("model", ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
                            ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
                            ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def accuracy(scored: DataFrame) -> DataFrame:
    return metrics_of(confusion_counts(scored)).select("model", "accuracy")


def precision_recall_f1(scored: DataFrame) -> DataFrame:
    return metrics_of(confusion_counts(scored)).select("model", "precision", "recall", "f1")


def auc_roc(scored: DataFrame, ranges: int = SCORE_RANGES) -> DataFrame:
    """Exact area under the ROC curve with ties halved; 0 if a class is missing.

    Rows are first reduced to class counts per distinct score. Score ranges,
    cut at approximate quantiles, carry the running count in two steps: totals
    of all ranges before (a few hundred rows), then a window inside each range,
    so no task sees all scores of a model. Any cuts give the same area.
    """
    probs = [i / ranges for i in range(1, ranges)]
    cuts = scored.groupBy("model").agg(F.percentile_approx("score", probs, 10_000).alias("c")).collect()
    inner = sorted({v for r in cuts if r["c"] for v in r["c"]})
    ranked_rows = scored.where(F.col("score").isNotNull() & F.col("model").isNotNull())
    by_score = ranked_rows.groupBy("model", "score").agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    if inner:
        cutter = Bucketizer(splits=[-float("inf"), *inner, float("inf")], inputCol="score", outputCol="part")
        parts = cutter.transform(by_score)
    else:
        parts = by_score.withColumn("part", F.lit(0.0))
    totals = parts.groupBy("model", "part").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    before = Window.partitionBy("model").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("model")
    totals = totals.select("model", "part",
                           F.coalesce(F.sum("neg").over(before), F.lit(0)).alias("neg_before"),
                           F.sum("pos").over(whole).alias("all_pos"), F.sum("neg").over(whole).alias("all_neg"))
    inside = Window.partitionBy("model", "part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("neg_before") + F.coalesce(F.sum("neg").over(inside), F.lit(0))
    ranked = parts.join(F.broadcast(totals), ["model", "part"]).withColumn("below", below)
    pairs = F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2))
    area = ranked.groupBy("model").agg(pairs.alias("pairs"), F.first("all_pos").alias("p"),
                                       F.first("all_neg").alias("q"))
    possible = F.col("p").cast("double") * F.col("q").cast("double")
    return area.select("model", F.coalesce(F.try_divide("pairs", possible), F.lit(0.0)).alias("auc"))


def model_comparison(scored: DataFrame) -> DataFrame:
    """One row per model: the five metrics and the confusion counts."""
    confusion = confusion_counts(scored)
    return (confusion.join(metrics_of(confusion), "model").join(auc_roc(scored), "model")
            .select("model", *SCREEN_METRICS, "tp", "tn", "fp", "fn"))


def correct_summary(scored: DataFrame) -> DataFrame:
    """Correct predictions of all, with the share in percent."""
    c = confusion_counts(scored)
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    correct = F.col("tn") + F.col("tp")
    pct = F.when(total > 0, F.round(correct / total * 100, 1)).otherwise(F.lit(0.0))
    return c.select("model", correct.alias("correct"), total.alias("total"), pct.alias("pct"))


def metric_winner(comparison: DataFrame, first: str = "nb", second: str = "svm",
                  metrics: Sequence[str] = SCREEN_METRICS) -> DataFrame:
    """Strict wins of two models over a metric set, the winner, and who leads in accuracy."""
    def of(model: str, metric: str):
        return F.max(F.when(F.col("model") == model, F.col(metric)))

    both = comparison.agg(*[of(first, m).alias(f"a_{m}") for m in {*metrics, "accuracy"}],
                          *[of(second, m).alias(f"b_{m}") for m in {*metrics, "accuracy"}])

    def wins(a: str, b: str):
        return sum(((F.col(f"{a}_{m}") > F.col(f"{b}_{m}")).cast("long") for m in metrics), F.lit(0).cast("long"))

    scored = both.select(wins("a", "b").alias("first_wins"), wins("b", "a").alias("second_wins"),
                         (F.col("a_accuracy") - F.col("b_accuracy")).alias("_gap"))
    winner = (F.when(F.col("first_wins") > F.col("second_wins"), F.lit(first))
              .when(F.col("second_wins") > F.col("first_wins"), F.lit(second)).otherwise(F.lit("tie")))
    lead = (F.when(F.abs("_gap") < EQUAL_ACCURACY, F.lit("equal"))
            .when(F.col("_gap") > 0, F.lit(first)).otherwise(F.lit(second)))
    return scored.select("first_wins", "second_wins", winner.alias("winner"), lead.alias("accuracy_lead"))


def opinion_conclusion(predicted: DataFrame, tie: str = "negative") -> DataFrame:
    """Per model (columns model, positive, negative): shares and the dominant class.

    ``tie`` names the class shown for equal counts: the text report says
    negative, the screen positive.
    """
    total = F.col("positive") + F.col("negative")

    def pct(part: str):
        return F.when(total > 0, F.round(F.col(part) / total * 100, 1)).otherwise(F.lit(0.0))

    dominant = (F.when(F.col("positive") > F.col("negative"), F.lit("positive"))
                .when(F.col("negative") > F.col("positive"), F.lit("negative")).otherwise(F.lit(tie)))
    return predicted.select("model", "positive", "negative", pct("positive").alias("positive_pct"),
                            pct("negative").alias("negative_pct"), dominant.alias("dominant"))
