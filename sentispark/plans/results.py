"""Training results as export rows, one nested document and report rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentispark.operators import evaluate
from sentispark.operators.features import top_mean_terms
from sentispark.operators.queues import training_set
from sentispark.operators.reports import dominant_label, label_distribution, label_stats
from sentispark.plans.phases import Training, score_corpus
from sentispark.session import cut_lineage

# Model names and headings of the exported table.
MODEL_NAMES = {"nb": "Naive Bayes", "svm": "SVM (Linear)"}
METRIC_HEADINGS = {"accuracy": "Accuracy", "precision": "Precision", "recall": "Recall",
                   "f1": "F1-Score", "auc": "AUC-ROC"}
CELLS = ("tp", "tn", "fp", "fn")
EXPORT_PLACES = 4


def export_metrics(comparison: DataFrame) -> DataFrame:
    """One row per model: five metrics to four places and the confusion cells."""
    name = F.when(F.col("model") == "nb", MODEL_NAMES["nb"]).otherwise(MODEL_NAMES["svm"])
    return comparison.select(
        name.alias("Model"),
        *[F.round(m, EXPORT_PLACES).alias(h) for m, h in METRIC_HEADINGS.items()],
        *[F.col(c).alias(c.upper()) for c in CELLS])


def results_document(posts: DataFrame, fitted: Training) -> DataFrame:
    """One nested row with sizes, metrics, confusion, corpus predictions and top terms."""
    corpus = score_corpus(posts, fitted)
    per_model = fitted.comparison.join(corpus, "model").select("model", F.struct(
        F.struct(*[F.round(m, EXPORT_PLACES).alias(m) for m in evaluate.SCREEN_METRICS]).alias("metrics"),
        F.struct("tn", "fp", "fn", "tp").alias("confusion"),
        F.col("positive").alias("full_pred_positive"),
        F.col("negative").alias("full_pred_negative")).alias("m"))

    def of(model: str):
        return F.max(F.when(F.col("model") == model, F.col("m"))).alias(model)

    models = per_model.agg(of("nb"), of("svm")).select(
        F.struct("nb", "svm").alias("models"),
        (F.col("nb.confusion.tp") + F.col("nb.confusion.fn")).alias("test_positive"),
        (F.col("nb.confusion.tn") + F.col("nb.confusion.fp")).alias("test_negative"))
    ranked = F.sort_array(F.collect_list(F.struct("weight", "term")), asc=False)
    terms = top_mean_terms(fitted.train, fitted.vocab).agg(
        F.transform(ranked, lambda t: F.struct(t["term"].alias("term"), t["weight"].alias("weight")))
        .alias("top_terms"))
    return models.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("generated_at"),
        F.lit(fitted.train_size + fitted.test_size).cast("long").alias("dataset_size"),
        F.lit(fitted.train_size).cast("long").alias("train_size"),
        F.lit(fitted.test_size).cast("long").alias("test_size"),
        "test_positive", "test_negative", "models", terms.scalar().alias("top_terms"))


def _rows(df: DataFrame, section: str, pairs: dict, prefix=None) -> DataFrame:
    """(section, item, value) rows of one-row-per-item frames."""
    def item(name: str):
        return F.lit(name) if prefix is None else F.concat_ws(".", prefix, F.lit(name))

    return df.select(F.inline_outer(F.array(*[
        F.struct(F.lit(section).alias("section"), item(k).alias("item"), v.cast("string").alias("value"))
        for k, v in pairs.items()])))


def evaluation_report(posts: DataFrame, fitted: Training) -> DataFrame:
    """The figures of the text report as (section, item, value) rows."""
    col = F.col
    base = cut_lineage(training_set(posts, False).select("label"))  # of labelled posts that also have a cleaned text
    stats = label_stats(base)
    labels = ("positive", "negative", "neutral")
    parts = [
        _rows(stats, "distribution", {
            "labelled": col("total_labeled"), **{l: col(l) for l in labels},
            **{f"{l}_pct": col(f"{l}_pct") for l in labels}}),
        _rows(dominant_label(base), "distribution", {"dominant": col("label"), "dominant_pct": col("pct")}),
        _rows(stats, "dataset", {
            "rows": col("positive") + col("negative"), "positive": col("positive"),
            "negative": col("negative"), "train": F.lit(fitted.train_size), "test": F.lit(fitted.test_size)}),
    ]
    model = col("model")
    parts.append(_rows(fitted.comparison, "metrics",
                       {m: F.round(m, 6) for m in evaluate.SCREEN_METRICS}, model))
    parts.append(_rows(fitted.comparison, "confusion", {c: col(c) for c in ("tn", "fp", "fn", "tp")}, model))
    parts.append(_rows(evaluate.correct_summary(fitted.scored), "correct",
                       {c: col(c) for c in ("correct", "total", "pct")}, model))
    winner = evaluate.metric_winner(fitted.comparison, metrics=evaluate.REPORT_METRICS)
    parts.append(_rows(winner, "winner", {c: col(c) for c in winner.columns}))
    opinion = evaluate.opinion_conclusion(score_corpus(posts, fitted))
    parts.append(_rows(opinion, "opinion", {c: col(c) for c in opinion.columns if c != "model"}, model))
    parts.append(_rows(label_distribution(base).where(col("label") == "neutral"), "neutral",
                       {"excluded": col("n")}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
