"""Metrics and comparisons over scored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentispark.operators import evaluate as ev
from sentispark.plans import inputs as ip
from sentispark.plans.catalog import query
from sentispark.plans.results import export_metrics



def sql_cells() -> str:
    """CTE of the confusion cells of ``scored``."""
    return """cells AS (SELECT model, count(*) FILTER (y = 0 AND pred = 0) AS tn,
    count(*) FILTER (y = 0 AND pred = 1) AS fp, count(*) FILTER (y = 1 AND pred = 0) AS fn,
    count(*) FILTER (y = 1 AND pred = 1) AS tp FROM scored GROUP BY model)"""


def sql_metrics() -> str:
    """CTEs of all metrics of ``scored``."""
    return f"""{sql_cells()}, metrics AS (SELECT *, (tp + tn) / (tp + tn + fp + fn) AS accuracy,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS "precision",
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
    CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1 FROM cells),
  auc AS (SELECT p.model, sum(CASE WHEN p.score > q.score THEN 1.0 WHEN p.score = q.score THEN 0.5 ELSE 0 END)
      / count(*) AS auc FROM scored p JOIN scored q ON p.model = q.model AND p.y = 1 AND q.y = 0 GROUP BY p.model),
  compared AS (SELECT m.*, CAST(auc AS DOUBLE) AS auc FROM metrics m JOIN auc USING (model))"""


SQL_CELLS = f"{ip.SQL_SCORED}, {sql_cells()}"
SQL_METRICS = f"{ip.SQL_SCORED}, {sql_metrics()}"
C = f"WITH {SQL_METRICS} "
FIVE = ("accuracy", "precision", "recall", "f1", "auc")


def _round6(df, *columns):
    return df.select(*[F.round(c, 6).alias(c) if c in columns else F.col(c) for c in df.columns])


@query("confusion_counts", f"WITH {SQL_CELLS} SELECT * FROM cells")
def confusion(spark, sf_dir):
    return ev.confusion_counts(ip.scored(spark, sf_dir))


@query("accuracy", C + "SELECT model, round(accuracy, 6) AS accuracy FROM metrics")
def accuracy(spark, sf_dir):
    return _round6(ev.accuracy(ip.scored(spark, sf_dir)), "accuracy")


@query("precision_recall_f1", C + """SELECT model, round("precision", 6) AS "precision", round(recall, 6) AS recall,
  round(f1, 6) AS f1 FROM metrics""")
def prf(spark, sf_dir):
    return _round6(ev.precision_recall_f1(ip.scored(spark, sf_dir)), "precision", "recall", "f1")


@query("auc_roc", C + "SELECT model, round(auc, 6) AS auc FROM compared")
def auc(spark, sf_dir):
    return _round6(ev.auc_roc(ip.scored(spark, sf_dir)), "auc")


@query("model_comparison", C + f"""SELECT model, {', '.join(f'round("{m}", 6) AS "{m}"' for m in FIVE)}, tp, tn, fp, fn
  FROM compared""")
def comparison(spark, sf_dir):
    return _round6(ev.model_comparison(ip.scored(spark, sf_dir)), *FIVE)


@query("export_metrics", C + """SELECT CASE model WHEN 'nb' THEN 'Naive Bayes' ELSE 'SVM (Linear)' END AS "Model",
  round(accuracy, 4) AS "Accuracy", round("precision", 4) AS "Precision", round(recall, 4) AS "Recall",
  round(f1, 4) AS "F1-Score", round(auc, 4) AS "AUC-ROC", tp AS "TP", tn AS "TN", fp AS "FP", fn AS "FN" FROM compared""")
def export(spark, sf_dir):
    return export_metrics(ev.model_comparison(ip.scored(spark, sf_dir)))


@query("correct_summary", f"""WITH {SQL_CELLS} SELECT model, tn + tp AS correct, tn + fp + fn + tp AS total,
  round((tn + tp) / (tn + fp + fn + tp) * 100, 1) AS pct FROM cells""")
def correct(spark, sf_dir):
    return ev.correct_summary(ip.scored(spark, sf_dir))


def sql_wins(metrics) -> str:
    def wins(a: str, b: str) -> str:
        return " + ".join(f'CAST({a}."{m}" > {b}."{m}" AS BIGINT)' for m in metrics)
    return f"""SELECT first_wins, second_wins, CASE WHEN first_wins > second_wins THEN 'nb'
      WHEN second_wins > first_wins THEN 'svm' ELSE 'tie' END AS winner,
    CASE WHEN abs(gap) < 1e-4 THEN 'equal' WHEN gap > 0 THEN 'nb' ELSE 'svm' END AS accuracy_lead
  FROM (SELECT {wins('a', 'b')} AS first_wins, {wins('b', 'a')} AS second_wins, a.accuracy - b.accuracy AS gap
    FROM compared a, compared b WHERE a.model = 'nb' AND b.model = 'svm')"""


@query("metric_winner", C + sql_wins(FIVE))
def winner(spark, sf_dir):
    return ev.metric_winner(ev.model_comparison(ip.scored(spark, sf_dir)))


@query("metric_winner_report", C + sql_wins(FIVE[:4]))
def winner_report(spark, sf_dir):
    return ev.metric_winner(ev.model_comparison(ip.scored(spark, sf_dir)), metrics=ev.REPORT_METRICS)


@query("opinion_conclusion", f"""WITH {ip.SQL_SCORED}, o AS (SELECT model, count(*) FILTER (pred = 1) AS positive,
    count(*) FILTER (pred = 0) AS negative FROM scored GROUP BY model)
  SELECT model, positive, negative, round(positive / (positive + negative) * 100, 1) AS positive_pct,
    round(negative / (positive + negative) * 100, 1) AS negative_pct,
    CASE WHEN positive > negative THEN 'positive' ELSE 'negative' END AS dominant FROM o""")
def opinion(spark, sf_dir):
    counts = ip.scored(spark, sf_dir).groupBy("model").agg(
        F.count_if(F.col("pred") == 1).alias("positive"), F.count_if(F.col("pred") == 0).alias("negative"))
    return ev.opinion_conclusion(counts)
