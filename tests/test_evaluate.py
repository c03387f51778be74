import random

import pytest

from sentispark.operators import evaluate as ev

SCHEMA = "model string, id long, y int, pred int, score double"


def rows_of(model, tn, fp, fn, tp):
    cells = [(0, 0)] * tn + [(0, 1)] * fp + [(1, 0)] * fn + [(1, 1)] * tp
    return [(model, i, y, p, float(p)) for i, (y, p) in enumerate(cells)]


def test_published_figures(spark):
    scored = spark.createDataFrame(rows_of("nb", 41, 4, 22, 1) + rows_of("svm", 36, 9, 12, 11), SCHEMA)
    got = {r.model: r for r in ev.model_comparison(scored).collect()}
    nb, svm = got["nb"], got["svm"]
    assert [nb.accuracy, nb.precision, nb.recall, nb.f1] == pytest.approx(
        [0.6176470588235294, 0.2, 0.043478260869565216, 0.07142857142857142])
    assert [svm.accuracy, svm.precision, svm.recall, svm.f1] == pytest.approx(
        [0.6911764705882353, 0.55, 0.4782608695652174, 0.5116279069767442])
    win = ev.metric_winner(ev.model_comparison(scored)).first()
    assert (win.first_wins, win.second_wins, win.winner, win.accuracy_lead) == (0, 5, "svm", "svm")
    correct = {r.model: (r.correct, r.total, r.pct) for r in ev.correct_summary(scored).collect()}
    assert correct == {"nb": (42, 68, 61.8), "svm": (47, 68, 69.1)}


def test_undefined_ratios_are_zero(spark):
    scored = spark.createDataFrame(rows_of("a", 3, 0, 2, 0) + rows_of("b", 5, 0, 0, 0), SCHEMA)
    got = {r.model: r for r in ev.model_comparison(scored).collect()}
    assert (got["a"].precision, got["a"].recall, got["a"].f1) == (0, 0, 0)
    assert got["b"].auc == 0 and got["a"].auc == .5


@pytest.mark.parametrize("ranges", [256, 3, 1])
def test_auc_against_pair_counting(spark, ranges):
    rng = random.Random(1)
    rows = [(m, i, rng.randint(0, 1), 0, v) for m in ("nb", "svm") for i in range(300)
            for v in [rng.choice([rng.gauss(0, 3), float(rng.randint(-2, 2))])]]
    got = {r.model: r.auc for r in ev.auc_roc(spark.createDataFrame(rows, SCHEMA), ranges).collect()}
    for m in ("nb", "svm"):
        pos = [r[4] for r in rows if r[0] == m and r[2] == 1]
        neg = [r[4] for r in rows if r[0] == m and r[2] == 0]
        pairs = sum((p > q) + (p == q) / 2 for p in pos for q in neg)
        assert got[m] == pytest.approx(pairs / len(pos) / len(neg))


def test_opinion_tie(spark):
    counts = spark.createDataFrame([("nb", 3, 3), ("svm", 0, 0), ("x", 4, 1)], "model string, positive long, negative long")
    for tie in ("negative", "positive"):
        got = {r.model: (r.positive_pct, r.dominant) for r in ev.opinion_conclusion(counts, tie).collect()}
        assert got == {"nb": (50.0, tie), "svm": (0.0, tie), "x": (80.0, "positive")}
