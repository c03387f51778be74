"""The whole training phase on a separable corpus, and its exports."""

import json
import math
import random

import pytest
from pyspark.ml.linalg import Vectors

from sentispark.operators import svm
from sentispark.operators.split import in_class_parts
from sentispark.plans.phases import run_train, score_corpus
from sentispark.plans.results import evaluation_report, export_metrics, results_document
from sentispark.sources.sinks import write_csv, write_json

GOOD, BAD, COMMON = ["bagus", "senang", "sehat"], ["buruk", "mahal", "gagal"], ["program", "sekolah", "anak", "menu"]


def corpus(n, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        label = "positive" if i % 3 else "negative"
        own = GOOD if label == "positive" else BAD
        words = [rng.choice(own)] + [rng.choice(COMMON) for _ in range(4)]
        rng.shuffle(words)
        rows.append((str(i), " ".join(words), label))
    return rows + [(f"n{i}", "program sekolah", "neutral") for i in range(7)]


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(corpus(90), "tweet_id string, cleaned_text string, label string").coalesce(2).persist()


@pytest.fixture(scope="module")
def fitted(posts):
    return run_train(posts)


def test_quality_floor(fitted):
    assert (fitted.train_size, fitted.test_size) == (72, 18)
    for r in fitted.comparison.collect():
        assert r.accuracy >= .9 and r.auc >= .95
    assert fitted.platt.slope > 0
    svm = [r for r in fitted.scored.collect() if r.model == "svm"]
    assert all(0 < r.score < 1 for r in svm)


def test_corpus_includes_neutral(posts, fitted):
    for r in score_corpus(posts, fitted).collect():
        assert r.positive + r.negative == 97


def test_exports(posts, fitted, tmp_path):
    assert export_metrics(fitted.comparison).columns == [
        "Model", "Accuracy", "Precision", "Recall", "F1-Score", "AUC-ROC", "TP", "TN", "FP", "FN"]
    write_csv(export_metrics(fitted.comparison).orderBy("Model"), str(tmp_path / "m"), single_file=True)
    lines = next((tmp_path / "m").glob("*.csv")).read_text().splitlines()
    assert lines[0].startswith("Model,Accuracy") and len(lines) == 3
    write_json(results_document(posts, fitted), str(tmp_path / "r"), single_file=True)
    doc = json.loads(next((tmp_path / "r").glob("*.json")).read_text())
    assert doc["dataset_size"] == 90 and doc["test_positive"] == 12 and doc["test_negative"] == 6
    assert set(doc["models"]) == {"nb", "svm"} and len(doc["top_terms"]) == 10
    weights = [t["weight"] for t in doc["top_terms"]]
    assert weights == sorted(weights, reverse=True)


def test_report_rows(posts, fitted):
    got = {(r.section, r.item): r.value for r in evaluation_report(posts, fitted).collect()}
    assert got[("distribution", "labelled")] == "97" and got[("distribution", "dominant")] == "positive"
    assert got[("dataset", "train")] == "72" and got[("neutral", "excluded")] == "7"
    assert ("confusion", "svm.tp") in got and ("winner", "winner") in got and ("opinion", "nb.dominant") in got


def test_too_little_data(spark):
    rows = [(str(i), "kata ini", "positive" if i % 2 else "negative") for i in range(9)]
    assert run_train(spark.createDataFrame(rows, "tweet_id string, cleaned_text string, label string")) is None


@pytest.mark.parametrize("positive, negative", [(9, 2), (3, 8)])
def test_training_on_uneven_classes(spark, positive, negative):
    rows = [(f"p{i}", f"bagus sekali nomor {'abcdefghij'[i % 10]}x", "positive") for i in range(positive)]
    rows += [(f"n{i}", f"buruk sekali nomor {'abcdefghij'[i % 10]}x", "negative") for i in range(negative)]
    fitted = run_train(spark.createDataFrame(rows, "tweet_id string, cleaned_text string, label string"))
    n = positive + negative
    assert fitted.train_size + fitted.test_size == n and fitted.test_size == -(-n // 5)
    assert all(0 <= r.score <= 1 for r in fitted.scored.collect())
    assert {r.model for r in fitted.comparison.collect()} == {"nb", "svm"}


def test_folds_deal_every_class_evenly(spark):
    rows = [(str(i), "a" if i % 10 else "b") for i in range(303)]
    dealt, sizes = in_class_parts(spark.createDataFrame(rows, "id string, y string"), 5, "y", "id")
    assert sizes == {"a": 272, "b": 31}
    got = {(r.y, r._part): r["count"] for r in dealt.groupBy("y", "_part").count().collect()}
    assert sorted(n for (y, _), n in got.items() if y == "a") == [54, 54, 54, 55, 55]
    assert sorted(n for (y, _), n in got.items() if y == "b") == [6, 6, 6, 6, 7]


def test_margins_without_a_second_class(spark):
    """The one negative row is in one fold; the other folds' model has both classes, its own only the positive one."""
    vectors = [(str(i), 1, Vectors.sparse(2, [0], [1.0])) for i in range(9)] + [("x", 0, Vectors.sparse(2, [1], [1.0]))]
    got = svm.held_out_margins(spark.createDataFrame(vectors, ["tweet_id", "y", "features"])).collect()
    assert len(got) == 10 and [r.svm_margin for r in got if r.tweet_id == "x"] == [1.0]


@pytest.mark.parametrize("rows", [
    [(m / 10, int(m > 3 or m % 7 == 0)) for m in range(-30, 40)], [(1.0, 1)] * 9 + [(1.0, 0)] * 2, [(50.0, 1), (-50.0, 0)],
    [(float(m * 1000), int(m > 0)) for m in range(-5, 6)], [(2.0, 1)] * 3])
def test_sigmoid_is_at_its_optimum(spark, rows):
    """No step to either side of both parameters lowers the loss."""
    df = spark.createDataFrame(rows, "svm_margin double, y int")
    fitted = svm.platt_fit(df)
    p = sum(y for _, y in rows)
    q = len(rows) - p
    target = [(p + 1) / (p + 2) if y else 1 / (q + 2) for _, y in rows]

    def loss(a, b):
        z = [a * m + b for m, _ in rows]
        return sum(max(v, 0) - t * v + math.log1p(math.exp(-abs(v))) for v, t in zip(z, target))

    best = loss(*fitted)
    for da, db in ((1e-3, 0), (-1e-3, 0), (0, 1e-3), (0, -1e-3), (1e-3, 1e-3), (-1e-3, -1e-3)):
        assert loss(fitted.slope + da, fitted.offset + db) >= best - 1e-6


def test_only_labelled_texts_are_cleaned(spark, tmp_path):
    """Texts meet their labels before they are cleaned, and the report reads the posts' labels once."""
    import contextlib
    import io
    from sentispark.plans import inputs as ip

    docs = [(n, f"Some text {n}", "en", "web", 9) for n in range(6)] + [(None, "x", "en", "web", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    marks = [(0, 1), (1, 0), (2, None), (3, 1), (3, 0), (None, 1)]
    spark.createDataFrame(marks, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = ip.gold_binary(spark, str(tmp_path))
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, ip.gold(spark, str(tmp_path)).where("label <> 'neutral'").collect())) == [
        ("0", "some text", "positive"), ("1", "some text", "negative"), ("3", "some text", "negative"), ("3", "some text", "positive")]
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        rows.explain("simple")
    plan = out.getvalue().split("Initial Plan")[0]
    assert plan.index("[^a-z]+") < plan.index("Join")
