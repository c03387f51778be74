import hashlib
import math
import random

import pytest

from sentispark.operators import bayes, features as ft
from sentispark.operators.split import stratified_split, train_quotas

TINY = [("1", "a bagus sekali", "positive"), ("2", "bagus sekali", "positive"), ("3", "buruk sekali", "negative"),
        ("4", "x", "negative")]


@pytest.fixture(scope="module")
def tiny(spark):
    return spark.createDataFrame(TINY, "tweet_id string, cleaned_text string, label string")


def test_tiny_corpus(tiny):
    model = ft.fit_tfidf(tiny)
    assert model.terms == ["bagus", "bagus sekali", "buruk", "buruk sekali", "sekali"] and model.n_docs == 4
    idf = {t: math.log(5 / (1 + d)) + 1 for t, d in zip(model.terms, (2, 2, 1, 1, 3))}
    assert model.idf == pytest.approx([idf[t] for t in model.terms])
    got = {(r.tweet_id, r.term): r.weight for r in ft.term_weights(ft.tfidf(tiny, model), model).collect()}
    norm = math.sqrt(2 * idf["bagus"] ** 2 + idf["sekali"] ** 2)
    assert got[("1", "bagus sekali")] == pytest.approx(idf["bagus"] / norm)
    assert not [k for k in got if k[0] == "4"]
    assert ft.tfidf(tiny, model).where("tweet_id = '4'").first().features.numNonzeros() == 0


def test_limit_and_ties(tiny):
    assert [r.term for r in ft.vocabulary(tiny, 2).collect()] == ["sekali", "bagus"]


def test_top_mean_terms_reverse_ties(tiny):
    model = ft.fit_tfidf(tiny)
    top = ft.top_mean_terms(ft.tfidf(tiny, model), model, 4).collect()
    assert [r.term for r in top] == ["sekali", "bagus sekali", "bagus", "buruk sekali"]


def test_naive_bayes_by_hand(tiny):
    model = ft.fit_tfidf(tiny)
    rows = ft.tfidf(tiny, model).selectExpr("tweet_id", "int(label = 'positive') y", "features")
    nb = bayes.nb_fit(rows)
    dense = {r.tweet_id: (r.y, r.features.toArray()) for r in rows.collect()}
    for c in (0, 1):
        sums = sum(v for y, v in dense.values() if y == c) + 1
        assert nb.theta[c] == pytest.approx([math.log(x / sums.sum()) for x in sums])
    assert nb.prior == pytest.approx([math.log(.5)] * 2)
    for r in bayes.nb_predict(rows, nb).collect():
        jll = [nb.prior[c] + sum(w * t for w, t in zip(dense[r.tweet_id][1], nb.theta[c])) for c in (0, 1)]
        assert r.nb_margin == pytest.approx(jll[1] - jll[0])
        assert r.nb_pred == int(jll[1] > jll[0])
        assert r.nb_proba == pytest.approx(math.exp(jll[1]) / (math.exp(jll[0]) + math.exp(jll[1])))


def test_quotas():
    assert train_quotas({"negative": 45 * 5, "positive": 23 * 5}) == {"negative": 180, "positive": 92}
    assert train_quotas({"a": 5, "b": 5, "c": 1}) == {"a": 4, "b": 3, "c": 1}


@pytest.mark.parametrize("n,share", [(2000, .3), (57, .5), (11, .2)])
def test_split_takes_the_first_hashes_of_each_class(spark, n, share):
    rng = random.Random(n)
    rows = [(str(i), "positive" if i < 2 or rng.random() < share else "negative") for i in range(n)]
    df = spark.createDataFrame(rows, "tweet_id string, label string")
    got = {r.tweet_id for r in stratified_split(df).where("is_train").collect()}
    counts = {c: sum(l == c for _, l in rows) for c in ("positive", "negative")}
    expected = set()
    for c, q in train_quotas(counts).items():
        order = sorted((i for i, l in rows if l == c), key=lambda i: hashlib.md5(f"{i}:42".encode()).hexdigest())
        expected |= set(order[:q])
    assert got == expected and len(rows) - len(got) == math.ceil(.2 * n)


def test_split_needs_two_full_classes(spark):
    with pytest.raises(ValueError):
        stratified_split(spark.createDataFrame([("1", "a"), ("2", "a")], "tweet_id string, label string"))
    with pytest.raises(ValueError):
        stratified_split(spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b")], "tweet_id string, label string"))
