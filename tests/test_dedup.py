import random

import pytest

from sentispark.operators.dedup import dedup_exact_text, dedup_first_wins, surviving_orders
from sentispark.operators.ingest import (upsert_clean, evolve_schema, insert_counts, insert_new, keyword_latest, upsert_label,
                                         valid_posts, with_matched_keyword)

SCHEMA = "seq long, tweet_id string, raw_text string"
CASES = [
    ([(1, "A", "t1"), (2, "B", "t1"), (3, "B", "t2")], [1, 3]),
    ([(1, "A", "t1"), (2, "A", "t2"), (3, "B", "t2")], [1, 3]),
    ([(1, "A", "t1"), (2, "A", "t2"), (3, "B", "t2"), (4, "B", "t3"), (5, "C", "t3")], [1, 3, 5]),
    ([(1, "A", "Halo"), (2, "B", "halo")], [1, 2]),
]
LIMITS = [{}, {"hot_rows": 3}, {"hot_rows": 1}]


def sequential(rows, stored=()):
    ids, texts = {i for i, _ in stored}, {t for _, t in stored}
    kept = []
    for seq, i, t in sorted(rows):
        if i not in ids and t not in texts:
            ids.add(i)
            texts.add(t)
            kept.append(seq)
    return kept


def kept_of(df):
    return sorted(r.seq for r in df.collect())


@pytest.mark.parametrize("rows,expected", CASES)
def test_cases(spark, rows, expected):
    assert kept_of(dedup_first_wins(spark.createDataFrame(rows, SCHEMA))) == expected


@pytest.mark.parametrize("limits", LIMITS)
def test_random_against_sequential(spark, limits):
    rng = random.Random(3)
    rows = [(n, f"i{rng.randint(0, 60)}", f"t{rng.randint(0, 60)}") for n in range(300)]
    assert kept_of(dedup_first_wins(spark.createDataFrame(rows, SCHEMA), **limits)) == sequential(rows)


@pytest.mark.parametrize("hot_rows", [1_000_000, 20])
def test_one_text_holds_a_third(spark, hot_rows):
    """A spam text under many ids, some of which also carry other texts."""
    rng = random.Random(5)
    rows = [(n, f"i{rng.randint(0, 400)}", "spam" if n % 3 == 0 else f"t{rng.randint(0, 200)}") for n in range(1, 600)]
    stored = [("i5", "t7"), ("i6", "spam")]
    batch = spark.createDataFrame(rows, SCHEMA)
    assert kept_of(dedup_first_wins(batch, hot_rows=hot_rows)) == sequential(rows)
    store = spark.createDataFrame(stored, "tweet_id string, raw_text string")
    assert kept_of(insert_new(store, batch, hot_rows=hot_rows)) == sequential(rows, stored)


@pytest.mark.parametrize("seed, n, ids, texts", [(1, 120, 12, 12), (2, 200, 150, 8), (3, 200, 90, 90), (4, 60, 3, 50), (5, 300, 200, 140)])
def test_branching_collisions(spark, seed, n, ids, texts):
    rng = random.Random(seed)
    rows = [(k, f"i{rng.randrange(ids)}", f"t{rng.randrange(texts)}") for k in range(n)]
    assert kept_of(dedup_first_wins(spark.createDataFrame(rows, SCHEMA))) == sequential(rows)


def chains(number, length):
    """Rows that collide with the one before by id and the one after by text, in turn; numbered along each chain."""
    return [(c * length + n, f"i{c}-{n // 2}", f"t{c}-{(n + 1) // 2}") for c in range(number) for n in range(length)]


@pytest.mark.parametrize("number, length, most", [(500, 100, 8), (1, 20_000, 16)])
def test_rounds_grow_with_the_logarithm_of_a_chain(spark, number, length, most):
    rows = chains(number, length)
    trace = []
    keys = spark.createDataFrame(rows, "seq long, tweet_id string, _k string")
    kept = surviving_orders(keys, "seq", "tweet_id", "_k", trace=trace)
    assert kept_of(kept) == [k for k in range(number * length) if k % length % 2 == 0]
    assert len(trace) <= 3 and sum(passes for _, passes in trace) <= most


def test_chain_that_hangs_on_a_branching(spark):
    """A row with two rivals in each group, and a chain that takes its fate."""
    head = [(0, "a", "x"), (1, "a", "y"), (2, "b", "z"), (3, "b", "y"), (4, "c", "z"), (5, "c", "y")]
    tail = [(6 + n, f"d{(n + 1) // 2}" if n else "c", f"u{n // 2}") for n in range(40)]
    rows = head + tail
    assert kept_of(dedup_first_wins(spark.createDataFrame(rows, SCHEMA))) == sequential(rows)


def test_against_store(spark):
    store = spark.createDataFrame([("A", "t1")], "tweet_id string, raw_text string")
    batch = spark.createDataFrame([(1, "A", "t9"), (2, "B", "t1"), (3, "B", "t9")], SCHEMA)
    assert kept_of(insert_new(store, batch)) == [3]


def test_empty_input(spark):
    assert kept_of(dedup_first_wins(spark.createDataFrame([], SCHEMA))) == []


def test_exact_text_keeps_the_earliest(spark):
    rows = [(3, "a", "x"), (1, "b", "x"), (2, "c", "y"), (4, "d", "Y")]
    assert kept_of(dedup_exact_text(spark.createDataFrame(rows, SCHEMA))) == [1, 2, 4]


def test_constraints(spark):
    rows = [("1", "u", "2024", "x", "k", None), ("2", None, "2024", "x", "k", None),
            ("3", "u", "2024", "x", "k", "happy"), ("4", "u", "2024", "x", "k", "neutral")]
    df = spark.createDataFrame(rows, "tweet_id string, username string, created_at string, raw_text string, "
                                     "keyword string, label string")
    assert sorted(r.tweet_id for r in valid_posts(df).collect()) == ["1", "4"]


def test_keyword_search_and_counts(spark):
    rows = [(n, str(n), f"2024-01-01T00:0{n}:00", t, "") for n, t in
            enumerate(["MBG hari ini", "program mbg", "lain", "Program MBG besok"])]
    posts = spark.createDataFrame(rows, "seq long, tweet_id string, created_at string, raw_text string, keyword string")
    top = keyword_latest(posts, ["mbg", "Program MBG"], 2).select("keyword", "seq", "rank").collect()
    assert sorted((r.keyword, r.rank, r.seq) for r in top) == [
        ("Program MBG", 1, 3), ("Program MBG", 2, 1), ("mbg", 1, 3), ("mbg", 2, 1)]
    counts = insert_counts(with_matched_keyword(posts, ["Program MBG", "mbg"])).collect()
    assert {r.keyword: r.inserted for r in counts} == {"Program MBG": 2, "mbg": 1, None: 3}


def test_schema_growth_and_upsert(spark):
    old = spark.createDataFrame([("1",)], "tweet_id string")
    assert evolve_schema(old).first().asDict() == {"tweet_id": "1", "tweet_url": None, "reply_to_id": None}
    table = spark.createDataFrame([("1", 0, None), ("2", 4, "positive")],
                                  "tweet_id string, sentiment_score long, label string")
    new = spark.createDataFrame([("1", -2, "negative"), ("9", 1, "positive")],
                                "tweet_id string, sentiment_score long, label string")
    assert sorted(tuple(r) for r in upsert_label(table, new).collect()) == [
        ("1", -2, "negative"), ("2", 4, "positive")]


def test_counts_of_large_order_numbers(spark):
    rows = [(2 * 10 ** 15, "a", "x", 0, "first"), (5, "b", "x", 1, "second")]
    hits = spark.createDataFrame(rows, "seq long, tweet_id string, raw_text string, keyword_pos int, keyword string")
    assert {r.keyword: r.inserted for r in insert_counts(hits).collect()} == {"first": 1, None: 1}


def test_repeated_updates_do_not_multiply_rows(spark):
    table = spark.createDataFrame([("1", None)], "tweet_id string, cleaned_text string")
    new = spark.createDataFrame([("1", "old", 1), ("1", "new", 2)], "tweet_id string, cleaned_text string, n int")
    assert [tuple(r) for r in upsert_clean(table, new, order="n").collect()] == [("1", "new")]
