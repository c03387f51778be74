"""What a batch reads of the stored keys, and that it decides as against the whole store."""

import random

import pytest
from pyspark.sql import functions as F

from sentispark.operators import keystore as ks
from sentispark.operators.dedup import text_key
from sentispark.operators.ingest import insert_new
from test_dedup import SCHEMA, kept_of, sequential
from test_plans import plan_of


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """20,000 posts in 16 prefixes, two batches."""
    return filled(spark, ks.KeyStore(str(tmp_path_factory.mktemp("keys")), 16))


def filled(spark, root):
    for b in (0, 1):
        rows = spark.range(b * 10_000, (b + 1) * 10_000).selectExpr("concat('i', id) AS tweet_id", "concat('t', id) AS raw_text")
        ks.add_keys(root, rows.coalesce(1), b)
    return root


def test_a_small_batch_reads_only_its_own_prefixes(spark, tmp_path):
    store = ks.KeyStore(str(tmp_path / "keys"), 1000)
    ks.add_keys(store, spark.range(10_000).selectExpr("concat('i', id) AS tweet_id", "'t' AS raw_text").coalesce(1), 0)
    batch = spark.createDataFrame([(n, f"i{n * 37}", f"new {n}") for n in range(100)], SCHEMA)
    own = {r[0] for r in batch.select(store.prefix(F.col("tweet_id"))).distinct().collect()}
    assert 80 < len(own) <= 100
    read = ks.stored_keys(spark, store, ks.IDS, sorted(own)).select(F.input_file_name().alias("f")).distinct().collect()
    assert {int(r.f.split("p1000=")[1].split("/")[0]) for r in read} == own
    taken = ks.taken_keys(store, batch, "tweet_id", ks.IDS)
    plan = plan_of(taken)
    assert "PartitionFilters: [p1000" in plan and "BroadcastHashJoin LeftSemi" in plan
    assert "SortMergeJoin" not in plan  # the store is not shuffled
    assert taken.count() == 100


def test_same_rows_as_against_the_whole_table(spark, store):
    rng = random.Random(2)
    rows = [(n, f"i{rng.randrange(30_000)}", f"t{rng.randrange(30_000)}") for n in range(2_000)]
    batch = spark.createDataFrame(rows, SCHEMA)
    stored = [(f"i{n}", f"t{n}") for n in range(20_000)]
    assert kept_of(insert_new(store, batch)) == sequential(rows, stored)
    assert kept_of(insert_new(store, batch, before=1)) == sequential(rows, stored[:10_000])


def test_large_batches_are_not_broadcast(spark, store, monkeypatch):
    monkeypatch.setattr(ks, "BROADCAST_BYTES", 10)
    batch = spark.createDataFrame([(n, f"i{n * 3}", f"t{n * 5}") for n in range(9_000)], SCHEMA)
    assert ks.taken_keys(store, batch, "tweet_id", ks.IDS).count() == 6_667
    assert ks.taken_keys(store, batch.select(text_key("raw_text").alias("_k")), "_k", ks.TEXTS).count() == 4_000


def test_a_batch_written_again_replaces_itself(spark, tmp_path):
    store = ks.KeyStore(str(tmp_path / "keys"), 8)
    first = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], SCHEMA)
    ks.add_keys(store, first, 0)
    ks.add_keys(store, first.where("seq = 2"), 0)
    assert [r.key for r in ks.stored_keys(spark, store, ks.IDS).collect()] == ["b"]
    ks.add_keys(store, first.where("seq = 9"), 1)  # a batch without rows
    assert kept_of(insert_new(store, first)) == [1]
    whole = ks.merged(store, spark, str(tmp_path / "new"), 2)
    assert kept_of(insert_new(whole, first)) == [1]
    assert kept_of(insert_new(whole, spark.createDataFrame([], SCHEMA))) == []
