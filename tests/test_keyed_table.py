"""Updates by key: what they read and write, and what a broken exchange leaves."""

import os
import random

import pytest
from pyspark.sql import functions as F

from sentispark.operators import keyed_table as kt
from sentispark.operators.ingest import upsert_columns
from test_plans import plan_of

SCHEMA = "tweet_id string, sentiment_score long, label string"


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def rows_of(df):
    return sorted(map(tuple, df.select("tweet_id", "sentiment_score", "label").collect()))


@pytest.fixture()
def table(spark, tmp_path):
    rows = spark.range(400).selectExpr("cast(id as string) tweet_id", "id sentiment_score", "'old' label")
    return kt.create(rows, str(tmp_path / "posts"), prefixes=20)


def test_other_prefixes_are_neither_read_nor_written(spark, table):
    before = files(table.path)
    new = spark.createDataFrame([("7", -1, "negative"), ("8", 2, "positive"), ("nobody", 1, "positive")], SCHEMA)
    own = {r[0] for r in new.select(table.prefix()).distinct().collect()}
    read = kt.touched(spark, table, new)
    assert f"PartitionFilters: [{table.column}" in plan_of(read)
    named = read.select(F.input_file_name().alias("f")).distinct().collect()
    assert {int(r.f.split(f"{table.column}=")[1].split("/")[0]) for r in named} <= own
    kt.upsert(table, new, ["sentiment_score", "label"])
    after = files(table.path)
    for f in set(before) | set(after):
        if int(f.split(f"{table.column}=")[1].split("/")[0]) not in own:
            assert before[f] == after[f]
    want = {str(k): (k, "old") for k in range(400)} | {"7": (-1, "negative"), "8": (2, "positive")}
    assert rows_of(kt.read(spark, table)) == sorted((k, *v) for k, v in want.items())


def test_same_as_the_join_of_whole_tables(spark, table):
    rng = random.Random(4)
    rows = [(str(rng.randrange(500)), rng.randrange(9), rng.choice("abc"), n) for n in range(300)]
    new = spark.createDataFrame(rows, SCHEMA + ", n int")
    want = rows_of(upsert_columns(kt.read(spark, table), new, ["sentiment_score", "label"], order="n"))
    kt.upsert(table, new, ["sentiment_score", "label"], order="n")
    assert rows_of(kt.read(spark, table)) == want


def test_no_updates(spark, table):
    want = rows_of(kt.read(spark, table))
    kt.upsert(table, spark.createDataFrame([], SCHEMA), ["label"])
    assert rows_of(kt.read(spark, table)) == want


def test_a_broken_exchange_is_finished(spark, table, monkeypatch):
    new = spark.createDataFrame([(str(k), 0, "new") for k in range(0, 400, 3)], SCHEMA)
    finish = kt._finish
    calls = []
    monkeypatch.setattr(kt, "_finish", lambda *a: calls.append(1) or (finish(*a) if len(calls) < 2 else None))
    kt.upsert(table, new, ["label"])  # dies behind the mark
    monkeypatch.undo()
    own = sorted(files(table.path))[0]
    os.remove(own)  # a partition is gone, as in the middle of an exchange
    got = {r[0]: r[2] for r in rows_of(kt.read(spark, table))}
    assert got == {str(k): "new" if k % 3 == 0 else "old" for k in range(400)}


def test_staged_without_a_mark_counts_for_nothing(spark, table):
    want = rows_of(kt.read(spark, table))
    spark.createDataFrame([("1", 5, "half", 3)], SCHEMA + f", {table.column} int").write.partitionBy(table.column).parquet(table.staged)
    assert rows_of(kt.read(spark, table)) == want
