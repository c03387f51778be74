"""A table laid out by hash prefix of its key, of which an update reads and rewrites only the prefixes it touches.

An update is staged first, beside the table, and a mark says when it is whole; then the staged partitions replace those of
the table, and the mark goes. A run that dies before the mark changes nothing. One that dies behind it may leave the table
half exchanged: the next use of the table finds the mark and exchanges the staged partitions again.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentispark.operators.ingest import upsert_columns
from sentispark.operators.keystore import PREFIXES


class KeyedTable(NamedTuple):
    path: str
    schema: str  # of the rows, as a DDL string
    key: str = "tweet_id"
    prefixes: int = PREFIXES

    @property
    def column(self) -> str:
        return f"p{self.prefixes}"

    @property
    def staged(self) -> str:
        return f"{self.path}.staged"

    @property
    def mark(self) -> str:
        return f"{self.path}.whole"

    def prefix(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.prefixes)).cast("int").alias(self.column)


def create(rows: DataFrame, path: str, key: str = "tweet_id", prefixes: int = PREFIXES) -> KeyedTable:
    table = KeyedTable(path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), key, prefixes)
    placed = rows.select("*", table.prefix()).repartition(table.column)
    placed.write.mode("overwrite").partitionBy(table.column).parquet(path)
    return table


def _rows(spark: SparkSession, table: KeyedTable, path: str) -> DataFrame:
    return spark.read.schema(f"{table.schema}, {table.column} int").parquet(path)


def read(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """All rows; an exchange that was broken off is finished first."""
    _finish(spark, table)
    return _rows(spark, table, table.path).drop(table.column)


def touched(spark: SparkSession, table: KeyedTable, updates: DataFrame) -> DataFrame:
    """The rows of the prefixes that hold a key of ``updates``; at most ``prefixes`` numbers reach the driver."""
    own = sorted(r[0] for r in updates.select(table.prefix()).distinct().collect())
    return _rows(spark, table, table.path).where(F.col(table.column).isin(own))


def upsert(table: KeyedTable, updates: DataFrame, columns: Sequence[str], order: str | None = None) -> None:
    """Set ``columns`` by key, as ``upsert_columns`` does; prefixes without an update are neither read nor written."""
    spark = updates.sparkSession
    _finish(spark, table)
    new = upsert_columns(touched(spark, table, updates), updates, columns, table.key, order)
    new.repartition(table.column).write.mode("overwrite").partitionBy(table.column).parquet(table.staged)
    _set_mark(spark, table, [(1,)])
    _finish(spark, table)


def _finish(spark: SparkSession, table: KeyedTable) -> None:
    try:
        if not spark.read.schema("whole int").parquet(table.mark).take(1):
            return
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        return
    (_rows(spark, table, table.staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(table.column).parquet(table.path))
    _set_mark(spark, table, [])


def _set_mark(spark: SparkSession, table: KeyedTable, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, "whole int").coalesce(1).write.mode("overwrite").parquet(table.mark)
