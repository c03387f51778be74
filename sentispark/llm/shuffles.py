"""Sizes of exchanges, and tables of packed rows dealt out by a number."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentispark.llm.words import release, tidy

#: Bytes of text whose words one part of an exchange holds.
PART_BYTES = 4 << 20
#: Rows that a part hands on at a time.
OUT_ROWS = 64


def parts_for(docs: DataFrame, column: str = "text", each: int = PART_BYTES) -> int:
    """Parts to cut the words of a text column into: they follow its bytes, so that no part outgrows a task."""
    size = docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // each))


def by_part(df: DataFrame, reduce: Callable[[int, pa.Table], Iterator[dict]], schema: str, parts: int) -> DataFrame:
    """Applies ``reduce`` to all rows of each ``part``, one part in memory at a time; what it yields leaves at once."""
    out = pa_schema(schema)

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            rows = reduce(key[0].as_py(), pa.Table.from_batches(list(batches)))
            while made := list(islice(rows, OUT_ROWS)):
                yield pa.RecordBatch.from_pylist(made, schema=out)
        finally:
            release()

    return df.repartition(parts, "part").groupBy("part").applyInArrow(run, schema)


def over_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[list[dict]]], schema: str) -> DataFrame:
    """mapInArrow for a function that yields lists of rows."""
    out = pa_schema(schema)

    @tidy
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in run(batches):
            yield pa.RecordBatch.from_pylist(rows, schema=out)

    return df.mapInArrow(each, schema)


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "double": pa.float64(),
          "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}


def pa_schema(schema: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (x.split() for x in schema.split(", "))])
