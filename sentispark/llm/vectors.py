"""Vectors fit for comparison, as rows and as arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def identified(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec``: one row per id, of rows that repeat an id the one with the least vector; null ids have none."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return rows.where("id is not null").groupBy("id").agg(F.min("vec").alias("vec"))


def usable(vectors: DataFrame) -> DataFrame:
    """Those that are not null, not zero and have finite components, all of the dimension most of them have."""
    x = F.col("vec")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    fit = vectors.where(x.isNotNull() & F.exists(x, lambda v: v != 0) & finite)
    common = fit.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return fit.where(F.size("vec") == (common["n"] if common else 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
