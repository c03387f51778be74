"""Running positions and sums inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows that a window over one bucket of a group holds, about.
BUCKET = 10_000


def running(df: DataFrame, group: str, key: str, ties: list[str], value: Column, out: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows of ``group`` that come before a row in the order of the hash ``key``.

    A group may hold any share of the rows: it is cut into ranges of the hash, each summed in a window of its own, and the
    sums of the ranges before are added. Ranges follow the number of rows, so none outgrows a task.
    """
    ranges = max(1, -(-df.count() // BUCKET))
    upper = F.shiftright(key, 32) + F.lit(1 << 31)
    cut = df.withColumn("_range", F.shiftright(upper * F.lit(ranges), 32))
    sums = cut.groupBy(group, "_range").agg(F.sum(value).alias("_sum"))
    before = W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col(group).alias("_group"), F.col("_range").alias("_of"),
                       F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy(group, "_range").orderBy(key, *ties).rowsBetween(W.unboundedPreceding, -1)
    own = cut.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = own.join(sums, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of")))
    return joined.select(*df.columns, (F.col("_start") + F.col("_inside")).alias(out))
