"""Connected components of an edge table, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentispark.session import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(src, dst)`` to ``(id, component)``, one row per id that has an edge to another id.

    The component is the smallest id reachable. Rounds alternate two steps: every node hands its larger neighbours
    to its smallest one, then its smaller ones, until only stars are left; their number grows with the logarithm of
    the longest path. Loops and repeated edges do no harm, null ends are ignored.
    """
    now = cut_lineage(edges.where("src != dst").select(F.greatest("src", "dst").alias("u"),
                                                       F.least("src", "dst").alias("v")).distinct())
    seen = None
    while (state := _state(now)) != seen:
        seen = state
        now = cut_lineage(_to_least_smaller(_to_least_larger(now)))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _to_least_larger(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _to_least_smaller(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u")
    return (moved.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).distinct())
