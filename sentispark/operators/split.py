"""Exact stratified split by radix selection on a seeded hash."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentispark.session import cut_lineage

DIGITS = 3          # hex digits fixed per pass: 4096 counts per class
HASH_DIGITS = 32
TEST_SIZE = 0.2
SEED = 42


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def train_quotas(counts: dict[str, int], test_size: float = TEST_SIZE) -> dict[str, int]:
    """Training rows per class: the test set takes ceil(test_size * n) rows, classes share
    the rest by largest remainder; equal remainders go to classes in name order."""
    total = sum(counts.values())
    n_train = total - math.ceil(test_size * total)
    quotas = {c: counts[c] * n_train // total for c in sorted(counts)}
    open_seats = n_train - sum(quotas.values())
    by_remainder = sorted(quotas, key=lambda c: (-(counts[c] * n_train % total), c))
    for c in by_remainder[:open_seats]:
        quotas[c] += 1
    return quotas


def split_key(id_col: str, seed: int = SEED):
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def cut_points(keyed: DataFrame, ranks: dict[tuple[str, int], int]) -> dict[tuple[str, int], str]:
    """For each (class, number) the hash of the row of that class with the given rank, "" for rank 0.

    ``keyed`` has ``label`` and ``_key``. Each pass counts rows by the next hex digits below the prefixes known so far
    and steps into the digit group that holds the wanted row: no sort, no
    window, and the driver sees at most 4096 counts per open cut and pass.
    """
    found = {c: "" for c, q in ranks.items() if q == 0}
    state = {c: ("", q) for c, q in ranks.items() if q > 0}
    depth = 0
    while state:
        if depth >= HASH_DIGITS:
            raise ValueError("row ids must be unique for an exact split")
        width = min(DIGITS, HASH_DIGITS - depth)
        inside = F.lit(False)
        for c, prefix in {(c[0], prefix) for c, (prefix, _) in state.items()}:
            inside = inside | ((F.col("label") == c) & F.col("_key").startswith(prefix))
        counts: dict[str, dict[str, tuple[int, str]]] = {c[0]: {} for c in state}
        for r in (keyed.where(inside)
                  .groupBy("label", F.substring("_key", 1, depth + width).alias("part"))
                  .agg(F.count("*").alias("n"), F.max("_key").alias("last")).collect()):
            counts[r["label"]][r["part"]] = (r["n"], r["last"])
        following = {}
        for c, (prefix, need) in state.items():
            for part in sorted(p for p in counts[c[0]] if p.startswith(prefix)):
                n, last = counts[c[0]][part]
                if need < n:
                    following[c] = (part, need)
                    break
                need -= n
                if need == 0:
                    found[c] = last
                    break
        state = following
        depth += width
    return found


def _keyed(df: DataFrame, label: str, id_col: str, seed: int) -> tuple[DataFrame, dict[str, int]]:
    """Class and hash of every row, written once so that the passes over them read no texts; the class sizes."""
    keyed = cut_lineage(df.select(F.col(label).alias("label"), split_key(id_col, seed).alias("_key")))
    return keyed, {r["label"]: r["n"] for r in class_counts(keyed).collect()}


def in_class_parts(df: DataFrame, parts: int, label: str, id_col: str, seed: int = SEED) -> tuple[DataFrame, dict[str, int]]:
    """``df`` with ``_part``, which deals each class into ``parts`` parts whose sizes differ by one at most; the class sizes."""
    keyed, counts = _keyed(df, label, id_col, seed)
    cuts = cut_points(keyed, {(c, k): n * k // parts for c, n in counts.items() for k in range(1, parts)})
    key, part = split_key(id_col, seed), F.lit(None).cast("int")
    for c in counts:
        behind = sum(((key > F.lit(cuts[c, k])).cast("int") for k in range(1, parts)), F.lit(0))
        part = F.when(F.col(label) == F.lit(c), behind).otherwise(part)
    return df.withColumn("_part", part), counts


def stratified_split(df: DataFrame, label: str = "label", id_col: str = "tweet_id",
                     test_size: float = TEST_SIZE, seed: int = SEED) -> DataFrame:
    """``df`` with ``is_train``: exact class sizes, rows of a class in seeded hash order.

    The result is a projection: a row compares its hash with the cut of its
    class. Only counts are shuffled to find the cuts.
    """
    keyed, counts = _keyed(df, label, id_col, seed)
    if len(counts) < 2:
        raise ValueError("training needs at least two classes")
    if min(counts.values()) < 2:
        raise ValueError("every class needs at least two rows")
    quotas = train_quotas(counts, test_size)
    cuts = {c: cut for (c, _), cut in cut_points(keyed, {(c, 0): n for c, n in quotas.items()}).items()}
    in_train = F.lit(False)
    key = split_key(id_col, seed)
    for c, cut in cuts.items():
        in_train = F.when(F.col(label) == c, key <= F.lit(cut)).otherwise(in_train)
    return df.withColumn("is_train", in_train)
