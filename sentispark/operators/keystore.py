"""A table of keys laid out by hash prefix, so that a batch reads the prefixes its own keys fall into.

Two tables lie under ``root``: ``ids`` and ``texts`` (32-byte digests), each as ``batch=<n>/p<prefixes>=<k>``. The number
of prefixes is part of the folder names, so a store cannot be read with another. Writing a batch again replaces it, and a
reader asks for the batches before its own, so a batch that failed half way leaves nothing behind that counts.

Reading needs no look at other prefixes: the prefixes of the batch's keys, at most ``prefixes`` numbers, reach the driver
and become partition filters. What is read then meets the batch's keys, broadcast while they are small, so a small batch
does not shuffle the store.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentispark.operators.dedup import store_keys

#: Choose it so that a prefix holds some 100 MB of keys in the end.
PREFIXES = 64
#: Bytes of keys of a batch that are broadcast at most.
BROADCAST_BYTES = 32 << 20
IDS, TEXTS = "ids", "texts"


class KeyStore(NamedTuple):
    root: str
    prefixes: int = PREFIXES

    @property
    def column(self) -> str:
        return f"p{self.prefixes}"

    def prefix(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.prefixes)).cast("int").alias(self.column)


def add_keys(store: KeyStore, rows: DataFrame, batch: int, id_col: str = "tweet_id", text: str = "raw_text") -> None:
    """Write the keys of the rows that batch ``batch`` inserted, in the place of what it wrote before."""
    keys = store_keys(rows, id_col, text)
    for name, col in ((IDS, id_col), (TEXTS, "_k")):
        placed = keys.select(F.col(col).alias("key")).distinct().select("key", store.prefix(F.col("key")))
        (placed.repartition(store.column).sortWithinPartitions(store.column, "key").write.mode("overwrite")
         .partitionBy(store.column).parquet(f"{store.root}/{name}/batch={batch}"))


def stored_keys(spark: SparkSession, store: KeyStore, name: str, prefixes: list[int] | None = None,
                before: int | None = None) -> DataFrame:
    """``key`` of the given prefixes (None: all) and of the batches before ``before`` (None: all)."""
    kind = "string" if name == IDS else "binary"
    rows = spark.read.schema(f"key {kind}, batch long, {store.column} int").parquet(f"{store.root}/{name}")
    if prefixes is not None and len(prefixes) < store.prefixes:
        rows = rows.where(F.col(store.column).isin(prefixes))
    if before is not None:
        rows = rows.where(F.col("batch") < before)
    return rows.select("key")


def taken_keys(store: KeyStore, keys: DataFrame, col: str, name: str, before: int | None = None) -> DataFrame:
    """Those values of ``col`` in ``keys`` that the store holds, as one column ``col``. ``keys`` should be materialised."""
    own = keys.select(F.col(col).alias("key")).distinct()
    touched = [r[0] for r in own.select(store.prefix(F.col("key"))).distinct().collect()]  # at most store.prefixes numbers
    size = own.agg(F.sum(F.octet_length("key") + 16)).first()[0] or 0
    own = F.broadcast(own) if size <= BROADCAST_BYTES else own
    return stored_keys(keys.sparkSession, store, name, touched, before).join(own, "key", "left_semi").select(F.col("key").alias(col))


def merged(store: KeyStore, spark: SparkSession, root: str, before: int) -> KeyStore:
    """The batches before ``before`` as one batch of a new store, one file a prefix; the caller changes over to it."""
    new = KeyStore(root, store.prefixes)
    for name in (IDS, TEXTS):
        keys = stored_keys(spark, store, name, before=before).distinct().select("key", store.prefix(F.col("key")))
        (keys.repartition(store.column).sortWithinPartitions(store.column, "key").write.mode("overwrite")
         .partitionBy(store.column).parquet(f"{root}/{name}/batch={before - 1}"))
    return new
