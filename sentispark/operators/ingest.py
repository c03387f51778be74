"""Ingest: constraints, keyword search, incremental insert, schema growth, upserts."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentispark.functions.sentiment import LABELS, parse_created_at, url_backfill, url_or_default
from sentispark.functions.text import each
from sentispark.operators.dedup import (HOT_ROWS, dedup_first_wins, pair_keys, store_keys,
                                        surviving_orders, without_keys)
from sentispark.operators.keystore import IDS, TEXTS, KeyStore, taken_keys
from sentispark.session import cut_lineage
from sentispark.sources.posts import OPTIONAL, REQUIRED

DEFAULT_SEARCH_LIMIT = 100


def valid_posts(df: DataFrame) -> DataFrame:
    """Skip rows that miss a required field or carry an unknown label."""
    out = df.na.drop(subset=list(REQUIRED))
    if "label" in df.columns:
        out = out.where(F.col("label").isNull() | F.col("label").isin(*LABELS))
    return out


def with_matched_keyword(df: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """One row per post and keyword its text contains, case-insensitively.

    The keyword list is a parameter, so matching stays inside the row.
    """
    text = F.lower("raw_text")
    listed = F.array(*[F.struct(F.lit(i).alias("keyword_pos"), F.lit(k).alias("keyword"),
                                F.contains(text, F.lower(F.lit(k))).alias("hit"))
                       for i, k in enumerate(keywords)])
    hits = each(df.drop("keyword"), F.filter(listed, lambda k: k["hit"]), "_m", "*")
    return hits.select("*", "_m.keyword_pos", "_m.keyword").drop("_m")


def keyword_latest(df: DataFrame, keywords: Sequence[str], limit: int = DEFAULT_SEARCH_LIMIT) -> DataFrame:
    """The newest ``limit`` matching posts of every keyword.

    The rank filter is applied per task before the shuffle, so a keyword that
    matches a third of all posts sends ``limit`` rows per task.
    """
    newest = Window.partitionBy("keyword_pos").orderBy(F.desc("created_ts"), F.asc("seq"))
    hits = with_matched_keyword(df, keywords).withColumn("created_ts", parse_created_at(F.col("created_at")))
    return (hits.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= limit))


def with_url(df: DataFrame) -> DataFrame:
    return df.withColumn("tweet_url", url_or_default(F.col("tweet_url"), F.col("username"), F.col("tweet_id")))


def backfill_url(df: DataFrame) -> DataFrame:
    return df.withColumn("tweet_url", url_backfill(F.col("tweet_url"), F.col("username"), F.col("tweet_id")))


def evolve_schema(df: DataFrame) -> DataFrame:
    """Older tables lack the optional columns: add them as null."""
    target = df.sparkSession.createDataFrame([], ", ".join(f"{c} string" for c in OPTIONAL))
    return df.unionByName(target, allowMissingColumns=True)


def insert_new(store: DataFrame | KeyStore, batch: DataFrame, order: str = "seq", id_col: str = "tweet_id",
               text: str = "raw_text", hot_rows: int = HOT_ROWS, before: int | None = None) -> DataFrame:
    """Rows of a batch that enter the store: stored ids and texts win, then first wins.

    ``store`` is a key store, of which only the prefixes of the batch's keys are read and only the batches before
    ``before``, or a table: the posts or their narrow keys, read whole.
    """
    keys = cut_lineage(pair_keys(batch, order, id_col, text))
    n = keys.count()
    for col, name in ((id_col, IDS), ("_k", TEXTS)):
        taken = taken_keys(store, keys, col, name, before) if isinstance(store, KeyStore) else store_keys(store, id_col, text)
        keys = without_keys(keys, taken, col, order, n, hot_rows)
    survivors = surviving_orders(keys, order, id_col, "_k", hot_rows)
    return batch.join(survivors, order, "left_semi")


def ingest(batch: DataFrame, store: DataFrame | KeyStore | None = None, before: int | None = None) -> DataFrame:
    """Constraint filter, two-key dedup (against the store, if any), derived links."""
    rows = valid_posts(batch)
    rows = dedup_first_wins(rows) if store is None else insert_new(store, rows, before=before)
    return with_url(rows)


def insert_counts(hits: DataFrame) -> DataFrame:
    """New rows per keyword and in total (keyword null); keywords are processed in list order,
    so a post found by several keywords counts for the first."""
    # one number, so that minima combine in a hash table; a struct would be sorted
    place = F.col("keyword_pos").cast("decimal(18,0)") * F.lit(Decimal(10) ** 19) + F.col("seq")
    ordered = hits.withColumn("_order", place.cast("decimal(38,0)"))
    kept = dedup_first_wins(ordered, order="_order")
    return kept.rollup("keyword").agg(F.count("*").alias("inserted"))


def upsert_columns(table: DataFrame, updates: DataFrame, columns: Sequence[str],
                   key: str = "tweet_id", order: str | None = None) -> DataFrame:
    """Set ``columns`` by key from ``updates``; rows without an update keep their values.

    All columns come from the same side of a match, as one UPDATE would set them. Of several updates of a key the
    last by ``order`` wins; without an order the greatest by value, so that reruns agree. A row is never multiplied.
    """
    values = F.struct(*columns)
    last = F.max(values) if order is None else F.max_by(values, order)
    new = updates.groupBy(key).agg(last.alias("_v")).select(
        key, *[F.col("_v")[c].alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = table.join(new, key, "left")
    for c in columns:
        joined = joined.withColumn(c, F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)))
    return joined.select(*table.columns)


def upsert_clean(table: DataFrame, cleaned: DataFrame, order: str | None = None) -> DataFrame:
    return upsert_columns(table, cleaned, ["cleaned_text"], order=order)


def upsert_label(table: DataFrame, labelled: DataFrame, order: str | None = None) -> DataFrame:
    return upsert_columns(table, labelled, ["sentiment_score", "label"], order=order)
