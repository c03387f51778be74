"""Joining rows with a word table: broadcast behind a size check, salted shuffle beyond it."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentispark.functions.text import join_words, tokens
from sentispark.operators.dedup import text_key
from sentispark.session import cut_lineage

MAX_BROADCAST_ROWS = 1_000_000   # word tables: some 30 MB
MAX_LITERAL_WORDS = 400_000      # word maps carried inside the plan, and the bytes of their words
MAX_LITERAL_BYTES = 16 << 20
SHORT_TABLE = 5_000
ENTRIES = 4                      # of a small map that a look-up walks
SALTS = 64


def fits(table: DataFrame, max_rows: int) -> bool:
    """Whether a table has at most ``max_rows`` rows; reads no more than it must."""
    return table.limit(max_rows + 1).count() <= max_rows


def lookup(rows: DataFrame, table: DataFrame, on: str, how: str, spread: list[str],
           max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join token rows with a table that holds each word once.

    Past the size limit both sides are shuffled by word and salt: the frequent
    words of a language would otherwise meet in a handful of tasks. ``spread``
    names columns that tell rows of one word apart, so a retried task salts
    its rows as before.
    """
    if fits(table, max_rows):
        return rows.join(F.broadcast(table), on, how)
    salt = F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", salt).join(copies, [on, "_salt"], how).drop("_salt")


def literal_map(table: DataFrame, value: str, ddl: str, max_words: int = MAX_LITERAL_WORDS,
                max_bytes: int = MAX_LITERAL_BYTES):
    """A (word, value) table as a look-up function inside the row, or None if it is too large.

    The words travel in the plan as an array of small maps, picked by hash:
    Spark walks a map entry by entry, and dealt to many maps a look-up touches
    some ``ENTRIES``. Many more maps than that would cost more to build than they save. ``table`` holds each word once. A short
    one is collected at once; the size of another is checked before.
    """
    columns = table.select("word", F.col(value).alias("v"), F.hash("word").alias("h"))
    rows = columns.limit(min(SHORT_TABLE, max_words) + 1).collect()
    if len(rows) > max_words:
        return None
    if len(rows) > SHORT_TABLE:
        size = columns.agg(F.count("*").alias("n"), F.sum(F.octet_length("word") + F.octet_length(F.col("v").cast("string"))).alias("b")).first()
        if size["n"] > max_words or size["b"] > max_bytes:
            return None
        rows = columns.collect()
    slots = max(16, len(rows) // ENTRIES)
    dealt: list[dict] = [{} for _ in range(slots)]
    for r in rows:
        dealt[r.h % slots][r.word] = r.v
    packed = F.from_json(F.lit(json.dumps(dealt)), f"array<map<string,{ddl}>>")
    return lambda w: F.try_element_at(F.get(packed, F.pmod(F.hash(w), F.lit(slots))), w)


def replace_words(df: DataFrame, key: str, text: str, mapping: DataFrame,
                  max_literal: int = MAX_LITERAL_WORDS,
                  max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Replace words of a cleaned text by a (word, stem) table; a word without entry stays,
    a word mapped to '' is dropped.

    A table within the limits goes into the plan and the work stays inside the row. A
    larger one is joined with the different words of every distinct text. Only words that change come back, as maps beside
    the text: occurrences are neither sorted nor gathered. Rows find their new text by its digest: the result of a row
    depends on its text alone, whatever its key and the size of the table.
    """
    mapping = mapping.groupBy("word").agg(F.min("stem").alias("stem"))
    found = literal_map(mapping, "stem", "string", max_literal)
    if found is not None:
        mapped = F.transform(tokens(text), lambda w: F.coalesce(found(w), w))
        return df.withColumn(text, join_words(F.array_remove(mapped, "")))
    mapping = cut_lineage(mapping.where("stem <> word"))
    texts = distinct_texts(df, text)
    words = texts.select("_d", F.explode_outer(F.array_distinct(tokens("_text"))).alias("word")).where("word IS NOT NULL")
    hits = lookup(words, mapping, "word", "inner", ["_d", "word"], max_rows).groupBy("_d").agg(F.collect_list(F.struct("word", "stem")).alias("_hits"))
    made = texts.join(hits.select("_d", _dealt("_hits").alias("_maps")), "_d", "left").select("_d", _replaced("_text", "_maps").alias("_new"))
    return (df.withColumn("_d", text_key(text)).join(made, "_d", "left")
            .withColumn(text, F.coalesce("_new", F.lit(""))).select(*df.columns))


def _dealt(hits: str):
    """An array of (word, stem) as an array of small maps, picked by hash: as many as there are words in one."""
    slots = F.ceil(F.sqrt(F.size(hits))).cast("int")
    return F.transform(F.sequence(F.lit(0), slots - 1), lambda slot: F.map_from_entries(
        F.filter(hits, lambda h: F.pmod(F.hash(h["word"]), slots) == slot)))


def _replaced(text: str, maps: str):
    """The text with its words looked up in the maps; without maps, as it is."""
    def found(w):
        return F.try_element_at(F.get(F.col(maps), F.pmod(F.hash(w), F.size(maps))), w)

    mapped = F.transform(tokens(text), lambda w: F.coalesce(found(w), w))
    return join_words(F.when(F.col(maps).isNull(), tokens(text)).otherwise(F.array_remove(mapped, "")))


def distinct_texts(df: DataFrame, text: str) -> DataFrame:
    """``_d, _text``: every text once, under its digest; nulls have none."""
    return df.where(F.col(text).isNotNull()).select(text_key(text).alias("_d"), F.col(text).alias("_text")).dropDuplicates(["_d"])


def drop_listed_words(df: DataFrame, key: str, text: str, stopwords: DataFrame, **limits) -> DataFrame:
    """Stop word removal with the list given as a table (column ``word``)."""
    return replace_words(df, key, text, stopwords.select("word", F.lit("").alias("stem")), **limits)
