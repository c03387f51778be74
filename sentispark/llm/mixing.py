"""A mix of sources by weight: hash-random order within each source, prefix sums, a cut at the exact budget.

Sources in code point order, null last, take the given weights in turn. Together they take ``share`` of all words; a
source stops at ``max_epochs`` times its size and the rest shares the excess by weight. A source with a budget of 1.4
times its size gives every document once and then, in the order of a hash, documents until the budget is full; the last
one gives the words that are left. Only ids, sources and sizes are exchanged, never texts, and no task holds a source:
see ``order.running``.

Defined results: null texts have size 0 and take 0; null sources are one source; a source without words has target 0;
repeated rows are documents of their own; texts may be of any length; null ids are ids; an empty table gives an empty result.
``mix_sources`` reads no other columns; ``mixed_rows`` hands all on, whatever their names. Collected are the totals of the
sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sentispark.llm.order import running
from sentispark.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, MAX_EPOCHS = (1, 2, 3), 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def keys(id_col: str, text_col: str, source_col: str) -> list[Column]:
    """Two numbers of 64 bits that name an id, text and source; rows that repeat all three share them."""
    parts = [F.col(c) for c in (id_col, text_col, source_col)]
    parts += [p.isNull() for p in parts]
    return [F.xxhash64(*parts).alias("doc_key"), F.xxhash64(F.lit(1), *parts).alias("doc_key2")]


def targets(totals: list[tuple[str | None, int]], weights: tuple = WEIGHTS, share: float = 1.0,
            max_epochs: int = MAX_EPOCHS) -> list[tuple[str | None, int, float]]:
    """Source, size and target of each source."""
    ordered = sorted(totals, key=lambda x: (x[0] is None, (x[0] or "").encode("utf-32-be")))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(ordered)}
    size, left = dict(ordered), share * sum(n for _, n in ordered)
    found: dict[str | None, float] = {}
    while True:
        rest = [s for s in size if s not in found]
        whole = sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / whole > max_epochs * size[s]]
        if not over:
            return [(s, n, found.get(s, left * weight[s] / whole if s not in found else 0.0)) for s, n in ordered]
        for s in over:
            found[s] = float(max_epochs * size[s])
        left -= sum(found[s] for s in over)
        if len(over) == len(rest):
            return [(s, n, found[s]) for s, n in ordered]


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                weights: tuple = WEIGHTS, share: float = 1.0, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per row ``doc_id, source, doc_key, doc_key2, size, source_size, target, taken``."""
    sized = cut_lineage(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        *keys(id_col, text_col, source_col), word_count(F.col(text_col)).alias("size")))
    totals = [tuple(r) for r in sized.groupBy("source").agg(F.sum("size")).collect()]
    if not totals:
        return sized.select("*", F.lit(0).cast("long").alias("source_size"), F.lit(0.0).alias("target"),
                            F.lit(0).cast("long").alias("taken"))
    plan = docs.sparkSession.createDataFrame(targets(totals, weights, share, max_epochs),
                                             "plan_source string, source_size long, target double")
    placed = running(sized, "source", "doc_key", ["doc_id", "size"], F.col("size"), "before")
    placed = placed.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    part = F.greatest(F.lit(0), F.least(F.col("size"), budget - epochs * F.col("source_size") - F.col("before")))
    return placed.select("doc_id", "source", "doc_key", "doc_key2", "size", "source_size", "target",
                         (epochs * F.col("size") + part).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, mix: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source") -> DataFrame:
    """The rows of the mix: each document as often as it is taken whole, and the one cut short with its first words.

    Of rows that repeat id, text and source some are taken oftener, at most one in part and the others less often: the
    greatest and the least number and their sum say how many, so a copy's own number says how much it gives.
    """
    take = mix.groupBy("doc_key", "doc_key2").agg(F.first("size").alias("size"), F.max("taken").alias("most"), F.min("taken").alias("least"),
                                                  (F.sum("taken") - F.count("*") * F.min("taken")).alias("more")).where("most > 0")
    keyed = docs.select(F.struct(*docs.columns).alias("row"), *keys(id_col, text_col, source_col))
    copy = F.row_number().over(W.partitionBy("doc_key", "doc_key2").orderBy("doc_key"))
    rows = keyed.withColumn("copy", copy).join(take, ["doc_key", "doc_key2"])
    step = F.col("most") - F.col("least")
    taken = F.col("least") + F.greatest(F.lit(0), F.least(step, F.col("more") - (F.col("copy") - 1) * step))
    rows = rows.select("row", "size", taken.alias("taken")).where("taken > 0")
    turns = F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))
    rows = rows.select("row", "size", "taken", F.explode(turns).alias("turn"))
    left = (F.col("taken") - (F.col("turn") - 1) * F.col("size")).cast("int")
    whole = F.col("row")[text_col]
    words = F.regexp_extract_all(whole, F.lit(f"({WORD})"))
    text = F.when(left >= F.col("size"), whole).otherwise(F.array_join(F.slice(words, 1, F.greatest(left, F.lit(1))), " "))
    return rows.select(*(text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))
