"""First-wins duplicate removal on one key and on two keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentispark.session import cut_lineage

HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 100_000
SALTS = 64


def text_key(text: Column | str) -> Column:
    """A 32-byte digest that stands for the byte-exact text, so shuffles carry no texts."""
    return F.unhex(F.sha2(text, 256))


def dedup_exact_text(df: DataFrame, order: str = "seq", text: str = "raw_text") -> DataFrame:
    """Keep the earliest row of every distinct text.

    The minimum combines on the map side, so a text copied a billion times is
    one row per task; the rows themselves are shuffled by the unique order
    column, never by text.
    """
    first = df.groupBy(text_key(text).alias("_k")).agg(F.min(order).alias(order)).select(order)
    return df.join(first, order, "left_semi")


def _with_value(rows: DataFrame, table: DataFrame, col: str, order: str, n_rows: int, hot_rows: int) -> DataFrame:
    """``rows`` with the one other column of ``table``, which has a row per ``col``; null where it has none.

    Safe against keys that hold much of the data: ``rows`` holds at most ``n_rows`` rows, so keys with ``hot_rows`` rows or
    more are few by arithmetic (n_rows / hot_rows, never over MAX_HOT_KEYS). Their values are broadcast, and their rows pass
    the shuffle under a salt that matches nothing.
    """
    limit = max(hot_rows, n_rows // MAX_HOT_KEYS)
    if n_rows < limit:
        return rows.join(table, col, "left")
    sizes = rows.groupBy(col).agg(F.count("*").alias("_n"))
    if (sizes.agg(F.max("_n")).first()[0] or 0) < limit:
        return rows.join(table, col, "left")
    value = next(c for c in table.columns if c != col)
    hot = (sizes.where(F.col("_n") >= limit).select(col).join(table, col, "left")
           .select(col, F.lit(True).alias("_hot"), F.col(value).alias("_of_hot")))
    marked = rows.join(F.broadcast(hot), col, "left")
    salt = F.when(F.col("_hot"), 1 + F.pmod(F.xxhash64(order), F.lit(SALTS))).otherwise(F.lit(0))
    return (marked.withColumn("_salt", salt.cast("int"))
            .join(table.withColumn("_salt", F.lit(0)), [col, "_salt"], "left")
            .select(*rows.columns, F.coalesce("_of_hot", value).alias(value)))


def without_keys(rows: DataFrame, taken: DataFrame, col: str, order: str, n_rows: int,
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows whose ``col`` is not among ``taken``, safe against keys that hold much of the data."""
    taken = taken.select(col).distinct()
    if n_rows < max(hot_rows, n_rows // MAX_HOT_KEYS):
        return rows.join(taken, col, "left_anti")
    marked = _with_value(rows, taken.withColumn("_taken", F.lit(True)), col, order, n_rows, hot_rows)
    return marked.where("_taken IS NULL").select(*rows.columns)


def _chain_links(undecided: DataFrame, order: str, id_col: str, key_col: str) -> tuple[DataFrame, DataFrame]:
    """``(row, to)`` of rows that are kept exactly if one other row is not, and the rows that are kept outright.

    A row that is the first of one group and the second and last of the other is blocked by that other one's first row and
    by nothing else. A row that is the first of both is kept.
    """
    groups = [undecided.groupBy(own).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))
              for own in (id_col, key_col)]
    firsts = [g.select(F.col("first").alias("row")) for g in groups]
    pairs = [g.where("n = 2").select(F.col("last").alias("row"), F.col("first").alias("to")) for g in groups]
    links = pairs[0].join(firsts[1], "row", "left_semi").unionByName(pairs[1].join(firsts[0], "row", "left_semi"))
    return links, firsts[0].join(firsts[1], "row")


def _drop_behind_firsts(undecided: DataFrame, order: str, id_col: str, key_col: str, n_rows: int, hot_rows: int) -> DataFrame:
    """Rows that are not behind a row of their group which is the first of its other group.

    Such a row is kept, or an earlier one of the group is: either way the group has its one kept row by then.
    """
    first_of = {c: undecided.groupBy(c).agg(F.min(order).alias(order)) for c in (id_col, key_col)}
    out = undecided
    for own, other in ((id_col, key_col), (key_col, id_col)):
        limit = (undecided.join(first_of[other].select(order), order, "left_semi")
                 .groupBy(own).agg(F.min(order).alias("_limit")))
        out = _with_value(out, limit, own, order, n_rows, hot_rows).where(
            F.col("_limit").isNull() | (F.col(order) <= F.col("_limit"))).drop("_limit")
    return out


def _follow_chains(links: DataFrame, kept: DataFrame) -> tuple[DataFrame, int]:
    """``(row, kept)`` of the rows whose chain of links begins at a row of ``kept``, and the doublings this took.

    ``odd`` says whether a row's fate is the opposite of the fate of the row it points to. In each pass every row takes over
    where its target points, so chains halve; a target outside the links is the begin of its chain and has nothing to give.
    """
    now, passes = cut_lineage(links.withColumn("odd", F.lit(True))), 0
    while True:
        ahead = now.select(F.col("row").alias("to"), F.col("to").alias("_to"), F.col("odd").alias("_odd"))
        if not now.join(ahead, "to", "left_semi").take(1):
            break
        now = cut_lineage(now.join(ahead, "to", "left").select(
            "row", F.coalesce("_to", "to").alias("to"), (F.col("odd") != F.coalesce("_odd", F.lit(False))).alias("odd")))
        passes += 1
    return now.join(kept.select(F.col("row").alias("to")), "to", "left_semi").select("row", (~F.col("odd")).alias("kept")), passes


def surviving_orders(keys: DataFrame, order: str, id_col: str, key_col: str, hot_rows: int = HOT_ROWS,
                     trace: list[tuple[int, int]] | None = None) -> DataFrame:
    """Order values of the rows a sequential first-wins pass over two unique keys keeps.

    Each round keeps the rows that are earliest in both of their groups and
    drops whoever shares a key with them; no earlier undecided row can block
    such a row, and no dropped row can come back, so the rounds reach the
    sequential result. Long chains of collisions would take a round a link, so from the second round on a round also drops
    all rows behind one that settles their group either way, and then settles whole chains: a row whose fate is the
    opposite of one other row's points to it, and pointer doubling carries fates along in a number of passes that grows
    with the logarithm of the chain. Only rows with two undecided rivals wait for the next round.

    ``order`` may be of any type that sorts, a struct too. ``trace`` gets rows left and doublings of each round.
    """
    undecided = cut_lineage(keys.select(order, id_col, key_col))
    kept = []
    left = undecided.count()
    chains = False
    while left:
        if chains:
            undecided = cut_lineage(_drop_behind_firsts(undecided, order, id_col, key_col, left, hot_rows))
        links, first = _chain_links(undecided, order, id_col, key_col)
        winners, decided, passes = first.select(F.col("row").alias(order)), None, 0
        if chains:
            found, passes = _follow_chains(links, first)
            decided = cut_lineage(found.unionByName(first.select("row", F.lit(True).alias("kept"))))
            winners = decided.where("kept").select(F.col("row").alias(order))
        winners = cut_lineage(undecided.join(winners, order, "left_semi"))
        kept.append(winners.select(order))
        rest = undecided
        if decided is not None:
            rest = rest.join(decided.where("NOT kept").select(F.col("row").alias(order)), order, "left_anti")
        rest = without_keys(rest, winners, id_col, order, left, hot_rows)
        rest = without_keys(rest, winners, key_col, order, left, hot_rows)
        undecided = cut_lineage(rest)
        if trace is not None:
            trace.append((left, passes))
        left, chains = undecided.count(), True
    if not kept:
        return undecided.select(order)
    out = kept[0]
    for part in kept[1:]:
        out = out.unionByName(part)
    return out


def store_keys(store: DataFrame, id_col: str = "tweet_id", text: str = "raw_text") -> DataFrame:
    """The narrow table a store is probed with: ids and text digests."""
    return store.select(id_col, "_k" if "_k" in store.columns else text_key(text).alias("_k"))


def pair_keys(df: DataFrame, order: str, id_col: str, text: str) -> DataFrame:
    """Narrow rows (order, id, text digest); of equal pairs only the first can survive."""
    return (df.groupBy(id_col, text_key(text).alias("_k")).agg(F.min(order).alias(order))
            .select(order, id_col, "_k"))


def dedup_first_wins(df: DataFrame, order: str = "seq", id_col: str = "tweet_id",
                     text: str = "raw_text", **limits) -> DataFrame:
    """A row stays iff no earlier kept row has its id or its text."""
    survivors = surviving_orders(pair_keys(df, order, id_col, text), order, id_col, "_k", **limits)
    return df.join(survivors, order, "left_semi")
