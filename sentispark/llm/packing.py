"""Documents packed into sequences of a fixed number of tokens: configuration linear program and rounding.

Three passes. Texts become pieces of at most ``capacity`` ids, only longer documents are cut. The histogram of piece
lengths, at most ``capacity`` numbers whatever the input, goes to the driver. Lengths are planned in ``CLASSES`` classes of a
grain of 4 tokens, for a capacity of 4096. Four pieces of one length up to ``BUNDLED`` make a bundle, which fills its class;
longer pieces, and fewer than four of a short length, stand alone and count up to the next multiple, so short pieces waste no
room and long ones 1.5 tokens each. The driver
chooses how many sequences follow which configuration (a multiset of classes that fits): multiplicative weights price
the classes, a knapsack by dynamic programming finds the configuration worth most, and the fractional solution is
rounded; what the rounding leaves is packed best fit, longest first. Then every piece finds its sequence by its class
and its rank in it, and the pieces of a sequence are laid end to end.

Ids are written once, as a table in the shared folder, and meet their places in one last join; what is ranked and placed are
narrow rows.

Defined results: null texts are empty and become the end mark alone; repeated rows are documents of their own; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sentispark.llm.order import running
from sentispark.llm.tokens import WordEncoder
from sentispark.llm.words import text_slices, tidy
from sentispark.session import scratch_path

CAPACITY, END = 4096, 1
#: Classes that lengths are planned in, at most, and the length up to which equal pieces make bundles.
CLASSES, BUNDLED = 1024, 512
#: Configurations priced at most, how fast the price of a covered length falls, and the share of a length's pieces that one may cover.
ROUNDS, RATE, STEP = 1500, 4.0, 0.6


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Per piece ``doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset``; ``ids`` as 32-bit little-endian."""
    schema = "doc_id long, doc_key long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("doc_key"),
                       F.col(text_col).cast("string").alias("text"))
    path = scratch_path(docs.sparkSession, "pieces")
    made = rows.mapInArrow(lambda b: _pieces(b, tokenizer, capacity, with_ids), schema)
    made.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    written = docs.sparkSession.read.parquet(path)
    pieces = written.select("row", "doc_id", "doc_key", "piece", "length")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length] = n
    plan = Units.of(counts, max(1, capacity // CLASSES))
    layout = arrange(plan.counts, capacity // plan.grain)
    ranked = running(pieces, "length", "doc_key", ["row"], F.lit(1), "rank")
    placed = ranked.select("row", "length", "rank").mapInArrow(
        lambda b: _place(b, plan, layout), "row long, length long, sequence_id long, slot long")
    before = W.partitionBy("sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    offsets = placed.select("row", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))
    return written.drop("doc_key").join(offsets, "row").drop("row")


@tidy
def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder = WordEncoder(path)
    for batch in batches:
        for rows in text_slices(batch):
            ids, first = encoder.encode(rows.column("text"))
            size = np.diff(first) + 1
            number = -(-size // capacity)
            doc = np.repeat(np.arange(len(size)), number)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
            start = piece * capacity
            length = np.minimum(size[doc] - start, capacity)
            flat = np.insert(ids, first[1:], END).astype("<u4")
            begin = (first[:-1] + np.arange(len(size)))[doc] + start
            parts = [flat[b:b + n].tobytes() for b, n in zip(begin.tolist(), length.tolist())]
            columns = {"doc_id": rows.column("doc_id").take(pa.array(doc)), "doc_key": rows.column("doc_key").take(pa.array(doc)),
                       "piece": pa.array(piece, pa.int32()), "start": pa.array(start), "length": pa.array(length),
                       "ids_crc32": pa.array([zlib.crc32(x) for x in parts], pa.int64())}
            if with_ids:
                columns["ids"] = pa.array(parts, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)


def best_configuration(price: np.ndarray, allowed: np.ndarray, capacity: int) -> list[int]:
    """Lengths, repeats allowed, that fit into ``capacity`` and are worth most, by dynamic programming over the room."""
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    lengths, worth = allowed, price[allowed]
    for room in range(1, capacity + 1):
        n = np.searchsorted(lengths, room, side="right")
        if n:
            value = best[room - lengths[:n]] + worth[:n]
            k = int(value.argmax())
            if value[k] > best[room - 1]:
                best[room], choice[room] = value[k], lengths[k]
                continue
        best[room] = best[room - 1]
    out, room = [], capacity
    while room > 0:
        if choice[room]:
            out.append(int(choice[room]))
            room -= int(choice[room])
        else:
            room -= 1
    return out


def configurations(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[list[int], float]]:
    """A fractional cover of the histogram: configurations and how many sequences follow each."""
    allowed = np.flatnonzero(counts)
    allowed = allowed[allowed <= capacity]
    price, covered = np.zeros(len(counts)), np.zeros(len(counts))
    found: dict[tuple[int, ...], float] = {}
    for _ in range(rounds if len(allowed) else 0):
        price[allowed] = allowed * np.exp(-RATE * covered[allowed] / counts[allowed])
        config = best_configuration(price, allowed, capacity)
        lengths, times = np.unique(config, return_counts=True)
        step = STEP * float((counts[lengths] / times).min())
        covered[lengths] += step * times
        found[tuple(config)] = found.get(tuple(config), 0.0) + step
        if (covered[allowed] >= counts[allowed]).all():
            break
    return [(list(c), x) for c, x in found.items()]


def arrange(counts: np.ndarray, capacity: int) -> dict[str, np.ndarray]:
    """Where the pieces of each class go: runs of ranks, with the first one's sequence and the slot of all."""
    left = counts.copy()
    chosen: list[tuple[list[int], int]] = []
    for config, times in sorted(configurations(counts, capacity), key=lambda x: (-sum(x[0]), -x[1])):
        lengths, each = np.unique(config, return_counts=True)
        n = int(min(np.floor(times + 0.5), (left[lengths] // each).min()))
        if n > 0:
            left[lengths] -= n * each
            chosen.append((config, n))
    chosen += best_fit(left, max(capacity, len(counts) - 1))
    used = np.zeros(len(counts), np.int64)
    runs, base = [], 0
    for config, n in chosen:
        for slot, length in enumerate(config):
            runs.append((length, used[length], base, slot))
            used[length] += n
        base += n
    runs.sort()
    length, rank, sequence, slot = np.array(runs, np.int64).reshape(-1, 4).T
    return {"key": (length << 48) + rank, "rank": rank, "sequence": sequence, "slot": slot}


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Longest first, each piece into the fullest sequence that still has room; equal sequences are kept as one with a count."""
    open_: dict[int, dict[tuple[int, ...], int]] = {}
    rooms: list[int] = []

    def put(config: tuple[int, ...], n: int) -> None:
        room = capacity - sum(config)
        if room not in open_:
            open_[room] = {}
            insort(rooms, room)
        open_[room][config] = open_[room].get(config, 0) + n

    for length in range(len(counts) - 1, 0, -1):
        n = int(counts[length])
        while n:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                if n >= each:
                    put((length,) * each, n // each)
                    n %= each
                else:
                    put((length,) * n, 1)
                    n = 0
                continue
            room = rooms[at]
            config, there = next(iter(open_[room].items()))
            each = min(room // length, n)
            times = min(there, n // each)
            if there > times:
                open_[room][config] = there - times
            else:
                del open_[room][config]
                if not open_[room]:
                    del open_[room], rooms[at]
            put(config + (length,) * each, times)
            n -= each * times
    return [(list(c), n) for room in open_.values() for c, n in room.items()]


class Units(NamedTuple):
    """What is placed as one: bundles of equal short pieces, and single pieces. A class holds the bundles of its length first,
    then the single pieces that count up to it, shorter ones first."""
    grain: int
    counts: np.ndarray  # units by class
    bundled: np.ndarray  # by length: pieces in bundles
    singles: np.ndarray  # by length: where its single pieces begin in their class

    @classmethod
    def of(cls, counts: np.ndarray, grain: int) -> Units:
        length = np.arange(len(counts))
        fits = (length <= BUNDLED) & (length * grain < len(counts))
        bundles = np.where(fits, counts // grain, 0)
        alone = counts - grain * bundles
        of = -(-length // grain)
        units = np.bincount(of, alone, minlength=of[-1] + 1).astype(np.int64)
        units[:len(bundles)] += bundles[:len(units)]
        before = np.cumsum(alone) - alone
        first = np.searchsorted(of, of)  # the shortest length of the same class
        own = np.append(bundles, np.zeros(len(units), np.int64))[of]  # bundles of that class come before
        return cls(grain, units, grain * bundles, own + before - before[first])

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, rank in it and place in the unit of the pieces with these lengths and ranks among those of their length."""
        inside = rank < self.bundled[length]
        return (np.where(inside, length, -(-length // self.grain)),
                np.where(inside, rank // self.grain, self.singles[length] + rank - self.bundled[length]),
                np.where(inside, rank % self.grain, 0))


@tidy
def _place(batches: Iterator[pa.RecordBatch], plan: Units, layout: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kind, rank, place = plan.find(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
        run = np.searchsorted(layout["key"], (kind << 48) + rank, side="right") - 1
        sequence = layout["sequence"][run] + rank - layout["rank"][run]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("length"), pa.array(sequence), pa.array(layout["slot"][run] * plan.grain + place)],
            ["row", "length", "sequence_id", "slot"])
