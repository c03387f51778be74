"""Repeated passages cut out of texts, found by difference-cover anchors.

Of every document only the runs of ``width - period + 1`` words that begin at places ``p`` with ``p mod period`` in a
difference cover are hashed and exchanged: a quarter of all places for period 21. For any two places there is a shift
below the period that brings both into the cover, so two equal windows share an equal anchor at the same shift, wherever
they stand. Anchors that occur once end there. Around the others the match is extended to whole windows: the hashes of
just those windows that hold a matched anchor are exchanged, and the ones that occur again are repeats. Nothing is
compared pair by pair, so a passage in a million documents costs as much as a million other passages.

The texts are exchanged once, by row key; both passes read that exchange. An anchor or window that is frequent within a
batch is settled there and tells the others by one entry, so that no task gathers a common passage.

Defined results: null texts have no words and stay null; texts under ``width`` words are left alone; rows that repeat,
with or without a null id, are documents of their own, so each repeats the other; an empty table gives an empty result;
other columns pass through, but for columns named like the three new ones, which give way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentispark.llm.shuffles import by_part, over_batches, parts_for
from sentispark.llm.words import groups, mix, pack, range_of, run_hashes, text_slices, tidy, unpack, words
from sentispark.session import cut_lineage, free_unreachable

#: A perfect difference cover: every number below PERIOD is a difference of two of these modulo PERIOD.
PERIOD, COVER = 21, (3, 6, 7, 12, 14)
#: An anchor or window that occurs so often within a batch is settled there.
LOCAL = 16
FLUSH = 400_000
_ENTRIES = "kind int, part int, docs binary, hashes binary, places binary"
_HASHED, _FOUND = 0, 1
_NEW = ("n_words", "n_removed", "kept_text")


def cut_repeats(docs: DataFrame, width: int = 35, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``: the words of no repeated window, joined by one space."""
    if width < PERIOD:
        raise ValueError(f"windows have at least {PERIOD} words")
    parts = parts_for(docs, text_col)
    key = F.xxhash64(*(F.col(f.name) for f in docs.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))))
    text = F.col(text_col).cast("string")
    narrow = docs.select(key.alias("key"), text.alias("text"))
    # both joins name all columns, so that they share one exchange of the texts
    texts = docs.select(key.alias("key"), F.struct(*docs.columns).alias("row"))
    of_row = F.col("row")[text_col].cast("string").alias("text")
    anchors = over_batches(narrow, lambda b: _scatter(b, parts, lambda w, _: _anchors(w, width)), _ENTRIES)
    matched = cut_lineage(_places(_again(anchors, parts), parts))
    del anchors
    free_unreachable(docs.sparkSession)  # all anchors, before the texts are exchanged
    around = over_batches(texts.join(matched, "key").select("key", "row", of_row, "places"),
                          lambda b: _scatter(b, parts, lambda w, batch: _windows(w, batch, width)), _ENTRIES)
    repeats = _places(_again(around, parts), parts)
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    cut = texts.join(repeats, "key", "left").select("row", of_row, "places").mapInArrow(lambda b: _cut(b, width), schema)
    return cut.select(*(F.col("row")[c].alias(c) for c in docs.columns if c not in _NEW), *_NEW)


def _anchors(w, width: int) -> np.ndarray:
    """Words at which an anchor begins, and the anchor's length."""
    size = np.diff(w.first)
    place = np.arange(len(w.hash)) - np.repeat(w.first[:-1], size)
    covered = np.zeros(PERIOD, bool)
    covered[list(COVER)] = True
    length = width - PERIOD + 1
    long_enough = np.repeat(np.where(size >= width, size, 0), size)
    return np.flatnonzero(covered[place % PERIOD] & (place + length <= long_enough)), length


def _windows(w, batch: pa.RecordBatch, width: int) -> np.ndarray:
    """Words at which a window begins that holds a matched anchor."""
    at = []
    for i, raw in enumerate(batch.column("places")):
        places = unpack(raw.as_py(), True, np.int64)
        size = int(w.first[i + 1] - w.first[i])
        edge = np.zeros(size + 2, np.int64)
        np.add.at(edge, np.maximum(places - PERIOD + 1, 0), 1)
        np.add.at(edge, places + 1, -1)
        at.append(np.flatnonzero(np.cumsum(edge)[:max(size - width + 1, 0)]) + w.first[i])
    return np.concatenate(at) if at else np.zeros(0, np.int64), width


def _scatter(batches: Iterator[pa.RecordBatch], parts: int, choose) -> Iterator[list[dict]]:
    for batch in batches:
        kept: list[tuple[np.ndarray, ...]] = []
        for piece in text_slices(batch):
            w = words(piece.column("text"))
            at, length = choose(w, piece)
            if len(at):
                row = np.searchsorted(w.first, at, side="right") - 1
                kept.append((run_hashes(w.hash, w.first, length, at)[0], piece.column("key").to_numpy()[row], at - w.first[row]))
            if sum(len(x[0]) for x in kept) >= FLUSH:
                yield _entry_rows(kept, parts)
                kept = []
        if kept:
            yield _entry_rows(kept, parts)


def _row(kind: int, part: int, at: np.ndarray, docs: np.ndarray, hashes: np.ndarray | None, places: np.ndarray) -> dict:
    return {"kind": kind, "part": part, "docs": pack(docs[at], True), "hashes": None if hashes is None else pack(hashes[at]),
            "places": pack(places[at], True)}


def _entry_rows(kept: list, parts: int) -> list[dict]:
    hashes, docs, places = (np.concatenate([x[i] for x in kept]) for i in range(3))
    order = np.argsort(hashes)
    begin = np.flatnonzero(np.concatenate(([True], hashes[order][1:] != hashes[order][:-1])))
    count = np.diff(np.append(begin, len(order)))
    often = np.zeros(len(hashes), bool)
    often[order] = np.repeat(count >= LOCAL, count)
    told = hashes[order[begin[count >= LOCAL]]]
    rest = [x[~often] for x in (docs, hashes, places)]
    out = [_row(_HASHED, part, at, *rest) for part, at in groups(range_of(rest[1], parts))]
    out += [{"kind": _HASHED, "part": part, "docs": None, "hashes": pack(told[at]), "places": None}
            for part, at in groups(range_of(told, parts))]
    docs, places = docs[often], places[often]
    return out + [_row(_FOUND, part, at, docs, None, places) for part, at in groups(_part_of(docs, parts))]


def _part_of(docs: np.ndarray, parts: int) -> np.ndarray:
    return (mix(docs.view(np.uint64)) % np.uint64(parts)).astype(np.int32)


def _again(entries: DataFrame, parts: int) -> DataFrame:
    """The entries whose hash occurs again, dealt by document."""
    def reduce(_, rows: pa.Table) -> Iterator[dict]:
        docs, hashes, places, named = [], [], [], []
        for kind, d, h, p in zip(rows["kind"].to_pylist(), rows["docs"].to_pylist(), rows["hashes"].to_pylist(), rows["places"].to_pylist()):
            if kind == _FOUND:
                yield from _by_doc(unpack(d, True, np.int64), unpack(p, True, np.int64), parts)
            else:
                hashes.append(unpack(h))
                named.append(np.full(len(hashes[-1]), d is not None))
                docs.append(unpack(d, True, np.int64) if d is not None else np.zeros(len(hashes[-1]), np.int64))
                places.append(unpack(p, True, np.int64) if p is not None else np.zeros(len(hashes[-1]), np.int64))
        if not hashes:
            return
        docs, hashes, places, named = map(np.concatenate, (docs, hashes, places, named))
        order = np.argsort(hashes)
        h = hashes[order]
        begin = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        count = np.diff(np.append(begin, len(h)))
        told = np.bitwise_or.reduceat(~named[order], begin)
        again = np.zeros(len(h), bool)
        again[order] = np.repeat((count > 1) | told, count)
        again &= named
        yield from _by_doc(docs[again], places[again], parts)

    return by_part(entries, reduce, "part int, docs binary, places binary", parts)


def _by_doc(docs: np.ndarray, places: np.ndarray, parts: int) -> Iterator[dict]:
    for part, at in groups(_part_of(docs, parts)):
        at = at[np.lexsort((places[at], docs[at]))]
        yield {"part": part, "docs": pack(docs[at], True), "places": pack(places[at], True)}


def _places(dealt: DataFrame, parts: int) -> DataFrame:
    """One row per document that has any: its places in order."""
    def reduce(_, rows: pa.Table) -> Iterator[dict]:
        docs, places = (np.concatenate([unpack(x, True, np.int64) for x in rows[c].to_pylist()]) for c in ("docs", "places"))
        order = np.lexsort((places, docs))
        docs, places = docs[order], places[order]
        begin = np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1]))) if len(docs) else order
        for b, e in zip(begin.tolist(), [*begin[1:].tolist(), len(docs)]):
            yield {"key": int(docs[b]), "places": pack(places[b:e], True)}

    return by_part(dealt, reduce, "key long, places binary", parts)


@tidy
def _cut(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in text_slices(batch):
            w = words(piece.column("text"))
            keep = np.ones(len(w.hash), bool)
            for i, raw in enumerate(piece.column("places").to_pylist()):
                if raw is not None:
                    places = unpack(raw, True, np.int64)
                    edge = np.zeros(int(w.first[i + 1] - w.first[i]) + 1, np.int64)
                    np.add.at(edge, places, 1)
                    np.add.at(edge, places + width, -1)
                    keep[w.first[i]:w.first[i + 1]] = np.cumsum(edge)[:-1] == 0
            data, ends = _joined(w, keep)
            size = np.diff(w.first)
            removed = size - np.diff(np.concatenate(([0], np.cumsum(keep)))[w.first])
            null = piece.column("text").is_null().to_numpy(zero_copy_only=False)
            kept = pa.array([None if n else data[b:e].tobytes() for n, b, e in zip(null, ends[:-1], ends[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(size), pa.array(removed), kept.cast(pa.string())],
                                             ["row", "n_words", "n_removed", "kept_text"])


def _joined(w, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of all rows, one space between those of a row, and where each row begins."""
    row = w.row[keep]
    start, end = w.start[keep], w.end[keep]
    size = end - start
    size[:-1] += row[1:] == row[:-1]  # the space behind
    stop = np.cumsum(size)
    out = np.full(int(stop[-1]) if len(stop) else 0, 32, np.uint8)
    begin = stop - size
    take = np.repeat(start - begin, end - start)
    place = np.arange(int((end - start).sum())) + np.repeat(begin - np.concatenate(([0], np.cumsum(end - start)[:-1])), end - start) if len(start) else np.zeros(0, np.int64)
    out[place] = w.data[place + take]
    bounds = np.concatenate(([0], stop))[np.searchsorted(row, np.arange(len(w.first)))]
    return out, bounds
