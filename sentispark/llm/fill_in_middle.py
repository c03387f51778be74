"""Fill-in-middle examples: texts cut at token boundaries and written prefix, suffix, middle or suffix, prefix, middle.

A token is a word with the white space before it, or the white space at the end of a text. Where the boundaries lie is kept
in a learned rank index, one per document: the function from a boundary's rank to its byte offset is almost straight, so it
is fitted by straight pieces between exact knots, each within ``ERROR`` bytes of every boundary, and one signed byte per
boundary holds what the prediction misses. A cut at rank r finds its piece, predicts the offset in whole numbers and adds
the stored residual, which makes it exact. The index takes about a byte a token; it can be written once (``rank_index``)
and serve any number of seeds and epochs without reading tokens again.

Pieces are fitted to all documents of a slice at once: every piece that misses a boundary by more than ``ERROR`` is halved,
until none does, so the rounds grow with the logarithm of the longest text.

Cuts and form of a document follow from hashes of the seed and its id alone. Cutting and writing the form are SQL functions.

Defined results: null texts are empty; empty texts and those that hold a marker stay plain, without cuts; null ids hash as an
empty string; rows that repeat an id have the same cuts if they have the same text; texts may be of any length; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentispark.llm.words import _WHITE, text_bytes, text_slices, tidy

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes that a prediction may miss a boundary by: what a signed byte holds.
ERROR = 127


class RankIndex:
    """Boundary offsets of many texts: knots ``(rank, offset)`` with straight lines between them, and residuals.

    ``knots[i]`` to ``knots[i + 1] - 1`` are the knots of text i, ``first[i]`` the place of its boundary of rank 0.
    """

    def __init__(self, rank: np.ndarray, offset: np.ndarray, knots: np.ndarray, residual: np.ndarray, first: np.ndarray):
        self.rank, self.offset, self.knots, self.residual, self.first = rank, offset, knots, residual, first

    @classmethod
    def fit(cls, offsets: np.ndarray, first: np.ndarray, error: int = ERROR) -> RankIndex:
        """From boundary offsets of texts one after another; ``first`` has where each begins, and the end.

        Each text has boundary 0, so none is empty. ``error`` is at most 127.
        """
        rank = np.arange(len(offsets)) - np.repeat(first[:-1], np.diff(first))
        left, right = first[:-1], first[1:] - 1  # pieces, as places of their two ends
        done = []
        while len(left):
            size = right - left + 1
            piece = np.repeat(np.arange(len(left)), size)
            begin = np.cumsum(size) - size
            at = np.arange(len(piece)) - begin[piece] + left[piece]
            missed = np.abs(offsets[at] - _between(rank[at], rank[left][piece], rank[right][piece], offsets[left][piece],
                                                   offsets[right][piece]))
            wide = np.maximum.reduceat(missed, begin) > error
            done.append(left[~wide])
            middle = (left[wide] + right[wide]) // 2
            left, right = np.concatenate((left[wide], middle)), np.concatenate((middle, right[wide]))
        place = np.unique(np.concatenate([*done, first[1:] - 1]))
        knots = np.searchsorted(place, first)
        index = cls(rank[place], offsets[place], knots, np.zeros(len(offsets), np.int8), first)
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        index.residual = (offsets - index.predict(text, rank)).astype(np.int8)
        return index

    def predict(self, text: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """About where the boundary of each ``rank`` lies in each ``text``."""
        span = int(self.rank.max(initial=0)) + 1
        key = np.repeat(np.arange(len(self.knots) - 1), np.diff(self.knots)) * span + self.rank
        a = np.searchsorted(key, text * span + rank, side="right") - 1
        b = np.minimum(a + 1, self.knots[text + 1] - 1)
        return _between(rank, self.rank[a], self.rank[b], self.offset[a], self.offset[b])

    def offset_of(self, text: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Exactly where it lies."""
        return self.predict(text, rank) + self.residual[self.first[text] + rank]


def _between(rank, left, right, offset, to) -> np.ndarray:
    """The line through two knots, in whole numbers."""
    return offset + (to - offset) * (rank - left) // np.maximum(right - left, 1)


def boundaries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Boundary offsets of all texts, counted from each text's begin; where each text's start; the bytes and their ends."""
    data, ends = text_bytes(column)
    white = _WHITE[data]
    last = np.zeros(len(data), bool)  # whether a token ends with this byte
    if len(data):
        last[:-1] = ~white[:-1] & white[1:]
        last[ends[1:][np.diff(ends) > 0] - 1] = True
    stop = np.flatnonzero(last) + 1
    count = np.searchsorted(stop, ends, side="right")
    begins = ends[:-1]
    offsets = np.insert(stop, count[:-1], begins)
    first = count + np.arange(len(ends))
    return offsets - np.repeat(begins, np.diff(first)), first, data, ends


def rank_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, n, knot_rank, knot_offset, residual``: the index as a table; offsets count UTF-8 bytes."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                offsets, first, _, _ = boundaries(part.column("text"))
                index = RankIndex.fit(offsets, first)
                raw, at = index.residual.tobytes(), first.tolist()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(first) - 1),
                     *(pa.ListArray.from_arrays(pa.array(index.knots, pa.int32()), pa.array(x, pa.int64())) for x in (index.rank, index.offset)),
                     pa.array([raw[b:e] for b, e in zip(at, at[1:])], pa.binary())],
                    ["doc_id", "n", "knot_rank", "knot_offset", "residual"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n long, knot_rank array<long>, knot_offset array<long>, residual binary")


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32, fixed by seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def cuts(index: RankIndex, n: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where prefix and middle of each text end."""
    ranks = h1 % (n + 1), h2 % (n + 1)
    text = np.arange(len(n))
    return index.offset_of(text, np.minimum(*ranks)), index.offset_of(text, np.maximum(*ranks))


def cuts_from_index(index: DataFrame, seed: int = 42) -> DataFrame:
    """``doc_id, n, prefix_bytes, middle_bytes`` from the table of ``rank_index``, for any seed and without the texts."""
    h1, h2, _, _ = draws(F.col("doc_id"), seed)
    kind = index.schema["doc_id"].dataType.simpleString()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, knots = b.column("n").to_numpy(), b.column("knot_rank")
            at = np.concatenate(([0], np.cumsum(knots.value_lengths().to_numpy())))
            residual = np.frombuffer(b"".join(b.column("residual").to_pylist()), np.int8)
            one = RankIndex(knots.flatten().to_numpy(), b.column("knot_offset").flatten().to_numpy(), at, residual,
                            np.concatenate(([0], np.cumsum(n + 1))))
            low, high = cuts(one, n, b.column("h1").to_numpy(), b.column("h2").to_numpy())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n"), pa.array(low), pa.array(high - low)],
                                             ["doc_id", "n", "prefix_bytes", "middle_bytes"])

    return index.select("*", h1.alias("h1"), h2.alias("h2")).mapInArrow(
        run, f"doc_id {kind}, n long, prefix_bytes long, middle_bytes long")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50,
                   suffix_first: int = 80) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` per row.

    ``rate`` percent of the texts take a form other than ``plain``; ``suffix_first`` percent of these are ``spm``, the rest ``psm``.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    plain = F.col("text") == ""
    for marker in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | F.contains("text", F.lit(marker))
    form = F.when(plain | (h3 % 100 >= rate), "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    drawn = rows.select("*", h1.alias("h1"), h2.alias("h2"), form.alias("form"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    cut = drawn.mapInArrow(_cut, f"doc_id {kind}, text string, form string, n long, prefix_chars long, middle_chars long")
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", _written().alias("output"))


@tidy
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch):
            offsets, first, data, ends = boundaries(part.column("text"))
            n = np.diff(first) - 1
            low, high = cuts(RankIndex.fit(offsets, first), n, part.column("h1").to_numpy(), part.column("h2").to_numpy())
            points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # code points before each byte
            begin = ends[:-1]
            prefix, middle = points[begin + low] - points[begin], points[begin + high] - points[begin + low]
            plain = np.array([f == "plain" for f in part.column("form").to_pylist()], bool)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text"), part.column("form"), pa.array(n), pa.array(prefix, mask=plain),
                 pa.array(middle, mask=plain)], ["doc_id", "text", "form", "n", "prefix_chars", "middle_chars"])


def _written() -> Column:
    text, size, middle = F.col("text"), F.col("prefix_chars").cast("int"), F.col("middle_chars").cast("int")
    prefix = F.substring(text, F.lit(1), size)
    between = F.substring(text, size + 1, middle)
    suffix = F.substring(text, size + middle + 1, F.length(text))
    return (F.when(F.col("form") == "plain", text)
            .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), between))
            .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), between)))


def restored(output: Column, form: Column) -> Column:
    """The text again, from what was written and its form. A marker cannot arise where a text meets one."""
    def sides(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = F.substring(output, F.lit(len(first) + 1), F.length(output))
        later = F.substring_index(rest, second, -1)
        return F.substring_index(rest, second, 1), F.substring_index(later, MIDDLE, 1), F.substring_index(later, MIDDLE, -1)

    prefix, suffix, middle = sides(PREFIX, SUFFIX)
    by_prefix = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = sides(SUFFIX, PREFIX)
    return F.when(form == "plain", output).when(form == "psm", by_prefix).otherwise(F.concat(prefix, middle, suffix))
