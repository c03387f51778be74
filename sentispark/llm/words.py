"""Words of many texts as arrays: where they stand and a 64-bit hash of each, straight from Arrow's buffers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at a time.
SEGMENT = 1 << 18
#: Bytes of text a slice of a batch holds, but for one longer text.
SLICE = 1 << 20

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20_240_229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


class Words(NamedTuple):
    hash: np.ndarray  # uint64
    start: np.ndarray  # byte positions in ``data``
    end: np.ndarray
    first: np.ndarray  # of row i: words first[i] to first[i + 1] - 1
    data: np.ndarray  # uint8

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def release() -> None:
    """What a task has freed goes back to the system; its worker lives on for other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def tidy(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``run``, a generator of a task, with ``release`` at its end."""
    @wraps(run)
    def tidied(*args) -> Iterator:
        try:
            yield from run(*args)
        finally:
            release()

    return tidied


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit number over all of them."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(29)
    return x


def powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


_UP, _DOWN = powers(_BASE, SEGMENT + 1), powers(inverse(_BASE), SEGMENT + 1)


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` bytes of text."""
    ends = _offsets(batch.column(column))[1:]
    at = 0
    while at < len(ends):
        begin = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, begin + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the rows one after another, and the offset of each row; null is empty."""
    ends = _offsets(column)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    raw = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[raw[0]:raw[-1]] if len(column) else np.zeros(0, np.uint8)
    return data, ends


def _offsets(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate(([0], np.cumsum(sizes)))


def words(column: pa.Array, lower: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each row; ``lower`` folds A to Z before hashing."""
    data, ends = text_bytes(column)
    inside = ~_WHITE[data]
    turn = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    cut = ends[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    whole = cut[inside[cut - 1] & inside[cut]] if len(cut) else cut  # two texts meet without white space
    edges = np.concatenate(([0] if len(data) and inside[0] else [], turn, np.unique(whole), np.unique(whole),
                            [len(data)] if len(data) and inside[-1] else [])).astype(np.int64)
    edges.sort()
    start, end = edges[0::2], edges[1::2]
    first = np.searchsorted(start, ends)
    return Words(_hashes(_LOWER[data] if lower else data, start, end), start, end, first, data)


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        begin = start[at]
        to = max(at + 1, int(np.searchsorted(end, begin + SEGMENT, side="right")))
        size = int(end[to - 1] - begin)
        up, down = (_UP, _DOWN) if size <= SEGMENT else (powers(_BASE, size + 1), powers(inverse(_BASE), size + 1))
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE[data[begin:begin + size]] * up[:size], out=total[1:])
        s, e = start[at:to] - begin, end[at:to] - begin
        out[at:to] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return out


def run_hashes(hashes: np.ndarray, first: np.ndarray, n: int, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``n`` words of one row, and the word each begins with; ``at`` names the wanted beginnings."""
    count = len(hashes)
    if at is None:
        last = np.repeat(first[1:], np.diff(first)) - n
        at = np.flatnonzero(np.arange(count) <= last)
    total = np.zeros(count + 1, np.uint64)
    np.cumsum(hashes * powers(_STEP, count), out=total[1:])
    return mix((total[at + n] - total[at]) * powers(inverse(_STEP), count + 1)[at] + np.uint64(n)), at


def whole_hashes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each row's whole word sequence; different from any run's."""
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(_STEP, len(hashes)), out=total[1:])
    size = np.diff(first).astype(np.uint64)
    return mix((total[first[1:]] - total[first[:-1]]) * powers(inverse(_STEP), len(hashes) + 1)[first[:-1]]
               + (size << np.uint64(32)))


def pack(values: np.ndarray, deltas: bool = False) -> bytes:
    """Whole numbers byte plane by byte plane, so that a shuffle's compression finds the equal bytes."""
    x = np.ascontiguousarray(values).view(np.uint64)
    if deltas:
        x = np.diff(x, prepend=np.uint64(0))
    return x.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(raw: bytes, deltas: bool = False, kind: type = np.uint64) -> np.ndarray:
    x = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return (np.cumsum(x) if deltas else x).view(kind)


def groups(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each value of ``part`` with the places that hold it, in order."""
    if not len(part):
        return
    if part.min() >= 0 and part.max() < 1 << 16:
        part = part.astype(np.uint16)  # these are sorted by digits
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for at in np.split(order, cuts):
        yield int(part[at[0]]), at


def range_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The range of the hash order, out of ``parts`` equal ones, that each hash falls into."""
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int32)
