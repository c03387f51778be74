"""Token ids of whole texts, each distinct word encoded once per task."""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from sentispark.llm.words import words

#: Distinct words whose ids a task keeps, at some 40 bytes each; beyond it starts anew.
MEMORY = 600_000
_TRAILING = np.zeros(256, bool)
_TRAILING[list(b".,!?*%$#&;:")] = True
_LETTER = np.zeros(256, bool)
_LETTER[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123))] = True


class WordEncoder:
    """Ids of texts for a vocabulary that never joins across white space, as the word BPE here.

    A text is cut at white space, and between a letter or digit and the marks that end a word. Neither cut lies inside
    a unit that the tokenizer forms, so the ids of the text are those of its pieces in order; a test compares them.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self._forget()

    def _forget(self) -> None:
        self.hash, self.first, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(4096, np.uint32), 0

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the place where each text's ids begin."""
        w = _cut_marks(words(texts))
        distinct, where, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
        if len(self.hash) + len(distinct) > MEMORY:
            self._forget()
        at = np.searchsorted(self.hash, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.hash)
        known[inside] = self.hash[at[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        if len(new):
            raw = w.data.tobytes()
            found = self.tokenizer.encode_batch_fast([raw[w.start[i]:w.end[i]].decode() for i in where[new]], add_special_tokens=False)
            self._add(distinct[new], at[new], [e.ids for e in found])
            at = np.searchsorted(self.hash, distinct)
        at = at[inverse]
        size = self.size[at]
        stop = np.concatenate(([0], np.cumsum(size)))
        take = np.repeat(self.first[at] - stop[:-1], size) + np.arange(stop[-1])
        return self.ids[take], stop[w.first]

    def _add(self, hashes: np.ndarray, at: np.ndarray, ids: list[list[int]]) -> None:
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for i in ids for x in i), np.uint32, int(size.sum()))
        self.ids = _room(self.ids, self.used + len(flat))
        self.ids[self.used:self.used + len(flat)] = flat
        begin = self.used + np.cumsum(size) - size
        self.used += len(flat)
        self.hash, self.first, self.size = (np.insert(x, at, y) for x, y in ((self.hash, hashes), (self.first, begin), (self.size, size)))


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    """Its size is that of the file; a worker keeps it. A task has one core, so its batches need no threads of their own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


def _room(x: np.ndarray, size: int) -> np.ndarray:
    return x if len(x) >= size else np.concatenate((x, np.zeros(max(size, 2 * len(x)) - len(x), x.dtype)))


def _cut_marks(w):
    """Words cut before the marks at their end, where a letter or digit stands before those; first letters in lower case."""
    from sentispark.llm.words import _hashes

    data = w.data.copy()
    stop = w.end.copy()
    at = np.arange(len(stop))
    while len(at):  # as often as the longest run of marks
        at = at[(stop[at] - 1 > w.start[at])]
        at = at[_TRAILING[data[stop[at] - 1]]]
        stop[at] -= 1
    last, before = data[stop - 1], data[np.maximum(stop - 2, 0)]
    accented = (before == 0xC3) & (last >= 0x80) & (last <= 0xBF) & (last != 0x97) & (last != 0xB7) & (stop - 2 >= w.start)
    stop = np.where(_LETTER[last] | accented, stop, w.end)
    first = data[w.start] if len(w.start) else np.zeros(0, np.uint8)
    upper = (first >= 65) & (first <= 90)
    data[w.start[upper]] += 32
    cut = stop < w.end
    start, end = np.concatenate((w.start, stop[cut])), np.concatenate((stop, w.end[cut]))
    order = np.argsort(start, kind="stable")
    start, end = start[order], end[order]
    extra = np.concatenate(([0], np.cumsum(cut)))
    return type(w)(_hashes(data, start, end), start, end, w.first + extra[w.first], data)
