"""Byte-level BPE: whole texts to token ids and back, by dynamic programming over prefixes instead of merges.

The ids of a prefix end in one token that no other choice can replace. Let ``last(p)`` be that token for the first ``p``
bytes of a word. It is the one token t that is a suffix of these bytes and goes with the token before it, the last one of
the first ``p - len(t)`` bytes: no merge that BPE would make earlier reaches across their border. So

* a suffix automaton of the vocabulary (its trie with suffix links) reads a word byte by byte and names the longest token
  that ends there; links lead from each token to the next shorter one that is a suffix of it;
* a pair is tested by taking back the later of the two tokens' last merges again and again: where the two pieces that then
  meet have a merge of a lower rank, BPE would have made it, so the pair cannot stand;
* back-pointers from the end of the word give its ids.

This is linear in the length of a word, however long. Words are those of the tokenizer's own pattern. A task encodes each
distinct word once; all new words of a slice of text go through the recurrence together, as arrays.

A slice's words are known by 64-bit hashes; its ids are decoded again and compared with its bytes, so a clash of two
hashes is seen and the slice is then encoded word by word.

Defined results: null texts are empty and have no ids; the special tokens of the file are found in texts, as the library
does; texts may be of any length; repeated rows are encoded each; null ids of documents stay; an empty table gives an
empty result; other columns are not read. ``decode`` skips ids that the vocabulary does not have and replaces bytes that
are no UTF-8; null ids give an empty text. The library's merges are not used; it is asked for the class of rare characters.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from sentispark.llm.words import _hashes, text_bytes, text_slices, tidy

#: Distinct words whose ids a task keeps, at some 40 bytes each; beyond it a task starts anew.
KNOWN = 500_000
#: Bytes of text taken at a time.
SLICE = 1 << 20
#: With fewer words left than this, the rest of each goes byte by byte through plain Python; the results are the same.
FEW = 24
NONE = 1 << 30
# Fixed values of the byte-level pattern: white space beyond ASCII, and the endings that follow an apostrophe.
SPACES = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
OTHER, LETTER, NUMBER, SPACE = range(4)


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` per row; ``ids`` as little-endian unsigned 32-bit integers."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(merges(tokenizer))
        for batch in batches:
            for part in text_slices(batch, limit=SLICE):
                ids, first = encoder.encode(part.column("text"))
                raw, at = ids.astype("<u4").tobytes(), (4 * first).tolist()
                packed = pa.array([raw[b:e] for b, e in zip(at, at[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(first)), packed], ["doc_id", "n_tokens", "ids"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary")


def decode(encoded: DataFrame, tokenizer: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with the text of their ids as column ``out``, in the place of one of that name."""
    rows = encoded.drop(out)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(tokenizer)
        for batch in batches:
            texts = [known.text(np.frombuffer(raw.as_py() or b"", "<u4")) for raw in batch.column(ids_col)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    return rows.mapInArrow(run, f"{fields}, `{out}` string")


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    """Its size is that of the file; a worker keeps one."""
    return Vocabulary(path)


@lru_cache(maxsize=1)
def merges(path: str) -> Merges:
    """The same; 100 MB or so for 50,000 tokens, so a worker that only decodes does without."""
    return Merges(path)


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in the file: its own where it prints, else one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def character_classes() -> np.ndarray:
    """Class of each code point; the library is asked about those that are newer than Python's tables."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[[*range(9, 14), 32, *SPACES]] = SPACE
    library = ByteLevel(add_prefix_space=False)
    newer = (c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")
    for c in regex.findall(r"[\p{L}\p{N}]", "".join(newer)):
        for beside, kind in (("a", LETTER), ("1", NUMBER)):
            if len(library.pre_tokenize_str(beside + c)) == 1:
                out[ord(c)] = kind
    return out


class Vocabulary:
    """Bytes of the tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self._load(json.load(f))

    def _load(self, spec: dict) -> dict[int, bytes]:
        model, self.special = spec["model"], {}
        if model["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["normalizer"]:
            raise ValueError("not a byte-level BPE without normalizer")
        for added in spec["added_tokens"]:
            if added["single_word"] or added["lstrip"] or added["rstrip"]:
                raise ValueError("added tokens that take neighbours along are not known here")
            self.special[added["content"].encode()] = added["id"]
        alphabet = byte_alphabet()
        raw = {i: bytes(alphabet[c] for c in t) for t, i in model["vocab"].items()}
        self.size = max([*raw, *self.special.values()]) + 1
        both = raw | {i: t for t, i in self.special.items()}
        parts = [both.get(i, b"") for i in range(self.size)]
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)
        self.at = np.array([0, *accumulate(map(len, parts))], np.int64)
        self.length = np.diff(self.at)
        return raw

    def text(self, ids: np.ndarray) -> str:
        return self.raw(ids[ids < self.size].astype(np.int64)).tobytes().decode("utf-8", "replace")

    def raw(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of all tokens, one after another."""
        size = self.length[ids]
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        return self.bytes[np.repeat(self.at[ids] - stop + size, size) + np.arange(total)]


class Merges(Vocabulary):
    """With its merges as arrays by token id, and the suffix automaton of the tokens."""

    def _load(self, spec: dict) -> dict[int, bytes]:
        raw = super()._load(spec)
        self._merges(spec["model"], raw)
        self._automaton({i: raw[i] for i in np.flatnonzero(self._reachable()).tolist()})
        self.classes = character_classes()
        return raw

    def _merges(self, model: dict, raw: dict[int, bytes]) -> None:
        ids = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([ids[p[k]] for p in pairs], np.int64) for k in (0, 1))
        made = np.array([ids[a + b] for a, b in pairs], np.int64)
        if len(np.unique(made)) < len(made):
            raise ValueError("two merges make one token, so a prefix may end in two")
        self.left, self.right, self.rank = (np.full(self.size, -1, np.int64) for _ in range(3))
        self.left[made], self.right[made], self.rank[made] = left, right, np.arange(len(made))
        self.token = np.zeros(self.size, bool)
        self.token[made] = True
        self.token[[i for i, t in raw.items() if len(t) == 1]] = True
        self.made = made
        keys = left * self.size + right
        order = np.argsort(keys)
        self.pair, self.pair_rank = np.append(keys[order], np.iinfo(np.int64).max), np.append(order, NONE)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys))))

    def _reachable(self) -> np.ndarray:
        """Tokens whose own bytes encode to the token alone; another one never occurs in a text."""
        good = self.token.copy()
        good[self.made] = self.compatible(self.left[self.made], self.right[self.made], self.rank[self.made])
        for t in self.made.tolist():
            good[t] &= good[self.left[t]] and good[self.right[t]]
        return good

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether BPE leaves tokens ``a`` and ``b`` side by side, as far as merges of a rank below ``limit`` go."""
        out = np.ones(len(a), bool)
        limit = np.full(len(a), NONE, np.int64) if limit is None else limit
        at = np.arange(len(a))
        while len(at):
            key = a * self.size + b
            place = np.searchsorted(self.pair, key)
            merges = (self.pair[place] == key) & (self.pair_rank[place] < limit)
            out[at[merges]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~merges & ((ra >= 0) | (rb >= 0))
            at, a, b, ra, rb = at[go], a[go], b[go], ra[go], rb[go]
            later = ra > rb
            limit = np.where(later, ra, rb + 1)
            a, b = np.where(later, self.right[a], a), np.where(later, b, self.left[b])
        return out

    @lru_cache(maxsize=1 << 16)
    def compatible_pair(self, a: int, b: int) -> bool:
        limit, ranks, size = NONE, self.rank_of, self.size
        while ranks.get(a * size + b, NONE) >= limit:
            ra, rb = int(self.rank[a]), int(self.rank[b])
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, int(self.right[a])
            else:
                limit, b = rb + 1, int(self.left[b])
        return False

    def _automaton(self, tokens: dict[int, bytes]) -> None:
        child: dict[int, int] = {}
        end, depth = {}, [0]
        for i, t in tokens.items():
            node = 0
            for x in t:
                key = node << 8 | x
                node = child.get(key, 0)
                if not node:
                    node = child[key] = len(depth)
                    depth.append(depth[key >> 8] + 1)
            end[node] = i
        level = np.array(depth)
        edge = np.fromiter(child, np.int64, len(child))
        to = np.fromiter(child.values(), np.int64, len(child))
        parent, byte = np.zeros(len(level), np.int64), np.zeros(len(level), np.int64)
        parent[to], byte[to] = edge >> 8, edge & 255
        here = np.full(len(level), -1, np.int64)
        here[list(end)] = list(end.values())
        link = np.zeros(len(level), np.int64)
        step = np.zeros((len(level), 256), np.int32)
        longest, shorter = here.copy(), np.full(self.size, -1, np.int64)
        for d in range(level.max() + 1):
            nodes = np.flatnonzero(level == d)
            if d > 1:
                link[nodes] = step[link[parent[nodes]], byte[nodes]]
            if d:
                step[nodes] = step[link[nodes]]
                longest[nodes] = np.where(here[nodes] >= 0, here[nodes], longest[link[nodes]])
                own = nodes[here[nodes] >= 0]
                shorter[here[own]] = longest[link[own]]
            below = np.flatnonzero((level == d + 1))
            step[parent[below], byte[below]] = below
        self.step, self.longest, self.shorter = step, longest, shorter

    def words_to_ids(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of ``data``, and how many each has."""
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        at = np.cumsum(size + 1) - size - 1  # of word w: last[at[w] + p] for the prefix of p bytes
        last = np.full(int(size.sum()) + len(size), -1, np.int64)
        state = np.zeros(len(size), np.int64)
        active, p = len(size), 0
        while active >= FEW:
            p += 1
            active = int(np.searchsorted(-size, -p, side="right"))
            state = self.step[state[:active], data[start[:active] + p - 1]].astype(np.int64)
            token = self.longest[state]
            open_ = np.arange(active)
            while len(open_):
                before = last[at[open_] + p - self.length[token]]
                good = before < 0
                inner = np.flatnonzero(~good)
                good[inner] = self.compatible(before[inner], token[inner])
                last[at[open_[good]] + p] = token[good]
                open_, token = open_[~good], self.shorter[token[~good]]
        for w in range(active):
            self._finish(data[start[w]:start[w] + size[w]].tobytes(), p, int(state[w]), last[at[w]:at[w] + size[w] + 1])
        return self._follow(last, at, size, order)

    def _finish(self, word: bytes, done: int, state: int, last: np.ndarray) -> None:
        """Fills ``last`` of one word from the prefix of ``done`` bytes on."""
        known, length, shorter, fits = last.tolist(), self.length, self.shorter, self.compatible_pair
        for p in range(done + 1, len(word) + 1):
            state = int(self.step[state, word[p - 1]])
            token = int(self.longest[state])
            while (before := known[p - int(length[token])]) >= 0 and not fits(before, token):
                token = int(shorter[token])
            known[p] = token
        last[:] = known

    def _follow(self, last: np.ndarray, at: np.ndarray, size: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = np.zeros(len(size), np.int64)
        words, left, steps = np.flatnonzero(size), size[size > 0], []
        while len(words):
            token = last[at[words] + left]
            steps.append((order[words], token))
            count[order[words]] += 1
            left = left - self.length[token]
            words, left = words[left > 0], left[left > 0]
        ids = np.zeros(int(count.sum()), np.uint32)
        place = np.cumsum(count)  # from the end of each word backwards
        for word, token in steps:
            place[word] -= 1
            ids[place[word]] = token
        return ids, count


class Encoder:
    """Ids of texts; remembers the words of its task."""

    def __init__(self, known: Merges):
        self.vocabulary = known
        self.special = re.compile(b"|".join(re.escape(t) for t in sorted(known.special, key=len, reverse=True)) or b"(?!)")
        self._forget()

    def _forget(self) -> None:
        self.hash, self.first, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the place where each text's ids begin."""
        data, ends = text_bytes(texts)
        start, special = self.words(data, ends)
        size = np.diff(np.append(start, len(data)))
        first = np.searchsorted(start, ends)
        plain = np.flatnonzero(special < 0)
        ids, count = self._remembered(data, start[plain], size[plain])
        flat, stop = self._with_special(ids, count, special, plain)
        if not np.array_equal(self.vocabulary.raw(flat.astype(np.int64)), data):  # two words share a hash
            ids, count = self.vocabulary.words_to_ids(data, start[plain], size[plain])
            flat, stop = self._with_special(ids, count, special, plain)
        return flat, stop[first]

    @staticmethod
    def _with_special(ids, count, special, plain) -> tuple[np.ndarray, np.ndarray]:
        each = np.ones(len(special), np.int64)
        each[plain] = count
        stop = np.concatenate(([0], np.cumsum(each)))
        if len(plain) == len(special):
            return ids, stop
        whole = np.zeros(int(stop[-1]), np.uint32)
        marks = np.flatnonzero(special >= 0)
        whole[stop[marks]] = special[marks]
        own = np.ones(len(whole), bool)
        own[stop[marks]] = False
        whole[own] = ids
        return whole, stop

    def _remembered(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distinct, where, inverse = np.unique(_hashes(data, start, start + size), return_index=True, return_inverse=True)
        if len(self.hash) + len(distinct) > KNOWN:
            self._forget()
        at = np.searchsorted(self.hash, distinct)
        new = np.flatnonzero(np.append(self.hash, np.uint64(0))[at] != distinct) if len(self.hash) else np.arange(len(distinct))
        if len(new):
            ids, count = self.vocabulary.words_to_ids(data, start[where[new]], size[where[new]])
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate((self.ids, np.zeros(len(self.ids), np.uint32)))
            self.ids[self.used:self.used + len(ids)] = ids
            begin = self.used + np.cumsum(count) - count
            self.used += len(ids)
            self.hash, self.first, self.count = (np.insert(x, at[new], y) for x, y in (
                (self.hash, distinct[new]), (self.first, begin), (self.count, count)))
            at = np.searchsorted(self.hash, distinct)
        at = at[inverse]
        count = self.count[at]
        stop = np.cumsum(count)
        total = int(stop[-1]) if len(stop) else 0
        return self.ids[np.repeat(self.first[at] - stop + count, count) + np.arange(total)], count

    def words(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word begins, in bytes, and the id of those that are special tokens (-1 for all others).

        A word is a run of letters, of numbers or of other marks, with the one space before it; a short ending after an
        apostrophe; or white space, of which the last character stays with what follows or alone.
        """
        breaks, special = [ends], {}
        for m in self.special.finditer(data.tobytes()):
            if np.searchsorted(ends, m.start(), side="right") == np.searchsorted(ends, m.end() - 1, side="right"):
                special[m.start()] = self.vocabulary.special[m.group()]
                breaks.append(np.array([m.start(), m.end()]))
        fixed = np.unique(np.concatenate(breaks))
        if len(data) and data.max() >= 128:
            points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
            wide = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            begin = np.concatenate(([0], np.cumsum(wide)))
            starts = begin[self._starts(points, np.searchsorted(begin, fixed))]
        else:
            starts = self._starts(data, fixed)
        inside = np.zeros(len(starts), bool)
        out = np.full(len(starts), -1, np.int64)
        if special:
            spans = np.array(sorted(special), np.int64)
            at = np.searchsorted(spans, starts, side="right") - 1
            sizes = np.array([self.vocabulary.length[special[s]] for s in spans.tolist()])
            inside = (at >= 0) & (starts > spans[at]) & (starts < spans[at] + sizes[at])
            exact = (at >= 0) & (starts == spans[at])
            out[exact] = [special[s] for s in starts[exact].tolist()]
        return starts[~inside], out[~inside]

    def _starts(self, points: np.ndarray, fixed: np.ndarray) -> np.ndarray:
        """Word beginnings among code points; at ``fixed`` places a new text begins."""
        n = len(points)
        if not n:
            return np.zeros(0, np.int64)
        kind = self.vocabulary.classes[points]
        begins = np.zeros(n + 1, bool)
        begins[fixed] = True
        hard = begins.copy()
        hard[n] = True
        begins[1:n] |= kind[1:] != kind[:-1]
        begins[n] = True
        white = kind == SPACE
        # the last white character before something else, in one text, is not part of the white space before it
        tail = np.flatnonzero(white[:-1] & ~white[1:] & ~hard[1:n])
        begins[tail] = True
        spaced = tail[points[tail] == 32]
        begins[spaced + 1] = False
        mark = np.flatnonzero((points[:-1] == 39) & begins[:n - 1] & (kind[1:] == LETTER) & ~hard[1:n])
        for ending in ENDINGS:
            size = len(ending)
            at = mark[mark + size < n]
            for k, c in enumerate(ending, 1):
                at = at[(points[at + k] == ord(c)) & ~hard[at + k]]
            begins[at + 1] = False
            begins[at + 1 + size] = True
        return np.flatnonzero(begins[:n])
