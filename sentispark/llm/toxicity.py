"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A text is read in overlapping windows of ``WINDOW`` words that begin every ``STRIDE`` words; all of them are scored. A word
enters as the sum of a word vector and of vectors of its character n-grams; words and n-grams that less
than a share of ``HELD_BY`` of the sample's documents hold have none, so no text is learned by heart, and an inflected or
disguised word still has its letters. Two gated recurrent layers read a window forwards and backwards, attention weighs the
places, and a logistic unit scores the window. A document scores as its most toxic window.

The network is fitted on at most ``SAMPLE`` labelled documents of each label, those with the smallest hash of their id, by
multiple-instance training: a document's label is the label of its most toxic window, and every window of a clean
document is clean. A fifth of the sample is left out and sets the logistic that turns a worst window into a score. Only ids with labels are gathered, and windows are cut on the executors; at most ``TRAINING`` windows of
the two labels train the network.

Defined results: null and empty texts score as a window without words; texts of any length are scored whole; without labels
of both kinds every score is the share of label 1, 0 without any; an id with both labels is toxic; repeated rows are scored alike;
an empty table gives an empty result; other columns pass through, but for one named like the new one, which
gives way.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentispark.llm.words import mix, text_slices, tidy, words

WINDOW, STRIDE = 24, 12
SAMPLE, PIECES = 500, 120
GRAMS, HELD_BY, HELD_LEAST, WIDTH, HIDDEN = (5,), 0.03, 4, 12, 8
EPOCHS, STEPS, BATCH, RATE, DECAY = 4, 400, 512, 0.02, 0.01
#: Distinct words whose gate inputs a worker keeps, and windows scored at a time.
MEMORY, AT_ONCE = 200_000, 2048


class Network(NamedTuple):
    word: np.ndarray
    char: np.ndarray
    gates: np.ndarray  # direction, input, 3 * hidden: update, reset, candidate
    state: np.ndarray  # direction, hidden, 3 * hidden
    bias: np.ndarray  # direction, 3 * hidden
    attend: np.ndarray  # 2 * hidden
    out: np.ndarray  # 2 * hidden + 1


def new_network(word_rows: int, char_rows: int, seed: int = 5) -> Network:
    r = np.random.default_rng(seed)
    f = np.float32
    return Network(np.zeros((word_rows, WIDTH), f), np.zeros((char_rows, WIDTH), f),
                   r.normal(0, 0.3, (2, WIDTH, 3 * HIDDEN)).astype(f), r.normal(0, 0.3, (2, HIDDEN, 3 * HIDDEN)).astype(f),
                   np.zeros((2, 3 * HIDDEN), f), np.zeros(2 * HIDDEN, f), r.normal(0, 0.1, 2 * HIDDEN + 1).astype(f))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + np.float32(0.5)


def bare(word: str) -> str:
    return word.lower().strip(".,!?*%$#&;:\"'()")


def grams_of(words_: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all character n-grams of the words, marked at both ends, and the word each belongs to."""
    text = "".join(f"<{w}>" for w in words_)
    size = np.fromiter((len(w) + 2 for w in words_), np.int64, len(words_))
    owner = np.repeat(np.arange(len(words_)), size)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    found = []
    for n in GRAMS:
        h = np.full(max(len(points) - n + 1, 0), n, np.uint64)
        for k in range(n):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + points[k:k + len(h)])
        inside = owner[:len(h)] == owner[n - 1:]
        found.append((h[inside], owner[:len(h)][inside]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


class Tables(NamedTuple):
    """Rows of the words and n-grams that have a vector; row 0 stands for all others."""
    words: dict[str, int]
    grams: np.ndarray  # sorted; the row is the place, plus 1

    def rows(self, words_: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each bare word its row; rows of all n-grams, and the word each belongs to."""
        grams, owner = grams_of(words_)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1) if len(self.grams) else np.zeros(len(grams), np.int64)
        known = self.grams[at] == grams if len(self.grams) else np.zeros(len(grams), bool)
        return np.fromiter((self.words.get(w, 0) for w in words_), np.int64, len(words_)), at[known] + 1, owner[known]


def tables(texts: list[list[str]]) -> Tables:
    held: Counter = Counter()
    grams: Counter = Counter()
    for ws in texts:
        own = {bare(w) for w in ws}
        held.update(own)
        grams.update(set(grams_of(sorted(own))[0].tolist()))
    least = max(HELD_LEAST, HELD_BY * len(texts))
    kept = sorted(w for w, n in held.items() if n >= least)
    return Tables({w: i + 1 for i, w in enumerate(kept)}, np.array(sorted(g for g, n in grams.items() if n >= least), np.uint64))


def windows(size: int) -> np.ndarray:
    """First words of the windows of a text; the last window holds its last word."""
    return np.arange(0, max(size - WINDOW + STRIDE, 1), STRIDE)


def projections(net: Network, inputs: np.ndarray) -> np.ndarray:
    """What the inputs give to the gates of both directions."""
    return np.stack([inputs @ net.gates[d] + net.bias[d] for d in range(2)])


def run_windows(net: Network, projected: np.ndarray, rows: np.ndarray, keep: bool = False):
    """Scores of windows. ``rows``: of each window and place, the row of ``projected``; -1 where the text has ended."""
    n, length = rows.shape
    there = rows >= 0
    states, kept = np.zeros((2, length, n, HIDDEN), np.float32), []
    for d in range(2):
        h = np.zeros((n, HIDDEN), np.float32)
        for t in range(length) if d == 0 else range(length - 1, -1, -1):
            x, u = projected[d][rows[:, t]], h @ net.state[d]
            gate = _sigmoid(x[:, :2 * HIDDEN] + u[:, :2 * HIDDEN])
            z, r = gate[:, :HIDDEN], gate[:, HIDDEN:]
            c = np.tanh(x[:, 2 * HIDDEN:] + r * u[:, 2 * HIDDEN:])
            new = h + there[:, t, None] * z * (c - h)
            if keep:
                kept.append((d, t, h, z, r, c, u[:, 2 * HIDDEN:]))
            h = states[d, t] = new
    both = np.concatenate((states[0], states[1]), 2).transpose(1, 0, 2)  # window, place, 2 * hidden
    weight = np.where(there, both @ net.attend, -1e9)
    weight = np.exp(weight - weight.max(1, keepdims=True)) * there
    weight /= np.maximum(weight.sum(1, keepdims=True), 1e-9)
    pooled = (weight[:, :, None] * both).sum(1)
    score = _sigmoid(pooled @ net.out[:-1] + net.out[-1])
    return (score, both, weight, pooled, kept) if keep else score


def gradients(net: Network, inputs: np.ndarray, rows: np.ndarray, label: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the mean cross entropy by the name of the parameters, and by the inputs."""
    score, both, weight, pooled, kept = run_windows(net, projections(net, inputs), rows, True)
    there = rows >= 0
    error = (score - label) / len(label)
    grad = {"out": np.append(pooled.T @ error, error.sum()), "gates": np.zeros_like(net.gates), "state": np.zeros_like(net.state),
            "bias": np.zeros_like(net.bias)}
    d_pooled = error[:, None] * net.out[:-1]
    d_weight = (both * d_pooled[:, None]).sum(2)
    d_logit = weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))
    grad["attend"] = np.einsum("np,nph->h", d_logit, both)
    d_both = weight[:, :, None] * d_pooled[:, None] + d_logit[:, :, None] * net.attend
    d_inputs = np.zeros_like(inputs)
    carry = [np.zeros((len(rows), HIDDEN), np.float32) for _ in range(2)]
    for d, t, h, z, r, c, uc in reversed(kept):
        dh = (carry[d] + d_both[:, t, d * HIDDEN:(d + 1) * HIDDEN])
        on = there[:, t, None]
        dc = dh * z * on * (1 - c * c)
        dz = dh * (c - h) * on * z * (1 - z)
        dr = dc * uc * r * (1 - r)
        dx = np.concatenate((dz, dr, dc), 1)
        du = np.concatenate((dz, dr, dc * r), 1)
        grad["state"][d] += h.T @ du
        grad["bias"][d] += dx.sum(0)
        x = inputs[rows[:, t]] * on
        grad["gates"][d] += x.T @ dx
        np.add.at(d_inputs, rows[:, t], (dx @ net.gates[d].T) * on)
        carry[d] = dh * (1 - z * on) + du @ net.state[d].T
    return grad, d_inputs


def word_inputs(net: Network, word: np.ndarray, grams: np.ndarray, owner: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.maximum(np.bincount(owner, minlength=len(word)), 1)).astype(np.float32)
    char = np.stack([np.bincount(owner, net.char[grams, k], len(word)) for k in range(WIDTH)], 1).astype(np.float32)
    return net.word[word] + char / size[:, None]


def train(texts: list[list[str]], labels: np.ndarray) -> tuple[Network, Tables]:
    """Fits the network on documents given as words: windows of clean ones, and the most toxic ones of the others."""
    table = tables(texts)
    net = new_network(len(table.words) + 1, len(table.grams) + 1)
    vocabulary: dict[str, int] = {}
    rows, of = [], []
    for i, ws in enumerate(texts):
        at = [vocabulary.setdefault(bare(w), len(vocabulary)) for w in ws]
        for b in windows(len(at)):
            rows.append((at[b:b + WINDOW] + [-1] * WINDOW)[:WINDOW])
            of.append(i)
    rows, of = np.array(rows), np.array(of)
    vocabulary = vocabulary or {"": 0}
    word, grams, owner = table.rows(list(vocabulary))
    r = np.random.default_rng(11)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net._asdict().items()}
    step = 0
    label = labels[of].astype(np.float32)
    each = max(1, 2 * int((label == 0).sum()) // BATCH)
    for epoch in range(max(EPOCHS, -(-STEPS // each))):  # few documents are gone through more often
        if epoch:  # of a toxic document, the windows that are not its worst and look clean are not held against the network
            ready = projections(net, word_inputs(net, word, grams, owner))
            found = np.concatenate([run_windows(net, ready, rows[a:a + AT_ONCE]) for a in range(0, len(rows), AT_ONCE)])
            worst = np.zeros(len(texts), np.float32)
            np.maximum.at(worst, of, found)
            used = np.flatnonzero((label == 0) | (found >= np.maximum(0.5 * worst[of], 0.3)) | (found == worst[of]))
        else:
            used = np.arange(len(rows))
        clean, toxic = used[label[used] == 0], used[label[used] == 1]
        for clean_part in np.array_split(r.permutation(clean), each):
            some = np.concatenate((clean_part, r.choice(toxic, min(len(toxic), BATCH // 2), replace=False)))
            own, place = np.unique(rows[some], return_inverse=True)
            place = place.reshape(len(some), WINDOW)
            if own[0] < 0:
                own, place = own[1:], place - 1
            number = np.full(len(word), -1)
            number[own] = np.arange(len(own))
            here = number[owner] >= 0
            part, part_owner = grams[here], number[owner[here]]
            grad, d_inputs = gradients(net, word_inputs(net, word[own], part, part_owner), place, label[some])
            grad["word"], grad["char"] = np.zeros_like(net.word), np.zeros_like(net.char)
            np.add.at(grad["word"], word[own], d_inputs)
            share = d_inputs / np.sqrt(np.maximum(np.bincount(part_owner, minlength=len(own)), 1))[:, None]
            np.add.at(grad["char"], part, share[part_owner])
            grad["word"][0] = grad["char"][0] = 0
            step += 1
            for k, g in grad.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                value = getattr(net, k)
                value -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
                if k in ("word", "char"):
                    value *= 1 - DECAY
    return net, table


class Model(NamedTuple):
    network: Network | None
    tables: Tables | None
    share: float
    #: Calibration: a document's score is the logistic of ``slope * logit + shift`` of its worst window.
    slope: float
    shift: float


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """``labels``: ``id, label`` of the rows to learn from."""
    known = labels.where("label is not null and id is not null").groupBy("id").agg(F.max("label").alias("label"))
    # the smallest hashes of a label, by each task first: no task sorts a label
    first = [known.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(SAMPLE) for k in (0, 1)]
    sample = first[0].unionByName(first[1])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "id")
    words_of = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"))
    got = rows.select("id", "label", words_of.alias("words")).select("id", "label", sample_of("id", F.col("words")).alias("words"))
    found = sorted(got.distinct().collect(), key=lambda r: (r["id"], r["words"]))
    return fit_texts([r["words"] for r in found], np.array([r["label"] for r in found], np.float32))


def sample_of(id_col: str, ws: Column) -> Column:
    """All words of a text, or ``PIECES`` runs of ``WINDOW`` words of a longer one, in their order."""
    runs = F.ceil(F.size(ws) / WINDOW).cast("int")
    named = F.transform(F.sequence(F.lit(0), F.greatest(runs - 1, F.lit(0))), lambda k: F.struct(F.xxhash64(F.col(id_col), k).alias("h"), k.alias("k")))
    chosen = F.array_sort(F.transform(F.slice(F.array_sort(named), 1, PIECES), lambda x: x["k"]))
    return F.when(runs <= PIECES, ws).otherwise(F.flatten(F.transform(chosen, lambda k: F.slice(ws, k * WINDOW + 1, WINDOW))))


def fit_texts(texts: list[list[str]], label: np.ndarray) -> Model:
    if len(set(label.tolist())) < 2:
        return Model(None, None, float(label.mean()) if len(label) else 0.0, 1.0, 0.0)
    left_out = np.zeros(len(label), bool)
    for kind in (0, 1):
        left_out[np.flatnonzero(label == kind)[4::5]] = True
    network, table = train([t for t, out in zip(texts, left_out) if not out], label[~left_out])
    check = left_out if len(set(label[left_out].tolist())) == 2 else ~left_out
    logit = _Scorer(network, table).documents(pa.array([" ".join(t) for t, c in zip(texts, check) if c], pa.string()))
    return Model(network, table, float(label.mean()), *_logistic(logit, label[check]))


def _logistic(x: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make the logistic of ``x`` fit the labels, both alike in weight, by Newton steps with a small penalty."""
    a, b = 1.0, 0.0
    weight = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w, off = np.maximum(p * (1 - p), 1e-6) * weight, (p - label) * weight
        g = np.array([(off * x).sum() + 0.1 * (a - 1), off.sum() + 0.1 * b])
        h = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -2, 2))
    return max(a, 1e-3), b


class _Scorer:
    """Scores texts; each distinct word's inputs are made once."""

    def __init__(self, network: Network, table: Tables):
        self.network, self.table, self.known = network, table, {}
        self.ready, self.used = np.zeros((2, 4096, 3 * HIDDEN), np.float32), 0

    def rows(self, w) -> np.ndarray:
        distinct, where, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > MEMORY:
            self.__init__(self.network, self.table)
        at = np.fromiter((self.known.get(h, -1) for h in distinct.tolist()), np.int64, len(distinct))
        new = np.flatnonzero(at < 0)
        if len(new):
            raw = w.data.tobytes()
            found = self.table.rows([bare(raw[w.start[i]:w.end[i]].decode()) for i in where[new]])
            at[new] = np.arange(len(new)) + self.used
            self.known.update(zip(distinct[new].tolist(), at[new].tolist()))
            if self.used + len(new) > self.ready.shape[1]:
                more = max(2 * self.ready.shape[1], self.used + len(new)) - self.ready.shape[1]
                self.ready = np.concatenate((self.ready, np.zeros((2, more, 3 * HIDDEN), np.float32)), 1)
            self.ready[:, self.used:self.used + len(new)] = projections(self.network, word_inputs(self.network, *found))
            self.used += len(new)
        return at[inverse]

    def documents(self, texts: pa.Array) -> np.ndarray:
        """The logit of each text's most toxic window."""
        w = words(texts)
        at = np.append(self.rows(w), -1) if len(w.hash) else np.array([-1])
        size = np.diff(w.first)
        number = np.maximum(-(-(size - WINDOW) // STRIDE) + 1, 1)
        doc = np.repeat(np.arange(len(size)), number)
        begin = (np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)) * STRIDE
        worst = np.zeros(len(size), np.float32)
        for a in range(0, len(doc), AT_ONCE):
            some = slice(a, a + AT_ONCE)
            place = w.first[doc[some], None] + begin[some, None] + np.arange(WINDOW)
            rows = np.where(place < w.first[doc[some] + 1][:, None], at[np.minimum(place, len(at) - 1)], -1)
            np.maximum.at(worst, doc[some], run_windows(self.network, self.ready, rows))
        worst = np.clip(worst, 1e-6, 1 - 1e-6).astype(np.float64)
        return np.log(worst / (1 - worst))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``toxicity``, between 0 and 1."""
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("toxicity", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by the table sizes above

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        scorer = _Scorer(m.network, m.tables) if m.network is not None else None
        for batch in batches:
            for piece in text_slices(batch):
                found = np.full(piece.num_rows, m.share)
                if scorer is not None and piece.num_rows:
                    found = 1 / (1 + np.exp(-(m.slope * scorer.documents(piece.column("text")) + m.shift)))
                yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(found, pa.float64())], ["row", "toxicity"])

    found = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
    return found.select(*(F.col("row")[c].alias(c) for c in docs.columns if c != "toxicity"), "toxicity")
