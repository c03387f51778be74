"""Language identification, word first with backoff to character n-grams.

A word that the model knows adds its log frequency in every language. An unknown word is looked up by its character
n-grams, the longest first: the first length of which any gram is known decides, with the mean log frequency of its
known grams, lowered by a constant for each step down. The language with the greatest sum wins.

The model is fitted on at most ``SAMPLE`` documents of each language, those with the smallest hash of their id; the
tables keep the ``WORDS`` most frequent words and ``GRAMS`` grams of each length, per language. Scoring covers all texts,
whole. Each distinct word is scored once per worker and batch.

Defined results: null texts and texts without a letter are ``und`` with score 0; so is every text if no document has a
language to learn from; ties go to the first language in code point order; other columns pass through, but for columns
named like the two new ones, which give way.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentispark.llm.words import mix, text_slices, tidy, words

SAMPLE, WORDS, GRAMS = 500, 10_000, 6_000
LENGTHS = (5, 4, 3, 2, 1)
#: Added to a count, and taken from a score for each step to shorter grams.
SMOOTH, STEP = 0.5, 0.5
UNKNOWN = "und"
#: Distinct words whose scores a worker keeps.
MEMORY = 400_000


class Model(NamedTuple):
    langs: list[str]
    tables: dict[int, tuple[np.ndarray, np.ndarray]]  # by gram length, 0 for words: sorted hashes, log frequencies


def fit(docs: DataFrame, lang: Column, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Tables from the rows where ``lang`` is not null."""
    ids = docs.select(F.col(id_col).alias("id"), lang.alias("lang")).where("lang is not null and id is not null")
    first = W.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    sample = ids.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= SAMPLE).select("id", "lang")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "id")
    counts = rows.select("lang", "text").mapInArrow(_count, "lang string, n int, gram string, times long")
    counts = counts.groupBy("lang", "n", "gram").agg(F.sum("times").alias("times"))
    top = W.partitionBy("lang", "n").orderBy(F.col("times").desc(), "gram")
    total = counts.groupBy("lang", "n").agg(F.sum("times").alias("total"))
    kept = counts.withColumn("nth", F.row_number().over(top)).where(F.when(F.col("n") == 0, F.col("nth") <= WORDS).otherwise(F.col("nth") <= GRAMS))
    return _model(kept.select("lang", "n", "gram", "times").toPandas(), {(r["lang"], r["n"]): r["total"] for r in total.collect()})


def normal(word: str) -> str:
    """In lower case, without marks and digits at the ends."""
    word = word.lower()
    a, b = 0, len(word)
    while a < b and not word[a].isalpha():
        a += 1
    while b > a and not word[b - 1].isalpha():
        b -= 1
    return word[a:b]


@tidy
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for word, times in Counter(map(normal, (text or "").split())).items():
                seen[lang, word] += times
    found: Counter = Counter()
    for (lang, word), times in seen.items():
        if word:
            found[lang, 0, word] += times
            marked = f" {word} "
            for n in LENGTHS:
                for i in range(len(marked) - n + 1):
                    found[lang, n, marked[i:i + n]] += times
    if found:
        yield pa.RecordBatch.from_pydict({"lang": [k[0] for k in found], "n": pa.array([k[1] for k in found], pa.int32()),
                                          "gram": [k[2] for k in found], "times": pa.array(list(found.values()), pa.int64())})


def _model(kept, totals: dict) -> Model:
    langs = sorted({x for x, _ in totals}, key=lambda x: x.encode("utf-32-be"))
    tables = {}
    for n in (0, *LENGTHS):
        part = kept[kept["n"] == n]
        hashes = _word_hash(part["gram"].tolist()) if n == 0 else np.concatenate(
            [_gram_hash(np.frombuffer(g.encode("utf-32-le"), np.uint32), n) for g in part["gram"]] or [np.zeros(0, np.uint64)])
        known, at = np.unique(hashes, return_inverse=True)
        times = np.zeros((len(known), len(langs)))
        times[at, [langs.index(x) for x in part["lang"]]] = part["times"]
        total = np.array([totals.get((x, n), 0) for x in langs])
        tables[n] = known, np.log((times + SMOOTH) / (total + SMOOTH * max(len(known), 1))).astype(np.float32)
    return Model(langs, tables)


def _word_hash(normals: list[str]) -> np.ndarray:
    return words(pa.array([f"^{x}" for x in normals], pa.string())).hash


def _gram_hash(points: np.ndarray, n: int) -> np.ndarray:
    h = np.zeros(max(len(points) - n + 1, 0), np.uint64)
    for k in range(n):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + points[k:k + len(h)] + np.uint64(n))
    return h


def _find(table: tuple[np.ndarray, np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """The place of each hash in the table, -1 if it isn't there."""
    at = np.minimum(np.searchsorted(table[0], hashes), max(len(table[0]) - 1, 0))
    return np.where(table[0][at] == hashes, at, -1) if len(table[0]) else np.full(len(hashes), -1)


def word_scores(model: Model, normals: list[str]) -> np.ndarray:
    """Score of each word, none empty, in each language."""
    out = np.zeros((len(normals), len(model.langs)), np.float32)
    at = _find(model.tables[0], _word_hash(normals))
    out[at >= 0] = model.tables[0][1][at[at >= 0]]
    rest = np.flatnonzero(at < 0)
    for step, n in enumerate(LENGTHS, 1):
        if not len(rest):
            break
        text = "".join(f" {normals[i]} " for i in rest)
        size = np.fromiter((len(normals[i]) + 2 for i in rest), np.int64, len(rest))
        of = np.repeat(np.arange(len(rest)), size)
        grams = _gram_hash(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), n)
        inside = of[:len(grams)] == of[n - 1:]
        at = np.where(inside, _find(model.tables[n], grams), -1)
        hit = np.flatnonzero(at >= 0)
        owner = of[hit]
        times = np.bincount(owner, minlength=len(rest))
        done = times > 0
        for k in range(len(model.langs)):
            total = np.bincount(owner, model.tables[n][1][at[hit], k], len(rest))
            out[rest[done], k] = total[done] / times[done] - STEP * step
        rest = rest[~done]
    return out


class _Scorer:
    def __init__(self, model: Model):
        self.model, self.known = model, {}
        self.scores = np.zeros((0, len(model.langs)), np.float32)
        self.letters = np.zeros(0, bool)

    def rows(self, w) -> tuple[np.ndarray, np.ndarray]:
        """Of each word of the batch: the row of ``scores`` and ``letters`` that belongs to it."""
        distinct, where, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > MEMORY:
            self.__init__(self.model)
        at = np.fromiter((self.known.get(h, -1) for h in distinct.tolist()), np.int64, len(distinct))
        new = np.flatnonzero(at < 0)
        if len(new):
            raw = w.data.tobytes()
            normals = [normal(raw[w.start[i]:w.end[i]].decode()) for i in where[new]]
            letters = np.array([bool(x) for x in normals])
            scores = np.zeros((len(new), len(self.model.langs)), np.float32)
            scores[letters] = word_scores(self.model, [x for x in normals if x])
            at[new] = np.arange(len(new)) + len(self.known)
            self.known.update(zip(distinct[new].tolist(), at[new].tolist()))
            self.scores, self.letters = np.concatenate((self.scores, scores)), np.concatenate((self.letters, letters))
        return at[inverse]


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score``, the latter between 0 and 1."""
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("lang_pred", T.StringType()),
                           T.StructField("lang_score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by WORDS, GRAMS and the number of languages

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in batches:
            for piece in text_slices(batch):
                langs, scores = _classify(scorer, piece.column("text"))
                yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(langs, pa.string()), pa.array(scores)],
                                                 ["row", "lang_pred", "lang_score"])

    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).cast("string").alias("text"))
    found = rows.mapInArrow(run, schema)
    return found.select(*(F.col("row")[c].alias(c) for c in docs.columns if c not in ("lang_pred", "lang_score")), "lang_pred", "lang_score")


def _classify(scorer: _Scorer, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    w = words(texts)
    number, langs = len(w.first) - 1, scorer.model.langs
    if not langs:
        return [UNKNOWN] * number, np.zeros(number)
    at = scorer.rows(w)
    lettered = scorer.letters[at]
    row = w.row[lettered]
    total = np.stack([np.bincount(row, scorer.scores[at[lettered], k], number) for k in range(len(langs))], 1)
    count = np.bincount(row, minlength=number)
    best = total.argmax(1)
    gap = (total - total.max(1, keepdims=True)) / np.sqrt(np.maximum(count, 1))[:, None]
    score = np.where(count > 0, 1 / np.exp(gap).sum(1), 0.0)
    return [langs[b] if c else UNKNOWN for b, c in zip(best, count)], score
