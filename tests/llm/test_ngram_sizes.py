"""What the n-gram join and the search for passages exchange and leave on the disk; that no reduction loses a link."""

import gc
import random
import re
import time
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from sentispark.llm import ngram_join, substring_dedup
from sentispark.llm.words import unpack


def varied(rng: random.Random) -> list[tuple[int, str]]:
    """Texts about the threshold: families whose members have some words changed, copies, short and empty ones."""
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.choice([3, 8, 20, 60, 150]))
        for _ in range(rng.randint(1, 6)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows) * 7 - 50, " ".join(words[:rng.choice([len(words), len(words), max(len(words) - 8, 1)])])))
    rows += [(100_000, ""), (100_001, None), (100_002, "  "), rows[3], rows[3], (100_003, rows[5][1])]
    rng.shuffle(rows)
    return rows


def by_hand(rows) -> dict:
    sets = {}
    for doc, text in rows:
        words = (text or "").lower().split()
        sets[doc] = {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()
    component = {doc: doc for doc in sets}
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            old, new = sorted((component[a], component[b]), reverse=True)
            component = {d: new if c == old else c for d, c in component.items()}
    return {d: (len(sets[d]), component[d]) for d in sets}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_by_hand(spark, seed):
    rows = varied(random.Random(seed))
    found = ngram_join.shingle_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len({doc for doc, _ in rows})
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == by_hand(rows)


def test_the_first_look_exchanges_a_third():
    """Only the first third of the order leaves for documents that may have no link at all."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(300)) for _ in range(40)]
    batch = pa.record_batch({"doc_id": pa.array(range(40), pa.int64()), "text": texts})
    sent = sum(len(unpack(row["hashes"])) for rows in ngram_join._scatter(iter([batch]), 5, ngram_join.LOOK) for row in rows
               if row["kind"] != ngram_join._SIZES)
    assert 0.28 < sent / (40 * 296) < 0.39


def test_its_shuffles_go(spark):
    """When the components are known, no shuffle of shingles or sets is kept."""
    def registered() -> int:
        return spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()

    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(3)
    before = registered()
    found = ngram_join.shingle_components(spark.createDataFrame(varied(random.Random(4)), "doc_id long, text string"))
    until = time.time() + 20
    while registered() > before + 8 and time.time() < until:
        time.sleep(0.2)
    assert registered() <= before + 8
    assert found.count()


def test_anchors_are_settled_before_texts_are_exchanged(spark, capsys):
    """What the result still has to do is the second pass: two deals by part, no anchors."""
    cut = substring_dedup.cut_repeats(spark.createDataFrame([(1, "one two"), (2, "a " * 80)], "doc_id long, text string"))
    cut.explain("simple")
    assert len(re.findall(r"FlatMapGroupsInArrow", capsys.readouterr().out)) == 2
    assert {r.doc_id: (r.n_words, r.n_removed) for r in cut.collect()} == {1: (2, 0), 2: (80, 80)}


def test_entries_cost_the_same_in_more_parts():
    """A map task's work follows its entries, and only its rows the number of parts."""
    rng = np.random.default_rng(6)
    kept = [(rng.integers(0, 1 << 63, 400_000, dtype=np.uint64) << np.uint64(1), np.sort(rng.integers(0, 3000, 400_000)))]

    def seconds(parts: int) -> float:
        began = time.process_time()
        rows = ngram_join._entry_rows(kept, parts)
        assert sum(len(unpack(r["hashes"])) for r in rows) == 400_000
        return time.process_time() - began

    few = min(seconds(50) for _ in range(3))
    assert min(seconds(4000) for _ in range(2)) < 20 * few


@pytest.mark.parametrize("limit", [ngram_join.PAIRS, 50])
def test_partial_overlaps_by_hand(monkeypatch, limit):
    """Pairs of any number of holders, also where counts leave before all are in."""
    monkeypatch.setattr(ngram_join, "PAIRS", limit)
    rng = random.Random(7)
    docs = [-5, 3, 40, 41, 1000, 2**40, 2**40 + 1]
    size = {d: rng.choice([30, 36, 60]) for d in docs}
    component = {d: rng.choice([1, 2, 3]) for d in docs}
    holders = {(h << 16): rng.sample(docs, rng.randint(1, len(docs))) for h in range(200)}
    found = [(h, d) for h, some in holders.items() for d in some]
    columns = [np.array(x, np.int64) for x in zip(*((d, h, size[d], component[d]) for h, d in found))]
    cut = len(found) // 2
    rows = pa.Table.from_pylist([ngram_join._labelled_row(0, np.arange(len(found))[s], columns[0], columns[1].view(np.uint64), *columns[2:])
                                 for s in (slice(cut), slice(cut, None))])
    counts: dict = {}
    for row in ngram_join._partial_overlaps(rows, 3):
        one, other = unpack(row["pairs"], True, np.int64).reshape(2, -1).tolist()
        for a, b, n, both in zip(one, other, unpack(row["counts"], False, np.int64).tolist(), unpack(row["limits"], False, np.int64).tolist()):
            assert both == size[a] + size[b]
            counts[a, b] = counts.get((a, b), 0) + n
    wanted: dict = {}
    for some in holders.values():
        for a, b in combinations(sorted(some), 2):
            if component[a] != component[b] and 100 * min(size[a], size[b]) >= 75 * max(size[a], size[b]):
                wanted[a, b] = wanted.get((a, b), 0) + 1
    assert counts == wanted
