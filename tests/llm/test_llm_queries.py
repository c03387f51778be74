"""The registered queries against SQL or a plain rewriting on small tables."""

import math
import re
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
import fixtures
from sentispark.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(spark, name, root):
    return queries.QUERIES[name](spark, root).collect()


def by_sql(name, root):
    with duckdb.connect() as db:
        for t in ("documents", "embeddings", "conversations"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{root}/{t}.parquet'")
        found = db.execute(queries.ORACLES[name])
        return [dict(zip((d[0] for d in found.description), r)) for r in found.fetchall()]


def plain(row, digits=9):
    return tuple(round(v, digits) if isinstance(v, float) else v for _, v in sorted(row.items()))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, tables, name):
    got = sorted(plain(r.asDict()) for r in rows_of(spark, name, tables))
    assert got == sorted(plain(r) for r in by_sql(name, tables)) and got


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_rows(spark, no_rows, name):
    left = rows_of(spark, name, no_rows)
    assert [r.conv_id for r in left] == [-7] if name == "op5_chat_format" else left == []


def test_language_on_held_out_rows(spark, tables):
    truth = {r[0]: r for r in fixtures.documents()}
    found = {r.doc_id: r for r in rows_of(spark, "op2_language_id", tables)}
    assert set(found) == set(truth)
    right = []
    for i, (_, text, lang, _, _) in truth.items():
        r = found[i]
        assert r.held_out == fixtures.held_out(i) and 0 <= r.score <= 1
        if not any(c.isalpha() for c in text or ""):
            assert r.lang_pred == "und"
        elif r.held_out:
            right.append(r.lang_pred == lang)
    assert sum(right) / len(right) >= 0.9


def test_pieces_are_whole_and_close_to_full(spark, tables):
    import public_tokenizers
    from tokenizers import Tokenizer
    import numpy as np
    import zlib

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for i, text, *_ in fixtures.documents():
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            piece = ids[k:k + 4096]
            want[(i, k // 4096)] = (k, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()))
    got = rows_of(spark, "op4_packing", tables)
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= math.ceil(sum(n for _, n, _ in want.values()) / 4096) + 1


def test_mix_meets_its_targets(spark, tables):
    got = rows_of(spark, "op7_mixing", tables)
    docs = {r[0]: r for r in fixtures.documents()}
    size = {i: len(WORD.findall(r[1] or "")) for i, r in docs.items()}
    assert {r.doc_id: r.size for r in got} == size
    totals = Counter()
    for i, r in docs.items():
        totals[r[3]] += size[i]
    names = sorted((s for s in totals if s is not None)) + [None]
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    left, target, free = sum(totals.values()), {}, set(names)
    while True:
        over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) > 3 * totals[s]]
        if not over:
            break
        share = {s: 3 * totals[s] for s in over}
        target.update(share)
        free -= set(over)
        left -= sum(share.values())
    target.update({s: left * weight[s] / sum(weight[x] for x in free) for s in free})
    taken = Counter()
    for r in got:
        s = docs[r.doc_id][3]
        assert r.source_size == totals[s] and r.target == pytest.approx(target[s]) and 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    assert sorted(map(tuple, got)) == sorted(map(tuple, rows_of(spark, "op7_mixing", tables)))


def test_page_text(spark, tables):
    got = {r.page_id: (r.text, r.n_chars) for r in rows_of(spark, "op3_html_extraction", tables)}
    text = "\n\n".join(["Stones & rivers", " ".join(fixtures.FIRST.split()), fixtures.SECOND])
    assert got == {1: (text, len(text)), 2: ("", 0), 3: ("", 0), 4: (text, len(text))}


def test_toxicity_runs_over_every_text(spark, tables):
    got = {r.doc_id: r for r in rows_of(spark, "op6_toxicity", tables)}
    assert set(got) == {r[0] for r in fixtures.documents()}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == fixtures.held_out(r.doc_id)
               for r in got.values())


def test_pipeline_stages(spark, tables):
    """Each stage against a plain rule on what the stage before it kept."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    left, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        left = stage(spark, left, tables).persist()
        assert left.columns == list(corpus_pipeline.COLUMNS)
        seen[name] = left.collect()
    assert {r.doc_id for r in seen["language_id"]} == {
        r[0] for r in fixtures.documents() if any(c.isalpha() for c in r[1] or "")}

    def shingles(text):
        w = WORD.findall(text.lower())
        return {tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))}

    sets = {r.doc_id: shingles(r.text) for r in seen["language_id"]}
    smallest = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    smallest[a] = min(smallest[a], smallest[b])
        if all(smallest[smallest[i]] == smallest[i] for i in smallest):
            break
    assert {r.doc_id for r in seen["ngram_join"]} == set(smallest.values())

    words = {r.doc_id: WORD.findall(r.text) for r in seen["ngram_join"]}
    times = Counter(tuple(w[k:k + 35]) for w in words.values() for k in range(len(w) - 34))
    kept = {}
    for i, w in words.items():
        gone = {j for k in range(len(w) - 34) if times[tuple(w[k:k + 35])] > 1 for j in range(k, k + 35)}
        if len(gone) < len(w):
            kept[i] = [x for j, x in enumerate(w) if j not in gone]
    assert {r.doc_id: WORD.findall(r.text) for r in seen["substring_dedup"]} == kept
    for r in seen["mixing"]:
        w = WORD.findall(r.text)
        assert w == kept[r.doc_id][:len(w)] and w
    packed = corpus_pipeline.STAGES[4][1](spark, left, tables)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in seen["mixing"]}
