"""The rank index against plain lists of boundaries, and the forms against a plain rewriting."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

import fixtures
from sentispark.llm import fill_in_middle as fim
from sentispark.llm import queries

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = ["", " ", "one", " one", "one ", "one two\tthree\n\n", "ü é  日本 😀", "x" * 5000 + " y " + "z" * 9000, "a " * 3000,
         "a " * 500 + "w" * 4000 + " b" * 500, "\t\n", "<S", "a\x0bb\x85c"]


def ends(text):
    return [0, *(len(text[:m.end()].encode()) for m in UNIT.finditer(text))]


@pytest.mark.parametrize("texts", [TEXTS, [None, *TEXTS[::-1]], [""], [], [None, None], ["plain words"]])
def test_index_gives_every_boundary(texts):
    offsets, first, data, _ = fim.boundaries(pa.array(texts, pa.string()))
    want = [ends(t or "") for t in texts]
    assert offsets.tolist() == [x for w in want for x in w] and np.diff(first).tolist() == list(map(len, want))
    index = fim.RankIndex.fit(offsets, first)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    rank = np.concatenate([np.arange(len(w)) for w in want]) if texts else np.zeros(0, np.int64)
    assert np.array_equal(index.offset_of(text, rank), offsets)
    assert np.abs(index.predict(text, rank) - offsets).max(initial=0) <= fim.ERROR


def test_wider_bounds_need_fewer_pieces():
    rng = random.Random(1)
    offsets = np.concatenate(([0], np.cumsum([rng.randrange(1, 12) for _ in range(20_000)])))
    knots = []
    for error in (0, 1, 5, 30, 127):
        index = fim.RankIndex.fit(offsets, np.array([0, len(offsets)]), error)
        assert np.abs(index.residual.astype(int)).max() <= error
        assert np.array_equal(index.offset_of(np.zeros(len(offsets), int), np.arange(len(offsets))), offsets)
        knots.append(len(index.rank))
    assert sorted(knots, reverse=True) == knots and knots[-1] < len(offsets) / 200


def plain_form(doc_id, text, seed=42):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_forms_and_way_back(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS * 9)]
    rows += [(None, "no id here"), (5, "again five"), (5, "again five"), (900, "has <P> in it"), (901, "<M>"), (902, "<S> <P"), (903, None)]
    rows += [(1000 + k, "tail <" + "S" * (k % 3) + " end<" * (k % 4) + "M") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS n", "'x' AS form", "2 AS h1", "3 AS h2", "text AS output", "0 AS prefix_chars")
    made = fim.fill_in_middle(docs)
    back = made.select("*", fim.restored(made["output"], made["form"]).alias("restored")).collect()
    got = sorted((str(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in back)
    want = sorted((str(i), *plain_form(i, t), t or "") for i, t in rows)
    key = [tuple(map(str, r)) for r in got], [tuple(map(str, r)) for r in want]
    assert key[0] == key[1] and {r[2] for r in got} == {"plain", "psm", "spm"}


def test_written_index_serves_any_seed(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = fim.rank_index(docs)
    for seed in (1, 42):
        for r in fim.cuts_from_index(index, seed).collect():
            text = rows[r.doc_id][1]
            digest = hashlib.sha256(f"{seed}:{r.doc_id}".encode()).hexdigest()
            at = ends(text)
            low, high = sorted(int(digest[8 * k:8 * k + 8], 16) % len(at) for k in range(2))
            assert (r.n, r.prefix_bytes, r.middle_bytes) == (len(at) - 1, at[low], at[high] - at[low])


def test_rate_and_share(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'a b c d' AS text")
    count = {r.form: r["count"] for r in fim.fill_in_middle(docs, seed=7, rate=90, suffix_first=50).groupBy("form").count().collect()}
    assert abs(count["plain"] - 400) < 100 and abs(count["spm"] - 1800) < 200 and sum(count.values()) == 4000


def test_registered_query(spark, tables):
    got = {r.doc_id: r for r in queries.QUERIES["op11_fill_in_middle"](spark, tables).collect()}
    for i, text, *_ in fixtures.documents():
        n, form, prefix, middle, output = plain_form(i, text)
        r = got[i]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
