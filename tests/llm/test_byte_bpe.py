"""Ids against the tokenizers library, and the recurrence against merges done one by one on a small vocabulary."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import fixtures
from sentispark.llm import byte_bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
CASES = [None, "", " ", "  a", "a  b", "don't we'll I'd 's 'S", "a's's ''s \n's\t't", "x<|endoftext|>y", "<|endoftext|>",
         "<|endoftext|><|endoftext|>  a", " <|endoftext|> ", "<|endof", "text|>", "é'è 're", "'", "'l", "'ll'", "a 'll", "\n\n\nx \n",
         "日本語テキスト。", "x" * 3000, "ab" * 4000, "😀😀👍🏽", "a\u0085b c  d", "Ᲊx \U000105c0", "١٢٣ ½", "\x00\x01", "tab\t\ttab \t "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(texts):
    ids, first = byte_bpe.Encoder(byte_bpe.merges(PATH)).encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(first, first[1:])]


def expected(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_cases(library):
    assert ids_of(CASES) == expected(library, CASES)
    assert ids_of([]) == [] and ids_of([None]) == [[]]


@pytest.mark.parametrize("seed, letters, longest", [
    (1, list("abst'dlrevm  \n\t1２٣!?.é日  <|>ß😀") + ["<|endoftext|>", "'ll", "'s"], 60), (2, list("abcdeth in"), 300),
    (3, list("xy"), 400), (4, [chr(c) for c in range(1, 400)], 80)])
def test_random_texts(library, seed, letters, longest):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, longest))) for _ in range(1500)]
    assert ids_of(texts) == expected(library, texts)


def test_classes_of_characters(library):
    """Where words begin, for every 37th code point and all those newer than Python's tables."""
    import unicodedata

    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    points = points[::37] + [c for c in points if unicodedata.category(chr(c)) == "Cn" and c < 0x20000][::11]
    texts = ["a" + c + "1" + c + "!" + c + " " + c + c + "b " for c in map(chr, points)]
    data, ends = byte_bpe.text_bytes(pa.array(texts))
    start, _ = byte_bpe.Encoder(byte_bpe.merges(PATH)).words(data, ends)
    raw, stop, first = data.tobytes(), np.append(start[1:], len(data)), np.searchsorted(start, ends)
    for i, text in enumerate(texts):
        want = [text[x:y] for _, (x, y) in library.pre_tokenizer.pre_tokenize_str(text)]
        assert [raw[start[j]:stop[j]].decode() for j in range(first[i], first[i + 1])] == want, hex(points[i])


def small_file(tmp_path, merges, extra=()):
    alphabet = {b: c for c, b in byte_bpe.byte_alphabet().items()}
    tokens = [alphabet[b] for b in range(256)] + [a + b for a, b in merges]
    spec = {"normalizer": None, "pre_tokenizer": {"type": "ByteLevel"}, "added_tokens": list(extra),
            "model": {"type": "BPE", "vocab": {t: i for i, t in enumerate(tokens)}, "merges": merges}}
    path = tmp_path / "small.json"
    path.write_text(json.dumps(spec))
    return str(path), {t: i for i, t in enumerate(tokens)}


def merged(word, merges, ids):
    """Always the first of the lowest merges there are."""
    rank = {tuple(m): k for k, m in enumerate(merges)}
    parts = list(word)
    while True:
        found = min(((rank[p], k) for k, p in enumerate(zip(parts, parts[1:])) if p in rank), default=None)
        if found is None:
            return [ids[p] for p in parts]
        k = found[1]
        parts[k:k + 2] = [parts[k] + parts[k + 1]]


def test_against_merges_one_by_one(tmp_path):
    rng = random.Random(5)
    for _ in range(25):
        tokens, merges = list("abc"), []
        while len(merges) < 30:
            a, b = rng.choice(tokens), rng.choice(tokens)
            if a + b not in tokens and len(a + b) < 9:
                tokens.append(a + b)
                merges.append([a, b])
        path, ids = small_file(tmp_path, merges)
        known = byte_bpe.Merges(path)
        words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 30))) for _ in range(200)]
        for some in (words, words[:5]):  # as arrays, and word by word
            raw = np.frombuffer("".join(some).encode(), np.uint8)
            size = np.array(list(map(len, some)))
            flat, count = known.words_to_ids(raw, np.cumsum(size) - size, size)
            got = [x.tolist() for x in np.split(flat, np.cumsum(count)[:-1])]
            assert got == [merged(w, merges, ids) for w in some]


def test_token_that_no_text_reaches(tmp_path):
    merges = [["b", "c"], ["a", "b"], ["ab", "c"]]  # abc becomes a bc
    path, ids = small_file(tmp_path, merges)
    known = byte_bpe.Merges(path)
    assert not known._reachable()[ids["abc"]]
    flat, _ = known.words_to_ids(np.frombuffer(b"abc", np.uint8), np.array([0]), np.array([3]))
    assert flat.tolist() == [ids["a"], ids["bc"]]


def test_files_it_does_not_know(tmp_path):
    for merges, extra in (([["a", "b"], ["b", "c"], ["a", "bc"], ["ab", "c"]], ()), ([["a", "b"]], [
            {"content": "<x>", "id": 300, "single_word": False, "lstrip": True, "rstrip": False}])):
        spec = small_file(tmp_path, merges[:3])[0]
        data = json.loads(open(spec).read())
        data["model"]["merges"], data["added_tokens"] = merges, list(extra)
        open(spec, "w").write(json.dumps(data))
        with pytest.raises(ValueError):
            byte_bpe.Merges(spec)


def test_clash_of_hashes_is_seen(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "_hashes", lambda data, start, end: (end - start).astype(np.uint64))
    texts = ["some words of equal size", "<|endoftext|> size size", "zwei drei vier"]
    assert ids_of(texts) == expected(library, texts)


def test_words_are_forgotten_beyond_the_bound(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KNOWN", 3)
    encoder = byte_bpe.Encoder(byte_bpe.merges(PATH))
    for text in ("a b c d", "d e f", "a b c d"):
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_decoding_any_ids(spark, library):
    known = byte_bpe.vocabulary(PATH)
    rng = random.Random(2)
    lists = [[rng.randrange(50257) for _ in range(30)] for _ in range(300)]
    assert [known.text(np.array(x, np.uint32)) for x in lists] == [library.decode(x, skip_special_tokens=False) for x in lists]
    assert known.text(np.array([60000, 64], np.uint32)) == "a"
    rows = spark.createDataFrame([(1, None, "x", 7), (2, b"", "y", 8), (3, bytes([64, 0, 0, 0]), "z", 9)],
                                 "doc_id long, ids binary, decoded string, n int")
    got = byte_bpe.decode(rows, PATH).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n, r.decoded) for r in got] == [(1, 7, ""), (2, 8, ""), (3, 9, "a")]


def test_null_ids_copies_and_clashing_columns(spark, library):
    rows = [(None, "one two", 1, b"z"), (4, "one two", 2, b"z"), (4, "one two", 2, b"z"), (5, None, 3, None)]
    made = byte_bpe.encode(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids binary"), PATH).collect()
    want = library.encode("one two", add_special_tokens=False).ids
    assert sorted((str(r.doc_id), r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) for r in made) == sorted(
        [("None", len(want), want), ("4", len(want), want), ("4", len(want), want), ("5", 0, [])])


def test_registered_query(spark, tables, library):
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op12_byte_bpe"](spark, tables).collect()}
    docs = [(r[0], r[1] or "") for r in fixtures.documents()]
    assert len(got) == len(docs)
    for (i, text), ids in zip(docs, expected(library, [t for _, t in docs])):
        back = library.decode(ids, skip_special_tokens=False)
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256(back.encode()).hexdigest()) and back == text
