import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from sentispark.operators.lexicon_score import contributions, lexicon_label, lexicon_overlap, with_sentiment
from sentispark.operators import lookup as look
from sentispark.operators.lookup import lookup, replace_words
from sentispark.plans.queries_lexicon import _lines
from sentispark.sources.lexicon import load_lexicon, parse_lexicon, union_lexica
from sentispark.sources.posts import literal_table

LINES = ["word\tweight", "  The \t2", "that\t4", "that\t2", "is\t3.0", "good idea\t5", "\t1", "nan\t 4 "]


def test_loader(spark, tmp_path):
    path = tmp_path / "positive.tsv"
    path.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    got = {r.word: r.weight for r in load_lexicon(spark, str(path)).collect()}
    assert got == {"the": 2, "that": 2, "good idea": 5, "nan": 4}


def test_last_line_wins_across_blocks(spark, tmp_path):
    path = tmp_path / "big.tsv"
    path.write_text("".join(f"w{n % 50}\t{n}\n" for n in range(20_000)), encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = {r.word: r.weight for r in load_lexicon(spark, str(path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {f"w{k}": 19_950 + k for k in range(50)}


def test_scores(spark):
    p = literal_table(spark, "word, weight", [("bagus", 3), ("ya", 1)])
    n = literal_table(spark, "word, weight", [("buruk", -4), ("ya", -2)])
    assert lexicon_overlap(p, n).first().asDict() == {"positive_words": 2, "negative_words": 2, "shared_words": 1}
    rows = spark.createDataFrame([("1", "bagus bagus ya"), ("2", "buruk ya"), ("3", None), ("4", ""), ("5", "lain"),
                                  ("6", "bagus ya ya ya")], "tweet_id string, cleaned_text string")
    words = union_lexica(p, n)
    for limits in ({}, {"max_literal": 0}, {"max_literal": 0, "max_rows": 0}):
        got = {r.tweet_id: (r.sentiment_score, r.label) for r in lexicon_label(rows, words, **limits).collect()}
        assert got == {"1": (5, "positive"), "2": (-5, "negative"), "3": (0, "neutral"), "4": (0, "neutral"),
                       "5": (0, "neutral"), "6": (0, "neutral")}
    parts = {(r.tweet_id, r.word): (r.occurrences, r.weight, r.contribution) for r in contributions(rows, words).collect()}
    assert parts[("1", "bagus")] == (2, 3, 6) and parts[("6", "ya")] == (3, -1, -3)


@pytest.mark.parametrize("limits", [{}, {"max_literal": 0}, {"max_literal": 0, "max_rows": 0}])
def test_scores_depend_on_the_text_alone(spark, limits):
    rows = spark.createDataFrame([("a", "bagus"), ("a", "bagus bagus"), (None, "bagus"), ("b", None), ("c", "")],
                                 "tweet_id string, cleaned_text string")
    lexicon = spark.createDataFrame([("bagus", 2)], "word string, weight int")
    got = sorted((str(r.tweet_id), r.cleaned_text or "", r.sentiment_score) for r in with_sentiment(rows, lexicon, **limits).collect())
    assert got == [("None", "bagus", 2), ("a", "bagus", 2), ("a", "bagus bagus", 4), ("b", "", 0), ("c", "", 0)]
    stems = spark.createDataFrame([("bagus", "baik")], "word string, stem string")
    got = sorted((str(r.tweet_id), r.cleaned_text or "") for r in replace_words(rows, "tweet_id", "cleaned_text", stems, **limits).collect())
    assert got == [("None", "baik"), ("a", "baik"), ("a", "baik baik"), ("b", ""), ("c", "")]


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_lines_are_not_sorted_to_find_the_last(spark, tmp_path):
    (tmp_path / "one.tsv").write_text("".join(line + "\n" for line in LINES), encoding="utf-8")
    plan = plan_of(load_lexicon(spark, str(tmp_path)))
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort" not in plan


def test_odd_weights_and_ends_of_words(spark):
    rows = [(" a　", " +1"), ("b\u0085", "-2 "), (" c \u0085", "3"), ("d e", "99999999999"), ("f", "1e3"), ("g", "3.0"), ("h", "x"), ("i", "--1"),
            (None, "1"), ("  ", "7"), ("J\t", "8"), ("k", None), ("l", "\t9\n")]
    lines = spark.createDataFrame([(w, x, n) for n, (w, x) in enumerate(rows)], "word string, weight string, line long")
    got = {r.word: r.weight for r in parse_lexicon(lines).collect()}
    assert got == {"a": 1, "b\u0085": -2, "c\u0085": 3, "": 7, "j": 8, "l": 9}


def test_word_lines_keep_their_order_without_a_shuffle_of_lines(spark):
    """Equal and missing numbers of texts, any white space, empty texts; an exchange carries texts and no words."""
    texts = [(3, "a\tb  c"), (1, "d\x0be\r\nf "), (3, "x"), (2, None), (None, "n"), (4, ""), (0, "é a b")]
    rows = spark.createDataFrame([(k, t, 5) for k, t in texts], "k long, text string, n long").repartition(3)
    lines = _lines(rows, F.col("k"), F.lit("1"))
    ordered = lines.sortWithinPartitions("line")
    got = [(r.line, r.word.strip(" ")) for r in ordered.collect()]
    want = [(None if k is None else (k << 24) + at, w) for k, t in texts if t for at, w in enumerate(re.findall(r"[^\x20\x09-\x0D]+", t))]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert [x for x, _ in got] == sorted((x for x, _ in want), key=lambda x: -1 if x is None else x)
    above = plan_of(ordered).split("Generate")[-1]
    assert "rangepartitioning(row" in plan_of(ordered) and "rangepartitioning(line" not in above


def test_joined_words_are_not_gathered_by_occurrence(spark, monkeypatch):
    """Only words that change meet the text again; dropped, equal and missing stems, words of one slot and of many."""
    rows = spark.createDataFrame([("a", "x y x " + " ".join(f"w{n}" for n in range(300))), ("b", "x x"), ("c", None), ("d", ""), ("d", "gone gone"),
                                  ("e", "same none x"), (None, "w7 gone w8")], "tweet_id string, cleaned_text string")
    stems = [(f"w{n}", f"v{n}") for n in range(0, 300, 2)] + [("gone", ""), ("same", "same"), ("none", None), ("x", "z"), (None, "q")]
    table = spark.createDataFrame(stems, "word string, stem string")
    to = {w: s for w, s in stems if s is not None}
    want = sorted((str(k), " ".join(to.get(w, w) for w in (t or "").split() if to.get(w, w))) for k, t in map(tuple, rows.collect()))
    for limits in ({}, {"max_literal": 0}, {"max_literal": 0, "max_rows": 0}):
        got = replace_words(rows, "tweet_id", "cleaned_text", table, **limits)
        assert sorted((str(r.tweet_id), r.cleaned_text) for r in got.collect()) == want
    looked_up = []
    monkeypatch.setattr(look, "lookup", lambda r, *a: looked_up.append(r.count()) or lookup(r, *a))
    replace_words(rows.where("tweet_id = 'b'"), "tweet_id", "cleaned_text", table, max_literal=0)
    assert looked_up == [1]
