import random
import re
import unicodedata

import pytest

from sentispark.functions import text as tx
from sentispark.operators.lookup import drop_listed_words, literal_map, replace_words
from sentispark.plans.phases import preprocess, stage_trace
from sentispark.sources.posts import literal_table
from test_plans import plan_of

CASES = [
    (None, ""),
    ("", ""),
    ("Lihat https://t.co/aB1 skrg", "lihat skrg"),
    ("abchttp://x y", "abc y"),
    ("a@b.com", "a com"),
    ("X@andi!", "x"),
    ("#MBG2025 ok", "ok"),
    ("www.x.id/1", ""),
    ("École ÜBER 12", "cole ber"),
    ("a  b\tc\nd e\u0085f\u001cg", "a b c d e f g"),
    ("senang 👍🏽 sekali", "senang sekali"),
    ("@http://x y", "y"),
    ("@ahttp://x b", "b"),
    ("http://a\u0085b", "b"),
    ("Sangat setuju dgn program MBG! 👍 @jokowi", "sangat setuju dgn program mbg"),
]


def twin(text):
    """The cleaning rules in plain Python."""
    t = (text or "").lower()
    for pattern, by in ((r"https?://\S+|www\.\S+", ""), (r"[@#]\w+", ""), (r"[^a-z]+", " ")):
        t = re.sub(pattern, by, t)
    return t.strip(" ")


def cleaned(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    out = rows.select("i", tx.clean_text("t").alias("c")).orderBy("i").collect()
    return [r.c for r in out]


def test_cases(spark):
    assert cleaned(spark, [t for t, _ in CASES]) == [c for _, c in CASES]


def old_enough(ch):
    """Characters both runtimes know: letters added to Unicode lately differ by version."""
    return unicodedata.ucd_3_2_0.category(ch) not in ("Cn", "Cs")


def test_random_unicode_matches_plain_python(spark):
    rng = random.Random(7)
    pool = [chr(c) for c in range(1, 0x3000) if old_enough(chr(c))]
    bits = ["http://", "https://", "www.", "@", "#", " ", "\t", " ", " ", "\u0085", "_", "a", "Z", "9"]
    texts = ["".join(rng.choice(bits) if rng.random() < .5 else rng.choice(pool) for _ in range(rng.randint(0, 25)))
             for _ in range(4000)]
    assert cleaned(spark, texts) == [twin(t) for t in texts]


def texts_of(df):
    return {r.id: r.t for r in df.select("id", "t").collect()}


@pytest.mark.parametrize("limits", [{}, {"max_literal": 0}, {"max_literal": 0, "max_rows": 0}])
def test_replace_words_same_on_every_path(spark, limits):
    df = spark.createDataFrame([("a", "satu dua satu"), ("b", ""), ("c", None), ("d", "tiga"), ("e", "dua")],
                               "id string, t string")
    mapping = literal_table(spark, "word, stem", [("satu", "uno"), ("dua", "")])
    got = {k: v or "" for k, v in texts_of(replace_words(df, "id", "t", mapping, **limits)).items()}
    assert got == {"a": "uno uno", "b": "", "c": "", "d": "tiga", "e": ""}


def test_large_stem_table_stays_in_the_row(spark):
    """200,000 entries: no explode and no shuffle of words, and the same texts as by the join."""
    made = "concat('w', conv(id, 10, 26))"
    mapping = spark.range(200_000).selectExpr(f"{made} AS word", "CASE WHEN id % 5 = 0 THEN '' ELSE concat('s', id % 1000) END AS stem")
    df = spark.range(300).selectExpr("cast(id as string) AS id", "concat_ws(' ', transform(sequence(id * 700, id * 700 + 40, 3), "
                                     "x -> concat('w', conv(x, 10, 26))), 'other') AS t").coalesce(1)
    packed = replace_words(df, "id", "t", mapping)
    plan = plan_of(packed)
    assert not any(word in plan for word in ("Exchange", "Generate", "Join", "Aggregate"))
    joined = texts_of(replace_words(df, "id", "t", mapping, max_literal=0))
    assert texts_of(packed) == joined
    for k in range(285):
        assert joined[str(k)].split() == [f"s{x % 1000}" for x in range(700 * k, 700 * k + 41, 3) if x % 5] + ["other"]


def test_tables_beyond_the_bytes_are_joined(spark):
    mapping = spark.range(6_000).selectExpr("concat(repeat('x', 50), id) AS word", "id AS stem")
    assert literal_map(mapping, "stem", "string", max_bytes=100_000) is None
    assert literal_map(mapping, "stem", "string", max_words=5_999) is None
    assert literal_map(mapping, "stem", "string") is not None


def test_stopword_table_and_list_agree(spark):
    df = spark.createDataFrame([("a", "yang ini yang itu")], "id string, t string")
    table = literal_table(spark, "word", [("yang",)])
    assert texts_of(drop_listed_words(df, "id", "t", table)) == {"a": "ini itu"}
    listed = df.select("id", tx.join_words(tx.without_words(tx.tokens("t"), ["yang"])).alias("t"))
    assert texts_of(listed) == {"a": "ini itu"}


def test_worked_example(spark):
    posts = spark.createDataFrame([("1", CASES[-1][0])], "tweet_id string, raw_text string")
    stems = literal_table(spark, "word, stem", [("setuju", "tuju")])
    assert preprocess(posts, (), stems).first().cleaned_text == "sangat tuju program"
    trace = stage_trace(posts, (), stems).first()
    assert trace.no_custom == "sangat setuju program" and trace.stemmed == "sangat tuju program"


def test_affixed_forms_survive_the_word_list(spark):
    posts = spark.createDataFrame([("1", "makanan makan")], "tweet_id string, raw_text string")
    assert preprocess(posts).first().cleaned_text == "makanan"
