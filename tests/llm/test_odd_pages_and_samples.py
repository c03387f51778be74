"""Pages with broken or unusual markup, and what one long document does to the toxicity sample."""

import random
import time

import pytest

from sentispark.llm import html_extraction as he
from sentispark.llm import mixing, toxicity

A = "The river carries stones from the hills, and over many years it grinds them into sand along the banks of the town."
B = "People walk there in the morning, because the light is bright and the paths are dry for most of the long year."
BODY = f"<h1>Stones and rivers</h1><p>{A}</p><p>{B}</p>"
ARTICLE = f"<article>{BODY}</article>"
TEXT = "\n\n".join(["Stones and rivers", A, B])


def page(inside):
    return f"<html><body><nav><a href='/'>Home</a> <a href='/n'>News</a></nav>{inside}<footer>Copyright</footer></body></html>"


@pytest.mark.parametrize("inside", [
    ARTICLE.replace("<p>", "<svg class='i'/><p>", 1), ARTICLE.replace("<p>", "<button><p>", 1), ARTICLE.replace("<p>", "<noscript/><p>", 1),
    f"<div class='site no-sidebar'>{ARTICLE}</div>", f"<div class='row with-sidebar'>{ARTICLE}</div>", f"<form id='aspnetForm'>{ARTICLE}</form>",
    ARTICLE.replace("<article>", "<article data-hidden>"), ARTICLE.replace("<article>", "<article data-hidden='1'>"),
    f"<article><header class='entry-header'><h1>Stones and rivers</h1></header><p>{A}</p><p>{B}</p></article>",
    ARTICLE.replace("<h1>", "<h1 title=\"a>"), ARTICLE.replace("<p>", "<p title='1 > 0'>", 1),
    f"<div class='content has-sidebar'>{ARTICLE}<div class='sidebar'><a href='/m'>Most read stories</a></div></div>",
    f"<div class='widget'><main>{BODY}</main></div>", ARTICLE + "<!-- <p>no text at all here</p> -->",
    ARTICLE + f"<section class='comments'><article class='comment'><p>{A}</p></article></section>",
    ARTICLE + "<div hidden><p>" + A + "</p></div>", ARTICLE + "<div class='ad-banner'><p>" + B + "</p></div>",
    ARTICLE + "<script>document.write('<p>x</p>')</script>"])
def test_article_of_an_odd_page(inside):
    assert he.main_text(page(inside)) == TEXT


@pytest.mark.parametrize("tail", ["<!-- open comment", "<script>var x = 1", "<a href='x", "<textarea>" + A])
def test_what_a_page_leaves_open(tail):
    assert he.main_text(f"<body>{ARTICLE}{tail}") == TEXT


@pytest.mark.parametrize("part", ["<div>", "<a \"'", "<div class=\"", "<p 'x", "<x y=", "<a \"<b>", "<a '\" ><i>", "<", "<svg>", "</p>"])
def test_hostile_pages_take_time_in_proportion(part):
    start = time.perf_counter()
    he.main_text(part * (200_000 // len(part)) + ">")
    assert time.perf_counter() - start < 20


def said(words, n, rng):
    return " ".join(rng.choice(words) for _ in range(n))


def test_a_long_document_takes_no_room_of_others(spark):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(200)]
    docs = [(k, said(words, 40, rng) + (" grunk zabber" if k % 2 else "")) for k in range(60)]
    docs[6] = (6, said(words, 100_000, rng))
    docs[7] = (7, said(words, 100_000, rng) + " grunk zabber")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k, _ in docs], "id long, label int")
    model = toxicity.fit(df, labels)
    assert model.network is not None
    got = {r.doc_id: r.toxicity for r in toxicity.score(df.where("doc_id NOT IN (6, 7)"), model).collect()}
    pairs = [got[a] > got[b] for a in got for b in got if a % 2 and b % 2 == 0]
    assert sum(pairs) > 0.9 * len(pairs), sorted(got.items())


def test_runs_of_a_long_text_come_from_everywhere(spark):
    n = toxicity.PIECES * toxicity.WINDOW
    df = spark.createDataFrame([(1, n), (2, n + 1), (3, 40 * n), (4, 0)], "id long, n int").selectExpr(
        "id", "CASE WHEN n > 0 THEN transform(sequence(0, n - 1), x -> cast(x as string)) ELSE array() END AS ws")
    got = {r.id: [int(x) for x in r.s] for r in df.select("id", toxicity.sample_of("id", df["ws"]).alias("s")).collect()}
    assert got[1] == list(range(n)) and got[4] == []
    assert n - toxicity.WINDOW < len(got[2]) <= n and len(got[3]) == n
    assert got[3] == sorted(set(got[3])) and got[3][0] < 4 * n and got[3][-1] > 36 * n


def test_rows_of_the_mix_by_source(spark):
    """One id and text in two sources, and rows that repeat all: each source gets its own target."""
    rows = [(1, "a b c d e f g h i", "s1", 1), (1, "a b c d e f g h i", "s2", 2), (5, "k l m", "s2", 3), (5, "k l m", "s2", 4),
            (5, "k l m", "s2", 5), (None, "x y", None, 6), (None, None, "s1", 7), (8, "", "s1", 8), (9, "p q r s", "s3", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _turn int").selectExpr(
        "*", "1 AS doc_key", "2 AS size", "3 AS taken", "4 AS copy", "5 AS _size")
    mix = mixing.mix_sources(df)
    want = {r.source: int(r.target + 0.5) for r in mix.collect()}
    out = mixing.mixed_rows(df, mix)
    assert out.columns == df.columns
    got = {}
    for r in out.collect():
        got[r.source] = got.get(r.source, 0) + len(r.text.split())
    assert got == {s: n for s, n in want.items() if n}


def test_pipeline_keeps_rows_without_an_id(spark, tmp_path):
    """Null ids, repeated rows and an empty table through the stages that decide on documents."""
    import corpus_pipeline

    rng = random.Random(3)
    text = [said(["the", "river", "and", "stone", "garden", "under", "morning", "house", "people", "weather"], 50, rng) for _ in range(6)]
    rows = [(k, text[k], "en", "s", 1) for k in range(4)] + [(None, text[4], "en", "s", 1), (None, text[5], "en", None, 1), (9, text[0], "en", "s", 1),
                                                             (1, text[1], "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    left = stages["ngram_join"](spark, stages["language_id"](spark, docs, ""), "")
    assert sorted((str(r.doc_id), r.text) for r in left.collect()) == sorted(
        [(str(k), text[k]) for k in (0, 1, 1, 2, 3)] + [("None", text[4]), ("None", text[5])])
    cut = stages["substring_dedup"](spark, left, "")
    assert sorted(str(r.doc_id) for r in cut.collect()) == ["0", "2", "3", "None", "None"]  # the two rows of id 1 repeat each other
    assert stages["mixing"](spark, docs.limit(0), "").count() == 0
