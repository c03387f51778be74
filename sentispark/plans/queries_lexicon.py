"""Lexicon loading and labelling."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentispark.functions.sentiment import label_of
from sentispark.operators.ingest import upsert_label
from sentispark.operators.lexicon_score import contributions, lexicon_label, lexicon_overlap
from sentispark.plans import inputs as ip
from sentispark.plans.catalog import query
from sentispark.plans.phases import run_label
from sentispark.session import scratch_path
from sentispark.sources.lexicon import load_lexicon, union_lexica
from sentispark.sources.posts import read_table

WHITE = "\t\n\x0b\x0c\r"
#: Parts the lines are dealt to, for every split of their table: a text becomes some five times its bytes in sorted lines.
PARTS_A_SPLIT = 16


def _words(text):
    for c in WHITE:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def _lines(rows, number, weight):
    """Every word of every text as a line ``line, word, weight``, in the order of the texts and of the words in them.

    Texts, not lines, go through the exchange, and only numbers of texts are sampled for its ranges. Texts of one number share
    a part, so that sorting the parts orders all lines.
    """
    texts = rows.select(number.alias("row"), "n", "text").repartitionByRange(PARTS_A_SPLIT * rows.rdd.getNumPartitions(), "row")
    words = texts.select("row", "n", F.posexplode_outer(_words(F.col("text"))).alias("at", "w")).where("w IS NOT NULL")
    return words.select((F.shiftleft("row", 24) + F.col("at")).alias("line"),
                        F.concat(F.lit("  "), "w", F.lit(" ")).alias("word"), weight.alias("weight"))


def _document_lines(spark, sf_dir):
    """Lexicon lines made of the documents, with words in blanks and weights that cannot be read among them."""
    k = F.col("row") + F.col("at")
    weight = (F.when(k % 7 == 0, F.lit("3.0")).when(k % 7 == 1, F.lit("weight"))
              .otherwise(F.concat(F.lit(" "), ((F.col("n") + F.col("at")) % 11 - 5).cast("string"), F.lit(" "))))
    return _lines(read_table(spark, sf_dir, "documents").withColumn("n", F.col("n_chars")), F.col("doc_id"), weight)


def _turn_lines(spark, sf_dir):
    weight = (-1 - (F.col("row") + F.col("at")) % 5).cast("string")
    turns = read_table(spark, sf_dir, "conversations").withColumn("n", F.col("turn"))
    return _lines(turns, F.shiftleft("conv_id", 12) + F.col("turn"), weight)


def _as_files(lines, name):
    """The lines as tab-separated files whose names follow their order, in the shared folder."""
    path = scratch_path(lines.sparkSession, name)
    (lines.sortWithinPartitions("line").select("word", "weight").write.option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path, sep="\t"))
    return path


def _lexica(spark, sf_dir):
    return (load_lexicon(spark, _as_files(_document_lines(spark, sf_dir), "positive")),
            load_lexicon(spark, _as_files(_turn_lines(spark, sf_dir), "negative")))


def _sql_lines(name, table, row, weight):
    return rf"""{name}words AS (SELECT row, n, unnest(ws) AS w, unnest(range(len(ws))) AS k FROM (
    SELECT {row} AS row, {table[1]} AS n, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM {table[0]})),
  {name}lines AS (SELECT row * 16777216 + k AS line, '  ' || w || ' ' AS word, {weight} AS weight FROM {name}words),
  {name}lex AS (SELECT word, arg_max(weight, line) AS weight FROM (
    SELECT line, lower(regexp_replace(word, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')) AS word,
      CAST(trim(weight) AS INT) AS weight FROM {name}lines WHERE regexp_full_match(trim(weight), '[+-]?[0-9]+'))
    GROUP BY word)"""


SQL_DOC_LEXICON = _sql_lines("d", ("documents", "n_chars"), "doc_id", """CASE (row + k) % 7 WHEN 0 THEN '3.0'
    WHEN 1 THEN 'weight' ELSE ' ' || ((n + k) % 11 - 5) || ' ' END""")
SQL_TURN_LEXICON = _sql_lines("t", ("conversations", "turn"), "(conv_id * 4096 + turn)", "CAST(-1 - (row + k) % 5 AS VARCHAR)")


@query("lexicon_load", f"WITH {SQL_DOC_LEXICON} SELECT word, weight FROM dlex")
def lexicon_load(spark, sf_dir):
    """Files of all words of the documents, read as a lexicon."""
    return _lexica(spark, sf_dir)[0]


@query("lexicon_union", f"""WITH {SQL_DOC_LEXICON}, {SQL_TURN_LEXICON}
  SELECT 'positive' AS polarity, word, weight FROM dlex UNION ALL SELECT 'negative', word, weight FROM tlex""")
def lexicon_union(spark, sf_dir):
    return union_lexica(*_lexica(spark, sf_dir))


@query("lexicon_overlap", f"""WITH {SQL_DOC_LEXICON}, {SQL_TURN_LEXICON}
  SELECT count(d.word) AS positive_words, count(t.word) AS negative_words,
    count(*) FILTER (d.word IS NOT NULL AND t.word IS NOT NULL) AS shared_words
  FROM dlex d FULL JOIN tlex t ON d.word = t.word""")
def overlap(spark, sf_dir):
    return lexicon_overlap(*_lexica(spark, sf_dir))


SQL_SCORED_DOCS = f"WITH {ip.SQL_CLEANED}, {ip.SQL_LEXICON}, {ip.sql_scores('cleaned')}"


@query("lexicon_score", f"{SQL_SCORED_DOCS} SELECT tweet_id, sentiment_score FROM scores")
def lexicon_score(spark, sf_dir):
    return (lexicon_label(ip.cleaned_posts(spark, sf_dir), ip.lexicon(spark))
            .select("tweet_id", "sentiment_score"))


@query("lexicon_label", f"""WITH {ip.SQL_CLEANED} SELECT tweet_id, {ip.sql_label('length(raw_text) % 7 - 3')} AS label
  FROM cleaned""")
def sign_label(spark, sf_dir):
    """The sign rule by itself, on scores of every sign."""
    score = F.length("raw_text") % 7 - 3
    return ip.posts(spark, sf_dir).select("tweet_id", label_of(score).alias("label"))


SQL_GAPS = f"""{ip.SQL_CLEANED}, gaps AS (SELECT tweet_id,
  CASE seq % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE cleaned_text END AS cleaned_text FROM cleaned)"""


@query("label_empty", f"""WITH {SQL_GAPS}, {ip.SQL_LEXICON}, {ip.sql_scores('gaps')}
  SELECT tweet_id, sentiment_score, {ip.sql_label('sentiment_score')} AS label FROM scores""")
def label_empty(spark, sf_dir):
    gap = F.col("seq") % 4
    rows = ip.cleaned_posts(spark, sf_dir).withColumn(
        "cleaned_text", F.when(gap == 1, F.lit("")).when(gap > 1, F.col("cleaned_text")))
    return lexicon_label(rows, ip.lexicon(spark))


@query("label_run", f"""WITH {ip.SQL_WIDE} SELECT w.tweet_id,
    CASE WHEN w.label IS NULL AND w.cleaned_text IS NOT NULL THEN s.sentiment_score ELSE w.sentiment_score END
      AS sentiment_score,
    CASE WHEN w.label IS NULL AND w.cleaned_text IS NOT NULL THEN {ip.sql_label('s.sentiment_score')}
      ELSE w.label END AS label
  FROM wide w JOIN scores s ON w.tweet_id = s.tweet_id""")
def label_run(spark, sf_dir):
    """The label queue is scored and set by key; everything else keeps its values."""
    table = ip.wide(spark, sf_dir)
    return (upsert_label(table, run_label(table, ip.lexicon(spark)))
            .select("tweet_id", "sentiment_score", "label"))


@query("lexicon_contributions", f"""WITH {ip.SQL_CLEANED}, {ip.SQL_LEXICON},
  words AS (SELECT tweet_id, unnest({ip.sql_tokens('cleaned_text')}) AS word FROM cleaned)
  SELECT tweet_id, word, count(*) AS occurrences, CAST(min(total) AS BIGINT) AS weight,
    CAST(sum(total) AS BIGINT) AS contribution FROM words JOIN lex USING (word) GROUP BY tweet_id, word""")
def lexicon_contributions(spark, sf_dir):
    return contributions(ip.cleaned_posts(spark, sf_dir), ip.lexicon(spark))
