"""Inputs of the registered queries, and the same inputs in SQL.

Rows always come from the given tables. Word lists and the small lexicon are
parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentispark.functions import text as tx
from sentispark.operators.lexicon_score import with_sentiment
from sentispark.sources.posts import (literal_table, posts_from_conversations, posts_from_documents,
                                      read_table, spread)

# --- parameters ---------------------------------------------------------------
POSITIVE = [("the", 2), ("and", 1), ("la", 3), ("der", 1), ("that", 2), ("de", 2), ("for", 3)]
NEGATIVE = [("of", -3), ("to", -2), ("de", -3), ("en", -1), ("ci", -1), ("was", -3), ("que", -2),
            ("die", -2), ("that", -1)]
STOPWORDS = ("a", "n", "r", "an", "is", "it", "le", "und")
STEMS = [("des", "de"), ("et", "e"), ("are", "be"), ("was", "be"), ("tion", "tio"), ("ch", "c"),
         ("setuju", "tuju"), ("kekhawatiran", "khawatir")]
KEYWORDS = ("Of The", "de la", "und", "the and")
# ------------------------------------------------------------------------------


def lexicon(spark: SparkSession) -> DataFrame:
    return literal_table(spark, "word, weight", POSITIVE + NEGATIVE)


def stem_map(spark: SparkSession) -> DataFrame:
    return literal_table(spark, "word, stem", STEMS)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(posts_from_documents(read_table(spark, sf_dir, "documents")), "tweet_id")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(posts_from_conversations(read_table(spark, sf_dir, "conversations")), "tweet_id")


def noisy_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents dressed as posts: mentions, hashtags, addresses, slang around the whole text."""
    raw = F.concat(F.lit("RT @"), "username", F.lit(": "), "raw_text", F.lit(" yg https://t.co/aB"),
                   "tweet_id", F.lit(" 👍 #"), "keyword", F.lit("_1 xhttp://a.b/c www.x.id/"), "tweet_id",
                   F.lit("\tÉcole a@b.com bgt setuju"))
    return posts(spark, sf_dir).withColumn("raw_text", raw)


def cleaned_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts(spark, sf_dir).withColumn("cleaned_text", tx.clean_text("raw_text"))


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide posts table in mid-work: every fifth row uncleaned, every fifth unlabelled."""
    rows = with_sentiment(cleaned_posts(spark, sf_dir), lexicon(spark))
    state = F.col("seq") % 5
    return (rows.withColumn("cleaned_text", F.when(state != 0, F.col("cleaned_text")))
            .withColumn("sentiment_score", F.when(state != 1, F.col("sentiment_score")).otherwise(F.lit(0)))
            .withColumn("label", F.when(state != 1, F.col("label"))))


def wide_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turns(spark, sf_dir).withColumn("cleaned_text", tx.clean_text("raw_text"))
    return with_sentiment(rows, lexicon(spark))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with human labels; those without one count as neutral."""
    return _gold(spark, sf_dir, "left")


def gold_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those with a label of either class; no other text is cleaned."""
    return _gold(spark, sf_dir, "inner")


def _gold(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("tweet_id"), "quality")
    label = (F.when(F.col("quality") == 1, "positive").when(F.col("quality") == 0, "negative")
             .otherwise("neutral"))
    if how == "inner":
        labels = labels.where("quality IN (0, 1)")
    rows = posts(spark, sf_dir).select("tweet_id", "raw_text").join(labels, "tweet_id", how)
    return rows.select("tweet_id", tx.clean_text("raw_text").alias("cleaned_text"), label.alias("label"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stand-in models over the labelled documents; scores have ties on purpose."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    rows = docs.join(read_table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    c, d = F.col("n_chars"), F.col("doc_id")
    return rows.select(F.inline_outer(F.array(
        F.struct(F.lit("nb").alias("model"), d.alias("id"), F.col("quality").alias("y"),
                 (c % 3 > 0).cast("int").alias("pred"), ((c % 100) / 100.0).alias("score")),
        F.struct(F.lit("svm").alias("model"), d.alias("id"), F.col("quality").alias("y"),
                 (d % 4 > 0).cast("int").alias("pred"), ((d * 37 % 101) / 101.0).alias("score")))))


# --- the same inputs in SQL ---------------------------------------------------

def sql_values(rows) -> str:
    def one(v):
        return "'" + v + "'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(one(v) for v in r) + ")" for r in rows)


def sql_list(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def sql_clean(col: str) -> str:
    ns = r"[^\s\x{1c}-\x{1f}\x{85}\p{Z}]"
    t = f"lower({col})"
    t = rf"regexp_replace({t}, 'https?://{ns}+|www\.{ns}+', '', 'g')"
    t = rf"regexp_replace({t}, '[@#][\p{{L}}\p{{N}}_]+', '', 'g')"
    return f"coalesce(trim(regexp_replace({t}, '[^a-z]+', ' ', 'g')), '')"


def sql_tokens(col: str) -> str:
    return f"list_filter(string_split({col}, ' '), lambda w: w <> '')"


def sql_label(score: str) -> str:
    return f"CASE WHEN {score} > 0 THEN 'positive' WHEN {score} < 0 THEN 'negative' ELSE 'neutral' END"


def _sql_time(n: str) -> str:
    return f"strftime(timestamp '2024-01-01' + to_minutes({n}), '%Y-%m-%dT%H:%M:%S')"


SQL_POSTS = f"""posts AS (SELECT doc_id AS seq, CAST(doc_id AS VARCHAR) AS tweet_id, source AS username,
  {_sql_time('doc_id')} AS created_at, text AS raw_text, lang AS keyword,
  CASE doc_id % 3 WHEN 1 THEN '' WHEN 2 THEN 'https://example.org/p/' || doc_id END AS tweet_url,
  CAST(NULL AS VARCHAR) AS reply_to_id, {_sql_time('doc_id')} AS scraped_at FROM documents)"""

SQL_TURNS = f"""turns AS (SELECT conv_id * 4294967296 + turn AS seq, conv_id || '-' || turn AS tweet_id,
  role AS username, {_sql_time('conv_id * 1000 + turn')} AS created_at, text AS raw_text, 'conv' AS keyword,
  CAST(NULL AS VARCHAR) AS tweet_url,
  CASE WHEN turn > 0 THEN conv_id || '-' || (turn - 1) END AS reply_to_id,
  {_sql_time('conv_id * 1000 + turn')} AS scraped_at FROM conversations)"""

SQL_NOISY = f"""{SQL_POSTS}, noisy AS (SELECT tweet_id, 'RT @' || username || ': ' || raw_text || ' yg https://t.co/aB'
  || tweet_id || ' 👍 #' || keyword || '_1 xhttp://a.b/c www.x.id/' || tweet_id || chr(9)
  || 'École a@b.com bgt setuju' AS raw_text FROM posts)"""

SQL_LEXICON = f"""entries(word, weight) AS (VALUES {sql_values(POSITIVE + NEGATIVE)}),
  lex AS (SELECT word, sum(weight) AS total FROM entries GROUP BY word)"""


def sql_scores(rows: str, name: str = "scores") -> str:
    """CTE (tweet_id, sentiment_score) over a relation with tweet_id and cleaned_text."""
    return f"""{name}_words AS (SELECT tweet_id, unnest({sql_tokens('cleaned_text')}) AS word FROM {rows}),
  {name}_hits AS (SELECT tweet_id, sum(total) AS s FROM {name}_words JOIN lex USING (word) GROUP BY tweet_id),
  {name} AS (SELECT r.tweet_id, CAST(coalesce(h.s, 0) AS BIGINT) AS sentiment_score
    FROM {rows} r LEFT JOIN {name}_hits h ON r.tweet_id = h.tweet_id)"""


SQL_CLEANED = f"{SQL_POSTS}, cleaned AS (SELECT *, {sql_clean('raw_text')} AS cleaned_text FROM posts)"

SQL_WIDE = f"""{SQL_CLEANED}, {SQL_LEXICON}, {sql_scores('cleaned')},
  wide AS (SELECT c.seq, c.tweet_id, username, created_at, raw_text, keyword, tweet_url, reply_to_id, scraped_at,
    CASE WHEN seq % 5 <> 0 THEN cleaned_text END AS cleaned_text,
    CASE WHEN seq % 5 <> 1 THEN sentiment_score ELSE 0 END AS sentiment_score,
    CASE WHEN seq % 5 <> 1 THEN {sql_label('sentiment_score')} END AS label
    FROM cleaned c JOIN scores s ON c.tweet_id = s.tweet_id)"""

SQL_WIDE_TURNS = f"""{SQL_TURNS}, tclean AS (SELECT *, {sql_clean('raw_text')} AS cleaned_text FROM turns),
  {SQL_LEXICON}, {sql_scores('tclean')},
  wide AS (SELECT c.*, sentiment_score, {sql_label('sentiment_score')} AS label
    FROM tclean c JOIN scores s ON c.tweet_id = s.tweet_id)"""

SQL_GOLD = f"""{SQL_CLEANED}, gold_all AS (SELECT tweet_id, cleaned_text,
    CASE quality WHEN 1 THEN 'positive' WHEN 0 THEN 'negative' ELSE 'neutral' END AS label
    FROM cleaned LEFT JOIN labels ON labels.doc_id = cleaned.seq),
  gold AS (SELECT * FROM gold_all WHERE label <> 'neutral')"""

SQL_SPLIT = f"""{SQL_GOLD},
  sizes AS (SELECT label, count(*) AS c, sum(count(*)) OVER () AS n FROM gold GROUP BY label),
  seats AS (SELECT label, c, CAST(n - ceil(0.2 * n) AS BIGINT) AS k, n FROM sizes),
  floors AS (SELECT label, c * k // n AS q, c * k % n AS r, k FROM seats),
  quotas AS (SELECT label, q + CASE WHEN row_number() OVER (ORDER BY r DESC, label) <= k - sum(q) OVER ()
    THEN 1 ELSE 0 END AS quota FROM floors),
  split AS (SELECT g.*, row_number() OVER (PARTITION BY g.label ORDER BY md5(tweet_id || ':42')) <= quota AS is_train
    FROM gold g JOIN quotas USING (label)),
  train AS (SELECT * FROM split WHERE is_train), test AS (SELECT * FROM split WHERE NOT is_train)"""

SQL_SCORED = """base AS (SELECT d.doc_id, n_chars, quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
  scored AS (SELECT 'nb' AS model, doc_id AS id, quality AS y, CAST(n_chars % 3 > 0 AS INT) AS pred,
      (n_chars % 100) / 100.0 AS score FROM base
    UNION ALL SELECT 'svm', doc_id, quality, CAST(doc_id % 4 > 0 AS INT), (doc_id * 37 % 101) / 101.0 FROM base)"""
