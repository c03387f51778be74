"""Ingest integrity, duplicate removal, upserts and incremental runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentispark.functions.sentiment import label_of
from sentispark.functions.text import CUSTOM_STOPWORDS
from sentispark.operators import ingest as ing
from sentispark.operators.dedup import dedup_exact_text, dedup_first_wins
from sentispark.operators.keyed_table import create, read, upsert
from sentispark.operators.keystore import KeyStore, add_keys
from sentispark.plans import inputs as ip
from sentispark.plans.catalog import query
from sentispark.plans.phases import preprocess, run_clean
from sentispark.session import scratch_path
from sentispark.sources.posts import posts_from_documents, read_table, read_table_stream
from sentispark.streaming import incremental as inc

P = f"WITH {ip.SQL_POSTS} "
SEARCH_LIMIT = 20

SQL_HITS = f"""kws(keyword_pos, kw) AS (VALUES {ip.sql_values(list(enumerate(ip.KEYWORDS)))}),
  hits AS (SELECT keyword_pos, kw AS keyword, seq, tweet_id, raw_text, created_at FROM posts
    JOIN kws ON contains(lower(raw_text), lower(kw)))"""


@query("keyword_latest_topn", f"""WITH {ip.SQL_POSTS}, {SQL_HITS} SELECT keyword, tweet_id, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY keyword_pos ORDER BY created_at DESC, seq) AS INT) AS rank FROM hits)
  WHERE rank <= {SEARCH_LIMIT}""")
def keyword_latest_topn(spark, sf_dir):
    return (ing.keyword_latest(ip.posts(spark, sf_dir), ip.KEYWORDS, SEARCH_LIMIT)
            .select("keyword", "tweet_id", "rank"))


@query("constraint_filter", P + """SELECT tweet_id, username, label FROM (SELECT seq, tweet_id, keyword,
    CASE WHEN seq % 17 <> 0 THEN username END AS username,
    CASE WHEN seq % 19 <> 0 THEN raw_text END AS raw_text,
    CASE seq % 5 WHEN 0 THEN NULL WHEN 1 THEN 'positive' WHEN 2 THEN 'negative' WHEN 3 THEN 'neutral'
      ELSE 'happy' END AS label FROM posts)
  WHERE username IS NOT NULL AND raw_text IS NOT NULL AND (label IS NULL OR label <> 'happy')""")
def constraint_filter(spark, sf_dir):
    s = F.col("seq")
    label = (F.when(s % 5 == 1, "positive").when(s % 5 == 2, "negative").when(s % 5 == 3, "neutral")
             .when(s % 5 == 4, "happy"))
    rows = (ip.posts(spark, sf_dir).withColumn("username", F.when(s % 17 != 0, F.col("username")))
            .withColumn("raw_text", F.when(s % 19 != 0, F.col("raw_text"))).withColumn("label", label))
    return ing.valid_posts(rows).select("tweet_id", "username", "label")


@query("dedup_exact_text", P + "SELECT min(seq) AS seq, CAST(min(seq) AS VARCHAR) AS tweet_id FROM posts GROUP BY raw_text")
def exact_text(spark, sf_dir):
    return dedup_exact_text(ip.posts(spark, sf_dir)).select("seq", "tweet_id")


def _colliding(spark, sf_dir) -> DataFrame:
    """Posts whose ids come in pairs, so that both keys collide and collisions chain."""
    return ip.posts(spark, sf_dir).withColumn("tweet_id", F.expr("cast(seq div 2 AS string)"))


def sql_walk(feed: str) -> str:
    """The sequential rule itself: one row after the other against the kept ids and texts."""
    return f"""WITH RECURSIVE {ip.SQL_POSTS}, feed AS ({feed}),
  walk AS (SELECT CAST(0 AS BIGINT) AS rn, []::VARCHAR[] AS ids, []::VARCHAR[] AS keys,
      CAST(NULL AS BIGINT) AS seq, false AS kept
    UNION ALL SELECT f.rn,
      CASE WHEN f.free THEN list_append(f.ids, f.tweet_id) ELSE f.ids END,
      CASE WHEN f.free THEN list_append(f.keys, f.k) ELSE f.keys END, f.seq, f.free
    FROM (SELECT n.*, w.ids, w.keys,
        NOT list_contains(w.ids, n.tweet_id) AND NOT list_contains(w.keys, n.k) AS free
      FROM walk w JOIN feed n ON n.rn = w.rn + 1) f)"""


@query("dedup_two_key_first_wins", sql_walk("""SELECT seq, CAST(seq // 2 AS VARCHAR) AS tweet_id, md5(raw_text) AS k,
  row_number() OVER (ORDER BY seq) AS rn FROM posts""") + " SELECT seq FROM walk WHERE kept")
def two_key(spark, sf_dir):
    return dedup_first_wins(_colliding(spark, sf_dir)).select("seq")


@query("incremental_insert", sql_walk("""SELECT seq, CAST(seq // 2 AS VARCHAR) AS tweet_id, md5(raw_text) AS k,
  row_number() OVER (ORDER BY seq % 3 <> 0, seq) AS rn FROM posts""")
       + " SELECT seq FROM walk WHERE kept AND seq % 3 <> 0")
def incremental_insert(spark, sf_dir):
    """A third of the posts is stored first, its keys by hash prefix; the rest arrives as one batch."""
    rows = _colliding(spark, sf_dir)
    keys = KeyStore(scratch_path(spark, "keys"))
    add_keys(keys, dedup_first_wins(rows.where("seq % 3 = 0")), 0)
    return ing.insert_new(keys, rows.where("seq % 3 <> 0"), before=1).select("seq")


@query("insert_counts", f"""WITH {ip.SQL_POSTS}, {SQL_HITS}, first AS (SELECT keyword, row_number() OVER (
    PARTITION BY raw_text ORDER BY keyword_pos, seq) AS rn FROM hits)
  SELECT keyword, count(*) AS inserted FROM first WHERE rn = 1 GROUP BY ROLLUP (keyword)""")
def insert_counts(spark, sf_dir):
    return ing.insert_counts(ing.with_matched_keyword(ip.posts(spark, sf_dir), ip.KEYWORDS))


_LINK = "'https://x.com/' || username || '/status/' || tweet_id"


@query("url_derive", P + f"SELECT tweet_id, coalesce(nullif(tweet_url, ''), {_LINK}) AS tweet_url FROM posts")
def url_derive(spark, sf_dir):
    return ing.with_url(ip.posts(spark, sf_dir)).select("tweet_id", "tweet_url")


@query("url_backfill", P + f"SELECT tweet_id, coalesce(tweet_url, {_LINK}) AS tweet_url FROM posts")
def url_backfill(spark, sf_dir):
    return ing.backfill_url(ip.posts(spark, sf_dir)).select("tweet_id", "tweet_url")


@query("schema_evolve", P + """SELECT tweet_id, username, keyword, CAST(NULL AS VARCHAR) AS tweet_url,
  CAST(NULL AS VARCHAR) AS reply_to_id FROM posts""")
def schema_evolve(spark, sf_dir):
    old = ip.posts(spark, sf_dir).drop("tweet_url", "reply_to_id")
    return ing.evolve_schema(old).select("tweet_id", "username", "keyword", "tweet_url", "reply_to_id")


_LISTED = ip.sql_list(sorted({*ip.STOPWORDS, *CUSTOM_STOPWORDS}))
SQL_CLEAN_RUN = (f"array_to_string(list_filter({ip.sql_tokens(ip.sql_clean('w.raw_text'))}, "
                 f"lambda t: t NOT IN {_LISTED}), ' ')")


@query("upsert_clean", f"""WITH {ip.SQL_WIDE} SELECT tweet_id,
  CASE WHEN cleaned_text IS NULL THEN {SQL_CLEAN_RUN} ELSE cleaned_text END AS cleaned_text FROM wide w""")
def upsert_clean(spark, sf_dir):
    """The clean queue is worked off and set by key, in a table laid out by key."""
    table = create(ip.wide(spark, sf_dir).select("tweet_id", "raw_text", "cleaned_text"), scratch_path(spark, "posts"))
    upsert(table, run_clean(read(spark, table), ip.STOPWORDS), ["cleaned_text"])
    return read(spark, table).select("tweet_id", "cleaned_text")


@query("upsert_label", f"""WITH {ip.SQL_WIDE} SELECT w.tweet_id,
    CASE WHEN w.seq % 2 = 0 THEN w.seq % 9 - 4 ELSE w.sentiment_score END AS sentiment_score,
    CASE WHEN w.seq % 2 = 0 THEN {ip.sql_label('(w.seq % 9 - 4)')} ELSE w.label END AS label FROM wide w""")
def upsert_label(spark, sf_dir):
    """Score and label of every second post are set together by key, in a table laid out by key."""
    table = create(ip.wide(spark, sf_dir).select("tweet_id", "sentiment_score", "label"), scratch_path(spark, "posts"))
    score = F.col("seq") % 9 - 4
    new = (ip.posts(spark, sf_dir).where("seq % 2 = 0")
           .select("tweet_id", score.alias("sentiment_score"), label_of(score).alias("label")))
    upsert(table, new, ["sentiment_score", "label"])
    return read(spark, table).select("tweet_id", "sentiment_score", "label")


@query("incremental_clean_label", f"""WITH {ip.SQL_CLEANED}, {ip.SQL_LEXICON}, {ip.sql_scores('cleaned')}
  SELECT c.tweet_id, c.cleaned_text, sentiment_score, {ip.sql_label('sentiment_score')} AS label
  FROM cleaned c JOIN scores s ON c.tweet_id = s.tweet_id""")
def incremental_clean_label(spark, sf_dir):
    """The documents as a stream: the rows written by the runs equal the batch result."""
    schema = read_table(spark, sf_dir, "documents").schema
    stream = read_table_stream(spark, sf_dir, "documents", schema)
    out = scratch_path(spark, "labelled")
    run = inc.clean_and_label(posts_from_documents(stream), out, scratch_path(spark, "progress"),
                              ip.lexicon(spark), lambda b: preprocess(b, custom=()))
    run.awaitTermination()
    return inc.stored(spark, out).select("tweet_id", "cleaned_text", "sentiment_score", "label")


@query("incremental_ingest", sql_walk("""SELECT seq, CAST(seq // 2 AS VARCHAR) AS tweet_id, md5(raw_text) AS k,
  row_number() OVER (ORDER BY seq % 3, seq) AS rn FROM posts""") + " SELECT seq FROM walk WHERE kept")
def incremental_ingest(spark, sf_dir):
    """Three batches landed one after the other; stored rows win over later ones."""
    rows = _colliding(spark, sf_dir)
    landing, progress = scratch_path(spark, "landing"), scratch_path(spark, "progress")
    rows_out, keys_out = scratch_path(spark, "rows"), scratch_path(spark, "keys")
    for part in range(3):
        rows.where(F.col("seq") % 3 == part).write.mode("append").parquet(landing)
        stream = inc.read_post_stream(spark, landing, "parquet")
        inc.ingest_stream(stream, rows_out, keys_out, progress).awaitTermination()
    return inc.stored(spark, rows_out).select("seq")
