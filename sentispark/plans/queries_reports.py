"""Scans, queues, previews, counts and top lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentispark.functions.sentiment import parse_created_at
from sentispark.operators import queues, reports
from sentispark.operators.ingest import valid_posts
from sentispark.plans import inputs as ip
from sentispark.plans.catalog import query
from sentispark.session import scratch_path
from sentispark.sources.posts import scan_posts as scan

W = f"WITH {ip.SQL_WIDE} "
COLUMNS = ("seq", "tweet_id", "username", "created_at", "raw_text", "keyword", "tweet_url", "reply_to_id")
LABELLED = "count(*) FILTER (label IS NOT NULL)"


def _wide_query(name: str, sql: str, run) -> None:
    @query(name, W + sql)
    def _(spark, sf_dir):
        return run(ip.wide(spark, sf_dir))


@query("scan_posts", f"""WITH {ip.SQL_POSTS}, {ip.SQL_TURNS} SELECT {', '.join(COLUMNS)} FROM posts
  UNION ALL SELECT {', '.join(COLUMNS)} FROM turns""")
def scan_posts(spark, sf_dir):
    """Landed JSON lines, read with the declared schema: optional fields that are null are missing from a line, and for every
    fiftieth post a line that breaks off and one without its author stand beside it."""
    rows = ip.posts(spark, sf_dir).unionByName(ip.turns(spark, sf_dir))
    whole, some = F.to_json(F.struct(*rows.columns)), F.col("seq") % 50 == 7
    broken = F.when(some, F.substring(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int")))
    nameless = F.when(some, F.to_json(F.struct(*[c for c in rows.columns if c != "username"])))
    path = scratch_path(spark, "landed")
    rows.select(F.explode_outer(F.array(whole, broken, nameless)).alias("value")).where("value IS NOT NULL").write.text(path)
    return valid_posts(scan(spark, path, "json", mode="DROPMALFORMED")).select(*COLUMNS)


@query("full_scan", W + "SELECT *, CAST(length(raw_text) AS BIGINT) AS n FROM wide")
def full_scan(spark, sf_dir):
    """The three stage tables put together again."""
    table = ip.wide(spark, sf_dir)
    raw = ip.posts(spark, sf_dir)
    rows = queues.wide_posts(raw, table.where("cleaned_text IS NOT NULL"), table.where("label IS NOT NULL"))
    arrived = F.regexp_replace(F.col("scraped_at").cast("string"), " ", "T")
    return rows.withColumn("scraped_at", arrived).withColumn("n", F.length("raw_text").cast("long"))


_wide_query("queue_clean", "SELECT tweet_id, raw_text FROM wide WHERE cleaned_text IS NULL", queues.clean_queue)
_wide_query("queue_label", "SELECT tweet_id, cleaned_text FROM wide WHERE label IS NULL AND cleaned_text IS NOT NULL",
            queues.label_queue)
_wide_query("ml_dataset_binary", """SELECT tweet_id, cleaned_text, label FROM wide
  WHERE cleaned_text IS NOT NULL AND label IN ('positive', 'negative')""", queues.training_set)
_wide_query("ml_dataset_all", """SELECT tweet_id, cleaned_text, label FROM wide
  WHERE cleaned_text IS NOT NULL AND label IS NOT NULL""",
            lambda t: queues.training_set(t, exclude_neutral=False))


@query("preview_filter", f"""WITH {ip.SQL_WIDE_TURNS} SELECT username, raw_text, label, reply_to_id, tweet_url FROM wide
  WHERE label = 'negative' AND reply_to_id IS NOT NULL ORDER BY scraped_at DESC, seq DESC LIMIT 5""")
def preview_filter(spark, sf_dir):
    return queues.preview(ip.wide_turns(spark, sf_dir), label="negative", only_replies=True)


_WORDED = "strftime(timestamp '2024-01-01' + to_minutes(seq), '%a %b %d %H:%M:%S +0000 %Y')"


@query("created_at_parse", f"""WITH {ip.SQL_POSTS} SELECT tweet_id,
    CASE WHEN seq % 10 = 9 THEN 'yesterday' WHEN seq % 2 = 1 THEN {_WORDED}
      WHEN seq % 4 = 0 THEN created_at || '.250000' ELSE created_at END AS created_at,
    CASE WHEN seq % 10 <> 9 THEN 1704067200 + seq * 60 END AS epoch FROM posts""")
def created_at_parse(spark, sf_dir):
    """ISO text with and without fractions, the worded format, and text that is no date."""
    s = F.col("seq")
    worded = F.date_format("scraped_at", "EEE MMM dd HH:mm:ss '+0000' yyyy")
    text = (F.when(s % 10 == 9, F.lit("yesterday")).when(s % 2 == 1, worded)
            .when(s % 4 == 0, F.concat("created_at", F.lit(".250000"))).otherwise(F.col("created_at")))
    rows = ip.posts(spark, sf_dir).select("tweet_id", text.alias("created_at"))
    return rows.withColumn("epoch", F.unix_seconds(parse_created_at(F.col("created_at"))))


_wide_query("label_distribution", """SELECT l.label, count(w.label) AS n
  FROM (VALUES ('positive'), ('negative'), ('neutral')) l(label) LEFT JOIN wide w ON w.label = l.label
  GROUP BY l.label""", reports.label_distribution)
_wide_query("label_distribution_with_null", "SELECT label, count(*) AS n FROM wide GROUP BY label",
            reports.label_distribution_with_null)


def _sql_count(label: str) -> str:
    return f"count(*) FILTER (label = '{label}')"


_wide_query("label_percentages", f"""SELECT count(*) AS total_tweets, {LABELLED} AS total_labeled,
  {', '.join(f"{_sql_count(x)} AS {x}" for x in reports.LABELS)},
  {', '.join(f"CASE WHEN {LABELLED} > 0 THEN round({_sql_count(x)} / {LABELLED} * 100, 1) ELSE 0 END AS {x}_pct"
             for x in reports.LABELS)} FROM wide""", reports.label_stats)
_wide_query("total_count", "SELECT count(*) AS n FROM wide", reports.total_count)

SQL_TOP = f"""words AS (SELECT label, unnest({ip.sql_tokens('cleaned_text')}) AS term FROM wide
    WHERE label IS NOT NULL AND cleaned_text IS NOT NULL),
  freq AS (SELECT label, term, count(*) AS n FROM words WHERE length(term) >= 3 GROUP BY label, term),
  top AS (SELECT *, CAST(row_number() OVER (PARTITION BY label ORDER BY n DESC, term) AS INT) AS rank FROM freq)"""
WT = f"WITH {ip.SQL_WIDE}, {SQL_TOP} "


@query("word_frequency_topn", WT + "SELECT label, term, n, rank FROM top WHERE rank <= 30")
def word_frequency_topn(spark, sf_dir):
    return reports.top_words(ip.wide(spark, sf_dir))


@query("export_wordcloud", WT + 'SELECT label AS "Label", term AS "Kata", n AS "Frekuensi" FROM top WHERE rank <= 50')
def export_wordcloud(spark, sf_dir):
    return reports.export_words(ip.wide(spark, sf_dir))


_wide_query("keyword_counts", "SELECT keyword, count(*) AS n FROM wide GROUP BY keyword", reports.keyword_counts)

SQL_LATEST = """SELECT username, raw_text, cleaned_text, sentiment_score, label, created_at, tweet_url, tweet_id
  FROM wide WHERE label IS NOT NULL ORDER BY scraped_at DESC, seq DESC LIMIT 50"""
SQL_LATEST_RAW = """SELECT username, raw_text, keyword, created_at, tweet_url, tweet_id FROM wide
  ORDER BY scraped_at DESC, seq DESC LIMIT 50"""
_wide_query("latest_labeled", SQL_LATEST, reports.latest_labeled)
_wide_query("latest_raw", SQL_LATEST_RAW, reports.latest_raw)
_wide_query("pending_counts", """SELECT count(*) FILTER (cleaned_text IS NULL) AS pending_preprocess,
  count(*) FILTER (cleaned_text IS NOT NULL AND label IS NULL) AS pending_label FROM wide""", reports.pending_counts)
_wide_query("dominant_label", f"""SELECT label, count(*) AS n,
  round(count(*) / (SELECT {LABELLED} FROM wide) * 100, 1) AS pct
  FROM wide WHERE label IS NOT NULL GROUP BY label
  ORDER BY n DESC, list_position(['positive', 'negative', 'neutral'], label) LIMIT 1""", reports.dominant_label)
_wide_query("export_labeled_csv", """SELECT username AS "Username", created_at AS "Tanggal", keyword AS "Keyword",
  label AS "Label", sentiment_score AS "Skor", raw_text AS "Tweet Asli", cleaned_text AS "Hasil Preprocessing",
  tweet_url AS "URL" FROM wide WHERE label IS NOT NULL""", reports.export_labeled)


@query("dashboard_blocks", WT + f""", stats AS (SELECT count(*) AS t, {LABELLED} AS l FROM wide),
  latest AS ({SQL_LATEST}), latest_raw AS ({SQL_LATEST_RAW})
  SELECT 'stats' AS block, 'total_tweets' AS item, t AS value FROM stats
  UNION ALL SELECT 'stats', 'total_labeled', l FROM stats
  UNION ALL SELECT 'stats', label, count(*) FROM wide WHERE label IS NOT NULL GROUP BY label
  UNION ALL SELECT 'wordclouds', label || ':' || term, n FROM top WHERE rank <= 30
  UNION ALL SELECT 'per_keyword', keyword, count(*) FROM wide GROUP BY keyword
  UNION ALL SELECT 'pending', 'pending_preprocess', count(*) FROM wide WHERE cleaned_text IS NULL
  UNION ALL SELECT 'pending', 'pending_label', count(*) FROM wide WHERE cleaned_text IS NOT NULL AND label IS NULL
  UNION ALL SELECT 'raw_tweets', tweet_id, length(raw_text) FROM latest_raw
  UNION ALL SELECT 'tweets', tweet_id, sentiment_score FROM latest""")
def dashboard_blocks(spark, sf_dir):
    """All blocks, as (block, item, value) rows."""
    b = reports.dashboard_blocks(ip.wide(spark, sf_dir))
    stats = b["stats"].unpivot([], ["total_tweets", "total_labeled", *reports.LABELS], "item", "value")
    stats = stats.where(~F.col("item").isin(*reports.LABELS) | (F.col("value") > 0))

    def rows(block: str, item, value):
        return b[block].select(F.lit(block).alias("block"), item.alias("item"), value.cast("long").alias("value"))

    parts = [
        stats.select(F.lit("stats").alias("block"), "item", "value"),
        rows("wordclouds", F.concat_ws(":", "label", "term"), F.col("n")),
        rows("per_keyword", F.col("keyword"), F.col("n")),
        b["pending"].unpivot([], ["pending_preprocess", "pending_label"], "item", "value")
        .select(F.lit("pending").alias("block"), "item", "value"),
        rows("raw_tweets", F.col("tweet_id"), F.length("raw_text")),
        rows("tweets", F.col("tweet_id"), F.col("sentiment_score")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
