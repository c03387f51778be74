"""Cleaning, tokenising, stop words and stemming."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentispark.functions import text as tx
from sentispark.operators.lookup import drop_listed_words, replace_words
from sentispark.operators.stem import (FORBIDDEN_PAIRS, MIN_STEM, PARTICLES, POSSESSIVES, PREFIX_RULES,
                                       SUFFIXES, stem_table)
from sentispark.plans import inputs as ip
from sentispark.plans.catalog import query
from sentispark.plans.phases import preprocess, stage_trace
from sentispark.session import cut_lineage
from sentispark.sources.posts import literal_table

LOWER = "lower(raw_text)"


def _sql_replace(col: str, pattern: str, by: str) -> str:
    return f"regexp_replace({col}, '{pattern}', '{by}', 'g')"


def _sql_urls(col: str) -> str:
    ns = r"[^\s\x{1c}-\x{1f}\x{85}\p{Z}]"
    return _sql_replace(col, rf"https?://{ns}+|www\.{ns}+", "")


def _sql_tags(col: str) -> str:
    return _sql_replace(col, r"[@#][\p{L}\p{N}_]+", "")


def _sql_letters(col: str) -> str:
    return _sql_replace(col, "[^a-z]+", " ")


def _sql_blanks(col: str) -> str:
    return _sql_replace(col, r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]+", " ")


def _drop(words: str, listed) -> str:
    return f"list_filter({words}, lambda w: w NOT IN {ip.sql_list(listed)})"


def _text_query(name: str, column, expr: str) -> None:
    @query(name, f"WITH {ip.SQL_NOISY} SELECT tweet_id, {expr} AS out FROM noisy")
    def run(spark, sf_dir):
        return ip.noisy_posts(spark, sf_dir).select("tweet_id", column("raw_text").alias("out"))


_text_query("case_fold", tx.case_fold, LOWER)
_text_query("strip_urls", lambda c: tx.strip_urls(tx.case_fold(c)), _sql_urls(LOWER))
_text_query("strip_mentions_hashtags", lambda c: tx.strip_tags(tx.case_fold(c)), _sql_tags(LOWER))
_text_query("letters_only", lambda c: tx.letters_only(tx.case_fold(c)), _sql_letters(LOWER))
_text_query("squeeze_trim", lambda c: tx.squeeze(c), f"trim({_sql_blanks('raw_text')})")
_text_query("clean_text", tx.clean_text, ip.sql_clean("raw_text"))


@query("tokenize", f"""WITH {ip.SQL_NOISY}, t AS (SELECT tweet_id, {ip.sql_tokens(ip.sql_clean('raw_text'))} AS w
  FROM noisy) SELECT tweet_id, CAST(unnest(generate_series(0, len(w) - 1)) AS INT) AS pos, unnest(w) AS token FROM t""")
def tokenize(spark, sf_dir):
    words = tx.tokens(tx.clean_text("raw_text"))
    return (ip.noisy_posts(spark, sf_dir)
            .select("tweet_id", F.posexplode_outer(words).alias("pos", "token")).where("token IS NOT NULL"))


SQL_GENERAL = _drop(ip.sql_tokens(ip.sql_clean("raw_text")), ip.STOPWORDS)
SQL_BOTH = _drop(SQL_GENERAL, tx.CUSTOM_STOPWORDS)


@query("remove_stopwords_general",
       f"WITH {ip.SQL_NOISY} SELECT tweet_id, array_to_string({SQL_GENERAL}, ' ') AS cleaned_text FROM noisy")
def remove_stopwords_general(spark, sf_dir):
    rows = ip.noisy_posts(spark, sf_dir).select("tweet_id", tx.clean_text("raw_text").alias("cleaned_text"))
    listed = literal_table(spark, "word", [(w,) for w in ip.STOPWORDS])
    return drop_listed_words(rows, "tweet_id", "cleaned_text", listed)


@query("remove_stopwords_custom", f"""WITH {ip.SQL_NOISY} SELECT tweet_id, array_to_string(
  {_drop(ip.sql_tokens(ip.sql_clean('raw_text')), tx.CUSTOM_STOPWORDS)}, ' ') AS cleaned_text FROM noisy""")
def remove_stopwords_custom(spark, sf_dir):
    words = tx.without_words(tx.tokens(tx.clean_text("raw_text")), tx.CUSTOM_STOPWORDS)
    return ip.noisy_posts(spark, sf_dir).select("tweet_id", tx.join_words(words).alias("cleaned_text"))


def _sql_stem(words: str) -> str:
    cases = " ".join(f"WHEN '{w}' THEN '{s}'" for w, s in ip.STEMS)
    return f"array_to_string(list_transform({words}, lambda w: CASE w {cases} ELSE w END), ' ')"


def _sql_stemmed(words: str) -> str:
    return f"WITH {ip.SQL_NOISY} SELECT tweet_id, {_sql_stem(words)} AS cleaned_text FROM noisy"


@query("stem_lookup", _sql_stemmed(ip.sql_tokens(ip.sql_clean("raw_text"))))
def stem_lookup(spark, sf_dir):
    rows = ip.noisy_posts(spark, sf_dir).select("tweet_id", tx.clean_text("raw_text").alias("cleaned_text"))
    return replace_words(rows, "tweet_id", "cleaned_text", ip.stem_map(spark))


@query("stem_lookup_joined", _sql_stemmed(ip.sql_tokens(ip.sql_clean("raw_text"))))
def stem_lookup_joined(spark, sf_dir):
    """The same through the word join that serves stem tables too large for a plan."""
    rows = ip.noisy_posts(spark, sf_dir).select("tweet_id", tx.clean_text("raw_text").alias("cleaned_text"))
    return replace_words(rows, "tweet_id", "cleaned_text", ip.stem_map(spark), max_literal=0, max_rows=0)


def _sql_cut(source: str, endings) -> str:
    cases = " ".join(
        f"WHEN ends_with({source}, '{e}') AND length({source}) >= {len(e) + MIN_STEM} "
        f"THEN left({source}, length({source}) - {len(e)})" for e in endings)
    return f"CASE {cases} ELSE {source} END"


def _sql_strip(level: int) -> str:
    """One prefix more; the outermost one must suit the suffix taken off."""
    step = 100 ** (3 - level)
    pairs = ", ".join(f"('{a}', '{b}')" for a, b in FORBIDDEN_PAIRS)
    suits = f"AND (left(prefix, 2), suffix) NOT IN ({pairs})" if level == 1 else ""
    return f"""d{level} AS (SELECT word, put || substr(form, n + 1) AS form, rank + 1000000 + no * {step} AS rank, suffix
      FROM d{level - 1} JOIN rules ON starts_with(form, prefix) AND length(form) >= n + {MIN_STEM}
        AND contains(nxt, substr(form, n + 1, 1)) {suits})"""


SQL_CONFIX = f"""WITH {ip.SQL_CLEANED},
  counted AS (SELECT word, count(*) AS c FROM (SELECT unnest({ip.sql_tokens('cleaned_text')}) AS word FROM cleaned)
    GROUP BY word),
  roots AS (SELECT word AS form FROM counted WHERE c >= 2 AND length(word) BETWEEN 3 AND 6),
  rules(prefix, nxt, put, n, no) AS (VALUES {ip.sql_values([(p, x, a, len(p), i + 1)
                                                           for i, (p, x, a) in enumerate(PREFIX_RULES)])}),
  f1 AS (SELECT word, {_sql_cut('word', PARTICLES)} AS w1 FROM counted),
  f2 AS (SELECT *, {_sql_cut('w1', POSSESSIVES)} AS w2 FROM f1),
  f3 AS (SELECT *, {_sql_cut('w2', SUFFIXES)} AS w3,
    CASE WHEN ends_with(w2, 'kan') THEN {_sql_cut('w2', ('an',))} ELSE w2 END AS w4 FROM f2),
  bare AS (
    SELECT word, word AS form, 0 AS g, '' AS suffix FROM f3
    UNION ALL SELECT word, w1, 1, '' FROM f3 UNION ALL SELECT word, w2, 2, '' FROM f3
    UNION ALL SELECT word, w3, 3, substr(w2, length(w3) + 1) FROM f3
    UNION ALL SELECT word, w4, 4, substr(w2, length(w4) + 1) FROM f3),
  d0 AS (SELECT word, form, CAST(10000000 * (5 + CASE g WHEN 3 THEN 0 WHEN 4 THEN 1 WHEN 2 THEN 2
    WHEN 1 THEN 3 ELSE 4 END) AS BIGINT) AS rank, suffix FROM bare),
  {_sql_strip(1)}, {_sql_strip(2)}, {_sql_strip(3)},
  forms AS (SELECT word, form, CAST(10000000 * g AS BIGINT) AS rank FROM bare
    UNION ALL SELECT word, form, rank FROM d1 UNION ALL SELECT word, form, rank FROM d2
    UNION ALL SELECT word, form, rank FROM d3)
  SELECT word, arg_min(form, rank) AS stem FROM forms JOIN roots USING (form) GROUP BY word"""


@query("stem_confix", SQL_CONFIX)
def stem_confix(spark, sf_dir):
    """Stems of all distinct words; the short frequent words of the texts serve as roots."""
    cleaned = ip.cleaned_posts(spark, sf_dir)
    words = tx.each(cleaned, tx.tokens("cleaned_text"), "word")
    counted = cut_lineage(words.groupBy("word").agg(F.count("*").alias("c")))
    roots = counted.where((F.col("c") >= 2) & F.length("word").between(3, 6))
    return stem_table(counted.select("word"), roots)


@query("preprocess_full", _sql_stemmed(SQL_BOTH))
def preprocess_full(spark, sf_dir):
    return preprocess(ip.noisy_posts(spark, sf_dir), ip.STOPWORDS, ip.stem_map(spark))


_U = _sql_urls("folded")
_T = _sql_tags("no_urls")
_L = _sql_letters("no_tags")


@query("stage_trace", f"""WITH {ip.SQL_NOISY}, a AS (SELECT *, lower(raw_text) AS folded FROM noisy),
  b AS (SELECT *, {_U} AS no_urls FROM a), c AS (SELECT *, {_T} AS no_tags FROM b),
  d AS (SELECT *, {_L} AS letters FROM c), e AS (SELECT *, trim(letters) AS cleaned FROM d),
  f AS (SELECT *, array_to_string({_drop(ip.sql_tokens('cleaned'), ip.STOPWORDS)}, ' ') AS no_stopwords FROM e),
  g AS (SELECT *, array_to_string({_drop(ip.sql_tokens('no_stopwords'), tx.CUSTOM_STOPWORDS)}, ' ') AS no_custom
    FROM f) SELECT *, {_sql_stem(ip.sql_tokens('no_custom'))} AS stemmed FROM g""")
def trace(spark, sf_dir):
    return stage_trace(ip.noisy_posts(spark, sf_dir), ip.STOPWORDS, ip.stem_map(spark))
