"""Training data, split and TF-IDF features."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentispark.functions.sentiment import binary_label
from sentispark.functions.terms import terms_1_2, vector_tokens
from sentispark.operators import features as ft
from sentispark.operators.split import class_counts, stratified_split
from sentispark.plans import inputs as ip
from sentispark.plans.catalog import query
from sentispark.session import cut_lineage

G = f"WITH {ip.SQL_GOLD} "
SQL_WORDS = "list_filter(string_split(cleaned_text, ' '), lambda w: length(w) >= 2)"
SQL_TERMS = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"


def sql_terms(rows: str, name: str) -> str:
    """CTE (tweet_id, term): every term occurrence of a relation."""
    return f"""{name} AS (SELECT tweet_id, unnest({SQL_TERMS}) AS term
    FROM (SELECT tweet_id, {SQL_WORDS} AS w FROM {rows}))"""


SQL_VOCAB = f"""{ip.SQL_SPLIT}, {sql_terms('train', 'train_terms')},
  vocab AS (SELECT term, count(*) AS tf FROM train_terms GROUP BY term ORDER BY tf DESC, term LIMIT {ft.MAX_FEATURES}),
  idf AS (SELECT term, count(DISTINCT tweet_id) AS df, (SELECT count(*) FROM train) AS n_docs,
    ln((1 + (SELECT count(*) FROM train)) / (1 + count(DISTINCT tweet_id))) + 1 AS idf
    FROM train_terms JOIN vocab USING (term) GROUP BY term)"""


def sql_weights(rows: str, name: str) -> str:
    """CTE (tweet_id, term, weight): unit-length weights of a relation under the vocabulary."""
    return f"""{sql_terms(rows, name + '_terms')},
  {name}_raw AS (SELECT tweet_id, term, count(*) * min(idf) AS x FROM {name}_terms JOIN idf USING (term)
    GROUP BY tweet_id, term),
  {name} AS (SELECT tweet_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY tweet_id)) AS weight FROM {name}_raw)"""


@query("class_counts", G + "SELECT label, count(*) AS n FROM gold GROUP BY label")
def counts(spark, sf_dir):
    return class_counts(ip.gold_binary(spark, sf_dir))


@query("binarize_label", G + "SELECT tweet_id, CAST(label = 'positive' AS INT) AS y FROM gold")
def binarize(spark, sf_dir):
    return ip.gold_binary(spark, sf_dir).select("tweet_id", binary_label(F.col("label")).alias("y"))


@query("stratified_split", f"WITH {ip.SQL_SPLIT} SELECT tweet_id, label, is_train FROM split")
def split(spark, sf_dir):
    return stratified_split(ip.gold_binary(spark, sf_dir)).select("tweet_id", "label", "is_train")


@query("vectorizer_tokens", f"""WITH {ip.SQL_CLEANED} SELECT tweet_id, array_to_string({SQL_WORDS}, ' ') AS words,
  len({SQL_WORDS}) AS n FROM cleaned""")
def words(spark, sf_dir):
    w = vector_tokens("cleaned_text")
    return ip.cleaned_posts(spark, sf_dir).select(
        "tweet_id", F.array_join(w, " ").alias("words"), F.size(w).cast("long").alias("n"))


@query("ngrams_1_2", f"""WITH {ip.SQL_CLEANED} SELECT tweet_id, array_to_string({SQL_TERMS}, '|') AS terms
  FROM (SELECT tweet_id, {SQL_WORDS} AS w FROM cleaned)""")
def ngrams(spark, sf_dir):
    words = ip.cleaned_posts(spark, sf_dir).withColumn("w", vector_tokens("cleaned_text"))
    return words.select("tweet_id", F.array_join(terms_1_2(F.col("w")), "|").alias("terms"))


@query("term_frequency", f"""WITH {ip.SQL_GOLD}, {sql_terms('gold', 'gold_terms')}
  SELECT tweet_id, term, count(*) AS tf FROM gold_terms GROUP BY tweet_id, term""")
def tf(spark, sf_dir):
    return ft.term_frequency(ip.gold_binary(spark, sf_dir))


def _split_parts(spark, sf_dir):
    rows = stratified_split(cut_lineage(ip.gold_binary(spark, sf_dir)))
    return rows.where("is_train"), rows.where(~F.col("is_train"))


@query("vocabulary_topk", f"WITH {SQL_VOCAB} SELECT term, tf FROM vocab")
def vocab(spark, sf_dir):
    return ft.vocabulary(_split_parts(spark, sf_dir)[0])


@query("smoothed_idf", f"WITH {SQL_VOCAB} SELECT term, df, n_docs, round(idf, 6) AS idf FROM idf")
def idf(spark, sf_dir):
    return ft.smoothed_idf(_split_parts(spark, sf_dir)[0]).withColumn("idf", F.round("idf", 6))


@query("tfidf_l2", f"""WITH {SQL_VOCAB}, {sql_weights('train', 'w')}
  SELECT tweet_id, term, round(weight, 6) AS weight FROM w""")
def tfidf_train(spark, sf_dir):
    train, _ = _split_parts(spark, sf_dir)
    model = ft.fit_tfidf(train)
    return ft.term_weights(ft.tfidf(train, model), model).withColumn("weight", F.round("weight", 6))


@query("tfidf_transform", f"""WITH {SQL_VOCAB}, {sql_weights('test', 'w')}
  SELECT tweet_id, term, round(weight, 6) AS weight FROM w""")
def tfidf_test(spark, sf_dir):
    train, test = _split_parts(spark, sf_dir)
    model = ft.fit_tfidf(train)
    return ft.term_weights(ft.tfidf(test, model), model).withColumn("weight", F.round("weight", 6))


@query("top_mean_tfidf", f"""WITH {SQL_VOCAB}, {sql_weights('train', 'w')}
  SELECT term, round(mean, 4) AS weight FROM (SELECT term, round(sum(weight) / (SELECT count(*) FROM train), 12) AS mean
    FROM w GROUP BY term) ORDER BY mean DESC, term DESC LIMIT 10""")
def top_mean(spark, sf_dir):
    train, _ = _split_parts(spark, sf_dir)
    model = ft.fit_tfidf(train)
    return ft.top_mean_terms(ft.tfidf(train, model), model)
