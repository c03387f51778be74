"""Naive Bayes and support vector machine on the labelled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentispark.functions.sentiment import binary_label
from sentispark.operators import bayes, svm
from sentispark.operators import features as ft
from sentispark.operators.split import stratified_split
from sentispark.plans import inputs as ip
from sentispark.operators import evaluate as ev
from sentispark.plans.catalog import query
from sentispark.plans.phases import both_models, run_train, score_corpus
from sentispark.plans.queries_evaluate import FIVE, sql_metrics, sql_wins
from sentispark.plans.queries_features import SQL_VOCAB, sql_weights
from sentispark.plans.results import evaluation_report, results_document
from sentispark.session import cut_lineage

SQL_NB = f"""{SQL_VOCAB}, {sql_weights('train', 'w')},
  classes AS (SELECT label, CAST(label = 'positive' AS INT) AS y, count(*) AS n FROM train GROUP BY label),
  grid AS (SELECT y, label, term FROM classes, vocab),
  sums AS (SELECT t.label, term, sum(weight) AS s FROM w JOIN train t ON t.tweet_id = w.tweet_id GROUP BY t.label, term),
  theta AS (SELECT y, g.term, ln((coalesce(s, 0) + 1) / sum(coalesce(s, 0) + 1) OVER (PARTITION BY y)) AS theta
    FROM grid g LEFT JOIN sums ON sums.label = g.label AND sums.term = g.term),
  prior AS (SELECT y, ln(n / (SELECT sum(n) FROM classes)) AS prior FROM classes)"""
SQL_MARGIN = f"""WITH {SQL_NB}, {sql_weights('test', 'v')},
  odds AS (SELECT max(prior) FILTER (y = 1) - max(prior) FILTER (y = 0) AS o FROM prior),
  diff AS (SELECT term, max(theta) FILTER (y = 1) - max(theta) FILTER (y = 0) AS d FROM theta GROUP BY term),
  dots AS (SELECT tweet_id, sum(weight * d) AS s FROM v JOIN diff USING (term) GROUP BY tweet_id),
  margins AS (SELECT t.tweet_id, o + coalesce(s, 0) AS margin
    FROM test t LEFT JOIN dots ON dots.tweet_id = t.tweet_id, odds)"""


def _parts(spark, sf_dir):
    rows = stratified_split(cut_lineage(ip.gold_binary(spark, sf_dir))).withColumn("y", binary_label(F.col("label")))
    train = rows.where("is_train")
    vocab = ft.fit_tfidf(train)
    keep = ["tweet_id", "y", "features"]
    return (vocab, cut_lineage(ft.tfidf(train, vocab).select(*keep)),
            ft.tfidf(rows.where(~F.col("is_train")), vocab).select(*keep))


@query("nb_fit", f"""WITH {SQL_NB} SELECT CAST(y AS INT) AS y, term, round(theta, 6) AS theta, round(prior, 6) AS prior
  FROM theta JOIN prior USING (y)""")
def nb_fit(spark, sf_dir):
    vocab, train, _ = _parts(spark, sf_dir)
    out = bayes.nb_parameters(spark, bayes.nb_fit(train), vocab)
    return out.withColumn("theta", F.round("theta", 6)).withColumn("prior", F.round("prior", 6))


def _nb_scores(spark, sf_dir):
    _, train, test = _parts(spark, sf_dir)
    return bayes.nb_predict(test, bayes.nb_fit(train))


@query("nb_predict", f"{SQL_MARGIN} SELECT tweet_id, CAST(margin > 0 AS INT) AS pred, round(margin, 6) AS margin FROM margins")
def nb_predict(spark, sf_dir):
    return _nb_scores(spark, sf_dir).select("tweet_id", F.col("nb_pred").alias("pred"),
                                            F.round("nb_margin", 6).alias("margin"))


@query("nb_proba", f"{SQL_MARGIN} SELECT tweet_id, round(1 / (1 + exp(-margin)), 6) AS proba FROM margins")
def nb_proba(spark, sf_dir):
    return _nb_scores(spark, sf_dir).select("tweet_id", F.round("nb_proba", 6).alias("proba"))


@query("svm_fit")
def svm_fit(spark, sf_dir):
    vocab, train, _ = _parts(spark, sf_dir)
    model = svm.svm_fit(train)
    rows = [("(intercept)", model.intercept), *zip(vocab.terms, model.weights)]
    return spark.createDataFrame(rows, "term string, weight double")


@query("svm_predict")
def svm_predict(spark, sf_dir):
    _, train, test = _parts(spark, sf_dir)
    return svm.svm_predict(test, svm.svm_fit(train)).select("tweet_id", "y", "svm_margin", "svm_pred")


@query("svm_platt")
def svm_platt(spark, sf_dir):
    _, train, test = _parts(spark, sf_dir)
    platt = svm.platt_fit(svm.held_out_margins(train))
    return (svm.svm_proba(svm.svm_predict(test, svm.svm_fit(train)), platt)
            .select("tweet_id", "y", "svm_margin", "svm_proba"))


def _trained(spark, sf_dir):
    rows = cut_lineage(ip.gold(spark, sf_dir))
    return rows, run_train(rows)


@query("full_corpus_scoring")
def full_corpus_scoring(spark, sf_dir):
    return score_corpus(*_trained(spark, sf_dir))


@query("full_corpus_scoring_nb", f"""WITH {SQL_NB}, {sql_weights('gold_all', 'v')},
  odds AS (SELECT max(prior) FILTER (y = 1) - max(prior) FILTER (y = 0) AS o FROM prior),
  diff AS (SELECT term, max(theta) FILTER (y = 1) - max(theta) FILTER (y = 0) AS d FROM theta GROUP BY term),
  dots AS (SELECT tweet_id, sum(weight * d) AS s FROM v JOIN diff USING (term) GROUP BY tweet_id)
  SELECT count(*) FILTER (o + coalesce(s, 0) > 0) AS positive, count(*) FILTER (o + coalesce(s, 0) <= 0) AS negative
  FROM gold_all g LEFT JOIN dots ON dots.tweet_id = g.tweet_id, odds""")
def full_corpus_scoring_nb(spark, sf_dir):
    vocab, train, _ = _parts(spark, sf_dir)
    rows = ft.tfidf(ip.gold(spark, sf_dir), vocab)
    margin = bayes.nb_margin(bayes.nb_fit(train))
    return rows.agg(F.count_if(margin > 0).alias("positive"), F.count_if(margin <= 0).alias("negative"))


@query("results_document")
def document(spark, sf_dir):
    return results_document(*_trained(spark, sf_dir))


@query("evaluation_report")
def report(spark, sf_dir):
    return evaluation_report(*_trained(spark, sf_dir))


# --- the second model with given weights: every figure behind it has SQL -----------------------------------------------

GIVEN_INTERCEPT, GIVEN_PLATT = 0.05, svm.Platt(1.5, 0.25)


def _given(vocab: ft.Tfidf) -> tuple[svm.Linear, svm.Platt]:
    """Weights that follow from the letters of a term, in the place of fitted ones."""
    weights = [((7 * len(t) + ord(t[0])) % 23 - 9) / 10.0 for t in vocab.terms]
    return svm.Linear(weights, GIVEN_INTERCEPT), GIVEN_PLATT


def _sql_margins(rows: str, name: str) -> str:
    """CTE (tweet_id, nb, svm): margins of both models for a relation, to nine places."""
    return f"""{sql_weights(rows, name + '_w')},
  {name}_dots AS (SELECT tweet_id, sum(weight * d) AS a, sum(weight * ((7 * length(term) + ascii(term)) % 23 - 9) / 10.0) AS b
    FROM {name}_w JOIN diff USING (term) GROUP BY tweet_id),
  {name} AS (SELECT r.tweet_id, r.label, round(o + coalesce(a, 0), 9) AS nb, round({GIVEN_INTERCEPT} + coalesce(b, 0), 9) AS svm
    FROM {rows} r LEFT JOIN {name}_dots k ON k.tweet_id = r.tweet_id, odds)"""


SQL_GIVEN = f"""WITH {SQL_NB},
  odds AS (SELECT max(prior) FILTER (y = 1) - max(prior) FILTER (y = 0) AS o FROM prior),
  diff AS (SELECT term, max(theta) FILTER (y = 1) - max(theta) FILTER (y = 0) AS d FROM theta GROUP BY term),
  {_sql_margins('test', 'tested')}, {_sql_margins('gold_all', 'everything')},
  scored AS (SELECT 'nb' AS model, tweet_id AS id, CAST(label = 'positive' AS INT) AS y, CAST(nb > 0 AS INT) AS pred,
      round(1 / (1 + exp(-nb)), 9) AS score FROM tested
    UNION ALL SELECT 'svm', tweet_id, CAST(label = 'positive' AS INT), CAST(svm > 0 AS INT),
      round(1 / (1 + exp(-({GIVEN_PLATT.slope} * svm + {GIVEN_PLATT.offset}))), 9) FROM tested),
  corpus AS (SELECT 'nb' AS model, count(*) FILTER (nb > 0) AS positive, count(*) FILTER (nb <= 0) AS negative FROM everything
    UNION ALL SELECT 'svm', count(*) FILTER (svm > 0), count(*) FILTER (svm <= 0) FROM everything),
  {sql_metrics()}"""


def _trained_given(spark, sf_dir):
    """A training whose second model is given; scores to nine places, so that equal ones are equal in SQL too."""
    rows = cut_lineage(ip.gold(spark, sf_dir))
    fitted = run_train(rows, given=_given)
    scored = fitted.scored.withColumn("score", F.round("score", 9))
    return rows, fitted._replace(scored=scored, comparison=ev.model_comparison(scored))


@query("svm_predict_given", f"""{SQL_GIVEN} SELECT t.tweet_id, CAST(label = 'positive' AS INT) AS y, round(svm, 6) AS svm_margin,
  CAST(svm > 0 AS INT) AS svm_pred, round(1 / (1 + exp(-({GIVEN_PLATT.slope} * svm + {GIVEN_PLATT.offset}))), 6) AS svm_proba FROM tested t""")
def svm_predict_given(spark, sf_dir):
    vocab, _, test = _parts(spark, sf_dir)
    model, platt = _given(vocab)
    out = svm.svm_proba(svm.svm_predict(test, model), platt)
    return out.select("tweet_id", "y", F.round("svm_margin", 6).alias("svm_margin"), "svm_pred", F.round("svm_proba", 6).alias("svm_proba"))


@query("full_corpus_scoring_given", f"{SQL_GIVEN} SELECT model, positive, negative FROM corpus")
def full_corpus_scoring_given(spark, sf_dir):
    return score_corpus(*_trained_given(spark, sf_dir))


_DOCUMENT = [f'max({x}) FILTER (model = \'{m}\') AS {m}_{n}' for m in ("nb", "svm") for n, x in [
    *((n, f'round("{n}", 4)') for n in FIVE), *((n, n) for n in ("tn", "fp", "fn", "tp"))]]


@query("results_document_given", f"""{SQL_GIVEN}, top AS (SELECT term, round(mean, 4) AS weight FROM (
    SELECT term, round(sum(weight) / (SELECT count(*) FROM train), 12) AS mean FROM w GROUP BY term)
    ORDER BY mean DESC, term DESC LIMIT 10)
  SELECT (SELECT count(*) FROM gold) AS dataset_size, (SELECT count(*) FROM train) AS train_size, (SELECT count(*) FROM test) AS test_size,
    (SELECT count(*) FROM test WHERE label = 'positive') AS test_positive, (SELECT count(*) FROM test WHERE label = 'negative') AS test_negative,
    {', '.join(_DOCUMENT)},
    {', '.join(f"(SELECT {c} FROM corpus WHERE model = '{m}') AS {m}_full_{c}" for m in ("nb", "svm") for c in ("positive", "negative"))},
    (SELECT string_agg(term, ',' ORDER BY term) FROM top) AS top_terms, (SELECT round(sum(weight), 3) FROM top) AS top_weight FROM compared""")
def results_document_given(spark, sf_dir):
    """The nested document laid flat."""
    doc = results_document(*_trained_given(spark, sf_dir))
    flat = ["dataset_size", "train_size", "test_size", "test_positive", "test_negative"]
    for m in ("nb", "svm"):
        flat += [F.col(f"models.{m}.metrics.{n}").alias(f"{m}_{n}") for n in FIVE]
        flat += [F.col(f"models.{m}.confusion.{n}").alias(f"{m}_{n}") for n in ("tn", "fp", "fn", "tp")]
        flat += [F.col(f"models.{m}.full_pred_{n}").alias(f"{m}_full_{n}") for n in ("positive", "negative")]
    weight = F.aggregate("top_terms.weight", F.lit(0.0), lambda a, x: a + x)
    return doc.select(*flat, F.array_join(F.array_sort("top_terms.term"), ",").alias("top_terms"), F.round(weight, 3).alias("top_weight"))


def _sql_items(section: str, rows: str, items: dict[str, str], prefix: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {prefix}'{k}' AS item, CAST({v} AS VARCHAR) AS value FROM {rows}" for k, v in items.items())


_SHARES = {f"{l}_pct": f"round(100.0 * count(*) FILTER (label = '{l}') / count(*), 1)" for l in ("positive", "negative", "neutral")}


@query("evaluation_report_given", f"""{SQL_GIVEN},
  opinion AS (SELECT *, round(positive / (positive + negative) * 100, 1) AS positive_pct,
    round(negative / (positive + negative) * 100, 1) AS negative_pct,
    CASE WHEN positive > negative THEN 'positive' ELSE 'negative' END AS dominant FROM corpus),
  won AS ({sql_wins(FIVE[:4])}),
  most AS (SELECT label, round(100.0 * n / sum(n) OVER (), 1) AS pct FROM (SELECT label, count(*) AS n FROM gold_all GROUP BY label) ORDER BY n DESC LIMIT 1),
  items AS ({_sql_items('distribution', 'gold_all', {'labelled': 'count(*)', **{l: f"count(*) FILTER (label = '{l}')" for l in ('positive', 'negative', 'neutral')}, **_SHARES})}
    UNION ALL {_sql_items('distribution', 'most', {'dominant': 'label', 'dominant_pct': 'pct'})}
    UNION ALL {_sql_items('dataset', 'split', {'rows': 'count(*)', 'positive': "count(*) FILTER (label = 'positive')",
        'negative': "count(*) FILTER (label = 'negative')", 'train': 'count(*) FILTER (is_train)', 'test': 'count(*) FILTER (NOT is_train)'})}
    UNION ALL {_sql_items('metrics', 'compared', {m: f'round("{m}", 6)' for m in FIVE}, "model || '.' || ")}
    UNION ALL {_sql_items('confusion', 'compared', {m: m for m in ('tn', 'fp', 'fn', 'tp')}, "model || '.' || ")}
    UNION ALL {_sql_items('correct', 'compared', {'correct': 'tn + tp', 'total': 'tn + fp + fn + tp',
        'pct': 'round((tn + tp) / (tn + fp + fn + tp) * 100, 1)'}, "model || '.' || ")}
    UNION ALL {_sql_items('winner', 'won', {c: c for c in ('first_wins', 'second_wins', 'winner', 'accuracy_lead')})}
    UNION ALL {_sql_items('opinion', 'opinion', {c: c for c in ('positive', 'negative', 'positive_pct', 'negative_pct', 'dominant')}, "model || '.' || ")}
    UNION ALL {_sql_items('neutral', 'gold_all', {'excluded': "count(*) FILTER (label = 'neutral')"})})
  SELECT section, item, round(TRY_CAST(value AS DOUBLE), 6) AS number, CASE WHEN TRY_CAST(value AS DOUBLE) IS NULL THEN value END AS value FROM items""")
def evaluation_report_given(spark, sf_dir):
    """The report's rows, figures apart from words."""
    rows = evaluation_report(*_trained_given(spark, sf_dir))
    number = F.col("value").try_cast("double")
    return rows.select("section", "item", F.round(number, 6).alias("number"), F.when(number.isNull(), F.col("value")).alias("value"))


SQL_STAND_IN = """marked AS (SELECT d.doc_id, quality AS y, (n_chars % 100) / 50.0 - 1 + 0.4 * quality AS m
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
  sizes AS (SELECT count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS q FROM marked),
  soft AS (SELECT CAST(m AS DOUBLE) AS m, CASE WHEN y = 1 THEN (p + 1) / (p + 2) ELSE 1 / (q + 2) END AS t FROM marked, sizes)"""


@query("svm_platt_given", f"""WITH RECURSIVE {SQL_STAND_IN},
  steps AS (SELECT 0 AS i, CAST(0 AS DOUBLE) AS a, ln((p + 1) / (q + 1)) AS b FROM sizes
    UNION ALL SELECT i + 1, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab), b - (haa * gb - hab * ga) / (haa * hbb - hab * hab)
    FROM (SELECT i, a, b, sum((p - t) * m) AS ga, sum(p - t) AS gb, sum(p * (1 - p) * m * m) AS haa, sum(p * (1 - p) * m) AS hab,
            sum(p * (1 - p)) AS hbb
          FROM (SELECT i, a, b, m, t, 1 / (1 + exp(-(a * m + b))) AS p FROM steps, soft WHERE i < 12) GROUP BY i, a, b))
  SELECT round(a, 5) AS slope, round(b, 5) AS "offset" FROM steps WHERE i = 12""")
def svm_platt_given(spark, sf_dir):
    """The sigmoid fitted to margins that follow from the documents."""
    from sentispark.sources.posts import read_table

    rows = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(read_table(spark, sf_dir, "labels"), "doc_id")
    margins = rows.select(F.col("quality").alias("y"), (F.col("n_chars") % 100 / 50.0 - 1 + 0.4 * F.col("quality")).alias("svm_margin"))
    fitted = svm.platt_fit(margins)
    return spark.createDataFrame([(round(fitted.slope, 5), round(fitted.offset, 5))], "slope double, offset double")
