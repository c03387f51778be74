"""The four phases as whole plans: ingest, clean, label, train."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentispark.functions import text as tx
from sentispark.functions.sentiment import binary_label
from sentispark.operators import bayes, evaluate, svm
from sentispark.operators.features import MAX_FEATURES, Tfidf, fit_tfidf, tfidf
from sentispark.operators.lexicon_score import lexicon_label
from sentispark.operators.lookup import replace_words
from sentispark.operators.queues import clean_queue, label_queue, training_set
from sentispark.operators.split import SEED, TEST_SIZE, stratified_split
from sentispark.session import cut_lineage

MIN_ROWS = 10


def preprocess(posts: DataFrame, stopwords: Iterable[str] = (), stems: DataFrame | None = None,
               custom: Iterable[str] = tx.CUSTOM_STOPWORDS, key: str = "tweet_id",
               raw: str = "raw_text") -> DataFrame:
    """(key, cleaned_text): clean, drop general and custom stop words, stem.

    Both word lists are dropped before stemming, so affixed forms survive.
    Without a stem table, or with a small one, this is one projection of the scan.
    """
    words = tx.without_words(tx.tokens(tx.clean_text(raw)), {*stopwords, *custom})
    cleaned = posts.select(key, tx.join_words(words).alias("cleaned_text"))
    return cleaned if stems is None else replace_words(cleaned, key, "cleaned_text", stems)


def stage_trace(posts: DataFrame, stopwords: Iterable[str], stems: DataFrame, key: str = "tweet_id",
                raw: str = "raw_text") -> DataFrame:
    """The text after every stage."""
    folded = posts.select(key, raw, tx.case_fold(raw).alias("folded"))
    bare = folded.withColumn("no_urls", tx.strip_urls("folded"))
    bare = bare.withColumn("no_tags", tx.strip_tags("no_urls"))
    letters = bare.withColumn("letters", tx.letters_only("no_tags"))
    cleaned = letters.withColumn("cleaned", F.trim("letters"))
    general = cleaned.withColumn(
        "no_stopwords", tx.join_words(tx.without_words(tx.tokens("cleaned"), stopwords)))
    custom = general.withColumn(
        "no_custom", tx.join_words(tx.without_words(tx.tokens("no_stopwords"), tx.CUSTOM_STOPWORDS)))
    return replace_words(custom.withColumn("stemmed", F.col("no_custom")), key, "stemmed", stems)


def run_clean(posts: DataFrame, stopwords: Iterable[str] = (), stems: DataFrame | None = None) -> DataFrame:
    """Clean what waits in the clean queue; a rerun finds nothing to do."""
    return preprocess(clean_queue(posts), stopwords, stems)


def run_label(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Label what waits in the label queue."""
    return lexicon_label(label_queue(posts), lexicon)


class Training(NamedTuple):
    vocab: Tfidf
    nb: bayes.NaiveBayes
    svm: svm.Linear
    platt: svm.Platt
    train_size: int
    test_size: int
    train: DataFrame    # tweet_id, y, features
    scored: DataFrame   # test rows: model, id, y, pred, score
    comparison: DataFrame


def both_models(vectors: DataFrame, fitted: Training | tuple) -> DataFrame:
    nb_model, svm_model = fitted[1], fitted[2]
    return svm.svm_predict(bayes.nb_predict(vectors, nb_model), svm_model)


def long_scores(predicted: DataFrame, id_col: str = "tweet_id") -> DataFrame:
    """Predictions of both models as (model, id, y, pred, score) rows."""
    return predicted.select(F.inline_outer(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(id_col).alias("id"), F.col("y"),
                 F.col(f"{m}_pred").alias("pred"), F.col(f"{m}_proba").alias("score"))
        for m in ("nb", "svm")])))


def run_train(posts: DataFrame, test_size: float = TEST_SIZE, max_features: int = MAX_FEATURES,
              seed: int = SEED, given: Callable[[Tfidf], tuple[svm.Linear, svm.Platt]] | None = None) -> Training | None:
    """Fit and compare both models on the labelled posts; None below ten rows.

    The training rows, the training vectors and the scores are written once and all passes read them; what reaches the driver is the vocabulary, two weight vectors and counts. ``given`` makes the second model from the
    vocabulary, for a model fitted elsewhere.
    """
    data = cut_lineage(training_set(posts))
    sizes = data.count()
    if sizes < MIN_ROWS:
        return None
    split = stratified_split(data, test_size=test_size, seed=seed)
    labelled = split.withColumn("y", binary_label(F.col("label")))
    train_text = labelled.where("is_train")
    vocab = fit_tfidf(train_text, max_features)
    keep = ["tweet_id", "y", "features"]
    train = cut_lineage(tfidf(train_text, vocab).select(*keep))
    nb_model = bayes.nb_fit(train)
    if given is None:
        with ThreadPoolExecutor(1) as beside:  # a solver step leaves cores idle, so the folds are fitted meanwhile
            whole = beside.submit(inheritable_thread_target(train.sparkSession)(svm.svm_fit), train)
            platt = svm.platt_fit(svm.held_out_margins(train))
            svm_model = whole.result()
    else:
        svm_model, platt = given(vocab)
    test = tfidf(labelled.where(~F.col("is_train")), vocab).select(*keep)
    predicted = svm.svm_proba(both_models(test, (vocab, nb_model, svm_model)), platt)
    scored = cut_lineage(long_scores(predicted))
    return Training(vocab, nb_model, svm_model, platt, vocab.n_docs, sizes - vocab.n_docs,
                    train, scored, evaluate.model_comparison(scored))


def score_corpus(posts: DataFrame, fitted: Training) -> DataFrame:
    """Predicted class counts of both models over all labelled rows, neutral ones included."""
    rows = training_set(posts, exclude_neutral=False)
    predicted = both_models(tfidf(rows, fitted.vocab), fitted)
    counts = predicted.agg(*[F.count_if(F.col(f"{m}_pred") == p).alias(f"{m}_{p}")
                             for m in ("nb", "svm") for p in (1, 0)])
    return counts.select(F.inline_outer(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(f"{m}_1").alias("positive"), F.col(f"{m}_0").alias("negative"))
        for m in ("nb", "svm")])))
