"""What the plans must and must not contain."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from sentispark.plans import catalog, inputs as ip
from sentispark.operators import dedup, reports
from sentispark.session import cut_lineage

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
PROJECTIONS = ("clean_text", "preprocess_full", "remove_stopwords_general", "stage_trace", "lexicon_score",
               "vectorizer_tokens", "ngrams_1_2", "url_derive")
OWN = set(catalog.QUERIES)
#: All but those that fit a model or run a stream before they return; these are checked through the jobs they share.
LAZY = sorted(n for n in OWN if not ("svm" in n or "nb_" in n or n.endswith("_given") or n in (
    "incremental_ingest", "incremental_clean_label", "results_document", "evaluation_report", "full_corpus_scoring", "full_corpus_scoring_nb")))


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow",
                 "FlatMapGroupsInArrow", "FlatMapGroupsInPandas", "InMemoryTableScan"):
        assert word not in plan, word


@pytest.mark.parametrize("name", PROJECTIONS)
def test_text_work_needs_no_shuffle(spark, name):
    """Only the spreading of a small file by id may appear."""
    exchanges = re.findall(r"Arguments: (hashpartitioning|rangepartitioning|SinglePartition)[^\n]*", plan_of(
        QUERIES[name](spark, SF)))
    assert len(exchanges) <= 1


def test_scan_reads_needed_columns_only(spark):
    plan = plan_of(reports.keyword_counts(ip.posts(spark, SF)))
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan or "ReadSchema: struct<lang:string>" in plan
    filtered = plan_of(ip.posts(spark, SF).where("keyword = 'en'").select("tweet_id"))
    assert "EqualTo(lang,en)" in filtered


def test_top_words_cut_before_the_shuffle(spark):
    plan = plan_of(reports.top_words(ip.wide(spark, SF)))
    assert plan.count("WindowGroupLimit") >= 2


def test_cleaning_appears_once_below_generated_rows(spark):
    plan = plan_of(QUERIES["vocabulary_topk"](spark, SF))
    assert "size(" not in "".join(l for l in plan.splitlines() if l.startswith("Condition"))


def test_dedup_rounds_need_no_python(spark, monkeypatch):
    """Every frame that the rounds materialise, not only the last plan."""
    plans = []
    monkeypatch.setattr(dedup, "cut_lineage", lambda df: plans.append(plan_of(df)) or cut_lineage(df))
    rows = spark.range(60).selectExpr("id AS seq", "concat('i', id div 2) AS tweet_id", "concat('t', (id + 1) div 2) AS raw_text")
    assert dedup.dedup_first_wins(rows).count() == 30
    assert len(plans) > 5 and not any(word in plan for plan in plans for word in ("Arrow", "Python", "Pandas", "NestedLoop", "Cartesian"))


def test_dashboard_reads_the_posts_twice(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(reports, "cut_lineage", lambda df: plans.append(plan_of(df)) or cut_lineage(df))
    out = plan_of(QUERIES["dashboard_blocks"](spark, SF))
    assert len(plans) == 2 and "FileScan" not in out and "Scan parquet" not in out and "InMemory" not in out
    assert all(len(re.findall(r"\) Scan parquet", plan)) == 1 for plan in plans)
