"""Every registered query with SQL, against DuckDB at the smallest scale."""

import pytest

import __spark_entry__ as entry
from oracle import connect, differences

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck, ORACLES[name]) == []


def test_entry(spark):
    row = entry.entry(spark).first()
    assert (row.positive, row.negative, row.neutral) == (85, 109, 6)


def test_queries_without_sql_are_the_fitted_ones():
    from sentispark.plans import catalog  # the library's own queries, without those of optional folders

    assert set(catalog.QUERIES) - set(catalog.ORACLES) == {"svm_fit", "svm_predict", "svm_platt", "full_corpus_scoring",
                                                           "results_document", "evaluation_report"}
