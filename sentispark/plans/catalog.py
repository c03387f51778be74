"""The registry of queries with the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def load_all() -> None:
    from sentispark.plans import (queries_evaluate, queries_features, queries_ingest,  # noqa: F401
                                  queries_lexicon, queries_models, queries_reports, queries_text)
