"""Writers. Report-sized results get one file, everything else is written by all tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, mode: str = "errorifexists",
                partition_by: str | None = None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "errorifexists") -> None:
    """CSV with a header row; quotes are doubled, line breaks inside a field are kept.

    ``single_file`` is for reports of a few rows only.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).csv(path, header=True, escape='"', quoteAll=False, emptyValue="")


def write_json(df: DataFrame, path: str, single_file: bool = False, mode: str = "errorifexists") -> None:
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).json(path, ignoreNullFields=False)
