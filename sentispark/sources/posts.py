"""The posts table: schema, readers and views over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POST_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType(), False),
    T.StructField("tweet_id", T.StringType(), False),
    T.StructField("username", T.StringType(), False),
    T.StructField("created_at", T.StringType(), False),
    T.StructField("raw_text", T.StringType(), False),
    T.StructField("keyword", T.StringType(), False),
    T.StructField("tweet_url", T.StringType(), True),
    T.StructField("reply_to_id", T.StringType(), True),
    T.StructField("scraped_at", T.TimestampNTZType(), True),
])
REQUIRED = ("tweet_id", "username", "created_at", "raw_text", "keyword")
OPTIONAL = ("tweet_url", "reply_to_id")

FORMATS = ("json", "parquet", "csv", "orc")


def scan_posts(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Read a landed batch with the declared schema; missing optional fields come back null."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}, expected one of {FORMATS}")
    reader = spark.read.schema(POST_SCHEMA).options(**options)
    if fmt == "csv":
        reader = reader.options(header=True, multiLine=True, escape='"')
    return reader.format(fmt).load(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_table_stream(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType) -> DataFrame:
    """A given table as a stream, be it one file or a folder of files.

    The bracket makes the path a pattern that matches itself: a stream takes a plain path for a folder.
    """
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread rows on ``key`` when there are fewer splits than cores, else leave them.

    A large table brings more splits than cores and is read as it is; a single
    small file would otherwise run all text work in one task. Aggregates by the
    same key need no shuffle of their own afterwards.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def literal_table(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A short parameter list as a table that lives in the plan."""
    def sql(v) -> str:
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else str(v)

    values = ", ".join("(" + ", ".join(sql(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def _minutes_after_start(n):
    return F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval(mins=n)


def _iso(ts):
    return F.regexp_replace(ts.cast("string"), " ", "T")


def posts_from_documents(docs: DataFrame) -> DataFrame:
    """Posts view of the documents table, with every link state present."""
    arrived = _minutes_after_start(F.col("doc_id"))
    third = F.col("doc_id") % 3
    return docs.select(
        F.col("doc_id").alias("seq"),
        F.col("doc_id").cast("string").alias("tweet_id"),
        F.col("source").alias("username"),
        _iso(arrived).alias("created_at"),
        F.col("text").alias("raw_text"),
        F.col("lang").alias("keyword"),
        F.when(third == 1, F.lit(""))
         .when(third == 2, F.concat(F.lit("https://example.org/p/"), F.col("doc_id").cast("string")))
         .alias("tweet_url"),
        F.lit(None).cast("string").alias("reply_to_id"),
        arrived.alias("scraped_at"),
    )


def posts_from_conversations(turns: DataFrame) -> DataFrame:
    """Posts view of the conversations table; every turn after the first is a reply."""
    seq = F.shiftleft(F.col("conv_id"), 32) + F.col("turn")  # room for any number of turns
    arrived = _minutes_after_start(F.col("conv_id") * 1000 + F.col("turn"))
    return turns.select(
        seq.alias("seq"),
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("tweet_id"),
        F.col("role").alias("username"),
        _iso(arrived).alias("created_at"),
        F.col("text").alias("raw_text"),
        F.lit("conv").alias("keyword"),
        F.lit(None).cast("string").alias("tweet_url"),
        F.when(F.col("turn") > 0,
               F.concat_ws("-", F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string")))
         .alias("reply_to_id"),
        arrived.alias("scraped_at"),
    )
