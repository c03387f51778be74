"""Stage tables on shared storage, a partition per batch, and the rerunnable phases that fill them.

``posts_raw``, ``posts_clean`` and ``posts_labeled`` lie as ``batch=<n>``; the keys of stored posts lie by hash prefix beside
them. ``stage_log`` gets a row when a phase has finished a batch, and batches are finished in order, so what is pending
follows from the last batch of each phase and no stored text is read to find it. A phase reads the one batch it works on and
replaces whatever an earlier attempt left of it; readers see finished batches only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentispark.operators.ingest import ingest
from sentispark.operators.keystore import PREFIXES, KeyStore, add_keys
from sentispark.operators.lexicon_score import lexicon_label
from sentispark.operators.queues import wide_posts
from sentispark.plans.phases import preprocess
from sentispark.session import cut_lineage
from sentispark.sources.posts import POST_SCHEMA

RAW, CLEAN, LABELED = "posts_raw", "posts_clean", "posts_labeled"
KEYS, LOG = "posts_keys", "stage_log"
SCHEMAS = {
    RAW: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in POST_SCHEMA),
    CLEAN: "tweet_id string, cleaned_text string",
    LABELED: "tweet_id string, sentiment_score long, label string",
    LOG: "stage string, batch long, last_seq long",
}


class Progress(NamedTuple):
    """The last finished batch of a phase, -1 for none, and the greatest post number by then."""
    batch: int = -1
    last_seq: int = -1


def _read(spark: SparkSession, root: str, name: str, more: str = "") -> DataFrame:
    schema = SCHEMAS[name] + more
    try:
        return spark.read.schema(schema).parquet(f"{root}/{name}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        return spark.createDataFrame([], schema)


def progress(spark: SparkSession, root: str) -> dict[str, Progress]:
    """How far each phase is; at most a row per phase reaches the driver."""
    log = _read(spark, root, LOG).groupBy("stage").agg(F.max("batch").alias("batch"), F.max("last_seq").alias("last_seq"))
    found = {r["stage"]: Progress(r["batch"], r["last_seq"]) for r in log.collect()}
    return {name: found.get(name, Progress()) for name in (RAW, CLEAN, LABELED)}


def stage(spark: SparkSession, root: str, name: str, batch: int | None = None) -> DataFrame:
    """The finished batches of a stage table, or one of them."""
    rows = _read(spark, root, name, ", batch long")
    wanted = F.col("batch") <= progress(spark, root)[name].batch if batch is None else F.col("batch") == batch
    return rows.where(wanted).drop("batch")


def _finish(df: DataFrame, root: str, name: str, batch: int, last_seq: int | None = None) -> None:
    """Write a batch of a stage table in the place of any earlier attempt; with ``last_seq``, log it as finished."""
    df.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch}")
    if last_seq is not None:
        _log(df.sparkSession, root, name, batch, last_seq)


def _log(spark: SparkSession, root: str, name: str, batch: int, last_seq: int) -> None:
    spark.createDataFrame([(name, batch, last_seq)], SCHEMAS[LOG]).coalesce(1).write.mode("append").parquet(f"{root}/{LOG}")


def with_arrival(batch: DataFrame, after: int) -> DataFrame:
    """Number a batch without gaps, in file and row order behind ``after``.

    The rows are fixed by a checkpoint; then the rows of each run, a file block as one task read it, are counted, and a
    run's first number is what the runs before it hold. No row is sorted or shuffled. Driver and broadcast see a row per
    file block.
    """
    placed = cut_lineage(batch.withColumns({
        "_file": F.input_file_name(), "_block": F.input_file_block_start(), "_row": F.monotonically_increasing_id()}))
    run = ["_file", "_block", F.shiftright("_row", 33).alias("_task")]
    counts = placed.groupBy(*run).agg(F.count("*").alias("n"), F.min("_row").alias("first")).collect()
    begins, upto = [], after + 1
    for r in sorted(counts, key=lambda r: (r["_file"], r["_block"], r["_task"])):
        begins.append((r["_file"], r["_block"], r["_task"], upto - r["first"]))
        upto += r["n"]
    shift = batch.sparkSession.createDataFrame(begins, "_file string, _block long, _task long, _shift long")
    numbered = placed.withColumn("_task", F.shiftright("_row", 33)).join(F.broadcast(shift), ["_file", "_block", "_task"])
    return numbered.withColumn("seq", F.col("_row") + F.col("_shift")).select(*batch.columns, "seq")


def ingest_stage(batch: DataFrame, root: str, prefixes: int = PREFIXES) -> None:
    """Insert the new posts of a batch; a batch without ``seq`` is numbered on arrival."""
    spark = batch.sparkSession
    done = progress(spark, root)[RAW]
    number = done.batch + 1
    if "seq" not in batch.columns:
        batch = with_arrival(batch, done.last_seq)
    for field in POST_SCHEMA:
        if field.name not in batch.columns:
            batch = batch.withColumn(field.name, F.lit(None).cast(field.dataType))
    arrived = F.coalesce("scraped_at", F.current_timestamp().cast("timestamp_ntz"))
    keys = KeyStore(f"{root}/{KEYS}", prefixes)
    fresh = ingest(batch, None if number == 0 else keys, before=number).withColumn("scraped_at", arrived)
    _finish(fresh.select(*POST_SCHEMA.fieldNames()), root, RAW, number)
    written = stage(spark, root, RAW, number)
    add_keys(keys, written, number)
    last = written.agg(F.max("seq")).first()[0]
    _log(spark, root, RAW, number, done.last_seq if last is None else max(last, done.last_seq))


def pending(spark: SparkSession, root: str, before: str, name: str) -> Iterator[int]:
    """Batches that phase ``before`` has finished and ``name`` has not."""
    done = progress(spark, root)
    return iter(range(done[name].batch + 1, done[before].batch + 1))


def clean_stage(spark: SparkSession, root: str, stopwords: Iterable[str] = (),
                stems: DataFrame | None = None) -> None:
    stopwords = list(stopwords)
    for batch in pending(spark, root, RAW, CLEAN):
        waiting = stage(spark, root, RAW, batch).select("tweet_id", "raw_text")
        _finish(preprocess(waiting, stopwords, stems), root, CLEAN, batch, -1)


def label_stage(spark: SparkSession, root: str, lexicon: DataFrame) -> None:
    for batch in pending(spark, root, CLEAN, LABELED):
        _finish(lexicon_label(stage(spark, root, CLEAN, batch), lexicon), root, LABELED, batch, -1)


def posts(spark: SparkSession, root: str) -> DataFrame:
    """The stage tables as one row per post."""
    return wide_posts(*(stage(spark, root, n) for n in (RAW, CLEAN, LABELED)))


def run_all(batch: DataFrame, root: str, lexicon: DataFrame, stopwords: Iterable[str] = (),
            stems: DataFrame | None = None, prefixes: int = PREFIXES) -> DataFrame:
    """Ingest, clean and label a batch; returns the posts table."""
    spark = batch.sparkSession
    ingest_stage(batch, root, prefixes)
    clean_stage(spark, root, stopwords, stems)
    label_stage(spark, root, lexicon)
    return posts(spark, root)
