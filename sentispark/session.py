"""Session settings and lineage cutting shared by every job."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution merges small shuffle partitions and splits skewed join
# partitions; how many there are to begin with follows the cores (see below).
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}
#: Spark's default number of shuffle partitions, and how many a core gets where nobody set another.
SPARKS_OWN, PARTITIONS_A_CORE = "200", 4


def build_session(app: str = "sentispark", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    if session.conf.get("spark.sql.shuffle.partitions") == SPARKS_OWN:
        wanted = max(int(SPARKS_OWN), PARTITIONS_A_CORE * session.sparkContext.defaultParallelism)
        session.conf.set("spark.sql.shuffle.partitions", wanted)
    return session


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if configured is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="sentispark-")
        sc.setCheckpointDir(configured)
    return configured or sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written intermediate table."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on reliable storage, so a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def free_unreachable(spark: SparkSession) -> None:
    """Shuffle and checkpoint files of frames that nobody holds any more go now, not when the driver's heap is next full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
