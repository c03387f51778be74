"""Incremental runs: clean and label what arrived, insert what is new.

Both jobs run the batch plans on each micro-batch and write the result under
its batch id, so a batch repeated after a failure replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from sentispark.operators.dedup import dedup_first_wins
from sentispark.operators.ingest import insert_new, valid_posts, with_url
from sentispark.operators.keystore import PREFIXES, KeyStore, add_keys
from sentispark.operators.lexicon_score import with_sentiment
from sentispark.session import cut_lineage
from sentispark.sources.posts import POST_SCHEMA, spread

BATCH = "batch"


def read_post_stream(spark: SparkSession, path: str, fmt: str = "json",
                     max_files: int = 1000) -> DataFrame:
    return (spark.readStream.schema(POST_SCHEMA).option("maxFilesPerTrigger", max_files)
            .format(fmt).load(path))


def _start(stream: DataFrame, checkpoint: str, handler: Callable[[DataFrame, int], None]) -> StreamingQuery:
    writer: DataStreamWriter = stream.writeStream.foreachBatch(handler)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _replace_batch(df: DataFrame, out: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{out}/{BATCH}={batch_id}")


def clean_and_label(stream: DataFrame, out: str, checkpoint: str, lexicon: DataFrame,
                    clean: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Append (tweet_id, cleaned_text, sentiment_score, label) of newly arrived posts.

    ``clean`` is a batch plan from posts to (tweet_id, cleaned_text). No state
    is kept: a post is labelled from its own text.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        _replace_batch(with_sentiment(clean(spread(batch, "tweet_id")), lexicon), out, batch_id)

    return _start(stream, checkpoint, handle)


def stored(spark: SparkSession, out: str) -> DataFrame:
    """What the runs have written so far, with the batch id as a column."""
    return spark.read.parquet(out)


def ingest_stream(stream: DataFrame, rows_out: str, keys_out: str, checkpoint: str,
                  prefixes: int = PREFIXES) -> StreamingQuery:
    """Insert new posts batch by batch under the two-key rule.

    The ids and text digests of inserted rows go to a key store under ``keys_out``, so a batch reads no stored texts, and
    of the stored keys those that share a hash prefix with its own. A batch competes with the batches
    before it only, not with output of its own earlier attempt, so repeating it
    gives the same rows.
    """
    keys = KeyStore(keys_out, prefixes)

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = valid_posts(batch)
        fresh = dedup_first_wins(rows) if batch_id == 0 else insert_new(keys, rows, before=batch_id)
        fresh = cut_lineage(with_url(fresh))
        _replace_batch(fresh, rows_out, batch_id)
        add_keys(keys, fresh, batch_id)

    return _start(stream, checkpoint, handle)
