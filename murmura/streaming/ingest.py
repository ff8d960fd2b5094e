"""Continuous ingest: the landing folder as a stream into the store."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from murmura.operators.scoring import prepare_lexicon
from murmura.plans.ingest import ingest_batch
from murmura.sources.landing import if_present, stream_messages
from murmura.sources.store import Store

# Fixed value: seconds between runs of a continuous ingest.
INTERVAL_SECONDS = 300


def ingest_landing(
    spark: SparkSession,
    landing: str,
    store: Store,
    checkpoint: str,
    interval_seconds: int | None = None,
    lexicon: DataFrame | None = None,
    files_per_batch: int = 1000,
    archive: str | None = None,
    joined: bool = False,
) -> StreamingQuery | None:
    """Process every landed file once. None when nothing has ever landed.

    Without an interval the query takes what is there and ends, which is the
    batch run; with one (see ``INTERVAL_SECONDS``) it goes on. The checkpoint
    remembers the files, and a batch that is run again after a failure replaces
    its own partitions, so no message is stored twice. ``archive`` is a folder
    that files move to once they are read. ``joined`` scores with a word list of any size: each
    micro-batch is joined with it as a batch (see ``operators.scoring``).
    """
    stream = if_present(lambda: stream_messages(spark, landing, files_per_batch, archive), spark, landing)
    if stream is None:
        return None
    words = prepare_lexicon(spark, lexicon, joined)

    @cache
    def query_id() -> str:
        # Names batches by the query that the checkpoint belongs to: with a new
        # checkpoint, batch 0 must not replace an older query's batch 0.
        return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]

    def store_batch(batch: DataFrame, number: int) -> None:
        ingest_batch(batch, f"{query_id()}-{number:09d}", store, words)

    writer = stream.writeStream.foreachBatch(store_batch).option("checkpointLocation", checkpoint)
    if interval_seconds is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{interval_seconds} seconds")
    return writer.start()
