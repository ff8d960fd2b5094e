"""How far a running ingest is behind: its progress, batch by batch, kept as a table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from murmura.schemas import BATCH, PROGRESS
from murmura.sources.landing import if_present
from murmura.sources.store import INTERNAL, Store, overwrite_partitions


def record_progress(query: StreamingQuery, store: Store) -> None:
    """Write what a query reports of its last batches (Spark keeps a hundred) to ``stream_progress``.

    A batch has a partition of its own, so recording it twice changes nothing.
    """
    spark = SparkSession.active()
    rows = [
        (
            p.batchId, dt.datetime.fromisoformat(p.timestamp), p.numInputRows,
            p.durationMs.get("triggerExecution", 0) / 1000.0, f"{p.id}-{p.batchId:09d}",
        )
        for p in query.recentProgress
        if p.numInputRows
    ]
    schema, keys = INTERNAL["stream_progress"]
    if rows:
        overwrite_partitions(spark.createDataFrame(rows, schema), store.path("stream_progress"), keys)


def stream_lag(spark: SparkSession, store: Store, landing: str) -> DataFrame:
    """One row per recorded batch: rows and files read, seconds taken, and the files left to read after it.

    Files come from the ledger, which the ingest writes with the batch, so a batch is
    counted once however often it ran. The landing folder is listed; no file is opened.
    """
    files = if_present(lambda: spark.read.format("binaryFile").load(landing), spark, landing)
    landed = F.lit(0).cast("long") if files is None else files.agg(F.count("*")).scalar()
    # A query's batches in order; a stream has few thousands of rows here, one a batch.
    query = F.regexp_replace(BATCH, "-[0-9]+$", "")
    so_far = Window.partitionBy(query).orderBy("batch_number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ledger = store.read(spark, "ingest_batches").select(BATCH, "files", "raw_rows", "newest_collected")
    return (
        store.read(spark, "stream_progress").join(ledger, BATCH)
        .withColumn("backlog_files", landed - F.sum("files").over(so_far))
        .select(
            query.alias("query_id"), "batch_number", "started", "input_rows", "raw_rows", "files", "backlog_files",
            "batch_seconds", F.try_divide("input_rows", "batch_seconds").alias("rows_per_second"), "newest_collected",
        )
    )
