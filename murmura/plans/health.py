"""Freshness of the data and the health report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.schemas import BATCH
from murmura.sources.landing import newest_file_time
from murmura.sources.store import Store, write_json_report

# Fixed value: data older than this many seconds is stale.
STALE_AFTER_SECONDS = 3600


def _now(as_of: dt.datetime | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def _judge(newest: DataFrame, as_of: dt.datetime | None, limit: int) -> DataFrame:
    micros = F.unix_micros(_now(as_of)) - F.unix_micros(F.col("newest").cast("timestamp"))
    age = micros / F.lit(1e6)
    return newest.select("newest", age.alias("age_seconds")).select(
        "*", F.coalesce(F.col("age_seconds") <= limit, F.lit(False)).alias("is_fresh")
    )


def landing_freshness(
    spark: SparkSession,
    landing: str,
    as_of: dt.datetime | None = None,
    limit: int = STALE_AFTER_SECONDS,
) -> DataFrame:
    """Age of the newest landed file. No file, or no folder, is not fresh."""
    return _judge(newest_file_time(spark, landing), as_of, limit)


def message_freshness(
    messages: DataFrame, as_of: dt.datetime | None = None, limit: int = STALE_AFTER_SECONDS
) -> DataFrame:
    """Age of the newest collected message."""
    return _judge(messages.agg(F.max("collected_at").alias("newest")), as_of, limit)


def health_report(
    spark: SparkSession,
    landing: str,
    store: Store,
    as_of: dt.datetime | None = None,
    limit: int = STALE_AFTER_SECONDS,
) -> DataFrame:
    """One row: freshness of the landing folder and the size of the stored tables.

    Sizes come from what the ingest noted: the ledger has a batch's raw rows as it wrote them, the rollup the
    stored messages by hour and label. No message is read or counted again. Batches that were stored before
    there was a ledger are not in its sum.
    """
    fresh = landing_freshness(spark, landing, as_of, limit).select(
        _now(as_of).alias("timestamp"),
        F.col("newest").alias("newest_file"),
        "age_seconds",
        F.col("is_fresh").alias("data_freshness"),
    )
    noted = {
        "raw_tweets_rows": store.read(spark, "ingest_batches").agg(F.coalesce(F.sum("raw_rows"), F.lit(0))),
        "processed_tweets_rows": store.read(spark, "sentiment_rollup").agg(F.coalesce(F.sum("messages"), F.lit(0))),
    }
    return fresh.withColumns({name: rows.scalar() for name, rows in noted.items()})


def batch_report(spark: SparkSession, store: Store) -> DataFrame:
    """One row per ingest batch: whether it ended, and what it read, could not read and kept."""
    return store.read(spark, "ingest_batches").select(
        BATCH, "finished", "raw_rows", "broken_rows", "messages", "newest_collected", F.size("dates").alias("dates")
    )


def save_health_report(report: DataFrame, folder: str) -> None:
    write_json_report(report, folder)
