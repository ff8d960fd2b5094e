"""Hourly counts on a stream that late rows still reach.

``live.hourly_counts`` drops a row whose hour has closed. Here every micro-batch leaves its own counts by hour, so an hour's
figure is the sum of its parts whenever it is asked for. A row that comes after its hour was published goes to a
side table as well, and the hour is published anew. There is no state store: what the query knows lies in four
tables below one folder, each written by batch, so that a batch that runs again replaces what it wrote.

* ``parts``  counts by date, hour, label and batch;
* ``clock``  for each batch the newest ``created_at`` so far and how many rows were late;
* ``late``   the late rows themselves, by batch;
* ``hours``  the published hours: those that ended ``delay`` or longer before the newest row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from murmura.functions.dates import instant
from murmura.schemas import DATE
from murmura.sources.landing import if_present
from murmura.sources.store import overwrite_partitions

_NUMBER = "batch_number"
HOURS = f"{DATE} DATE, tweet_hour INT, sentiment_label STRING, tweet_count BIGINT"


def reconciled_hours(
    live: DataFrame, folder: str, checkpoint: str, delay_seconds: int, interval_seconds: int | None = None
) -> StreamingQuery:
    """Run a stream of scored messages into ``folder``; without an interval it takes what is there and ends."""

    def store(batch: DataFrame, number: int) -> None:
        reconcile_batch(batch, number, folder, delay_seconds)

    writer = live.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if interval_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{interval_seconds} seconds").start()


def published_hours(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, f"{folder}/hours", HOURS)


def late_rows(spark: SparkSession, folder: str) -> DataFrame | None:
    """The rows that came after their hour was published; None when there are none."""
    return if_present(lambda: spark.read.parquet(f"{folder}/late"), spark, f"{folder}/late")


def reconcile_batch(batch: DataFrame, number: int, folder: str, delay_seconds: int) -> None:
    """Add one micro-batch: its counts, its late rows, and every hour they close or change."""
    spark = batch.sparkSession
    created = instant(F.col("created_at"))
    rows = batch.where(created.isNotNull()).withColumns({DATE: F.to_date(created), "tweet_hour": F.hour(created)})
    parts = rows.groupBy(DATE, "tweet_hour", "sentiment_label").agg(
        F.count("*").alias("tweet_count"), F.max(F.unix_micros(created)).alias("newest")
    )
    seen = overwrite_partitions(
        parts.withColumn(_NUMBER, F.lit(number)), f"{folder}/parts", [DATE, _NUMBER],
        {"newest": F.max("newest"), "dates": F.collect_set(DATE)},
    )
    before = _clock(spark, folder, number)
    after = max((t for t in (before, seen["newest"]) if t is not None), default=None)
    closed_before = None if before is None else before - delay_seconds * 1_000_000
    late = 0
    if closed_before is not None:
        late = _set_aside(rows, number, folder, closed_before)
    clock = spark.createDataFrame([(after, late, number)], f"newest LONG, late LONG, {_NUMBER} INT")
    overwrite_partitions(clock, f"{folder}/clock", [_NUMBER])
    if after is not None:
        # The dates of this batch, and those in which hours closed since the one before.
        closed = after - delay_seconds * 1_000_000
        dates = set(seen["dates"])
        if closed_before is not None:
            first, last = _day(closed_before), _day(closed)
            dates |= {first + dt.timedelta(days=i) for i in range((last - first).days + 1)}
        publish_hours(spark, folder, dates, closed)


def publish_hours(spark: SparkSession, folder: str, dates: set[dt.date], closed: int) -> None:
    """Replace the published hours of some dates by the sums of their parts; open hours stay out."""
    listed = ",".join(sorted(d.isoformat() for d in dates))
    parts = _read(
        spark, f"{folder}/parts/{DATE}={{{listed}}}", f"{HOURS}, newest BIGINT, {_NUMBER} INT", f"{folder}/parts"
    )
    hours = parts.where(_hour_end() <= F.lit(closed)).groupBy(DATE, "tweet_hour", "sentiment_label").agg(
        F.sum("tweet_count").alias("tweet_count")
    )
    overwrite_partitions(hours, f"{folder}/hours", [DATE])


def _set_aside(rows: DataFrame, number: int, folder: str, closed: int) -> int:
    """Write the rows of closed hours to the side table; their number."""
    late = rows.where(_hour_end() <= F.lit(closed)).withColumn(_NUMBER, F.lit(number))
    seen = overwrite_partitions(late, f"{folder}/late", [_NUMBER], {"rows": F.count(F.lit(1))}, spread=False)
    return seen["rows"]


def _hour_end():
    """When the hour of a row ends, in microseconds."""
    return F.unix_micros(F.col(DATE).cast("timestamp")) + (F.col("tweet_hour") + 1).cast("long") * 3_600_000_000


def _day(micros: int) -> dt.date:
    return dt.date(1970, 1, 1) + dt.timedelta(days=micros // 86_400_000_000)


def _clock(spark: SparkSession, folder: str, number: int) -> int | None:
    """The newest ``created_at`` of all batches before this one; each batch's row holds it for those up to it."""
    found = _read(spark, f"{folder}/clock/{_NUMBER}={number - 1}", "newest LONG, late LONG").select("newest").collect()
    return found[0]["newest"] if found else None


def _read(spark: SparkSession, path: str, schema: str, base: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema)
    if base is not None:
        reader = reader.option("basePath", base)
    found = if_present(lambda: reader.parquet(path), spark, path)
    return spark.createDataFrame([], schema) if found is None else found
