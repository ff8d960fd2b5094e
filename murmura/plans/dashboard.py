"""CSV extracts for dashboards, and the whole run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from murmura.functions.dates import AsOf
from murmura.operators import serving
from murmura.operators.messages import DEFAULT_KEYWORDS
from murmura.plans.ingest import collect_messages
from murmura.sources.store import Store, write_csv
from murmura.streaming.ingest import ingest_landing
from murmura.streaming.lag import record_progress


def refresh_dashboard(spark: SparkSession, store: Store, out: str, as_of: AsOf = None) -> None:
    """The short extract: a week of trends and the summary."""
    trends = serving.sentiment_trends(store.read(spark, "daily_sentiment"), as_of=as_of)
    write_csv(trends, f"{out}/sentiment_trends", single_file=True)
    _write_summary(spark, store, out, as_of)


def export_extracts(spark: SparkSession, store: Store, out: str, as_of: AsOf = None) -> None:
    """The full extract: a month of trends, a week of hours, the summary."""
    trends = serving.sentiment_trends(
        store.read(spark, "daily_sentiment"), serving.EXTRACT_DAYS, as_of
    )
    write_csv(trends, f"{out}/sentiment_trends", single_file=True)
    hourly = serving.hourly_trends_recent(store.read(spark, "hourly_sentiment"), as_of=as_of)
    if not hourly.isEmpty():
        write_csv(hourly, f"{out}/hourly_trends", single_file=True)
    _write_summary(spark, store, out, as_of)


def export_dataset(
    spark: SparkSession, store: Store, out: str, as_of: AsOf = None
) -> DataFrame:
    """The main dashboard dataset, written and returned."""
    dataset = serving.dashboard_dataset_from_rollup(
        store.read(spark, "sentiment_rollup"), as_of=as_of
    )
    write_csv(dataset, f"{out}/main_sentiment_data", single_file=True)
    return dataset


def _write_summary(spark: SparkSession, store: Store, out: str, as_of: AsOf) -> None:
    summary = serving.summary_from_rollup(store.read(spark, "sentiment_rollup"), as_of)
    write_csv(serving.summary_stats(summary), f"{out}/summary_stats", single_file=True)


def run_all(
    records: DataFrame,
    landing: str,
    store: Store,
    checkpoint: str,
    out: str,
    keywords: Sequence[str] = DEFAULT_KEYWORDS,
    max_results: int | None = None,
    as_of: AsOf = None,
    lexicon: DataFrame | None = None,
    joined: bool = False,
) -> None:
    """Collect, ingest what has landed, refresh the dashboard."""
    spark = records.sparkSession
    collect_messages(records, landing, keywords, max_results)
    query = ingest_landing(spark, landing, store, checkpoint, lexicon=lexicon, joined=joined)
    if query is not None:
        query.awaitTermination()
        record_progress(query, store)
    refresh_dashboard(spark, store, out, as_of)
