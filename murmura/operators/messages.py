"""Raw messages to processed messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.functions.dates import instant
from murmura.functions.text import any_keyword
from murmura.functions.measures import counter
from murmura.schemas import BATCH, COUNTERS, DATE

# Search defaults, the language kept, the mark of a re-post.
DEFAULT_KEYWORDS = ["technology", "ai", "machine learning"]
DEFAULT_MAX_RESULTS = 100
LANGUAGE = "en"
REPOST_PREFIX = "RT @"


def flatten_records(records: DataFrame) -> DataFrame:
    """Nested service records to flat raw messages, stamped with the collection time."""
    return records.select(
        "id", "text", "created_at", "author_id", "lang",
        *[F.col(f"public_metrics.{c}").alias(c) for c in COUNTERS],
        F.current_timestamp().alias("collected_at"),
    )


def keyword_filter(messages: DataFrame, keywords: Sequence[str] = DEFAULT_KEYWORDS) -> DataFrame:
    """Messages that contain any of the keywords."""
    return messages.where(any_keyword(F.col("text"), keywords))


def most_recent(messages: DataFrame, n: int = DEFAULT_MAX_RESULTS) -> DataFrame:
    """The ``n`` newest messages (each task keeps its own top n, then one merge)."""
    return messages.orderBy(F.desc("created_at"), F.asc("id")).limit(n)


def process_messages(raw: DataFrame, language: str = LANGUAGE) -> DataFrame:
    """Typed messages in one language without re-posts, with date and hour.

    Unreadable counters and times become NULL. Both filters read stored columns
    only, so on Parquet they are pushed into the scan.
    """
    kept = raw.where(
        (F.col("lang") == language) & ~F.startswith(F.col("text"), F.lit(REPOST_PREFIX))
    )
    created = instant(F.col("created_at"))
    return kept.select(
        F.col("id").cast("string").alias("id"),
        "text",
        created.alias("created_at"),
        F.col("author_id").cast("string").alias("author_id"),
        "lang",
        *[counter(F.col(c)).alias(c) for c in COUNTERS],
        instant(F.col("collected_at")).alias("collected_at"),
        F.current_timestamp().alias("processed_at"),
        F.to_date(created).alias(DATE),
        F.hour(created).alias("tweet_hour"),
    )


def latest_by_id(messages: DataFrame, version: str = "collected_at", narrow_first: bool = False) -> DataFrame:
    """One row per id, the latest collected; rows without an id are all kept.

    Copies of one time are told apart by their counters, then by the other columns, so
    ties have one answer. The maximum is a partial aggregate: the copies of a hot id
    collapse before the one exchange. Rows without an id never take part in it.

    With ``narrow_first`` the newest copies are found on ids, times and counters. The rows
    are then filtered, which Spark does below the joins and projections that make them: for
    messages joined from narrow rows and texts, no message's text crosses an exchange, save
    for copies that agree in time and counters. The rows are read three times, so their
    source has to give the same rows each time.
    """
    if narrow_first:
        kept, tied = _newest_and_tied(messages, version)
        return kept.unionByName(newest_copies(tied, version))
    return newest_copies(messages, version).unionByName(messages.where("id IS NULL"))


def _newest_and_tied(messages: DataFrame, version: str) -> tuple[DataFrame, DataFrame]:
    """Rows that are the newest of their id by time and counters alone, and newest ones that agree in these.

    The conditions are subqueries, not joins: a filter moves below projections that compute columns, a join does not.
    """
    names = [version, *[c for c in COUNTERS if c in messages.columns and c != version]]
    several = (
        # Other names than the messages have, so that the conditions' outer columns are theirs.
        messages.where("id IS NOT NULL").select(F.col("id").alias("_id"), F.struct(*names).alias("_mark"))
        .groupBy("_id", "_mark").agg(F.count("*").alias("_same"))
        .groupBy("_id").agg(F.max(F.struct("_mark", "_same")).alias("_top"), F.sum("_same").alias("_copies"))
        .where("_copies > 1")
        .select("_id", F.col("_top._mark").alias("_newest"), (F.col("_top._same") > 1).alias("_tied"))
    )
    own = F.col("_id") == F.col("id").outer()
    older = F.struct(*[F.col(c).outer().alias(c) for c in names]) < F.col("_newest")
    kept = messages.where(~several.where(own & (older | F.col("_tied"))).exists())
    return kept, messages.where(several.where(own & ~older & F.col("_tied")).exists())


def newest_copies(messages: DataFrame, version: str = "collected_at") -> DataFrame:
    """The rows with an id of ``latest_by_id``, dealt out by id."""
    counts = [c for c in COUNTERS if c in messages.columns and c != version]
    rest = [c for c in messages.columns if c not in ("id", version, *counts)]
    return (
        messages.where("id IS NOT NULL").groupBy("id")
        .agg(F.max(F.struct(version, *counts, *rest)).alias("newest"))
        .select("id", *[F.col("newest")[c].alias(c) for c in messages.columns if c != "id"])
        .select(*messages.columns)
    )


def newest_batches(versions: DataFrame, ids: DataFrame, batch: str = BATCH) -> DataFrame:
    """For each of the ids, the batch that holds its newest stored copy.

    ``versions`` are stored raw rows; only ids, times and counters are read. Copies that
    agree in these are one version, which belongs to the batch with the larger name, so
    the answer depends neither on the order of batches nor on their size.
    """
    named = ids.select("id").where("id IS NOT NULL").distinct()
    return (
        versions.select("id", "collected_at", *COUNTERS, batch)
        .join(named, "id", "left_semi")
        .groupBy("id")
        .agg(F.max(F.struct("collected_at", *COUNTERS, batch)).alias("newest"))
        .select("id", F.col("newest")[batch].alias(batch))
    )
