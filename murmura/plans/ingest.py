"""From raw messages to stored messages and aggregates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from murmura.functions.dates import instant
from murmura.operators.aggregates import sentiment_rollup, views_from_rollup
from murmura.operators.messages import (
    DEFAULT_KEYWORDS,
    flatten_records,
    keyword_filter,
    latest_by_id,
    most_recent,
    newest_copies,
    process_messages,
)
from murmura.operators.scoring import WordList, score_sentiment
from murmura.schemas import BATCH, CORRUPT, COUNTERS, DATE
from murmura.sources import places
from murmura.sources.landing import content_name, if_present, land_messages, read_messages
from murmura.sources.store import Store, overwrite_partitions
from murmura.sources.versions import VersionLog

# Ids of a batch that may be sent to its rows: about 10 MB.
FEW_IDS = 200_000


def collect_messages(
    records: DataFrame,
    landing: str,
    keywords: Sequence[str] = DEFAULT_KEYWORDS,
    max_results: int | None = None,
) -> None:
    """Search service records and land the matches: all, or the newest ``max_results``."""
    found = keyword_filter(flatten_records(records), keywords)
    land_messages(found if max_results is None else most_recent(found, max_results), landing)


def ingest_batch(
    raw: DataFrame, batch: str, store: Store, lexicon: DataFrame | WordList | None = None
) -> list[dt.date | None]:
    """Store one batch of raw messages and bring its dates' aggregates up to date.

    Of all copies of a message, in this batch and in others, the newest one is kept; a copy
    that another batch stored before is taken out there. So the tables depend on what landed,
    not on how it was cut into batches. A message's ``created_at`` never changes, so its
    other copies are looked for among the versions of its creation times.

    A ledger names the batches that have begun. Each step replaces what the same batch wrote
    before, so running a batch again after a failure, at whatever step, ends in the same tables; only
    then is the log of versions derived anew from the raw messages of the batch's dates. Returns
    the dates the batch touched.
    """
    spark = raw.sparkSession
    log = VersionLog(spark, store)
    again = store.started(spark, batch)
    # One row per calendar date of the batch comes to the driver, to name folders.
    had = _dates(store.read_batch(spark, "raw_tweets", batch)) if again else set()
    store.note(spark, batch, finished=False)
    created = instant(F.col("created_at"))
    # Names of files are a set: read where the scan runs, they stay right if a task runs twice.
    read = Observation()
    named = raw.withColumn("_file", F.input_file_name())
    named = named.observe(read, F.size(F.collect_set("_file")).cast("long").alias("files")).drop("_file")
    stamped = named.withColumns({DATE: F.to_date(created), BATCH: F.lit(batch)})
    us = F.unix_micros(created)
    gone, seen = store.replace(stamped, "raw_tweets", [(d, batch) for d in had], {
        "rows": F.count(F.lit(1)), "broken": F.count(CORRUPT) if CORRUPT in raw.columns else F.lit(0).cast("long"),
        "dates": F.collect_set(DATE), "dateless": F.count_if(F.col(DATE).isNull()),
        "first": F.min(us), "last": F.max(us), "newest": F.max(instant(F.col("collected_at"))),
    })
    dates = set(seen["dates"]) | had | ({None} if seen["dateless"] else set())
    if not dates:
        store.note(spark, batch, finished=True, raw_rows=0, broken_rows=0, messages=0, dates=[])
        return []
    landed = store.read_batch(spark, "raw_tweets", batch, dates)
    if seen["broken"] or again:
        # Few lines, read back from the partition they were just written to.
        broken = store.read_batch(spark, "raw_tweets", batch, [None]).where(F.col(CORRUPT).isNotNull())
        lines = broken.select(F.col(CORRUPT).alias("line"), F.lit(batch).alias(BATCH))
        overwrite_partitions(lines, store.path("quarantine"), [BATCH], spread=False)
    span = None if seen["first"] is None else (seen["first"], seen["last"])
    if again:
        log.rebuild(dates)
    else:
        log.append(log.compare(landed, dates, span))
    versions = log.rows(dates, span).where(F.col(BATCH) == batch)
    won = versions.where("won").select("id")
    # Two counts and the partitions whose copies were replaced, no more than there are partitions.
    odd, repeated, replaced = versions.agg(
        F.count_if(F.expr("NOT won OR copies > 1")), F.count_if(F.expr("won AND copies > 1")),
        F.collect_set(F.when(F.col("replaced").isNotNull(), F.struct(DATE, "replaced"))),
    ).first()
    if again:
        # The log now holds the newest version of each id only, in whatever batch; what this batch has of it is counted.
        versions = (
            landed.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("copies"))
            .join(won.withColumn("won", F.lit(True)), "id", "left").fillna(False, "won")
        )
        odd, repeated = versions.agg(
            F.count_if(F.expr("NOT won OR copies > 1")), F.count_if(F.expr("won AND copies > 1"))
        ).first()
    if odd > FEW_IDS and places.fit(len(landed.inputFiles()), seen["rows"]):
        fresh = newest_by_place(landed, versions, repeated)
    else:
        fresh = newest_of_batch(landed, versions, odd, repeated)
    scored = score_sentiment(process_messages(fresh), lexicon).withColumn(BATCH, F.lit(batch))
    had_messages = _dates(store.read_batch(spark, "processed_tweets", batch, dates)) if again else set()
    _, kept = store.replace(
        scored, "processed_tweets", [(d, batch) for d in had_messages], {"rows": F.count(F.lit(1))}
    )

    # Partitions that hold a copy which is no longer the newest.
    stale, few = [], True
    if again or replaced:
        others = (
            store.read_dates(spark, "processed_tweets", dates).where(F.col(BATCH) != batch) if again
            else store.read_parts(spark, "processed_tweets", map(tuple, replaced))
        )
        older = others.join(won, "id", "left_semi")
        counted = older.groupBy(DATE, BATCH).count().collect()
        stale = [(r[DATE], r[BATCH]) for r in counted]
        few = sum(r["count"] for r in counted) <= FEW_IDS
    if stale:
        there = store.read_parts(spark, "processed_tweets", stale)
        if few:
            kept_there = there.join(F.broadcast(older.select("id")), "id", "left_anti")
        elif places.fit(len(there.inputFiles()), there.count()):
            placed = store.read_parts(spark, "processed_tweets", stale, placed=True)
            lost = placed.select("id", places.FILE, places.AT).join(won, "id", "left_semi")
            kept_there = places.without(placed, lost).drop(places.FILE, places.AT)
        else:
            kept_there = there.join(won, "id", "left_anti")
        store.replace(kept_there, "processed_tweets", stale)

    # Only these partitions' messages are read; the rollup rows of all others stand.
    changed = {*stale, *((d, batch) for d in dates)}
    written = store.read_parts(spark, "processed_tweets", changed)
    named = [*stale, *((d, batch) for d in had_messages)]
    store.replace(sentiment_rollup(written, by=[BATCH]), "sentiment_rollup", named)
    refresh_aggregates(spark, store, dates)
    log.compact(dates)
    store.note(
        spark, batch, finished=True, raw_rows=seen["rows"], broken_rows=seen["broken"], messages=kept["rows"],
        files=read.get["files"], newest_collected=seen["newest"], dates=sorted(d for d in dates if d),
    )
    return sorted(dates - {d for d, _ in gone}, key=str)


def newest_of_batch(landed: DataFrame, versions: DataFrame, odd: int, repeated: int) -> DataFrame:
    """The rows of a batch that are the newest copies of their messages; rows without an id all stay.

    ``versions`` are the batch's ids in the log. Most ids come once and are new. ``odd`` ids lost against a
    stored copy or came several times, ``repeated`` ones came several times and won. Up to ``FEW_IDS`` odd
    ids are sent to the rows, of which only the repeated ones then cross an exchange; beyond that all rows
    with an id cross one, where their copies are compared and the ids that lost are taken out.
    """
    if not odd:
        return landed
    ids = versions.where("NOT won OR copies > 1").select("id", F.col("won").alias("_won"))
    if odd <= FEW_IDS:
        ids = F.broadcast(ids)
    elif repeated:
        # Merged by sorted ids: the rows lie by id already, where their copies were compared.
        newest = newest_copies(landed).join(ids.where("NOT _won").hint("merge"), "id", "left_anti")
        return newest.unionByName(landed.where("id IS NULL"))
    rest = landed.join(ids, "id", "left_anti")
    if not repeated:
        return rest
    return rest.unionByName(latest_by_id(landed.join(ids.where("_won"), "id", "left_semi")))


def newest_by_place(landed: DataFrame, versions: DataFrame, repeated: int) -> DataFrame:
    """``newest_of_batch`` where many ids are odd: rows are told apart by their places in the batch's files.

    Ids, times, counters and places cross an exchange, the places of older copies come back as bitmaps. Only copies that
    agree in time and counters are compared as whole rows.
    """
    odd = versions.where("NOT won OR copies > 1").select("id", "won")
    marked = landed.where("id IS NOT NULL").select(
        "id", F.struct("collected_at", *COUNTERS).alias("_mark"), *places.places()
    ).join(odd.hint("shuffle_hash"), "id")
    if not repeated:
        return places.without(landed, marked)
    tops = (
        marked.where("won").groupBy("id", "_mark").agg(F.count("*").alias("_same"))
        .groupBy("id").agg(F.max(F.struct("_mark", "_same")).alias("_top"))
    )
    judged = marked.join(tops, "id", "left")
    older = F.col("_mark") < F.col("_top._mark")
    gone = judged.where(~F.col("won") | older | (F.col("_top._same") > 1))
    tied = judged.where(F.col("won") & ~older & (F.col("_top._same") > 1))
    return places.without(landed, gone).unionByName(newest_copies(places.only(landed, tied)))


def _dates(df: DataFrame) -> set[dt.date | None]:
    return {row[0] for row in df.select(DATE).distinct().collect()}


def ingest_file(
    spark: SparkSession, path: str, store: Store, lexicon: DataFrame | WordList | None = None
) -> list[dt.date | None]:
    """Store one named file or glob of landed messages; nothing there is not an error.

    The batch is named by the files it reads, so the same path with other files is another batch.
    """
    raw = if_present(lambda: read_messages(spark, path), spark, path)
    if raw is None or raw.isEmpty():
        return []
    return ingest_batch(raw, f"file-{content_name(spark, path)}", store, lexicon)


def refresh_aggregates(spark: SparkSession, store: Store, dates: Iterable[dt.date | None]) -> None:
    """Derive the three aggregates of some dates from the stored rollup and replace them.

    A date without rows in an aggregate loses the rows it had there.
    """
    rollup = store.read_dates(spark, "sentiment_rollup", dates)

    def refresh(table: str, view: DataFrame) -> None:
        had = _dates(store.read_dates(spark, table, dates))
        store.replace(view, table, [(d,) for d in had])

    # Three small jobs that do not depend on each other: let Spark run them at the same time.
    views = views_from_rollup(rollup)
    with ThreadPoolExecutor(len(views)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(refresh), t, v) for t, v in views.items()]:
            done.result()


def rebuild_aggregates(spark: SparkSession, store: Store, dates: Iterable[dt.date | None]) -> None:
    """Recompute some dates from their stored messages, rollup included."""
    messages = store.read_dates(spark, "processed_tweets", dates)
    had = store.read_dates(spark, "sentiment_rollup", dates).select(DATE, BATCH).distinct().collect()
    store.replace(sentiment_rollup(messages, by=[BATCH]), "sentiment_rollup", had)
    refresh_aggregates(spark, store, dates)
