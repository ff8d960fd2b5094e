"""Which copy of a message is the newest: a log of versions, bucketed by id.

The log has a row for every id of every batch: times and counters of its newest copy there, and whether that was the
newest of all when it came, and in place of which batch's. It is an external table of the session's catalog, because only a table carries
buckets: a batch is dealt out by id once and meets the log where that lies, without an exchange of it. Files are
sorted by creation time, and a batch reads only the creation times it holds itself, so what it reads grows
with its own span, not with the day. Rows are appended; the newest version of an id is the largest one.

Nothing is lost if the log is: raw messages hold everything, and ``rebuild`` derives it from them.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.functions.dates import instant
from murmura.schemas import BATCH, COUNTERS, DATE, VERSIONS
from murmura.sources.landing import exists
from murmura.sources.store import Store

#: Files of one date and bucket before they are merged.
MOST_FILES = 32
#: What makes a version: later ones are larger. The batch's name decides between equal copies.
VERSION = ["collected_at", *COUNTERS, BATCH]


class VersionLog:
    """The log of one store, declared in the session's catalog."""

    def __init__(self, spark: SparkSession, store: Store):
        self.spark, self.store = spark, store
        self.path = store.path(f"message_versions_{store.id_buckets}")
        self.table = f"murmura_versions_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}"
        self._declare()
        if not exists(spark, f"{self.path}_ready"):
            # A store that may have been filled before it had this log: derive the whole of it once.
            if exists(spark, store.path("raw_tweets")):
                self.rebuild(None)
            spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.path}_ready")
        self._mend()

    def _declare(self) -> None:
        if self.spark.catalog.tableExists(self.table):
            return
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in VERSIONS.fields)
        self.spark.sql(
            f"CREATE TABLE {self.table} ({columns}) USING parquet PARTITIONED BY ({DATE}) "
            f"CLUSTERED BY (id) SORTED BY (created_us) INTO {self.store.id_buckets} BUCKETS LOCATION '{self.path}'"
        )
        if exists(self.spark, self.path):
            self.spark.catalog.recoverPartitions(self.table)

    def rows(self, dates: Iterable[dt.date | None], span: tuple[int, int] | None = None) -> DataFrame:
        """The log of some dates; with ``span`` only versions created in it (microseconds, both ends included)."""
        dates = set(dates)
        self._find(dates)
        days = sorted(d for d in dates if d is not None)
        wanted = F.col(DATE).isin(days) if days else F.lit(False)
        created = F.lit(True) if span is None else F.col("created_us").between(*span)
        if None in dates:
            wanted, created = wanted | F.col(DATE).isNull(), created | F.col("created_us").isNull()
        return self.spark.table(self.table).where(wanted & created)

    def _find(self, dates: set) -> None:
        """Let the catalog know partitions that another session may have added."""
        parts = " ".join(f"PARTITION ({_named(d)})" for d in sorted(dates, key=str))
        if parts:
            self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS {parts}")
            self.spark.catalog.refreshTable(self.table)

    def own(self, landed: DataFrame) -> DataFrame:
        """One row per id of a batch: its newest copy, dealt out as the log is."""
        return (
            landed.where("id IS NOT NULL")
            .select("id", created_us().alias("created_us"), "collected_at", *COUNTERS, BATCH, DATE)
            .repartition(self.store.id_buckets, "id")
            .groupBy("id")
            .agg(F.max(F.struct(*VERSION, "created_us", DATE)).alias("own"), F.count("*").alias("copies"))
        )

    def compare(self, landed: DataFrame, dates: Iterable[dt.date | None], span: tuple[int, int] | None) -> DataFrame:
        """Every id of a batch as a row of the log: is its copy the newest, and whose does it replace?"""
        known = self.rows(dates, span).groupBy("id").agg(F.max(F.struct(*VERSION)).alias("known"))
        # Merged by sorted ids: the plan asks for no side to be small, and the log stays where it is.
        both = self.own(landed).join(known.hint("merge"), "id", "left")
        won = F.col("known").isNull() | (F.struct(*[F.col(f"own.{c}") for c in VERSION]) >= F.col("known"))
        replaced = F.when(won & (F.col(f"known.{BATCH}") != F.col(f"own.{BATCH}")), F.col(f"known.{BATCH}"))
        return both.select("id", "own.*", "copies", won.alias("won"), replaced.alias("replaced"))

    def append(self, versions: DataFrame) -> None:
        versions.select(*VERSIONS.names).write.insertInto(self.table)

    def rebuild(self, dates: Iterable[dt.date | None] | None) -> None:
        """Derive the log of some dates, or of all, from the raw messages."""
        spark, store = self.spark, self.store
        raw = store.read(spark, "raw_tweets") if dates is None else store.read_dates(spark, "raw_tweets", dates)
        newest = self.own(raw).select(
            "id", "own.*", "copies", F.lit(True).alias("won"), F.lit(None).cast("string").alias("replaced")
        )
        dates = set(dates or ())
        kept = {r[0] for r in raw.where("id IS NOT NULL").select(DATE).distinct().collect()} if dates else set()
        with self._rewriting(dates):
            self._replace(newest)
            for date in dates - kept:
                # An empty partition takes the place of one that holds rows no longer there.
                spark.createDataFrame([], VERSIONS).drop(DATE).createOrReplaceTempView(f"{self.table}_none")
                spark.sql(f"INSERT OVERWRITE {self.table} PARTITION ({_named(date)}) SELECT * FROM {self.table}_none")

    def compact(self, dates: Iterable[dt.date | None]) -> None:
        """Merge the files of dates that have more than ``MOST_FILES`` a bucket into one a bucket."""
        dates = set(dates)
        # Names only, of a batch's dates: at most MOST_FILES + 1 a bucket and date.
        if len(self.rows(dates).inputFiles()) <= MOST_FILES * self.store.id_buckets * len(dates):
            return
        newest = (
            self.rows(dates).groupBy("id")
            .agg(F.max(F.struct(*VERSION, "created_us", DATE, "copies", "won", "replaced")).alias("own"))
            .select("id", "own.*")
        )
        with self._rewriting(dates):
            self._replace(newest)

    def _replace(self, versions: DataFrame) -> None:
        """Write versions in place of the partitions they have rows for."""
        key = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, "dynamic")
        try:
            versions.select(*VERSIONS.names).write.insertInto(self.table, overwrite=True)
        finally:
            self.spark.conf.set(key, before)

    @contextmanager
    def _rewriting(self, dates: Iterable[dt.date | None]):
        """Note the dates while their partitions are replaced, so that a crash in between is mended later."""
        self._note(dates)
        yield
        self.spark.catalog.refreshTable(self.table)
        self._note(())

    def _note(self, dates: Iterable[dt.date | None]) -> None:
        rows = self.spark.createDataFrame([(d,) for d in dates], f"{DATE} DATE").coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.path}_rewriting")

    def _mend(self) -> None:
        """Derive dates again whose partitions a crash may have left half replaced."""
        path = f"{self.path}_rewriting"
        if not exists(self.spark, path):
            return
        dates = {r[0] for r in self.spark.read.schema(f"{DATE} DATE").parquet(path).collect()}  # of one batch
        if dates:
            self.rebuild(dates)


def _named(date: dt.date | None) -> str:
    return f"{DATE}=NULL" if date is None else f"{DATE}=DATE'{date.isoformat()}'"


def created_us() -> Column:
    return F.unix_micros(instant(F.col("created_at")))
