"""The stored tables: date-partitioned Parquet, extracts and the catalog."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura import schemas
from murmura.functions.measures import LABELS, sentiment_category_sql
from murmura.schemas import BATCH, DATE, partitioned
from murmura.sources import places
from murmura.sources.landing import exists, if_present

# Table names and, for each, its columns and partition columns.
TABLES: dict[str, tuple[T.StructType, list[str]]] = {
    "raw_tweets": (schemas.RAW_LINES, [DATE, BATCH]),
    "processed_tweets": (schemas.SCORED, [DATE, BATCH]),
    "sentiment_rollup": (schemas.ROLLUP, [DATE, BATCH]),
    "hourly_sentiment": (schemas.HOURLY, [DATE]),
    "daily_sentiment": (schemas.DAILY, [DATE]),
    "trending_topics": (schemas.TRENDING, [DATE]),
}
# What the ingest keeps for itself; not in the catalog.
INTERNAL: dict[str, tuple[T.StructType, list[str]]] = {
    "ingest_batches": (schemas.LEDGER, [BATCH]),
    "stream_progress": (schemas.PROGRESS, [BATCH]),
    "quarantine": (T.StructType([T.StructField("line", T.StringType())]), [BATCH]),
    "released": (T.StructType([T.StructField("digest", T.StringType())]), ["repair"]),
}


# Fixed value: messages are mostly text, which zstd keeps in less room than the default codec does.
CODEC = "zstd"
# Tables of whole messages. An exchange before their write would copy every text once more.
WHOLE_TEXTS = {"raw_tweets", "processed_tweets"}


@dataclass(frozen=True)
class Store:
    """All tables below one root folder.

    ``id_buckets`` is how many ways the log of message versions is split by id; it belongs to the
    folder, so use one value for all its readers. A hundred million ids a day want a few hundred.
    """

    root: str
    id_buckets: int = 4

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The whole table; an empty frame of its schema before the first write."""
        return self._load(spark, table, self.path(table))

    def read_dates(self, spark: SparkSession, table: str, dates: Iterable[dt.date]) -> DataFrame:
        """The table for some dates. Only their folders are listed."""
        listed = ",".join(sorted({_folder(d) for d in dates}))
        return self._load(spark, table, f"{self.path(table)}/{DATE}={{{listed}}}")

    def read_batch(
        self, spark: SparkSession, table: str, batch: str, dates: Iterable[dt.date] | None = None
    ) -> DataFrame:
        """The rows one ingest batch wrote; without ``dates``, every date's folder is looked at."""
        listed = "*" if dates is None else "{" + ",".join(sorted({_folder(d) for d in dates})) + "}"
        return self._load(spark, table, f"{self.path(table)}/{DATE}={listed}/{BATCH}={batch}")

    def read_parts(self, spark: SparkSession, table: str, parts: Iterable[tuple], placed: bool = False) -> DataFrame:
        """The rows of the named (date, batch) partitions; only their folders are listed. ``placed`` adds their places."""
        columns, keys = TABLES[table]
        schema = partitioned(columns, *keys)
        listed: dict[str, list[str]] = {}
        for date, batch in parts:
            listed.setdefault(batch, []).append(_folder(date))
        out = None
        for batch, folders in sorted(listed.items()):
            path = f"{self.path(table)}/{DATE}={{{','.join(sorted(folders))}}}/{BATCH}={batch}"
            if placed and not exists(spark, path):
                continue
            found = self._load(spark, table, path)
            found = found.select("*", *places.places()) if placed else found
            out = found if out is None else out.unionByName(found)
        return spark.createDataFrame([], schema) if out is None else out

    def size(self, spark: SparkSession, table: str, date: dt.date | None) -> int:
        """Bytes that a date of a table has on disk; asks the file system, reads nothing."""
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(table)}/{DATE}={_folder(date)}")
        files = where.getFileSystem(spark._jsc.hadoopConfiguration())
        return files.getContentSummary(where).getLength() if files.exists(where) else 0

    def started(self, spark: SparkSession, batch: str) -> bool:
        """True when an ingest batch of this name has begun before, whether or not it ended."""
        return exists(spark, f"{self.path('ingest_batches')}/{BATCH}={batch}")

    def note(self, spark: SparkSession, batch: str, finished: bool, **figures) -> None:
        """Write the ledger row of one batch in place of the one before."""
        figures = {"finished": finished, **figures}
        row = [F.lit(figures.get(f.name)).cast(f.dataType).alias(f.name) for f in schemas.LEDGER.fields]
        path = f"{self.path('ingest_batches')}/{BATCH}={batch}"
        spark.range(1).select(*row).coalesce(1).write.mode("overwrite").parquet(path)

    def clear(self, spark: SparkSession, table: str, *values) -> None:
        """Empty one partition: an empty file takes the place of its rows."""
        columns, keys = TABLES[table]
        rest = T.StructType([f for f in columns.fields if f.name not in keys])
        folder = "/".join(
            f"{k}={_folder(v) if k == DATE else v}" for k, v in zip(keys, values, strict=True)
        )
        empty = spark.createDataFrame([], rest).coalesce(1)
        empty.write.mode("overwrite").parquet(f"{self.path(table)}/{folder}")

    def replace(self, df: DataFrame, table: str, named: Iterable[tuple], metrics: dict[str, Column] | None = None):
        """Replace the partitions ``df`` has rows for, and empty those of ``named`` it has none for.

        ``named`` lists partitions that hold earlier results. Only where there are any is ``df``
        asked which ones it still has. Messages are written by the tasks that read them. Returns the partitions that became empty, and with ``metrics``
        (name to aggregate) also their values over what was written.
        """
        keys = TABLES[table][1]
        named = {tuple(n) for n in named}
        kept = {tuple(r) for r in df.select(*keys).distinct().collect()} if named else set()
        seen = overwrite_partitions(df, self.path(table), keys, metrics, spread=table not in WHOLE_TEXTS)
        for values in named - kept:
            self.clear(df.sparkSession, table, *values)
        return named - kept if metrics is None else (named - kept, seen)

    def _load(self, spark: SparkSession, table: str, path: str) -> DataFrame:
        columns, keys = (TABLES | INTERNAL)[table]
        schema = partitioned(columns, *keys)
        reader = spark.read.schema(schema).option("basePath", self.path(table))
        found = if_present(lambda: reader.parquet(path), spark, path)
        return spark.createDataFrame([], schema) if found is None else found


def _folder(date: dt.date | None) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if date is None else date.isoformat()


def append_messages(df: DataFrame, path: str, mode: str = "append") -> None:
    """Date-partitioned Parquet in the given mode, written by the tasks that hold the messages: no text is shuffled."""
    df.write.mode(mode).partitionBy(DATE).parquet(path, compression=CODEC)


def overwrite_partitions(
    df: DataFrame, path: str, keys: list[str], metrics: dict[str, Column] | None = None, spread: bool = True
) -> dict:
    """Replace exactly the partitions ``df`` has rows for; all others stay.

    ``spread`` deals the rows out anew, for few files. Without it each task writes the rows it holds, a file
    for each partition among them: nothing is shuffled, and there are as many files as the input's tasks make.

    ``metrics`` are observed as the rows are written, without a second pass. They sit behind
    any exchange, in the tasks that write: a shuffle stage that runs again after a lost
    executor would count its rows twice.
    """
    rows, seen = _balanced(df, keys) if spread else df, Observation()
    if metrics:
        rows = rows.observe(seen, *[c.alias(n) for n, c in metrics.items()])
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path, compression=CODEC)
    )
    return seen.get if metrics else {}


def _balanced(df: DataFrame, keys: list[str]) -> DataFrame:
    """Few files per partition, yet no task that has to write a whole busy date.

    A plain ``repartition(date)`` would send a date to one task. The rebalance
    hint splits partitions that come out too large and merges small ones.
    """
    return df.hint("rebalance", *keys)


def write_csv(df: DataFrame, folder: str, single_file: bool = False) -> None:
    """CSV with a header and no index.

    ``single_file`` suits dashboard extracts, which hold at most one row per hour
    and label of a fixed span.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(folder)


def write_json_report(report: DataFrame, folder: str) -> None:
    """Append a one-row report as a JSON line."""
    report.write.mode("append").json(folder)


def create_catalog(spark: SparkSession, store: Store, database: str = "sentiment_db") -> None:
    """Database, external tables over the store, and the two views."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table, (columns, keys) in TABLES.items():
        body = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in partitioned(columns, *keys).fields
        )
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({body}) USING parquet "
            f"PARTITIONED BY ({', '.join(keys)}) LOCATION '{store.path(table)}'"
        )
    spark.sql(
        f"CREATE VIEW IF NOT EXISTS {database}.sentiment_trends AS "
        f"SELECT {DATE}, sentiment_label, tweet_count, avg_polarity, "
        f"{sentiment_category_sql('avg_polarity')} AS sentiment_category "
        f"FROM {database}.daily_sentiment"
    )
    counts = ", ".join(
        f"coalesce(sum(tweet_count) FILTER (WHERE sentiment_label = '{label}'), 0) AS {label}_count"
        for label in LABELS
    )
    spark.sql(
        f"CREATE VIEW IF NOT EXISTS {database}.hourly_trends AS "
        f"SELECT {DATE}, tweet_hour, {counts}, sum(tweet_count) AS total_count "
        f"FROM {database}.hourly_sentiment GROUP BY {DATE}, tweet_hour"
    )


def refresh_catalog(spark: SparkSession, database: str = "sentiment_db") -> None:
    """Let the catalog see all partitions that were written by path."""
    for table in TABLES:
        spark.catalog.recoverPartitions(f"{database}.{table}")


def register_batch(
    spark: SparkSession, batch: str, dates: Iterable[dt.date | None], database: str = "sentiment_db"
) -> None:
    """Let the catalog see what one batch wrote, without looking at any other partition."""
    for table, (_, keys) in TABLES.items():
        parts = []
        for date in dates:
            day = "NULL" if date is None else f"DATE'{date.isoformat()}'"
            parts.append(f"PARTITION ({DATE}={day}" + (f", {BATCH}='{batch}')" if BATCH in keys else ")"))
        if parts:
            spark.sql(f"ALTER TABLE {database}.{table} ADD IF NOT EXISTS {' '.join(parts)}")


def execute_query(spark: SparkSession, query: str, args: dict | None = None) -> DataFrame:
    """Run SQL with named parameters; the result stays distributed."""
    return spark.sql(query, args=args or {})
