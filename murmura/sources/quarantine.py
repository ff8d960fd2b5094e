"""Lines that could not be read: set aside with their batch, and a way back in once they are mended."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.schemas import CORRUPT, LANDED
from murmura.sources import places
from murmura.sources.landing import LANDED_AS, exists
from murmura.sources.store import INTERNAL, Store, overwrite_partitions


def quarantined(spark: SparkSession, store: Store) -> DataFrame:
    """Broken lines that have not come back: line, its digest, ingest_batch."""
    out = store.read(spark, "quarantine").withColumn("digest", F.sha2("line", 256))
    return out.join(store.read(spark, "released").select("digest"), "digest", "left_anti")


def release(
    spark: SparkSession, store: Store, landing: str, mend: Callable[[Column], Column], name: str
) -> int:
    """Land the quarantined lines that ``mend`` makes readable; the next ingest takes them up. Returns their number.

    ``name`` names this repair: run again after a failure, it lands the lines once more, and the ingest keeps
    one copy of a message, as of any other. Lines that stay broken stay in quarantine for another repair.
    """
    if not exists(spark, store.path("quarantine")):
        return 0
    stored = store.read(spark, "quarantine")
    waiting = stored.select("line", F.sha2("line", 256).alias("digest"), *places.places()).join(
        store.read(spark, "released").select("digest"), "digest", "left_anti"
    )
    read = F.from_json(mend(F.col("line")), LANDED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    good = waiting.withColumn("read", read).where(f"read IS NOT NULL AND read.{CORRUPT} IS NULL")
    # One digest a line is one line: copies of a broken line come back once. The lines themselves stay where they lie.
    good = good.groupBy("digest").agg(F.min(F.struct(places.FILE, places.AT)).alias("first"))
    lines = places.only(stored, good.select("first.*")).select(mend(F.col("line")).alias("value"))
    _, keys = INTERNAL["released"]
    lines.write.mode("append").option("compression", LANDED_AS["compression"]).text(landing)
    seen = overwrite_partitions(
        good.select("digest").withColumn(keys[0], F.lit(name)), store.path("released"), keys, {"rows": F.count(F.lit(1))}
    )
    return seen["rows"]
