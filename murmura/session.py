"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "murmura",
    master: str | None = None,
    executor_memory: str | None = None,
    driver_memory: str | None = None,
    hive: bool = False,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with adaptive execution on and dates and hours read in UTC."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Dedup state holds an id per message: keep it on disk, not in the heap.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }
    if executor_memory:
        settings["spark.executor.memory"] = executor_memory
    if driver_memory:
        settings["spark.driver.memory"] = driver_memory
    builder = SparkSession.builder.appName(app_name).config(map=settings | (conf or {}))
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Make a session that was built elsewhere derive dates and hours in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder that ``spark.checkpoint.dir`` names.

    Only a local master, where every task sees this machine's disk, may fall
    back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        shared = tempfile.mkdtemp(prefix="murmura-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
