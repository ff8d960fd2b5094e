"""The log of message versions: what a batch reads, and that the log can be lost, left half written or merged."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from helpers import message, raw
from murmura.operators.messages import latest_by_id
from murmura.plans import ingest as ingest_module
from murmura.plans.ingest import FEW_IDS, ingest_batch, newest_of_batch
from murmura.schemas import BATCH, DATE, VERSIONS
from murmura.sources import versions as versions_module
from murmura.sources.store import Store
from murmura.sources.versions import VersionLog

DAY = dt.date(2024, 1, 10)


def at(i, id=None, **more):
    """A message of its own minute."""
    return message(str(i if id is None else id), f"good {i}", created=f"2024-01-10T{i // 60:02d}:{i % 60:02d}:00", **more)


def tables(spark, store):
    out = {}
    for name in ("processed_tweets", "sentiment_rollup", "daily_sentiment", "trending_topics"):
        df = store.read(spark, name).drop("processed_at", BATCH)
        out[name] = sorted(map(repr, df.select(sorted(df.columns)).collect()))
    return out


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    store = Store(str(tmp_path_factory.mktemp("versions")), id_buckets=2)
    for k in range(4):
        ingest_batch(raw(spark, *[at(100 * k + i) for i in range(100)]), f"b{k}", store)
    return store


@pytest.fixture
def store(filled, folder):
    """A copy of a store with four batches of one date."""
    shutil.copytree(filled.root, f"{folder}/tables")
    return Store(f"{folder}/tables", id_buckets=2)


def scanned(df):
    """Rows that the scans of a frame gave, after running it."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    stages = [plan.executedPlan()] if "Adaptive" in plan.nodeName() else [plan]
    while stages:
        node = stages.pop()
        if "Scan parquet" in node.nodeName() and "murmura_versions" in node.toString():
            total += node.metrics().get("numOutputRows").get().value()
        children = node.children()
        stages += [children.apply(i) for i in range(children.size())]
        if "QueryStage" in node.nodeName():
            stages.append(node.plan())
    return total


def test_stored_side_has_no_exchange_and_only_its_span_is_read(spark, store):
    log = VersionLog(spark, store)
    landed = raw(spark, *[at(300 + i, collected="2024-01-11T00:00:00") for i in range(10)]).withColumns(
        {BATCH: F.lit("new"), DATE: F.lit(DAY)}
    )
    micros = [int(dt.datetime(2024, 1, 10, 5, m, tzinfo=dt.timezone.utc).timestamp() * 1e6) for m in (0, 9)]
    joined = log.compare(landed, [DAY], tuple(micros))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(id" in plan  # the batch's ids, to the log's buckets
    assert "SelectedBucketsCount: 2 out of 2" in plan and "SortMergeJoin" in plan
    few, day = scanned(joined), scanned(log.compare(landed, [DAY], None))
    # The files of the other three batches hold other creation times and are skipped.
    assert day == 400 and 0 < few <= 100
    rows = joined.collect()
    assert len(rows) == 10 and all(r.won and r.replaced == "b3" for r in rows)


def test_one_row_an_id_and_batch(spark, store):
    again = [at(5, likes=50, collected="2024-01-11T00:00:00"), at(5, likes=3, collected="2024-01-09T00:00:00"),
             at(6, likes=50, collected="2024-01-09T00:00:00"), message(None, "good")]
    ingest_batch(raw(spark, *again), "b9", store)
    log = VersionLog(spark, store).rows([DAY]).where(F.col(BATCH) == "b9").orderBy(F.col("id").cast("int"))
    assert [(r.id, r.copies, r.won, r.replaced) for r in log.collect()] == [("5", 2, True, "b0"), ("6", 1, False, None)]
    kept = {r.id: r.like_count for r in store.read(spark, "processed_tweets").where("id IN ('5', '6')").collect()}
    assert kept == {"5": 50, "6": 0} and store.read(spark, "processed_tweets").count() == 401


def test_lost_log_is_derived_from_raw_messages(spark, store, folder):
    """Another number of buckets is another log, which does not exist yet."""
    other = Store(store.root, id_buckets=3)
    ingest_batch(raw(spark, at(5, likes=50, collected="2024-01-11T00:00:00")), "b9", other)
    assert VersionLog(spark, other).rows([DAY]).count() == 401
    assert {r.like_count for r in other.read(spark, "processed_tweets").where("id = '5'").collect()} == {50}


def test_half_replaced_partitions_are_mended(spark, store):
    log = VersionLog(spark, store)
    before = sorted(r.id for r in log.rows([DAY]).collect())
    log._note([DAY])
    spark.createDataFrame([], VERSIONS).drop(DATE).createOrReplaceTempView("none")
    spark.sql(f"INSERT OVERWRITE {log.table} PARTITION ({DATE}=DATE'{DAY}') SELECT * FROM none")
    assert log.rows([DAY]).count() == 0
    mended = VersionLog(spark, store)
    assert sorted(r.id for r in mended.rows([DAY]).collect()) == before
    assert spark.read.parquet(f"{mended.path}_rewriting").count() == 0


def test_files_of_a_date_are_merged(spark, store, monkeypatch):
    monkeypatch.setattr(versions_module, "MOST_FILES", 3)
    before = tables(spark, store)
    log = VersionLog(spark, store)
    assert len(log.rows([DAY]).inputFiles()) == 8
    ingest_batch(raw(spark, at(7, collected="2024-01-01T00:00:00")), "b9", store)
    assert len(log.rows([DAY]).inputFiles()) == 2 and log.rows([DAY]).count() == 400
    assert tables(spark, store) == before


@pytest.mark.parametrize("step", ["raw_tweets", "sentiment_rollup"])
def test_batch_stopped_after_any_step_ends_in_the_same_tables(spark, folder, step):
    """The first run fails right after a step; the second one, of the same name, finishes."""
    batches = [raw(spark, *[at(i, likes=20) for i in range(6)]),
               raw(spark, *[at(i, likes=30, collected="2024-01-11T00:00:00") for i in range(3, 9)], at(20), at(20))]

    class Stopped(Store):
        def replace(self, df, table, named, metrics=None):
            out = super().replace(df, table, named, metrics)
            if table == step and self.root.endswith("stopped") and not self.started(spark, "done"):
                raise RuntimeError("stopped")
            return out

    whole, stopped = Store(f"{folder}/whole", 2), Store(f"{folder}/stopped", 2)
    for k, batch in enumerate(batches):
        ingest_batch(batch, f"b{k}", whole)
    ingest_batch(batches[0], "b0", stopped)
    with pytest.raises(RuntimeError):
        ingest_batch(batches[1], "b1", Stopped(stopped.root, 2))
    assert [r.finished for r in stopped.read(spark, "ingest_batches").orderBy(BATCH).collect()] == [True, False]
    ingest_batch(batches[1], "b1", stopped)
    assert tables(spark, stopped) == tables(spark, whole)


def test_many_odd_ids_are_joined_not_sent(spark, store):
    landed = store.read_batch(spark, "raw_tweets", "b0", [DAY])
    log = VersionLog(spark, store).rows([DAY]).where(F.col(BATCH) == "b0")
    few = newest_of_batch(landed, log, 1, 0)._jdf.queryExecution().optimizedPlan().toString()
    many = newest_of_batch(landed, log, FEW_IDS + 1, 0)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in few and "strategy=broadcast" not in many
    assert newest_of_batch(landed, log, 0, 0) is landed


def test_many_copies_cross_one_exchange(spark, folder):
    """Ids that come several times, that lost, and rows without one: few ids are sent, many meet where rows are compared."""
    rows = [at(i) for i in range(9)] + [at(1, likes=3), at(1, likes=2), at(2, likes=9), message(None, "x"), message(None, "x")]
    raw(spark, *rows).write.parquet(f"{folder}/landed")
    landed = spark.read.parquet(f"{folder}/landed")
    ids = [(str(i), i not in (2, 5), 3 if i == 1 else 2 if i == 2 else 1) for i in range(9)]
    versions = spark.createDataFrame(ids, "id STRING, won BOOLEAN, copies BIGINT")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few, many = newest_of_batch(landed, versions, 3, 1), newest_of_batch(landed, versions, FEW_IDS + 1, 1)
        plan = many._jdf.queryExecution().executedPlan().toString()
        got = [sorted((r.id or "", r.like_count) for r in df.collect()) for df in (few, many)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got[0] == got[1] == [("", 0), ("", 0), ("0", 0), ("1", 3), *[(str(i), 0) for i in (3, 4, 6, 7, 8)]]
    assert plan.count("Exchange hashpartitioning") == 2  # rows once, ids once


def test_a_batch_that_runs_again_compares_only_repeated_ids(spark, folder, monkeypatch):
    """Whole rows are sent to their id only for ids that come several times in the batch."""
    store, compared = Store(f"{folder}/tables", 2), []
    monkeypatch.setattr(ingest_module, "latest_by_id", lambda rows: compared.append(rows.count()) or latest_by_id(rows))
    for _ in range(2):
        ingest_batch(raw(spark, *[at(i, likes=20) for i in range(6)]), "b0", store)
    assert compared == []
    for _ in range(2):
        ingest_batch(raw(spark, at(3, likes=30, collected="2024-01-11T00:00:00"), at(20), at(20), message(None, "no id")), "b1", store)
    assert compared == [2, 2]
    kept = store.read(spark, "processed_tweets").select(BATCH, "id").collect()
    assert sorted((r[0], r[1] or "") for r in kept) == [*[("b0", str(i)) for i in (0, 1, 2, 4, 5)], ("b1", ""), ("b1", "20"), ("b1", "3")]
