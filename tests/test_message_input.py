"""The messages that the registered queries start from, built from rows of the test's own."""

import datetime as dt
import os

import pytest

from checks import messages as built
from checks import queries
from murmura.plans.ingest import ingest_file
from murmura.sources.landing import land_messages, read_messages, stream_messages
from murmura.sources.store import Store


@pytest.fixture
def tables(spark, folder):
    """Three documents and eight events; event 6 comes as a view and as a click, and one event has no id."""
    kinds = ["view", "click", "signup", "purchase", "view", "click", "view"]
    rows = [(i, dt.datetime(2024, 1, 1, i), i, kind, 1.5, "") for i, kind in enumerate(kinds)]
    rows += [(6, dt.datetime(2024, 1, 1, 7), 7, "click", 2.5, ""), (None, dt.datetime(2024, 1, 1), 8, "view", 0.5, "")]
    columns = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    spark.createDataFrame(rows, columns).write.parquet(f"{folder}/events.parquet")
    texts = [(0, "zero the thing", "en", "a", 14), (1, "one then", "en", "a", 8), (2, "two", "de", "a", 3)]
    documents = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars INT"
    spark.createDataFrame(texts, documents).write.parquet(f"{folder}/documents.parquet")
    return folder


def _scratch(spark, purpose):
    shared = spark.conf.get("spark.checkpoint.dir")
    return {f for f in os.listdir(shared) if f.startswith(purpose)} if os.path.isdir(shared) else set()


def test_messages_are_not_copied(spark, tables):
    """Nothing is written, and above the join, where each event has a whole text, no exchange carries it."""
    before = _scratch(spark, "messages")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = built.messages(spark, tables)
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert _scratch(spark, "messages") == before
    above, _, below = plan.partition("SortMergeJoin")
    assert below and "Exchange" not in above
    assert below.count("Exchange hashpartitioning") == 2  # events once, documents once
    assert sorted((r.id, r.text) for r in rows.collect()) == [
        ("0", "zero the thing"), ("1", "one then https://t.co/x @user #tag"), ("2", "RT @user: two"),
        ("3", "zero the thing"), ("4", "one then"), ("5", "two https://t.co/x @user #tag"),
        ("6", "zero the thing"), ("6", "zero the thing https://t.co/x @user #tag"),
    ]


def test_collected_again_by_id(spark, tables):
    """Every row of an id that was viewed comes again, whatever that row's own event is."""
    again = queries._collected_again(spark, tables)
    assert sorted((r.id, r.like_count, r.collected_at.hour - r.created_at.hour) for r in again.collect()) == [
        ("0", 6, 3), ("4", 6, 3), ("6", 6, 3), ("6", 7, 3)
    ]


def test_texts_of_newest_copies_cross_no_exchange(spark, tables):
    """Older copies are taken out of the events, below the join that gives each its text."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        latest = queries.queries()["latest_by_id"](spark, tables)
        plan = latest._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Whole rows are compared in the last part of the union, which holds copies of one time with equal counters.
    kept, tied, whole = plan.partition("partial_max(struct(collected_at")
    assert tied and "Exchange hashpartitioning(id#" not in whole and kept.count("Exchange hashpartitioning(id#") == 1
    texts = [i for i, line in enumerate(kept.splitlines()) if "SortMergeJoin [doc_id" in line]
    anti = [i for i, line in enumerate(kept.splitlines()) if "LeftAnti" in line]
    assert len(anti) == 2 and texts[0] < anti[0]
    assert sorted((r.id, r.like_count, r.text) for r in latest.collect()) == [
        ("0", 6, "zero the thing"), ("1", 1, "one then https://t.co/x @user #tag"), ("2", 1, "RT @user: two"),
        ("3", 1, "zero the thing"), ("4", 6, "one then"), ("5", 1, "two https://t.co/x @user #tag"),
        ("6", 7, "zero the thing https://t.co/x @user #tag"),
    ]


def test_landed_lines_are_compressed(spark, tables, folder):
    """Landed files are gzip files, and plain ones beside them are read as before, by batch and by stream."""
    rows = built.messages(spark, tables)
    landing = f"{folder}/landing"
    land_messages(rows, landing)
    files = [f for f in os.listdir(landing) if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    rows.selectExpr("to_json(struct(id, text)) AS value").where("id = '3'").write.mode("append").text(landing)
    landed = read_messages(spark, landing).drop("_corrupt_record")
    want = [tuple(r) for r in rows.collect()]
    want.append(("3", "zero the thing", *[None] * (len(rows.columns) - 2)))
    assert sorted((tuple(r) for r in landed.collect()), key=str) == sorted(want, key=str)
    query = (
        stream_messages(spark, landing).select("id").writeStream.format("parquet").trigger(availableNow=True)
        .option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").start()
    )
    query.awaitTermination()
    assert spark.read.schema("id STRING").parquet(f"{folder}/out").count() == len(want)


def test_stored_messages_are_compressed_and_hold_the_landed_rows(spark, tables, folder):
    """Both message tables are written with zstd; all landed rows are among the raw ones."""
    landing, store = f"{folder}/landing", Store(f"{folder}/tables")
    land_messages(built.messages(spark, tables), landing)
    ingest_file(spark, landing, store)
    for table, rows in (("raw_tweets", 8), ("processed_tweets", 5)):
        read = store.read(spark, table)
        assert read.count() == rows
        assert all(".zstd.parquet" in f for f in read.inputFiles())


def test_time_order_needs_no_store(spark, tables):
    """The ordered landing folder holds every message once, and nothing is ingested for it."""
    before = _scratch(spark, "store")
    landed = read_messages(spark, queries.in_time_order(spark, tables))
    assert sorted(r.id for r in landed.collect()) == ["0", "1", "2", "3", "4", "5", "6", "6"]
    assert _scratch(spark, "store") == before


@pytest.mark.parametrize("fill", [queries.with_late_files, queries.in_time_order, queries.ingest_recollected(2)])
def test_landing_rounds_take_the_parts_of_the_join(spark, tables, monkeypatch, fill):
    """Files are put together out of parts that are there; no text crosses an exchange to be dealt out to files."""
    landed = []
    monkeypatch.setattr(queries, "land_messages", lambda rows, folder: landed.append(rows) or land_messages(rows, folder))
    fill(spark, tables)
    plans = [rows._jdf.queryExecution().optimizedPlan().toString() for rows in landed]
    assert len(plans) >= 2 and all("Repartition " in p and "Repartition 0" not in p for p in plans)
    assert all("Repartition " + str(spark.sparkContext.defaultParallelism) + ", false" in p for p in plans)


def test_stream_results_are_kept_with_zstd(spark, tables):
    rows = queries.stream_dedup(spark, tables)
    assert sorted(r.id for r in rows.collect()) == sorted({str(i) for i in range(7)})
    assert all(".zstd.parquet" in f for f in rows.inputFiles())
