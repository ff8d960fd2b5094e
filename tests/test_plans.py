"""The physical plans are the intended ones: pushdown, pruning, no needless shuffle or Python."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import land, message, raw, record
from murmura.operators import aggregates, serving
from murmura.operators.messages import latest_by_id, most_recent, newest_batches, process_messages
from murmura.operators.scoring import batch_analyze, score_sentiment
from murmura.plans.ingest import ingest_file
from murmura.sources import store as store_module
from murmura.sources.landing import stream_messages
from murmura.sources.store import Store


def executed(df):
    """The plan after adaptive execution."""
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("plans"))
    land(f"{folder}/in", "a.json", [record(i, created=f"2024-01-{1 + i:02d}T05:00:00Z") for i in range(20)])
    tables = Store(f"{folder}/tables")
    ingest_file(spark, f"{folder}/in", tables)
    return tables


def test_filters_reach_the_scan(spark, store):
    plan = executed(process_messages(store.read(spark, "raw_tweets")))
    assert "EqualTo(lang,en)" in plan and "Not(StringStartsWith(text,RT @))" in plan
    assert "Exchange" not in plan


def test_scoring_is_a_projection(spark, store):
    plan = executed(batch_analyze(store.read(spark, "raw_tweets")))
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan
    assert plan.count("regexp_extract_all") == 1


def test_aggregates_read_narrow_columns_of_the_wanted_dates(spark, store):
    plan = executed(serving.dashboard_dataset(store.read(spark, "processed_tweets"), as_of="2024-01-10"))
    assert "PartitionFilters: [isnotnull(tweet_date" in plan
    scan = plan[plan.index("ReadSchema"):]
    assert "text" not in scan and "author_id" not in scan


def test_one_shuffle_per_aggregate(spark, store):
    scored = store.read(spark, "processed_tweets")
    for view in aggregates.create_aggregated_views(scored).values():
        assert view._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_only_wanted_date_folders_are_listed(spark, store):
    dates = [dt.date(2024, 1, 3), dt.date(2024, 1, 5), dt.date(1999, 1, 1)]
    some = store.read_dates(spark, "daily_sentiment", dates)
    assert {f.split("tweet_date=")[1][:10] for f in some.inputFiles()} == {"2024-01-03", "2024-01-05"}
    assert dict(some.dtypes)["tweet_date"] == "date"


def test_texts_cross_one_exchange(spark, store, folder):
    """Also where nothing is small enough to broadcast, and with a hot id and rows without one."""
    rows = [message("hot", likes=i) for i in range(50)] + [message(None, f"t{i}") for i in range(20)] + [message(str(i)) for i in range(30)]
    raw(spark, *rows).write.parquet(f"{folder}/raw")
    landed = spark.read.parquet(f"{folder}/raw")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        latest = latest_by_id(landed)
        versions = store.read(spark, "raw_tweets")
        won = newest_batches(versions, landed).select("id")
        kept = latest.join(won, "id", "left_anti")
        assert sorted((r.id or "", r.like_count) for r in latest.collect() if r.id in (None, "hot")) == [("", 0)] * 20 + [("hot", 49)]
        physical = kept._jdf.queryExecution().executedPlan().toString()
        # An exchange below the partial maximum of whole rows carries texts; the others carry ids.
        whole = [i for i, line in enumerate(physical.splitlines()) if "partial_max(struct(collected_at" in line and "text#" in line]
        assert len(whole) == 1
        assert all("hashpartitioning(id#" in line for line in physical.splitlines() if "Exchange hashpartitioning" in line)
        assert physical.count("text:string") == 2  # one scan of rows with an id, one of rows without
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_batch_is_read_by_its_dates(spark, store):
    (batch,) = {r[0] for r in store.read(spark, "raw_tweets").select("ingest_batch").collect()}
    some = store.read_batch(spark, "raw_tweets", batch, [dt.date(2024, 1, 3)])
    assert {f.split("tweet_date=")[1][:10] for f in some.inputFiles()} == {"2024-01-03"}


def test_top_n_is_not_a_full_sort(spark):
    plan = most_recent(raw(spark, message()), 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_stored_writes_are_rebalanced(spark, folder):

    df = store_module._balanced(spark.range(10).withColumn("tweet_date", F.current_date()), ["tweet_date"])
    assert "REBALANCE_PARTITIONS_BY_COL" in df._jdf.queryExecution().executedPlan().toString()


def test_streamable(spark, folder):
    """Inline scoring keeps no state, so a stream takes it without foreachBatch."""
    land(f"{folder}/in", "a.json", [record(1)])

    live = score_sentiment(process_messages(stream_messages(spark, f"{folder}/in")))
    assert live.isStreaming


def test_messages_are_written_by_the_tasks_that_read_them(spark, folder):
    """No exchange copies the texts before the write; narrow tables still get few files."""
    made, tables = Store(f"{folder}/made"), Store(f"{folder}/tables")
    for day in (1, 2):
        land(f"{folder}/in", f"{day}.json", [record(10 * day + i, created=f"2024-01-{1 + i:02d}T05:00:00Z") for i in range(2)])
    ingest_file(spark, f"{folder}/in", made)
    for table, files in (("raw_tweets", 6), ("processed_tweets", 6), ("sentiment_rollup", 2)):
        rows = made.read(spark, table)
        # Three tasks, each of which has every row.
        tables.replace(spark.range(0, 3, 1, 3).select().crossJoin(F.broadcast(rows)).select(*rows.columns), table, [])
        assert len(tables.read(spark, table).inputFiles()) == files
        assert tables.read(spark, table).count() == 3 * rows.count()
