import datetime as dt
import glob
import os
import time

from pyspark.sql import functions as F

from helpers import land, message, raw, record
from murmura.operators import serving
from murmura.operators.aggregates import create_aggregated_views
from murmura.operators.messages import process_messages
from murmura.operators.scoring import score_sentiment
from murmura.plans.dashboard import export_dataset, export_extracts, run_all
from murmura.plans.ingest import collect_messages, ingest_batch, ingest_file, rebuild_aggregates
from murmura.schemas import COUNTERS
from murmura.sources.landing import read_messages, read_records, stream_messages
from murmura.sources.store import Store
from murmura.streaming.ingest import ingest_landing
from murmura.streaming.live import hourly_counts, unique_by_id

TEXTS = ["I love this!", "This is terrible!", "Just a message.", "RT @a good", "not good"]


def records(n, start=0, **more):
    return [
        record(i, more.get("text", TEXTS[i % 5]), f"2024-01-{8 + i % 3:02d}T{i % 24:02d}:30:00+00:00", **({"likes": i} | {k: v for k, v in more.items() if k != "text"}))
        for i in range(start, start + n)
    ]


def ingest(spark, folder, store, checkpoint="checkpoint", **options):
    query = ingest_landing(spark, f"{folder}/in", store, f"{folder}/{checkpoint}", **options)
    query.awaitTermination()


def content(spark, store, table, *drop):
    df = store.read(spark, table).drop("processed_at", *drop)
    df = df.withColumns({c: F.round(c, 9) for c, t in df.dtypes if t == "double"})
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def test_stream_equals_batch_and_second_run_adds_nothing(spark, folder):
    for k in range(4):
        land(f"{folder}/in", f"{k}.json", records(10, 10 * k))
    # The same messages once more in a later file, collected earlier, later and at the same time.
    land(f"{folder}/in", "9.json", records(4, collected_at="2024-01-01T00:00:00", likes=77))
    land(f"{folder}/in", "8.json", records(8, 4, collected_at="2024-02-01T00:00:00", likes=50, text="This is terrible!"))
    land(f"{folder}/in", "7.json", records(4, 12))
    streamed, batch = Store(f"{folder}/a"), Store(f"{folder}/b")
    ingest(spark, folder, streamed, files_per_batch=2)
    ingest_file(spark, f"{folder}/in/*.json", batch)
    messages = content(spark, streamed, "processed_tweets", "ingest_batch")
    assert messages == content(spark, batch, "processed_tweets", "ingest_batch")
    assert len(messages) == 33
    direct = create_aggregated_views(batch.read(spark, "processed_tweets"))
    for table in ("hourly_sentiment", "daily_sentiment", "trending_topics"):
        assert content(spark, streamed, table) == content(spark, batch, table)
        assert content(spark, batch, table) == sorted(
            map(repr, direct[table].select(*[
                F.round(c, 9).alias(c) if t == "double" else c for c, t in sorted(direct[table].dtypes)
            ]).collect())
        )
    # Nothing new, then one new file: earlier dates keep their history.
    ingest(spark, folder, streamed)
    assert content(spark, streamed, "processed_tweets", "ingest_batch") == messages
    land(f"{folder}/in", "new.json", [record(900, created="2024-02-01T00:00:00+00:00")])
    ingest(spark, folder, streamed)
    dates = {r[0] for r in streamed.read(spark, "daily_sentiment").select("tweet_date").collect()}
    assert dates == {dt.date(2024, 1, 8), dt.date(2024, 1, 9), dt.date(2024, 1, 10), dt.date(2024, 2, 1)}


def test_new_checkpoint_neither_loses_nor_repeats(spark, folder):
    land(f"{folder}/in", "a.json", records(10))
    store = Store(f"{folder}/tables")
    ingest(spark, folder, store, "first")
    before = content(spark, store, "processed_tweets", "ingest_batch")
    ingest(spark, folder, store, "second")
    assert content(spark, store, "processed_tweets", "ingest_batch") == before


def test_batch_run_again_ends_in_the_same_tables(spark, folder):
    store = Store(folder)
    batch = raw(spark, message("1", "I love this!", likes=20), message(None, "x"), message(None, "x"),
                message("2", "fine", created=None))
    results = []
    for _ in range(2):
        dates = ingest_batch(batch, "b1", store)
        results.append([content(spark, store, t) for t in ("raw_tweets", "processed_tweets", "daily_sentiment")])
    assert results[0] == results[1]
    assert set(dates) == {dt.date(2024, 1, 10), None}
    assert [len(r) for r in results[0][:2]] == [4, 4]


def test_later_batch_does_not_wipe_a_shared_date(spark, folder):
    store = Store(folder)
    ingest_batch(raw(spark, message("1", likes=11)), "b1", store)
    ingest_batch(raw(spark, message("2", likes=12), message("1", likes=99)), "b2", store)
    assert store.read(spark, "processed_tweets").count() == 2
    assert store.read(spark, "raw_tweets").count() == 3
    (day,) = store.read(spark, "trending_topics").collect()
    # Copies of one time: the one with more likes is the newer one.
    assert (day.total_engagement, day.tweet_count) == (111, 2)
    ingest_batch(raw(spark, message("1", likes=1, collected="2024-01-10T14:00:00")), "b3", store)
    (day,) = store.read(spark, "trending_topics").collect()
    assert (day.total_engagement, day.tweet_count) == (12, 1)
    assert store.read(spark, "processed_tweets").count() == 2
    tables = ("sentiment_rollup", "hourly_sentiment", "daily_sentiment", "trending_topics")
    before = [content(spark, store, t) for t in tables]
    rebuild_aggregates(spark, store, [dt.date(2024, 1, 10)])
    assert [content(spark, store, t) for t in tables] == before


def test_newest_copy_in_another_language_takes_the_message_out(spark, folder):
    for name, order in (("a", (0, 1)), ("b", (1, 0))):
        store = Store(f"{folder}/{name}")
        copies = [message("1", likes=20), message("1", lang="de", likes=30, collected="2024-01-11T00:00:00")]
        for i in order:
            ingest_batch(raw(spark, copies[i]), f"b{i}", store)
        assert store.read(spark, "processed_tweets").count() == 0
        assert store.read(spark, "trending_topics").count() == 0 == store.read(spark, "daily_sentiment").count()


def test_batch_that_keeps_nothing_on_the_second_run(spark, folder):
    store = Store(folder)
    ingest_batch(raw(spark, message("1", likes=20), message("2", created="2024-01-11T00:00:00")), "b", store)
    ingest_batch(raw(spark, message("3", created="2024-01-12T00:00:00", likes=20)), "b", store)
    assert [r.id for r in store.read(spark, "raw_tweets").collect()] == ["3"]
    assert [r.id for r in store.read(spark, "processed_tweets").collect()] == ["3"]
    assert [r.tweet_date.day for r in store.read(spark, "daily_sentiment").collect()] == [12]


def test_one_path_with_other_files_is_another_batch(spark, folder):
    store = Store(f"{folder}/tables")
    land(f"{folder}/in", "a.json", [record(1)])
    ingest_file(spark, f"{folder}/in", store)
    land(f"{folder}/in", "a.json", [])
    land(f"{folder}/in", "b.json", [record(2)])
    for _ in range(2):
        ingest_file(spark, f"{folder}/in", store)
    assert sorted(r.id for r in store.read(spark, "processed_tweets").collect()) == ["1", "2"]
    assert store.read(spark, "raw_tweets").count() == 2


def test_old_files_are_read_and_archived(spark, folder):
    store, old = Store(f"{folder}/tables"), time.time() - 40 * 86400
    for k in range(2):
        land(f"{folder}/in", f"{k}.json", [record(k)])
        if k:
            os.utime(f"{folder}/in/{k}.json", (old, old))
        ingest(spark, folder, store, archive=f"{folder}/read")
    ingest(spark, folder, store, archive=f"{folder}/read")
    assert sorted(r.id for r in store.read(spark, "processed_tweets").collect()) == ["0", "1"]


def test_stream_with_an_interval(spark, folder):
    land(f"{folder}/in", "a.json", [record(1)])
    store = Store(f"{folder}/tables")
    query = ingest_landing(spark, f"{folder}/in", store, f"{folder}/c", interval_seconds=1)
    try:
        query.processAllAvailable()
        land(f"{folder}/in", "b.json", [record(2)])
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(r.id for r in store.read(spark, "processed_tweets").collect()) == ["1", "2"]


def test_collection_is_whole_unless_cut(spark, folder):
    df = raw(spark, *[message(str(i), "ai", created=f"2024-01-01T00:{i // 60:02d}:{i % 60:02d}") for i in range(700)])
    nested = df.select("id", "text", "created_at", "author_id", "lang", F.struct(*COUNTERS).alias("public_metrics"))
    collect_messages(nested, f"{folder}/all")
    collect_messages(nested, f"{folder}/some", max_results=500)
    counts = [read_messages(spark, f"{folder}/{n}").count() for n in ("all", "some")]
    assert counts == [700, 500]


def test_nothing_landed_yet(spark, folder):
    assert ingest_landing(spark, f"{folder}/none", Store(folder), f"{folder}/c") is None


def test_unique_by_id_on_a_stream(spark, folder):
    land(f"{folder}/in", "a.json", records(6) + [record(None), record(None)])
    land(f"{folder}/in", "b.json", records(6) + records(2, 6))
    stream = unique_by_id(stream_messages(spark, f"{folder}/in", 1), "5 days")

    def run():
        stream.select("id").writeStream.format("parquet").option("path", f"{folder}/out").option(
            "checkpointLocation", f"{folder}/c"
        ).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.id or "-" for r in spark.read.schema("id STRING").parquet(f"{folder}/out").collect())

    once = run()
    assert once == ["-", "-"] + [str(i) for i in range(8)]
    assert run() == once


def test_hourly_counts_hold_back_open_hours(spark, folder):
    land(f"{folder}/in", "a.json", [record(i, created=f"2024-01-10T{10 + i // 2}:1{i % 2}:00Z") for i in range(8)])
    live = score_sentiment(process_messages(stream_messages(spark, f"{folder}/in")))
    hourly_counts(live, "1 hour").writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/c"
    ).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{folder}/out").orderBy("tweet_hour").collect()
    assert [(r.tweet_hour, r.sentiment_label, r.tweet_count) for r in rows] == [
        (10, "positive", 2), (11, "positive", 2)
    ]


def test_whole_run(spark, folder):
    land(f"{folder}/records", "a.json", [
        {"id": i, "text": f"I love ai {i}" if i % 2 else "nothing here", "lang": "en", "author_id": 1,
         "created_at": f"2024-01-10T{i:02d}:00:00Z",
         "public_metrics": {"retweet_count": 1, "like_count": 20, "reply_count": 0, "quote_count": 0}}
        for i in range(20)
    ])

    store, out, as_of = Store(f"{folder}/tables"), f"{folder}/out", dt.date(2024, 1, 10)
    run_all(read_records(spark, f"{folder}/records"), f"{folder}/in", store, f"{folder}/c", out,
            max_results=5, as_of=as_of)
    assert sorted(r.id for r in store.read(spark, "processed_tweets").collect()) == ["11", "13", "15", "17", "19"]
    (trend,) = spark.read.option("header", True).csv(f"{out}/sentiment_trends").collect()
    assert (trend.tweet_count, trend.sentiment_category) == ("5", "Very Positive")
    assert spark.read.option("header", True).csv(f"{out}/summary_stats").count() == 3
    export_extracts(spark, store, out, as_of)
    assert spark.read.option("header", True).csv(f"{out}/hourly_trends").count() == 5
    dataset = export_dataset(spark, store, out, as_of)
    direct = serving.dashboard_dataset(store.read(spark, "processed_tweets"), as_of=as_of)
    assert dataset.drop("avg_polarity").collect() == direct.drop("avg_polarity").collect()
    # A week without data: no hourly extract is written, the others are empty.
    export_extracts(spark, store, f"{folder}/late", dt.date(2025, 1, 1))
    assert not glob.glob(f"{folder}/late/hourly_trends")
    assert glob.glob(f"{folder}/late/sentiment_trends")
