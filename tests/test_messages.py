import datetime as dt

from pyspark.sql import functions as F

from helpers import message, raw
from murmura.operators.messages import (
    flatten_records,
    keyword_filter,
    latest_by_id,
    most_recent,
    newest_batches,
    process_messages,
)
from murmura.schemas import PROCESSED


def test_filters_language_and_reposts(spark):
    df = raw(
        spark,
        message("1", "fine"), message("2", "RT @a x"), message("3", "RT@a"),
        message("4", " RT @a"), message("5", None), message("6", "x", lang="EN"),
        message("7", "x", lang=None), message("8", "", lang="en"),
    )
    kept = process_messages(df)
    assert {r.id for r in kept.collect()} == {"1", "3", "4", "8"}
    assert [f.name for f in kept.schema] == [f.name for f in PROCESSED]
    assert [f.dataType for f in kept.schema] == [f.dataType for f in PROCESSED]


def test_junk_counters_and_times_become_null(spark):
    df = spark.createDataFrame(
        [(5, "x", "2024-01-02T23:30:00+00:00", 9, "en", "3", "x7", None, "4", "nope")],
        "id LONG, text STRING, created_at STRING, author_id LONG, lang STRING, retweet_count STRING,"
        " like_count STRING, reply_count STRING, quote_count STRING, collected_at STRING",
    )
    row = process_messages(df).first()
    assert (row.id, row.author_id) == ("5", "9")
    assert (row.retweet_count, row.like_count, row.quote_count) == (3, None, 4)
    assert row.collected_at is None
    assert (row.tweet_date, row.tweet_hour) == (dt.date(2024, 1, 2), 23)


def test_date_and_hour_agree_for_zoned_times(spark):
    df = raw(spark, message()).withColumn("created_at", F.lit("2024-01-02T23:30:00-05:00"))
    row = process_messages(df).first()
    assert (row.tweet_date, row.tweet_hour) == (dt.date(2024, 1, 3), 4)


def test_unreadable_time_keeps_the_message(spark):
    df = raw(spark, message()).withColumn("created_at", F.lit("yesterday"))
    row = process_messages(df).first()
    assert (row.created_at, row.tweet_date, row.tweet_hour) == (None, None, None)


def test_flatten_records(spark):
    df = spark.createDataFrame(
        [("1", "t", dt.datetime(2024, 1, 1), "a", "en", (1, 2, 3, 4))],
        "id STRING, text STRING, created_at TIMESTAMP, author_id STRING, lang STRING, public_metrics "
        "STRUCT<retweet_count: INT, like_count: INT, reply_count: INT, quote_count: INT>",
    )
    row = flatten_records(df).first()
    assert (row.retweet_count, row.like_count, row.reply_count, row.quote_count) == (1, 2, 3, 4)
    assert row.collected_at is not None


def test_most_recent_orders_by_time_then_id(spark):
    df = raw(
        spark,
        message("a", created="2024-01-01T00:00:00"), message("c", created="2024-01-03T00:00:00"),
        message("b", created="2024-01-03T00:00:00"), message("d", created=None),
    )
    assert [r.id for r in most_recent(df, 3).collect()] == ["b", "c", "a"]


def test_keyword_filter(spark):
    df = raw(spark, message("1", "AI news"), message("2", "plain"), message("3", None))
    assert [r.id for r in keyword_filter(df).collect()] == ["1"]


def test_latest_copy_wins_and_missing_ids_stay(spark):
    df = raw(
        spark,
        message("1", likes=1, collected="2024-01-10T13:00:00"),
        message("1", likes=9, collected="2024-01-10T15:00:00"),
        message("1", likes=5, collected=None),
        message(None, "x"), message(None, "x"),
    )
    rows = latest_by_id(df).collect()
    assert sorted((r.id or "-", r.like_count) for r in rows) == [("-", 0), ("-", 0), ("1", 9)]


def test_ties_have_one_answer(spark):
    rows = [message("1", likes=n) for n in range(20)]
    for order in (rows, rows[::-1]):
        assert latest_by_id(raw(spark, *order).repartition(4)).first().like_count == 19


def test_newest_by_narrow_columns_first(spark):
    """The same rows, also where copies agree in time and counters, are equal, or lack times, counters or ids."""
    df = raw(
        spark,
        message("once"), message("once-null", collected=None),
        message("later", "old", collected="2024-01-10T13:00:00"), message("later", "new", collected="2024-01-10T15:00:00"),
        message("some", likes=5, collected=None), message("some", likes=1), message("none", likes=3, collected=None),
        message("none", likes=4, collected=None),
        message("text", "a"), message("text", "c"), message("text", "b"), message("text", "z", likes=-1),
        message("equal", "e"), message("equal", "e"), message("nothing", None, collected=None), message("nothing", "x", collected=None),
        message(None, "x"), message(None, "x"), message(None, None, collected=None),
    )
    df = df.withColumn("like_count", F.when(F.col("id") != "equal", F.col("like_count")))
    for order in (df, df.orderBy(F.desc("text")).repartition(4)):
        for version in ("collected_at", "like_count"):
            whole, narrow = (latest_by_id(order, version, narrow_first=n).collect() for n in (False, True))
            assert sorted(map(str, narrow)) == sorted(map(str, whole))
    found = {r.id: (r.text, r.like_count) for r in latest_by_id(df, narrow_first=True).collect()}
    assert found["later"][0] == "new" and found["text"][0] == "c" and found["nothing"][0] == "x"
    assert found["some"][1] == 1 and found["none"][1] == 4 and found["equal"][1] is None and len(found) == 9


def test_newest_batches(spark):
    stored = raw(
        spark,
        message("1", likes=1, collected="2024-01-10T13:00:00"), message("2", likes=2), message("2", likes=5),
        message("3"), message("9"), message(None),
    ).withColumn("ingest_batch", F.when(F.col("like_count") == 5, "b").otherwise("a"))
    later = raw(spark, message("1", collected="2024-01-10T15:00:00"), message("3"), message(None)).withColumn(
        "ingest_batch", F.lit("b"))
    versions = stored.unionByName(later)
    for order in (versions, versions.orderBy(F.desc("ingest_batch"))):
        got = newest_batches(order, raw(spark, message("1"), message("2"), message("3"), message(None)))
        assert {r.id: r.ingest_batch for r in got.collect()} == {"1": "b", "2": "b", "3": "b"}


def test_counters_in_memory(spark):
    df = raw(spark, message()).withColumns({
        "like_count": F.lit("7.0"), "retweet_count": F.lit(7.9), "reply_count": F.lit("x7"), "quote_count": F.lit("99999999999")})
    row = process_messages(df).first()
    assert (row.like_count, row.retweet_count, row.reply_count, row.quote_count) == (7, 7, None, None)
