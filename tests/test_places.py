"""Rows told apart by their places, and the jobs that keep whole texts out of exchanges with them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.messages import WORDS
from helpers import message, plan, raw
from murmura.operators import scoring
from murmura.operators.messages import process_messages
from murmura.operators.scoring import score_sentiment
from murmura.plans import ingest as ingest_module
from murmura.plans.ingest import ingest_batch, newest_by_place
from murmura.schemas import BATCH, DATE, LEXICON
from murmura.sources import closed, places, quarantine
from murmura.sources.store import Store, append_messages


def test_rows_are_found_by_their_places(spark, folder):
    """Several files, one of them with more rows than a bitmap has bits."""
    spark.range(0, 70_000, numPartitions=1).write.parquet(f"{folder}/t")
    spark.range(70_000, 70_020, numPartitions=2).write.mode("append").parquet(f"{folder}/t")
    rows = spark.read.parquet(f"{folder}/t")
    named = rows.select("id", *places.places()).where("id % 7 = 3 OR id IN (0, 69999, 70019)")
    assert {r.id for r in places.only(rows, named).collect()} == {i for i in range(70_020) if i % 7 == 3} | {0, 69_999, 70_019}
    left = places.without(rows, named)
    assert left.columns == ["id"]
    assert {r.id for r in left.collect()} == {i for i in range(70_020) if i % 7 != 3} - {0, 69_999, 70_019}
    assert places.without(rows, named.where("false")).count() == 70_020


def exchanged(df):
    """The columns that the hash and range exchanges of a frame's plan carry, in text."""
    lines = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).split("\n\n")
    return [part for part in lines if ") Exchange" in part.split("\n")[0]]


def test_many_odd_ids_move_no_text(spark, folder):
    copies = [message("1", "a"), message("1", "b", likes=2), message("1", "c", likes=1), message("2", "lost"),
              message("3", "x", likes=5), message("3", "y", likes=5), message("4", "own"), message(None, "n"), message(None, "n"),
              message("5", "older"), message("5", "newer", collected="2024-01-11T00:00:00")]
    raw(spark, *copies).write.parquet(f"{folder}/landed")
    landed = spark.read.parquet(f"{folder}/landed")
    ids = [("1", True, 3), ("2", False, 1), ("3", True, 2), ("4", True, 1), ("5", True, 2)]
    versions = spark.createDataFrame(ids, "id STRING, won BOOLEAN, copies BIGINT")
    got = newest_by_place(landed, versions, 3)
    assert sorted((r.id or "", r.text) for r in got.collect()) == [
        ("", "n"), ("", "n"), ("1", "b"), ("3", "y"), ("4", "own"), ("5", "newer")
    ]
    lost = newest_by_place(landed, versions.where("NOT won"), 0)
    assert lost.count() == 10
    assert exchanged(lost) and not any("text" in part for part in exchanged(lost))


@pytest.mark.parametrize("few", [0, 200_000])
def test_copies_are_taken_out_of_other_batches_by_place(spark, folder, monkeypatch, few):
    monkeypatch.setattr(ingest_module, "FEW_IDS", few)
    store = Store(f"{folder}/tables", 2)
    for k, newer in enumerate(([], [1, 2], [2, 5, 7])):
        rows = [message(str(i), f"good {k}", likes=k, collected=f"2024-01-1{k}T14:00:00") for i in (newer or range(8))]
        ingest_batch(raw(spark, *rows, *rows[:1], message(None, f"none {k}")), f"b{k}", store)
    kept = sorted((r.id or "", r.text) for r in store.read(spark, "processed_tweets").collect())
    texts = {0: 0, 1: 1, 2: 2, 3: 0, 4: 0, 5: 2, 6: 0, 7: 2}
    assert kept == sorted([("", f"none {k}") for k in range(3)] + [(str(i), f"good {k}") for i, k in texts.items()])
    # The same rows under another name, one that loses and one that wins.
    for name in ("a9", "c0"):
        before = kept
        ingest_batch(store.read(spark, "raw_tweets").where("id IS NOT NULL").drop(DATE, BATCH), name, store)
        kept = sorted((r.id or "", r.text) for r in store.read(spark, "processed_tweets").collect())
        assert kept == before


def test_mended_lines_come_back_once_and_are_not_shuffled(spark, folder, monkeypatch):
    store = Store(f"{folder}/tables", 2)
    lines = spark.createDataFrame([('{"id": 1, "text": "a"', "b0"), ('{"id": 1, "text": "a"', "b1"), ("{junk", "b1")], f"line STRING, {BATCH} STRING")
    lines.write.partitionBy(BATCH).parquet(store.path("quarantine"))
    assert quarantine.release(spark, store, f"{folder}/in", lambda line: F.concat(line, F.lit("}")), "first") == 1
    assert [r.value for r in spark.read.text(f"{folder}/in").collect()] == ['{"id": 1, "text": "a"}']
    assert all(f.endswith(".gz") for f in spark.read.text(f"{folder}/in").inputFiles())
    assert [r.line for r in quarantine.quarantined(spark, store).collect()] == ["{junk"]
    assert quarantine.release(spark, Store(f"{folder}/none"), f"{folder}/in", lambda line: line, "first") == 0


def test_dates_are_merged_without_an_exchange(spark, folder, monkeypatch):
    store, days = Store(f"{folder}/tables", 2), [dt.date(2024, 1, d) for d in (10, 11)]
    for k in range(3):
        ingest_batch(raw(spark, *[message(f"{k}-{d}", created=f"2024-01-{d}T01:00:00") for d in (10, 11)]), f"b{k}", store)
    monkeypatch.setattr(closed, "FILE_BYTES", 1 << 20)
    merged = spark.read.parquet(closed.merge_dates(spark, store, days))
    assert sorted((r.id, r.tweet_date.day) for r in merged.collect()) == [(f"{k}-{d}", d) for k in range(3) for d in (10, 11)]
    assert len(merged.inputFiles()) == 2
    assert store.size(spark, "processed_tweets", days[0]) > 0 == store.size(spark, "processed_tweets", dt.date(2020, 1, 1))


def test_messages_are_appended_by_the_tasks_that_hold_them(spark, folder, monkeypatch):
    from murmura.sources import store as store_module

    monkeypatch.setattr(store_module, "_balanced", lambda df, keys: pytest.fail("texts would be shuffled"))
    append_messages(process_messages(raw(spark, message("1"), message("2", created="2024-01-11T00:00:00"))), f"{folder}/out")
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_a_joined_list_meets_words_not_tokens(spark, monkeypatch):
    """Copies of a text are scored once, the rows of a frequent one are split, and both plans agree."""
    monkeypatch.setattr(scoring, "HOT_COPIES", 10)
    texts = ["from the thing then only trash !", "THE thing!", "nothing here", "", None, "http://x.y @a", "don't trash"] * 25
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING").repartition(5)
    words = spark.createDataFrame(WORDS, LEXICON)
    columns = ["id", "text", "polarity", "subjectivity", "sentiment_label"]
    joined = score_sentiment(df, words, joined=True)
    inline = score_sentiment(df, words)
    assert joined.select(columns).orderBy("id").collect() == inline.select(columns).orderBy("id").collect()
    # No row for each token: what is exploded are the distinct words of a text.
    assert "explode(array_distinct(" in plan(joined) and "explode(transform" not in plan(joined)


def test_many_tasks_land_one_file(spark, folder):
    from murmura.sources.landing import land_in_one_file, read_messages

    rows = spark.createDataFrame([message(str(i), f"text {i}") for i in range(500)], raw(spark).schema).repartition(6)
    for k in range(2):
        land_in_one_file(rows.where(F.col("id").cast("int") % 2 == k), f"{folder}/in")
    landed = read_messages(spark, f"{folder}/in")
    assert len(landed.inputFiles()) == 2
    assert sorted((r.id, r.text, r.collected_at) for r in landed.collect()) == sorted((r.id, r.text, r.collected_at) for r in rows.collect())
