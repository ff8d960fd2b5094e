import datetime as dt

import pytest
from pyspark.sql import functions as F

from murmura.functions.measures import bucket_start, sentiment_category, sentiment_label
from murmura.operators import serving
from murmura.operators.aggregates import sentiment_rollup

AS_OF = dt.date(2024, 1, 10)


@pytest.fixture(scope="module")
def calendar(spark):
    """One neutral message a day, 1 to 15 January."""
    rows = [
        (dt.date(2024, 1, d), d % 24, "neutral", 0.05 * d, 0.05 * d, d, 1) for d in range(1, 16)
    ]
    return spark.createDataFrame(
        rows,
        "tweet_date DATE, tweet_hour INT, sentiment_label STRING, polarity DOUBLE,"
        " confidence DOUBLE, like_count INT, retweet_count INT",
    )


def test_label_and_category_edges(spark):
    df = spark.createDataFrame([(x,) for x in (0.31, 0.3, 0.11, 0.1, 0.0, -0.1, -0.11, -0.3, None)], "p DOUBLE")
    rows = df.select(sentiment_label(F.col("p")), sentiment_category(F.col("p"))).collect()
    assert [r[0] for r in rows] == [
        "positive", "positive", "positive", "neutral", "neutral", "neutral", "negative", "negative", "neutral",
    ]
    assert [r[1] for r in rows] == [
        "Very Positive", "Positive", "Positive", "Neutral", "Neutral", "Negative", "Negative",
        "Very Negative", "Very Negative",
    ]


def test_bucket_start(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), 7), (dt.date(2024, 1, 2), None)], "d DATE, h INT")
    rows = df.select(bucket_start(F.col("d"), F.col("h")).cast("string")).collect()
    assert [r[0] for r in rows] == ["2024-01-02 07:00:00", None]


def daily_of(calendar):
    return calendar.select("tweet_date", "sentiment_label", F.lit(1).cast("long").alias("tweet_count"),
                           F.col("polarity").alias("avg_polarity"))


def test_look_back_is_inclusive_and_ends_at_as_of(calendar):
    dates = [r.tweet_date.day for r in serving.sentiment_trends(daily_of(calendar), 7, "2024-01-10").collect()]
    assert dates == [10, 9, 8, 7, 6, 5, 4, 3]
    assert serving.sentiment_trends(daily_of(calendar), 1, AS_OF).count() == 2


def test_default_as_of_is_today(spark):
    daily = spark.sql(
        "SELECT date_sub(current_date(), n) AS tweet_date, 'x' AS sentiment_label,"
        " 1L AS tweet_count, 0.0D AS avg_polarity FROM VALUES (0), (7), (8), (-1) AS t(n)"
    )
    assert serving.sentiment_trends(daily).count() == 2


def test_hourly_pivot_counts_other_labels_in_the_total_only(spark):
    d = dt.date(2024, 1, 9)
    hourly = spark.createDataFrame(
        [(d, 3, "positive", 2), (d, 3, "mixed", 5), (d, 3, None, 1), (d, 1, "negative", 4),
         (d, 2, "neutral", 6), (dt.date(2024, 1, 3), 9, "neutral", 1), (dt.date(2024, 1, 4), 9, "neutral", 1)],
        "tweet_date DATE, tweet_hour INT, sentiment_label STRING, tweet_count BIGINT",
    )
    rows = serving.hourly_trends(hourly, "2024-01-09").collect()
    assert [tuple(r)[1:] for r in rows] == [(1, 0, 4, 0, 4), (2, 0, 0, 6, 6), (3, 2, 0, 0, 8)]
    recent = serving.hourly_trends_recent(hourly, as_of=AS_OF).collect()
    assert [(r.tweet_date.day, r.tweet_hour) for r in recent] == [(9, 1), (9, 2), (9, 3), (4, 9)]


def test_summary(spark, calendar):
    rows = serving.summary_stats(serving.dashboard_summary(calendar, AS_OF)).collect()
    by = {r.metric_type: r for r in rows}
    assert by["total_tweets"].total == 15 and by["total_tweets"].avg_sentiment is None
    assert (by["sentiment_distribution"].sentiment_label, by["sentiment_distribution"]["count"]) == ("neutral", 2)
    assert by["avg_sentiment"].avg_sentiment == pytest.approx(0.475)


def test_summary_of_nothing_has_a_null_average(calendar):
    empty = calendar.where("false")
    for summary in (serving.dashboard_summary(empty), serving.summary_from_rollup(sentiment_rollup(empty))):
        rows = {r.metric_type: r for r in serving.summary_stats(summary).collect()}
        assert set(rows) == {"total_tweets", "avg_sentiment"}
        assert rows["total_tweets"].total == 0 and rows["avg_sentiment"].avg_sentiment is None


def test_dataset_measures_and_order(spark):
    d = dt.date(2024, 1, 9)
    scored = spark.createDataFrame(
        [(d, 1, "negative", -0.4, 0.4, 3, None), (d, 2, "negative", -0.4, 0.4, 3, 4)],
        "tweet_date DATE, tweet_hour INT, sentiment_label STRING, polarity DOUBLE,"
        " confidence DOUBLE, like_count INT, retweet_count INT",
    )
    late, early = serving.dashboard_dataset(scored, as_of=AS_OF).collect()
    assert (late.tweet_hour, late.engagement_score, late.sentiment_strength) == (2, 7, 0.4)
    assert early.engagement_score is None


def test_rollup_serves_the_same_summary_and_dataset(calendar):
    rollup = sentiment_rollup(calendar)
    a = serving.dashboard_dataset(calendar, as_of=AS_OF).collect()
    assert a == serving.dashboard_dataset_from_rollup(rollup, as_of=AS_OF).collect()
    assert len(a) == 10
    one, two = (
        sorted(map(repr, serving.summary_stats(s).collect()))
        for s in (serving.dashboard_summary(calendar, AS_OF), serving.summary_from_rollup(rollup, AS_OF))
    )
    assert len(one) == len(two) == 3
