"""Look-back queries, summaries and the dashboard dataset.

``as_of`` stands for the current date, which is its default. Each function
takes the table it reads, so the same query runs on a stored table, a catalog
table or a frame that is still lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.functions.dates import AsOf, day, last_dates, within_days
from murmura.functions.measures import (
    LABELS,
    bucket_start,
    engagement_score,
    sentiment_category,
    sentiment_strength,
)
from murmura.operators.aggregates import rollup_mean
from murmura.schemas import DATE

# Look-back spans in days.
TREND_DAYS = 7
EXTRACT_DAYS = 30
SUMMARY_DAYS = 1
HOURLY_DATES = 7


def trends_view(daily: DataFrame) -> DataFrame:
    """Daily aggregate with its sentiment category; consumers sort."""
    return daily.select(
        DATE,
        "sentiment_label",
        "tweet_count",
        "avg_polarity",
        sentiment_category(F.col("avg_polarity")).alias("sentiment_category"),
    )


def hourly_view(hourly: DataFrame) -> DataFrame:
    """One row per date and hour with a count per label; other labels count in the total."""

    def count_of(label: str) -> Column:
        counted = F.when(F.col("sentiment_label") == label, F.col("tweet_count")).otherwise(0)
        return F.sum(counted).alias(f"{label}_count")

    return hourly.groupBy(DATE, "tweet_hour").agg(
        *[count_of(label) for label in LABELS],
        F.sum("tweet_count").alias("total_count"),
    )


def sentiment_trends(daily: DataFrame, days: int = TREND_DAYS, as_of: AsOf = None) -> DataFrame:
    """Trends of the last ``days`` days, newest date first."""
    recent = daily.where(within_days(F.col(DATE), days, as_of))
    return trends_view(recent).orderBy(F.desc(DATE), F.asc("sentiment_label"))


def hourly_trends(hourly: DataFrame, date: AsOf) -> DataFrame:
    """Hourly label counts of one date in hour order."""
    return hourly_view(hourly.where(F.col(DATE) == day(date))).orderBy("tweet_hour")


def hourly_trends_recent(
    hourly: DataFrame, dates: int = HOURLY_DATES, as_of: AsOf = None
) -> DataFrame:
    """Hourly label counts of the last ``dates`` dates in one range scan."""
    recent = hourly.where(last_dates(F.col(DATE), dates, as_of))
    return hourly_view(recent).orderBy(F.desc(DATE), F.asc("tweet_hour"))


def total_count(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count("*").alias("total"))


def label_distribution(
    scored: DataFrame, days: int = SUMMARY_DAYS, as_of: AsOf = None
) -> DataFrame:
    recent = scored.where(within_days(F.col(DATE), days, as_of))
    return recent.groupBy("sentiment_label").agg(F.count("*").alias("count"))


def avg_sentiment(scored: DataFrame, days: int = SUMMARY_DAYS, as_of: AsOf = None) -> DataFrame:
    """One row; its value is NULL when no message falls in the span."""
    recent = scored.where(within_days(F.col(DATE), days, as_of))
    return recent.agg(F.avg("polarity").alias("avg_sentiment"))


def dashboard_summary(scored: DataFrame, as_of: AsOf = None) -> dict[str, DataFrame]:
    """The three summary frames by metric name."""
    return {
        "total_tweets": total_count(scored),
        "sentiment_distribution": label_distribution(scored, as_of=as_of),
        "avg_sentiment": avg_sentiment(scored, as_of=as_of),
    }


def summary_from_rollup(rollup: DataFrame, as_of: AsOf = None) -> dict[str, DataFrame]:
    """``dashboard_summary`` from the rollup, without reading messages."""
    recent = rollup.where(within_days(F.col(DATE), SUMMARY_DAYS, as_of))
    return {
        "total_tweets": rollup.agg(F.coalesce(F.sum("messages"), F.lit(0)).alias("total")),
        "sentiment_distribution": recent.groupBy("sentiment_label").agg(
            F.sum("messages").alias("count")
        ),
        "avg_sentiment": recent.agg(rollup_mean("polarity").alias("avg_sentiment")),
    }


def summary_stats(summary: dict[str, DataFrame]) -> DataFrame:
    """Summary frames stacked under their ``metric_type``; cells a metric lacks are NULL."""
    tagged = [df.withColumn("metric_type", F.lit(name)) for name, df in summary.items()]
    stacked = tagged[0]
    for df in tagged[1:]:
        stacked = stacked.unionByName(df, allowMissingColumns=True)
    return stacked


def dashboard_dataset(
    scored: DataFrame, days: int = EXTRACT_DAYS, as_of: AsOf = None
) -> DataFrame:
    """Hourly figures of the last ``days`` days with the derived measures."""
    grouped = (
        scored.where(within_days(F.col(DATE), days, as_of))
        .groupBy(DATE, "tweet_hour", "sentiment_label")
        .agg(
            F.count("*").alias("tweet_count"),
            F.avg("polarity").alias("avg_polarity"),
            F.avg("confidence").alias("avg_confidence"),
            F.sum("like_count").alias("total_likes"),
            F.sum("retweet_count").alias("total_retweets"),
        )
    )
    return _with_measures(grouped)


def dashboard_dataset_from_rollup(
    rollup: DataFrame, days: int = EXTRACT_DAYS, as_of: AsOf = None
) -> DataFrame:
    """``dashboard_dataset`` from the rollup, without reading messages."""
    recent = rollup.where(within_days(F.col(DATE), days, as_of))
    grouped = recent.groupBy(DATE, "tweet_hour", "sentiment_label").agg(
        F.sum("messages").alias("tweet_count"),
        rollup_mean("polarity").alias("avg_polarity"),
        rollup_mean("confidence").alias("avg_confidence"),
        F.sum("likes").alias("total_likes"),
        F.sum("retweets").alias("total_retweets"),
    )
    return _with_measures(grouped)


def _with_measures(grouped: DataFrame) -> DataFrame:
    return grouped.select(
        "*",
        engagement_score(F.col("total_likes"), F.col("total_retweets")).alias("engagement_score"),
        sentiment_strength(F.col("avg_polarity")).alias("sentiment_strength"),
        bucket_start(F.col(DATE), F.col("tweet_hour")).alias("datetime"),
    ).orderBy(F.desc(DATE), F.desc("tweet_hour"), F.asc("sentiment_label"))
