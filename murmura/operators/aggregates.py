"""Hourly, daily and engagement aggregates of scored messages.

All of them are partial-then-final aggregations over (date, hour, label), so
what is shuffled is one row per group and task whatever the number of messages,
and a date that holds most of the rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.schemas import DATE

# Fixed value: a message counts for engagement when it has more likes than this.
MIN_LIKES = 10


def hourly_sentiment(scored: DataFrame) -> DataFrame:
    return scored.groupBy(DATE, "tweet_hour", "sentiment_label").agg(
        F.count("*").alias("tweet_count"),
        F.avg("polarity").alias("avg_polarity"),
        F.avg("confidence").alias("avg_confidence"),
    )


def daily_sentiment(scored: DataFrame) -> DataFrame:
    return scored.groupBy(DATE, "sentiment_label").agg(
        F.count("*").alias("tweet_count"),
        F.avg("polarity").alias("avg_polarity"),
        F.sum("like_count").alias("total_likes"),
        F.sum("retweet_count").alias("total_retweets"),
    )


def trending_topics(scored: DataFrame, min_likes: int = MIN_LIKES) -> DataFrame:
    """Per-day totals over well-liked messages (there is no topic column)."""
    return scored.where(F.col("like_count") > min_likes).groupBy(DATE).agg(
        F.sum("like_count").alias("total_engagement"),
        F.count("*").alias("tweet_count"),
        F.avg("polarity").alias("avg_sentiment"),
    )


def create_aggregated_views(scored: DataFrame) -> dict[str, DataFrame]:
    """The three aggregates by name, each a lazy frame over ``scored``."""
    return {
        "hourly_sentiment": hourly_sentiment(scored),
        "daily_sentiment": daily_sentiment(scored),
        "trending_topics": trending_topics(scored),
    }


def sentiment_rollup(
    scored: DataFrame, min_likes: int = MIN_LIKES, by: Sequence[str] = ()
) -> DataFrame:
    """Sums and counts per (date, hour, label) from which every aggregate follows.

    One pass over the messages in place of one per aggregate. At most 24 rows
    per date and label, so everything derived from it is cheap. ``by`` adds
    columns to the key. Rows for parts of the messages add up to the rows for
    all of them, so new messages never need the old ones read again.
    """
    hot = F.col("like_count") > min_likes

    def when_hot(c: str) -> Column:
        return F.when(hot, F.col(c))

    return scored.groupBy(DATE, "tweet_hour", "sentiment_label", *by).agg(
        F.count("*").alias("messages"),
        F.sum("polarity").alias("polarity_sum"),
        F.count("polarity").alias("polarity_rows"),
        F.sum("confidence").alias("confidence_sum"),
        F.count("confidence").alias("confidence_rows"),
        F.sum("like_count").alias("likes"),
        F.sum("retweet_count").alias("retweets"),
        F.count(F.when(hot, 1)).alias("hot_messages"),
        F.coalesce(F.sum(when_hot("like_count")), F.lit(0)).alias("hot_likes"),
        F.coalesce(F.sum(when_hot("polarity")), F.lit(0.0)).alias("hot_polarity_sum"),
        F.count(when_hot("polarity")).alias("hot_polarity_rows"),
    )


def rollup_mean(name: str) -> Column:
    """Average of a measure over rollup rows; NULL where no message had a value."""
    return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_rows"))


def views_from_rollup(rollup: DataFrame) -> dict[str, DataFrame]:
    """The frames of ``create_aggregated_views`` without reading messages again.

    ``rollup`` may hold several rows per (date, hour, label), one per batch.
    """
    return {
        "hourly_sentiment": rollup.groupBy(DATE, "tweet_hour", "sentiment_label").agg(
            F.sum("messages").alias("tweet_count"),
            rollup_mean("polarity").alias("avg_polarity"),
            rollup_mean("confidence").alias("avg_confidence"),
        ),
        "daily_sentiment": rollup.groupBy(DATE, "sentiment_label").agg(
            F.sum("messages").alias("tweet_count"),
            rollup_mean("polarity").alias("avg_polarity"),
            F.sum("likes").alias("total_likes"),
            F.sum("retweets").alias("total_retweets"),
        ),
        "trending_topics": rollup.where(F.col("hot_messages") > 0).groupBy(DATE).agg(
            F.sum("hot_likes").alias("total_engagement"),
            F.sum("hot_messages").alias("tweet_count"),
            rollup_mean("hot_polarity").alias("avg_sentiment"),
        ),
    }
