"""Labels, categories and derived dashboard measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label threshold, and category bands by lower bound (all comparisons strict).
LABEL_THRESHOLD = 0.1
LABELS = ["positive", "negative", "neutral"]
CATEGORY_BANDS = [
    (0.3, "Very Positive"),
    (0.1, "Positive"),
    (-0.1, "Neutral"),
    (-0.3, "Negative"),
]
LOWEST_CATEGORY = "Very Negative"


def sentiment_label(polarity: Column, threshold: float = LABEL_THRESHOLD) -> Column:
    """``positive`` above the threshold, ``negative`` below its negation, else ``neutral``."""
    return (
        F.when(polarity > F.lit(threshold), "positive")
        .when(polarity < F.lit(-threshold), "negative")
        .otherwise("neutral")
    )


def confidence(polarity: Column) -> Column:
    return F.abs(polarity)


def sentiment_category(avg_polarity: Column) -> Column:
    """Band of an average polarity; a missing average falls in the lowest one."""
    (top, top_name), *others = CATEGORY_BANDS
    band = F.when(avg_polarity > F.lit(top), top_name)
    for bound, name in others:
        band = band.when(avg_polarity > F.lit(bound), name)
    return band.otherwise(LOWEST_CATEGORY)


def sentiment_category_sql(avg_polarity: str) -> str:
    """The same bands as SQL text, for catalog views."""
    tests = " ".join(f"WHEN {avg_polarity} > {bound}D THEN '{name}'" for bound, name in CATEGORY_BANDS)
    return f"CASE {tests} ELSE '{LOWEST_CATEGORY}' END"


def engagement_score(likes: Column, retweets: Column) -> Column:
    return likes + retweets


def sentiment_strength(avg_polarity: Column) -> Column:
    return F.abs(avg_polarity)


def bucket_start(date: Column, hour: Column) -> Column:
    """The timestamp at which an hourly (date, hour) bucket starts."""
    return F.timestamp_add("HOUR", hour, date.cast("timestamp"))


def counter(value: Column) -> Column:
    """A count out of a number or its text: 7, "7" and 7.0 are 7; what cannot be read is NULL."""
    return value.try_cast("decimal(38,6)").try_cast("int")
