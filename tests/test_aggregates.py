import datetime as dt
import math

import pytest

from murmura.operators.aggregates import (
    create_aggregated_views,
    sentiment_rollup,
    views_from_rollup,
)
from murmura.schemas import DAILY, HOURLY, ROLLUP, TRENDING

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
SCHEMA = (
    "tweet_date DATE, tweet_hour INT, sentiment_label STRING, polarity DOUBLE, confidence DOUBLE,"
    " like_count INT, retweet_count INT"
)
ROWS = [
    (D1, 5, "positive", 0.5, 0.5, 11, 1),
    (D1, 5, "positive", 0.7, 0.7, 10, 2),
    (D1, 6, "positive", 0.2, 0.2, None, None),
    (D1, 6, "negative", -0.4, 0.4, 50, 0),
    (D1, 7, "neutral", None, None, 30, 4),
    (D2, 5, "neutral", 0.0, 0.0, 10, None),
    (None, None, "neutral", 0.0, 0.0, 12, 1),
]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def as_dict(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_hourly(scored):
    rows = as_dict(create_aggregated_views(scored)["hourly_sentiment"], "tweet_date", "tweet_hour", "sentiment_label")
    assert len(rows) == 6
    first = rows[D1, 5, "positive"]
    assert (first.tweet_count, first.avg_polarity, first.avg_confidence) == (2, 0.6, 0.6)
    assert rows[D1, 7, "neutral"].avg_polarity is None


def test_daily(scored):
    rows = as_dict(create_aggregated_views(scored)["daily_sentiment"], "tweet_date", "sentiment_label")
    r = rows[D1, "positive"]
    assert (r.tweet_count, r.total_likes, r.total_retweets) == (3, 21, 3)
    assert math.isclose(r.avg_polarity, (0.5 + 0.7 + 0.2) / 3)
    assert rows[D2, "neutral"].total_retweets is None


def test_trending_is_strictly_above_ten(scored):
    rows = as_dict(create_aggregated_views(scored)["trending_topics"], "tweet_date")
    assert set(rows) == {(D1,), (None,)}
    r = rows[(D1,)]
    assert (r.total_engagement, r.tweet_count) == (91, 3)
    assert math.isclose(r.avg_sentiment, (0.5 - 0.4) / 2)


def test_rollup_gives_the_same_views(scored):
    direct = create_aggregated_views(scored)
    derived = views_from_rollup(sentiment_rollup(scored))
    for name, view in direct.items():
        assert derived[name].columns == view.columns
        a, b = ([tuple(r) for r in df.collect()] for df in (view, derived[name]))
        assert len(a) == len(b)
        for x, y in zip(sorted(a, key=repr), sorted(b, key=repr)):
            assert x[:2] == y[:2]
            for p, q in zip(x, y):
                assert p == q or math.isclose(p, q, abs_tol=1e-12)


def test_column_types_are_the_stored_ones(scored):
    views = create_aggregated_views(scored) | {"sentiment_rollup": sentiment_rollup(scored)}
    wanted = {
        "hourly_sentiment": HOURLY, "daily_sentiment": DAILY, "trending_topics": TRENDING,
        "sentiment_rollup": ROLLUP,
    }
    for name, schema in wanted.items():
        assert dict(views[name].dtypes) == {f.name: f.dataType.simpleString() for f in schema.fields}


def test_nothing_in_nothing_out(scored):
    empty = scored.where("false")
    assert all(v.isEmpty() for v in create_aggregated_views(empty).values())
    assert all(v.isEmpty() for v in views_from_rollup(sentiment_rollup(empty)).values())
