"""Small builders shared by the tests."""

import datetime as dt
import json
import os

from murmura.schemas import RAW

def message(id="1", text="hello", created="2024-01-10T12:00:00", lang="en", likes=0, retweets=0,
            collected="2024-01-10T13:00:00"):
    def time(x):
        return None if x is None else dt.datetime.fromisoformat(x).replace(tzinfo=dt.timezone.utc)

    return (id, text, time(created), "a", lang, retweets, likes, 0, 0, time(collected))


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


def land(folder, name, records):
    """A landing file as the collector writes it."""
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        for record in records:
            f.write((record if isinstance(record, str) else json.dumps(record)) + "\n")


def record(id, text="I love this!", created="2024-01-10T12:00:00+00:00", likes=11, **more):
    return {
        "id": id, "text": text, "created_at": created, "author_id": 7, "lang": "en",
        "retweet_count": 2, "like_count": likes, "reply_count": 0, "quote_count": 0,
        "collected_at": "2024-01-10T13:00:00.123456",
    } | more


def plan(df):
    return df._jdf.queryExecution().toString()
