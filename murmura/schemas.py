"""Fixed schemas of the message tables."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
DATE = "tweet_date"
BATCH = "ingest_batch"

# Column names and types are the contract of the stored tables.
COUNTERS = ["retweet_count", "like_count", "reply_count", "quote_count"]


def _struct(columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_STR, _INT, _BIG = T.StringType(), T.IntegerType(), T.LongType()
_DBL, _TS, _DAY = T.DoubleType(), T.TimestampType(), T.DateType()

_HEAD = {"id": _STR, "text": _STR, "created_at": _TS, "author_id": _STR, "lang": _STR}
_COUNTS = {name: _INT for name in COUNTERS}

# JSON lines as they land. Ids and counters are read as text, so that 17, "17" and 17.0 are accepted.
LANDED = _struct(_HEAD | {name: _STR for name in COUNTERS} | {"collected_at": _TS, CORRUPT: _STR})
RAW = _struct(_HEAD | _COUNTS | {"collected_at": _TS})
RAW_LINES = _struct(_HEAD | _COUNTS | {"collected_at": _TS, CORRUPT: _STR})

# One record as the search service returns it, counters nested.
API_RECORD = _struct(_HEAD | {"public_metrics": _struct({name: _STR for name in COUNTERS})})

PROCESSED = _struct(
    _HEAD | _COUNTS | {"collected_at": _TS, "processed_at": _TS, DATE: _DAY, "tweet_hour": _INT}
)
SCORED = _struct(
    {f.name: f.dataType for f in PROCESSED.fields}
    | {"polarity": _DBL, "subjectivity": _DBL, "sentiment_label": _STR, "confidence": _DBL}
)

HOURLY = _struct(
    {DATE: _DAY, "tweet_hour": _INT, "sentiment_label": _STR, "tweet_count": _BIG,
     "avg_polarity": _DBL, "avg_confidence": _DBL}
)
DAILY = _struct(
    {DATE: _DAY, "sentiment_label": _STR, "tweet_count": _BIG, "avg_polarity": _DBL,
     "total_likes": _BIG, "total_retweets": _BIG}
)
TRENDING = _struct(
    {DATE: _DAY, "total_engagement": _BIG, "tweet_count": _BIG, "avg_sentiment": _DBL}
)
ROLLUP = _struct(
    {DATE: _DAY, "tweet_hour": _INT, "sentiment_label": _STR, "messages": _BIG,
     "polarity_sum": _DBL, "polarity_rows": _BIG, "confidence_sum": _DBL,
     "confidence_rows": _BIG, "likes": _BIG, "retweets": _BIG, "hot_messages": _BIG,
     "hot_likes": _BIG, "hot_polarity_sum": _DBL, "hot_polarity_rows": _BIG}
)

# One row per id and batch: its newest copy there, how many there were, whether it was the newest of all when it
# came, and the batch whose copy it then replaced.
VERSIONS = _struct(
    {"id": _STR, "created_us": _BIG, "collected_at": _TS} | _COUNTS
    | {BATCH: _STR, "copies": _BIG, "won": T.BooleanType(), "replaced": _STR, DATE: _DAY}
)
# What one ingest batch read and kept; finished is false until all its tables are written.
LEDGER = _struct(
    {"finished": T.BooleanType(), "raw_rows": _BIG, "broken_rows": _BIG, "files": _BIG, "messages": _BIG,
     "newest_collected": _TS, "dates": T.ArrayType(_DAY)}
)

# What a streaming query reported of one batch.
PROGRESS = _struct(
    {"batch_number": _BIG, "started": _TS, "input_rows": _BIG, "batch_seconds": _DBL, BATCH: _STR}
)

LEXICON = _struct(
    {"word": _STR, "kind": _STR, "polarity": _DBL, "subjectivity": _DBL, "intensity": _DBL}
)


def partitioned(schema: T.StructType, *names: str) -> T.StructType:
    """``schema`` as stored: partition columns last, the ones it lacks added as text.

    The date column is always a DATE, so directory names are never guessed at.
    """
    kept = [f for f in schema.fields if f.name not in names]
    typed = {f.name: f.dataType for f in schema.fields} | {DATE: _DAY}
    return T.StructType(kept + [T.StructField(n, typed.get(n, _STR)) for n in names])
