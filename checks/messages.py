"""Messages made from the given tables, and the word list used with them.

Every event is one message. Its text is a whole document: event ids are spread
over all documents, so both tables are used in full. Sign-ups count as re-posts
and clicks carry a link, a mention and a tag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.schemas import LEXICON, RAW
from murmura.session import pin_utc

MESSAGES_SQL = """
SELECT CAST(e.event_id AS {text_type}) AS id,
       concat(CASE WHEN e.event_type = 'signup' THEN 'RT @user: ' ELSE '' END,
              d.text,
              CASE WHEN e.event_type = 'click' THEN ' https://t.co/x @user #tag' ELSE '' END) AS text,
       e.ts AS created_at,
       CAST(e.user_id AS {text_type}) AS author_id,
       d.lang AS lang,
       CAST(minute(e.ts) AS INT) AS retweet_count,
       CAST(floor(e.value) AS INT) AS like_count,
       CAST(second(e.ts) AS INT) AS reply_count,
       CAST(hour(e.ts) AS INT) AS quote_count,
       e.ts + INTERVAL 1 HOUR AS collected_at
FROM (SELECT *, event_id % (SELECT count(*) FROM {counted}) AS doc_id FROM {events}) e
JOIN {documents} d ON d.doc_id = e.doc_id
"""

# The invented prose holds almost no sentiment words, so words it does hold stand in.
WORDS = [
    ("thing", "term", 0.6, 0.5, None),
    ("then", "term", 0.3, 0.4, None),
    ("idiot", "term", -0.8, 0.8, None),
    ("stupid", "term", -0.8, 1.0, None),
    ("worthless", "term", -0.8, 0.9, None),
    ("moron", "term", -0.7, 0.9, None),
    ("trash", "term", -0.5, 0.6, None),
    ("only", "modifier", None, None, 1.3),
    ("the", "modifier", None, None, 1.5),
    ("from", "negator", None, None, None),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Raw messages of all events, or of those given, joined as they are read; no copy of them is written.

    Before the join there are narrow events and each document once, after it a whole text for every event. So the
    two tables are spread by the join key, and the rows stay where the join makes them. Text lengths differ a
    thousandfold: there are several parts a core, and no fewer than the join itself would ask for, which
    would spread the documents a second time.
    """
    pin_utc(spark)
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    documents = table(spark, sf_dir, "documents")
    joined = spark.sql(
        MESSAGES_SQL.replace("{text_type}", "STRING"),
        documents=documents.repartition(parts, "doc_id"),
        counted=documents,
        events=table(spark, sf_dir, "events") if events is None else events,
    )
    times = {c: F.col(c).cast("timestamp") for c in ("created_at", "collected_at")}
    return joined.withColumns(times).select(*[F.col(f.name).cast(f.dataType) for f in RAW.fields])


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(WORDS, LEXICON)
