"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the input tables, BENCH_CPUS the local cores. Every query runs
in full into the ``noop`` sink; the better of two runs counts, after a warm-up.
The ingest and the two scoring comparisons run once.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from checks import queries as registry  # noqa: E402
from checks.messages import lexicon, messages  # noqa: E402
from murmura.operators.scoring import score_sentiment  # noqa: E402
from murmura.session import build_session, scratch_dir  # noqa: E402
from murmura.sources.landing import land_messages, read_messages  # noqa: E402
from murmura.sources.store import Store  # noqa: E402
from murmura.streaming.ingest import ingest_landing  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
HEADLINE = [
    "process_messages", "clean_text", "keyword_filter", "recent_n", "latest_by_id",
    "sentiment_scores", "batch_analyze", "hourly_sentiment", "daily_sentiment", "trending_topics",
    "sentiment_rollup", "sentiment_trends", "hourly_last_7_days", "summary_stats",
    "dashboard_dataset",
]
STORED = [
    "stored_hourly_sentiment", "catalog_sentiment_trends", "dashboard_job", "summary_job",
    "stream_hourly",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action, runs: int = 2) -> float:
    best = float("inf")
    for _ in range(runs):
        start = time.perf_counter()
        action()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def ingest(spark, landing: str) -> None:
    """The landed JSON through processing, dedup, scoring, storing and aggregating."""
    root = scratch_dir(spark, "bench-ingest")
    ingest_landing(
        spark, landing, Store(f"{root}/tables"), f"{root}/checkpoint", lexicon=lexicon(spark)
    ).awaitTermination()


def row_at_a_time(spark, landing: str):
    """The same scoring as a row-at-a-time Python UDF, for comparison."""
    spark.sparkContext.addPyFile(os.path.join(HERE, "tests", "plain_rule.py"))
    from checks.messages import WORDS
    from pyspark.sql import functions as F

    @F.udf("polarity DOUBLE, subjectivity DOUBLE")
    def score(text):
        from plain_rule import brute_score

        return brute_score(text, WORDS)

    return read_messages(spark, landing).select("id", score("text").alias("s")).select("id", "s.*")


def main() -> None:
    memory = os.environ.get("BENCH_DRIVER_MEMORY", "8g")
    spark = build_session(
        "murmura-bench",
        f"local[{CPUS}]",
        driver_memory=memory,
        conf={
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="murmura-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    run(queries["sentiment_scores"](spark, SF_DIR))
    seconds = {name: timed(lambda n=name: run(queries[n](spark, SF_DIR))) for name in HEADLINE}

    landing = scratch_dir(spark, "bench-landing")
    land_messages(messages(spark, SF_DIR), landing)
    seconds["ingest_landing"] = timed(lambda: ingest(spark, landing), runs=1)
    registry.stored(spark, SF_DIR)
    for name in STORED:
        seconds[name] = timed(lambda n=name: run(queries[n](spark, SF_DIR)))

    landed = read_messages(spark, landing)
    rows = landed.count()
    native = timed(lambda: run(score_sentiment(landed, lexicon(spark))), runs=1)
    python = timed(lambda: run(row_at_a_time(spark, landing)), runs=1)
    print(
        json.dumps(
            {
                "metric": "message analytics, total of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "messages": rows,
                "ingest_messages_per_sec": round(rows / seconds["ingest_landing"]),
                "score_all_native_sec": native,
                "score_all_row_udf_sec": python,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
