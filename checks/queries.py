"""One registered query per operator, over the whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.messages import lexicon, messages, table
from murmura.functions.measures import sentiment_label
from murmura.functions.text import clean_text
from murmura.operators import aggregates, serving
from murmura.operators.messages import (
    flatten_records,
    keyword_filter,
    latest_by_id,
    most_recent,
    process_messages,
)
from murmura.operators.ordering import with_position
from murmura.operators.scoring import analyze_text, batch_analyze, register_scorer, score_sentiment
from murmura.operators.search import search_index, write_index
from murmura.plans.dashboard import export_dataset, export_extracts, refresh_dashboard, run_all
from murmura.plans.health import health_report, message_freshness, save_health_report
from murmura.plans.ingest import collect_messages, ingest_file, rebuild_aggregates
from murmura.schemas import COUNTERS, DATE
from murmura.session import pin_utc, scratch_dir
from murmura.sources.closed import closed_messages, compact_dates, create_closed, merge_dates, switch_dates
from murmura.sources.landing import (
    LANDED_AS,
    LANDED_TIME,
    land_in_one_file,
    land_messages,
    newest_file_time,
    read_messages,
    read_records,
    stream_messages,
)
from murmura.sources.quarantine import quarantined, release
from murmura.sources.store import (
    CODEC,
    Store,
    append_messages,
    create_catalog,
    execute_query,
    overwrite_partitions,
    refresh_catalog,
    write_csv,
)
from murmura.streaming.ingest import ingest_landing
from murmura.streaming.lag import record_progress, stream_lag
from murmura.streaming.live import hourly_counts, unique_by_id
from murmura.streaming.reconcile import published_hours, reconciled_hours

# Parameters of the registered queries; the data covers January 2024.
AS_OF = dt.date(2024, 1, 30)
ONE_DATE = dt.date(2024, 1, 15)
CHECKED_AT = dt.datetime(2024, 1, 31, 1, 0, 0)
# Words of the invented prose, one of them a phrase.
KEYWORDS = ["thing", "stupid", "only from"]
NEWEST = 500


def plain(df: DataFrame) -> DataFrame:
    """Times without a zone and rounded averages, as the SQL side gives them.

    Sums differ in their last bits with the order of addition. Rounding hides
    that, and the tiny shift keeps means that end in a tie, such as 59/128, from
    going up on one side and down on the other.
    """
    changed = {}
    for name, kind in df.dtypes:
        if kind == "timestamp":
            changed[name] = F.col(name).cast("timestamp_ntz")
        elif kind == "double":
            changed[name] = F.round(F.col(name) + F.lit(1e-12), 9)
    return df.withColumns(changed) if changed else df


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process_messages(messages(spark, sf_dir)).drop("processed_at")


def scored(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return score_sentiment(processed(spark, sf_dir), lexicon(spark), **options)


def _scores(df: DataFrame) -> DataFrame:
    return df.select("id", "polarity", "subjectivity", "sentiment_label", "confidence")


def _summary(df: DataFrame) -> DataFrame:
    """Counts that most rows lack, as doubles: both sides then show a gap the same way."""
    return plain(df.withColumns({c: F.col(c).cast("double") for c in ("total", "count")}))


def _collected_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of views, collected once more two hours later with more likes."""
    events = table(spark, sf_dir, "events")
    # Ids are told apart before the join with the documents: no text crosses an exchange for it.
    ids = events.where("event_type = 'view'").select("event_id")
    viewed = messages(spark, sf_dir, events.join(ids, "event_id", "left_semi"))
    return viewed.withColumns(
        {
            "like_count": F.col("like_count") + 5,
            "collected_at": F.timestamp_add("HOUR", F.lit(2), "collected_at"),
        }
    )


def _recollected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).unionByName(_collected_again(spark, sf_dir))


# --- stored tables, written once per session and scale ---------------------------------

_stores: dict[tuple[str, str], tuple[Store, str]] = {}


def stored(spark: SparkSession, sf_dir: str) -> tuple[Store, str]:
    """A store filled by the stream ingest from a landing folder, and that folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        pin_utc(spark)
        root = scratch_dir(spark, "store")
        landing = f"{root}/landing"
        land_messages(messages(spark, sf_dir), landing)
        store = Store(f"{root}/tables")
        # About three batches, so that several batches meet in every date.
        files = len(read_messages(spark, landing).inputFiles())
        ingest_landing(
            spark, landing, store, f"{root}/checkpoint",
            lexicon=lexicon(spark), files_per_batch=-(-files // 3),
        ).awaitTermination()
        _stores[key] = (store, landing)
    return _stores[key]


_ordered: dict[tuple[str, str], str] = {}


def in_time_order(spark: SparkSession, sf_dir: str) -> str:
    """A landing folder filled in four rounds in order of time, one file a core each; once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ordered:
        rows = messages(spark, sf_dir)
        bounds = rows.select(F.unix_micros("created_at").alias("t")).approxQuantile("t", [0.25, 0.5, 0.75], 0.01)
        part = sum(((F.unix_micros("created_at") >= F.lit(int(b))).cast("int") for b in bounds), F.lit(0))
        _ordered[key] = scratch_dir(spark, "ordered")
        for i in range(len(bounds) + 1):
            land_messages(rows.where(part == i).coalesce(spark.sparkContext.defaultParallelism), _ordered[key])
    return _ordered[key]


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = stored(spark, sf_dir)
    kept = store.read(spark, "processed_tweets").drop("processed_at", "ingest_batch")
    return plain(kept)


def ingest_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed files ingested twice: as one named batch and then as a stream."""
    _, landing = stored(spark, sf_dir)
    root = scratch_dir(spark, "again")
    store = Store(f"{root}/tables")
    ingest_file(spark, landing, store, lexicon(spark))
    ingest_landing(
        spark, landing, store, f"{root}/checkpoint", lexicon=lexicon(spark)
    ).awaitTermination()
    return store.read(spark, "daily_sentiment").transform(plain)


def ingest_recollected(rounds: int) -> Callable[[SparkSession, str], DataFrame]:
    """Messages and their later copies landed in so many rounds of several files, ingested in a batch for each round.

    Copies are dealt out to the rounds by chance. The files are put together out of the join's parts, so no text
    crosses an exchange for them.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, files = scratch_dir(spark, "recollected"), spark.sparkContext.defaultParallelism
        rows, dealt = _recollected(spark, sf_dir), F.pmod(F.xxhash64("id", "collected_at"), F.lit(rounds))
        for i in range(rounds):
            land_messages(rows.where(dealt == i).coalesce(files), f"{root}/landing")
        store = Store(f"{root}/tables")
        ingest_landing(
            spark, f"{root}/landing", store, f"{root}/checkpoint",
            lexicon=lexicon(spark), files_per_batch=files,
        ).awaitTermination()
        return store.read(spark, "daily_sentiment").transform(plain)

    return run


def ingest_rotated_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One path ingested twice, with other files the second time."""
    root = scratch_dir(spark, "rotated")
    store, landing = Store(f"{root}/tables"), f"{root}/landing"
    half = F.pmod(F.xxhash64("id"), F.lit(2))
    for part in (0, 1):
        now = messages(spark, sf_dir).where(half == part)
        now.write.mode("overwrite").options(**LANDED_AS).json(landing)
        ingest_file(spark, landing, store, lexicon(spark))
    return store.read(spark, "daily_sentiment").transform(plain)


def text_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters landed as text, as decimals and as junk, beside a line that is no JSON."""
    folder = scratch_dir(spark, "counters")
    first = messages(spark, sf_dir).where("lang = 'en'")
    first.select(
        "id", "text", "lang", "created_at",
        F.col("retweet_count").cast("string").alias("retweet_count"),
        F.col("like_count").cast("double").alias("like_count"),
        F.concat(F.lit("x"), F.col("reply_count").cast("string")).alias("reply_count"),
    ).write.options(**LANDED_AS).json(folder)
    first.select(F.concat(F.lit("{"), "id").alias("value")).write.mode("append").text(folder)
    read = process_messages(read_messages(spark, folder).where("_corrupt_record IS NULL"))
    return read.select("id", *COUNTERS)


def rebuild_after_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored messages corrected so that a label, all hot messages and a whole date vanish."""
    root = scratch_dir(spark, "corrected")
    store = Store(f"{root}/tables")
    land_messages(messages(spark, sf_dir), f"{root}/landing")
    dates = ingest_file(spark, f"{root}/landing", store, lexicon(spark))
    # Read while it is replaced: partitions change only when all of the new ones are written.
    kept = store.read(spark, "processed_tweets").where(
        (F.col("sentiment_label") != "negative") & (F.col(DATE) != F.lit(ONE_DATE))
    ).withColumn("like_count", F.least("like_count", F.lit(10)))
    named = store.read(spark, "processed_tweets").select(DATE, "ingest_batch").distinct().collect()
    store.replace(kept, "processed_tweets", named)
    rebuild_aggregates(spark, store, dates)
    days = store.read(spark, "daily_sentiment").select(
        DATE, "sentiment_label", "tweet_count", "avg_polarity", "total_likes", "total_retweets"
    )
    hot = store.read(spark, "trending_topics").select(
        DATE, F.lit("hot").alias("sentiment_label"), "tweet_count", F.col("avg_sentiment").alias("avg_polarity"),
        F.col("total_engagement").alias("total_likes"), F.lit(0).cast("long").alias("total_retweets"),
    )
    return plain(days.unionByName(hot))


def settled_copy(df: DataFrame, root: str) -> DataFrame:
    df.write.parquet(f"{root}/copy", compression=CODEC)
    return df.sparkSession.read.parquet(f"{root}/copy")


def collect_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every match collected and landed."""
    root = scratch_dir(spark, "collect-all")
    nested = messages(spark, sf_dir).select(
        "id", "text", "created_at", "author_id", "lang", F.struct(*COUNTERS).alias("public_metrics")
    )
    collect_messages(nested, f"{root}/landing", KEYWORDS)
    landed = read_messages(spark, f"{root}/landing")
    return plain(landed.drop("_corrupt_record", "collected_at"))


def trends_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month of trends as the extract job writes it."""
    store, _ = stored(spark, sf_dir)
    out = scratch_dir(spark, "extracts")
    export_extracts(spark, store, out, AS_OF)
    columns = (
        f"{DATE} DATE, sentiment_label STRING, tweet_count BIGINT, avg_polarity DOUBLE, sentiment_category STRING"
    )
    return plain(spark.read.option("header", True).schema(columns).csv(f"{out}/sentiment_trends"))


def catalog_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog's hourly view."""
    store, _ = stored(spark, sf_dir)
    database = "sentiment_db_" + store.root.rstrip("/").split("-")[-1].split("/")[0]
    create_catalog(spark, store, database)
    refresh_catalog(spark, database)
    return execute_query(spark, f"SELECT * FROM {database}.hourly_trends")


def stored_aggregate(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(stored(spark, sf_dir)[0].read(spark, name))

    return run


def catalog_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL with parameters over the catalog's view."""
    store, _ = stored(spark, sf_dir)
    database = "sentiment_db_" + store.root.rstrip("/").split("-")[-1].split("/")[0]
    create_catalog(spark, store, database)
    refresh_catalog(spark, database)
    return plain(
        execute_query(
            spark,
            f"SELECT {DATE}, sentiment_label, tweet_count, avg_polarity, sentiment_category "
            f"FROM {database}.sentiment_trends "
            f"WHERE {DATE} BETWEEN date_sub(:as_of, :days) AND :as_of "
            f"ORDER BY {DATE} DESC, sentiment_label",
            {"as_of": AS_OF, "days": 7},
        )
    )


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "json")
    land_messages(messages(spark, sf_dir), folder)
    return plain(read_messages(spark, folder).drop("_corrupt_record"))


def collect_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested records searched, cut to the newest, landed and read back."""
    root = scratch_dir(spark, "collect")
    nested = messages(spark, sf_dir).select(
        "id", "text", "created_at", "author_id", "lang", F.struct(*COUNTERS).alias("public_metrics")
    )
    land_messages(nested, f"{root}/records")
    collect_messages(read_records(spark, f"{root}/records"), f"{root}/landing", KEYWORDS, NEWEST)
    landed = read_messages(spark, f"{root}/landing")
    return plain(landed.drop("_corrupt_record", "collected_at"))


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything appended and read back."""
    folder = scratch_dir(spark, "parquet")
    append_messages(processed(spark, sf_dir), folder)
    return plain(spark.read.parquet(folder))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "csv")
    dataset = serving.dashboard_dataset(scored(spark, sf_dir), as_of=AS_OF)
    write_csv(plain(dataset), folder)
    return spark.read.option("header", True).schema(plain(dataset).schema).csv(folder)


def dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily figures, then one date's written anew with its counts doubled."""
    folder = scratch_dir(spark, "overwrite")
    daily = aggregates.daily_sentiment(scored(spark, sf_dir))
    overwrite_partitions(daily, folder, [DATE])
    doubled = daily.where(F.col(DATE) == F.lit(ONE_DATE)).withColumn(
        "tweet_count", F.col("tweet_count") * 2
    )
    overwrite_partitions(doubled, folder, [DATE])
    return plain(spark.read.parquet(folder))


def dashboard_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main dataset as the export job writes it, from the stored rollup."""
    store, _ = stored(spark, sf_dir)
    out = scratch_dir(spark, "dashboard")
    dataset = export_dataset(spark, store, out, AS_OF)
    written = spark.read.option("header", True).schema(dataset.schema).csv(f"{out}/main_sentiment_data")
    return plain(written)


def summary_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary as the dashboard job writes it, from the stored rollup."""
    store, _ = stored(spark, sf_dir)
    out = scratch_dir(spark, "summary")
    refresh_dashboard(spark, store, out, AS_OF)
    columns = "total BIGINT, metric_type STRING, sentiment_label STRING, count BIGINT, avg_sentiment DOUBLE"
    return _summary(spark.read.option("header", True).schema(columns).csv(f"{out}/summary_stats"))


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report an hour, and once more two hours and a second, after the newest file landed."""
    store, landing = stored(spark, sf_dir)
    newest = newest_file_time(spark, landing).first()["newest"]
    reports = [
        health_report(spark, landing, store, newest + dt.timedelta(seconds=s)).withColumns({
            "timestamp": F.round((F.unix_micros("timestamp") - F.unix_micros("newest_file")) / 1e6, 3),
            "newest_file": F.col("newest_file").isNotNull(),
            "age_seconds": F.round("age_seconds", 3),
        })
        for s in (3600, 7201)
    ]
    return reports[0].unionByName(reports[1])


def _words_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list too large to travel with the plan: the test words, and a made-up value for every word of the documents."""
    words = table(spark, sf_dir, "documents").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0))).alias("word")
    ).distinct()
    first, own = F.ascii("word"), lexicon(spark)
    made = words.join(own.select("word"), "word", "left_anti").select(
        "word", F.lit("term").alias("kind"),
        ((F.pmod(first * 7 + F.length("word"), F.lit(21)) - 10) / F.lit(10.0)).alias("polarity"),
        (F.pmod(F.length("word"), F.lit(5)) / F.lit(4.0)).alias("subjectivity"),
        F.lit(None).cast("double").alias("intensity"),
    )
    return own.unionByName(made)


def stream_large_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream ingest with a word list that has to be joined."""
    words = settled_copy(_words_of_documents(spark, sf_dir), scratch_dir(spark, "words"))
    root = scratch_dir(spark, "large-list")
    land_messages(messages(spark, sf_dir), f"{root}/landing")
    store = Store(f"{root}/tables")
    ingest_landing(
        spark, f"{root}/landing", store, f"{root}/checkpoint", lexicon=words, joined=True
    ).awaitTermination()
    return plain(_scores(store.read(spark, "processed_tweets")))


def with_late_files(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """A landing folder in order of time but for every seventh message, which lands last; files a round."""
    landing, files = scratch_dir(spark, "late"), spark.sparkContext.defaultParallelism
    rows = messages(spark, sf_dir)
    late = F.pmod(F.xxhash64("id"), F.lit(7)) == 0
    middle = rows.select(F.unix_micros("created_at").alias("t")).approxQuantile("t", [0.5], 0.01)[0]
    first = F.unix_micros("created_at") < F.lit(int(middle))
    for part in (~late & first, ~late & ~first, late):
        land_messages(rows.where(part).coalesce(files), landing)
    return landing, files


def stream_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts of closed hours when a seventh of the messages comes after its hour was published."""
    landing, files = with_late_files(spark, sf_dir)
    live = score_sentiment(process_messages(stream_messages(spark, landing, files_per_batch=files)), lexicon(spark))
    root = scratch_dir(spark, "reconciled")
    reconciled_hours(live, f"{root}/tables", f"{root}/checkpoint", 3600).awaitTermination()
    return published_hours(spark, f"{root}/tables")


def lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an ingest of four files, one a batch, reports of itself; the times it took are left out."""
    root = scratch_dir(spark, "lag")
    rows = messages(spark, sf_dir)
    for quarter in range(4):
        part = rows.where(F.pmod(F.col("id").cast("long"), F.lit(4)) == quarter)
        land_in_one_file(part, f"{root}/landing")
    store = Store(f"{root}/tables")
    query = ingest_landing(
        spark, f"{root}/landing", store, f"{root}/checkpoint", lexicon=lexicon(spark), files_per_batch=1
    )
    query.awaitTermination()
    for _ in range(2):
        record_progress(query, store)
    return plain(stream_lag(spark, store, f"{root}/landing").select(
        "batch_number", "input_rows", "raw_rows", "files", "backlog_files", "newest_collected",
        (F.col("batch_seconds") > 0).alias("timed"),
    ))


def quarantine_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases land cut off; their lines are set aside, mended, landed again and ingested."""
    root = scratch_dir(spark, "quarantine")
    landing, store = f"{root}/landing", Store(f"{root}/tables")
    events = table(spark, sf_dir, "events")
    # Ids are told apart before the join with the documents: no text crosses an exchange for it.
    ids = events.where("event_type = 'purchase'").select("event_id")
    land_messages(messages(spark, sf_dir, events.join(ids, "event_id", "left_anti")), landing)
    bought = messages(spark, sf_dir, events.join(ids, "event_id", "left_semi"))
    cut = bought.select(F.to_json(F.struct(*bought.columns), {"timestampFormat": LANDED_TIME}).alias("line"))
    cut.select(F.expr("left(line, length(line) - 1)").alias("value")).write.mode("append").option(
        "compression", LANDED_AS["compression"]
    ).text(landing)

    def ingest():
        ingest_landing(spark, landing, store, f"{root}/checkpoint", lexicon=lexicon(spark)).awaitTermination()

    ingest()
    release(spark, store, landing, lambda line: F.concat(line, F.lit("}")), "first")
    ingest()
    days = store.read(spark, "daily_sentiment")
    # Lines that are still set aside, as a count on every row.
    return plain(days.withColumn("still_broken", quarantined(spark, store).agg(F.count("*")).scalar()))


class _Stopped(Store):
    """A store whose second write of one table fails, as if the driver were lost between two steps."""

    def replace(self, df, table, named, metrics=None):
        if table == "sentiment_rollup" and self.read(df.sparkSession, table).limit(1).count():
            raise RuntimeError("stopped between two steps")
        return super().replace(df, table, named, metrics)


def run_all_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run on an interval, stopped between two writes of its second batch and gone on with."""
    root = scratch_dir(spark, "resumed")
    landing, checkpoint, out = f"{root}/landing", f"{root}/checkpoint", f"{root}/out"
    nested = messages(spark, sf_dir).select(
        "id", "text", "created_at", "author_id", "lang", F.struct(*COUNTERS).alias("public_metrics")
    )
    collect_messages(nested, landing, KEYWORDS)
    files = len(read_messages(spark, landing).inputFiles())
    query = ingest_landing(
        spark, landing, _Stopped(f"{root}/tables"), checkpoint, 1, lexicon(spark), files_per_batch=-(-files // 3)
    )
    try:
        query.processAllAvailable()
        raise AssertionError("the run was not stopped")
    except StreamingQueryException:
        pass
    store = Store(f"{root}/tables")
    run_all(nested.where("false"), landing, store, checkpoint, out, KEYWORDS, as_of=AS_OF, lexicon=lexicon(spark))
    columns = (
        f"{DATE} DATE, sentiment_label STRING, tweet_count BIGINT, avg_polarity DOUBLE, sentiment_category STRING"
    )
    return plain(spark.read.option("header", True).schema(columns).csv(f"{out}/sentiment_trends"))


def compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dates merged, then merged again: figures between writing the second folder and the switch, and after it."""
    store, _ = stored(spark, sf_dir)
    database = "sentiment_db_" + store.root.rstrip("/").split("-")[-1].split("/")[0]
    create_closed(spark, store, database)
    dates = {r[0] for r in store.read(spark, "daily_sentiment").select(DATE).distinct().collect()}
    compact_dates(spark, store, dates, database)
    folder = merge_dates(spark, store, dates)
    root = scratch_dir(spark, "compacted")
    for step in ("between", "after"):
        daily = aggregates.daily_sentiment(closed_messages(spark, database)).withColumn("step", F.lit(step))
        daily.write.mode("append").parquet(root)
        if step == "between":
            switch_dates(spark, folder, dates, database)
    return plain(spark.read.parquet(root))


def indexed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyword search by way of a token index."""
    path, rows = scratch_dir(spark, "index"), messages(spark, sf_dir)
    write_index(rows, path)
    return plain(search_index(spark.read.parquet(path), rows, KEYWORDS))


def scorer_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by the SQL function, over a view of the cleaned messages."""
    register_scorer(spark, lexicon(spark), "sentiment")
    rows = processed(spark, sf_dir).select("id", clean_text(F.col("text")).alias("cleaned_text"))
    rows.createOrReplaceTempView("cleaned_messages")
    scores = execute_query(spark, "SELECT id, s.* FROM (SELECT id, sentiment(cleaned_text) AS s FROM cleaned_messages)")
    return plain(scores)


def ordered(build: Callable[[SparkSession, str], DataFrame], **order: str) -> Callable[[SparkSession, str], DataFrame]:
    """A result with each row's position, so that its order can be compared; ``order`` names columns as "asc" or "desc"."""
    return lambda spark, sf_dir: with_position(
        build(spark, sf_dir), *[F.desc(c) if way == "desc" else F.asc(c) for c, way in order.items()]
    )


def analyze_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring where every third text is missing."""
    turns = table(spark, sf_dir, "conversations")
    return plain(batch_analyze(turns.withColumn("text", F.when(F.col("turn") % 3 != 1, F.col("text"))), lexicon(spark)))


def single_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest message, scored by itself."""
    newest = most_recent(processed(spark, sf_dir), 1).first()
    return plain(analyze_text(spark, newest["text"], lexicon(spark)).drop("cleaned_text"))


def _extract(name: str, columns: str, job) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store, _ = stored(spark, sf_dir)
        out = scratch_dir(spark, name)
        job(spark, store, out, AS_OF)
        return spark.read.option("header", True).schema(columns).csv(f"{out}/{name}")

    return run


_TRENDS = f"{DATE} DATE, sentiment_label STRING, tweet_count BIGINT, avg_polarity DOUBLE, sentiment_category STRING"
_HOURS = f"{DATE} DATE, tweet_hour INT, positive_count BIGINT, negative_count BIGINT, neutral_count BIGINT, total_count BIGINT"
_TOTALS = "total BIGINT, metric_type STRING, sentiment_label STRING, count BIGINT, avg_sentiment DOUBLE"


def saved_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The health report as its JSON line says."""
    store, landing = stored(spark, sf_dir)
    folder = scratch_dir(spark, "report")
    newest = newest_file_time(spark, landing).first()["newest"]
    save_health_report(health_report(spark, landing, store, newest + dt.timedelta(hours=1)), folder)
    kinds = "age_seconds DOUBLE, data_freshness BOOLEAN, raw_tweets_rows BIGINT, processed_tweets_rows BIGINT"
    return spark.read.schema(kinds).json(folder).withColumn("age_seconds", F.round("age_seconds", 3))


def _run_stream(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there into Parquet and read the result."""
    root = scratch_dir(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .option("compression", CODEC)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages landed, then their repeats; over several batches the first copy of each id stays."""
    landing = scratch_dir(spark, "repeats")
    land_messages(messages(spark, sf_dir), landing)
    first = len(read_messages(spark, landing).inputFiles())
    land_messages(_collected_again(spark, sf_dir), landing)
    unique = unique_by_id(stream_messages(spark, landing, files_per_batch=first), "60 days")
    return plain(_run_stream(spark, unique.drop("_corrupt_record"), "dedup"))


def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts of closed hours from a stream that is scored on the way, in several batches."""
    files = spark.sparkContext.defaultParallelism
    live = process_messages(stream_messages(spark, in_time_order(spark, sf_dir), files_per_batch=files))
    return _run_stream(spark, hourly_counts(score_sentiment(live, lexicon(spark)), "1 hour"), "hourly")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

    # Sources and projections
    q["process_messages"] = lambda s, d: plain(processed(s, d))
    q["flatten_metrics"] = lambda s, d: plain(
        flatten_records(
            messages(s, d).select(
                "id", "text", "created_at", "author_id", "lang",
                F.struct(*COUNTERS).alias("public_metrics"),
            )
        ).drop("collected_at")
    )
    q["keyword_filter"] = lambda s, d: plain(keyword_filter(messages(s, d), KEYWORDS))
    q["recent_n"] = lambda s, d: plain(most_recent(messages(s, d), NEWEST))
    q["latest_by_id"] = lambda s, d: plain(latest_by_id(_recollected(s, d), narrow_first=True))

    # Text and sentiment
    q["clean_text"] = lambda s, d: messages(s, d).select(
        "id", clean_text(F.col("text")).alias("cleaned_text")
    )
    q["sentiment_scores"] = lambda s, d: plain(_scores(scored(s, d)))
    q["sentiment_scores_joined"] = lambda s, d: plain(_scores(scored(s, d, joined=True)))
    q["sentiment_label"] = lambda s, d: (
        scored(s, d).select("id", sentiment_label(F.col("polarity"), 0.25).alias("strict_label"))
    )
    q["batch_analyze"] = lambda s, d: plain(
        batch_analyze(table(s, d, "conversations"), lexicon(s))
    )

    # Aggregates
    q["hourly_sentiment"] = lambda s, d: plain(aggregates.hourly_sentiment(scored(s, d)))
    q["daily_sentiment"] = lambda s, d: plain(aggregates.daily_sentiment(scored(s, d)))
    q["trending_topics"] = lambda s, d: plain(aggregates.trending_topics(scored(s, d)))
    q["sentiment_rollup"] = lambda s, d: plain(aggregates.sentiment_rollup(scored(s, d)))

    # Serving
    q["sentiment_trends"] = lambda s, d: plain(
        serving.sentiment_trends(aggregates.daily_sentiment(scored(s, d)), as_of=AS_OF)
    )
    q["hourly_trends"] = lambda s, d: serving.hourly_view(
        aggregates.hourly_sentiment(scored(s, d))
    ).orderBy(F.desc(DATE), F.desc("tweet_hour"))
    q["hourly_trends_for_date"] = lambda s, d: serving.hourly_trends(
        aggregates.hourly_sentiment(scored(s, d)), ONE_DATE
    )
    q["hourly_last_7_days"] = lambda s, d: serving.hourly_trends_recent(
        aggregates.hourly_sentiment(scored(s, d)), as_of=AS_OF
    )
    q["total_count"] = lambda s, d: serving.total_count(scored(s, d))
    q["label_distribution"] = lambda s, d: serving.label_distribution(scored(s, d), as_of=AS_OF)
    q["avg_sentiment"] = lambda s, d: plain(serving.avg_sentiment(scored(s, d), as_of=AS_OF))
    q["summary_stats"] = lambda s, d: _summary(
        serving.summary_stats(serving.dashboard_summary(scored(s, d), AS_OF))
    )
    q["dashboard_dataset"] = lambda s, d: plain(
        serving.dashboard_dataset(scored(s, d), as_of=AS_OF)
    )

    # Sinks
    q["json_landing_roundtrip"] = json_roundtrip
    q["json_landing_text_counters"] = text_counters
    q["parquet_roundtrip"] = parquet_roundtrip
    q["csv_extract_roundtrip"] = csv_roundtrip
    q["dynamic_overwrite"] = dynamic_overwrite

    # Jobs over the store
    q["collect_messages"] = collect_job
    q["stream_process_equals_batch"] = stream_ingest
    q["ingest_twice"] = ingest_again
    q["collect_all"] = collect_all
    q["ingest_recollected"] = ingest_recollected(4)
    q["ingest_recollected_at_once"] = ingest_recollected(1)
    q["ingest_rotated_folder"] = ingest_rotated_folder
    q["rebuild_after_correction"] = rebuild_after_correction
    q["export_trends"] = trends_extract
    q["catalog_hourly_trends"] = catalog_hours
    q["stored_hourly_sentiment"] = stored_aggregate("hourly_sentiment")
    q["stored_trending_topics"] = stored_aggregate("trending_topics")
    q["catalog_sentiment_trends"] = catalog_trends
    q["dashboard_job"] = dashboard_job
    q["summary_job"] = summary_job
    q["freshness"] = lambda s, d: plain(message_freshness(messages(s, d), CHECKED_AT))
    q["health_report"] = health

    # Streams
    q["stream_dedup"] = stream_dedup
    q["stream_hourly"] = stream_hourly
    q["stream_hourly_reconciled"] = stream_reconciled
    q["stream_scores_large_list"] = stream_large_list
    q["stream_lag"] = lag
    q["quarantine_roundtrip"] = quarantine_roundtrip
    q["run_all_resumed"] = run_all_resumed

    # Search, order, SQL function
    q["compacted_date"] = compacted
    q["keyword_search_indexed"] = indexed_search
    q["scorer_hook"] = scorer_hook
    q["ordered_trends"] = ordered(q["sentiment_trends"], tweet_date="desc", sentiment_label="asc")
    q["ordered_hours"] = ordered(q["hourly_trends_for_date"], tweet_hour="asc")
    q["ordered_hourly_view"] = ordered(q["hourly_trends"], tweet_date="desc", tweet_hour="desc")
    q["ordered_dataset"] = ordered(
        q["dashboard_dataset"], tweet_date="desc", tweet_hour="desc", sentiment_label="asc"
    )

    # Missing texts, single messages, the other files of the jobs
    q["analyze_missing_texts"] = analyze_with_gaps
    q["single_message"] = single_message
    q["export_hours"] = _extract("hourly_trends", _HOURS, export_extracts)
    q["export_summary"] = lambda s, d: _summary(_extract("summary_stats", _TOTALS, export_extracts)(s, d))
    q["dashboard_trends"] = lambda s, d: plain(_extract("sentiment_trends", _TRENDS, refresh_dashboard)(s, d))
    q["json_report"] = saved_report
    return q
