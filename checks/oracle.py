"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from checks.messages import MESSAGES_SQL, WORDS
from checks.queries import AS_OF, KEYWORDS, NEWEST, ONE_DATE

# DuckDB's \s and \w know ASCII only, so the classes are spelled out.
BLANK = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}"
WORD_CHAR = r"\p{L}\p{N}_"

MESSAGES = "messages AS (" + MESSAGES_SQL.format(
    text_type="VARCHAR", documents="documents", counted="documents", events="events"
) + ")"

RAW_COLUMNS = (
    "id, text, created_at, author_id, lang, retweet_count, like_count, reply_count, quote_count"
)

PROCESSED = f"""processed AS (
    SELECT {RAW_COLUMNS}, collected_at,
           CAST(created_at AS DATE) AS tweet_date, CAST(hour(created_at) AS INT) AS tweet_hour
    FROM messages WHERE lang = 'en' AND NOT starts_with(text, 'RT @'))"""


def cleaned(text: str) -> str:
    no_links = f"regexp_replace({text}, '(?:http|www)[^{BLANK}]+', '', 'g')"
    no_tags = f"regexp_replace({no_links}, '[@#][{WORD_CHAR}]+', '', 'g')"
    return f"trim(regexp_replace({no_tags}, '[{BLANK}]+', ' ', 'g'))"


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else f"CAST({value} AS DOUBLE)"


LEXICON = (
    "lexicon(word, kind, polarity, subjectivity, intensity) AS (VALUES "
    + ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in WORDS)
    + ")"
)


def scores(source: str, key: str, lexicon: str = LEXICON) -> str:
    """CTEs ending in ``scores(key, polarity, subjectivity)`` for texts of ``source``.

    Term scores are added up in text order, so sums come out the same to the last bit.
    """
    return f"""{lexicon},
token_lists AS (
    SELECT {key}, regexp_extract_all(lower({cleaned('text')}), '\\p{{L}}+(?:''\\p{{L}}+)*|!') AS t
    FROM {source}),
token_rows AS (
    SELECT {key}, unnest(t) AS word, generate_subscripts(t, 1) AS i FROM token_lists),
neighbours AS (
    SELECT {key}, word, i,
           lag(word) OVER w AS prev, lag(word, 2) OVER w AS prev2, lead(word) OVER w AS next
    FROM token_rows WINDOW w AS (PARTITION BY {key} ORDER BY i)),
term_scores AS (
    SELECT n.*,
           greatest(-1.0::DOUBLE, least(1.0::DOUBLE,
               t.polarity * coalesce(m.intensity, 1.0::DOUBLE)
               * CASE WHEN n.next = '!' THEN 1.25::DOUBLE ELSE 1.0::DOUBLE END))
           * CASE WHEN p1.word IS NOT NULL OR (m.word IS NOT NULL AND p2.word IS NOT NULL)
                  THEN -0.5::DOUBLE ELSE 1.0::DOUBLE END AS pol,
           greatest(0.0::DOUBLE, least(1.0::DOUBLE,
               t.subjectivity * coalesce(m.intensity, 1.0::DOUBLE))) AS sub
    FROM neighbours n
    JOIN lexicon t ON t.word = n.word AND t.kind = 'term'
    LEFT JOIN lexicon m ON m.word = n.prev AND m.kind = 'modifier'
    LEFT JOIN lexicon p1 ON p1.word = n.prev AND p1.kind = 'negator'
    LEFT JOIN lexicon p2 ON p2.word = n.prev2 AND p2.kind = 'negator'),
scores AS (
    SELECT {key},
           list_reduce(list(pol ORDER BY i), lambda a, b: a + b) / count(*) AS polarity,
           list_reduce(list(sub ORDER BY i), lambda a, b: a + b) / count(*) AS subjectivity
    FROM term_scores GROUP BY {key})"""


def labelled(source: str, key: str, name: str) -> str:
    return f"""{name} AS (
    SELECT *, CASE WHEN polarity > 0.1::DOUBLE THEN 'positive'
                   WHEN polarity < -0.1::DOUBLE THEN 'negative' ELSE 'neutral' END AS sentiment_label,
           abs(polarity) AS confidence
    FROM (SELECT s.*, coalesce(c.polarity, 0.0::DOUBLE) AS polarity,
                 coalesce(c.subjectivity, 0.0::DOUBLE) AS subjectivity
          FROM {source} s LEFT JOIN scores c USING ({key})))"""


SCORED = f"{scores('processed', 'id')},\n{labelled('processed', 'id', 'scored')}"

HOURLY = """hourly AS (
    SELECT tweet_date, tweet_hour, sentiment_label, count(*) AS tweet_count,
           avg(polarity) AS avg_polarity, avg(confidence) AS avg_confidence
    FROM scored GROUP BY ALL)"""
DAILY = """daily AS (
    SELECT tweet_date, sentiment_label, count(*) AS tweet_count, avg(polarity) AS avg_polarity,
           CAST(sum(like_count) AS BIGINT) AS total_likes,
           CAST(sum(retweet_count) AS BIGINT) AS total_retweets
    FROM scored GROUP BY ALL)"""

AS_OF_SQL = f"DATE '{AS_OF}'"


def days(n: int) -> str:
    return f"tweet_date BETWEEN {AS_OF_SQL} - {n} AND {AS_OF_SQL}"


# The bands of the sentiment category.
CATEGORY = """CASE WHEN avg_polarity > 0.3::DOUBLE THEN 'Very Positive' WHEN avg_polarity > 0.1::DOUBLE THEN 'Positive'
         WHEN avg_polarity > -0.1::DOUBLE THEN 'Neutral' WHEN avg_polarity > -0.3::DOUBLE THEN 'Negative'
         ELSE 'Very Negative' END"""
HOURLY_SELECT = """SELECT tweet_date, tweet_hour, sentiment_label, tweet_count,
    round(avg_polarity + 1e-12, 9) AS avg_polarity, round(avg_confidence + 1e-12, 9) AS avg_confidence FROM hourly"""
DAILY_SELECT = """SELECT tweet_date, sentiment_label, tweet_count,
    round(avg_polarity + 1e-12, 9) AS avg_polarity, total_likes, total_retweets FROM daily"""
HOURLY_PIVOT = """SELECT tweet_date, tweet_hour,
    CAST(sum(CASE WHEN sentiment_label = 'positive' THEN tweet_count ELSE 0 END) AS BIGINT) AS positive_count,
    CAST(sum(CASE WHEN sentiment_label = 'negative' THEN tweet_count ELSE 0 END) AS BIGINT) AS negative_count,
    CAST(sum(CASE WHEN sentiment_label = 'neutral' THEN tweet_count ELSE 0 END) AS BIGINT) AS neutral_count,
    CAST(sum(tweet_count) AS BIGINT) AS total_count
FROM hourly {where} GROUP BY tweet_date, tweet_hour ORDER BY {order}"""
DATE_HOUR = "tweet_date DESC, tweet_hour"
TRENDS = f"""SELECT tweet_date, sentiment_label, tweet_count,
    round(avg_polarity + 1e-12, 9) AS avg_polarity,
    {CATEGORY} AS sentiment_category
FROM daily WHERE {{days}} ORDER BY tweet_date DESC, sentiment_label"""
TRENDING = """SELECT tweet_date, CAST(sum(like_count) AS BIGINT) AS total_engagement,
    count(*) AS tweet_count, round(avg(polarity) + 1e-12, 9) AS avg_sentiment
FROM scored WHERE like_count > 10 GROUP BY tweet_date"""
DATASET = f"""SELECT * REPLACE (round(avg_polarity + 1e-12, 9) AS avg_polarity,
                    round(avg_confidence + 1e-12, 9) AS avg_confidence),
    total_likes + total_retweets AS engagement_score,
    round(abs(avg_polarity) + 1e-12, 9) AS sentiment_strength,
    CAST(tweet_date AS TIMESTAMP) + to_hours(tweet_hour) AS datetime
FROM (SELECT tweet_date, tweet_hour, sentiment_label, count(*) AS tweet_count,
             avg(polarity) AS avg_polarity, avg(confidence) AS avg_confidence,
             CAST(sum(like_count) AS BIGINT) AS total_likes,
             CAST(sum(retweet_count) AS BIGINT) AS total_retweets
      FROM scored WHERE {days(30)} GROUP BY tweet_date, tweet_hour, sentiment_label)
ORDER BY tweet_date DESC, tweet_hour DESC, sentiment_label"""
SUMMARY = f"""SELECT count(*)::DOUBLE AS total, 'total_tweets' AS metric_type,
    NULL::VARCHAR AS sentiment_label, NULL::DOUBLE AS count, NULL::DOUBLE AS avg_sentiment FROM scored
UNION ALL SELECT NULL, 'sentiment_distribution', sentiment_label, count(*)::DOUBLE, NULL
    FROM scored WHERE {days(1)} GROUP BY sentiment_label
UNION ALL SELECT NULL, 'avg_sentiment', NULL, NULL, round(avg(polarity) + 1e-12, 9)
    FROM scored WHERE {days(1)}"""


def has_keyword(text: str) -> str:
    def token(word: str) -> str:
        return f"regexp_matches({text}, '(?i)(?:^|[^{WORD_CHAR}]){word}(?:[^{WORD_CHAR}]|$)')"

    return " OR ".join("(" + " AND ".join(map(token, k.split())) + ")" for k in KEYWORDS)


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def oracle_sql() -> dict[str, str]:
    base = (MESSAGES, PROCESSED)
    full = (*base, SCORED)
    hourly, daily = (*full, HOURLY), (*full, DAILY)
    recollected = """recollected AS (
        SELECT * FROM messages
        UNION ALL SELECT m.* REPLACE (like_count + 5 AS like_count, collected_at + INTERVAL 2 HOUR AS collected_at)
        FROM messages m JOIN events e ON m.id = CAST(e.event_id AS VARCHAR) AND e.event_type = 'view')"""
    newest = f"ORDER BY created_at DESC, id LIMIT {NEWEST}"
    sql = {
        "process_messages": _with(*base, select="SELECT * FROM processed"),
        "flatten_metrics": _with(MESSAGES, select=f"SELECT {RAW_COLUMNS} FROM messages"),
        "keyword_filter": _with(
            MESSAGES, select=f"SELECT * FROM messages WHERE {has_keyword('text')}"
        ),
        "recent_n": _with(MESSAGES, select=f"SELECT * FROM messages {newest}"),
        "latest_by_id": _with(
            MESSAGES, recollected,
            select="SELECT * FROM recollected "
            "QUALIFY row_number() OVER (PARTITION BY id ORDER BY collected_at DESC) = 1",
        ),
        "clean_text": _with(
            MESSAGES, select=f"SELECT id, {cleaned('text')} AS cleaned_text FROM messages"
        ),
        "sentiment_scores": _with(
            *full,
            select="SELECT id, round(polarity + 1e-12, 9) AS polarity, round(subjectivity + 1e-12, 9) AS subjectivity, "
            "sentiment_label, round(confidence + 1e-12, 9) AS confidence FROM scored",
        ),
        "sentiment_scores_joined": _with(
            *full,
            select="SELECT id, round(polarity + 1e-12, 9) AS polarity, round(subjectivity + 1e-12, 9) AS subjectivity, "
            "sentiment_label, round(confidence + 1e-12, 9) AS confidence FROM scored",
        ),
        "sentiment_label": _with(
            *full,
            select="SELECT id, CASE WHEN polarity > 0.25::DOUBLE THEN 'positive' "
            "WHEN polarity < -0.25::DOUBLE THEN 'negative' ELSE 'neutral' END AS strict_label FROM scored",
        ),
        "batch_analyze": _with(
            "turns AS (SELECT *, row_number() OVER () AS n FROM conversations)",
            scores("turns", "n"),
            labelled("turns", "n", "analyzed"),
            select=f"SELECT conv_id, turn, role, text, {cleaned('text')} AS cleaned_text, "
            "round(polarity + 1e-12, 9) AS polarity, round(subjectivity + 1e-12, 9) AS subjectivity, "
            "sentiment_label, round(confidence + 1e-12, 9) AS confidence FROM analyzed",
        ),
        "hourly_sentiment": _with(*hourly, select=HOURLY_SELECT),
        "daily_sentiment": _with(*daily, select=DAILY_SELECT),
        "trending_topics": _with(*full, select=TRENDING),
        "sentiment_rollup": _with(
            *full,
            select="""SELECT tweet_date, tweet_hour, sentiment_label, count(*) AS messages,
                round(sum(polarity) + 1e-12, 9) AS polarity_sum, count(polarity) AS polarity_rows,
                round(sum(confidence) + 1e-12, 9) AS confidence_sum, count(confidence) AS confidence_rows,
                CAST(sum(like_count) AS BIGINT) AS likes, CAST(sum(retweet_count) AS BIGINT) AS retweets,
                count(*) FILTER (WHERE like_count > 10) AS hot_messages,
                CAST(coalesce(sum(like_count) FILTER (WHERE like_count > 10), 0) AS BIGINT) AS hot_likes,
                round(coalesce(sum(polarity) FILTER (WHERE like_count > 10), 0) + 1e-12, 9) AS hot_polarity_sum,
                count(polarity) FILTER (WHERE like_count > 10) AS hot_polarity_rows
                FROM scored GROUP BY tweet_date, tweet_hour, sentiment_label""",
        ),
        "sentiment_trends": _with(*daily, select=TRENDS.format(days=days(7))),
        "hourly_trends": _with(*hourly, select=HOURLY_PIVOT.format(where="", order=DATE_HOUR + " DESC")),
        "hourly_trends_for_date": _with(
            *hourly, select=HOURLY_PIVOT.format(where=f"WHERE tweet_date = DATE '{ONE_DATE}'", order="tweet_hour")
        ),
        "hourly_last_7_days": _with(*hourly, select=HOURLY_PIVOT.format(where=f"WHERE {days(6)}", order=DATE_HOUR)),
        "total_count": _with(*full, select="SELECT count(*) AS total FROM scored"),
        "label_distribution": _with(
            *full,
            select=f"SELECT sentiment_label, count(*) AS count FROM scored WHERE {days(1)} "
            "GROUP BY sentiment_label",
        ),
        "avg_sentiment": _with(
            *full,
            select=f"SELECT round(avg(polarity) + 1e-12, 9) AS avg_sentiment FROM scored WHERE {days(1)}",
        ),
        "summary_stats": _with(*full, select=SUMMARY),
        "dashboard_dataset": _with(*full, select=DATASET),
        "json_landing_roundtrip": _with(MESSAGES, select="SELECT * FROM messages"),
        "json_landing_text_counters": _with(
            *base,
            select="SELECT id, retweet_count, like_count, CAST(NULL AS INT) AS reply_count, "
            "CAST(NULL AS INT) AS quote_count FROM processed",
        ),
        "parquet_roundtrip": _with(*base, select="SELECT * FROM processed"),
        "csv_extract_roundtrip": _with(*full, select=DATASET),
        "dynamic_overwrite": _with(
            *daily,
            select=f"""SELECT tweet_date, sentiment_label,
                tweet_count * CASE WHEN tweet_date = DATE '{ONE_DATE}' THEN 2 ELSE 1 END AS tweet_count,
                round(avg_polarity + 1e-12, 9) AS avg_polarity, total_likes, total_retweets FROM daily""",
        ),
        "collect_messages": _with(
            MESSAGES,
            select=f"SELECT {RAW_COLUMNS} FROM messages WHERE {has_keyword('text')} {newest}",
        ),
        "stream_process_equals_batch": _with(
            *full,
            select="SELECT * REPLACE (round(polarity + 1e-12, 9) AS polarity, "
            "round(subjectivity + 1e-12, 9) AS subjectivity, round(confidence + 1e-12, 9) AS confidence) FROM scored",
        ),
        "ingest_twice": _with(*daily, select=DAILY_SELECT),
        "ingest_rotated_folder": _with(*daily, select=DAILY_SELECT),
        "collect_all": _with(
            MESSAGES, select=f"SELECT {RAW_COLUMNS} FROM messages WHERE {has_keyword('text')}"
        ),
        "rebuild_after_correction": _with(
            *full,
            "corrected AS (SELECT * REPLACE (least(like_count, 10) AS like_count) FROM scored "
            f"WHERE sentiment_label <> 'negative' AND tweet_date <> DATE '{ONE_DATE}')",
            DAILY.replace("FROM scored", "FROM corrected"),
            select=DAILY_SELECT,
        ),
        "stored_hourly_sentiment": _with(*hourly, select=HOURLY_SELECT),
        "stored_trending_topics": _with(*full, select=TRENDING),
        "catalog_sentiment_trends": _with(*daily, select=TRENDS.format(days=days(7))),
        "export_trends": _with(*daily, select=TRENDS.format(days=days(30))),
        "catalog_hourly_trends": _with(*hourly, select=HOURLY_PIVOT.format(where="", order=DATE_HOUR)),
        "dashboard_job": _with(*full, select=DATASET),
        "summary_job": _with(*full, select=SUMMARY),
        "freshness": _with(
            MESSAGES,
            select="""SELECT newest, round(epoch(TIMESTAMP '2024-01-31 01:00:00' - newest) + 1e-12, 9) AS age_seconds,
                epoch(TIMESTAMP '2024-01-31 01:00:00' - newest) <= 3600 AS is_fresh
                FROM (SELECT max(collected_at) AS newest FROM messages)""",
        ),
        "health_report": _with(
            *base,
            select="SELECT age AS \"timestamp\", TRUE AS newest_file, age AS age_seconds, age <= 3600 AS data_freshness, "
            "(SELECT count(*) FROM messages) AS raw_tweets_rows, (SELECT count(*) FROM processed) AS processed_tweets_rows "
            "FROM (VALUES (3600.0::DOUBLE), (7201.0::DOUBLE)) AS ages(age)",
        ),
        "stream_dedup": _with(
            MESSAGES,
            select="SELECT * FROM messages",
        ),
        "stream_hourly": _with(
            *hourly,
            select="""SELECT tweet_date, tweet_hour, sentiment_label, tweet_count FROM hourly
                WHERE CAST(tweet_date AS TIMESTAMP) + to_hours(tweet_hour + 1)
                      <= (SELECT max(created_at) FROM processed) - INTERVAL 1 HOUR""",
        ),
    }
    again = (MESSAGES, recollected, """newest AS (SELECT * FROM recollected
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY collected_at DESC) = 1)""",
        PROCESSED.replace("FROM messages", "FROM newest"), SCORED, DAILY)
    large = LEXICON.replace("lexicon(", "own(", 1) + """,
words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS word FROM documents),
lexicon AS (
    SELECT * FROM own UNION ALL
    SELECT word, 'term', CAST((ascii(word) * 7 + length(word)) % 21 - 10 AS DOUBLE) / 10.0::DOUBLE,
           CAST(length(word) % 5 AS DOUBLE) / 4.0::DOUBLE, NULL
    FROM words WHERE word NOT IN (SELECT word FROM own))"""
    sql["stream_scores_large_list"] = _with(
        *base, scores("processed", "id", large), labelled("processed", "id", "scored"),
        select="SELECT id, round(polarity + 1e-12, 9) AS polarity, round(subjectivity + 1e-12, 9) AS subjectivity, "
        "sentiment_label, round(confidence + 1e-12, 9) AS confidence FROM scored",
    )
    sql["stream_hourly_reconciled"] = sql["stream_hourly"]
    sql["stream_lag"] = _with(
        MESSAGES,
        select="""SELECT CAST(id AS BIGINT) % 4 AS batch_number, count(*) AS input_rows, count(*) AS raw_rows,
            CAST(1 AS BIGINT) AS files, 3 - CAST(id AS BIGINT) % 4 AS backlog_files, max(collected_at) AS newest_collected,
            TRUE AS timed FROM messages GROUP BY CAST(id AS BIGINT) % 4""",
    )
    sql["quarantine_roundtrip"] = _with(
        *daily, select=DAILY_SELECT.replace(" FROM daily", ", CAST(0 AS BIGINT) AS still_broken FROM daily")
    )
    collected = (
        f"collected AS (SELECT * FROM messages WHERE {has_keyword('text')})",
        PROCESSED.replace("FROM messages", "FROM collected"), SCORED, DAILY,
    )
    sql["run_all_resumed"] = _with(MESSAGES, *collected, select=TRENDS.format(days=days(7)))
    sql["compacted_date"] = _with(
        *daily, select=DAILY_SELECT.replace(" FROM daily", ", step FROM daily, (VALUES ('between'), ('after')) AS steps(step)"),
    )
    sql["keyword_search_indexed"] = sql["keyword_filter"]
    sql["scorer_hook"] = _with(
        *full,
        select="SELECT id, round(polarity + 1e-12, 9) AS polarity, round(subjectivity + 1e-12, 9) AS subjectivity FROM scored",
    )
    for name, query, order in (
        ("ordered_trends", "sentiment_trends", "tweet_date DESC, sentiment_label"),
        ("ordered_hours", "hourly_trends_for_date", "tweet_hour"),
        ("ordered_hourly_view", "hourly_trends", "tweet_date DESC, tweet_hour DESC"),
        ("ordered_dataset", "dashboard_dataset", "tweet_date DESC, tweet_hour DESC, sentiment_label"),
    ):
        sql[name] = f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({sql[query]})"
    sql["analyze_missing_texts"] = sql["batch_analyze"].replace(
        "SELECT *, row_number() OVER () AS n FROM conversations",
        "SELECT * REPLACE (CASE WHEN turn % 3 <> 1 THEN text END AS text), row_number() OVER () AS n FROM conversations",
    )
    sql["single_message"] = _with(
        *full,
        select="SELECT round(polarity + 1e-12, 9) AS polarity, round(subjectivity + 1e-12, 9) AS subjectivity, "
        "sentiment_label, round(confidence + 1e-12, 9) AS confidence FROM scored ORDER BY created_at DESC, id LIMIT 1",
    )
    sql["export_hours"] = sql["hourly_last_7_days"]
    sql["export_summary"] = sql["summary_stats"]
    sql["dashboard_trends"] = sql["sentiment_trends"]
    sql["json_report"] = _with(
        *base,
        select="SELECT 3600.0::DOUBLE AS age_seconds, TRUE AS data_freshness, (SELECT count(*) FROM messages) AS raw_tweets_rows, "
        "(SELECT count(*) FROM processed) AS processed_tweets_rows",
    )
    sql["ingest_recollected"] = sql["ingest_recollected_at_once"] = _with(*again, select=DAILY_SELECT)
    return sql
