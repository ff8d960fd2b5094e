"""Sentiment of messages from a word list.

For each lexicon term in a message, with ``prev``, ``prev2`` and ``next`` the
tokens around it:

* ``factor``  is the intensity of ``prev`` if that is a modifier, else 1;
* ``negated`` if ``prev`` is a negator, or ``prev`` a modifier and ``prev2`` a negator;
* ``boosted`` by 1.25 if ``next`` is an exclamation mark;
* polarity = clamp(p * factor * boost, -1, 1), times -0.5 when negated;
* subjectivity = clamp(s * factor, 0, 1).

A message has the mean of both over its terms, added up in text order, and 0.0
when it has none.

There are two physical plans for this one rule, with the same results to the last
bit; the caller chooses. By default the word list travels inside the plan as
literals, and scoring is a projection: no shuffle, no Python worker, and it works
unchanged on a stream. A list of more than ``INLINE_ROWS`` rows is refused there. With
``joined=True`` the list, of any size, is joined; a stream cannot take that plan.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from murmura.functions.measures import LABEL_THRESHOLD, confidence, sentiment_label
from murmura.functions.text import APOSTROPHE, TOKEN, clean_text, strip_markup, tokens
from murmura.operators.lexicon import default_lexicon, normalise

# Fixed values of the scoring rule.
BOOST = 1.25
NEGATION = -0.5

# Word lists up to this many rows may be put into the plan; about 1 MB of literals.
INLINE_ROWS = 20_000
# Lists of fewer words than this are not looked up in a hash set (Spark's own limit).
SET_SIZE = 11
# On the join path: chunks of texts for each shuffle partition, copies of a text before they are split, and the most ways.
CHUNKS = 8
HOT_COPIES = 100_000
COPY_SALT = 1024


@dataclass(frozen=True)
class WordList:
    """A lexicon made ready: its table, and its rows unless it is to be joined."""

    table: DataFrame
    rows: list[Row] | None


def prepare_lexicon(
    spark: SparkSession, lexicon: DataFrame | None = None, joined: bool = False
) -> WordList:
    """Normalise a lexicon and check its size; do it once and score many batches."""
    words = normalise(default_lexicon(spark) if lexicon is None else lexicon)
    if joined:
        return WordList(words, None)
    rows = words.limit(INLINE_ROWS + 1).collect()
    if len(rows) > INLINE_ROWS:
        raise ValueError(f"the word list has more than {INLINE_ROWS} rows: score it with joined=True")
    return WordList(words, rows)


def score_sentiment(
    messages: DataFrame,
    lexicon: DataFrame | WordList | None = None,
    text: str = "text",
    threshold: float = LABEL_THRESHOLD,
    keep_cleaned: bool = False,
    scorer: Callable[[Column], Column] | None = None,
    joined: bool = False,
) -> DataFrame:
    """``messages`` plus polarity, subjectivity, sentiment_label and confidence.

    Every input row comes back once. ``scorer`` replaces the word list by a
    user's own function from cleaned text to ``struct<polarity, subjectivity>``,
    for example a ``pandas_udf``; rows it returns NULL for score 0.0.
    """
    if scorer is not None:
        scored = messages.withColumn("_s", scorer(clean_text(F.col(text)))).select(
            *messages.columns,
            F.coalesce("_s.polarity", F.lit(0.0)).alias("polarity"),
            F.coalesce("_s.subjectivity", F.lit(0.0)).alias("subjectivity"),
        )
    else:
        words = (
            lexicon
            if isinstance(lexicon, WordList)
            else prepare_lexicon(messages.sparkSession, lexicon, joined)
        )
        if words.rows is not None:
            scored = _score_inline(messages, words.rows, text)
        elif messages.isStreaming:
            raise ValueError("a stream needs a word list that is not joined")
        else:
            scored = _score_joined(messages, words.table, text)
    columns = list(messages.columns)
    if keep_cleaned:
        cleaned = F.coalesce(clean_text(F.col(text)), F.col(text))
        scored = scored.withColumn("cleaned_text", cleaned)
        columns.append("cleaned_text")
    return scored.select(
        *columns,
        "polarity",
        "subjectivity",
        sentiment_label(F.col("polarity"), threshold).alias("sentiment_label"),
        confidence(F.col("polarity")).alias("confidence"),
    )


def batch_analyze(
    messages: DataFrame, lexicon: DataFrame | WordList | None = None, **options
) -> DataFrame:
    """``score_sentiment`` with the cleaned text kept as a fifth new column."""
    return score_sentiment(messages, lexicon, keep_cleaned=True, **options)


def analyze_text(
    spark: SparkSession, text: str | None, lexicon: DataFrame | WordList | None = None
) -> DataFrame:
    """One message as a one-row frame, scored by the same operator."""
    one = spark.createDataFrame([(text,)], "text STRING")
    return batch_analyze(one, lexicon).drop("text")


def register_scorer(
    spark: SparkSession, lexicon: DataFrame | WordList | None = None, name: str = "sentiment"
) -> Callable[[Column], Column]:
    """The scoring rule as a SQL function of cleaned text, ``struct<polarity, subjectivity>``; also returned.

    For SQL users and as a pattern for a ``scorer=`` of one's own: texts cross to Python in Arrow batches. The
    column plans of ``score_sentiment`` need no Python and give the same numbers.
    """
    words = lexicon if isinstance(lexicon, WordList) else prepare_lexicon(spark, lexicon)
    if words.rows is None:
        raise ValueError("a word list that is joined has no SQL function")
    terms = {r.word: (r.polarity or 0.0, r.subjectivity or 0.0) for r in words.rows if r.kind == "term"}
    factors = {r.word: 1.0 if r.intensity is None else r.intensity for r in words.rows if r.kind == "modifier"}
    negators = {r.word for r in words.rows if r.kind == "negator"}
    pattern, apostrophe, boost, negation = TOKEN, APOSTROPHE, BOOST, NEGATION

    def score(texts):
        import pandas as pd
        import regex

        find = regex.compile(pattern).findall

        def one(text):
            found = find(text.lower().replace(apostrophe, "'")) if text else []
            total, weight, n = 0.0, 0.0, 0
            for i, word in enumerate(found):
                if word in terms:
                    before, before2 = (found[i - k] if i >= k else "" for k in (1, 2))
                    factor = factors.get(before, 1.0)
                    lift = boost if found[i + 1 : i + 2] == ["!"] else 1.0
                    negated = before in negators or (before in factors and before2 in negators)
                    p, s = terms[word]
                    total += max(-1.0, min(1.0, p * factor * lift)) * (negation if negated else 1.0)
                    weight += max(0.0, min(1.0, s * factor))
                    n += 1
            return (total / n, weight / n) if n else (0.0, 0.0)

        return pd.DataFrame([one(t) for t in texts], columns=["polarity", "subjectivity"], dtype="float64")

    scorer = F.pandas_udf(score, "polarity double, subjectivity double", F.PandasUDFType.SCALAR)
    spark.udf.register(name, scorer)
    return scorer


def _term_score(
    polarity: Column, subjectivity: Column, factor: Column, negated: Column, boosted: Column
) -> Column:
    """The rule for one term; NULL flags count as false."""
    boost = F.when(boosted, BOOST).otherwise(1.0)
    sign = F.when(negated, NEGATION).otherwise(1.0)
    strength = F.coalesce(factor, F.lit(1.0))
    return F.struct(
        (_clamp(polarity * strength * boost, -1.0) * sign).alias("polarity"),
        _clamp(subjectivity * strength, 0.0).alias("subjectivity"),
    )


def _clamp(value: Column, low: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(1.0), value))


def _score_inline(messages: DataFrame, rows: list[Row], text: str) -> DataFrame:
    """Scoring as a projection, with the word list in the plan."""
    terms = {
        r.word: {"p": r.polarity or 0.0, "s": r.subjectivity or 0.0}
        for r in rows if r.kind == "term"
    }
    modifiers = {
        r.word: 1.0 if r.intensity is None else r.intensity for r in rows if r.kind == "modifier"
    }
    negators = [r.word for r in rows if r.kind == "negator"]
    term = _lookup(terms, "struct<p:double,s:double>")
    intensity = _lookup(modifiers, "double")

    def score_at(i: Column) -> Column:
        prev, prev2 = F.get("_tokens", i - 1), F.get("_tokens", i - 2)
        entry = term(F.get("_tokens", i))
        negated = _among(prev, negators) | (_among(prev, modifiers) & _among(prev2, negators))
        factor = F.when(_among(prev, modifiers), intensity(prev))
        return _term_score(
            entry["p"], entry["s"], factor, negated, F.get("_tokens", i + 1) == "!"
        )

    # Few tokens are terms: find their positions by hash set first, look up only those.
    hits = F.filter(
        F.transform("_tokens", lambda w, i: F.when(_among(w, terms), i)), lambda i: i.isNotNull()
    )
    zero = F.struct(F.lit(0.0).alias("polarity"), F.lit(0.0).alias("subjectivity"))
    total = F.aggregate(
        F.transform("_hits", score_at),
        zero,
        lambda acc, one: F.struct(
            (acc["polarity"] + one["polarity"]).alias("polarity"),
            (acc["subjectivity"] + one["subjectivity"]).alias("subjectivity"),
        ),
    )
    return (
        messages.select("*", tokens(strip_markup(F.col(text))).alias("_tokens"))
        .select("*", hits.alias("_hits"))
        .select(*messages.columns, F.size("_hits").alias("_n"), total.alias("_total"))
        .select(
            *messages.columns,
            *[
                F.when(F.col("_n") > 0, F.col(f"_total.{c}") / F.col("_n")).otherwise(0.0).alias(c)
                for c in ("polarity", "subjectivity")
            ],
        )
    )


def _among(word: Column, words) -> Column:
    """True where ``word`` is one of ``words``.

    Spark looks a word up in a hash set if the list has more than ten entries and compares it with one after
    the other if not; inside a lambda that is several times as slow. Texts that no token can be fill short lists up.
    """
    if not words:
        return F.lit(False)
    return word.isin([*words, *(f" {i}" for i in range(SET_SIZE - len(words)))])


def _lookup(entries: dict, kind: str) -> Callable[[Column], Column]:
    """Word to value through a literal array of small maps.

    A literal map is searched from end to end, so one big map would make each
    lookup cost as much as the word list is long. A checksum picks a small one.
    """
    slots = 1 << max(0, (len(entries) // 4).bit_length())
    maps: list[dict] = [{} for _ in range(slots)]
    for word, value in entries.items():
        maps[zlib.crc32(word.encode()) % slots][word] = value
    table = F.from_json(F.lit(json.dumps(maps)), f"array<map<string,{kind}>>")
    return lambda word: F.try_element_at(F.get(table, (F.crc32(word) % slots).cast("int")), word)


def _score_joined(messages: DataFrame, words: DataFrame, text: str) -> DataFrame:
    """Scoring by joins, for a word list too large to travel with the plan.

    Each distinct text is scored once, under a digest, and the words go to the texts instead of the tokens to the
    words: texts are dealt out in chunks, every word a chunk holds meets the list once, and a chunk is scored with the
    entries found for it. So the exchanges carry each distinct text, the words of each chunk and the scores; a row crosses
    one to meet its text's score, with no more of its columns than are asked for. The rows of a text with very many copies
    are split by a salt out of their own values, which a retried task computes again.
    """
    others = [c for c in messages.columns if c != text]
    chunks = CHUNKS * int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Rows without a text have a key of their own values that no text has.
    alone = F.xxhash64(*others).cast("string").cast("binary") if others else F.lit(None).cast("binary")
    keyed = messages.select("*", strip_markup(F.col(text)).alias("_body")).withColumn(
        "_text", F.when(F.col(text).isNotNull(), F.unhex(F.sha2("_body", 256))).otherwise(alone)
    )
    # The count is asked for wherever the texts are, and no condition on their tokens moves below their exchange: it is run once.
    bodies = (
        keyed.where(F.col(text).isNotNull()).groupBy("_text", "_body").agg(F.count("*").alias("_copies"))
        .where("_copies > 0").withColumn("_chunk", F.pmod(F.xxhash64("_text"), F.lit(chunks)))
    )
    held = bodies.select("_chunk", F.explode_outer(F.array_distinct(tokens(F.col("_body")))).alias("word")).distinct()
    entries = held.join(words, "word").select(
        F.col("_chunk").alias("_of"), F.col("word").cast("binary").alias("word"), "kind",
        "polarity", "subjectivity", "intensity",
    )
    # No token contains a blank.
    listed = F.array_join(tokens(F.col("_body")), " ").cast("binary").alias("_words")
    scores = (
        bodies.select("_chunk", "_text", listed).groupBy("_chunk").cogroup(entries.groupBy("_of"))
        .applyInArrow(_chunk_scorer(), "_text binary, polarity double, subjectivity double")
    )
    # One row for HOT_COPIES messages at most.
    hot = F.broadcast(bodies.where(F.col("_copies") > HOT_COPIES).select(
        "_text", F.least(F.lit(COPY_SALT), F.ceil(F.col("_copies") / HOT_COPIES)).cast("int").alias("_salts")
    ))
    salts = F.coalesce("_salts", F.lit(1))
    copy = F.pmod(F.xxhash64(*others), salts).cast("int") if others else F.lit(0)
    spread = F.explode(F.sequence(F.lit(0), (salts if others else F.lit(1)) - 1)).alias("_copy")
    # Scores are narrow: a hash of a part's scores, and no row has to be sorted to meet its own.
    found = scores.join(hot, "_text", "left").select("_text", spread, "polarity", "subjectivity").hint("shuffle_hash")
    return keyed.join(hot, "_text", "left").withColumn("_copy", copy).join(found, ["_text", "_copy"], "left").select(
        *messages.columns,
        F.coalesce("polarity", F.lit(0.0)).alias("polarity"),
        F.coalesce("subjectivity", F.lit(0.0)).alias("subjectivity"),
    )


def _chunk_scorer() -> Callable:
    """The rule over the texts of a chunk, given as tokens joined by blanks, and the entries of their words.

    Texts without a term are left out. Python's floats are the doubles of the column plan, added up in the same order.
    """
    boost, negation = BOOST, NEGATION

    def score(texts, entries):
        import pyarrow as pa

        rows = entries.to_pylist()
        terms = {r["word"]: (r["polarity"] or 0.0, r["subjectivity"] or 0.0) for r in rows if r["kind"] == "term"}
        factors = {
            r["word"]: 1.0 if r["intensity"] is None else r["intensity"] for r in rows if r["kind"] == "modifier"
        }
        negators = {r["word"] for r in rows if r["kind"] == "negator"}
        out = {"_text": [], "polarity": [], "subjectivity": []}
        for key, joined in zip(texts.column("_text"), texts.column("_words")):
            found = joined.as_py().split(b" ")
            total, weight, n = 0.0, 0.0, 0
            for i, word in enumerate(found):
                if word in terms:
                    before, before2 = (found[i - k] if i >= k else None for k in (1, 2))
                    factor = factors.get(before, 1.0)
                    lift = boost if found[i + 1 : i + 2] == [b"!"] else 1.0
                    negated = before in negators or (before in factors and before2 in negators)
                    p, s = terms[word]
                    total += max(-1.0, min(1.0, p * factor * lift)) * (negation if negated else 1.0)
                    weight += max(0.0, min(1.0, s * factor))
                    n += 1
            if n:
                for name, value in zip(out, (key.as_py(), total / n, weight / n)):
                    out[name].append(value)
        return pa.table(out, schema=pa.schema([("_text", pa.binary()), ("polarity", pa.float64()), ("subjectivity", pa.float64())]))

    return score
