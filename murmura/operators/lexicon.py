"""The sentiment word list: a table, not code.

Columns: ``word``, ``kind`` (``term``, ``modifier`` or ``negator``),
``polarity`` and ``subjectivity`` of terms, ``intensity`` of modifiers.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.schemas import LEXICON

# A small list of our own. Terms: word -> (polarity, subjectivity).
TERMS = {
    "amazing": (0.7, 0.9), "awesome": (0.9, 1.0), "beautiful": (0.8, 0.9), "best": (0.9, 0.4),
    "better": (0.5, 0.5), "brilliant": (0.9, 0.9), "charming": (0.7, 0.9), "clean": (0.3, 0.6),
    "clever": (0.4, 0.7), "cool": (0.4, 0.6), "delicious": (0.9, 1.0), "delighted": (0.7, 0.8),
    "easy": (0.4, 0.8), "elegant": (0.5, 0.8), "enjoy": (0.5, 0.5), "excellent": (0.9, 0.9),
    "exciting": (0.4, 0.8), "fair": (0.5, 0.7), "fantastic": (0.7, 0.9), "fast": (0.2, 0.5),
    "fine": (0.4, 0.5), "fresh": (0.3, 0.5), "friendly": (0.5, 0.6), "fun": (0.4, 0.3),
    "glad": (0.5, 0.9), "good": (0.7, 0.6), "great": (0.8, 0.8), "happy": (0.8, 0.9),
    "helpful": (0.5, 0.5), "impressive": (0.7, 0.9), "interesting": (0.5, 0.5),
    "joy": (0.8, 0.6), "kind": (0.5, 0.8), "like": (0.2, 0.3), "love": (0.6, 0.6),
    "loved": (0.6, 0.7), "lovely": (0.6, 0.8), "nice": (0.6, 0.9), "okay": (0.1, 0.3),
    "perfect": (0.9, 0.9), "pleasant": (0.6, 0.8), "pleased": (0.5, 0.8), "proud": (0.6, 0.8),
    "reliable": (0.5, 0.5), "safe": (0.4, 0.5), "smart": (0.3, 0.6), "smooth": (0.3, 0.5),
    "super": (0.5, 0.7), "superb": (0.9, 0.9), "thanks": (0.3, 0.2), "useful": (0.4, 0.3),
    "win": (0.7, 0.4), "wonderful": (0.9, 0.9), "worth": (0.4, 0.3),
    "angry": (-0.5, 0.9), "annoying": (-0.7, 0.9), "awful": (-0.9, 0.9), "bad": (-0.7, 0.7),
    "boring": (-0.8, 0.9), "broken": (-0.4, 0.4), "confusing": (-0.4, 0.5), "cruel": (-0.9, 0.9),
    "dangerous": (-0.5, 0.8), "dirty": (-0.5, 0.7), "disappointed": (-0.7, 0.8),
    "disappointing": (-0.6, 0.7), "disgusting": (-0.9, 0.9), "dreadful": (-0.9, 0.9),
    "dumb": (-0.5, 0.6), "evil": (-0.9, 0.9), "fail": (-0.5, 0.3), "fake": (-0.5, 0.8),
    "fear": (-0.5, 0.6), "hate": (-0.8, 0.9), "hated": (-0.8, 0.8), "horrible": (-0.9, 0.9),
    "idiot": (-0.8, 0.8), "lose": (-0.4, 0.3), "mediocre": (-0.4, 0.8), "mess": (-0.3, 0.3),
    "nasty": (-0.8, 0.9), "poor": (-0.5, 0.6), "sad": (-0.6, 0.9), "scary": (-0.5, 0.8),
    "sick": (-0.6, 0.8), "slow": (-0.3, 0.4), "sorry": (-0.4, 0.8), "stupid": (-0.8, 0.9),
    "terrible": (-0.9, 0.9), "trash": (-0.5, 0.6), "ugly": (-0.7, 0.9), "unhappy": (-0.6, 0.9),
    "useless": (-0.6, 0.4), "waste": (-0.4, 0.3), "weak": (-0.4, 0.6), "worse": (-0.5, 0.6),
    "worst": (-0.9, 0.9), "worthless": (-0.8, 0.9), "wrong": (-0.5, 0.8),
}
# Modifiers: word -> factor on the term that follows.
MODIFIERS = {
    "absolutely": 1.5, "completely": 1.4, "extremely": 1.6, "incredibly": 1.5, "really": 1.3,
    "so": 1.2, "too": 1.2, "totally": 1.4, "truly": 1.3, "very": 1.3,
    "barely": 0.4, "fairly": 0.8, "hardly": 0.4, "mildly": 0.6, "pretty": 0.9, "quite": 0.9,
    "slightly": 0.5, "somewhat": 0.7,
}
NEGATORS = [
    "ain't", "aren't", "can't", "cannot", "couldn't", "didn't", "doesn't", "don't", "hasn't",
    "isn't", "never", "no", "nor", "not", "wasn't", "weren't", "without", "won't", "wouldn't",
]


@cache
def _default_rows() -> tuple[tuple, ...]:
    return (
        tuple((w, "term", p, s, None) for w, (p, s) in TERMS.items())
        + tuple((w, "modifier", None, None, k) for w, k in MODIFIERS.items())
        + tuple((w, "negator", None, None, None) for w in NEGATORS)
    )


def default_lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(_default_rows()), LEXICON)


def load_lexicon(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A word list stored as Parquet, JSON lines or CSV with the lexicon columns."""
    return spark.read.format(fmt).schema(LEXICON).options(**options).load(path)


def normalise(lexicon: DataFrame) -> DataFrame:
    """Lower-case words, one row per (word, kind); several senses are averaged."""
    return (
        lexicon.select(F.lower("word").alias("word"), "kind", "polarity", "subjectivity", "intensity")
        .groupBy("word", "kind")
        .agg(*[F.avg(c).alias(c) for c in ("polarity", "subjectivity", "intensity")])
    )
