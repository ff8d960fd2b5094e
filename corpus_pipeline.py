"""Training-data pipeline over ``documents``: five stages, each written and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last
return the columns of documents, so that a run can stop and go on after any of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from murmura.llm import decontaminate, minhash, pieces, pii, quality
from murmura.llm.common import settle, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near-duplicates."""
    return minhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document, checked by decoding them."""
    return pieces.encode(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("PII", without_personal_data),
    ("SentencePiece encoding", as_pieces),
]

#: The classifier and the pieces are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what lies between them is written as Parquet."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), "stage-" + name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
