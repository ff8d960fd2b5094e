"""One registered query per corpus operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from murmura.llm import (
    conversations,
    decontaminate,
    embeddings,
    exact,
    html_text,
    licenses,
    minhash,
    pieces,
    pii,
    quality,
    runs,
    substrings,
    toxicity,
)
from murmura.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score and offending spans of every document."""
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document under merge-dropout, checked by decoding them."""
    return pieces.encode(table(spark, sf_dir, "documents"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and component of every document; contract columns in this order."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find_personal_data(table(spark, sf_dir, "documents")).drop("scored")


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document once repeated passages are gone."""
    return substrings.dedup(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, with the verified overlap."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation after its damage."""
    return conversations.report(conversations.damage(table(spark, sf_dir, "conversations")), mark="present")


def op12_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document."""
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document after its damage."""
    return runs.report(table(spark, sf_dir, "documents"), damage=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_sentencepiece": op2_sentencepiece,
        "op3_minhash": op3_minhash,
        "op4_licenses": op4_licenses,
        "op5_html": op5_html,
        "op6_embeddings": op6_embeddings,
        "op7_quality": op7_quality,
        "op8_pii": op8_pii,
        "op9_substrings": op9_substrings,
        "op10_decontaminate": op10_decontaminate,
        "op11_conversations": op11_conversations,
        "op12_exact": op12_exact,
        "op13_runs": op13_runs,
        "pipeline": corpus_pipeline.run,
    }
