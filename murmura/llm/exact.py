"""Exact duplicates by skew-safe combining: local, salted, global, each on the full content.

Equal texts (A-Z lower-cased, nothing else changed) are merged three times, always grouped by the text itself
next to its SHA-256: inside a map task (Spark's partial aggregation), among the tasks of one salt, and among
the salts. A text that fills a third of the table is one row a task after the first step, one row a salt after
the second. What is left per digest (winner, size, how many different contents) is written once; rows then find
their group by digest alone, which is exact where the digest has one content. A digest with more than one
(a collision) is settled by joining on the full text. Groups of a thousandth of all rows or more, at most 1000
by their size, are broadcast; the rest meet in a join that no such group can skew.

Cases: a null text counts as empty, and empty texts are equal to each other. The row with the largest doc_id
stays; a null doc_id is smaller than any other, so keep_id is null only if every row of the group lacks one. Of
rows that repeat both text and the largest doc_id exactly one stays, the others are dropped. Other columns are
ignored by ``exact_duplicates`` and kept by ``keep_one``, whatever they are called. No documents give no rows.
``docs`` is read twice and must give the same rows in the same partitions, as files do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import fresh, settle

#: Rows of one text that meet in a task: map tasks / SALTS in the salted step, SALTS in the global one.
SALTS = 64
#: Groups with at least 1 / HOT of all rows are broadcast; there are HOT of them at most.
HOT = 1000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def combined(rows: DataFrame, salts: int) -> DataFrame:
    """One row (digest, content, keep_row, keep_id, size) per content of ``rows`` (digest, content, row, id)."""
    # max_by takes the row of the largest id; without any id the smallest number stands in, as a tie it harms nothing.
    order = F.coalesce("id", F.lit(-(1 << 63)))
    salted = (
        rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("digest", "salt", "content")
        .agg(F.max_by("row", order).alias("row"), F.max("id").alias("id"), F.count("*").alias("size"))
    )
    return salted.groupBy("digest", "content").agg(
        F.max_by("row", order).alias("keep_row"), F.max("id").alias("keep_id"), F.sum("size").alias("size")
    )


def _numbered(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    content = normalised(F.col("text"))
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("id"),
        digest(content).alias("digest"), content.alias("content"),
    )


def groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """Rows (row, id, digest, keep_row, keep_id, size), one for every row of ``docs``; all but the digest are longs."""
    rows = _numbered(docs, digest)
    found = (
        combined(rows, salts)
        .groupBy("digest")
        .agg(
            F.count("*").alias("contents"), F.max("keep_row").alias("keep_row"),
            F.max("keep_id").alias("keep_id"), F.sum("size").alias("size"),
        )
    )
    found = settle(found, "exact-digests")
    # Two numbers for the driver: all rows, and the digests that stand for more than one content.
    total, collisions = found.agg(F.sum("size"), F.count_if(F.col("contents") > 1)).first()
    if not total:
        return rows.drop("content").join(found.drop("contents"), "digest").select(*_COLUMNS)

    known = found.where("contents = 1").drop("contents")
    hot = known.where(F.col("size") * HOT >= total).select("digest", F.struct("keep_row", "keep_id", "size").alias("hot"))
    cold = known.where(F.col("size") * HOT < total).withColumnRenamed("digest", "key")
    # A row of a hot group gets a key of its own, so that it neither matches nor piles up in the second join.
    at = rows.drop("content").join(F.broadcast(hot), "digest", "left").withColumn(
        "key", F.when(F.col("hot").isNotNull(), F.concat(F.lit("hot "), F.col("row"))).otherwise(F.col("digest"))
    )
    at = at.join(cold, "key", "left").select(
        "row", "id", "digest",
        *[F.coalesce(F.col(f"hot.{c}"), F.col(c)).alias(c) for c in ("keep_row", "keep_id", "size")],
    )
    if not collisions:
        return at
    several = found.where("contents > 1").select("digest")
    apart = rows.join(several, "digest", "left_semi")
    whole = combined(apart, salts)
    return at.where("size IS NOT NULL").unionByName(apart.join(whole, ["digest", "content"]).select(*_COLUMNS))


_COLUMNS = ["row", "id", "digest", "keep_row", "keep_id", "size"]


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its group: doc_id, keep_id, group_size, kept, text_sha256."""
    return groups(docs).select(
        F.col("id").alias("doc_id"), "keep_id", F.col("size").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"), F.col("digest").alias("text_sha256"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    row = fresh(docs, "_row")
    kept = groups(docs).where("row = keep_row").select(F.col("row").alias(row))
    return docs.withColumn(row, F.monotonically_increasing_id()).join(kept, row, "left_semi").drop(row)
