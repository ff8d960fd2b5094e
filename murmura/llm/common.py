"""What several corpus operators share: tables, words, hashes, written stages, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.session import scratch_dir

#: Stands for a missing id where ids are compared: later than any other.
NO_ID = (1 << 63) - 1
#: Groups of linked classes with 1 / HOT of all classes or more; there are HOT of them at most.
HOT = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps start from the files."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fold(column: str = "doc_id", keep: str = "0,1,3") -> Column:
    """True for rows whose crc32 of the id as text, mod 4, is one of ``keep``."""
    rest = F.crc32(F.col(column).cast("string").cast("binary")) % 4
    return F.coalesce(rest.isin([int(x) for x in keep.split(",")]), F.lit(False))


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", rows: int = 2000, limit: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that a piece holds one row or at most ``limit`` bytes of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            fits = int(np.searchsorted(total, before + limit, "right"))
            end = max(start + 1, min(start + rows, fits, batch.num_rows))
            yield batch.slice(start, end - start)
            start = end


def byte_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text; bytes.split() breaks at exactly these."""
    return text.split() if text else []


def hash_words(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words one after the other, and where each list starts (one more at the end)."""
    starts = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=starts[1:])
    flat = np.fromiter(
        map(xxhash.xxh64_intdigest, chain.from_iterable(lists)), np.uint64, int(starts[-1])
    )
    return flat, starts


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def run_hashes(words: np.ndarray, length: int, seed: int = 0, offsets: Iterable[int] | None = None) -> np.ndarray:
    """Hash of the ``length`` words from each position on (of those at ``offsets`` only, if given)."""
    n = max(0, len(words) - length + 1)
    out = np.full(n, (0x9E3779B97F4A7C15 * (seed + 1) + length) & (2**64 - 1), np.uint64)
    for i in range(length) if offsets is None else offsets:
        out ^= words[i : i + n]
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return mix64(out)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (id, component), the smallest id of each.

    Large-star and small-star rounds: a node's edges move to the smallest neighbour until
    every component is a star. Each round is written to the shared folder; the driver
    sees three numbers a round. Minima are combined before the shuffle, and the joins
    leave hot nodes to the skew split.
    """

    def settled(df: DataFrame) -> tuple[DataFrame, tuple]:
        df = settle(df.where(F.col("a") < F.col("b")).distinct(), "components")
        state = df.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum((F.xxhash64("b", "a") % 1_000_003).cast("long"))
        ).first()
        return df, tuple(state)

    now, state = settled(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    while state[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.join(low, "a").where(F.col("b") > F.col("a"))
            .select(F.col("m").alias("a"), "b").where(F.col("a") < F.col("b")).distinct()
        )
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
        now, after = settled(small)
        if after == state:
            break
        state = after
    return now.select(F.col("b").alias("id"), F.col("a").alias("component")).union(
        now.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    )


def lowest(classes: DataFrame, group: DataFrame) -> DataFrame:
    """(rep, component) for the ``classes`` (rep, low) in ``group`` (id, component): the smallest ``low`` of each component."""
    own = settle(classes.select("rep", "low").join(group.withColumnRenamed("id", "rep"), "rep"), "groups")
    least = own.groupBy("component").agg(F.min("low").alias("lowest"), F.count("*").alias("members"))
    total = own.count()
    # By their size there are HOT large groups at most; the others can skew no join.
    hot = F.broadcast(least.where(F.col("members") * HOT >= total))
    cold = least.where(F.col("members") * HOT < total)
    large = own.join(hot, "component")
    small = own.join(hot, "component", "left_anti").join(cold, "component")
    return large.unionByName(small).select("rep", F.col("lowest").alias("component"))


def summed(df: DataFrame, measure, size: int, slots: int = 16) -> np.ndarray:
    """Sum over all rows of ``measure(batch) -> float64[size]``, a partition at a time.

    Partition sums meet in at most ``slots`` rows before the driver adds those up, so what
    arrives there is bounded however many partitions there are.
    """

    def one(batches):
        total, used = np.zeros(size), 0
        for batch in batches:
            if batch.num_rows:
                total += measure(batch)
                used += 1
        if used:
            slot = int(xxhash.xxh32_intdigest(total.tobytes())) % slots
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([total.tobytes()])], ["slot", "part"])

    def add(part: pa.Table) -> pa.Table:
        total = np.zeros(size)
        for x in part.column("part"):
            total += np.frombuffer(x.as_py())
        return pa.table({"part": [total.tobytes()]})

    parts = df.mapInArrow(one, "slot int, part binary").groupBy("slot").applyInArrow(add, "part binary").collect()
    total = np.zeros(size)
    for row in sorted(bytes(x["part"]) for x in parts):
        total += np.frombuffer(row)
    return total


def labelled(docs: DataFrame, labels: DataFrame, column: str, most: int) -> DataFrame:
    """``docs`` (with doc_id) of the training folds with their ``label``; about ``most`` rows at most.

    Repeated labels of a document are averaged, null ones left out. Beyond ``most`` labels, a hash of
    the id decides which ones stay, so the sample is the same on every run. The ids and labels, bounded
    by ``most``, go to the documents; the documents are not shuffled.
    """
    one = labels.select(F.col("doc_id").cast("long"), F.col(column).cast("double").alias("label")).dropna()
    one = one.where(fold()).groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("double").alias("label"))
    count = one.count()
    if count > most:
        one = one.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(most / count * (1 << 20)))
    return docs.join(F.broadcast(one), "doc_id")
