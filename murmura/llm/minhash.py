"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard on whole shingle sets.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a document's set holds its
distinct 5-word shingles (as 64-bit hashes), with fewer words the whole sequence as one.
All coordinates of a signature come from two permutations of the 32-bit universe: the first
one shuffles the shingles, the second one is shifted circularly by k for coordinate k.

Copies of one set are one class from the start, told apart by the set's digest and numbered as
they are written; doc_ids only name the result. In every band bucket, members are compared
with the bucket's first class. Only buckets that then still hold several components go on:
members outside the first one's component are compared with the members of all others, one by
one in small buckets, in blocks by products of incidence matrices in large ones. So a group of n
linked copies costs about n comparisons, and no link that would join two components is lost.

Cases: a text that is null, empty or white space has an empty set and links with nothing.
Rows that repeat a doc_id with different texts are separate documents of that id, each linked by its own set. A row without doc_id links with
nothing, has no component and is kept. Other columns are ignored. No rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import byte_words, components, fresh, hash_words, lowest, mix64, run_hashes, settle, slices

BANDS, ROWS = 20, 6  # at a similarity of 0.85 a pair shares a bucket with probability 0.9999
WORDS = 5
LEAST = 85  # hundredths
#: Buckets of more members than this are compared in blocks of about so many sets and shingles.
SMALL, BLOCK, BLOCK_SHINGLES = 32, 400, 150_000


def _first_permutation(x: np.ndarray) -> np.ndarray:
    x = x * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA77)
    return x ^ (x >> np.uint32(13))


def _second_permutation(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def shingle_sets(texts: list[bytes | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    flat, starts = hash_words([byte_words(x.lower()) if x else [] for x in texts])
    runs = run_hashes(flat, words)
    found = []
    for a, b in zip(starts[:-1], starts[1:]):
        n = int(b - a)
        if n >= words:
            found.append(np.unique(runs[a : b - words + 1]))
        else:
            found.append(run_hashes(flat[a:b], n) if n else np.empty(0, np.uint64))
    return found


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Circulant MinHash of non-empty sets: one row of ``coordinates`` minima each."""
    starts = np.concatenate([[0], np.cumsum([len(x) for x in sets])[:-1]]).astype(np.int64)
    base = _first_permutation(np.concatenate(sets).astype(np.uint32))
    out = np.empty((len(sets), coordinates), np.uint32)
    for k in range(coordinates):
        out[:, k] = np.minimum.reduceat(_second_permutation(base + np.uint32(k)), starts)
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.empty((len(signature), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(signature), band + 1, np.uint64)
        for row in range(rows):
            key = mix64(key ^ signature[:, band * rows + row].astype(np.uint64)) + np.uint64(row)
        keys[:, band] = key
    return keys.view(np.int64)


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key (digest of the set) and one key a band; the last two null for empty sets."""

    def sketch(batches):
        for part in slices(batches):
            sets = shingle_sets(part.column("text").to_pylist())
            full = [x for x in sets if len(x)]
            keys = band_keys(signatures(full, bands * rows), bands, rows).ravel() if full else np.empty(0, np.int64)
            has = np.array([len(x) > 0 for x in sets])
            edges = np.concatenate([[0], np.cumsum(has * bands)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("text_key"),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([xxhash.xxh128_digest(x.tobytes()) if len(x) else None for x in sets], pa.binary()),
                    pa.ListArray.from_arrays(edges, keys, mask=pa.array(~has)),
                ],
                ["doc_id", "text_key", "n_shingles", "set_key", "bands"],
            )

    return _with_text_key(docs).mapInArrow(
        sketch, "doc_id long, text_key binary, n_shingles long, set_key binary, bands array<long>"
    )


def verified(pairs: DataFrame, texts: DataFrame, least: int = LEAST) -> DataFrame:
    """The pairs (a, b) whose whole sets have ``100 * intersection >= least * union``."""

    def check(batches):
        last, last_set = None, None
        for part in slices(batches, "text_a"):
            a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
            sets = shingle_sets(part.column("text_a").to_pylist())
            keep = []
            for i, other in enumerate(b):
                if other != last:
                    last, last_set = other, shingle_sets([part.column("text_b")[i].as_py()])[0]
                both = len(np.intersect1d(sets[i], last_set, assume_unique=True))
                keep.append(100 * both >= least * (len(sets[i]) + len(last_set) - both))
            mask = np.array(keep)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(a, np.int64)[mask]), pa.array(np.array(b, np.int64)[mask])], ["a", "b"]
            )

    return (
        pairs.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(check, "a long, b long")
    )


def _with_text_key(docs: DataFrame) -> DataFrame:
    """doc_id, text (binary) and a digest of the text, which tells apart rows that repeat a doc_id."""
    text = F.col("text").cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.md5(text)).alias("text_key"))


def _decided(docs: DataFrame, bands: int, rows: int, least: int) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept: one row for every row of ``docs``."""
    sketch = settle(sketches(docs, bands, rows), "minhash-sketch")
    classes = settle(
        sketch.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("set_key", "n_shingles")
        .agg(F.min(F.struct("doc_id", "text_key")).alias("pick"), F.first("bands").alias("bands"))
        .select("set_key", "n_shingles", F.col("pick.doc_id").alias("low"), F.col("pick.text_key").alias("text_key"), "bands")
        .withColumn("rep", F.monotonically_increasing_id()),
        "minhash-classes",
    )
    spread = classes.select("rep", "n_shingles", F.posexplode("bands").alias("band", "key"))
    buckets = (
        spread.groupBy("band", "key")
        .agg(F.min(F.struct("rep", "n_shingles")).alias("hub"), F.count("*").alias("members"))
        .where("members > 1")
    )
    # A class stands in at most 20 buckets; only those it shares with other classes stay.
    shared = settle(
        spread.join(buckets, ["band", "key"])
        .select("band", "key", "rep", "n_shingles", F.col("hub.rep").alias("hub"), F.col("hub.n_shingles").alias("hub_n")),
        "minhash-buckets",
    )
    wanted = classes.join(shared.select("rep").distinct(), "rep", "left_semi").select("rep", F.col("low").alias("doc_id"), "text_key")
    # Rows that repeat both doc_id and text meet before the exchange.
    texts = settle(
        _with_text_key(docs).where(F.col("doc_id").isNotNull()).join(wanted, ["doc_id", "text_key"])
        .groupBy("doc_id", "text_key", "rep").agg(F.first("text").alias("text")).select("rep", "text"),
        "minhash-texts",
    )

    def close(n: str, m: str):  # sets of such sizes can reach the similarity
        return 100 * F.least(n, m) >= least * F.greatest(n, m)

    found = settle(
        verified(
            shared.where((F.col("rep") != F.col("hub")) & close("n_shingles", "hub_n"))
            .select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct(),
            texts, least,
        ),
        "minhash-links",
    )
    group = components(found)
    open_now = settle(_open_buckets(shared, group), "minhash-open")
    if not open_now.isEmpty():
        pairs = _across(open_now.where(F.col("members") <= SMALL)).where(close("n_a", "n_b"))
        more = verified(pairs.select("a", "b").distinct(), texts, least)
        more = settle(more.union(_in_blocks(open_now.where(F.col("members") > SMALL), texts, least)), "minhash-links")
        if not more.isEmpty():
            group = components(found.union(more))
    named = classes.select("set_key", "rep", "low").join(lowest(classes, group), "rep", "left").select(
        "set_key", F.coalesce("component", "low").alias("component")
    )
    own = sketch.select(
        "doc_id", "text_key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key"))
    return own.join(named, "set_key", "left").select(
        "doc_id", "text_key", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def near_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, least: int = LEAST) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for every row of ``docs``."""
    return _decided(docs, bands, rows, least).drop("text_key")


def _open_buckets(shared: DataFrame, group: DataFrame) -> DataFrame:
    """Members, with their component, of buckets that still hold several components.

    ``first`` is the component of the bucket's hub, with which all were compared.
    """
    label = group.select(F.col("id").alias("rep"), "component")
    members = shared.join(label, "rep", "left").select(
        "band", "key", "rep", "n_shingles", "hub", F.coalesce("component", "rep").alias("component")
    )
    state = members.groupBy("band", "key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.max(F.when(F.col("rep") == F.col("hub"), F.col("component"))).alias("first"),
        F.count("*").alias("members"), F.sum("n_shingles").alias("size"),
    ).where("low < high").drop("low", "high")
    return members.join(state, ["band", "key"])


def _across(members: DataFrame) -> DataFrame:
    """Members outside the bucket's first component against those of other components."""
    left = members.where("component <> first").select(
        "band", "key", F.col("rep").alias("a"), F.col("n_shingles").alias("n_a"), F.col("component").alias("c_a"),
    )
    right = members.select(
        "band", "key", F.col("rep").alias("b"), F.col("n_shingles").alias("n_b"), F.col("component").alias("c_b"),
        (F.col("component") == F.col("first")).alias("in_first"), "hub",
    )
    return left.join(right, ["band", "key"]).where(
        (F.col("c_a") != F.col("c_b")) & (F.col("b") != F.col("hub"))
        & (F.col("in_first") | (F.col("a") < F.col("b")))
    ).select("a", "b", "n_a", "n_b")


def _in_blocks(members: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """Links across components in large buckets, block by block.

    A bucket's members fall into blocks of about BLOCK sets and BLOCK_SHINGLES shingles; every block of
    members outside the first component meets every block of all members in one group. Of the links
    found there, those that join components leave it: fewer than there are members.
    """
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("size") / BLOCK_SHINGLES)).cast("int")
    own = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    keys = ["band", "key", "l", "r", "side", "rep", "component"]
    left = own.where("component <> first").withColumns({"l": F.col("block"), "side": F.lit(0)}).withColumn("r", every).select(keys)
    right = own.withColumns({"r": F.col("block"), "side": F.lit(1)}).withColumn("l", every).select(keys)
    rows = left.union(right).join(texts, "rep")

    def compare(part: pa.Table) -> pa.Table:
        side = part.column("side").to_numpy()
        reps, label = part.column("rep").to_pylist(), part.column("component").to_pylist()
        sets = shingle_sets(part.column("text").to_pylist())
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        both = intersections([sets[i] for i in a], [sets[i] for i in b])
        n = np.array([len(x) for x in sets])
        hits = np.argwhere(100 * both >= least * (n[a][:, None] + n[b][None, :] - both))
        parent = {c: c for c in label}
        found = []
        for i, j in hits:
            x, y = (_root(parent, label[k]) for k in (a[i], b[j]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                found.append((reps[a[i]], reps[b[j]]))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return rows.groupBy("band", "key", "l", "r").applyInArrow(compare, "a long, b long")


def _root(parent: dict, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def intersections(left: list[np.ndarray], right: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of the intersections of every left with every right set (sorted distinct values)."""
    out = np.zeros((len(left), len(right)))
    if not left or not right:
        return out
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    at_l = [np.searchsorted(shared, x[np.isin(x, shared, assume_unique=True)]) for x in left]
    at_r = [np.searchsorted(shared, x[np.isin(x, shared, assume_unique=True)]) for x in right]
    for start in range(0, len(shared), width):
        m = []
        for sets in (at_l, at_r):
            block = np.zeros((len(sets), min(width, len(shared) - start)), np.float32)
            for i, x in enumerate(sets):
                block[i, x[np.searchsorted(x, start) : np.searchsorted(x, start + width)] - start] = 1
            m.append(block)
        out += m[0] @ m[1].T
    return out


def keep_one(
    docs: DataFrame, bands: int = BANDS, rows: int = ROWS, least: int = LEAST
) -> DataFrame:
    """``docs`` without the near-duplicates of an earlier document; same columns.

    Rows that repeat both doc_id and text are one document and stay or go together.
    """
    names = [fresh(docs, "_gone"), fresh(docs, "_gone_text")]
    gone = _decided(docs, bands, rows, least).where(~F.col("kept")).select("doc_id", "text_key").distinct().toDF(*names)
    own = F.unhex(F.md5(F.col("text").cast("binary")))
    return docs.join(gone, (F.col("doc_id").cast("long") == F.col(names[0])) & (own == F.col(names[1])), "left_anti")
