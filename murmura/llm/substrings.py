"""Exact removal of repeated passages, found by difference-cover anchors.

A window is 20 consecutive words ``[^\\x20\\x09-\\x0D]+`` of one document. Every word under a
window that also starts earlier (smaller doc_id, or the same document further left) goes.

The residues {0, 1, 3, 9} modulo 13 are a difference cover: for any two starts i and j some
k < 13 puts both i + k and j + k on a residue of the cover. So two equal windows of 20 words
share a block of 8 words that is anchored at a cover position in both. Only blocks at cover
positions are hashed and grouped (4 of 13); only windows around a block that occurs twice are
then extended to the full 20 words and grouped by a 128-bit hash, where all but the earliest go.

Both groupings travel as packed blocks, dealt by hash range. A task sends one reference for each
hash and block of documents: further occurrences in the same block are known to be repeats at
once. So a passage in every third document sends a row per block, not one per document.

Cases: a null or empty text has no words and hashes the empty string. Rows that repeat a doc_id with
one text are one document: equal windows at the same start do not make each other repeats. Rows that
repeat a doc_id with different texts are separate documents, in the order of two hashes of the text; so
are rows without doc_id, which count as later than any id. Other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import NO_ID, byte_words, hash_words, run_hashes, settle, slices

WINDOW = 20
PERIOD, COVER = 13, (0, 1, 3, 9)
#: Words in an anchored block: any shift below the period leaves room for it.
BLOCK = WINDOW - PERIOD + 1
#: Bytes of text for each bucket of a grouping.
BUCKET_BYTES = 16 << 20
#: Hashes that a task packs at once; a document's own are never split.
PACKED = 1_000_000
#: What names a document: its id, and two hashes of its text where the id is missing or repeated.
DOC = ("doc", "twin", "other")
KINDS = {"doc": np.int64, "twin": np.int64, "other": np.int64, "pos": np.int32}


def _group_starts(order_keys: list[np.ndarray]) -> np.ndarray:
    """True where a sorted run of equal keys begins."""
    new = np.ones(len(order_keys[0]), bool)
    if len(new):
        new[1:] = np.any([k[1:] != k[:-1] for k in order_keys], axis=0)
    return new


def _squeeze(values: np.ndarray, ascending: bool = False) -> bytes:
    """An array by byte planes, compressed; of ascending values, the steps."""
    if ascending:
        values = np.diff(values, prepend=values.dtype.type(0))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unsqueeze(packed: list[bytes], kind, ascending: bool = False) -> np.ndarray:
    opener, parts = zstandard.ZstdDecompressor(), []
    for one in packed:
        planes = np.frombuffer(opener.decompress(one), np.uint8).reshape(np.dtype(kind).itemsize, -1)
        values = np.ascontiguousarray(planes.T).reshape(-1).view(kind)
        parts.append(np.cumsum(values, dtype=kind) if ascending else values)
    return np.concatenate(parts) if parts else np.empty(0, kind)


def _order(keys: list[np.ndarray], places: dict[str, np.ndarray]) -> np.ndarray:
    """The order by keys, then places; columns without any value but 0 take no part."""
    return np.lexsort([x for x in reversed([*keys, *places.values()]) if x.any()] or [places["pos"]])


def _same_place(places: dict[str, np.ndarray], at: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.all([x[at] == x[other] for x in places.values()], axis=0)


def _pack(keys: list[np.ndarray], places: dict[str, np.ndarray], buckets: int):
    """Rows (bucket, keys, place, known, places of more) of one block of documents.

    The first occurrence of a key is its reference; ``known`` says that it occurs again
    here. Further occurrences, repeats for certain, ride along without their key.
    """
    order = _order(keys, places)
    keys, places = [k[order] for k in keys], {name: x[order] for name, x in places.items()}
    first = _group_starts(keys)
    again = ~first
    at = np.flatnonzero(again)
    again[at] = ~_same_place(places, at, at - 1)
    known = np.zeros(len(order), bool)
    known[np.flatnonzero(first)] = np.diff(np.append(np.flatnonzero(first), len(order))) > 1
    bucket = (keys[0] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    rows = []
    for i in np.flatnonzero(np.diff(cuts)):
        part = slice(cuts[i], cuts[i + 1])
        f, m = first[part], again[part]
        rows.append((
            int(i), *(_squeeze(k[part][f], k is keys[0]) for k in keys), *(_squeeze(x[part][f]) for x in places.values()),
            _squeeze(known[part][f]), *(_squeeze(x[part][m]) for x in places.values()),
        ))
    names = _names(len(keys))
    columns = list(zip(*rows)) if rows else [()] * len(names)
    kinds = [pa.int32(), *[pa.binary()] * (len(names) - 1)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _names(keys: int) -> list[str]:
    return ["bucket", *(f"key{i}" for i in range(keys)), *KINDS, "known", *(f"more_{name}" for name in KINDS)]


def _schema(keys: int) -> str:
    return "bucket int, " + ", ".join(f"{name} binary" for name in _names(keys)[1:])


def _packed(found, keys: int, buckets: int, most: int):
    """Pack what ``found`` yields, (keys, places) a slice, in blocks of about ``most`` hashes."""
    held, size = [], 0

    def block():
        return _pack(
            [np.concatenate([k[i] for k, _ in held]) for i in range(keys)],
            {name: np.concatenate([p[name] for _, p in held]) for name in KINDS}, buckets,
        )

    for one in found:
        held.append(one)
        size += len(one[0][0])
        if size >= most:
            yield block()
            held, size = [], 0
    if size:
        yield block()


def _places(part: pa.RecordBatch, row: np.ndarray, pos: np.ndarray) -> dict[str, np.ndarray]:
    return {name: part.column(name).to_numpy(zero_copy_only=False)[row] for name in DOC} | {"pos": pos.astype(np.int32)}


def _repeats(packed: DataFrame, keys: int, keep_first: bool) -> DataFrame:
    """Places of keys that occur twice; without the earliest place if ``keep_first``."""

    def joined(part: pa.Table, name: str, kind) -> np.ndarray:
        return _unsqueeze(part.column(name).to_pylist(), kind, name == "key0")

    def find(part: pa.Table) -> pa.Table:
        hashed = [joined(part, f"key{i}", np.uint64) for i in range(keys)]
        places = {name: joined(part, name, kind) for name, kind in KINDS.items()}
        order = _order(hashed, places)
        first = _group_starts([k[order] for k in hashed])
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(order)))
        places = {name: x[order] for name, x in places.items()}
        if keep_first:
            again = ~first  # equal places stand next to each other at the front
            head = np.repeat(starts, sizes)
            at = np.flatnonzero(again)
            again[at] = ~_same_place(places, at, head[at])
        else:
            known = np.add.reduceat(joined(part, "known", bool)[order].astype(np.int64), starts) if len(starts) else starts
            again = np.repeat((sizes > 1) | (known > 0), sizes)
        return pa.table({
            name: np.concatenate([places[name][again], joined(part, f"more_{name}", kind)]) for name, kind in KINDS.items()
        })

    return packed.groupBy("bucket").applyInArrow(find, "doc long, twin long, other long, pos int")


def _documents(docs: DataFrame) -> DataFrame:
    """Every row's name (DOC) and text (binary)."""
    text = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.col("text").cast("binary").alias("text")
    )
    repeated = settle(
        text.where(F.col("doc") != NO_ID).groupBy("doc").count().where("count > 1").select("doc", F.lit(True).alias("repeated")),
        "repeated-ids",
    )
    several = F.col("doc") == NO_ID
    if not repeated.isEmpty():
        text = text.join(repeated, "doc", "left")
        several = several | F.col("repeated").isNotNull()
    hashes = (F.xxhash64("text"), F.xxhash64(F.lit("other"), "text"))
    return text.select("doc", *(F.when(several, x).otherwise(0).alias(name) for name, x in zip(DOC[1:], hashes)), "text")


def removed_words(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, packed: int = PACKED) -> DataFrame:
    """The name (DOC), text (binary) and the starts of windows that occur earlier, for every row."""
    spark = docs.sparkSession
    text = _documents(docs)
    size = docs.agg(F.sum(F.length(F.col("text").cast("binary")))).first()[0] or 0
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // bucket_bytes, 1)

    def anchors(part: pa.RecordBatch):
        words, starts = hash_words([byte_words(x) for x in part.column("text").to_pylist()])
        hashes = run_hashes(words, BLOCK)
        row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[: len(hashes)]
        pos = np.arange(len(hashes)) - starts[row]
        use = np.isin(pos % PERIOD, COVER) & (pos + BLOCK <= np.diff(starts)[row])
        return [hashes[use]], _places(part, row[use], pos[use])

    def windows(part: pa.RecordBatch):
        words, starts = hash_words([byte_words(x) for x in part.column("text").to_pylist()])
        cover = np.zeros(len(words) + 1, np.int64)
        for i, found in enumerate(part.column("found")):
            n = int(starts[i + 1] - starts[i])
            p = found.values.to_numpy()
            if n >= WINDOW and len(p):
                low = np.maximum(p - (PERIOD - 1), 0)
                high = np.minimum(p, n - WINDOW) + 1
                fits = low < high
                np.add.at(cover, starts[i] + low[fits], 1)
                np.add.at(cover, starts[i] + high[fits], -1)
        at = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
        # words of the windows only: positions of one run after the other
        keys = [run_hashes(words, WINDOW, seed + 1)[at] if len(at) else np.empty(0, np.uint64) for seed in (0, 1)]
        row = np.searchsorted(starts, at, "right") - 1
        return keys, _places(part, row, at - starts[row])

    def hashed(find, keys: int):
        return lambda batches: _packed(map(find, slices(batches)), keys, buckets, packed)

    found = _repeats(text.mapInArrow(hashed(anchors, 1), _schema(1)), 1, False)
    # A set: rows of one name find the same places.
    found = found.groupBy(*DOC).agg(F.collect_set("pos").alias("found"))
    around = text.join(found, list(DOC)).mapInArrow(hashed(windows, 2), _schema(2))
    gone = _repeats(around, 2, True).groupBy(*DOC).agg(F.collect_set("pos").alias("gone"))
    return text.join(gone, list(DOC), "left")


def dedup(
    docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, with_text: bool = False, packed: int = PACKED
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by a space), kept_text on wish."""

    def cut(batches):
        for part in slices(batches):
            n, removed, kept = [], [], []
            for text, gone in zip(part.column("text").to_pylist(), part.column("gone")):
                words = byte_words(text)
                n.append(len(words))
                drop = 0
                if gone.is_valid:
                    p = np.unique(gone.values.to_numpy())
                    cover = np.bincount(p, minlength=len(words) + WINDOW) - np.bincount(
                        p + WINDOW, minlength=len(words) + WINDOW)
                    out = np.cumsum(cover)[: len(words)] > 0
                    drop = int(out.sum())
                    words = [w for w, x in zip(words, out.tolist()) if not x]
                removed.append(drop)
                kept.append(b" ".join(words))
            ids = part.column("doc")
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            columns = [
                pa.array([None if i == NO_ID else i for i in ids.to_pylist()], pa.int64()), pa.array(n, pa.int64()),
                pa.array(removed, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
            ]
            if with_text:
                names, columns = [*names, "kept_text"], [*columns, pa.array([x.decode() for x in kept])]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return removed_words(docs, bucket_bytes, packed).mapInArrow(cut, schema)
