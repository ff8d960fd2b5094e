"""Benchmark decontamination by spaced-seed hashing.

Tokens are runs of letters and digits of the lower-cased text. Fixed masks slide over the tokens; a seed is the
hash of the tokens that a mask selects, so a substitution under an ignored position does not
change it. An overlap counts if it has at least 12 tokens, or the whole item where that is shorter, and at
least 80 % of them are equal. Every such overlap holds a seed: it can be cut down to one of 12 to 23 tokens, and
any 12 tokens with two substituted, 15 with three and 20 with four are hit by one mask at least; items of fewer than
12 tokens have masks of their own, for 6 tokens with one substituted and 10 with two. Seeds of documents that may be benchmark seeds (a filter of fixed size, which only ever lets too many through)
are joined with the benchmark's seeds; each hit names a document, an item and a shift between the two. The texts
are then compared token by token along that shift, and of all stretches that count, the one with the most equal
tokens is reported, without substituted tokens at its ends where the least length allows.

The benchmark may have any size: the filter has 8 MB, and seeds, hits and texts meet in joins. Items of
equal tokens are one item until the end.

Cases: a null or empty text or item has no tokens and matches nothing, nor does an item of fewer than 6 tokens.
Rows that repeat a doc_id are compared each on its own; the best of them is reported. A row without doc_id is reported
with a null id. Repeated items are reported each under its item_id. Other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import NO_ID, fresh, run_hashes, settle, slices

#: Selected positions are 1; ignored ones may be substituted.
MASKS = ("111111", "11101011", "101001000111", "1101100010001", "10011111")
SHORT_MASKS = ("11111", "101111", "110111", "111011", "111101", "11001011")  # for items of fewer than LEAST_TOKENS
LEAST_TOKENS, LEAST_ITEM = 12, 6
LEAST_SHARE = 4, 5  # four fifths
FILTER_BITS = 26
_TOKEN = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def seeds(words: np.ndarray, masks: list[int]) -> list[tuple[int, np.ndarray]]:
    """(mask number, seed hash from each position on) of one run of token hashes."""
    every = MASKS + SHORT_MASKS
    return [(m, run_hashes(words, len(every[m]), m + 1, [i for i, x in enumerate(every[m]) if x == "1"])) for m in masks]


def _seeds_of(texts: list[str | None], masks: list[int]):
    """Seeds of many texts at once: (text number, position, tokens of the text, mask number, seed), none across two texts."""
    lists = [tokens(x) for x in texts]
    size = np.array([len(x) for x in lists], np.int64)
    starts = np.zeros(len(lists) + 1, np.int64)
    np.cumsum(size, out=starts[1:])
    words = np.fromiter(map(xxhash.xxh64_intdigest, (w for x in lists for w in x)), np.uint64, int(starts[-1]))
    row = np.repeat(np.arange(len(lists)), size)
    left = starts[1:][row] - np.arange(len(words)) if len(words) else np.empty(0, np.int64)
    for m, hashed in seeds(words, masks):
        at = np.flatnonzero(left[: len(hashed)] >= len((MASKS + SHORT_MASKS)[m]))
        yield row[at], at - starts[row[at]], size[row[at]], m, hashed[at]


def benchmark_seeds(items: DataFrame) -> DataFrame:
    """(item, item_pos, mask, seed) of every distinct item text, by the masks for its length."""

    def run(batches):
        for part in slices(batches):
            for row, pos, size, m, hashed in _seeds_of(part.column("text").to_pylist(), list(range(len(MASKS + SHORT_MASKS)))):
                own = size >= LEAST_TOKENS if m < len(MASKS) else (size >= LEAST_ITEM) & (size < LEAST_TOKENS)
                row, pos, hashed = row[own], pos[own], hashed[own]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("item").take(pa.array(row)), pa.array(pos.astype(np.int32)),
                        pa.array(np.full(len(row), m, np.int32)), pa.array(hashed.view(np.int64)),
                    ],
                    ["item", "item_pos", "mask", "seed"],
                )

    return items.mapInArrow(run, "item binary, item_pos int, mask int, seed long")


def _filter(found: DataFrame) -> np.ndarray:
    """A bit for each of two parts of every benchmark seed; at most 2^20 words come to the driver."""
    side = (1 << FILTER_BITS) - 1
    bits = found.select(F.explode(F.array(
        F.col("seed").bitwiseAND(side), F.shiftrightunsigned("seed", 32).bitwiseAND(side))).alias("bit"))
    words = bits.select(
        F.shiftright("bit", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("mask")
    ).groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[words.column("word").to_numpy()] = words.column("mask").to_numpy().view(np.uint64)
    return out


def _may_be(hashed: np.ndarray, bits: np.ndarray) -> np.ndarray:
    side = np.uint64((1 << FILTER_BITS) - 1)
    low = hashed & side
    found = np.flatnonzero((bits[low >> np.uint64(6)] >> (low & np.uint64(63))) & np.uint64(1))
    high = (hashed[found] >> np.uint64(32)) & side
    return found[((bits[high >> np.uint64(6)] >> (high & np.uint64(63))) & np.uint64(1)).astype(bool)]


def best_stretch(equal: np.ndarray, least: int) -> tuple[int, int] | None:
    """Start and end of the stretch of at least ``least`` tokens and LEAST_SHARE with the most equal tokens, the first of such.

    For every end the earliest start that keeps the share gives the most equal tokens; earliest starts lie
    where the prefix sum of the share's surplus reaches a new low.
    """
    over, of = LEAST_SHARE
    same = np.concatenate([[0], np.cumsum(equal)])
    surplus = of * same - over * np.arange(len(same))
    start = np.searchsorted(-np.minimum.accumulate(surplus), -surplus, "left")
    end = np.arange(len(same))
    found = np.where(end - start >= least, same - same[start], -1)
    b = int(np.argmax(found))
    if found[b] <= 0:
        return None
    a = int(start[b])
    while b - a > least and not equal[a]:
        a += 1
    while b - a > least and not equal[b - 1]:
        b -= 1
    return a, b


def overlap(doc: list[str], item: list[str], shift: int) -> tuple[int, int, int] | None:
    """(start in the document, tokens, equal tokens) of the verified overlap along ``shift``."""
    a, b = max(0, shift), min(len(doc), shift + len(item))
    if b <= a:
        return None
    equal = np.array([x == y for x, y in zip(doc[a:b], item[a - shift : b - shift])])
    found = best_stretch(equal, min(LEAST_TOKENS, len(item)))
    if found is None:
        return None
    start, end = found
    return a + start, end - start, int(equal[start:end].sum())


def _row_key() -> tuple[Column, Column]:
    """Id and text digest of a row; rows that share both have the same overlaps."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.unhex(F.md5(F.col("text").cast("string")))


def _proven(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The verified overlaps (doc, key, item, start_token, n_tokens, n_equal), and the benchmark with the ``item`` of each row."""
    spark = docs.sparkSession
    doc, key = _row_key()
    own = docs.select(doc.alias("doc"), key.alias("key"), F.col("text").cast("string").alias("text"))
    named = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null").withColumn(
        "item", F.unhex(F.md5(F.lower("text"))))
    items = named.groupBy("item").agg(F.first("text").alias("text"))
    known = settle(benchmark_seeds(items), "benchmark-seeds")
    bits = spark.sparkContext.broadcast(_filter(known))
    masks = sorted(r.mask for r in known.select("mask").distinct().collect())

    def run(batches):
        for part in slices(batches):
            for row, pos, _, _, hashed in _seeds_of(part.column("text").to_pylist(), masks):
                at = _may_be(hashed, bits.value)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("doc").take(pa.array(row[at])), part.column("key").take(pa.array(row[at])),
                            pa.array(pos[at].astype(np.int32)), pa.array(hashed[at].view(np.int64)),
                        ],
                        ["doc", "key", "pos", "seed"],
                    )

    hits = own.mapInArrow(run, "doc long, key binary, pos int, seed long").join(known, "seed").select(
        "doc", "key", "item", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct()
    hits = settle(hits, "benchmark-hits")

    def verify(batches):
        last, words = None, []
        for part in slices(batches):
            rows = []
            for doc, key, text, item, other, shift in zip(*(part.column(x).to_pylist() for x in ("doc", "key", "text", "item", "item_text", "shift"))):
                if text != last:
                    last, words = text, tokens(text)
                found = overlap(words, tokens(other), shift)
                if found:
                    rows.append((doc, key, item, *found))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc", "key", "item", "start_token", "n_tokens", "n_equal"]
            )

    proven = (
        hits.join(items.select("item", F.col("text").alias("item_text")), "item").join(own, ["doc", "key"])
        .select("doc", "key", "text", "item", "item_text", "shift")
        .mapInArrow(verify, "doc long, key binary, item binary, start_token int, n_tokens int, n_equal int")
    )
    return proven, named


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start_token, n_tokens, n_equal: a row for each document and item that overlap."""
    proven, named = _proven(docs, benchmark)
    proven = proven.groupBy("doc", "item").agg(
        F.max(F.struct("n_equal", F.negative("start_token").alias("back"), "n_tokens")).alias("best"))
    return proven.join(named.select("item", "item_id"), "item").select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "item_id",
        F.negative("best.back").alias("start_token"), F.col("best.n_tokens").alias("n_tokens"), F.col("best.n_equal").alias("n_equal"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that overlap with an item, each judged by its own text; same columns."""
    name, digest = fresh(docs, "_gone"), fresh(docs, "_gone_text")
    doc, key = _row_key()
    gone = _proven(docs, benchmark)[0].select(F.col("doc").alias(name), F.col("key").alias(digest)).distinct()
    return docs.join(gone, (doc == F.col(name)) & (key == F.col(digest)), "left_anti")
