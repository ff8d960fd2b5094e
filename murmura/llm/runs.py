"""Periodic runs of words: a suffix automaton whose suffix-link tree is a link-cut forest.

A run is a longest stretch of consecutive words with smallest period q and a length of max(24, 3 q) or more. Words are
appended to a suffix automaton one by one. The path from the tree's root to the state of the prefix just read
stands for all suffixes that end here; ``access`` makes that path preferred and recolours it with this end. What
it recolours comes in segments, each with one colour: the end where its strings were last seen. A segment with
longest string L and an end d words back says that the last L words equal those d before; the word before does not.
So L + d words have period d, and L >= 2 d makes them a run so far: a square, its start already exact. The next
words extend it, or it is closed. Colours hold for whole preferred paths (kept at the root of their splay tree).

Before that, arithmetic on whole texts finds the stretches of words whose 8-word passage occurred before
in the text. A run's words but the first period are inside one such stretch, so a stretch of n
passages holds no period over (n + 7) / 2; it and that many words before it are what the automaton reads. That is
exact; a text without repeats costs no automaton.

Each text is one row and is worked on by itself, without a shuffle; memory grows with the words of the longest
repetitive stretch, about 1 KB a word.

Cases: null and empty texts have no words and no runs. A null doc_id is kept and never damaged. Rows that repeat
are worked on one by one. Other columns are ignored. No documents give no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import byte_words, hash_words, run_hashes, slices

#: A run has this many words and this many periods at least.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words of the passages that tell repetitive stretches; with a run's limits, nine or more passages of it repeat.
PASSAGE = 8


def runs(words: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words`` (numbers that are equal where the words are), by place.

    State 0 is the root. ``up`` is the parent in the splay tree, or across a path's top the parent in the
    suffix-link tree; ``top`` and ``low`` are the children towards the root and away from it.
    """
    size = 2 * len(words) + 2
    longest, link, after = [0] * size, [-1] * size, [None] * size
    up, top, low, seen = [-1] * size, [-1] * size, [-1] * size, [-1] * size
    after[0] = {}
    states, last = 1, 0
    open_runs: dict[tuple[int, int], int] = {}
    found = []

    def rotate(x: int) -> None:
        y = up[x]
        z = up[y]
        if top[y] == x:
            child = top[y] = low[x]
            low[x] = y
        else:
            child = low[y] = top[x]
            top[x] = y
        if child >= 0:
            up[child] = y
        if z >= 0:
            if top[z] == y:
                top[z] = x
            elif low[z] == y:
                low[z] = x
        up[x], up[y] = z, x

    def splay(x: int) -> None:
        """Bring ``x`` to the root of its path's tree; the path's colour moves along."""
        y = up[x]
        if y < 0 or (top[y] != x and low[y] != x):
            return
        root = y
        while (z := up[root]) >= 0 and (top[z] == root or low[z] == root):
            root = z
        seen[x] = seen[root]
        while (y := up[x]) >= 0 and (top[y] == x or low[y] == x):
            z = up[y]
            if z >= 0 and (top[z] == y or low[z] == y):
                rotate(y if (top[z] == y) == (top[y] == x) else x)
            rotate(x)

    for i, word in enumerate(words):
        # Append the word to the automaton; new states enter the forest as they get their suffix link.
        new = states
        states += 1
        longest[new], after[new] = longest[last] + 1, {}
        p = last
        while p >= 0 and word not in after[p]:
            after[p][word] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = after[p][word]
            if longest[p] + 1 == longest[q]:
                link[new] = q
            else:
                clone = states
                states += 1
                longest[clone], after[clone], link[clone] = longest[p] + 1, after[q].copy(), link[q]
                while p >= 0 and after[p].get(word) == q:
                    after[p][word] = clone
                    p = link[p]
                link[q] = link[new] = clone
                # The clone goes between q and what is above it, into the path and the colour of q.
                splay(q)
                above = top[q]
                top[clone], up[clone], top[q], seen[clone] = above, q, clone, seen[q]
                if above >= 0:
                    up[above] = clone
        up[new] = link[new]
        last = new

        # Access: from the new state up, segment by segment.
        here: dict[tuple[int, int], int] = {}
        below, x = new, link[new]
        while x >= 0:
            splay(x)
            away = i - seen[x]
            length = longest[x]
            if length >= (LEAST_PERIODS - 1) * away and length + away >= LEAST_WORDS:
                here[i - length - away + 1, away] = i
            # What lay below x keeps the colour it had; x now heads the path that leads to the new state.
            if low[x] >= 0:
                seen[low[x]] = seen[x]
            low[x] = below
            below, x = x, up[x]
        seen[below] = i
        for key, end in open_runs.items():
            if key not in here:
                found.append((key[0], end - key[0] + 1, key[1]))
        open_runs = here
    found += [(start, end - start + 1, away) for (start, away), end in open_runs.items()]
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(hashes: np.ndarray) -> list[tuple[int, int]]:
    """Stretches [from, to) of the words that hold every run: repeated passages and what their period may reach back to."""
    passages = run_hashes(hashes, PASSAGE)
    if not len(passages):
        return []
    order = np.argsort(passages, kind="stable")
    again = np.zeros(len(passages), bool)
    again[order[1:]] = passages[order[1:]] == passages[order[:-1]]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], again, [False])).astype(np.int8)))
    out: list[tuple[int, int]] = []
    for first, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        span = end - first
        reach = (span + PASSAGE - 1) // (LEAST_PERIODS - 1)
        start, stop = max(0, first - reach), end + PASSAGE - 1
        if stop - start < LEAST_WORDS:
            continue
        if out and start <= out[-1][1]:
            # A stretch further on may reach back over several before it.
            while out and start <= out[-1][1]:
                start = min(start, out.pop()[0])
        out.append((start, stop))
    return out


def find_runs(words: list[bytes], hashes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of one text, by start and period."""
    found = []
    for start, stop in stretches(hashes):
        numbers: dict[bytes, int] = {}
        part = [numbers.setdefault(w, len(numbers)) for w in words[start:stop]]
        found += [(start + a, length, period) for a, length, period in runs(part)]
    return found


def damaged(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words as crc32 of the decimal doc_id asks: where it ends in 0, they turn periodic from some word on."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % period] for i in range(a, n)]


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words left when every run keeps its first period only."""
    if not found:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, n in zip(words, np.cumsum(gone).tolist()) if not n]


def _each(docs: DataFrame, damage: bool, tuples, types: list[tuple[str, pa.DataType]], ddl: str) -> DataFrame:
    """``tuples(doc_id, words, runs)`` for every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))

    def run(batches):
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            lists = [byte_words(t) for t in batch.column("text").to_pylist()]
            if damage:
                lists = [damaged(w, i) for w, i in zip(lists, ids)]
            hashes, starts = hash_words(lists)
            out = []
            for i, words, a, b in zip(ids, lists, starts[:-1].tolist(), starts[1:].tolist()):
                out += tuples(i, words, find_runs(words, hashes[a:b]))
            if out:
                columns = [pa.array(c, t) for c, (_, t) in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays(columns, [n for n, _ in types])

    return rows.mapInArrow(run, ddl)


_LONGS = ("n_runs", "start", "length", "period", "exponent_milli")


def periodic_runs(docs: DataFrame, damage: bool = False) -> DataFrame:
    """Every run of every text: doc_id, start, length, period (in words) and the words of its first period."""

    def spans(doc_id, words, found):
        return [(doc_id, s, n, q, b" ".join(words[s : s + q]).decode("utf-8", "replace")) for s, n, q in found]

    types = [("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("start", "length", "period")], ("unit", pa.string())]
    return _each(docs, damage, spans, types, "doc_id long, start long, length long, period long, unit string")


def collapse(docs: DataFrame, damage: bool = False) -> DataFrame:
    """doc_id and the text of every row with each run cut to its first period, words joined by one space."""

    def texts(doc_id, words, found):
        return [(doc_id, b" ".join(collapsed(words, found)).decode("utf-8", "replace"))]

    return _each(docs, damage, texts, [("doc_id", pa.int64()), ("text", pa.string())], "doc_id long, text string")


def report(docs: DataFrame, damage: bool = False) -> DataFrame:
    """One row per row of ``docs``: its runs counted, the one that repeats most, digests of all runs and of the rest."""

    def digests(doc_id, words, found):
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        return [(
            doc_id, len(found), *numbers, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest(),
        )]

    types = [("doc_id", pa.int64()), *[(c, pa.int64()) for c in _LONGS], ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
    ddl = ", ".join(["doc_id long", *[f"{c} long" for c in _LONGS], "runs_sha256 string", "collapsed_sha256 string"])
    return _each(docs, damage, digests, types, ddl)
