"""Toxic spans by a linear-chain conditional random field, and a score of each document.

Labels come per document, so training first labels tokens: a word, or the first four to six letters of
one, that occurs in 1.5 % of the toxic training documents (five at least) and hardly ever in clean ones marks its
tokens in toxic documents. A chain is a sentence (up to a stop, 128 tokens at most); its tokens carry the
features of the word, its beginnings and end, and both neighbours. The field's two states, 0 and
1, have emission weights a feature and four transitions, fitted by gradient steps on the
likelihood of whole chains; forward-backward gives every token's marginal. A logistic
curve over a document's largest marginal and its expected number of toxic tokens, fitted on training
documents, is the score; runs of tokens with a marginal of 0.5 or more are the offending spans.

Only the text enters a score. Documents whose crc32(doc_id) mod 4 is 2 are held out.

Bounds, of training alone: FIT_DOCS labelled documents, CHAINS chains, MARKERS marker strings.
Scoring reads every token of every text, and what it holds at once is a slice of a batch.

Cases: a null text counts as empty; an empty text has no tokens and gets the score of zero evidence. A
null doc_id is never in training and not held out. Repeated labels are averaged, null labels skipped.
Without labels of both classes the score is the share of toxic ones (0 without labels), and no
spans are found. Repeated rows repeat their score; no rows give no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import fold, labelled, settle, slices

#: Bounds of the training sample.
FIT_DOCS, CHAINS, MARKERS = 40_000, 24_000, 20_000
CHAIN = 128
THRESHOLD = 0.3
SPAN = 0.5
_STRIP = b".,;:!?*#$%&|\"'()[]{}<>-_~`"
_STOPS = frozenset(b".!?")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_KINDS = (b"w:", b"4:", b"5:", b"6:", b"e:", b"p:", b"n:")


def plain(word: bytes) -> bytes:
    """A word in lower case without the marks around it."""
    return word.lower().strip(_STRIP)


def evidence(text: bytes | None) -> set[bytes]:
    """Words and beginnings of words of a text, as candidates for markers."""
    found = set()
    for word in {plain(w) for w in (text or b"").split()}:
        if word:
            found.add(b"w:" + word)
            found.update(b"%d:" % n + word[:n] for n in (4, 5, 6) if len(word) > n)
    return found


@dataclass
class Field:
    """Weights of state 1 over state 0 by feature, transitions, and the logistic curve."""

    own: dict[bytes, float] = field(default_factory=dict)  # keys as in _KINDS
    bias: float = 0.0
    transitions: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)
    share: float | None = None  # set where there was nothing to learn

    def emissions(self, words: list[bytes], cache: dict) -> np.ndarray:
        """What each word adds to itself, to the word after and the word before it; whether it ends a sentence."""
        get, out = self.own.get, []
        for word in words:
            found = cache.get(word)
            if found is None:
                w = plain(word)
                own = get(b"w:" + w, 0.0) + get(b"4:" + w[:4], 0.0) + get(b"5:" + w[:5], 0.0)
                own += get(b"6:" + w[:6], 0.0) + get(b"e:" + w[-3:], 0.0) + self.bias
                found = cache[word] = (own, get(b"p:" + w, 0.0), get(b"n:" + w, 0.0), word[-1] in _STOPS)
            out.append(found)
        return np.array(out, np.float64).reshape(-1, 4)


def chains(stops: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where chains begin: documents, words after a stop, and every CHAIN tokens."""
    n = len(stops)
    new = np.zeros(n, bool)
    new[starts[:-1][starts[:-1] < n]] = True
    new[1:] |= stops[:-1]
    begin = np.flatnonzero(new)
    offset = np.arange(n) - np.repeat(begin, np.diff(np.append(begin, n)))
    new |= offset % CHAIN == 0
    return np.flatnonzero(new)


def marginals(emission: np.ndarray, begin: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """P(state 1) of every token; ``begin`` lists where chains start. All chains step together."""
    n = len(emission)
    if not n:
        return np.empty(0)
    length = np.diff(np.append(begin, n))
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    steps = int(length[0])
    live = np.searchsorted(-length, -np.arange(steps), "left")  # chains longer than t
    t = np.exp(transitions - transitions.max())
    e = np.exp(np.clip(emission, -30, 30))
    forward, backward = np.empty(n), np.ones(n)  # share of state 1; messages normalised to state 0 = 1
    odds = e[begin]
    forward[begin] = odds
    for i in range(1, steps):
        at = begin[: live[i]] + i
        odds = odds[: live[i]]
        odds = e[at] * (t[0, 1] + odds * t[1, 1]) / (t[0, 0] + odds * t[1, 0])
        forward[at] = odds
    for i in range(steps - 2, -1, -1):
        at = begin[: live[i + 1]] + i
        right = e[at + 1] * backward[at + 1]
        backward[at] = (t[1, 0] + t[1, 1] * right) / (t[0, 0] + t[0, 1] * right)
    odds = forward * backward
    return odds / (1 + odds)


def _tokens(model: Field, texts: list[bytes | None], cache: dict):
    lists = [x.split() if x else [] for x in texts]
    starts = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=starts[1:])
    if len(cache) > 400_000:
        cache.clear()
    parts = model.emissions([w for x in lists for w in x], cache)
    begin = chains(parts[:, 3] > 0, starts)
    emission = parts[:, 0].copy()
    inner = np.ones(len(emission), bool)
    inner[begin] = False
    at = np.flatnonzero(inner)
    emission[at] += parts[at - 1, 1]
    emission[at - 1] += parts[at, 2]
    return marginals(emission, begin, model.transitions), starts


def _evidence(p: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Largest marginal (as log odds) and expected toxic tokens of each document."""
    out = np.zeros((len(starts) - 1, 2))
    out[:, 0] = np.log(1e-6)
    if len(p):
        q = np.clip(p, 1e-6, 1 - 1e-6)
        full = np.flatnonzero(np.diff(starts))
        out[full, 0] = np.maximum.reduceat(np.log(q / (1 - q)), starts[full])
        out[full, 1] = np.log1p(np.add.reduceat(np.where(q >= 0.05, q, 0.0), starts[full]))
    return out


def _spans(text: str, p: np.ndarray) -> list[tuple[int, int, float]]:
    """Code point offsets of runs of toxic tokens, marks at the ends left out."""
    found: list[list] = []
    last = -2
    for i, m in enumerate(_WORD.finditer(text)):
        if p[i] >= SPAN:
            word = m.group()
            left = len(word) - len(word.lstrip(_STRIP.decode()))
            right = len(word.rstrip(_STRIP.decode()))
            start, end = m.start() + left, m.start() + max(right, left)
            if i == last + 1 and found:
                found[-1][1], found[-1][2] = end, max(found[-1][2], float(p[i]))
            else:
                found.append([start, end, float(p[i])])
            last = i
    return [tuple(x) for x in found]


def _markers(train: DataFrame) -> tuple[set[bytes], float, int]:
    """Marker strings of the training documents, the share of toxic ones and their number."""
    totals = train.agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).first()
    n, toxic = totals["n"], totals["toxic"] or 0.0
    if not 0 < toxic < n:
        return set(), toxic / n if n else 0.0, n

    def listed(batches):
        for part in slices(batches):
            items = [sorted(evidence(x)) for x in part.column("text").to_pylist()]
            label = np.repeat(part.column("label").to_numpy(), [len(x) for x in items])
            yield pa.RecordBatch.from_arrays(
                [pa.array([y for x in items for y in x], pa.binary()), pa.array(label)], ["item", "label"]
            )

    counted = train.mapInArrow(listed, "item binary, label double").groupBy("item").agg(
        F.sum("label").alias("toxic"), F.count("*").alias("all")
    )
    pure = counted.where((F.col("toxic") >= max(5, 0.015 * toxic)) & (F.col("toxic") >= 0.95 * F.col("all")))
    top = pure.orderBy(F.desc("toxic"), "item").limit(MARKERS).collect()
    return {bytes(x["item"]) for x in top}, toxic / n, n


def _is_marked(word: bytes, markers: set[bytes]) -> bool:
    w = plain(word)
    return b"w:" + w in markers or any(len(w) > n and b"%d:" % n + w[:n] in markers for n in (4, 5, 6))


def _sample_chains(train: DataFrame, markers: set[bytes]) -> list[tuple[list[bytes], list[int]]]:
    """At most CHAINS labelled chains: those with toxic tokens and as many others, by hash."""
    shared = train.sparkSession.sparkContext.broadcast(markers)

    def cut(batches):
        for part in slices(batches):
            words, marks, toxic = [], [], []
            for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist()):
                own = (text or b"").split()
                starts = np.array([0, len(own)])
                begin = chains(np.array([w[-1] in _STOPS for w in own], bool), starts) if own else []
                for a, b in zip(begin, [*begin[1:], len(own)]):
                    chain = own[a:b]
                    y = [int(label == 1 and _is_marked(w, shared.value)) for w in chain]
                    if any(y) or hash(int(a) * 7919 + len(own)) % 16 == 0:
                        words.append(b" ".join(chain))
                        marks.append(bytes(y))
                        toxic.append(int(any(y)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(marks, pa.binary()), pa.array(toxic, pa.int32())], ["words", "marks", "toxic"]
            )

    rows = settle(train.mapInArrow(cut, "words binary, marks binary, toxic int"), "toxicity-chains")
    found = []
    for toxic in (1, 0):
        found += rows.where(F.col("toxic") == toxic).orderBy(F.xxhash64("words"), "words").limit(CHAINS // 2).collect()
    return [(bytes(r["words"]).split(), list(bytes(r["marks"]))) for r in found]


def train_field(samples: list[tuple[list[bytes], list[int]]], epochs: int = 60, rate: float = 0.3) -> Field:
    """Likelihood of the labelled chains by AdaGrad steps over all of them, with a small L2 penalty.

    A feature needs three tokens to get a weight.
    """
    names: dict[bytes, int] = {}
    count: list[int] = []
    rows, cols, begin, y, n = [], [], [], [], 0
    for words, marks in samples:
        begin.append(n)
        clean = [plain(w) for w in words]
        for i, w in enumerate(clean):
            keys = [b"w:" + w, b"4:" + w[:4], b"5:" + w[:5], b"6:" + w[:6], b"e:" + w[-3:]]
            if i:
                keys.append(b"p:" + clean[i - 1])
            if i + 1 < len(clean):
                keys.append(b"n:" + clean[i + 1])
            for key in keys:
                at = names.setdefault(key, len(names))
                if at == len(count):
                    count.append(0)
                count[at] += 1
                rows.append(n)
                cols.append(at)
            n += 1
        y += marks
    rows, cols, y, begin = np.array(rows), np.array(cols), np.array(y, float), np.array(begin)
    use = np.array(count)[cols] >= 3
    rows, cols = rows[use], cols[use]
    inner = np.ones(n, bool)
    inner[begin] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[at - 1].astype(int), y[at].astype(int)), 1)
    w, bias, trans = np.zeros(len(names)), -2.0, np.zeros((2, 2))
    g_w, g_b, g_t = np.full(len(names), 1e-8), 1e-8, np.full((2, 2), 1e-8)
    for _ in range(epochs):
        emission = np.bincount(rows, weights=w[cols], minlength=n) + bias
        p = marginals(emission, begin, trans)
        gap = y - p
        d_w = np.bincount(cols, weights=gap[rows], minlength=len(names)) - 0.05 * w
        expected = pair_counts(emission, p, at, trans)
        d_b, d_t = gap.sum(), seen - expected - 0.05 * trans
        g_w += d_w**2
        g_b += d_b**2
        g_t += d_t**2
        w += rate * d_w / np.sqrt(g_w)
        bias += rate * d_b / np.sqrt(g_b)
        trans += rate * d_t / np.sqrt(g_t)
    own = {k: float(w[i]) for k, i in names.items() if abs(w[i]) > 1e-3}
    return Field(own, float(bias), trans)


def pair_counts(emission: np.ndarray, p: np.ndarray, at: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Expected transitions. P(state at i | state at i-1) follows from the marginals of both ends.

    For two states, P(1,1) is the root of the odds-ratio equation of the 2x2 table: the
    odds ratio of neighbours in a chain is that of the transition weights alone.
    """
    a, b = p[at - 1], p[at]
    ratio = np.exp(trans[0, 0] + trans[1, 1] - trans[0, 1] - trans[1, 0])
    if abs(ratio - 1) < 1e-9:
        both = a * b
    else:
        s = 1 + (a + b) * (ratio - 1)
        both = (s - np.sqrt(np.maximum(s * s - 4 * ratio * (ratio - 1) * a * b, 0.0))) / (2 * (ratio - 1))
    both = np.clip(both, np.maximum(0.0, a + b - 1), np.minimum(a, b))
    return np.array([[(1 - a - b + both).sum(), (b - both).sum()], [(a - both).sum(), both.sum()]])


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Newton steps of a logistic curve over two columns, lightly penalised."""
    z = np.column_stack([x[:, 0] / 5, x[:, 1], np.ones(len(x))])
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + np.diag([0.5, 0.5, 0.05])
        w += np.clip(np.linalg.solve(h, z.T @ (y - p) - np.array([0.5, 0.5, 0.05]) * w), -3, 3)
    return float(w[0] / 5), float(w[1]), float(w[2])


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> Field:
    """The field of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    train = settle(labelled(text, labels, "toxic", fit_docs).select("text", "label"), "toxicity-train")
    markers, share, n = _markers(train)
    samples = _sample_chains(train, markers) if markers else []
    if not samples:
        return Field(share=share)
    model = train_field(samples)

    def measure(batches):
        cache: dict = {}
        for part in slices(batches):
            x = _evidence(*_tokens(model, part.column("text").to_pylist(), cache))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[:, 0]), pa.array(x[:, 1]), part.column("label")], ["peak", "mass", "label"]
            )

    seen = train.mapInArrow(measure, "peak double, mass double, label double").toPandas()
    model.curve = _logistic(seen[["peak", "mass"]].to_numpy(), seen["label"].to_numpy())
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """doc_id, held_out, score, predicted, spans: one row for every row of ``docs``.

    ``spans`` lists (start, end, probability) of offending runs in code points.
    """
    m = fit(docs, labels, fit_docs)
    span = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("probability", pa.float64())])

    def run(batches):
        cache: dict = {}
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            if m.share is not None:
                score, spans = np.full(len(texts), m.share), [[] for _ in texts]
            else:
                p, starts = _tokens(m, texts, cache)
                x = _evidence(p, starts)
                score = 1 / (1 + np.exp(-np.clip(x @ np.array(m.curve[:2]) + m.curve[2], -30, 30)))
                spans = [[] for _ in texts]
                for i in np.flatnonzero(x[:, 0] >= 0):
                    spans[i] = _spans(texts[i].decode(), p[starts[i] : starts[i + 1]])
            rows = [[{"start": a, "stop": b, "probability": c} for a, b, c in s] for s in spans]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32)),
                 pa.array(rows, pa.list_(span))],
                ["doc_id", "held_out", "score", "predicted", "spans"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), fold(keep="2").alias("held_out"), F.col("text").cast("binary").alias("text")
    ).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int, "
        "spans array<struct<start:int,stop:int,probability:double>>",
    )
