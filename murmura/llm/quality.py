"""Quality score of documents: random Fourier features, ridge regression, isotonic calibration.

Each text becomes a vector of statistics (lengths, shares of character kinds, repetition). Cosines of
random projections of the standardized vector approximate a Gaussian kernel; ridge weights solve the
normal equations, whose sums come from the partitions. Documents whose crc32(doc_id) mod 4 is 0 or 1
fit the weights, those of 3 fit the isotonic calibration (pool adjacent violators over 2,000 score
bins), those of 2 are held out. Only the text enters a score.

Cases: a null text counts as empty; empty texts are scored like any other. A null doc_id is never in
training and not held out. Repeated labels are averaged, null labels skipped; without any label, or with
one class only, the score is that class's share (0.5 without labels). Repeated rows repeat their score.
Other columns are ignored. No documents give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import fold, fresh, labelled, settle, slices, summed

#: Labelled documents that training reads at most.
FIT_ROWS = 200_000
FEATURES, RIDGE, SEED = 320, 1e-3, 7
THRESHOLD = 0.7
BINS, LOW, HIGH = 2000, -0.5, 1.5

_KINDS = np.zeros(256, np.int64)  # byte kinds: 0 other symbols, 1 lower, 2 upper, 3 digit, 4 blank, 5 line feed, 6 stop, 7 marks, 8 high
for _c in range(256):
    _t = chr(_c)
    _KINDS[_c] = (
        8 if _c > 127 else 1 if "a" <= _t <= "z" else 2 if "A" <= _t <= "Z" else 3 if _t.isdigit() else 5 if _t == "\n"
        else 4 if _t.isspace() else 6 if _t in ".,;:'\"-()" else 7 if _t in "!?" else 0
    )


def statistics(text: bytes | None) -> np.ndarray:
    """The statistics of one text; all zero when it has no words."""
    words = (text or b"").split()
    if not words:
        return np.zeros(STATISTICS)
    n = len(words)
    bytes_ = np.frombuffer(text, np.uint8)
    counts = np.bincount(bytes_, minlength=256)
    kinds = np.bincount(_KINDS, weights=counts, minlength=9)
    solid = len(text) - kinds[4] - kinds[5]
    share = counts[counts > 0] / len(text)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    triples = len(set(zip(words, words[1:], words[2:]))) / (n - 2) if n > 2 else 1.0
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = kinds[1] + kinds[2] + kinds[8]
    stops = text.count(b".") + text.count(b"!") + text.count(b"?")
    return np.array([
        np.log1p(n), np.log1p(len(text)), solid / n, kinds[0] / solid, kinds[2] / max(letters, 1), kinds[3] / solid,
        kinds[6] / solid, kinds[7] / solid, kinds[8] / solid, len(seen) / n, max(seen.values()) / n, triples,
        len(set(lines)) / len(lines), np.log1p(len(lines)), np.log1p(n / max(stops, 1)), -(share * np.log(share)).sum(),
        sum(1 for w in seen if len(w) == 1) / len(seen), np.log1p(max(map(len, seen))), counts[124] / solid,
        (len(seen) / np.sqrt(n)),
    ])


STATISTICS = 20


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lift(x) @ self.weights

    def lift(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        z = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / FEATURES)
        return np.hstack([z, np.ones((len(z), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0.0, 1.0)


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and its packed ``stats``, one row for every row of ``docs``."""

    def run(batches):
        for part in slices(batches):
            stats = [statistics(x).tobytes() for x in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(stats, pa.binary())], ["doc_id", "stats"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, stats binary"
    )


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("stats").to_pylist())).reshape(-1, STATISTICS)


def isotonic(positives: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the non-decreasing rates closest to ``positives / counts``."""
    blocks: list[list[float]] = []
    for p, c in zip(positives, counts):
        blocks.append([p, c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p2, c2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + p2, blocks[-1][1] + c2, blocks[-1][2] + n2]
    return np.concatenate([np.full(int(n), p / c) for p, c, n in blocks]) if blocks else np.empty(0)


def fit(stats: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """The model of ``stats`` (with_statistics) and ``labels`` (doc_id, quality)."""
    train = settle(labelled(stats, labels, "quality", rows).select(
        "stats", "label", fold(keep="3").alias("calibrates")).repartition(16), "quality-train")
    fits, other = train.where(~F.col("calibrates")), train.where("calibrates")

    def moments(batch):
        x, y = _matrix(batch), batch.column("label").to_numpy()
        return np.concatenate([[len(x), y.sum()], x.sum(0), (x * x).sum(0)])

    total = summed(fits, moments, 2 + 2 * STATISTICS)
    n, positive = total[:2]
    random = np.random.default_rng(SEED)
    directions = random.normal(size=(STATISTICS, FEATURES)) / np.sqrt(STATISTICS / 2)
    phases = random.uniform(0, 2 * np.pi, FEATURES)
    mean = total[2 : 2 + STATISTICS] / max(n, 1)
    scale = np.sqrt(np.maximum(total[2 + STATISTICS :] / max(n, 1) - mean**2, 1e-12))
    scale[scale < 1e-5] = 1.0
    share = positive / n if n else 0.5
    blank = Model(mean, scale, directions, phases, np.zeros(FEATURES + 1), np.array([0.0]), np.array([share]))
    if not 0 < positive < n:
        return blank

    def normal(batch):
        z, y = blank.lift(_matrix(batch)), batch.column("label").to_numpy()
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    size = FEATURES + 1
    total = summed(fits, normal, size * size + size)
    gram, right = total[: size * size].reshape(size, size), total[size * size :]
    penalty = np.full(size, RIDGE * n / FEATURES)
    penalty[-1] = 0.0
    weights = np.linalg.solve(gram + np.diag(penalty), right)
    ridge = Model(mean, scale, directions, phases, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def histogram(batch):
        y = batch.column("label").to_numpy()
        at = np.clip(((ridge.raw(_matrix(batch)) - LOW) / (HIGH - LOW) * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)])

    total = summed(other, histogram, 2 * BINS)
    counts, positives = total[:BINS], total[BINS:]
    used = counts > 0
    if not 0 < positives.sum() < counts.sum():
        return ridge
    knots = LOW + (np.flatnonzero(used) + 0.5) * (HIGH - LOW) / BINS
    return Model(mean, scale, directions, phases, weights, knots, isotonic(positives[used], counts[used]))


def score_quality(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for every row of ``docs``."""
    stats = settle(with_statistics(docs), "quality-statistics")
    model = fit(stats, labels, rows)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(model.score(_matrix(batch)))],
                    ["doc_id", "held_out", "score"],
                )

    scored = stats.withColumn("held_out", fold(keep="2")).mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` whose text the classifier accepts; same columns.

    The text alone decides, so equal texts share their fate.
    """
    model = fit(settle(with_statistics(docs), "quality-statistics"), labels, rows)
    names, own = docs.columns, fresh(docs, "_text")

    def run(batches):
        for part in slices(batches, own):
            x = np.vstack([statistics(t) for t in part.column(own).to_pylist()])
            keep = pa.array(model.score(x) >= THRESHOLD)
            yield part.select(names).filter(keep)

    return docs.withColumn(own, F.col("text").cast("binary")).mapInArrow(run, docs.schema)
