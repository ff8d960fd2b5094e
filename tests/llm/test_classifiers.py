"""Toxicity and quality: parts against brute force, models on planted labels, and odd rows."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmura.llm import quality, toxicity


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


# parts


def test_marginals_equal_enumeration():
    r = np.random.default_rng(0)
    lengths = [1, 2, 5, 3, 1, 4]
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    emission, trans = r.normal(size=sum(lengths)), r.normal(size=(2, 2))
    got = toxicity.marginals(emission, begin, trans)
    at = np.setdiff1d(np.arange(sum(lengths)), begin)
    pairs = np.zeros((2, 2))
    for b, n in zip(begin, lengths):
        total, one = 0.0, np.zeros(n)
        here = np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(emission[b + i] * y[i] for i in range(n)) + sum(trans[y[i], y[i + 1]] for i in range(n - 1)))
            total += w
            one += w * np.array(y)
            for i in range(n - 1):
                here[y[i], y[i + 1]] += w
        assert np.allclose(got[b : b + n], one / total)
        pairs += here / total
    assert np.allclose(toxicity.pair_counts(emission, got, at, trans), pairs)


def test_chains_end_at_stops_documents_and_length():
    stops = np.zeros(400, bool)
    stops[[4, 9]] = True
    assert toxicity.chains(stops, np.array([0, 7, 7, 400])).tolist() == [0, 5, 7, 10, 138, 266, 394]
    assert toxicity.chains(np.zeros(0, bool), np.array([0, 0])).tolist() == []


def test_spans_count_code_points():
    text = "é 😀 you  *idiot* moron!! fine"
    assert toxicity._spans(text, np.array([0, 0, 0, 0.9, 0.8, 0.1])) == [(10, 22, 0.9)]


def test_isotonic_equals_the_best_monotone_fit():
    r = np.random.default_rng(1)
    counts = r.integers(1, 9, 30).astype(float)
    positives = np.floor(counts * r.random(30))
    got = quality.isotonic(positives, counts)
    rates = positives / counts
    best = [
        max(min((positives[a : b + 1].sum() / counts[a : b + 1].sum()) for b in range(i, 30)) for a in range(i + 1)) for i in range(30)
    ]
    assert np.allclose(got, best) and (np.diff(got) >= -1e-12).all() and not np.allclose(got, rates)


def test_features_approximate_the_kernel():
    r = np.random.default_rng(2)
    n, d = 20_000, quality.STATISTICS
    w = r.normal(size=(d, n)) / np.sqrt(d / 2)
    p = r.uniform(0, 2 * np.pi, n)
    x = r.normal(size=(2, d)) * 0.5
    z = np.cos(x @ w + p) * np.sqrt(2 / n)
    assert abs(z[0] @ z[1] - np.exp(-((x[0] - x[1]) ** 2).sum() / d)) < 0.03


@pytest.mark.parametrize("text", [None, b"", b" \n", b"a", b"a b", "é\n\n".encode(), b"x " * 50_000, b"x" * 100_000, b"\n.\n"])
def test_statistics_of_any_text(text):
    x = quality.statistics(text)
    assert x.shape == (quality.STATISTICS,) and np.isfinite(x).all()


# models


def documents(spark, n=1200):
    r = random.Random(5)
    plain = [f"{a}{b}{c}" for a in ("ta", "lo", "mi", "ru") for b in ("ne", "pa", "si") for c in ("l", "r", "n", "st", "k")]
    bad = ["grumb", "grumbler", "grumbling", "snarf", "zogwort"]
    docs, labels = [], []
    for i in range(n):
        words = [r.choice(plain) for _ in range(r.randrange(20, 90))]
        toxic, good = r.random() < 0.2, r.random() < 0.7
        if toxic:
            for _ in range(r.randrange(1, 4)):
                words[r.randrange(len(words))] = r.choice(bad)
        for k in range(6, len(words), 7):
            words[k] += "."
        text = " ".join(words) if good else " ".join(w.upper() + "!!" for w in words) if i % 2 else " ".join(words[:3] * 30)
        docs.append((i, text, "xx", "clash", 1))
        if i % 3:
            labels.append((i, int(good), int(toxic)))
    docs += [(n, None, None, None, None), (n + 1, "", "", "", 0), (None, "tanel", "xx", "s", 5), (0, docs[0][1], "xx", "clash", 1)]
    docs.append((n + 2, "tanel lopar " * 20_000 + "grumb", "xx", "s", 9))
    labels += [(1, 1, None), (1, None, 0), (None, 1, 1), (n + 9, 0, 1)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, stats string, label int"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        {i: t for i, _, t in labels[: n - n // 3 - 1]}, {i: q for i, q, _ in labels[: n - n // 3 - 1]},
    )


@pytest.mark.parametrize("kind", ["toxic", "quality"])
def test_held_out_rows(spark, kind):
    docs, labels, toxic, good = documents(spark)
    score = toxicity.score_toxicity if kind == "toxic" else quality.score_quality
    truth, threshold = (toxic, 0.3) if kind == "toxic" else (good, 0.7)
    rows = score(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (r.doc_id is not None and held_out(r.doc_id)) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in rows)
    own = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in own) >= 0.95 * len(own)
    assert len({r.score for r in rows if r.doc_id == 0}) == 1
    if kind == "toxic":
        texts = {r.doc_id: r.text for r in docs.collect()}
        found = {texts[r.doc_id][s.start : s.stop].lower() for r in rows if r.doc_id != 1202 for s in r.spans}
        assert found and all(any(x.startswith(("grum", "snar", "zogw")) for x in f.split()) for f in found)
        assert next(r for r in rows if r.doc_id == 1202).predicted == 1


def test_without_labels_or_rows(spark):
    docs, labels, _, _ = documents(spark, 40)
    none, one = labels.limit(0), labels.withColumns({"toxic": F.lit(1), "quality": F.lit(1)})
    assert {r.score for r in toxicity.score_toxicity(docs, none).collect()} == {0.0}
    assert {r.score for r in quality.score_quality(docs, none).collect()} == {0.5}
    assert {r.score for r in toxicity.score_toxicity(docs, one).collect()} == {1.0}
    assert {r.score for r in quality.score_quality(docs, one).collect()} == {1.0}
    assert toxicity.score_toxicity(docs.limit(0), labels).collect() == []
    assert quality.score_quality(docs.limit(0), labels).collect() == []


def test_a_bounded_sample_is_enough(spark):
    docs, labels, _, good = documents(spark)
    rows = quality.score_quality(docs, labels, rows=400).collect()
    own = [r for r in rows if r.held_out and r.doc_id in good]
    assert sum(r.predicted == good[r.doc_id] for r in own) >= 0.9 * len(own)


def test_keep_good_keeps_columns(spark):
    docs, labels, _, good = documents(spark)
    docs = docs.withColumn("_text", F.lit(1))
    kept = quality.keep_good(docs, labels)
    assert kept.schema == docs.schema
    ids = {r.doc_id for r in kept.collect()}
    right = [(i in ids) == bool(g) for i, g in good.items()]
    assert sum(right) >= 0.95 * len(right)
