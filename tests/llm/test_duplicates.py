"""Near-duplicate documents, near-duplicate vectors and repeated passages against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmura.llm import embeddings, minhash, substrings
from murmura.llm.common import components

SCHEMA = "doc_id long, text string, lang string, rep string, component string"


def named(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "xx", "clash", "clash") for i, t in zip(ids, texts)], SCHEMA)


def words(random_, n, vocabulary=5000):
    return [f"w{random_.randrange(vocabulary)}" for _ in range(n)]


def edited(random_, base, n):
    out = list(base)
    for i in random_.sample(range(len(out)), n):
        out[i] = f"x{random_.randrange(10**9)}"
    return out


def shingles(text):
    own = [w.decode() for w in (text or "").encode().lower().split()]
    if len(own) < 5:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}


def reachable(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def brute_components(texts):
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    linked = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    return reachable(sets, linked), {i: len(s) for i, s in sets.items()}


def corpus():
    r = random.Random(4)
    texts = [None, "", " \n\t", "a b", "A  B", "one two three four five", "ONE two three four FIVE", "É a b c d e", "é a b c d e"]
    for _ in range(6):
        base = words(r, 300)
        texts += [" ".join(base)] * 3 + [" ".join(edited(r, base, n)) for n in (1, 2, 3, 4, 5, 6, 8, 12, 30)]
    hub = words(r, 200)
    texts += [" ".join(edited(r, hub, r.randrange(1, 8))) for _ in range(60)]  # a group that is not all linked
    texts.append(" ".join(words(r, 30_000)))
    return texts


def test_components_equal_brute_force(spark):
    texts = corpus()
    expected, sizes = brute_components(texts)
    got = {r.doc_id: r for r in minhash.near_duplicates(named(spark, texts)).collect()}
    assert len(got) == len(texts)
    assert {i: r.n_shingles for i, r in got.items()} == sizes
    assert {i: r.component_id for i, r in got.items()} == expected
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    texts = corpus()
    monkeypatch.setattr(minhash, "SMALL", 1)
    monkeypatch.setattr(minhash, "BLOCK", 5)
    got = minhash.near_duplicates(named(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(texts)[0]


def test_near_duplicates_of_odd_rows(spark):
    text = "a b c d e f g h"
    df = named(spark, [text, text, None, text, "z"], [None, 5, 6, 5, 7])
    got = sorted(minhash.near_duplicates(df).collect(), key=str)
    assert [(r.doc_id, r.component_id, r.kept) for r in got if r.doc_id == 5] == [(5, 5, True)] * 2
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert [(r.n_shingles, r.kept) for r in got if r.doc_id == 6] == [(0, True)]
    assert minhash.near_duplicates(df.limit(0)).collect() == []


def test_keep_one_keeps_columns_and_the_first(spark):
    text = "a b c d e f g h"
    df = named(spark, [text, text.upper(), "other words are here now"]).withColumn("_gone", F.lit(1))
    got = minhash.keep_one(df)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == [0, 2]


def test_rows_that_repeat_a_doc_id_keep_their_own_links(spark):
    r = random.Random(11)
    a, b = words(r, 200), words(r, 200)
    near_a, near_b = edited(r, a, 1), edited(r, b, 1)
    texts = [" ".join(x) for x in (a, b, near_a, near_b, b)]
    df = named(spark, texts, [5, 5, 3, 9, 5])
    got = sorted((x.doc_id, x.component_id, x.kept) for x in minhash.near_duplicates(df).collect())
    assert got == [(3, 3, True), (5, 3, False), (5, 5, True), (5, 5, True), (9, 5, False)]
    kept = sorted((x.doc_id, x.text) for x in minhash.keep_one(df).collect())
    assert kept == sorted([(3, texts[2]), (5, texts[1]), (5, texts[1])])


def test_large_buckets_keep_repeated_doc_ids_apart(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", 1)
    monkeypatch.setattr(minhash, "BLOCK", 5)
    texts = corpus()
    ids = [i % 7 for i in range(len(texts))]
    group = brute_components(texts)[0]
    low = {}
    for i, c in group.items():
        low[c] = min(low.get(c, 99), ids[i])
    expected = sorted((ids[i], low[c] if shingles(texts[i]) else ids[i]) for i, c in group.items())
    got = minhash.near_duplicates(named(spark, texts, ids)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == expected


def test_signatures_estimate_similarity():
    r = np.random.default_rng(0)
    a = np.unique(r.integers(0, 2**63, 2000).astype(np.uint64))
    b = np.unique(np.concatenate([a[:1400], r.integers(0, 2**63, 600).astype(np.uint64)]))
    both = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    s = minhash.signatures([a, b], 2000)
    assert abs((s[0] == s[1]).mean() - both) < 0.04


def test_intersections_in_chunks():
    r = random.Random(1)
    sets = [np.array(sorted(r.sample(range(60), r.randrange(0, 30))), np.uint64) for _ in range(12)]
    got = minhash.intersections(sets[:5], sets[5:], width=7)
    assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[5:]] for a in sets[:5]]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 102), (102, 101), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components(edges.limit(0)).collect() == []


def brute_removed(rows):
    seen, out = {}, []
    for doc, text in sorted(rows, key=lambda r: r[0]):
        own = (text or "").encode().split()
        gone = [False] * len(own)
        for p in range(len(own) - 19):
            key = tuple(own[p : p + 20])
            if seen.setdefault(key, (doc, p)) != (doc, p):
                gone[p : p + 20] = [True] * 20
        kept = b" ".join(w for w, g in zip(own, gone) if not g)
        out.append((doc, len(own), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_repeated_passages_equal_brute_force(spark):
    r = random.Random(7)
    passage, line = words(r, 60), words(r, 19)
    texts = [None, "", "one"]
    for i in range(40):
        own = words(r, r.randrange(0, 150), 40 if i % 9 == 0 else 5000)
        at = r.randrange(len(own) + 1)
        texts.append(" ".join(own[:at] + passage[i % 30 :] + own[at:] + line + own[:25]))
    texts += [" ".join(passage), " ".join(passage), " ".join(["is"] * 70), "is " * 25]
    got = substrings.dedup(named(spark, texts), bucket_bytes=500).collect()
    assert sorted(map(tuple, got)) == brute_removed(list(enumerate(texts)))


def test_repeated_passages_of_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    got = substrings.dedup(named(spark, [text, text, text], [3, 3, None]), with_text=True).collect()
    assert [(r.n_removed, r.kept_text) for r in got if r.doc_id == 3] == [(0, text)] * 2
    assert [(r.n_removed, r.kept_text) for r in got if r.doc_id is None] == [(30, "")]
    assert substrings.dedup(named(spark, [])).collect() == []


def test_rows_without_or_with_a_repeated_doc_id_lose_only_their_own_repeats(spark):
    r = random.Random(23)
    passage = words(r, 60)
    texts = [" ".join(words(r, 15) + passage + words(r, 15)) for _ in range(2)] + [" ".join(words(r, 90)) for _ in range(2)]
    for ids in ([None] * 4, [7] * 4, [7, None, 7, None]):
        got = substrings.dedup(named(spark, texts + texts[:1], ids + ids[:1]), with_text=True).collect()
        kept = {x.kept_text for x in got}
        assert texts[2] in kept and texts[3] in kept
        # the first of the two keeps the passage, the other one loses it and nothing else
        lost = [x for x in got if x.n_removed]
        assert {x.n_removed for x in lost} == {60} and len({x.kept_text for x in lost}) == 1
        assert len(kept & set(texts)) == 3


def test_blocks_of_any_size_remove_alike(spark):
    r = random.Random(29)
    passage = words(r, 40)
    texts = [" ".join(words(r, 30) + passage[i % 15 :] + words(r, 30)) for i in range(30)]
    expected = brute_removed(list(enumerate(texts)))
    for packed in (1, 200, 10**6):
        assert sorted(map(tuple, substrings.dedup(named(spark, texts), packed=packed).collect())) == expected


def test_cover_reaches_every_shift():
    for i in range(substrings.PERIOD):
        for j in range(substrings.PERIOD):
            assert any(
                (i + k) % substrings.PERIOD in substrings.COVER and (j + k) % substrings.PERIOD in substrings.COVER
                for k in range(substrings.PERIOD)
            )
    assert substrings.PERIOD - 1 + substrings.BLOCK == substrings.WINDOW


def vectors(spark):
    r = np.random.default_rng(3)
    base = r.normal(size=(12, 16))
    rows = [base[i % 12] + r.normal(size=16) * s for i, s in enumerate(np.repeat([0.0, 0.05, 0.3, 0.5, 0.6], 24))]
    rows += [base[0]] * 30 + [base[1] * 7] + list(r.normal(size=(40, 16)))
    data = [(i, [float(np.float32(x)) for x in v], 0, "x") for i, v in enumerate(rows)]
    n = len(data)
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [1.0, 2.0]]
    data += [(n + i, v, 0, "x") for i, v in enumerate(odd)] + [(None, rows[0].tolist(), 0, "x")]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>, rep int, digest string"), n


@pytest.mark.parametrize("settings", [{}, {"tile": 20}, {"tile": 15, "leaves": 16}])
def test_vectors_equal_brute_force(spark, settings):
    df, n = vectors(spark)
    x = np.array([r.embedding for r in df.where(F.col("vec_id") < n).orderBy("vec_id").collect()])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = u @ u.T >= 0.9
    np.fill_diagonal(hit, False)
    expected = reachable(range(n), np.argwhere(hit).tolist())
    got = {r.vec_id: r for r in embeddings.near_duplicates(df, **settings).collect()}
    assert len(got) == df.count()
    assert {i: got[i].n_links for i in range(n)} == dict(enumerate(hit.sum(axis=1).tolist()))
    assert {i: got[i].component_id for i in range(n)} == expected
    for i in range(n, n + 7):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, True)


def test_no_vectors(spark):
    df, _ = vectors(spark)
    assert embeddings.near_duplicates(df.limit(0)).collect() == []


def test_vectors_of_every_length_are_compared(spark):
    """Two lengths of equal frequency and one rare pair of equal vectors."""
    r = np.random.default_rng(5)
    data, n = [], 0
    for size, count in ((6, 30), (9, 30), (2, 1)):
        base = r.normal(size=(max(count // 3, 1), size))
        for v in (base, base + r.normal(size=base.shape) * 0.1, base * 3):
            data += [(n + i, x.tolist()) for i, x in enumerate(v)]
            n += len(v)
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    hit = np.zeros((n, n), bool)
    for i, v in data:
        for j, w in data:
            if i != j and len(v) == len(w):
                hit[i, j] = np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.9
    got = {x.vec_id: x for x in embeddings.near_duplicates(df, tile=8).collect()}
    assert [got[i].n_links for i in range(n)] == hit.sum(axis=1).tolist()
    assert {i: got[i].component_id for i in range(n)} == reachable(range(n), np.argwhere(hit).tolist())


def test_rows_that_repeat_a_vec_id_do_not_join_their_groups(spark):
    one, other = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    data = [(5, one), (5, other), (3, [1.0, 0.01, 0.0]), (9, [0.01, 1.0, 0.0]), (7, other), (None, one)]
    got = embeddings.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()
    rows = sorted(((r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id is not None))
    assert rows == [(3, 1, 3), (5, 1, 3), (5, 2, 5), (7, 2, 5), (9, 2, 5)]
