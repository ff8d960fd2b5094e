"""Periodic runs against brute force over all periods."""

import hashlib
import random
import time
import zlib

from murmura.llm import runs
from murmura.llm.common import hash_words

SCHEMA = "doc_id long, text string, start string, n_runs string, Period string"


def docs(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], SCHEMA).repartition(parts)


def brute(words):
    """Stretches of equal words at every distance; of one stretch the smallest period counts."""
    found, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(24, 3 * q):
                found.setdefault((start, length), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def hidden(rng, alphabet, n):
    """Random words with periodic stretches, some nested or side by side."""
    words = [rng.randrange(alphabet) for _ in range(n)]
    for _ in range(rng.randrange(3)):
        unit = [rng.randrange(alphabet) for _ in range(rng.randrange(1, 14))] * rng.randrange(2, 9)
        if rng.random() < 0.3:
            unit = (unit + [rng.randrange(alphabet)]) * 3
        if rng.random() < 0.3:
            unit = unit[: -rng.randrange(1, len(unit))]
        place = rng.randrange(n + 1)
        words[place:place] = unit
    return words


def as_bytes(words):
    return [b"w%d" % w for w in words]


def test_automaton_equals_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        words = hidden(rng, rng.choice([1, 2, 3, 6, 40]), rng.randrange(110))
        assert runs.runs(words) == brute(words), words


def test_stretches_lose_no_run():
    rng = random.Random(2)
    for _ in range(800):
        words = as_bytes(hidden(rng, rng.choice([1, 2, 4, 60]), rng.randrange(300)))
        assert runs.find_runs(words, hash_words([words])[0]) == brute(words)


def test_text_without_repeats_needs_no_automaton():
    words = as_bytes(range(50_000))
    assert runs.stretches(hash_words([words])[0]) == []


def test_long_runs_take_time_in_proportion():
    def seconds(n, period):
        words = [i % period for i in range(n)]
        start = time.process_time()
        assert runs.runs(words) == [(0, n, period)]
        return (time.process_time() - start) / n

    for period in (1, 5, 9_000):
        assert seconds(80_000, period) < 6 * max(seconds(20_000, min(period, 4_000)), 2e-6)


def test_damage_is_the_contract_s():
    words = as_bytes(range(40))
    for doc_id in range(400):
        h = zlib.crc32(str(doc_id).encode())
        found = runs.damaged(words, doc_id)
        if h % 10:
            assert found == words
        else:
            a, g = (h // 10) % 40, h // 10
            p = 1 + (40 - a) // (3 + g % 8)
            assert found == [words[i] if i < a else words[a + (i - a) % p] for i in range(40)]
    assert runs.damaged([], 0) == [] and runs.damaged(words, None) == words


def expected(rows, damage=True):
    out = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        words = runs.damaged(words, doc_id) if damage else words
        found = brute(words)
        best = sorted(found, key=lambda r: (-r[1] / r[2], r[0], r[2]))[:1]
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        rest = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((
            doc_id, len(found), *(best[0] if best else (None,) * 3), 1000 * best[0][1] // best[0][2] if best else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(rest).hexdigest(),
        ))
    return sorted(out, key=str)


def cases():
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{w}" for w in hidden(rng, rng.choice([2, 5, 200]), rng.randrange(150)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \n\t "), (None, "a b " * 30), (None, None), (203, "ha " * 23), (204, "ha " * 24)]
    rows += [(205, "tie tie " * 12 + "x " + "tie tie " * 12), (205, "tie tie " * 12 + "x " + "tie tie " * 12)]
    rows += [(206, "é ü ß " * 40), (207, " ".join(f"p{i % 700}" for i in range(2400)))]
    return rows


def test_report_of_every_odd_case(spark):
    rows = cases()
    assert sorted(map(tuple, runs.report(docs(spark, rows), damage=True).collect()), key=str) == expected(rows)
    assert sorted(map(tuple, runs.report(docs(spark, rows)).collect()), key=str) == expected(rows, damage=False)


def test_spans_and_collapsed_texts(spark):
    table = docs(spark, [(1, "a b c d " * 10 + "end"), (2, "nothing here"), (3, None)])
    found = [tuple(r) for r in runs.periodic_runs(table).collect()]
    assert found == [(1, 0, 40, 4, "a b c d")]
    texts = {r["doc_id"]: r["text"] for r in runs.collapse(table).collect()}
    assert texts == {1: "a b c d end", 2: "nothing here", 3: ""}


def test_no_documents(spark):
    assert runs.report(docs(spark, [])).collect() == [] and runs.periodic_runs(docs(spark, [])).collect() == []
