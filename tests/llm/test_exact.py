"""Exact duplicates against brute force: every odd case, weak digests and hot groups."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from murmura.llm import exact

SCHEMA = "doc_id long, text string, row string, keep_id string, Digest string"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], SCHEMA).repartition(parts)


def settled(spark, folder, rows, parts=3):
    docs(spark, rows, parts).write.parquet(f"{folder}/docs")
    return spark.read.parquet(f"{folder}/docs")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(_LOWER)].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        top = max(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        kept = [True] + [False] * (len(ids) - 1)
        for i, k in zip(sorted(ids, key=lambda x: x != top), kept):
            out.append((i, top, len(ids), k, digest))
    return out


def tuples(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


ROWS = (
    [(i, f"text {i % 7} ÄÖ É") for i in range(40)]
    + [(100 + i, f"TEXT {i % 7} ÄÖ É") for i in range(9)]
    + [(200, "äö"), (201, "ÄÖ"), (202, None), (203, ""), (None, None), (None, "only null ids"), (None, "Only null ids")]
    + [(300, "twice"), (300, "twice"), (300, "TWICE"), (299, "twice"), (300, "another text of id 300")]
    + [(400, "x" * 200_000), (401, "X" * 200_000), (402, "x" * 199_999)]
)


@pytest.mark.parametrize("salts", [1, 3, 64])
def test_equals_brute_force(spark, folder, monkeypatch, salts):
    monkeypatch.setattr(exact, "SALTS", salts)
    assert tuples(exact.exact_duplicates(settled(spark, folder, ROWS, 5))) == sorted(brute(ROWS), key=str)


def test_content_decides_where_digests_collide(spark, folder):
    table = settled(spark, folder, ROWS, 4)
    weak = exact.groups(table, digest=lambda text: F.length(text).cast("string"), salts=2)
    found = sorted((r["id"], r["keep_id"], r["size"], r["row"] == r["keep_row"]) for r in weak.collect() if r["id"])
    assert found == sorted(r[:4] for r in brute(ROWS) if r[0])
    assert weak.count() == len(ROWS)


def test_one_text_in_a_third_of_all_rows(spark, folder):
    rng = random.Random(3)
    rows = [(i, "the same everywhere" if i % 3 == 0 else f"{rng.random()}") for i in range(3000)]
    found = exact.exact_duplicates(settled(spark, folder, rows, 12)).where("group_size > 1").collect()
    assert len(found) == 1000
    assert [r["doc_id"] for r in found if r["kept"]] == [2997] and {r["keep_id"] for r in found} == {2997}


def test_a_hot_text_is_one_row_a_task_then_one_row_a_salt(spark):
    rows = spark.range(6000, numPartitions=30).selectExpr(
        "'d' AS digest", "'same' AS content", "id AS row", "id"
    )
    plan = exact.combined(rows, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortAggregate") == 0 and plan.count("Exchange hashpartitioning") == 2
    assert exact.combined(rows, 4).collect()[0].asDict() == {
        "digest": "d", "content": "same", "keep_row": 5999, "keep_id": 5999, "size": 6000
    }


def test_no_python_on_the_main_path(spark, folder):
    table = settled(spark, folder, ROWS)
    plan = exact.exact_duplicates(table)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_keep_one_keeps_rows_and_columns(spark, folder):
    table = settled(spark, folder, ROWS)
    kept = exact.keep_one(table)
    assert kept.columns == table.columns
    texts = [(r["text"] or "").translate(_LOWER) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({(t or "").translate(_LOWER) for _, t in ROWS})


def test_no_documents(spark, folder):
    table = settled(spark, folder, [])
    assert exact.exact_duplicates(table).collect() == [] and exact.keep_one(table).collect() == []
