"""The registered queries against their SQL in DuckDB, on the smallest tables."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry_point
from checks import queries as registry

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["documents", "events", "conversations"]
COMPARED = [
    "process_messages", "keyword_filter", "latest_by_id", "sentiment_scores",
    "sentiment_scores_joined", "summary_stats", "dashboard_dataset",
]


def test_every_query_has_its_sql():
    own = set(registry.queries())
    assert own <= set(entry_point.queries()) and own <= set(entry_point.oracle_sql())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_queries_are_listed_without_a_session():
    """In a process of its own: no session is active there."""
    code = "import __spark_entry__ as e; assert set(e.queries()) >= set(e.oracle_sql())"
    root = os.path.dirname(os.path.abspath(entry_point.__file__))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_its_sql(spark, duck, name):
    mine = entry_point.queries()[name](spark, SF_DIR)
    theirs = duck.execute(entry_point.oracle_sql()[name])
    columns = [c[0] for c in theirs.description]
    assert sorted(mine.columns) == sorted(columns)
    rows = sorted(map(repr, (tuple(r) for r in mine.select(columns).collect())))
    assert rows and rows == sorted(map(repr, theirs.fetchall()))
