"""Every registered query against its SQL, on the smallest driver tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import table

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path)[:-8]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = db.execute(entry.oracle_sql()[name])
    expected = table([d[0] for d in cursor.description], cursor.fetchall())
    assert table(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_queries_without_sql_are_only_the_trained_ones():
    own = set(entry.queries()) - set(entry.LLM_QUERIES)
    assert own - set(entry.oracle_sql()) == {"train_metrics", "score_latest"}
