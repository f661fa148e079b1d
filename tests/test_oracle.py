"""Every registered query against its SQL twin on the generated tables."""

import os

import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from sessionloom.checks.oracle import ORACLES
from sessionloom.checks.queries import QUERIES

duckdb = pytest.importorskip("duckdb")

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no generated tables")

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def comparable(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(
        tuple(
            "null" if pd.isna(value) else f"{value:.9g}" if isinstance(value, float) else str(value)
            for value in row
        )
        for row in frame.itertuples(index=False, name=None)
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    found = QUERIES[name](spark, FOLDER).toPandas()
    # As a view, which is how a twin is kept beside the tables; not every statement can be one.
    database.execute(f"CREATE OR REPLACE VIEW twin AS {ORACLES[name]}")
    expected = database.execute("SELECT * FROM twin").fetchdf()
    assert sorted(found.columns) == sorted(expected.columns)
    assert comparable(found) == comparable(expected)


def test_every_oracle_has_a_query():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_sorted_rows_come_in_order(spark):
    rows = [tuple(row) for row in QUERIES["srt_sort"](spark, FOLDER).collect()]
    assert rows and [r[0] for r in rows] == sorted(r[0] for r in rows)


def test_entry(spark):
    assert entry(spark).count() > 0
