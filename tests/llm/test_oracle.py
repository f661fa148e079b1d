"""The queries that have SQL twins against them, and all of them on the generated tables."""

import os

import pytest

from sessionloom.llm.oracle import ORACLES
from sessionloom.llm.queries import QUERIES

duckdb = pytest.importorskip("duckdb")

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no generated tables")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    found = QUERIES[name](spark, FOLDER).toPandas()
    with duckdb.connect() as database:
        for table in ("documents", "pages"):
            database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        if name not in ORACLES:
            table = "pages" if name == "op3_warc" else "documents"
            assert len(found) == database.execute(f"SELECT count(*) FROM {table}").fetchone()[0]
            return
        expected = database.execute(ORACLES[name]).fetchdf()
    columns = sorted(expected.columns)
    assert sorted(found.columns) == columns

    def plain(frame):
        """Rows as text; whole numbers may come as floats where a column has nulls."""
        values = frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist()
        return sorted(repr([None if x is None else str(x).removesuffix(".0") for x in row]) for row in values)

    assert plain(found) == plain(expected)
