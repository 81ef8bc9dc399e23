"""Every registered query gives the rows of its SQL, run by DuckDB on the same tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point

TABLES = Path(os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001"))
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()
OWN = sorted(set(QUERIES) - set(entry_point.TEXT_QUERIES))

# Spark type -> DuckDB type
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(TABLES.glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def in_order(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, duck, name):
    assert name in ORACLES
    got = QUERIES[name](spark, str(TABLES))
    columns = sorted(got.columns)
    result = duck.execute(ORACLES[name])
    want_types = {d[0]: str(d[1]) for d in result.description}
    want_rows = result.fetchall()
    assert columns == sorted(want_types)
    assert {c: TYPES[t] for c, t in got.dtypes} == want_types
    order = [list(want_types).index(c) for c in columns]
    want = in_order([tuple(r[i] for i in order) for r in want_rows])
    have = in_order([tuple(r) for r in got.select(*columns).collect()])
    assert len(have) == len(want) and len(have) > 0
    for h, w in zip(have, want):
        assert h == w or all(a == b or (isinstance(a, float) and math.isnan(a) and math.isnan(b)) for a, b in zip(h, w))


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
