"""Every registered query against its DuckDB oracle (small scale factor):
same columns, same rows as an order-insensitive multiset, values exact."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from duck_oracle import ORACLE_SQL
from duck_oracle.compare import bag, duckdb_views
from tessera.plans.catalog import QUERIES as CATALOG
from tests.conftest import SF_SMALL

KEYS = sorted(CATALOG)
SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                   "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(CATALOG)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert bag(df.columns, got) == bag(ocols, want)
    otypes = dict(con.execute(f"DESCRIBE {entry.oracle_sql()[key]}").fetchall()[i][:2]
                  for i in range(len(ocols)))
    assert {c: SPARK_TO_DUCKDB.get(t, t) for c, t in df.dtypes} == otypes
