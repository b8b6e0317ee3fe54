"""Every catalogue query against its DuckDB SQL twin on sf0.001 (row count,
column names, order-insensitive value hash)."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from casebook.catalog import QUERIES
from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import TABLES, _digest  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_sql():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(sdf.columns, srows)[0] == _digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_id", "plan_id", "payment_date", "amount_paid"]
    assert df.count() > 0


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_types_match_oracle(spark, con, name):
    """Column types agree too (decimals with the same precision and scale)."""
    sdf = QUERIES[name](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in sdf.schema.fields:
        t = f.dataType.simpleString()
        assert duck[f.name] == SPARK_TO_DUCK.get(t, t.upper()), (f.name, t, duck[f.name])
