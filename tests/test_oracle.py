"""Every registered batch query equals its DuckDB oracle at sf0.001
(row count, column names, order-insensitive values)."""

import math

import duckdb
import pytest

import __spark_entry__ as se
from kpiflow.plans.catalog import BATCH_QUERIES

TABLES = ["events"]


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_query_matches_oracle(spark, duck, sf_small, name):
    df = se.queries()[name](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    sql = se.oracle_sql()[name]
    rel = duck.execute(sql)
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {sql}").fetchall()}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == duck_types
    assert len(rows) == len(orows)
    assert _rows(df.columns, rows) == _rows(ocols, orows)


def test_every_query_has_an_oracle():
    from kpiflow.plans import catalog, oracle

    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(se.queries()) and set(oracle.oracle_sql()) <= set(se.oracle_sql())


@pytest.mark.parametrize("name", ["approx_sessions", "alerts_stream_live", "drift_stream_live", "campaign_stream_live"])
def test_streaming_flavours_match(spark, duck, sf_small, name):
    test_query_matches_oracle(spark, duck, sf_small, name)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert "conversion_rate" in df.columns
