"""Every registered query against its DuckDB oracle (as the driver checks), at sf0.001."""
import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from paths import SF_SMALL
from lakebank.sources.tables import DRIVER_TABLES

ORACLE = E.oracle_sql()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, (float, decimal.Decimal)):
        return "%.9g" % float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_is_registered_with_entry(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["fecha_corte", "cuenta_id"] and df.count() > 0


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    s = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[key])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, s) == _rows(ocols, cur.fetchall())


def test_every_key_has_an_oracle():
    from lakebank.oracle_sql import ORACLE as own
    from lakebank.plans.registry import QUERIES
    assert set(QUERIES) == set(own) and len(QUERIES) >= 89
    assert set(QUERIES) <= set(E.queries()) and set(own) <= set(E.oracle_sql())
