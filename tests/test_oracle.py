"""Every registered query against its DuckDB oracle on the smallest driver tables.

Same comparison as the driver's gate: column names, row count and an
order-insensitive multiset of normalised values.
"""

import datetime as dt
import decimal
import math

import pytest

from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(table):
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    return cols, sorted((tuple(_norm(c[i]) for c in data) for i in range(table.num_rows)), key=repr)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _base():
    from quayside.registry import QUERIES

    return QUERIES


def _keys():
    import __spark_entry__ as E

    return sorted(E.queries().keys() & _base().keys())


def test_every_query_has_an_oracle():
    import __spark_entry__ as E

    assert set(_base()) <= set(E.queries())
    assert set(_base()) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["event_name", "prop_k", "prop_city", "n"]
    assert df.count() > 0


@pytest.mark.parametrize("key", _keys())
def test_matches_oracle(spark, duck, key):
    import __spark_entry__ as E

    got = E.queries()[key](spark, SF_SMALL).toArrow()
    want = duck.sql(E.oracle_sql()[key]).to_arrow_table()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr
