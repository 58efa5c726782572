"""Every registered query against its DuckDB oracle on the small test tables."""

import math
import os

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from martmetrics.plans import catalog

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
QUERIES = {k: v for k, v in E.queries().items() if k in catalog.QUERIES}
SQL = {k: v for k, v in E.oracle_sql().items() if k in catalog.QUERIES}


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(int(v)))
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, f"{v:.6f}")
    if hasattr(v, "isoformat"):
        return (1, v.isoformat())
    if isinstance(v, int) or hasattr(v, "as_integer_ratio"):
        return (1, f"{float(v):.6f}")
    return (1, str(v))


def _type_class(t) -> str:
    if pa.types.is_integer(t):
        return f"int{t.bit_width}"
    if pa.types.is_floating(t):
        return "float"
    if pa.types.is_decimal(t):
        return "decimal"
    if pa.types.is_string(t) or pa.types.is_large_string(t) or pa.types.is_string_view(t):
        return "string"
    if pa.types.is_date(t):
        return "date"
    return str(t)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _canon(df.columns, got) == _canon(cols, want)
    spark_types = {f.name: _type_class(f.type) for f in df.limit(0).toArrow().schema}
    duck_types = {f.name: _type_class(f.type) for f in duck.sql(SQL[name]).to_arrow_table().schema}
    assert spark_types == duck_types


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "entity" in df.columns and "placed_gmv" in df.columns
