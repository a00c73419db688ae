"""Every registered query against its DuckDB oracle SQL (the driver's correctness gate)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans.oracle import ORACLE

from .conftest import SF_SMALL

TYPE = {"bigint": "BIGINT", "int": "INTEGER", "float": "FLOAT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return ("nan",)
    return ("v", v)


def _rows(cols, recs):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in recs), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in os.listdir(SF_SMALL):
        if t.endswith(".parquet"):
            con.sql(f"CREATE VIEW {t[:-8]} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}')")
    return con


def test_registry_complete():
    from tessera.plans.oracle import ORACLE
    from tessera.plans.queries import QUERIES

    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) - set(ORACLE) == set()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_types = {f.name: TYPE.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    s_rec = [r.asDict() for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    d_types = dict(zip(rel.columns, map(str, rel.types)))
    d_rec = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert s_types == d_types
    cols = sorted(s_types)
    assert _rows(cols, s_rec) == _rows(cols, d_rec)


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 20
    assert [f.name for f in df.schema.fields][:2] == ["h3_index", "h3_hex"]
