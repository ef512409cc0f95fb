"""Registry-level checks: the flagship entry, every query against its SQL
oracle on sf0.001 (DuckDB), and plan properties (no Python UDF, pushed
filters and pruned scans)."""

import math

import duckdb
import pytest

from ravel.plans.registry import ORACLE, QUERIES
from ravel.sources.tables import TABLES

from conftest import SF001

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
            "MapInPandas")


def norm(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return c


def test_entry(spark):
    df = __import__('__spark_entry__').entry(spark)
    assert df.columns == ["word", "chunk", "n", "prevs"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_declared():
    rows_only = {n for n in QUERIES if n not in ORACLE}
    assert rows_only == set(), rows_only


DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean",
              "FLOAT": "float", "DOUBLE": "double"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    cols = df.columns
    got = sorted(tuple(norm(r[c]) for c in sorted(cols)) for r in df.collect())
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == sorted(cols)
    otypes = {d[0]: DUCK_TYPES.get(str(d[1]), str(d[1])) for d in res.description}
    assert dict(df.dtypes) == otypes
    order = [ocols.index(c) for c in sorted(cols)]
    want = sorted(tuple(norm(r[i]) for i in order) for r in res.fetchall())
    assert got == want


@pytest.mark.parametrize("name", ["word_totals", "phone_pairs", "trending_rows", "degree_summary",
                                  "cast_parse"])
def test_no_python_in_plan(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert not any(p in plan for p in PY_NODES)


def test_scan_pruned(spark):
    from ravel.sources.tables import cast_rows
    plan = cast_rows(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint," in plan
    assert "l_extendedprice" not in plan


def test_entry_adds_the_other_queries():
    import __spark_entry__ as E
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
