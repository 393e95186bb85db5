"""Every registered query against its DuckDB oracle on the smallest driver data set,
plus plan checks (no Python UDF, no cartesian product)."""

import math
from collections import Counter

import duckdb
import pytest

from tierline.oracle import ORACLE
from tierline.queries import QUERIES
from tierline.testbed import TABLES


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.fixture(scope="module")
def built(spark, sf_small):
    """Each query's DataFrame, built once for both tests below."""
    frames = {}

    def get(name):
        if name not in frames:
            frames[name] = QUERIES[name](spark, sf_small)
        return frames[name]

    return get


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(built, con, name):
    df = built(name)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _multiset(df.columns, rows) == _multiset(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan_is_jvm_only(built, name):
    plan = built(name)._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, f"{name}: {node} in plan"
