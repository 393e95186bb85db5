import math
import random

import numpy as np
import pytest
from pyspark.sql.types import ArrayType, DoubleType, FloatType, LongType, StructField, StructType

from tierline.llm.topk_search import search_block, top_k

SCHEMA = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType()))])


def brute(rows, is_query, k):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good = [(i, list(v)) for i, v in dict.fromkeys((i, tuple(v)) for i, v in good)]
    out = []
    for q, v in good:
        if not is_query(q):
            continue
        found = {(-sum(a * b for a, b in zip(v, c)), i) for i, c in good if i != q and len(c) == len(v)}
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


def check(spark, rows, k=5, every=5, **blocks):
    df = spark.createDataFrame(rows, SCHEMA)
    got = top_k(spark, df, lambda i: i % every == 0, k, **blocks).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, lambda i: i % every == 0, k)


def test_random_vectors_over_several_blocks(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(20)]) for i in range(240)]
    check(spark, rows, query_block=20, candidate_block=50)


def test_ties_copies_and_few_candidates(spark):
    rng = random.Random(2)
    hot = [0.5] * 8
    rows = [(i, hot if i % 3 else [rng.choice([0.0, 0.5, -0.5]) for _ in range(8)]) for i in range(120)]
    check(spark, rows, query_block=16, candidate_block=16)
    check(spark, rows[:3], k=5, every=1)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (5, None), (10, [None, 1.0]), (15, [nan, 1.0]), (20, [inf, 0.0]), (25, []), (30, []),
            (1, [0.1, -0.1]), (2, [0.1, -0.1]), (None, [1.0, 1.0]), (3, [1.0, 2.0, 3.0]), (35, [1.0, 0.0, -1e-9]),
            (0, [1.0, 2.0]), (40, [1e7, 1e7]), (41, [1e7, -3e6])]
    check(spark, rows)


def test_empty_table(spark):
    assert top_k(spark, spark.createDataFrame([], SCHEMA), lambda i: i % 2 == 0).collect() == []


def test_float_components_are_widened(spark):
    schema = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(FloatType()))])
    rows = [(i, [float(np.float32(0.1 * i)), 1.0]) for i in range(12)]
    got = top_k(spark, spark.createDataFrame(rows, schema), lambda i: i % 5 == 0, 3).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, lambda i: i % 5 == 0, 3)


@pytest.mark.parametrize("dims", [1, 16, 40])
def test_bounds_lose_nothing_when_masses_are_uneven(dims):
    rng = np.random.default_rng(dims)
    m = np.floor(rng.normal(0, 60, (1500, dims)) * rng.choice([0.05, 1, 8], (1500, 1)))
    ids = rng.permutation(1500)
    q = np.arange(0, 1500, 50)
    rows = {int(i): v for i, v in zip(ids, m)}
    got = search_block(q, np.array([rows[int(i)] for i in q]), ids, m, 5)
    have = {}
    for a, b, s in zip(*got):
        have.setdefault(int(a), []).append((-int(s), int(b)))
    for i in q.tolist():
        want = sorted((-int(rows[i] @ v), j) for j, v in rows.items() if j != i)[:5]
        assert have[i] == want
