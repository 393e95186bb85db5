import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tierline.llm.whitening import _deviation, leading_pairs, whiten

SCHEMA = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType()))])


def reference(rows, components):
    """Ids, component values, shares and deviations from the covariance matrix itself."""
    held = [(i, [math.floor(1024 * c) + 100_000 for c in v]) for i, v in rows]
    x = np.array([v for _, v in held], object)
    n, s = len(x), x.sum(axis=0)
    y = ((n * x - s) / n).astype(float)
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return [i for i, _ in held], y @ u / np.sqrt(e), e / np.square(y).sum() * n, [int(v) for v in ((n * x - s) ** 2).sum(axis=1)]


def check(spark, rows, good, components=8, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = whiten(spark, df, components).collect()
    ids, white, share, deviation = reference(good, components)
    k = white.shape[1]
    assert len(got) == len(good) * k
    order = lambda r: (r.vec_id is None, r.vec_id or 0, r.deviation)
    by_id = [sorted((r for r in got if r.component == c + 1), key=order) for c in range(k)]
    at = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, deviation[i]))
    for c in range(k):
        assert [(r.vec_id, int(r.deviation)) for r in by_id[c]] == [(ids[i], deviation[i]) for i in at]
        mine, theirs = np.array([r.whitened for r in by_id[c]]), white[at, c]
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < 1e-8
        assert all(abs(r.explained / share[c] - 1) < 1e-9 and r.n == len(good) for r in by_id[c])
    assert {r.identity_error for r in got} and got[0].identity_error < 1e-9


def vectors(seed, n, dims):
    rng = np.random.default_rng(seed)
    mix = rng.standard_normal((dims, dims)) * np.linspace(2, 0.2, dims)
    return [(i, (rng.standard_normal(dims) @ mix).tolist()) for i in range(n)]


def test_random_vectors(spark):
    rows = vectors(1, 300, 12)
    check(spark, rows, rows)
    check(spark, rows[:7], rows[:7], components=3)


def test_unusable_vectors_take_no_part(spark):
    rows = vectors(2, 60, 5)
    nan, inf = float("nan"), float("inf")
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0]), (102, [nan, 1.0, 1.0, 1.0, 1.0]), (103, [1.0, 1.0, 1.0, -inf, 1.0]),
           (104, []), (105, [1.0, 2.0])]
    good = rows + [(None, [0.5, 0.25, -3.0, 1e-9, 7.0]), (3, [2.0, 1.0, 0.0, -1.0, -2.0]), rows[4]]
    check(spark, bad + good, good, components=4)


def test_directions_without_variation_have_no_component(spark):
    rng = random.Random(1)
    rows = [(i, [a, 2 * a, b, 0.5]) for i in range(50) for a, b in [(rng.randrange(40) / 8, rng.randrange(30) / 4)]]
    got = whiten(spark, spark.createDataFrame(rows, SCHEMA), 8).collect()
    assert {r.component for r in got} == {1, 2} and got[0].identity_error < 1e-9
    assert abs(sum(r.explained for r in got if r.vec_id == 0) - 1) < 1e-9
    for nothing in ([(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(1, []), (2, [])], [(1, None)], []):
        assert whiten(spark, spark.createDataFrame(nothing, SCHEMA)).collect() == []


def test_equal_eigenvalues(spark):
    rows = [(2 * i + j, [(1.0 - 2 * j) * (i == k) for k in range(6)]) for i in range(6) for j in range(2)]
    got = whiten(spark, spark.createDataFrame(rows, SCHEMA), 4).collect()
    assert len(got) == 12 * 4 and got[0].identity_error < 1e-9
    assert all(abs(r.explained - 1 / 6) < 1e-9 for r in got)


def test_large_entries_and_other_columns(spark):
    rows = [(i, [500.0 * i, float(i % 3), -100.0 * (i % 7)]) for i in range(40)]
    check(spark, rows, rows, components=3)
    clash = {c: F.lit("x") for c in ("x", "component", "n", "deviation", "whitened", "at", "value")}
    df = spark.createDataFrame([(i, [1e9 * i, float(i % 3)]) for i in range(40)], SCHEMA)
    plain = sorted((r.vec_id, r.component, r.deviation) for r in whiten(spark, df, 2).collect())
    assert sorted((r.vec_id, r.component, r.deviation) for r in whiten(spark, df.withColumns(clash), 2).collect()) == plain
    huge = whiten(spark, spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], SCHEMA), 2)
    assert len(huge.collect()) == 3     # one direction drowns the other


@pytest.mark.parametrize("dims, count", [(5, 8), (64, 8), (300, 6)])
def test_pairs_reach_double_precision(dims, count):
    rng = np.random.default_rng(dims)
    q, _ = np.linalg.qr(rng.standard_normal((dims, dims)))
    e = np.sort(np.concatenate([rng.random(dims - 3) + 1, [2.0001, 2.0002, 9.0]]))[::-1]
    a = (q * e) @ q.T
    values, vecs = leading_pairs(lambda b: a @ b, dims, count)
    k = min(dims, count)
    assert np.allclose(values, e[:k], rtol=1e-12) and np.abs(vecs.T @ vecs - np.eye(k)).max() < 1e-12
    assert np.linalg.norm(a @ vecs - vecs * values, axis=0).max() < 1e-11


def test_deviations_are_exact_at_any_size():
    rng = random.Random(3)
    for top, n in ((300, 50), (2 ** 40, 1000), (2 ** 52, 10 ** 6)):
        x = np.array([[rng.randrange(-top, top) for _ in range(4)] for _ in range(20)], np.int64)
        s = [rng.randrange(-top, top) * n for _ in range(4)]
        exact = [sum((n * int(v) - t) ** 2 for v, t in zip(row, s)) for row in x.tolist()]
        assert [None if d is None else int(d) for d in _deviation(x, n, s)] == [v if v < 10 ** 38 else None for v in exact]
