"""Embedding whitening: the leading eigenvectors of the covariance by block Jacobi-Davidson.

The covariance is never formed.  One pass over the vectors multiplies it by a narrow block:
each task centres its rows, projects them on the block and adds up rows x projections;
Spark sums those partial products entry by entry.  The driver holds only the search
subspace, dimensions x ``SUBSPACE`` numbers.

Each round takes the Rayleigh-Ritz pairs of the subspace.  Leading pairs whose residual
has reached double precision are locked.  For the next ones the correction equation,
projected against the locked and current vectors, is solved roughly by MINRES: one inner
step of all corrections is one pass.  The corrections, orthogonalised, widen the
subspace, which restarts from its best vectors when it is full.  It ends when all wanted
pairs are locked, or at the latest when the subspace is the whole space.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import ship_package, stage, tidied

SCALE, SHIFT = 1024, 100_000
SUBSPACE = 40           # widest search subspace (at least four times the components)
INNER = 6               # MINRES steps per correction
TOLERANCE = 512 * np.finfo(float).eps    # residual beside the largest eigenvalue
MOST_ROUNDS = 200
LEAST_SHARE = 1e-10     # of the largest eigenvalue: below, double precision can't tell a direction from none
_WIDE = np.int64(1) << np.int64(62)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column of one length, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _sums(df: DataFrame, run: Callable[[np.ndarray], np.ndarray], size: int, shape: tuple[int, ...]) -> np.ndarray:
    """Entry-wise sum of ``run(vectors)`` over all batches: each task adds up its own and
    sends ``size`` numbers, Spark adds those, and ``size`` numbers reach the driver."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += run(_matrix(batch.column(0))).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["at", "value"])

    rows = df.select("x").mapInArrow(tidied(task), "at long, value double").groupBy("at").agg(
        F.sum("value").alias("value")).collect()
    out = np.zeros(size)
    out[[r.at for r in rows]] = [r.value for r in rows]
    return out.reshape(shape)


@dataclass
class Moments:
    """Of the fitted vectors: how many, exact sums per dimension, and the mean."""
    n: int
    sums: list[int]


def moments(vectors: DataFrame, dims: int) -> Moments:
    """Exact: 64-bit sums per task where they fit, decimals between tasks."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for batch in batches:
            x = _matrix(batch.column(0))
            if not len(x):
                continue
            n += len(x)
            exact = x if int(np.abs(x).max()) < int(_WIDE) // len(x) else x.astype(object)
            total = [t + int(s) for t, s in zip(total, exact.sum(axis=0))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dims + 1), pa.int64()),
             pa.array([Decimal(t) for t in [*total, n]], pa.decimal128(38, 0))], names=["at", "value"])

    got = {r.at: int(r.value) for r in vectors.select("x").mapInArrow(tidied(task), "at long, value decimal(38,0)")
           .groupBy("at").agg(F.sum("value").alias("value")).collect()}
    return Moments(got.get(dims, 0), [got.get(i, 0) for i in range(dims)])


class Covariance:
    """Products with the covariance of the vectors, one pass over them each."""

    def __init__(self, vectors: DataFrame, m: Moments) -> None:
        self._vectors, self._n = vectors, m.n
        self._origin = np.array([s // m.n for s in m.sums], np.int64)
        self._rest = np.array([float(Decimal(s % m.n) / m.n) for s in m.sums])

    def centring(self) -> Callable[[np.ndarray], np.ndarray]:
        """Vectors to vectors less the mean: its whole part is taken off exactly."""
        origin, rest = self._origin, self._rest
        return lambda x: (x - origin).astype(float) - rest

    def trace(self) -> float:
        rows = self.centring()
        return float(_sums(self._vectors, lambda x: np.array([np.square(rows(x)).sum()]), 1, (1,))[0] / self._n)

    def times(self, block: np.ndarray) -> np.ndarray:
        rows = self.centring()

        def run(x: np.ndarray) -> np.ndarray:
            y = rows(x)
            return y.T @ (y @ block)

        return _sums(self._vectors, run, block.size, block.shape) / self._n


def _orthonormal(block: np.ndarray, against: list[np.ndarray]) -> np.ndarray:
    """The block's columns made orthonormal to ``against`` and to each other; those that
    leave nothing new go."""
    kept: list[np.ndarray] = []
    for v in block.T:
        size = np.linalg.norm(v)
        if not size > 0:
            continue
        v = v / size
        for _ in range(3):
            for basis in against:
                v = v - basis @ (basis.T @ v)
            for u in kept:
                v = v - u * (u @ v)
            size = np.linalg.norm(v)
            if size < 1e-10:
                break
            v = v / size
        if size >= 1e-10:
            kept.append(v)
    return np.stack(kept, 1) if kept else np.zeros((block.shape[0], 0))


def _corrections(times: Callable[[np.ndarray], np.ndarray], theta: np.ndarray, basis: np.ndarray,
                 residuals: np.ndarray, steps: int) -> np.ndarray:
    """Rough solutions t of (I - QQ')(V - theta)(I - QQ') t = -r for all columns at once, by
    MINRES; ``basis`` is Q.  A step multiplies the covariance by one block."""
    def off(x: np.ndarray) -> np.ndarray:
        x = x - basis @ (basis.T @ x)
        return x - basis @ (basis.T @ x)

    def norms(x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.einsum("ij,ij->j", x, x))

    r = off(-residuals)
    beta = norms(r)
    first = np.where(beta > 0, beta, 1.0)
    m = r.shape[1]
    v_old, v = np.zeros_like(r), r / first
    c_old, c, s_old, s = np.ones(m), np.ones(m), np.zeros(m), np.zeros(m)
    w_old, w, t = np.zeros_like(r), np.zeros_like(r), np.zeros_like(r)
    eta, live, last = beta.copy(), beta > 0, np.zeros(m)
    for _ in range(steps):
        if not live.any():
            break
        z = off(times(v) - theta * v)
        alpha = np.einsum("ij,ij->j", v, z)
        z = z - alpha * v - last * v_old
        beta_new = norms(z)
        delta = c * alpha - c_old * s * last            # rotations of the two steps before
        rho2 = s * alpha + c_old * c * last
        rho3 = s_old * last
        rho1 = np.hypot(delta, beta_new)
        usable = live & (rho1 > 1e-300)
        safe = np.where(usable, rho1, 1.0)
        c_new, s_new = np.where(usable, delta / safe, 1.0), np.where(usable, beta_new / safe, 0.0)
        w_new = (v - rho3 * w_old - rho2 * w) / safe
        t = t + np.where(usable, c_new * eta, 0.0) * w_new
        eta = -s_new * eta
        live = usable & (beta_new > 1e-14 * np.maximum(np.abs(theta), 1e-300)) & (np.abs(eta) > 1e-3 * beta)
        v_old, v = v, np.where(live, z / np.where(beta_new > 0, beta_new, 1.0), 0.0)
        w_old, w = w, w_new
        c_old, c, s_old, s, last = c, c_new, s, s_new, beta_new
    return off(t)


def leading_pairs(times: Callable[[np.ndarray], np.ndarray], dims: int, count: int, subspace: int = SUBSPACE,
                  inner: int = INNER, tolerance: float = TOLERANCE, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of the symmetric operator
    ``times``: its ``count`` largest, by block Jacobi-Davidson with locking."""
    count, widest = min(count, dims), min(dims, max(subspace, 4 * count))
    rng = np.random.default_rng(seed)
    locked, values = np.zeros((dims, 0)), []
    space = _orthonormal(rng.standard_normal((dims, min(dims, count + 2))), [])
    image = times(space)
    for _ in range(MOST_ROUNDS):
        small = space.T @ image
        theta, rot = np.linalg.eigh((small + small.T) / 2)
        theta, rot = theta[::-1], rot[:, ::-1]
        space, image = space @ rot, image @ rot
        want = count - locked.shape[1]
        residual = image[:, :want] - space[:, :want] * theta[:want]
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        scale = max([abs(theta[0]) if len(theta) else 0.0, *map(abs, values)])
        whole = space.shape[1] + locked.shape[1] == dims
        done = 0
        while done < len(size) and (whole or size[done] <= tolerance * scale):
            done += 1
        if done:
            locked = np.hstack([locked, space[:, :done]])
            values += theta[:done].tolist()
            space, image, theta, residual = space[:, done:], image[:, done:], theta[done:], residual[:, done:]
            want -= done
        if not want:
            order = np.argsort(values)[::-1]
            return np.array(values)[order], locked[:, order]
        if not space.shape[1]:      # everything found so far is locked: look elsewhere
            more = rng.standard_normal((dims, want))
        else:
            now = min(want, space.shape[1])
            more = _corrections(times, theta[:now], np.hstack([locked, space[:, :now]]), residual[:, :now], inner)
        if space.shape[1] + locked.shape[1] + more.shape[1] > widest:
            keep = max(want + 2, (widest - locked.shape[1]) // 2)
            space, image = space[:, :keep], image[:, :keep]
        fresh = _orthonormal(more, [locked, space])
        if not fresh.shape[1]:      # the corrections say nothing new
            fresh = _orthonormal(rng.standard_normal((dims, 1)), [locked, space])
        fresh = fresh[:, :dims - locked.shape[1] - space.shape[1]]
        space, image = np.hstack([space, fresh]), np.hstack([image, times(fresh)])
    raise ArithmeticError(f"{locked.shape[1]} of {count} eigenpairs after {MOST_ROUNDS} rounds")


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x``: the vectors that are neither NULL nor hold a NULL, infinite or NaN
    entry, each entry c as the whole number floor(1024 c) + 100000 (entries beyond
    +-2^52 count as that)."""
    v = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    good = F.col(vector_col).isNotNull() & ~F.exists(
        v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    far = float(1 << 52)
    whole = F.transform(v, lambda c: F.floor(F.least(F.greatest(SCALE * c, F.lit(-far)), F.lit(far))) + F.lit(SHIFT))
    return rows.where(good).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("x"))


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[Decimal | None]:
    """Sum over dimensions of (n x - S)^2 of each row, exact; None beyond 38 digits."""
    s = np.array(sums, object)
    most = max([abs(int(x.max())), abs(int(x.min()))]) * n + max(map(abs, sums))
    if most * most * x.shape[1] < int(_WIDE):
        y = n * x - s.astype(np.int64)
        return [Decimal(int(v)) for v in (y * y).sum(axis=1)]
    if most < int(_WIDE):
        y = n * x - s.astype(np.int64)
        top = int(np.abs(y).max())
        if top * top * x.shape[1] < int(_WIDE):
            return [Decimal(int(v)) for v in (y * y).sum(axis=1)]
    y = n * x.astype(object) - s
    return [Decimal(int(v)) if v < 10 ** 38 else None for v in (y * y).sum(axis=1)]


def _projected(m: Moments, centred: Callable[[np.ndarray], np.ndarray], vectors: np.ndarray, values: np.ndarray,
               trace: float, error: float):
    count, scaled = len(values), vectors / np.sqrt(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = _matrix(part.column("x"))
                w = centred(x) @ scaled
                rows = np.repeat(np.arange(len(x)), count)
                deviation = pa.array(_deviation(x, m.n, m.sums), pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(pa.array(rows)), pa.array(np.tile(np.arange(1, count + 1), len(x)), pa.int32()),
                     pa.array(np.full(len(rows), m.n)), deviation.take(pa.array(rows)), pa.array(w.ravel()),
                     pa.array(np.tile(values / trace, len(x))), pa.array(np.full(len(rows), error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return tidied(run)


def whiten(spark: SparkSession, rows: DataFrame, components: int = 8, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component (from 1, by falling eigenvalue): ``vec_id,
    component, n, deviation, whitened, explained, identity_error``.

    All usable vectors are fitted (see ``whole_vectors``); where lengths differ, those of
    the most frequent length (the longest of equally frequent ones) are, and the others
    take no part.  Ids may be NULL or repeat, each row counts.  There are as many
    components as directions the vectors vary in (with ``LEAST_SHARE`` of the largest
    variance at least), at most ``components``: without variation a direction has no
    whitened value, so copies of one vector, a single vector or empty vectors give no
    rows.  ``deviation`` is an exact decimal, NULL beyond 38
    digits.  Other columns are ignored.
    """
    ship_package(spark)
    usable = stage(spark, whole_vectors(rows, id_col, vector_col), "op13-vectors")
    sizes = usable.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    dims = sizes[0].dims if sizes else 0
    schema = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double")
    if not dims:
        return spark.createDataFrame([], schema)
    fitted = usable.where(F.size("x") == dims)
    m = moments(fitted, dims)
    cov = Covariance(fitted, m)
    trace = cov.trace()
    if not trace > 0:
        return spark.createDataFrame([], schema)
    values, vectors = leading_pairs(cov.times, dims, components)
    varied = values > LEAST_SHARE * values[0]
    values, vectors = values[varied], vectors[:, varied]
    count, centred, scaled = len(values), cov.centring(), vectors / np.sqrt(values)

    def second(x: np.ndarray) -> np.ndarray:
        w = centred(x) @ scaled
        return np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])

    got = _sums(fitted, second, count * count + count, (-1,)) / m.n
    centre = got[count * count:]
    error = float(np.abs(got[:count * count].reshape(count, count) - np.outer(centre, centre) - np.eye(count)).max())
    return fitted.mapInArrow(_projected(m, centred, vectors, values, trace, error), schema)
