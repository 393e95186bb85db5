"""Exact top-k by inner product: columnar branch and bound.

Vectors are quantised to whole numbers.  Queries and candidates are dealt into blocks, and
every task meets one block of queries with one block of candidates.  In a task the
candidates lie dimension by dimension (vertical layout).  Scores accumulate one block of
dimensions at a time; the mass of the dimensions still to come bounds what a candidate
can yet reach (Cauchy-Schwarz on the remaining norms), and candidates below the query's
k-th best so far are compacted away before the next dimensions are read.  The task's k
best per query go to a final ranking, so a query moves k rows per candidate block.

The queries are a share of the rows, so the work grows with queries x rows; neither side
is broadcast, and blocks have a fixed size at every scale.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.llm.common import release_memory, stage

SCALE = 256
K = 5
QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 4096
CHUNK = 512          # candidates scored at a time against a slice of the queries
QUERY_SLICE = 512
DIMENSIONS = 16      # dimensions accumulated between two bounds


def _keep_best(ids, scores, new_ids, new_scores, k):
    """k best of two sets of (id, score), ties to the smaller id."""
    ids, scores = np.concatenate([ids, new_ids]), np.concatenate([scores, new_scores])
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
                 k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of each query's k best candidates other than itself.  Both
    matrices hold whole numbers, a row a vector; sums must stay below 2^53 for floats,
    else they are Python integers."""
    dims = vectors.shape[1]
    steps = list(range(0, dims, DIMENSIONS)) or [0]
    exact = queries.dtype != object
    order = np.argsort(ids, kind="stable")
    ids, columns = ids[order], np.ascontiguousarray(vectors[order].T)     # vertical layout

    def rest_norms(m: np.ndarray) -> np.ndarray:
        """Norm of the dimensions from each step on, rounded up (m: dimensions x vectors)."""
        if not exact:
            return np.zeros((len(steps) + 1, m.shape[1]))
        squares = np.array([(m[s:s + DIMENSIONS].astype(np.float64) ** 2).sum(axis=0) for s in steps])
        tail = np.cumsum(squares[::-1], axis=0)[::-1]
        return np.vstack([np.sqrt(tail) * (1 + 1e-9), np.zeros(m.shape[1])])

    q_rest, c_rest = rest_norms(queries.T), rest_norms(columns)
    best = [(np.zeros(0, ids.dtype), np.zeros(0, queries.dtype)) for _ in query_ids]
    floor = np.full(len(query_ids), -np.inf)                     # k-th best score so far
    for a in range(0, len(ids), CHUNK):
        b = min(a + CHUNK, len(ids))
        for s in range(0, len(query_ids), QUERY_SLICE):
            rows = np.arange(s, min(s + QUERY_SLICE, len(query_ids)))
            q, c = np.divmod(np.arange(len(rows) * (b - a)), b - a)
            q, c = q + s, c + a
            other = query_ids[q] != ids[c]
            q, c = q[other], c[other]
            part = np.zeros(len(q), queries.dtype)
            for i, d in enumerate(steps):
                if len(q) > len(rows) * (b - a) // 8 and exact:   # still dense: one product
                    part += (queries[rows, d:d + DIMENSIONS] @ columns[d:d + DIMENSIONS, a:b])[q - s, c - a]
                else:
                    part = part + (queries[q, d:d + DIMENSIONS] * columns[d:d + DIMENSIONS, c].T).sum(axis=1)
                if exact:                                        # ties beyond the k-th have larger ids
                    bound = part + q_rest[i + 1][q] * c_rest[i + 1][c]
                    full = np.isfinite(floor[q])
                    alive = ~full | ((bound > floor[q]) if i + 1 == len(steps) else (bound + 0.5 > floor[q]))
                    q, c, part = q[alive], c[alive], part[alive]
            cut = np.searchsorted(q, np.append(rows, rows[-1] + 1))
            for j, r in enumerate(rows):
                lo, hi = cut[j], cut[j + 1]
                if lo < hi:
                    best[r] = _keep_best(*best[r], ids[c[lo:hi]], part[lo:hi], k)
                    if len(best[r][0]) == k:
                        floor[r] = float(best[r][1][-1]) if exact else -np.inf
    sizes = [len(x[0]) for x in best]
    return (np.repeat(query_ids, sizes), np.concatenate([x[0] for x in best]) if best else ids[:0],
            np.concatenate([x[1] for x in best]) if best else np.zeros(0, queries.dtype))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _search(k: int):
    def run(key, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(candidates):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        q, c = _matrix(queries["quantised"]), _matrix(candidates["quantised"])
        reach = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * max(1, q.shape[1])
        if reach >= 2.0 ** 53:    # beyond exact floats: whole numbers of any size
            q, c = (np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (q, c))
        query, vec, score = search_block(queries["vec_id"].to_numpy(), q, candidates["vec_id"].to_numpy(), c, k)
        release_memory()
        low, high = -(2 ** 63), 2 ** 63 - 1
        return pd.DataFrame({"query_id": query, "vec_id": vec,
                             "score": np.array([min(max(int(s), low), high) for s in score], np.int64)})

    return run


def top_k(spark: SparkSession, vectors: DataFrame, is_query, k: int = K, id_col: str = "vec_id",
          vector_col: str = "embedding", query_block: int = QUERY_BLOCK,
          candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest inner products of every row for
    which ``is_query`` (a condition on the id) holds, against all rows but those with its
    own id; ties go to the smaller id.

    A component x counts as floor(256 * x), x as double.  Rows with a NULL id, a NULL
    vector, or a NULL or non-finite component take no part.  Vectors are compared with
    vectors of the same length; an empty vector scores 0.  Rows that repeat an id are
    candidates each, and equal (query, id, score) rows count once.  Scores beyond a long
    are cut to its limits.
    """
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    base = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where(_finite("x"))
    quantised = stage(spark, base.select("vec_id", F.transform("x", lambda v: F.floor(v * SCALE).cast("double"))
                                         .alias("quantised"), F.size("x").alias("dims")).dropDuplicates(),
                      "op4-vectors")
    queries = quantised.where(is_query(F.col("vec_id")))
    n_query = max(1, -(-queries.count() // query_block))
    n_candidate = max(1, -(-quantised.count() // candidate_block))

    def block(n: int, salt: str):
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.withColumn("qb", block(n_query, "q")).withColumn("cb", every(n_candidate))
    right = quantised.withColumn("cb", block(n_candidate, "c")).withColumn("qb", every(n_query))
    found = (left.groupBy("dims", "qb", "cb").cogroup(right.groupBy("dims", "qb", "cb"))
             .applyInPandas(_search(k), "query_id long, vec_id long, score long")).dropDuplicates()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _finite(name: str):
    """True for an array whose components are all present and finite."""
    return F.forall(F.col(name), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
