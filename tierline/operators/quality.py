"""Silver-layer table operators: keep-first dedup, orphan flags, data-quality metrics,
event-date window.

Scale notes
* ``dedup`` keeps the ``row_number() == 1`` shape so Catalyst plans a *partial*
  window group limit before the shuffle: a key holding a third of all rows is cut
  to one row per map task before it reaches a reducer.
* ``flag_orphans`` joins against the distinct parent keys.  NULL foreign keys can
  never match, so each is dealt by a hash of its whole row; a hot non-NULL key is split
  by AQE's skew-join handling, or explicitly with ``split_hot_keys``.
* metrics are single-pass aggregates with map-side partial aggregation.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, FloatType, IntegralType, MapType, StringType, TimestampNTZType, TimestampType,
                               VariantType)

from tierline.operators.spread import can_hash, row_hash
from tierline.sources.tables import stage

_ORDERABLE_EXCLUDED = (MapType, VariantType)


def _as_list(x: str | Iterable[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def full_order(df: DataFrame, first: Sequence[str]) -> list[Column]:
    """``first`` columns, then every other orderable column in schema order, all
    ascending with NULLs first: a total order, so the kept row is deterministic."""
    rest = [f.name for f in df.schema.fields
            if f.name not in first and not isinstance(f.dataType, _ORDERABLE_EXCLUDED)]
    return [F.col(c).asc_nulls_first() for c in list(first) + rest]


def dedup(df: DataFrame, keys: str | Iterable[str], order: str | Iterable[str] | None = None,
          deterministic: bool = True) -> DataFrame:
    """Keep the first row of every ``keys`` group, ordered by ``order`` (default: the
    keys).  With ``deterministic`` the remaining columns break ties."""
    keys = _as_list(keys)
    order_cols = _as_list(order) if order is not None else keys
    ordering = (full_order(df, order_cols) if deterministic
                else [F.col(c).asc_nulls_first() for c in order_cols])
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_metrics(df: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """One row: rows before dedup, rows after (one per key, NULL keys form a group,
    as in ``dedup``), and the difference."""
    keys = _as_list(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    ).withColumn("duplicates_removed", F.col("rows_before") - F.col("rows_after"))


def flag_orphans(df: DataFrame, parent: DataFrame, parent_key: str | Iterable[str], fk: str | Iterable[str],
                 flag: str | None = None, split_hot_keys: bool = False) -> DataFrame:
    """Add ``flag`` (default ``is_orphan_<fk>``) = no parent row has ``parent_key`` equal
    to ``fk``.  Keys may have several columns.  Every row is kept; an ``fk`` with a NULL is
    an orphan.

    ``split_hot_keys`` splits hot keys explicitly instead of leaving them to AQE: every
    key with more than 1/(4 x shuffle partitions) of the rows, so at most 4 x partitions
    keys, is found by a partially aggregated count; its child rows are dealt over as many
    buckets as it has such shares, and only those parent keys are repeated per bucket.
    """
    fks, pks = _as_list(fk), _as_list(parent_key)
    if len(fks) != len(pks):
        raise ValueError(f"{fks} and {pks} differ in length")
    flag = flag or f"is_orphan_{'_'.join(fks)}"
    # Compare in the wider of two integer types, and cast the parent side before
    # the distinct: the distinct's hash partitioning then already fits the join key,
    # so a sort-merge join shuffles the parent keys once, not twice.
    child, valid, cond, known = {}, [], F.lit(True), F.lit(True)
    for i, (c, p) in enumerate(zip(fks, pks)):
        child_t, parent_t = df.schema[c].dataType, parent.schema[p].dataType
        key_t = _wider_integral(child_t, parent_t)
        valid.append((F.col(p) if key_t is None or key_t == parent_t else F.col(p).cast(key_t)).alias(f"_valid_{i}"))
        child[f"_fk_{i}"] = F.col(c) if key_t is None or key_t == child_t else F.col(c).cast(key_t)
        cond = cond & (F.col(f"_fk_{i}") == F.col(f"_valid_{i}"))
        known = known & F.col(c).isNotNull()
    valid = parent.select(*valid).distinct()
    hashed = row_hash(df)
    # A key with a NULL takes its row's hash as its first part; ``known`` keeps it from matching.
    first_t = _wider_integral(df.schema[fks[0]].dataType, parent.schema[pks[0]].dataType) or df.schema[fks[0]].dataType
    keys = dict(child)
    if isinstance(first_t, (IntegralType, StringType)):
        room = {"tinyint": 127, "smallint": 32767}.get(first_t.simpleString(), 2147483647)
        keys["_fk_0"] = F.when(known, child["_fk_0"]).otherwise(F.pmod(hashed, F.lit(room)).cast(first_t))
    keyed = df.withColumns(keys)
    cond = cond & known
    if split_hot_keys:
        hot = _hot_keys(df.where(known).select(*[c.alias(k) for k, c in child.items()]))
        runs = F.broadcast(hot.select(*[F.col(k).alias(f"_hot{k}") for k in child], "_runs"))

        def with_runs(rows: DataFrame, tag: str) -> DataFrame:
            same = F.lit(True)
            for i in range(len(fks)):
                same = same & (F.col(f"{tag}{i}") == F.col(f"_hot_fk_{i}"))
            return rows.join(runs, same, "left").drop(*[f"_hot{k}" for k in child])

        keyed = (with_runs(keyed, "_fk_")
                 .withColumn("_hs", F.when(known, F.pmod(hashed, F.coalesce("_runs", F.lit(1)))).otherwise(0)).drop("_runs"))
        valid = (with_runs(valid, "_valid_")
                 .withColumn("_vs", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_runs", F.lit(1)) - 1)))
                 .drop("_runs"))
        cond = cond & (F.col("_hs") == F.col("_vs"))
    joined = keyed.join(valid, cond, "left")
    return joined.withColumn(flag, F.col("_valid_0").isNull()).drop(
        *child, *[f"_valid_{i}" for i in range(len(fks))], "_hs", "_vs")


def _hot_keys(keys: DataFrame) -> DataFrame:
    """Keys with more than 1/(4 x shuffle partitions) of the rows, and in how many runs to
    deal them: at most 4 x partitions rows.  The counts are staged, so ``keys`` is
    evaluated once."""
    spark = keys.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = stage(keys.groupBy(*keys.columns).agg(F.count(F.lit(1)).alias("_n")), "fk-counts", spark)
    share = max(1, int(counts.agg(F.sum("_n")).first()[0] or 0) // (4 * parts))
    return counts.where(F.col("_n") > share).withColumn("_runs", F.ceil(F.col("_n") / share)).drop("_n")


_INTEGRAL_ORDER = ["tinyint", "smallint", "int", "bigint"]


def _wider_integral(a, b):
    """The wider of two integral types, or None when either is not integral."""
    na, nb = a.simpleString(), b.simpleString()
    if na in _INTEGRAL_ORDER and nb in _INTEGRAL_ORDER:
        return a if _INTEGRAL_ORDER.index(na) >= _INTEGRAL_ORDER.index(nb) else b
    return None


def orphan_metrics(df: DataFrame, flags: Iterable[str]) -> DataFrame:
    """One row: number of rows carrying each flag, plus the row count."""
    flags = list(flags)
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(F.col(f)).alias(f"{f}_count") for f in flags])


def event_window(df: DataFrame, ts: str, start: str | _dt.date | None = None,
                 end: str | _dt.date | None = None, today: _dt.date | None = None) -> DataFrame:
    """Rows whose ``ts`` falls on the selected UTC days.

    neither date -> yesterday (UTC); only ``start`` -> that day; both -> the inclusive
    range.  Written as ``ts >= start AND ts < end + 1 day`` so it pushes to the scan.
    """
    def _d(x):
        return x if isinstance(x, _dt.date) else _dt.date.fromisoformat(str(x))

    if start is None and end is not None:
        raise ValueError("event_window: end given without start")
    if start is None:
        today = today or _dt.datetime.now(_dt.timezone.utc).date()
        lo = hi = today - _dt.timedelta(days=1)
    else:
        lo = _d(start)
        hi = _d(end) if end is not None else lo
    if hi < lo:
        raise ValueError(f"event_window: end {hi} before start {lo}")
    lo_ts = _dt.datetime.combine(lo, _dt.time())
    hi_ts = _dt.datetime.combine(hi + _dt.timedelta(days=1), _dt.time())
    dtype = df.schema[ts].dataType
    if isinstance(dtype, TimestampNTZType):
        lo_c = F.to_timestamp_ntz(F.lit(lo_ts.isoformat(sep=" ")))
        hi_c = F.to_timestamp_ntz(F.lit(hi_ts.isoformat(sep=" ")))
    elif isinstance(dtype, TimestampType):
        lo_c = F.lit(lo_ts.replace(tzinfo=_dt.timezone.utc))
        hi_c = F.lit(hi_ts.replace(tzinfo=_dt.timezone.utc))
    else:
        raise TypeError(f"event_window: {ts} is {dtype.simpleString()}, not a timestamp")
    return df.filter((F.col(ts) >= lo_c) & (F.col(ts) < hi_c))


def _fingerprint(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a row: equal rows have equal ones (zeros and NaNs in one form,
    NULLs counted by place)."""
    values = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if can_hash(f.dataType):
            values += [F.when(F.isnan(c), F.lit(float("nan"))).otherwise(c + F.lit(0.0))
                       if isinstance(f.dataType, (FloatType, DoubleType)) else c]
        values.append(c.isNull())
    return [F.xxhash64(*values).alias("_f0"), F.xxhash64(F.lit(1), *values[::-1]).alias("_f1")]


def exact_duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: rows, and rows that repeat an earlier identical row.  Rows are grouped by a
    fingerprint of two longs; only rows whose fingerprint repeats are compared in full."""
    marked = df.select("*", *_fingerprint(df))
    prints = marked.groupBy("_f0", "_f1").agg(F.count(F.lit(1)).alias("_n"))
    repeated = prints.where("_n > 1").select("_f0", "_f1")
    exact = (marked.join(repeated, ["_f0", "_f1"], "left_semi").drop("_f0", "_f1")
             .groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
             .agg(F.lit(0).alias("rows"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("defects")))
    rows = prints.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.lit(0).alias("defects"))
    return rows.unionByName(exact).agg(F.sum("rows").cast("bigint").alias("rows"), F.sum("defects").cast("bigint").alias("defects"))


def dq_profile(tables: dict[str, DataFrame], checks: dict[str, dict[str, Column]],
               duplicates: Iterable[str] = ()) -> DataFrame:
    """Defect rates, one row per (entity, check): rows, defects, rate = defects / rows.

    ``checks`` maps entity -> {check name: boolean defect predicate}; all checks of
    an entity are one aggregate over one scan.  ``duplicates`` names entities whose
    exact duplicate rows are counted too (by fingerprints, see ``exact_duplicate_rows``).
    """
    parts = []
    for entity, preds in checks.items():
        df = tables[entity]
        agg = df.agg(F.count(F.lit(1)).alias("rows"),
                     *[F.count_if(p).alias(f"_c{i}") for i, p in enumerate(preds.values())])
        stack = ", ".join(f"'{name}', _c{i}" for i, name in enumerate(preds))
        parts.append(agg.selectExpr(f"'{entity}' AS entity", "rows",
                                    f"stack({len(preds)}, {stack}) AS (dq_check, defects)"))
    for entity in duplicates:
        parts.append(exact_duplicate_rows(tables[entity])
                     .select(F.lit(entity).alias("entity"), "rows",
                             F.lit("exact_duplicate").alias("dq_check"), "defects"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return (out.select("entity", "dq_check", F.col("rows").cast("bigint").alias("rows"),
                       F.col("defects").cast("bigint").alias("defects"))
               .withColumn("rate", F.when(F.col("rows") > 0, F.col("defects") / F.col("rows"))
                                    .otherwise(F.lit(0.0))))
