"""Left join to a lookup with hot keys, independent of adaptive execution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def can_hash(t: T.DataType) -> bool:
    """Spark hashes neither maps nor variants."""
    if isinstance(t, T.StructType):
        return all(can_hash(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return can_hash(t.elementType)
    return not isinstance(t, (T.MapType, T.VariantType))


def row_hash(df: DataFrame) -> Column:
    """A hash of a row's hashable columns, to deal rows evenly."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if can_hash(f.dataType)], F.lit(0))


def join_spread(df: DataFrame, lookup: DataFrame, on: dict[str, str], count: str) -> DataFrame:
    """``df`` left-joined to ``lookup``, one row per key, NULL keys equal (as in a window).

    ``on`` maps columns of ``df`` to key columns of ``lookup``; ``count`` is the number of
    rows of ``df`` with that key.  ``lookup`` is read three times, so it should be staged.
    Keys with more than 1/(4 x shuffle partitions) of the rows are at most 4 x partitions
    many, a proven bound: those are broadcast, and their rows skip the shuffle join by
    taking a random join hash.  The result has the columns of ``df`` and the lookup's
    other columns (but ``count``).
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = lookup.agg(F.sum(count)).first()[0] or 0
    share = max(1, int(total) // (4 * parts))
    keys = list(on.values())
    values = [c for c in lookup.columns if c not in keys and c != count]

    def side(rows: DataFrame, tag: str) -> DataFrame:
        return rows.select(*[F.col(k).alias(f"_{tag}_{k}") for k in keys],
                           *[F.col(v).alias(f"_{tag}_{v}") for v in values], F.lit(True).alias(f"_{tag}"))

    def same(tag: str):
        cond = F.lit(True)
        for a, k in on.items():
            cond = cond & F.col(a).eqNullSafe(F.col(f"_{tag}_{k}"))
        return cond

    hot = side(lookup.where(F.col(count) > share), "hot")
    rest = side(lookup.where(F.col(count) <= share), "rest").withColumn(
        "_rest_hash", F.xxhash64(*[F.col(f"_rest_{k}") for k in keys]))
    out = df.join(F.broadcast(hot), same("hot"), "left")
    spread = F.when(F.col("_hot"), row_hash(df)).otherwise(
        F.xxhash64(*[F.col(c) for c in on]))
    out = out.withColumn("_hash", spread).join(
        rest, (F.col("_hash") == F.col("_rest_hash")) & F.col("_hot").isNull() & same("rest"), "left")
    return out.select(*df.columns, *[F.when(F.col("_hot"), F.col(f"_hot_{v}")).otherwise(F.col(f"_rest_{v}")).alias(v)
                                     for v in values])
