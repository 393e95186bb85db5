"""Running maximum per key in event order, without putting a whole key in one task.

``running_max(df, key, order, values)`` adds, for every row, the maximum of each
value expression over the rows of the same ``key`` with ``order`` <= the row's
``order`` (SQL: ``max(v) OVER (PARTITION BY key ORDER BY order ROWS BETWEEN
UNBOUNDED PRECEDING AND CURRENT ROW)``, with ``order`` unique per key).

A plain window sends every row of a key to one task, and a key may hold a third
of all rows.  Here ``order`` (an integer) is cut into blocks of ``block`` values:

1. per (key, block) maximum -- a partial aggregate, small;
2. carry-in per (key, block) = maximum over the earlier blocks of the key -- a
   window over the small table from step 1 (one row per block, not per event);
3. rows scanned by a window partitioned by (key, block), in which the block's carry-in
   is a first row that is dropped afterwards: no task ever holds more than ``block``
   order values, and the rows are shuffled and sorted once (a join to the carry-in would
   do both a second time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_max(df: DataFrame, key: str, order: str, values: dict[str, Column],
                block: int = 1 << 16) -> DataFrame:
    names = list(values)
    blk = F.expr(f"CAST(`{order}` AS BIGINT) div {int(block)}")  # exact integer division
    staged = df.withColumns({"_blk": blk, **{f"_v_{n}": c for n, c in values.items()}})

    per_block = staged.groupBy(F.col(key).alias("_bk"), F.col("_blk").alias("_bb")).agg(
        *[F.max(f"_v_{n}").alias(f"_m_{n}") for n in names])
    before = Window.partitionBy("_bk").orderBy("_bb").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_block.where(F.col("_bb").isNotNull()).select(   # rows without order have none
        F.col("_bk").alias(key), F.col("_bb").alias("_blk"),
        *[F.max(f"_m_{n}").over(before).alias(f"_v_{n}") for n in names], F.lit(True).alias("_carry"))

    # A carry-in has no order, so it comes before its block's rows, which have one.
    rows = staged.withColumn("_carry", F.lit(False)).unionByName(carry, allowMissingColumns=True)
    upto = (Window.partitionBy(key, "_blk").orderBy(F.col(order).asc_nulls_first())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = rows.withColumns({n: F.max(f"_v_{n}").over(upto) for n in names}).where(~F.col("_carry"))
    return out.drop("_blk", "_carry", *[f"_v_{n}" for n in names])
