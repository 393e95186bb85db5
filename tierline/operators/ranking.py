"""Group-relative operators: rank within a group, share of the group total, pivot.

The groups here (channel, industry, country) have a handful of values, so a plain
``Window.partitionBy(group)`` would put a whole group -- possibly a third of all rows --
into one task.

* ``rank_in_group``: rank = 1 + rows of the group with a strictly larger value.  Rows
  are counted per distinct (group, value), so a repeated value is one row; those are
  range-partitioned on (group, value), whose boundaries Spark samples from the data;
  each range is counted, and a value's rank is the counts of the group's earlier ranges
  plus the larger values of its own range.  A value lies in one range whole, so ties are
  exact.  NULL values come last: their rank is the group's other rows + 1.
* ``share_of_group``: group totals by a partially aggregated ``groupBy``.

Rows then take their rank or total by ``join_spread``, which keeps hot keys out of the
shuffle whether or not adaptive execution is on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.operators.spread import join_spread
from tierline.sources.tables import stage


def value_ranks(df: DataFrame, group: str, value: str) -> DataFrame:
    """``_g, _v, _n, _rank``: every distinct (group, value) with its rows and rank."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = (df.groupBy(F.col(group).alias("_g"), F.col(value).alias("_v"))
                .agg(F.count(F.lit(1)).alias("_n")))
    ranged = stage(counts.repartitionByRange(parts, F.col("_g"), F.col("_v").desc_nulls_last())
                   .withColumn("_range", F.spark_partition_id()), "rank-ranges", spark)
    known = ranged.where("_v IS NOT NULL")
    sums = known.groupBy("_g", "_range").agg(F.sum("_n").alias("_in_range"))
    earlier = Window.partitionBy("_g").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("_g").alias("_og"), F.col("_range").alias("_or"),
                          F.coalesce(F.sum("_in_range").over(earlier), F.lit(0)).alias("_offset"))
    larger = (Window.partitionBy("_g", "_range").orderBy(F.col("_v").desc())
              .rowsBetween(Window.unboundedPreceding, -1))
    ranks = (known.withColumn("_above", F.coalesce(F.sum("_n").over(larger), F.lit(0)))
             .join(offsets, F.col("_g").eqNullSafe(F.col("_og")) & (F.col("_range") == F.col("_or")))
             .select("_g", "_v", "_n", (F.col("_offset") + F.col("_above") + 1).cast("int").alias("_rank")))
    others = sums.groupBy(F.col("_g").alias("_og")).agg(F.sum("_in_range").alias("_known"))
    last = (ranged.where("_v IS NULL").join(others, F.col("_g").eqNullSafe(F.col("_og")), "left")
            .select("_g", "_v", "_n", (F.coalesce("_known", F.lit(0)) + 1).cast("int").alias("_rank")))
    return stage(ranks.unionByName(last), "value-ranks", spark)


def rank_in_group(df: DataFrame, group: str, value: str, out: str = "rank") -> DataFrame:
    """SQL ``rank() OVER (PARTITION BY group ORDER BY value DESC NULLS LAST)``."""
    ranks = value_ranks(df, group, value)
    return (join_spread(df, ranks, {group: "_g", value: "_v"}, "_n").withColumnRenamed("_rank", out))


def share_of_group(df: DataFrame, group: str, value: str, total: str, share: str) -> DataFrame:
    """Add ``total`` = sum of ``value`` over the row's ``group`` (NULL is a group of its
    own, as in a window) and ``share`` = value / total (0.0 when the total is 0 or NULL)."""
    totals = stage(df.groupBy(F.col(group).alias("_g")).agg(F.sum(value).alias(total), F.count(F.lit(1)).alias("_n")),
                   "group-totals", df.sparkSession)
    out = join_spread(df, totals, {group: "_g"}, "_n")
    return out.withColumn(
        share,
        F.when(F.col(total) != 0, F.col(value) / F.col(total)).otherwise(F.lit(0.0)),
    )


def pivot_sum(df: DataFrame, row: str | Sequence[str], column: str, value: str,
              values: Sequence | None = None) -> DataFrame:
    """Rows = ``row``, one column per value of ``column`` (sorted), cell = sum of
    ``value`` (NULL where no row).  The headings come from the data; ``values`` gives them
    beforehand and skips that job.  A value that is not listed then fails the query,
    rather than being left out without a word."""
    rows = [row] if isinstance(row, str) else list(row)
    if values is not None:
        unknown = F.raise_error(F.concat(F.lit(f"{column} has a value outside the given headings: "),
                                         F.coalesce(F.col(column).cast("string"), F.lit("NULL"))))
        df = df.withColumn(column, F.when(F.col(column).isin(list(values)), F.col(column)).otherwise(unknown))
    return df.groupBy(*rows).pivot(column, sorted(values) if values is not None else None).agg(F.sum(value))
