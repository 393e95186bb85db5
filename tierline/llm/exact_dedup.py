"""Exact deduplication by content sort (built-in functions only).

Rows are range-partitioned by sampled splitters on the leading bytes of the text and its
64-bit fingerprint, so the keys that Spark samples to the driver are a few dozen bytes,
not texts.  An external sort within each range then puts equal texts next to each other,
and the window over that order compares neighbours on the full text.

A text with more rows than a fraction of one range (``heavy``) is dealt over several runs
by a hash of its id.  There are at most 4 x partitions such texts, because each holds
over 1/(4 x partitions) of the rows; their runs' heads are sorted and compared by full
text once more, and the outcome of at most 8 x partitions runs is broadcast to the rows.
The result doesn't depend on that split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.llm.common import partitions, stage

PREFIX = 32  # leading bytes in the range key


def exact_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                normalise: Column | None = None, keep: str = "max") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after ``normalise`` (an expression of the text; none:
    unchanged).  Of equal texts the row with the largest (``keep="max"``) or smallest id
    stays.  NULL text counts as empty, and empty texts are equal to each other.  A NULL
    id gives way to any other id; if all ids of a group are NULL, or the winning id is
    repeated, exactly one of those rows is kept.  Other columns are ignored; an empty
    table gives no rows.
    """
    if keep not in ("max", "min"):
        raise ValueError("keep is 'max' or 'min'")
    p = partitions(spark)
    text = F.coalesce(F.col(text_col) if normalise is None else normalise, F.lit("")).cast("string")
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("h", F.xxhash64("text"))

    share = max(1, -(-docs.count() // (4 * p)))   # rows a run may hold; at least 1/(4p) of all
    heavy = stage(spark, base.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > share)
                  .select("h", F.ceil(F.col("n") / share).cast("int").alias("runs")), "op1-heavy")

    spread = (base.join(F.broadcast(heavy), "h", "left")   # at most 4 x partitions rows
              .withColumn("runs", F.coalesce("runs", F.lit(1)))
              .withColumn("run", F.pmod(F.xxhash64("doc_id", F.lit("run")), F.col("runs")).cast("int"))
              .withColumn("head", F.substring(F.col("text").cast("binary"), 1, PREFIX)))
    ranged = spread.repartitionByRange(p, "head", "h", "run")
    best = F.col("doc_id").desc_nulls_last() if keep == "max" else F.col("doc_id").asc_nulls_last()
    same = Window.partitionBy("head", "h", "run", "text")
    runs = (ranged
            .withColumn("rn", F.row_number().over(same.orderBy(best)))
            .withColumn("run_keep", F.first("doc_id").over(same.orderBy(best)))
            .withColumn("run_size", F.count(F.lit(1)).over(same))
            .select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "run", "runs", "rn",
                    "run_keep", "run_size",
                    F.when((F.col("runs") > 1) & (F.col("rn") == 1), F.col("text")).alias("head_text")))
    rows = stage(spark, runs, "op1-runs")

    # Heads of the runs of heavy texts: at most 8 x partitions rows.
    again = Window.partitionBy("head_text")
    run_best = F.col("run_keep").desc_nulls_last() if keep == "max" else F.col("run_keep").asc_nulls_last()
    heads = (rows.where(F.col("head_text").isNotNull())
             .select("text_sha256", "run", "run_keep", "run_size", "head_text")
             .withColumn("place", F.row_number().over(again.orderBy(run_best, "run")))
             .withColumn("group_keep", F.first("run_keep").over(again.orderBy(run_best, "run")))
             .withColumn("all_rows", F.sum("run_size").over(again))
             .select("text_sha256", "run", "place", "group_keep", "all_rows"))
    out = rows.drop("head_text").join(F.broadcast(heads), ["text_sha256", "run"], "left")
    split = F.col("place").isNotNull()
    return out.select(
        "doc_id",
        F.when(split, F.col("group_keep")).otherwise(F.col("run_keep")).alias("keep_id"),
        F.when(split, F.col("all_rows")).otherwise(F.col("run_size")).cast("long").alias("group_size"),
        ((F.col("rn") == 1) & (F.coalesce("place", F.lit(1)) == 1)).alias("kept"),
        "text_sha256")
