"""Mixing sources to target weights by hierarchical budgeting (built-in functions only).

Leaves are the value combinations of the tree's columns, say domain, language, source.
The token budget goes down the tree.  At a node, children get shares in proportion to
their weights, but no child more than it can give (its leaves' tokens times the epochs
allowed); what a short child leaves goes to its siblings, and only what a whole node
can't give goes on to the siblings of the node.  That is one water level per node, found
in closed form by a window over its children in order of capacity per weight.

A leaf's order is seeded by epoch: rows follow the MD5 of (seed, epoch, id).  Whole
epochs take every row; the last one takes the rows up to the token target.  The cut is
found by token sums of 4,096 hash buckets per leaf and then inside one bucket, so a leaf
with a third of all rows is never sorted in one task.  Rows are then kept by comparing
their hash with the leaf's cut.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.llm.common import drop_staged, stage

BUCKET_DIGITS = 3   # leading hex digits of the hash: 4,096 buckets per leaf
NONE = "(none)"     # a NULL level


def word_tokens(text_col: str = "text") -> Column:
    """Words of a text (runs without ASCII white space) as its token measure."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def _weight(level: str, weights: Mapping[str, int], default: int) -> Column:
    out = F.lit(default)
    for value, w in weights.items():
        out = F.when(F.col(level) == value, F.lit(int(w))).otherwise(out)
    return out.cast("long")


def _order(seed: int, epoch: Column) -> Column:
    return F.md5(F.concat_ws("-", F.lit(str(seed)), epoch.cast("string"), F.col("doc_id").cast("string"))
                 .cast("binary"))


def share_out(children: DataFrame, parent: Sequence[str], level: str) -> DataFrame:
    """``children(parent..., level, weight, capacity, target)``, where target is the
    parent's budget: each child's ``budget`` under one water level per parent."""
    order = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("weight"), level)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    able = (children.where("weight > 0")
            .withColumn("rise", (F.col("target") - F.coalesce(F.sum("capacity").over(before), F.lit(0)))
                        / F.sum("weight").over(onward)))
    unfilled = F.when(F.col("capacity") / F.col("weight") > F.col("rise"), F.col("rise"))
    able = able.withColumn("water", F.max(unfilled).over(Window.partitionBy(*parent)))
    budget = F.when(F.col("water").isNull(), F.col("capacity")).otherwise(
        F.least("capacity", F.floor(F.col("water") * F.col("weight"))))
    return able.withColumn("budget", F.greatest(budget, F.lit(0)).cast("long")).drop("rise", "water")


def _plan(spark: SparkSession, slim: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]],
          default_weight: int, share: float, epochs: int, seed: int) -> DataFrame:
    """One row per leaf with a budget: ``levels..., whole`` (whole epochs) and ``cut``
    (largest hash taken in the next epoch)."""
    leaves = stage(spark, slim.groupBy(*levels).agg(F.sum("tokens").alias("size"))
                   .withColumn("capacity", F.col("size") * epochs), "op7-leaves")
    top = leaves.agg(F.coalesce(F.floor(F.sum("size") * F.lit(float(share))), F.lit(0)).alias("t")).first().t
    budgets = None
    for depth, level in enumerate(levels):
        path = list(levels[:depth + 1])
        nodes = (leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
                 .withColumn("weight", _weight(level, weights.get(level, {}), default_weight)))
        if budgets is None:
            nodes, parent = nodes.withColumn("target", F.lit(int(top)).cast("long")).withColumn("root", F.lit(0)), ["root"]
        else:
            nodes, parent = nodes.join(budgets.withColumnRenamed("budget", "target"), path[:-1]), path[:-1]
        budgets = share_out(nodes, parent, level).select(*path, "budget")
    leaf = stage(spark, budgets.join(leaves.select(*levels, "size"), list(levels)).where("size > 0")
                 .withColumn("whole", F.floor(F.col("budget") / F.col("size")))
                 .withColumn("rest", F.col("budget") - F.col("whole") * F.col("size")), "op7-budgets")

    keyed = (slim.join(leaf.where("rest > 0"), list(levels))
             .select(*levels, "rest", "tokens", _order(seed, F.col("whole")).alias("key"))
             .withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS)))
    sums = keyed.groupBy(*levels, "rest", "bucket").agg(F.sum("tokens").alias("in_bucket"))
    upto = Window.partitionBy(*levels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    edge = (sums.withColumn("through", F.sum("in_bucket").over(upto))
            .withColumn("before", F.col("through") - F.col("in_bucket")))
    # The bucket in which the target falls; the buckets before it are whole.
    edge = edge.where("before <= rest AND through > rest").select(*levels, "bucket", "before")
    run = Window.partitionBy(*levels, "bucket").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    inner = (keyed.join(edge, [*levels, "bucket"])
             .withColumn("through", F.col("before") + F.sum("tokens").over(run)))
    cuts = inner.groupBy(*levels).agg(F.max(F.when(F.col("through") <= F.col("rest"), F.col("key"))).alias("inside"),
                                      F.first("bucket").alias("edge_bucket"))
    plan = (leaf.join(cuts, list(levels), "left")
            .select(*levels, "whole", F.coalesce("inside", "edge_bucket").alias("cut")))
    out = stage(spark, plan, "op7-plan")
    drop_staged(spark, leaves, leaf)
    return out


def reachable_share(docs: DataFrame, level: Column, weights: Mapping[str, int], epochs: int = 1,
                    tokens: Column | None = None, default_weight: int = 1) -> float:
    """The largest ``share`` for ``mix_sources`` at which the values of the tree's first
    level that ``weights`` lists still stand in the ratio of their weights: none of those
    that have tokens at all is short within ``epochs`` passes.  Values that are not listed
    (NULL among them) give at most what they have.  1.0 where no listed value has tokens."""
    measure = word_tokens() if tokens is None else F.coalesce(tokens, F.lit(0)).cast("long")
    sizes = (docs.groupBy(F.coalesce(level.cast("string"), F.lit(NONE)).alias("value"))
             .agg(F.sum(measure).alias("size")).where("size > 0")
             .withColumn("weight", _weight("value", weights, default_weight)).where("weight > 0"))
    sizes = stage(docs.sparkSession, sizes, "mix-sizes")
    capacity, listed = F.col("size") * epochs, F.col("value").isin(*weights)
    level_at = sizes.where(listed).agg(F.min(capacity / F.col("weight")).alias("l")).first().l
    if level_at is None:
        drop_staged(docs.sparkSession, sizes)
        return 1.0
    given = F.least(capacity.cast("double"), F.lit(float(level_at)) * F.col("weight"))
    r = sizes.agg(F.sum(given).alias("given"), F.sum("size").alias("size")).first()
    drop_staged(docs.sparkSession, sizes)
    return r.given / r.size


def mix_sources(spark: SparkSession, docs: DataFrame, levels: Mapping[str, Column],
                weights: Mapping[str, Mapping[str, int]], share: float, epochs: int = 1, seed: int = 17,
                tokens: Column | None = None, default_weight: int = 1, id_col: str = "doc_id") -> DataFrame:
    """The chosen rows of ``docs`` with all their columns and ``mix_epoch`` (0 for the
    first pass), ``mix_tokens`` and one ``mix_<level>`` column per level.

    ``levels``: name -> expression, from the root's children to the leaves; a NULL is the
    value "(none)".  ``weights``: level -> value -> whole weight (others:
    ``default_weight``; 0 takes nothing).  ``share``: token budget as a share of the
    tokens there are; what the tree can't give within ``epochs`` passes stays unused.
    ``tokens``: measure of a row, by default its words; a NULL text has none and goes with
    any epoch that reaches its hash.  Rows that repeat an id share a hash and go together;
    a NULL id is one more id.  A leaf without tokens gives no rows.  An input column named
    like one of the result's is replaced by it.
    """
    names = [f"mix_{n}" for n in levels]
    slim_cols = [F.coalesce(e.cast("string"), F.lit(NONE)).alias(f"mix_{n}") for n, e in levels.items()]
    measure = word_tokens() if tokens is None else F.coalesce(tokens, F.lit(0)).cast("long")
    slim = stage(spark, docs.select(F.col(id_col).alias("doc_id"), measure.alias("tokens"), *slim_cols), "op7-slim")
    plan = _plan(spark, slim, names, {f"mix_{n}": w for n, w in weights.items()}, default_weight, share, epochs, seed)
    drop_staged(spark, slim)

    out_names = ["mix_epoch", "mix_tokens", *names]
    own = [c for c in docs.columns if c not in out_names]
    rows = docs.select(F.struct(*own).alias("row"), F.col(id_col).alias("doc_id"), measure.alias("mix_tokens"),
                       *slim_cols).join(plan, names)
    # A cut at a bucket's name takes the buckets before it: any key in the bucket is greater.
    part = F.coalesce(_order(seed, F.col("whole")) <= F.col("cut"), F.lit(False)).cast("long")
    return (rows.withColumn("taken", F.col("whole") + part).where("taken > 0")
            .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("taken") - 1)))
            .select("row.*", *out_names))
