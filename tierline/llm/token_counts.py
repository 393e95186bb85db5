"""Token counts from an exact length histogram.

Documents are counted by encoded length, which a partial sum shrinks to one row per
distinct length and task before the shuffle.  Suffix sums over that histogram then give,
for any context limit, how many documents and tokens there are, the length quantiles,
and the tokens that remain when longer documents are truncated to the limit.  The sums
run in two levels (spans of ``SPAN`` lengths, then the lengths of a span), so no task
gets the histogram of very long lengths whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.llm.common import binary_parts, slices, stage, text_bytes, tidied
from tierline.llm.tokens import default_tokenizer, encoder

SPAN = 128


def _lengths(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                _, at = encoder(path).encode(*binary_parts(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("grp"), pa.array(np.diff(at))], names=["grp", "length"])

    return tidied(run)


def length_histogram(docs: DataFrame, group_col: str = "lang", text_col: str = "text",
                     tokenizer: str | None = None) -> DataFrame:
    """``(grp, length, docs)``: documents by encoded length, without special tokens.
    NULL text counts as empty (length 0); a NULL group stays a group of its own."""
    base = docs.select(F.col(group_col).cast("string").alias("grp"), text_bytes(text_col).alias("text"))
    return (base.mapInArrow(_lengths(tokenizer or default_tokenizer()), "grp string, length long")
            .groupBy("grp", "length").agg(F.count(F.lit(1)).alias("docs")))


def limit_table(histogram: DataFrame) -> DataFrame:
    """From ``(grp, length, docs)``, one row per group and distinct length, read as a
    context limit: ``docs`` of that length, ``docs_longer``, ``docs_total``,
    ``tokens_total``, ``tokens_longer`` (tokens of longer documents), ``truncated_total``
    (tokens left when every document is cut to the limit) and ``quantile`` (share of
    documents of at most that length).  Any other limit L is answered by the largest
    length below it (see ``answer``)."""
    spanned = histogram.withColumn("span", F.floor(F.col("length") / SPAN)).withColumn(
        "tokens", F.col("length") * F.col("docs"))
    sums = spanned.groupBy("grp", "span").agg(F.sum("docs").alias("span_docs"), F.sum("tokens").alias("span_tokens"))
    later = Window.partitionBy("grp").orderBy("span").rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy("grp")
    sums = sums.select(
        "grp", "span",
        F.coalesce(F.sum("span_docs").over(later), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("span_tokens").over(later), F.lit(0)).alias("tokens_after"),
        F.sum("span_docs").over(whole).alias("docs_total"), F.sum("span_tokens").over(whole).alias("tokens_total"))
    within = Window.partitionBy("grp", "span").orderBy("length").rowsBetween(1, Window.unboundedFollowing)
    out = (spanned.withColumn("more_docs", F.coalesce(F.sum("docs").over(within), F.lit(0)))
           .withColumn("more_tokens", F.coalesce(F.sum("tokens").over(within), F.lit(0))))
    s = sums.select(F.col("grp").alias("g"), F.col("span").alias("s"), "docs_after", "tokens_after", "docs_total",
                    "tokens_total")
    out = out.join(s, out.grp.eqNullSafe(s.g) & (out.span == s.s))
    docs_longer = F.col("more_docs") + F.col("docs_after")
    tokens_longer = F.col("more_tokens") + F.col("tokens_after")
    return out.select(
        "grp", "length", "docs", docs_longer.alias("docs_longer"), "docs_total", "tokens_total",
        tokens_longer.alias("tokens_longer"),
        (F.col("tokens_total") - tokens_longer + F.col("length") * docs_longer).alias("truncated_total"),
        ((F.col("docs_total") - docs_longer) / F.col("docs_total")).alias("quantile"))


def answer(limits: DataFrame, limit: int) -> DataFrame:
    """Per group, totals under one context limit, whether or not a document has that
    length: ``grp, docs_total, tokens_total, docs_longer, truncated_total``."""
    below = F.col("length") <= limit
    longer = F.coalesce(F.min(F.when(below, F.col("docs_longer"))), F.max("docs_total"))
    tokens = F.coalesce(F.min(F.when(below, F.col("tokens_longer"))), F.max("tokens_total"))
    return (limits.groupBy("grp").agg(F.max("docs_total").alias("docs_total"),
                                      F.max("tokens_total").alias("tokens_total"),
                                      longer.alias("docs_longer"), tokens.alias("_tokens"))
            .select("grp", "docs_total", "tokens_total", "docs_longer",
                    (F.col("tokens_total") - F.col("_tokens") + limit * F.col("docs_longer")).alias("truncated_total")))


def quantile_length(limits: DataFrame, q: float) -> DataFrame:
    """Per group, the smallest length that a share ``q`` of the documents doesn't exceed."""
    return limits.where(F.col("quantile") >= q).groupBy("grp").agg(F.min("length").alias("length"))


def token_counts(spark: SparkSession, docs: DataFrame, group_col: str = "lang", text_col: str = "text",
                 tokenizer: str | None = None) -> DataFrame:
    """``limit_table`` of ``docs`` per group and, as group ``*``, over all documents.  The
    histogram is written once, so texts are encoded once.  An empty table gives no rows."""
    counts = stage(spark, length_histogram(docs, group_col, text_col, tokenizer), "op9-histogram")
    everything = (counts.groupBy("length").agg(F.sum("docs").alias("docs"))
                  .select(F.lit("*").alias("grp"), "length", "docs"))
    return limit_table(counts.unionByName(everything))
