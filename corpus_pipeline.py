"""Training-text pipeline: documents to packed sequences.

``STAGES`` lists (name, function) in order; each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``documents``.

1. toxicity: documents that the toxicity model rejects go.  The model learns from the
   labels table's training rows and the documents given.
2. line_dedup: blocks of lines that an earlier document has go; documents left without
   words by that go with them.
3. near_dedup: of each group of near duplicates (five-word shingles, similarity 0.8 or
   more) the document with the smallest id stays, and of rows that repeat its id and text
   one row.
4. mixing: documents are chosen to target weights over domain, language and source, in
   one epoch, so no document comes twice.  The token budget is the largest one at which the
   domains still stand in the ratio asked for.
5. packing: token sequences whose lengths are powers of two.

A NULL text counts as empty throughout and such a document is kept by the filters; a NULL
id is kept by the filters and takes no part in comparisons; empty tables pass through.
Columns beyond those of ``documents`` are dropped at the start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import read_table, ship_package, stage
from tierline.llm.line_dedup import drop_repeated_lines
from tierline.llm.minhash import near_duplicates
from tierline.llm.mixing import mix_sources, reachable_share
from tierline.llm.packing import pack_documents
from tierline.llm.queries import MIX_SEED, MIX_WEIGHTS, held_out, mix_levels
from tierline.llm.toxicity import keep_clean, learn

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: SQL can express neither the tokenizer nor the fitted model: tests use brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = docs.select(*COLUMNS)
    model = learn(spark, docs, read_table(spark, sf_dir, "labels"), ~held_out())
    return keep_clean(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return drop_repeated_lines(spark, docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = docs.select(*COLUMNS)
    gone = near_duplicates(spark, docs, percent=80).where("NOT kept").select("doc_id")
    kept = docs.join(stage(spark, gone, "near-gone"), "doc_id", "left_anti").select(*COLUMNS)
    again = stage(spark, docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"),
                  "near-repeated-ids")
    one = (kept.join(again, "doc_id", "left_semi").select(*COLUMNS)
           .groupBy("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
           .agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("row")).select("doc_id", "row.*"))
    return kept.join(again, "doc_id", "left_anti").select(*COLUMNS).union(one.select(*COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, levels = docs.select(*COLUMNS), mix_levels()
    share = reachable_share(docs, levels["domain"], MIX_WEIGHTS["domain"])
    return mix_sources(spark, docs, levels, MIX_WEIGHTS, share, epochs=1, seed=MIX_SEED).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return pack_documents(docs.select("doc_id", "text"))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing),
          ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to shared storage and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(spark, step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
