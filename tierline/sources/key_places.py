"""Where keys live: an index of key blocks per load of a bronze dataset.

A daily run needs all rows, old ones too, of the keys that came today.  The index holds one
row per (block of neighbouring keys, load), so the run reads the loads that share a block
with today's keys and no others.  Keys that grow with time fall into few blocks a load: the
index of a trillion dense whole numbers has some fifteen million rows.  Keys without order
(random strings) have a block each; then the index is about as large as the key column, and
the loads found are those that hold the keys.  Blocks that two keys share by chance only
cost a needless read.

The index lies below the dataset (``_key_blocks/<key columns and types>``), one partition a
load.  A key column whose type grows gets an index of its own, built from all loads.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.sources.tables import event_day
from tierline.streaming.incremental import BATCH_COL, number_folders

INDEX_DIR, BLOCK_COL, DONE = "_key_blocks", "_block", "_upto"
BLOCK = 65_536      # whole numbers of one block
TAIL = 4            # characters at a string's end that its block leaves out


def _block_part(name: str, dtype: T.DataType) -> Column:
    c = F.col(name)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.expr(f"`{name}` div {BLOCK}")
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.floor(c / F.lit(BLOCK))
    if isinstance(dtype, T.StringType):
        return F.substring(c, F.lit(1), F.greatest(F.length(c) - F.lit(TAIL), F.lit(0)))
    return event_day(name) if isinstance(dtype, T.TimestampType) else c


def key_block(df: DataFrame, keys: list[str]) -> Column:
    """The block of a row's key; equal keys have equal blocks."""
    return F.xxhash64(*[_block_part(k, df.schema[k].dataType) for k in keys])


def _index_path(path: str, bronze: DataFrame, keys: list[str]) -> str:
    name = "-".join(f"{k}.{bronze.schema[k].dataType.simpleString()}" for k in keys)
    return f"{path.rstrip('/')}/{INDEX_DIR}/{re.sub('[^A-Za-z0-9._-]', '_', name)}"


def update_index(spark: SparkSession, path: str, bronze: DataFrame, keys: list[str]) -> str:
    """Enter the loads that the index lacks; returns its folder.  What is entered is marked
    after the write, so a run that fails before that enters the same loads again."""
    index = _index_path(path, bronze, keys)
    upto = max(number_folders(spark, index, DONE), default=-1)
    loads = [n for n in number_folders(spark, path, BATCH_COL) if n > upto]
    if loads:
        rows = bronze.where(F.col(BATCH_COL).between(loads[0], loads[-1])).select(
            key_block(bronze, keys).alias(BLOCK_COL), BATCH_COL).distinct()
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH_COL).parquet(index))
        mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{index}/{DONE}={loads[-1]}")
        mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(mark)
    return index


def loads_of(spark: SparkSession, index: str, touched: DataFrame, keys: list[str]) -> list[int]:
    """The loads that may hold the keys of ``touched`` (a number a load reaches the driver)."""
    if not number_folders(spark, index, BATCH_COL):
        return []
    blocks = touched.select(key_block(touched, keys).alias(BLOCK_COL)).distinct()
    entries = spark.read.schema(f"{BLOCK_COL} bigint, {BATCH_COL} bigint").parquet(index)
    return sorted(r[0] for r in entries.join(blocks, BLOCK_COL, "left_semi").select(BATCH_COL).distinct().collect())
