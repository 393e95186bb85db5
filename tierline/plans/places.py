"""The days on which an event table may hold given keys, found without reading its other days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.silver import clean_columns
from tierline.rules import EntityRule
from tierline.sources.key_places import loads_of, update_index
from tierline.sources.tables import PART_COL, event_day, stage
from tierline.streaming.incremental import BATCH_COL, read_bronze

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def days_of(spark: SparkSession, rule: EntityRule, rows: DataFrame) -> DataFrame | None:
    """The days on which silver may hold the keys of these bronze rows: each key's silver row
    came from one of them.  None where a cast or trim can turn two bronze keys into one
    (keys other than whole numbers), as then other keys' rows count too."""
    silver = clean_columns(rows, rule, try_cast=True)
    if spark.conf.get("spark.sql.ansi.enabled") != "true" or not all(
            isinstance(df.schema[k].dataType, _WHOLE) for df in (rows, silver) for k in rule.primary_key):
        return None
    return stage(silver.select(event_day(rule.event_time).alias(PART_COL)).distinct(), "silver-days", spark)


def days_holding(spark: SparkSession, path: str, rule: EntityRule, ids: DataFrame) -> DataFrame | None:
    """``days_of`` all bronze rows, at ``path``, of the keys in ``ids``; the index of key blocks
    names the loads to read.  None as in ``days_of``."""
    keys, bronze = list(rule.primary_key), read_bronze(spark, path, keep_batch=True)
    if not all(isinstance(bronze.schema[k].dataType, _WHOLE) for k in keys):
        return None
    loads = loads_of(spark, update_index(spark, path, bronze, keys), ids, keys)
    held = bronze.where(F.col(BATCH_COL).isin(loads)).join(ids.select(*keys), keys, "left_semi")
    return days_of(spark, rule, held.drop(BATCH_COL))
