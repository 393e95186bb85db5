"""Gold kept up to date: what changed in the silver event tables since the last gold build
climbs to the ads it reaches (``operators.funnel_delta``), instead of a rebuild from all events.

* Silver builds log the rows they write (``<entity>__changes/_run=n``; ids, keys, flags and
  amounts only) and record the log's number with the silver table.
* The gold schema keeps the weighed rows of conversions, clicks and impressions, by day as
  silver has them, and the sums per ad, by linear hashing.
* ``update_rollup`` takes the runs logged since.  Of the weighed rows it reads only the days
  that can hold the touched ids (index of key blocks of bronze); it writes only those days.
* The rest of both gold tables (ads, campaigns, advertisers, ranks and shares) is of the
  dimensions' size and is built anew: one new value may change every rank of its channel.

All new rows are staged before the first table changes, and the sums per ad lose their
record of what was taken in while the tables are written.  A run that finds no record, a
silver table of another epoch (rebuilt, built without a log, or failed half-way) or a missing
log rebuilds the kept tables from silver.  A log goes once it is taken in.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators import funnel_delta as delta
from tierline.plans.places import days_holding
from tierline.rules import REGISTRY, EntityRule
from tierline.sources.tables import (PART_COL, delete_folder, drop_staged, event_day, in_partitions, merge_upsert,
                                     set_table_properties, stage, table_exists, table_properties)
from tierline.streaming.incremental import number_folders

LOG_PROPERTY = "tierline.change_log"        # of a silver table: epoch and last run logged
TAKEN_PROPERTY = "tierline.rollup_taken"    # of the sums per ad: the same, per entity
RUN_COL = "_run"


def _log_path(layout, entity: str) -> str:
    return layout.table_path("silver", f"{entity}__changes")


def _log_state(spark: SparkSession, table: str) -> dict | None:
    text = table_properties(spark, table).get(LOG_PROPERTY, "") if table_exists(spark, table) else ""
    return json.loads(text) if text else None


def log_changes(spark: SparkSession, layout, rule: EntityRule, df: DataFrame | None) -> dict[str, str]:
    """Log the rows that a silver build is about to write (None: all of a new table, which needs
    no log) and return the table properties to set when the build is complete.  Without
    ``layout.incremental_gold`` nothing is logged and the properties say so."""
    if rule.name not in delta.AMOUNTS or rule.primary_key != ("id",):
        return {}
    if not layout.incremental_gold:
        return {LOG_PROPERTY: ""}
    path, state = _log_path(layout, rule.name), _log_state(spark, layout.table("silver", rule.name))
    last = max(number_folders(spark, path, RUN_COL), default=-1)
    if state is None or last > state["run"] or df is None:   # no log so far, or a build that failed
        state = {"epoch": uuid.uuid4().hex, "run": max(last, state["run"] if state else -1)}
    run = state["run"] + 1
    if df is not None:
        delta.own_part(df, rule.name, rule.event_time).write.mode("overwrite").parquet(f"{path}/{RUN_COL}={run}")
    return {LOG_PROPERTY: json.dumps({"epoch": state["epoch"], "run": run})}


def _rollup_table(layout, entity: str) -> str:
    return layout.table("gold", f"rollup_{entity}")


def _since(spark: SparkSession, layout, now: dict, taken: dict) -> dict[str, list[int]] | None:
    """The logged runs to take in, per entity; None: they don't tell all that has changed."""
    out = {}
    for entity in delta.AMOUNTS:
        a, b = taken.get(entity), now.get(entity)
        if not a or not b or a["epoch"] != b["epoch"] or not table_exists(spark, _rollup_table(layout, entity)):
            return None
        out[entity] = list(range(a["run"] + 1, b["run"] + 1))
        if set(out[entity]) - set(number_folders(spark, _log_path(layout, entity), RUN_COL)):
            return None
    return out


def _logged(spark: SparkSession, layout, entity: str, runs: list[int], like: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Own parts from the log: the last one of each id, and all rows without an id (each of
    these was added to silver, as NULL keys match nothing)."""
    own = delta.own_part(like, entity, REGISTRY[entity].event_time)
    if not runs:
        return own.limit(0), own.limit(0)
    path = _log_path(layout, entity)
    logged = T.StructType([*own.schema.fields, T.StructField(RUN_COL, T.IntegerType())])
    rows = (spark.read.schema(logged).option("basePath", path)
            .parquet(*[f"{path}/{RUN_COL}={n}" for n in runs]))
    last = F.row_number().over(Window.partitionBy("id").orderBy(F.col(RUN_COL).desc()))
    keyed = rows.where(F.col("id").isNotNull()).withColumn("_nth", last).where(F.col("_nth") == 1)
    return keyed.drop("_nth", RUN_COL), rows.where(F.col("id").isNull()).drop(RUN_COL)


def _held(spark: SparkSession, layout, entity: str, ids: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The weighed rows of these ids, and the days they may be on (the NULL day included)."""
    rows = spark.table(_rollup_table(layout, entity))
    days = days_holding(spark, layout.bronze_path(entity), REGISTRY[entity], ids)
    if days is not None:
        days = days.unionByName(days.sparkSession.range(1).select(F.lit(None).cast("int").alias(PART_COL))).distinct()
        days = stage(days, "rollup-days", spark)
        rows = in_partitions(rows, days)
    return rows.drop(PART_COL).join(ids, "id", "left_semi"), days


def _write(spark: SparkSession, layout, entity: str, rows: DataFrame, days: DataFrame | None = None) -> None:
    name = _rollup_table(layout, entity)
    merge_upsert(spark, name, rows, "id", layout.table_path("gold", f"rollup_{entity}"),
                 partition_expr=event_day("_at"), check_unique=False,
                 keys_may_move=layout.event_keys_may_move, may_hold=days)


def _write_ads(spark: SparkSession, layout, rows: DataFrame, taken: dict) -> None:
    properties = {TAKEN_PROPERTY: json.dumps(taken)}
    merge_upsert(spark, _rollup_table(layout, "ads"), rows, "id", layout.table_path("gold", "rollup_ads"),
                 rows_per_partition=layout.rows_per_partition, check_unique=False, properties=properties)


def _rebuild(spark: SparkSession, layout, silver: dict[str, DataFrame], types: dict[str, str], now: dict) -> None:
    for entity in ("ads", *delta.AMOUNTS):      # first the one that records what was taken in
        spark.sql(f"DROP TABLE IF EXISTS {_rollup_table(layout, entity)}")
        delete_folder(spark, layout.table_path("gold", f"rollup_{entity}"))
    below = None
    for entity in delta.AMOUNTS:
        own = delta.own_part(silver[entity], entity, REGISTRY[entity].event_time)
        rows = stage(delta.weighed(own, below, types), f"rollup-{entity}", spark)
        without_id = delta.no_sums(own.where(F.col("id").isNull()), types)
        given = delta.added([delta.gives(rows, entity, types), delta.gives(without_id, entity, types)], types)
        given = stage(given, f"given-{entity}", spark)
        _write(spark, layout, entity, rows)
        drop_staged(spark, rows, *([below] if below is not None else []))
        below = given
    _write_ads(spark, layout, below, now)
    drop_staged(spark, below)


def _apply(spark: SparkSession, layout, silver: dict[str, DataFrame], types: dict[str, str],
           runs: dict[str, list[int]], now: dict) -> None:
    below, ready, used = None, [], []
    for entity in delta.AMOUNTS:
        changed, without_id = _logged(spark, layout, entity, runs[entity], silver[entity])
        ids = changed.select("id") if below is None else changed.select("id").unionByName(below.select("id"))
        ids = stage(ids.distinct(), f"touched-{entity}", spark)
        old, days = _held(spark, layout, entity, ids)
        old = stage(old, f"old-{entity}", spark)
        new = stage(delta.reweighed(old, changed, below, types), f"rollup-{entity}", spark)
        parts = [delta.gives(new, entity, types), delta.gives(old, entity, types, -1),
                 delta.gives(delta.no_sums(without_id, types), entity, types)]
        ready.append((entity, new, days))
        below = delta.added(parts, types)       # parents whose sums stay need no visit
        below = below.where(" OR ".join(f"{c} <> 0" for c in delta.SUMS))
        below = stage(below, f"given-{entity}", spark)
        used += [ids, old, new, below] + ([days] if days is not None else [])
    ads = _rollup_table(layout, "ads")
    kept = spark.table(ads).drop(PART_COL)
    sums = stage(delta.added([kept.join(below.select("id"), "id", "left_semi"), below], types), "rollup-ads", spark)
    set_table_properties(spark, ads, {TAKEN_PROPERTY: ""})
    for entity, new, days in ready:
        _write(spark, layout, entity, new, days)
    _write_ads(spark, layout, sums, now)
    drop_staged(spark, *used, sums)


def update_rollup(spark: SparkSession, layout, silver: dict[str, DataFrame]) -> DataFrame:
    """Take what has changed in the silver event tables into the kept sums; returns what
    reaches each ad, as the dimension ends of the gold operators take it."""
    types = delta.sum_types(silver)
    now = {e: _log_state(spark, layout.table("silver", e)) for e in delta.AMOUNTS}
    ads = _rollup_table(layout, "ads")
    text = table_properties(spark, ads).get(TAKEN_PROPERTY, "") if table_exists(spark, ads) else ""
    taken = json.loads(text) if text else {}
    runs = _since(spark, layout, now, taken)
    if runs is None:
        _rebuild(spark, layout, silver, types, now)
    elif any(runs.values()):
        _apply(spark, layout, silver, types, runs, now)
    for entity, at in now.items():
        for n in number_folders(spark, _log_path(layout, entity), RUN_COL):
            if at and n <= at["run"]:
                delete_folder(spark, f"{_log_path(layout, entity)}/{RUN_COL}={n}")
    return delta.as_ad_level(spark.table(ads))
