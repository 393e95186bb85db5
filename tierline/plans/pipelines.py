"""Pipelines: bronze load (L1), silver build (L2), the gold tables (L3, L4) and the
run-all orchestration with a summary table (L5).

Every table lives below one ``base`` folder on shared storage (``Layout``): landing
JSON, and catalog tables for bronze, silver and gold in the schemas ``bronze_<domain>``, ``silver_<domain>``, ``gold_<domain>``.
"""

from __future__ import annotations

import datetime as _dt
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators import funnel
from tierline.operators.quality import event_window
from tierline.operators.silver import build_silver
from tierline.plans.gold_updates import log_changes, update_rollup
from tierline.plans.places import days_of
from tierline.rules import REGISTRY, EntityRule, FkCheck, build_order, get_rule
from tierline.sources.key_places import loads_of, update_index
from tierline.sources.landing import land_json
from tierline.sources.tables import (PART_COL, drop_staged, ensure_schemas, event_day, in_partitions, merge_upsert,
                                     observed, overwrite_table, set_table_properties, stage, table_exists,
                                     table_properties, table_rows)
from tierline.streaming.incremental import (BATCH_COL, has_schema, latest_load, load_new_files, loaded_rows, read_bronze,
                                            record_empty, register_bronze)


@dataclass(frozen=True)
class Layout:
    base: str
    domain: str = "ads"
    # Dimensions are partitioned by linear hashing of the key: a partition is divided when
    # the table holds more than this many rows a partition.
    rows_per_partition: int = 1_000_000
    # An event id may reappear on another day (ids restart daily in the source feed), so
    # each upsert also finds the days already holding the incoming ids.  False: skip it.
    event_keys_may_move: bool = True
    # Explicit hot-key splitting in FK checks (off: leave hot keys to AQE's skew join).
    split_hot_fk_keys: bool = False
    # Gold from sums kept per event row and ad, brought up to date with what silver changed
    # (plans.gold_updates).  False: from all events each time.
    incremental_gold: bool = False

    @property
    def landing(self) -> str:
        return f"{self.base.rstrip('/')}/landing_{self.domain}"

    def bronze_path(self, entity: str) -> str:
        return f"{self.base.rstrip('/')}/bronze_{self.domain}/{entity}"

    def schema(self, layer: str) -> str:
        return f"{layer}_{self.domain}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.schema(layer)}.{name}"

    def table_path(self, layer: str, name: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}_{self.domain}.db/{name}"


LAYER_COMMENTS = {
    "bronze": "raw entities as landed, schema inferred and growing",
    "silver": "typed, deduplicated and validated entities",
    "gold": "business aggregates rebuilt in full each run",
}


def setup_schemas(spark: SparkSession, layout: Layout) -> list[str]:
    return ensure_schemas(spark, {layout.schema(k): v for k, v in LAYER_COMMENTS.items()},
                          location_root=layout.base)


def bronze_load(spark: SparkSession, layout: Layout, entity: str, source: DataFrame,
                run_date: str | _dt.date | None = None, registry: dict[str, EntityRule] | None = None) -> int:
    """L1: land ``source`` as JSON Lines for ``run_date``, load the new files into the
    entity's bronze dataset and list it in the catalog.  Returns the rows the bronze
    table holds, as its loads recorded them."""
    get_rule(entity, registry)
    land_json(source, layout.landing, entity, run_date)
    path = layout.bronze_path(entity)
    load_new_files(spark, f"{layout.landing}/{entity}", path)
    if not has_schema(spark, path):       # nothing but empty files so far
        record_empty(spark, path, source)
    register_bronze(spark, layout.table("bronze", entity), path)
    return loaded_rows(spark, path)


# Table property: what a silver table has taken in.  Under its own name the last load of its
# bronze dataset; under ``silver:<parent>`` the last load that the parent's silver table had
# taken in when this table's flags were set.
SEEN_PROPERTY = "tierline.seen_loads"


def _seen(spark: SparkSession, table: str) -> dict[str, int]:
    return json.loads(table_properties(spark, table).get(SEEN_PROPERTY, "{}")) if table_exists(spark, table) else {}


def _available(spark: SparkSession, layout: Layout, rule: EntityRule) -> dict[str, int]:
    """What a build of this entity could take in now."""
    out = {rule.name: latest_load(spark, layout.bronze_path(rule.name))}
    for fk in rule.fk_checks:
        out[f"silver:{fk.parent}"] = _seen(spark, layout.table("silver", fk.parent)).get(fk.parent, -1)
    return out


def _pending_table(layout: Layout, rule: EntityRule, fk: FkCheck) -> str:
    return layout.table("silver", f"{rule.name}__pending_{'_'.join(fk.child_columns)}")


def _parent_keys(spark: SparkSession, layout: Layout, fk: FkCheck) -> DataFrame:
    """The parent's silver table; before it is built, no keys."""
    table = layout.table("silver", fk.parent)
    if table_exists(spark, table):
        return spark.table(table)
    return spark.createDataFrame([], ", ".join(f"`{k}` bigint" for k in fk.parent_keys))


def _touched_rows(spark: SparkSession, layout: Layout, rule: EntityRule, bronze: DataFrame,
                  seen: dict) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bronze rows, old and new, of the keys that have a new row (of rows with a NULL key
    only the new ones: such rows never match in an upsert); the old ones of them and the
    keys, staged.  The index of key blocks names the loads that may hold them; no others
    are read, and those once."""
    keys, path = list(rule.primary_key), layout.bronze_path(rule.name)
    fresh = bronze.where(F.col(BATCH_COL) > seen[rule.name])
    touched = stage(fresh.select(*keys).dropDuplicates().dropna(), "silver-keys", spark)
    loads = loads_of(spark, update_index(spark, path, bronze, keys), touched, keys)
    old = bronze.where(F.col(BATCH_COL).isin([n for n in loads if n <= seen[rule.name]]))
    again = stage(old.join(touched, keys, "left_semi"), "silver-again", spark)
    return fresh.unionByName(again), again, touched


def _healed_rows(spark: SparkSession, layout: Layout, rule: EntityRule, seen: dict, loads: dict,
                 touched: DataFrame | None) -> DataFrame | None:
    """Silver rows of keys not in ``touched`` whose orphan flags end because a parent has arrived since:
    the newly arrived parent keys meet the pending orphans only, and of silver only the
    rows (of event tables: the days) that waited for them are read."""
    keys, found = list(rule.primary_key), None
    for fk in rule.fk_checks:
        since, now = seen[f"silver:{fk.parent}"], loads[f"silver:{fk.parent}"]
        if now <= since:
            continue
        arrived = (read_bronze(spark, layout.bronze_path(fk.parent), keep_batch=True)
                   .where((F.col(BATCH_COL) > since) & (F.col(BATCH_COL) <= now))
                   .select(*[F.col(k).alias(f"_pk_{i}") for i, k in enumerate(fk.parent_keys)]).distinct())
        cond = F.lit(True)
        for i, c in enumerate(fk.child_columns):
            cond = cond & (F.col(c) == F.col(f"_pk_{i}"))
        hit = spark.table(_pending_table(layout, rule, fk)).join(arrived, cond).select(
            *keys, PART_COL, F.lit(fk.flag).alias("_flag"))
        found = hit if found is None else found.unionByName(hit)
    if found is None:
        return None
    found = stage(found if touched is None else found.join(touched, keys, "left_anti"), "silver-healed", spark)
    rows = spark.table(layout.table("silver", rule.name))
    if rule.event_time:     # the index is partitioned by day as the table is
        rows = in_partitions(rows, stage(found.select(PART_COL).distinct(), "silver-healed-days", spark))
    flags = found.groupBy(*keys).agg(F.collect_set("_flag").alias("_ended"))
    rows = rows.join(flags, keys)
    ended = {fk.flag: F.col(fk.flag) & ~F.array_contains("_ended", fk.flag) for fk in rule.fk_checks}
    return rows.withColumns(ended).drop("_ended", PART_COL)


def silver_build(spark: SparkSession, layout: Layout, entity: str,
                 registry: dict[str, EntityRule] | None = None) -> dict:
    """L2: bronze -> dedup -> FK flags (against the parents' silver tables) -> casts ->
    named transforms -> trim -> upsert into the silver table.

    The first run takes all of bronze.  Later runs take the keys with new rows, with all
    their bronze rows (from the loads that an index of key blocks names; the days that may
    hold them in silver are those of these rows), and the orphans whose parent has come since into the parent's silver
    table.  Those are found in ``<entity>__pending_<fk>``, a table of the unresolved foreign
    keys and the rows that wait for them.  So the result equals a full rebuild in whatever
    order entities are built (a parent not built yet has no keys; the next run after it is
    built ends the flags), and days without such keys are not rewritten.  What was taken in
    is recorded with the table last; a run that fails before that takes it again.

    Returns ``rows`` (the silver table's), ``rows_written``, ``duplicates_removed`` and
    ``orphans`` (of the bronze rows taken in this run)."""
    rule = get_rule(entity, registry)
    table, keys = layout.table("silver", entity), list(rule.primary_key)
    bronze = read_bronze(spark, layout.bronze_path(entity), keep_batch=True)
    loads, seen = _available(spark, layout, rule), _seen(spark, table)
    known = all(n in seen for n in loads) and all(
        table_exists(spark, _pending_table(layout, rule, fk)) for fk in rule.fk_checks)
    if known and all(seen[n] >= loads[n] for n in loads):
        return {"rows": table_rows(spark, table), "rows_written": 0, "duplicates_removed": 0, "orphans": 0}
    healed = days = again = touched = None
    if known:
        fresh = seen[entity] < loads[entity]
        if fresh:
            bronze, again, touched = _touched_rows(spark, layout, rule, bronze, seen)
        else:               # only parents have come
            bronze = bronze.limit(0)
        if rule.event_time and layout.event_keys_may_move:
            days = days_of(spark, rule, bronze.drop(BATCH_COL))
        healed = _healed_rows(spark, layout, rule, seen, loads, touched)
    before, after = {}, {}
    if known and not fresh:
        df = stage(healed, f"silver-{entity}", spark)
    else:
        parents = {fk.parent: _parent_keys(spark, layout, fk) for fk in rule.fk_checks}
        taken, kept = Observation(f"taken_{entity}"), Observation(f"kept_{entity}")
        raw = bronze.drop(BATCH_COL).observe(taken, F.count(F.lit(1)).alias("rows"))
        df = build_silver(raw, rule, parents,
                          fk_options={"split_hot_keys": True} if layout.split_hot_fk_keys else None)
        flags = [F.count_if(F.col(fk.flag)).alias(fk.flag) for fk in rule.fk_checks]
        df = df.observe(kept, F.count(F.lit(1)).alias("rows"), *flags)
        if healed is not None:
            df = df.unionByName(healed, allowMissingColumns=True)
        df = stage(df, f"silver-{entity}", spark)
        before, after = observed(taken), observed(kept)
    if rule.event_time:  # events: partition by UTC day, so a daily load touches recent days
        layout_args = {"partition_expr": event_day(rule.event_time), "sort_within": [rule.event_time],
                       "keys_may_move": layout.event_keys_may_move, "may_hold": days}
    else:                # dimensions: linear hashing of the key
        layout_args = {"rows_per_partition": layout.rows_per_partition}
    # dedup on the primary key already leaves one row per key: no second pass to check it
    unique = tuple(rule.dedup_keys) == tuple(rule.primary_key)
    log = log_changes(spark, layout, rule, df if table_exists(spark, table) else None)
    result = merge_upsert(spark, table, df, keys, path=layout.table_path("silver", entity),
                          check_unique=not unique, **layout_args)
    for fk in rule.fk_checks:
        _update_pending(spark, layout, rule, fk, df, layout_args)
    set_table_properties(spark, table, {SEEN_PROPERTY: json.dumps(loads)} | log)
    drop_staged(spark, df, *([again] if again is not None else []))
    return {"rows": result["rows"], "rows_written": result["rows_written"],
            "duplicates_removed": before.get("rows", 0) - after.get("rows", 0),
            "orphans": sum(after.get(fk.flag, 0) for fk in rule.fk_checks)}


def _update_pending(spark: SparkSession, layout: Layout, rule: EntityRule, fk: FkCheck, df: DataFrame,
                    layout_args: dict) -> None:
    """Enter the orphans among the rows just written into the index, take out the others.
    (A NULL foreign key waits for nobody.)"""
    keys, waiting = list(rule.primary_key), F.col(fk.flag)
    for c in fk.child_columns:
        waiting = waiting & F.col(c).isNotNull()
    columns = [*keys, *fk.child_columns, *([rule.event_time] if rule.event_time else [])]
    rows = df.dropna(subset=keys).select(*dict.fromkeys(columns), (~waiting).alias("_resolved"))
    name = _pending_table(layout, rule, fk)
    merge_upsert(spark, name, rows, keys, path=layout.table_path("silver", name.rpartition(".")[2]), check_unique=False,
                 remove="_resolved", **{k: v for k, v in layout_args.items() if k != "sort_within"})


def silver_events(spark: SparkSession, layout: Layout, entity: str, start=None, end=None) -> DataFrame:
    """F4 on a silver event table: the rows of the selected UTC days (yesterday by
    default).  The range filter reaches the parquet scan; files are sorted by event
    time, so row groups outside the range are skipped."""
    rule = get_rule(entity)
    if not rule.is_event or not rule.event_time:
        raise ValueError(f"{entity} is a dimension, not an event entity")
    table = spark.table(layout.table("silver", entity))
    today = _dt.datetime.now(_dt.timezone.utc).date()    # resolved once for both filters
    rows = event_window(table, rule.event_time, start, end, today)
    days = _window_days(start, end, today)
    return rows.where(F.col(PART_COL).between(*days)).drop(PART_COL)


def _window_days(start, end, today: _dt.date) -> tuple[int, int]:
    """UTC day numbers bounding the F4 window (partition pruning on ``_part``)."""
    epoch = _dt.date(1970, 1, 1)
    if start is None:
        day = today - _dt.timedelta(days=1)
        return (day - epoch).days, (day - epoch).days
    lo = _dt.date.fromisoformat(str(start))
    hi = _dt.date.fromisoformat(str(end)) if end is not None else lo
    return (lo - epoch).days, (hi - epoch).days


def _silver_tables(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {e: spark.table(layout.table("silver", e)).drop(PART_COL) for e in REGISTRY}


def gold_campaign_performance(spark: SparkSession, layout: Layout) -> int:
    """L3: campaign_performance_by_channel, from all events or (``incremental_gold``) from the
    kept sums; the table is written in full, as one value may change every rank."""
    silver, put = _silver_tables(spark, layout), lambda df, label: stage(df, label, spark)
    if layout.incremental_gold:
        rollup = funnel.campaigns_from_ads(silver, update_rollup(spark, layout, silver))
    else:
        rollup = funnel.campaign_rollup(silver)
    gold = funnel.campaign_performance_from(rollup, put)
    name = "campaign_performance_by_channel"
    return overwrite_table(gold, layout.table("gold", name), layout.table_path("gold", name))


def gold_advertiser_revenue(spark: SparkSession, layout: Layout, industries=None) -> dict[str, int]:
    """L4: advertiser_revenue_by_industry and revenue_by_country_industry_pivot.  The
    per-advertiser revenue is computed once (staged) and feeds both tables; with
    ``incremental_gold`` it comes from the kept sums."""
    silver = _silver_tables(spark, layout)
    revenue = (funnel.advertisers_from_ads(silver, update_rollup(spark, layout, silver)) if layout.incremental_gold
               else funnel.revenue_by_advertiser(silver))
    revenue = stage(revenue, "revenue", spark)
    a, p = "advertiser_revenue_by_industry", "revenue_by_country_industry_pivot"
    gold = funnel.advertiser_revenue_from(revenue)
    return {
        a: overwrite_table(gold, layout.table("gold", a), layout.table_path("gold", a)),
        p: overwrite_table(funnel.revenue_pivot(revenue, industries), layout.table("gold", p),
                           layout.table_path("gold", p)),
    }


def sorted_campaign_performance(spark: SparkSession, layout: Layout) -> DataFrame:
    """The L3 table in display order: by channel, then rank."""
    return spark.table(layout.table("gold", "campaign_performance_by_channel")).orderBy("channel", "rank_in_channel")


def sorted_advertiser_revenue(spark: SparkSession, layout: Layout) -> DataFrame:
    """The L4 table in display order: by industry, then share, largest first."""
    return spark.table(layout.table("gold", "advertiser_revenue_by_industry")).orderBy(
        F.col("industry"), F.col("revenue_share_in_industry").desc())


SUMMARY_SCHEMA = T.StructType([
    T.StructField("step", T.IntegerType()),
    T.StructField("layer", T.StringType()),
    T.StructField("entity", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("duplicates_removed", T.LongType()),
    T.StructField("orphans", T.LongType()),
    T.StructField("error", T.StringType()),
])


def run_all(spark: SparkSession, layout: Layout, sources: dict[str, DataFrame],
            run_date: str | _dt.date | None = None, raise_on_error: bool = True,
            registry: dict[str, EntityRule] | None = None) -> DataFrame:
    """L5: schemas, then bronze for every entity (registry order), silver for every
    entity (parents first), then both gold builds.  Stops at the first failure: it is
    re-raised with the summary so far as its attribute ``run_summary``, or with
    ``raise_on_error=False`` the summary is returned; it ends with the failed step and its
    error.  The summary has one row per step (a handful of rows, built on the
    driver): the rows the table holds, and for silver the duplicates removed and orphans
    flagged in this run."""
    registry = REGISTRY if registry is None else registry
    setup_schemas(spark, layout)
    steps: list[tuple] = []

    class _Stop(Exception):
        pass

    def record(layer: str, names: list[str], fn):
        try:
            got = fn()
        except Exception as e:
            steps.append((len(steps) + 1, layer, names[0], "ERROR", None, None, None, f"{type(e).__name__}: {e}"[:2000]))
            if raise_on_error:
                e.run_summary = spark.createDataFrame(steps, SUMMARY_SCHEMA)
                raise
            raise _Stop() from None
        for name in names:
            d = got if layer == "silver" else {"rows": got[name] if isinstance(got, dict) else got}
            steps.append((len(steps) + 1, layer, name, "OK", int(d["rows"]), d.get("duplicates_removed"),
                          d.get("orphans"), None))

    try:
        for entity in registry:
            if entity in sources:
                record("bronze", [entity],
                       lambda e=entity: bronze_load(spark, layout, e, sources[e], run_date, registry))
        for entity in build_order(registry):
            if entity in sources:
                record("silver", [entity], lambda e=entity: silver_build(spark, layout, e, registry))
        record("gold", ["campaign_performance_by_channel"], lambda: gold_campaign_performance(spark, layout))
        record("gold", ["advertiser_revenue_by_industry", "revenue_by_country_industry_pivot"],
               lambda: gold_advertiser_revenue(spark, layout))
    except _Stop:
        pass
    return spark.createDataFrame(steps, SUMMARY_SCHEMA)
