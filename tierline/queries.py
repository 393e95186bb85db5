"""Registered queries: one per operator / pipeline of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the driver's whole
tables.  Steps a plan reads more than once (linked events, FK parents, the gold
aggregate before its two-pass rank) are written once below the shared checkpoint
folder while the query is built; the rest stays lazy.  ``export`` gives every
result engine-neutral types (decimals as double, timestamps without zone) so it
compares with the SQL oracle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

from tierline import oracle
from tierline import testbed as tb
from tierline.functions.columns import apply_casts, fix_protocol, flag_present, flag_zero, trim_strings
from tierline.operators import funnel
from tierline.operators.quality import (dedup, dedup_metrics, dq_profile, event_window, flag_orphans,
                                        orphan_metrics)
from tierline.operators.ranking import pivot_sum, rank_in_group, share_of_group
from tierline.operators.silver import build_silver_all
from tierline.rules import FkCheck
from tierline.session import scratch_dir
from tierline.sources.landing import land_json
from tierline.sources.tables import (PART_COL, ensure_schemas, list_tables, merge_upsert, overwrite_table,
                                     stage, table_exists)
from tierline.streaming.incremental import BATCH_COL, load_new_files, read_bronze, read_rejects, register_bronze

QueryFn = Callable[[SparkSession, str], DataFrame]


def export(df: DataFrame) -> DataFrame:
    """Decimals -> double, zoned timestamps -> timestamp_ntz (wall clock kept)."""
    changes = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType):
            changes[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, TimestampType):
            changes[f.name] = F.col(f.name).cast("timestamp_ntz")
    return df.withColumns(changes) if changes else df


def _stager(spark: SparkSession):
    return lambda df, label: stage(df, label, spark)


def raw_testbed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return tb.raw_entities(spark, sf_dir, stage=_stager(spark))


def silver_testbed(spark: SparkSession, sf_dir: str, only=None) -> dict[str, DataFrame]:
    """The silver tables over the testbed (all six, or ``only`` and their FK
    ancestors).  FK parents are written once and re-read, so their children and gold
    reuse them instead of recomputing them."""
    return build_silver_all(raw_testbed(spark, sf_dir), stage=_stager(spark), only=only)


def _r(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round double columns whose last bits depend on summation order."""
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})


# ---- gold (testbed -> silver -> gold) ---------------------------------------------

def q_gold_campaign_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export(funnel.campaign_performance(silver_testbed(spark, sf_dir), stage=_stager(spark)))


def q_funnel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.funnel_rows(silver_testbed(spark, sf_dir))


def q_gold_advertiser_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = funnel.advertiser_revenue(silver_testbed(spark, sf_dir), stage=_stager(spark))
    return _r(export(gold), {"industry_total_revenue_usd": 6, "revenue_share_in_industry": 9})


def q_gold_revenue_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rev = funnel.revenue_by_advertiser(silver_testbed(spark, sf_dir))
    piv = funnel.revenue_pivot(stage(rev, "pivot-revenue", spark))     # headings from the data
    return _r(piv, {c: 6 for c in piv.columns if c != "country"})


# ---- window / group operators on the driver's tables ------------------------------

def q_rank_in_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = tb.read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("channel"), "o_totalprice")
    return (rank_in_group(o, "channel", "o_totalprice", "rank_in_channel")
            .orderBy("channel", "rank_in_channel"))


def q_industry_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tb.read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    out = share_of_group(c, "c_mktsegment", "c_acctbal", "segment_total_acctbal", "acctbal_share")
    return (_r(out, {"segment_total_acctbal": 6, "acctbal_share": 9})
            .orderBy(F.col("c_mktsegment"), F.col("acctbal_share").desc()))


def q_pivot_country_industry(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tb.read_table(spark, sf_dir, "customer")
    n = tb.read_table(spark, sf_dir, "nation")
    cn = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("country"), F.col("c_mktsegment").alias("industry"), "c_acctbal")
    piv = pivot_sum(cn, "country", "industry", "c_acctbal")     # headings from the data
    return _r(piv, {c: 6 for c in piv.columns if c != "country"})


# ---- silver operators, one at a time --------------------------------------------

LINEITEM_KEY = ["l_orderkey", "l_linenumber"]


def q_dedup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(tb.read_table(spark, sf_dir, "lineitem"), LINEITEM_KEY)


def q_dedup_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_metrics(tb.read_table(spark, sf_dir, "lineitem"), LINEITEM_KEY)


def _events_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = tb.read_table(spark, sf_dir, "events")
    sup = tb.read_table(spark, sf_dir, "supplier")
    return flag_orphans(ev, sup, "s_suppkey", "user_id")


def q_fk_flag_events_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_supplier(spark, sf_dir)


def _clicks_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_testbed(spark, sf_dir)
    return flag_orphans(raw["clicks"], raw["impressions"], "id", "impression_id")


def q_fk_flag_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clicks_flagged(spark, sf_dir).select("id", "impression_id", "is_orphan_impression_id")


def q_fk_orphan_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = orphan_metrics(_events_supplier(spark, sf_dir), ["is_orphan_user_id"])
    ck = orphan_metrics(_clicks_flagged(spark, sf_dir), ["is_orphan_impression_id"])
    return (ev.select(F.lit("events.user_id -> supplier.s_suppkey").alias("fk_check"), "rows",
                      F.col("is_orphan_user_id_count").alias("orphans"))
              .unionByName(ck.select(F.lit("clicks.impression_id -> impressions.id").alias("fk_check"),
                                     "rows", F.col("is_orphan_impression_id_count").alias("orphans"))))


ORDER_CASTS = {"o_orderkey": "int", "o_custkey": "int", "o_totalprice": "decimal(12,2)",
               "o_orderdate": "date"}


def q_cast_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export(apply_casts(tb.read_table(spark, sf_dir, "orders"), ORDER_CASTS))


def q_trim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tb.read_table(spark, sf_dir, "customer")
    padded = c.withColumns({
        "c_name": F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")),
        "c_mktsegment": F.concat(F.lit(" "), F.col("c_mktsegment")),
    })
    return trim_strings(padded)


def _pages_defective(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs with planted protocol defects: stripped (page_id % 50 = 0), upper
    case (% 50 = 25), leading blank (% 50 = 10)."""
    p = tb.read_table(spark, sf_dir, "pages").select("page_id", "url")
    m = F.col("page_id") % 50
    return p.withColumn("url", F.when(m == 0, F.regexp_replace("url", "^https?://", ""))
                                .when(m == 25, F.upper("url"))
                                .when(m == 10, F.concat(F.lit(" "), F.col("url")))
                                .otherwise(F.col("url")))


def q_fix_protocol_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trim_strings(fix_protocol(_pages_defective(spark, sf_dir), "url"))


def q_flag_zero_discount(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = tb.read_table(spark, sf_dir, "lineitem").select(*LINEITEM_KEY, "l_discount")
    return flag_zero(li, "l_discount", "is_zero_discount")


def q_flag_present_creative(spark: SparkSession, sf_dir: str) -> DataFrame:
    ads = tb.ads(spark, sf_dir)
    return flag_present(ads, "creative_url", "has_creative_url").select(
        "id", "creative_url", "has_creative_url")


def q_fk_flag_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose user viewed nothing on that day: a foreign key of user and day."""
    day = F.col("ts").cast("date")
    ev = tb.read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", day.alias("day"))
    views = ev.where(F.col("event_type") == "view").select(F.col("user_id").cast("int").alias("viewer"), F.col("day").alias("seen_on"))
    flagged = flag_orphans(ev, views, ["viewer", "seen_on"], ["user_id", "day"], "no_view_that_day")
    return flagged.select("event_id", "user_id", "no_view_that_day")


def q_silver_children_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver built children first, twice: the second round ends the flags of rows whose
    parents came in the first.  Orphan flags of clicks and conversions."""
    from tierline.plans.pipelines import Layout, bronze_load, setup_schemas, silver_build
    layout = Layout(base=scratch_dir(spark, "pipeline"), domain=f"ads_{uuid.uuid4().hex[:8]}")
    setup_schemas(spark, layout)
    raw = raw_testbed(spark, sf_dir)
    order = ["conversions", "clicks", "impressions"]
    for entity in order:
        bronze_load(spark, layout, entity, raw[entity], "2024-01-31")
    for entity in [*order, "clicks", "conversions"]:
        silver_build(spark, layout, entity)
    return spark.table(layout.table("silver", "clicks")).select(
        F.lit("clicks").alias("entity"), "id", F.col("is_orphan_impression_id").alias("orphan")).unionByName(
        spark.table(layout.table("silver", "conversions")).select(
            F.lit("conversions").alias("entity"), "id", F.col("is_orphan_click_id").alias("orphan")))


def q_funnel_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funnel where event ids restart: silver events get keys of id and day (an id's
    quotient and remainder by 7), foreign keys of two columns, are flagged and rolled up."""
    def split(df, old, key, day):
        return df.withColumn(day, F.col(old) % 7).withColumn(key, F.expr(f"`{old}` div 7"))

    silver = silver_testbed(spark, sf_dir)
    imp = split(silver["impressions"], "id", "id", "day")
    clk = split(split(silver["clicks"], "impression_id", "impression_id", "impression_day"), "id", "id", "day")
    cnv = split(split(silver["conversions"], "click_id", "click_id", "click_day"), "id", "id", "day")
    links = funnel.LINKS | {
        "clicks": FkCheck("impressions", ("id", "day"), ("impression_id", "impression_day")),
        "conversions": FkCheck("clicks", ("id", "day"), ("click_id", "click_day"))}
    silver["impressions"] = imp
    for name, df in (("clicks", clk), ("conversions", cnv)):
        fk = links[name]
        silver[name] = flag_orphans(df, silver[fk.parent], fk.parent_keys, fk.child_columns, fk.flag)
    out = funnel.campaign_rollup(silver, links).select(
        "campaign_id", "funnel_rows", "impressions_count", "clicks_count", "conversions_count",
        "total_impression_cost_usd", "total_click_cost_usd", "total_conversion_value_usd")
    return export(out)


def q_silver_daily_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impressions and clicks loaded in three daily parts (by id, so repeated ids meet across
    parts too) with an incremental silver build after each: equal to one build of all."""
    from tierline.plans.pipelines import Layout, bronze_load, setup_schemas, silver_build
    layout = Layout(base=scratch_dir(spark, "pipeline"), domain=f"ads_{uuid.uuid4().hex[:8]}")
    setup_schemas(spark, layout)
    raw = raw_testbed(spark, sf_dir)
    for n in range(3):
        for entity in ("clicks", "impressions"):
            part = raw[entity].where(F.pmod(F.xxhash64("id", "timestamp"), F.lit(3)) == n)
            bronze_load(spark, layout, entity, part, f"2024-01-{29 + n}")
            silver_build(spark, layout, entity)
    silver_build(spark, layout, "clicks")       # the flags of parents that came after their clicks
    return export(spark.table(layout.table("silver", "clicks")).drop("_part"))


def q_gold_daily_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events loaded in two daily parts (by id, so children meet parents of another part), gold
    built after each from the kept sums: the second takes in only what silver changed, and
    equals gold from all events."""
    from tierline.plans.pipelines import Layout, bronze_load, gold_campaign_performance, setup_schemas, silver_build
    layout = Layout(base=scratch_dir(spark, "pipeline"), domain=f"ads_{uuid.uuid4().hex[:8]}", incremental_gold=True)
    setup_schemas(spark, layout)
    raw = raw_testbed(spark, sf_dir)
    for entity in ("advertisers", "campaigns", "ads"):
        bronze_load(spark, layout, entity, raw[entity], "2024-01-30")
        silver_build(spark, layout, entity)
    for n in range(2):
        for entity in ("impressions", "clicks", "conversions"):
            part = raw[entity].where(F.pmod(F.xxhash64("id", "timestamp"), F.lit(2)) == n)
            bronze_load(spark, layout, entity, part, f"2024-01-{30 + n}")
            silver_build(spark, layout, entity)
        gold_campaign_performance(spark, layout)
    return export(spark.table(layout.table("gold", "campaign_performance_by_channel")))


def _silver_query(entity: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return export(silver_testbed(spark, sf_dir, only=[entity])[entity])
    run.__name__ = f"q_silver_{entity}"
    return run


def q_dq_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_testbed(spark, sf_dir)
    tables = dict(raw)
    tables["clicks"] = flag_orphans(raw["clicks"], raw["impressions"], "id", "impression_id")
    tables["conversions"] = flag_orphans(raw["conversions"], raw["clicks"], "id", "click_id")
    checks = {
        "advertisers": {"website_without_protocol": ~F.col("website").rlike("^https?://")},
        "campaigns": {"zero_budget": F.col("daily_budget_usd") == 0},
        "ads": {"missing_creative": F.col("creative_url").isNull()},
        "impressions": {"zero_cost": F.col("cost_usd") == 0},
        "clicks": {"orphan_impression_id": F.col("is_orphan_impression_id")},
        "conversions": {"orphan_click_id": F.col("is_orphan_click_id")},
    }
    return dq_profile(tables, checks, duplicates=["impressions"])


def q_event_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_window(tb.read_table(spark, sf_dir, "events"), "ts", "2024-01-10", "2024-01-12")


# ---- sinks: write below a fresh scratch folder, return what reads back -------------

def _scratch_schema(spark: SparkSession, label: str) -> tuple[str, str]:
    base = scratch_dir(spark, label)
    name = f"tl_{label}_{uuid.uuid4().hex[:10]}"
    ensure_schemas(spark, {name: f"scratch schema for {label}"}, location_root=base)
    return name, base


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.read_table(spark, sf_dir, "orders")


def _upsert_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Target: orders with key % 10 < 8.  Source: even keys and keys ending in 9, price + 1
    (so it updates keys and inserts keys 8, 9, 18, ...).  Together they are all orders."""
    o = _orders(spark, sf_dir)
    target = o.where(F.col("o_orderkey") % 10 < 8)
    source = (o.where((F.col("o_orderkey") % 2 == 0) | (F.col("o_orderkey") % 10 == 9))
               .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0)))
    return target, source


def q_merge_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, _ = _scratch_schema(spark, "create")
    table = f"{schema}.orders"
    assert not table_exists(spark, table)
    merge_upsert(spark, table, _orders(spark, sf_dir), "o_orderkey", partitions=8)
    return spark.table(table).drop(PART_COL)


def _upserted(spark: SparkSession, sf_dir: str, times: int) -> DataFrame:
    schema, _ = _scratch_schema(spark, "upsert")
    table = f"{schema}.orders"
    target, source = _upsert_inputs(spark, sf_dir)
    merge_upsert(spark, table, target, "o_orderkey", partitions=8)
    for _ in range(times):
        merge_upsert(spark, table, source, "o_orderkey", partitions=8)
    return spark.table(table).drop(PART_COL)


def q_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir, 1)


def q_merge_rerun_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir, 2)


def q_merge_changed_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created with 4 partitions, upserted by a caller that says 5: the recorded 4 hold."""
    schema, _ = _scratch_schema(spark, "upsert")
    table = f"{schema}.orders"
    target, source = _upsert_inputs(spark, sf_dir)
    merge_upsert(spark, table, target, "o_orderkey", partitions=4)
    merge_upsert(spark, table, source, "o_orderkey", partitions=5)
    return spark.table(table).drop(PART_COL)


def q_merge_key_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bigint-keyed table upserted with int keys."""
    schema, _ = _scratch_schema(spark, "upsert")
    table = f"{schema}.orders"
    target, source = _upsert_inputs(spark, sf_dir)
    merge_upsert(spark, table, target, "o_orderkey", partitions=8)
    merge_upsert(spark, table, source.withColumn("o_orderkey", F.col("o_orderkey").cast("int")), "o_orderkey",
                 partitions=8)
    return spark.table(table).drop(PART_COL)


def q_merge_null_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day: a third of them first land without a time (the NULL day), the rest on
    their day; then that third arrives with time and value, a day later."""
    schema, _ = _scratch_schema(spark, "upsert")
    table = f"{schema}.events"
    ev = tb.read_table(spark, sf_dir, "events")
    late = F.col("event_id") % 3 == 0
    day = F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date"))
    first = ev.withColumn("ts", F.when(~late, F.col("ts")))
    merge_upsert(spark, table, first, "event_id", partition_expr=day)
    then = (ev.where(late).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY"))
            .withColumn("value", F.col("value") + F.lit(1.0)))
    merge_upsert(spark, table, then, "event_id", partition_expr=day)
    return spark.table(table).drop(PART_COL)


def q_overwrite_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A managed table (made by other means) of some orders, rebuilt from all orders with
    one more column, twice."""
    schema, _ = _scratch_schema(spark, "overwrite")
    table = f"{schema}.orders"
    o = _orders(spark, sf_dir)
    o.where(F.col("o_orderkey") % 2 == 0).write.saveAsTable(table)
    for _ in range(2):
        overwrite_table(o.withColumn("key_class", F.col("o_orderkey") % 7), table)
    return spark.table(table)


def q_upsert_new_column_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unpartitioned upsert whose source has a column more."""
    schema, _ = _scratch_schema(spark, "upsert")
    table = f"{schema}.orders"
    target, source = _upsert_inputs(spark, sf_dir)
    merge_upsert(spark, table, target, "o_orderkey")
    merge_upsert(spark, table, source.withColumn("key_class", F.col("o_orderkey") % 7), "o_orderkey")
    return spark.table(table)


def q_upsert_widened_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole prices, then an upsert with fractions."""
    schema, _ = _scratch_schema(spark, "upsert")
    table = f"{schema}.orders"
    target, source = _upsert_inputs(spark, sf_dir)
    whole = target.withColumn("o_totalprice", F.floor("o_totalprice").cast("int"))
    merge_upsert(spark, table, whole, "o_orderkey", partitions=8)
    merge_upsert(spark, table, source, "o_orderkey", partitions=8)
    return spark.table(table).drop(PART_COL)


def q_merge_growing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table laid out for its first load, a hundredth of the orders, that then takes the
    rest in two upserts: partitions are divided until they are small again."""
    schema, _ = _scratch_schema(spark, "upsert")
    table, size = f"{schema}.orders", 500
    o = _orders(spark, sf_dir)
    for rows in (o.where(F.col("o_orderkey") % 100 == 0), o.where(F.col("o_orderkey") % 2 == 0), o):
        merge_upsert(spark, table, rows, "o_orderkey", rows_per_partition=size)
    held = spark.table(table)
    largest = held.groupBy(PART_COL).count().agg(F.max("count")).first()[0]
    return held.drop(PART_COL).withColumn("partitions_bounded", F.lit(largest <= 3 * size))


def q_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, _ = _scratch_schema(spark, "overwrite")
    nation = tb.read_table(spark, sf_dir, "nation")
    overwrite_table(nation.where(F.col("n_regionkey") == 0), f"{schema}.nation")
    overwrite_table(nation, f"{schema}.nation")
    return spark.table(f"{schema}.nation")


INGEST_SPLIT = "2024-01-16"


def _ingested(spark: SparkSession, sf_dir: str, evolve: bool) -> DataFrame:
    """Land events in two parts (run dates 2024-01-16 and 2024-01-31), loading after
    each; land the first day again and load a third time (nothing new)."""
    base = scratch_dir(spark, "ingest")
    ev = tb.read_table(spark, sf_dir, "events")
    split = F.to_timestamp_ntz(F.lit(f"{INGEST_SPLIT} 00:00:00"))
    part1 = ev.where(F.col("ts") < split)
    part2 = ev.where(F.col("ts") >= split)
    if evolve:
        part2 = part2.withColumn("props_len", F.length("props").cast("bigint"))
    landing, bronze = f"{base}/landing/events", f"{base}/bronze/events"
    land_json(part1, f"{base}/landing", "events", INGEST_SPLIT)
    load_new_files(spark, landing, bronze)
    land_json(part2, f"{base}/landing", "events", "2024-01-31")
    load_new_files(spark, landing, bronze)
    land_json(part1, f"{base}/landing", "events", INGEST_SPLIT)
    load_new_files(spark, landing, bronze)
    out = read_bronze(spark, bronze)
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _split_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ev = tb.read_table(spark, sf_dir, "events")
    split = F.to_timestamp_ntz(F.lit(f"{INGEST_SPLIT} 00:00:00"))
    return ev.where(F.col("ts") < split), ev.where(F.col("ts") >= split)


def q_ingest_type_widening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose columns change type on the second day: whole numbers become fractions
    (``value``) or text (``user_id``), and a column of NULLs becomes a struct (``detail``).
    Read through the catalog."""
    base = scratch_dir(spark, "ingest")
    schema, _ = _scratch_schema(spark, "ingest")
    first, then = _split_events(spark, sf_dir)
    first = first.select("event_id", F.floor("value").alias("value"), "user_id", F.lit(None).cast("string").alias("detail"))
    then = then.select("event_id", "value", F.concat(F.lit("u"), F.col("user_id")).alias("user_id"),
                       F.struct("event_type", F.length("props").alias("size")).alias("detail"))
    for day, rows in (("2024-01-16", first), ("2024-01-31", then)):
        land_json(rows, f"{base}/landing", "events", day)
        load_new_files(spark, f"{base}/landing/events", f"{base}/bronze/events")
        register_bronze(spark, f"{schema}.events", f"{base}/bronze/events")
    return spark.table(f"{schema}.events").select(
        "event_id", "value", "user_id", F.col("detail.event_type").alias("detail_type"),
        F.col("detail.size").alias("detail_size"))


def q_ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines of which every seventh is cut short and every eleventh is a bare
    number; then a second day that is whole.  Every line ends up loaded or rejected."""
    base = scratch_dir(spark, "ingest")
    landing, bronze = f"{base}/landing/events", f"{base}/bronze/events"
    first, then = _split_events(spark, sf_dir)
    line = F.to_json(F.struct("event_id", "user_id", "value"))
    broken = F.when(F.col("event_id") % 7 == 0, F.substring_index(line, ",", 2)).when(
        F.col("event_id") % 11 == 0, F.col("event_id").cast("string")).otherwise(line)
    for day, rows, text in (("2024-01-16", first, broken), ("2024-01-31", then, line)):
        rows.select(text.alias("value")).write.text(f"{landing}/events_{day}")
        load_new_files(spark, landing, bronze)
    loaded = read_bronze(spark, bronze).select("event_id", "user_id", "value", F.lit("loaded").alias("outcome"))
    gone = read_rejects(spark, bronze).select(
        F.coalesce(F.nullif(F.regexp_extract("line", r'"event_id":([0-9]+)', 1), F.lit("")), F.col("line")).cast("bigint").alias("event_id"),
        F.lit(None).cast("bigint").alias("user_id"), F.lit(None).cast("double").alias("value"), F.col("reason").alias("outcome"))
    return loaded.unionByName(gone)


def q_bronze_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a bronze catalog table after two daily loads, the second with a new
    column, read by name."""
    from tierline.plans.pipelines import Layout, setup_schemas
    layout = Layout(base=scratch_dir(spark, "bronze"), domain=f"ads_{uuid.uuid4().hex[:8]}")
    setup_schemas(spark, layout)
    ev = tb.read_table(spark, sf_dir, "events")
    split = F.to_timestamp_ntz(F.lit(f"{INGEST_SPLIT} 00:00:00"))
    path, table = layout.bronze_path("events"), layout.table("bronze", "events")
    later = ev.where(F.col("ts") >= split).withColumn("props_len", F.length("props").cast("bigint"))
    for day, rows in (("2024-01-15", ev.where(F.col("ts") < split)), ("2024-01-31", later)):
        land_json(rows, layout.landing, "events", day)
        load_new_files(spark, f"{layout.landing}/events", path)
        register_bronze(spark, table, path)
    return spark.table(table).drop(BATCH_COL).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def q_ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, evolve=False)


def q_ingest_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, evolve=True)


def q_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline (L5) on the testbed entities; one summary row per step,
    joined to the tables the catalog lists for each layer."""
    from tierline.plans.pipelines import Layout, run_all
    layout = Layout(base=scratch_dir(spark, "pipeline"), domain=f"ads_{uuid.uuid4().hex[:8]}")
    raw = raw_testbed(spark, sf_dir)
    summary = run_all(spark, layout, raw, run_date="2024-01-31")
    listed = None
    for layer in ("bronze", "silver", "gold"):
        t = list_tables(spark, layout.schema(layer)).select(
            F.lit(layer).alias("layer"), F.col("tableName").alias("entity"))
        listed = t if listed is None else listed.unionByName(t)
    return summary.join(listed.withColumn("in_catalog", F.lit(True)), ["layer", "entity"], "left")


QUERIES: dict[str, QueryFn] = {
    "gold_campaign_performance": q_gold_campaign_performance,
    "funnel_rows": q_funnel_rows,
    "gold_advertiser_revenue": q_gold_advertiser_revenue,
    "gold_revenue_pivot": q_gold_revenue_pivot,
    "rank_in_channel": q_rank_in_channel,
    "industry_share": q_industry_share,
    "pivot_country_industry": q_pivot_country_industry,
    "dedup_lineitem": q_dedup_lineitem,
    "dedup_metrics": q_dedup_metrics,
    "fk_flag_events_supplier": q_fk_flag_events_supplier,
    "fk_flag_clicks": q_fk_flag_clicks,
    "fk_orphan_count": q_fk_orphan_count,
    "fk_flag_composite": q_fk_flag_composite,
    "silver_children_first": q_silver_children_first,
    "silver_daily_loads": q_silver_daily_loads,
    "gold_daily_updates": q_gold_daily_updates,
    "funnel_composite": q_funnel_composite,
    "cast_orders": q_cast_orders,
    "trim_customer": q_trim_customer,
    "fix_protocol_pages": q_fix_protocol_pages,
    "flag_zero_discount": q_flag_zero_discount,
    "flag_present_creative": q_flag_present_creative,
    **{f"silver_{e}": _silver_query(e) for e in
       ["advertisers", "campaigns", "ads", "impressions", "clicks", "conversions"]},
    "dq_profile": q_dq_profile,
    "event_window": q_event_window,
    "merge_first_run": q_merge_first_run,
    "merge_upsert": q_merge_upsert,
    "merge_rerun_idempotent": q_merge_rerun_idempotent,
    "merge_changed_partitions": q_merge_changed_partitions,
    "merge_key_width": q_merge_key_width,
    "merge_null_day": q_merge_null_day,
    "merge_growing": q_merge_growing,
    "upsert_new_column_plain": q_upsert_new_column_plain,
    "upsert_widened_value": q_upsert_widened_value,
    "overwrite_roundtrip": q_overwrite_roundtrip,
    "overwrite_new_column": q_overwrite_new_column,
    "ingest_incremental": q_ingest_incremental,
    "ingest_schema_evolution": q_ingest_schema_evolution,
    "ingest_type_widening": q_ingest_type_widening,
    "ingest_rejects": q_ingest_rejects,
    "bronze_catalog": q_bronze_catalog,
    "run_summary": q_run_summary,
}

ORACLE: dict[str, str] = dict(oracle.ORACLE)
