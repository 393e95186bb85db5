"""The whole pipeline (L5) on the testbed: bronze -> silver -> gold tables."""

import dataclasses
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tierline.operators import funnel
from tierline.operators.quality import event_window
from tierline.plans.pipelines import (Layout, bronze_load, run_all, setup_schemas, silver_build, silver_events,
                                      sorted_advertiser_revenue, sorted_campaign_performance)
from tierline.queries import export, silver_testbed
from tierline.rules import REGISTRY, EntityRule, build_order
from tierline.session import scratch_dir
from tierline.sources.tables import list_tables
from tierline.testbed import raw_entities


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_run_all_matches_direct_plans(spark, sf_small):
    layout = Layout(base=scratch_dir(spark, "pipe"), domain=f"t{uuid.uuid4().hex[:6]}")
    raw = raw_entities(spark, sf_small)
    summary = run_all(spark, layout, raw, run_date="2024-01-31")
    steps = summary.collect()
    assert [s.status for s in steps] == ["OK"] * len(steps)
    assert [s.layer for s in steps][:6] == ["bronze"] * 6
    gold = spark.table(layout.table("gold", "campaign_performance_by_channel"))
    direct = funnel.campaign_performance(silver_testbed(spark, sf_small))
    first = _rows(export(gold))
    assert first == _rows(export(direct).select(*gold.columns))
    # a second run on the same day changes nothing (landing skipped, upsert idempotent)
    run_all(spark, layout, raw, run_date="2024-01-31")
    spark.catalog.refreshTable(layout.table("gold", "campaign_performance_by_channel"))
    assert _rows(export(spark.table(layout.table("gold", "campaign_performance_by_channel")))) == first
    silver_ads = spark.table(layout.table("silver", "ads"))
    assert silver_ads.count() == silver_testbed(spark, sf_small, only=["ads"])["ads"].count()
    # F4 over a silver event table: same rows as filtering the direct plan
    win = silver_events(spark, layout, "clicks", "2024-01-10", "2024-01-12")
    direct_clicks = silver_testbed(spark, sf_small, only=["clicks"])["clicks"]
    assert _rows(export(win.select(*direct_clicks.columns))) == _rows(
        export(event_window(direct_clicks, "timestamp", "2024-01-10", "2024-01-12")))
    plan = win._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp" in plan
    assert "_part" in plan.split("PartitionFilters: [")[1].split("]")[0]  # day partitions pruned
    with pytest.raises(ValueError):
        silver_events(spark, layout, "ads")


def test_run_all_stops_at_first_failure(spark, sf_small):
    layout = Layout(base=scratch_dir(spark, "pipe"), domain=f"t{uuid.uuid4().hex[:6]}")
    raw = dict(raw_entities(spark, sf_small))
    raw["campaigns"] = raw["campaigns"].drop("daily_budget_usd")  # its cast rule cannot apply
    summary = run_all(spark, layout, raw, run_date="2024-01-31", raise_on_error=False).collect()
    assert [(s.layer, s.entity, s.status) for s in summary][-1] == ("silver", "campaigns", "ERROR")
    assert "daily_budget_usd" in summary[-1].error
    assert all(s.status == "OK" for s in summary[:-1]) and len(summary) == 8


def _pipeline(spark, days, only_last=False):
    """Silver tables after the given days: one run a day, or all landed before one run."""
    layout = Layout(base=scratch_dir(spark, "pipe"), domain=f"t{uuid.uuid4().hex[:6]}", rows_per_partition=4)
    setup_schemas(spark, layout)
    results = {}
    for n, (day, frames) in enumerate(days):
        for entity, df in frames.items():
            bronze_load(spark, layout, entity, df, day)
        if not only_last or n == len(days) - 1:
            for entity in build_order():
                if any(entity in f for _, f in days):
                    results[entity] = silver_build(spark, layout, entity)
    return layout, results


def _days(spark):
    """Day two brings a colliding id that sorts before the old row, one that sorts after, a
    late parent of an orphan click, an id that moves to another day, and a repeated row."""
    imp = "id long, ad_id long, timestamp string, country string, cost_usd double"
    clk = "id long, impression_id long, timestamp string, cost_usd double"
    cnv = "id long, click_id long, timestamp string, value_usd double"
    t = lambda d: f"2024-01-{d:02d}T10:00:00.000000+00:00"
    one = {"impressions": [(1, 5, t(1), "US", 0.1), (2, 5, t(1), "US", 0.2), (2, 5, t(1), "US", 0.2), (3, 6, t(2), "AR", 0.0)],
           "clicks": [(10, 1, t(1), 1.0), (11, 9, t(1), 2.0), (12, None, t(2), 3.0)],
           "conversions": [(20, 11, t(2), 9.0), (21, 77, t(2), 8.0)]}
    two = {"impressions": [(9, 5, t(3), "US", 0.5), (1, 4, t(4), "US", 0.9), (2, 8, t(4), "US", 0.2)],
           "clicks": [(13, 9, t(3), 1.5), (10, 0, t(5), 1.0)],
           "conversions": [(21, 13, t(4), 8.0)]}
    frames = lambda d: {e: spark.createDataFrame(r, s) for (e, r), s in zip(d.items(), (imp, clk, cnv))}
    return [("2024-01-10", frames(one)), ("2024-01-11", frames(two))]


def test_two_days_equal_a_full_rebuild(spark):
    days = _days(spark)
    step, after = _pipeline(spark, days)
    full, _ = _pipeline(spark, days, only_last=True)
    for entity in ("impressions", "clicks", "conversions"):
        a, b = (spark.table(x.table("silver", entity)) for x in (step, full))
        assert _rows(a) == _rows(b.select(*a.columns)), entity
        assert after[entity]["rows"] == b.count()
    clicks = {r.id: r.is_orphan_impression_id for r in spark.table(step.table("silver", "clicks")).collect()}
    assert clicks == {10: True, 11: False, 12: True, 13: False}      # 11's parent came on day two


def test_a_daily_run_rewrites_only_what_it_must(spark):
    days = _days(spark)
    layout, first = _pipeline(spark, days[:1])
    assert first["impressions"]["duplicates_removed"] == 1 and first["clicks"]["orphans"] == 2
    table = layout.table("silver", "conversions")
    path = layout.table_path("silver", "conversions").replace("file:", "")

    def files():
        return {f for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}

    before = files()
    again = silver_build(spark, layout, "conversions")
    assert again == {"rows": 2, "rows_written": 0, "duplicates_removed": 0, "orphans": 0} and files() == before
    late = spark.createDataFrame([(30, 11, "2024-01-09T00:00:00.000000+00:00", 1.0)],
                                 "id long, click_id long, timestamp string, value_usd double")
    bronze_load(spark, layout, "conversions", late, "2024-01-12")
    got = silver_build(spark, layout, "conversions")
    assert got["rows"] == 3 and got["rows_written"] == 1 and before < files()
    assert spark.table(table).count() == 3


def test_an_empty_first_day(spark):
    schema = "id long, click_id long, timestamp string, value_usd double"
    days = _days(spark)
    days[0][1]["conversions"] = spark.createDataFrame([], schema)
    layout, after = _pipeline(spark, days[:1])
    assert after["conversions"]["rows"] == 0
    assert spark.table(layout.table("bronze", "conversions")).columns[:4] == ["id", "click_id", "timestamp", "value_usd"]
    layout, after = _pipeline(spark, days)
    assert after["conversions"]["rows"] == 1


def test_an_all_null_column(spark):
    days = _days(spark)[:1]
    days[0][1]["impressions"] = days[0][1]["impressions"].withColumn("cost_usd", F.lit(None).cast("double"))
    layout, after = _pipeline(spark, days)
    assert after["impressions"]["rows"] == 3
    assert {r.cost_usd for r in spark.table(layout.table("silver", "impressions")).collect()} == {None}


def test_bronze_tables_are_listed_and_grow(spark):
    layout = Layout(base=scratch_dir(spark, "pipe"), domain=f"t{uuid.uuid4().hex[:6]}")
    setup_schemas(spark, layout)
    one = spark.createDataFrame([(1, "a")], "id long, country string")
    two = spark.createDataFrame([(2, "b", 1.5)], "id long, country string, x double")
    assert bronze_load(spark, layout, "advertisers", one, "2024-01-01") == 1
    assert bronze_load(spark, layout, "advertisers", two, "2024-01-02") == 2
    assert "advertisers" in [r.tableName for r in list_tables(spark, layout.schema("bronze")).collect()]
    got = {(r.id, r.country, r.x) for r in spark.table(layout.table("bronze", "advertisers")).collect()}
    assert got == {(1, "a", None), (2, "b", 1.5)}


def test_an_own_entity_and_wide_ids_go_through(spark):
    wide = dict(REGISTRY) | {"impressions": dataclasses.replace(
        REGISTRY["impressions"], casts={**REGISTRY["impressions"].casts, "id": "bigint"})}
    wide["regions"] = EntityRule(name="regions", is_event=False, casts={"id": "bigint"})
    layout = Layout(base=scratch_dir(spark, "pipe"), domain=f"t{uuid.uuid4().hex[:6]}")
    sources = {"regions": spark.createDataFrame([(5_000_000_000, " x ")], "id long, name string"),
               "impressions": spark.createDataFrame([(5_000_000_001, 1, "2024-01-01T00:00:00.000000+00:00", "US", 0.1)],
                                                    "id long, ad_id long, timestamp string, country string, cost_usd double")}
    summary = run_all(spark, layout, sources, "2024-01-01", raise_on_error=False, registry=wide).collect()
    assert [(s.layer, s.entity, s.status) for s in summary[:4]] == [
        ("bronze", "impressions", "OK"), ("bronze", "regions", "OK"),
        ("silver", "impressions", "OK"), ("silver", "regions", "OK")]
    assert summary[-1].status == "ERROR" and summary[-1].error      # gold needs all six
    assert [tuple(r)[:2] for r in spark.table(layout.table("silver", "regions")).select("id", "name").collect()] == [
        (5_000_000_000, "x")]


def test_gold_tables_in_display_order(spark, sf_small):
    layout = Layout(base=scratch_dir(spark, "pipe"), domain=f"t{uuid.uuid4().hex[:6]}")
    run_all(spark, layout, raw_entities(spark, sf_small), run_date="2024-01-31")
    a = [(r.channel, r.rank_in_channel) for r in sorted_campaign_performance(spark, layout).collect()]
    assert a == sorted(a) and len(a) > 1000
    b = [(r.industry, -r.revenue_share_in_industry) for r in sorted_advertiser_revenue(spark, layout).collect()]
    assert b == sorted(b) and len(b) > 100


def _flags(spark, layout):
    return {e: {r.id: r[c] for r in spark.table(layout.table("silver", e)).collect()}
            for e, c in (("clicks", "is_orphan_impression_id"), ("conversions", "is_orphan_click_id"))}


def test_orphan_flags_heal_in_any_build_order(spark):
    days = _days(spark)
    full, _ = _pipeline(spark, days, only_last=True)
    want = _flags(spark, full)
    for order in (["conversions", "clicks", "impressions"], ["clicks", "impressions", "conversions"]):
        layout = Layout(base=scratch_dir(spark, "pipe"), domain=f"t{uuid.uuid4().hex[:6]}", rows_per_partition=4)
        setup_schemas(spark, layout)
        for day, frames in days:
            for entity, df in frames.items():
                bronze_load(spark, layout, entity, df, day)
            for entity in order:
                silver_build(spark, layout, entity)
        for _ in order:     # parents are there now: the flags end without new rows
            for entity in order:
                silver_build(spark, layout, entity)
        assert _flags(spark, layout) == want, order
        for entity in order:
            assert silver_build(spark, layout, entity)["rows_written"] == 0
        for entity in ("clicks", "conversions"):
            a, b = (spark.table(x.table("silver", entity)) for x in (layout, full))
            assert _rows(a) == _rows(b.select(*a.columns))


def test_a_late_parent_reads_no_old_child_rows(spark, monkeypatch):
    """Only the pending orphans meet the parent's new keys, and only their days are read."""
    import tierline.plans.pipelines as pipelines
    days = _days(spark)
    layout, _ = _pipeline(spark, days[:1])
    pending = layout.table("silver", "clicks__pending_impression_id")
    assert _rows(spark.table(pending).select("id", "impression_id")) == [(11, 9)]
    bronze_load(spark, layout, "impressions", days[1][1]["impressions"], "2024-01-11")
    silver_build(spark, layout, "impressions")
    read, scanned = pipelines.read_bronze, []
    monkeypatch.setattr(pipelines, "read_bronze", lambda s, path, **k: (scanned.append(path), read(s, path, **k))[1])
    monkeypatch.setattr(pipelines, "build_silver", _no_old_rows(pipelines.build_silver))
    got = silver_build(spark, layout, "clicks")
    assert got["rows"] == 3 and got["rows_written"] == 2        # the day of click 11
    assert spark.table(pending).count() == 0
    assert {r.id: r.is_orphan_impression_id for r in spark.table(layout.table("silver", "clicks")).collect()} == {
        10: False, 11: False, 12: True}


def _no_old_rows(build):
    def run(raw, *args, **kwargs):
        assert raw.count() == 0
        return build(raw, *args, **kwargs)

    return run


def test_parents_alone_need_no_build_of_the_children(spark, monkeypatch):
    """When only parents have come, the flags end; no parent keys are read for rows there are none of."""
    import tierline.plans.pipelines as pipelines
    days = _days(spark)
    layout, _ = _pipeline(spark, days[:1])
    bronze_load(spark, layout, "impressions", days[1][1]["impressions"], "2024-01-11")
    silver_build(spark, layout, "impressions")
    monkeypatch.setattr(pipelines, "build_silver", None)
    got = silver_build(spark, layout, "clicks")
    assert got == {"rows": 3, "rows_written": 2, "duplicates_removed": 0, "orphans": 0}
    assert _flags(spark, layout)["clicks"] == {10: False, 11: False, 12: True}
    assert silver_build(spark, layout, "clicks")["rows_written"] == 0


def test_ids_that_restart_each_day(spark):
    """Keys of id and day: both days' rows stay, and a foreign key only meets its own day."""
    from tierline.rules import FkCheck
    day_key = {"primary_key": ("id", "day"), "dedup_keys": ("id", "day"), "tiebreaker": ("id", "day")}
    registry = {
        "views": EntityRule(name="views", is_event=False, casts={"id": "int"}, **day_key),
        "taps": EntityRule(name="taps", is_event=False, casts={"id": "int", "view_id": "int"},
                           fk_checks=(FkCheck("views", ("id", "day"), ("view_id", "day")),), **day_key),
    }
    layout = Layout(base=scratch_dir(spark, "pipe"), domain=f"t{uuid.uuid4().hex[:6]}")
    setup_schemas(spark, layout)
    views = {1: [(1, "d1"), (2, "d1"), (2, "d1")], 2: [(1, "d2")], 3: [(2, "d2")]}
    taps = {1: [(1, "d1", 1), (2, "d1", 2), (3, "d1", 9)], 2: [(1, "d2", 1), (2, "d2", 2)], 3: []}
    orphans = {}
    for n in (1, 2, 3):
        bronze_load(spark, layout, "views", spark.createDataFrame(views[n], "id long, day string"), f"2024-01-0{n}", registry)
        bronze_load(spark, layout, "taps", spark.createDataFrame(taps[n], "id long, day string, view_id long"),
                    f"2024-01-0{n}", registry)
        for entity in ("views", "taps"):
            got = silver_build(spark, layout, entity, registry)
        orphans[n] = {(r.id, r.day) for r in spark.table(layout.table("silver", "taps")).where("is_orphan_view_id_day").collect()}
    assert got["rows"] == 5 and spark.table(layout.table("silver", "views")).count() == 4
    assert orphans == {1: {(3, "d1")}, 2: {(3, "d1"), (2, "d2")}, 3: {(3, "d1")}}


def test_a_failure_carries_the_summary_so_far(spark, sf_small):
    layout = Layout(base=scratch_dir(spark, "pipe"), domain=f"t{uuid.uuid4().hex[:6]}")
    raw = {"advertisers": raw_entities(spark, sf_small)["advertisers"].drop("website")}
    with pytest.raises(Exception) as e:
        run_all(spark, layout, raw, run_date="2024-01-31")
    steps = e.value.run_summary.collect()
    assert [(s.layer, s.status) for s in steps] == [("bronze", "OK"), ("silver", "ERROR")]
