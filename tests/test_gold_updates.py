"""Gold from kept sums equals gold from all events, day after day."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from tests.test_key_places import _spoil
from tierline.operators import funnel
from tierline.operators import funnel_delta as delta
from tierline.plans import gold_updates
from tierline.plans.pipelines import (Layout, bronze_load, gold_advertiser_revenue, gold_campaign_performance,
                                      setup_schemas, silver_build)
from tierline.rules import REGISTRY
from tierline.session import scratch_dir
from tierline.sources.key_places import BLOCK
from tierline.sources.tables import table_properties
from tierline.streaming.incremental import BATCH_COL, number_folders

SCHEMAS = {
    "advertisers": "id long, advertiser_name string, industry string, country string, website string",
    "campaigns": "id long, advertiser_id long, campaign_name string, channel string, objective string, "
                 "daily_budget_usd double",
    "ads": "id long, campaign_id long, creative_url string",
    "impressions": "id long, ad_id long, timestamp string, cost_usd double",
    "clicks": "id long, impression_id long, timestamp string, cost_usd double",
    "conversions": "id long, click_id long, timestamp string, value_usd double",
}
GOLD = ["campaign_performance_by_channel", "advertiser_revenue_by_industry", "revenue_by_country_industry_pivot"]


def _day(d):
    return f"2024-01-{d:02d}T10:00:00.000000+00:00"


def _layout(spark, **more):
    layout = Layout(base=scratch_dir(spark, "gold"), domain=f"g{uuid.uuid4().hex[:6]}", incremental_gold=True, **more)
    setup_schemas(spark, layout)
    return layout


def _load(spark, layout, entity, rows, day):
    bronze_load(spark, layout, entity, spark.createDataFrame(rows, SCHEMAS[entity]), f"2024-01-{day:02d}")
    silver_build(spark, layout, entity)


def _dimensions(spark, layout, day=1):
    _load(spark, layout, "advertisers", [(i, f"a{i}", f"i{i % 2}", f"c{i % 2}", "x.example") for i in range(3)], day)
    _load(spark, layout, "campaigns", [(i, i % 4, f"p{i}", f"ch{i % 2}", "o", 1.0) for i in range(5)], day)
    _load(spark, layout, "ads", [(i, i % 6, "u") for i in range(8)], day)


def _gold(spark, layout):
    gold_campaign_performance(spark, layout)
    gold_advertiser_revenue(spark, layout)


def _rows(df):
    return sorted(map(repr, df.collect()))


def _assert_as_rebuilt(spark, layout):
    silver = {e: spark.table(layout.table("silver", e)).drop("_part") for e in REGISTRY}
    revenue = funnel.revenue_by_advertiser(silver)
    full = [funnel.campaign_performance(silver), funnel.advertiser_revenue_from(revenue), funnel.revenue_pivot(revenue)]
    for name, want in zip(GOLD, full, strict=True):
        got = spark.table(layout.table("gold", name))
        assert got.dtypes == want.dtypes
        assert _rows(got) == _rows(want), name


def _taken(spark, layout):
    return table_properties(spark, layout.table("gold", "rollup_ads"))[gold_updates.TAKEN_PROPERTY]


@pytest.mark.parametrize("seed", [1])
def test_days_with_late_moved_and_changed_rows_equal_a_rebuild(spark, seed, monkeypatch):
    rng, layout = random.Random(seed), _layout(spark)
    _dimensions(spark, layout)

    def some(n, top, *cents):
        return [(rng.choice([None, *range(n)]), rng.choice([None, *range(top)]), rng.choice([None, *map(_day, range(1, 5))]),
                 rng.choice([None, *cents])) for _ in range(rng.randrange(1, 20))]

    rebuilds, rebuild = [], gold_updates._rebuild
    monkeypatch.setattr(gold_updates, "_rebuild", lambda *a: (rebuilds.append(1), rebuild(*a)))
    for day in range(1, 4):     # children come before their parents on some days
        order = ["impressions", "clicks", "conversions"]
        rng.shuffle(order)
        for entity in order:
            n, top = {"impressions": (12, 10), "clicks": (10, 14), "conversions": (10, 12)}[entity]
            _load(spark, layout, entity, some(n, top, 0.25, 0.5, 3.0), day)
        if day == 2:            # an ad moves, a new one comes
            _load(spark, layout, "ads", [(1, 0, "u"), (9, 2, "u")], day)
        _gold(spark, layout)
        _assert_as_rebuilt(spark, layout)
    assert len(rebuilds) == 1
    for entity in ("impressions", "clicks", "conversions"):     # the logs taken in are gone
        assert number_folders(spark, gold_updates._log_path(layout, entity), "_run") == []


def test_an_update_reads_no_other_day_of_the_events(spark):
    layout = _layout(spark)
    _dimensions(spark, layout)
    for d in (1, 2, 3):         # every day's ids have blocks of their own
        at = d * 10 * BLOCK
        _load(spark, layout, "impressions", [(at + i, i % 8, _day(d), 0.5) for i in range(6)], d)
        _load(spark, layout, "clicks", [(at + i, at + i % 4, _day(d), 0.25) for i in range(5)], d)
        _load(spark, layout, "conversions", [(at + i, at + i % 3, _day(d), 2.0) for i in range(4)], d)
    _gold(spark, layout)
    # a conversion of day 1's click and a click on day 1's impression come on day 4
    at = 10 * BLOCK
    _load(spark, layout, "impressions", [(40 * BLOCK, 3, _day(4), 0.5)], 4)
    _load(spark, layout, "clicks", [(40 * BLOCK, at + 4, _day(4), 0.75)], 4)
    _load(spark, layout, "conversions", [(40 * BLOCK, at + 4, _day(4), 9.0)], 4)
    spoiled = []
    for entity in ("impressions", "clicks", "conversions"):
        for table in (layout.table("silver", entity), layout.table("gold", f"rollup_{entity}")):
            for day in ("_part=19724", "_part=19725"):      # days 2 and 3
                where = [r.data_type for r in spark.sql(
                    f"DESCRIBE TABLE EXTENDED {table} PARTITION ({day})").collect() if r.col_name == "Location"][0]
                spoiled.append(_spoil(where))
        for n in number_folders(spark, layout.bronze_path(entity), BATCH_COL)[1:3]:
            spoiled.append(_spoil(f"{layout.bronze_path(entity)}/{BATCH_COL}={n}"))
    assert min(spoiled) >= 1
    before = {r.campaign_id: r for r in spark.table(layout.table("gold", GOLD[0])).collect()}
    _gold(spark, layout)
    after = {r.campaign_id: r for r in spark.table(layout.table("gold", GOLD[0])).collect()}
    total = lambda rows, c: sum(r[c] or 0 for r in rows.values())
    assert total(after, "conversions_count") == total(before, "conversions_count") + 1
    assert total(after, "total_conversion_value_usd") == total(before, "total_conversion_value_usd") + 9
    assert total(after, "clicks_count") == total(before, "clicks_count") + 1
    assert total(after, "impressions_count") == total(before, "impressions_count") + 1


@pytest.mark.parametrize("where", ["merge", "write"])
def test_a_failed_build_is_made_good(spark, where, monkeypatch):
    layout = _layout(spark)
    _dimensions(spark, layout)
    for entity, rows in {"impressions": [(1, 1, _day(1), 0.5), (2, 2, _day(1), 0.5)], "clicks": [(1, 1, _day(1), 0.25)],
                         "conversions": [(1, 1, _day(1), 2.0)]}.items():
        _load(spark, layout, entity, rows, 1)
    _gold(spark, layout)

    def fail(*a, **k):
        raise RuntimeError("stopped")

    if where == "merge":        # a silver build stops after it has logged
        with monkeypatch.context() as m, pytest.raises(RuntimeError):
            m.setattr("tierline.plans.pipelines.merge_upsert", fail)
            _load(spark, layout, "clicks", [(2, 1, _day(2), 0.75), (None, 2, _day(2), 1.0)], 2)
        silver_build(spark, layout, "clicks")
    else:                       # a gold build stops between two of its tables
        _load(spark, layout, "clicks", [(2, 1, _day(2), 0.75), (None, 2, _day(2), 1.0)], 2)
        with monkeypatch.context() as m, pytest.raises(RuntimeError):
            m.setattr(gold_updates, "_write_ads", fail)
            _gold(spark, layout)
        assert _taken(spark, layout) == ""
    _gold(spark, layout)
    _assert_as_rebuilt(spark, layout)
    _load(spark, layout, "conversions", [(2, 2, _day(3), 4.0)], 3)
    _gold(spark, layout)
    _assert_as_rebuilt(spark, layout)


def test_silver_built_without_a_log_means_a_rebuild(spark):
    layout = _layout(spark)
    _dimensions(spark, layout)
    for entity in ("impressions", "clicks", "conversions"):
        _load(spark, layout, entity, [(1, 1, _day(1), 0.5)], 1)
    _gold(spark, layout)
    plain = Layout(base=layout.base, domain=layout.domain)
    _load(spark, plain, "conversions", [(2, 1, _day(2), 4.0)], 2)
    _gold(spark, layout)
    _assert_as_rebuilt(spark, layout)


def test_rows_are_weighed_anew_without_a_sort(spark):
    """Own parts: as they came, else as they were; a part that came with NULLs replaces one without."""
    types = {c: "bigint" for c in delta.SUMS} | {c: "decimal(38,2)" for c in delta._MONEY}
    own = "id long, _at timestamp, _up long, _live boolean, _amount decimal(10,2)"
    one = lambda rows: spark.createDataFrame(rows, "id long, up long, live boolean, amount string").selectExpr(
        "id", "TIMESTAMP '2024-01-01' AS _at", "up AS _up", "live AS _live", "CAST(amount AS decimal(10,2)) AS _amount")
    old = delta.no_sums(one([(1, 10, True, "1.5"), (2, 20, True, "2.5")]), types).withColumn("_rows", F.lit(3).cast("bigint"))
    below = delta.no_sums(spark.createDataFrame([(1,), (9,)], "id long"), types).withColumn("_rows", F.lit(4).cast("bigint"))
    new = delta.reweighed(old, one([(2, None, False, None), (3, 30, True, "3.5")]), below, types)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in new.schema.fields][:5] == [
        f"{c.split()[0]} {c.split()[1].replace('long', 'bigint')}" for c in own.split(", ")]
    assert "SortAggregate" not in new._jdf.queryExecution().executedPlan().toString()
    got = {r.id: (r._up, r._live, None if r._amount is None else str(r._amount), r._rows) for r in new.collect()}
    assert got == {1: (10, True, "1.50", 7), 2: (None, False, None, 3), 3: (30, True, "3.50", 0), 9: (None, False, None, 4)}
