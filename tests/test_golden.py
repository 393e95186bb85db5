"""Hand-worked golden rows (FIXTURES.md section 4): every silver rule and gold quirk on
a six-entity set small enough to check by hand."""

from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tierline.operators import funnel
from tierline.operators.silver import build_silver_all

TS = "2026-01-01T10:00:00+00:00"


@pytest.fixture(scope="module")
def raw(spark):
    L, S, D = T.LongType(), T.StringType(), T.DoubleType()

    def frame(cols, rows):
        return spark.createDataFrame(rows, T.StructType([T.StructField(n, t) for n, t in cols]))

    return {
        "advertisers": frame(
            [("id", L), ("advertiser_name", S), ("industry", S), ("website", S), ("country", S)],
            [(1, "A1", "Retail", "https://a1.com", "US"), (2, "A2", "Retail", "a2.com", "AR"),
             (3, "A3 ", "Gaming", " https://a3.com", "US")]),
        "campaigns": frame(
            [("id", L), ("advertiser_id", L), ("campaign_name", S), ("channel", S), ("objective", S),
             ("daily_budget_usd", D)],
            [(10, 1, "C10", "Search", "Traffic", 100.0), (11, 1, "C11", "Search", "Traffic", 0.0),
             (12, 2, "C12", "Social", "Awareness", 50.0), (13, 3, "C13", "Search", "Traffic", 70.0)]),
        "ads": frame(
            [("id", L), ("campaign_id", L), ("format", S), ("creative_url", S)],
            [(100, 10, "Banner", "https://cdn.example.com/x.png"), (101, 11, "Video", None),
             (102, 12, "Native", "https://cdn.example.com/y.png")]),
        "impressions": frame(
            [("id", L), ("ad_id", L), ("timestamp", S), ("country", S), ("cost_usd", D)],
            [(1000, 100, TS, "US", 0.01), (1000, 100, TS, "US", 0.01), (1001, 100, TS, "US", 0.0),
             (1002, 102, TS, "AR", 0.02)]),
        "clicks": frame(
            [("id", L), ("impression_id", L), ("timestamp", S), ("cost_usd", D)],
            [(500, 1000, TS, 1.0), (501, 1000, TS, 2.0), (502, 9999999, TS, 0.5), (503, 1002, TS, 0.7),
             (504, None, TS, 0.3)]),
        "conversions": frame(
            [("id", L), ("click_id", L), ("timestamp", S), ("value_usd", D)],
            [(900, 500, TS, 10.0), (901, 500, TS, 20.0), (902, 502, TS, 99.0), (903, 8888888, TS, 5.0)]),
    }


@pytest.fixture(scope="module")
def silver(raw):
    return {k: v.cache() for k, v in build_silver_all(raw).items()}


def test_silver_rules(silver):
    adv = {r.id: r for r in silver["advertisers"].collect()}
    assert [adv[i].website for i in (1, 2, 3)] == ["https://a1.com", "https://a2.com", "https:// https://a3.com"]
    assert adv[3].advertiser_name == "A3"
    assert silver["impressions"].count() == 3
    camp = {r.id: r.has_zero_budget for r in silver["campaigns"].collect()}
    assert camp == {10: False, 11: True, 12: False, 13: False}
    assert {r.id for r in silver["ads"].collect() if not r.has_creative_url} == {101}
    assert {r.id for r in silver["impressions"].collect() if r.is_zero_cost_impression} == {1001}
    assert {r.id for r in silver["clicks"].collect() if r.is_orphan_impression_id} == {502, 504}
    # 902 points at click 502, which exists (it is itself an orphan): not flagged.
    assert {r.id for r in silver["conversions"].collect() if r.is_orphan_click_id} == {903}


def test_silver_types(silver):
    types = dict(silver["impressions"].dtypes)
    assert types == {"id": "int", "ad_id": "int", "timestamp": "timestamp", "country": "string",
                     "cost_usd": "decimal(10,6)", "is_zero_cost_impression": "boolean"}
    assert dict(silver["campaigns"].dtypes)["daily_budget_usd"] == "decimal(10,2)"


def test_campaign_performance(silver):
    rows = {r.campaign_id: r for r in funnel.campaign_performance(silver).collect()}
    c10 = rows[10]
    assert (c10.impressions_count, c10.clicks_count, c10.conversions_count) == (4, 3, 2)
    assert c10.total_impression_cost_usd == Decimal("0.030000")
    assert c10.total_click_cost_usd == Decimal("4.0000")
    assert c10.total_conversion_value_usd == Decimal("30.00")
    assert c10.ctr == 0.75 and abs(c10.cvr - 2 / 3) < 1e-12
    assert c10.cost_per_conversion_usd == Decimal("2.015")
    assert c10.rank_in_channel == 1
    for cid in (11, 13):
        r = rows[cid]
        assert (r.impressions_count, r.clicks_count, r.conversions_count) == (0, 0, 0)
        assert r.total_impression_cost_usd is None and r.cost_per_conversion_usd is None
        assert (r.ctr, r.cvr, r.rank_in_channel) == (0.0, 0.0, 2)
    c12 = rows[12]
    assert (c12.impressions_count, c12.clicks_count, c12.conversions_count) == (1, 1, 0)
    assert c12.total_click_cost_usd == Decimal("0.7000") and c12.total_conversion_value_usd is None
    assert (c12.ctr, c12.cvr, c12.rank_in_channel) == (1.0, 0.0, 1)


def test_gold_types(silver):
    types = dict(funnel.campaign_performance(silver).dtypes)
    assert types["total_impression_cost_usd"] == "decimal(20,6)"
    assert types["total_click_cost_usd"] == "decimal(20,4)"
    assert types["total_conversion_value_usd"] == "decimal(20,2)"
    assert types["cost_per_conversion_usd"] == "decimal(38,21)"
    assert types["rank_in_channel"] == "int"
    assert dict(funnel.advertiser_revenue(silver).dtypes)["total_revenue_usd"] == "double"


def test_advertiser_revenue(silver):
    rows = {r.advertiser_id: r for r in funnel.advertiser_revenue(silver).collect()}
    got = {k: (r.total_revenue_usd, r.conversions_count, r.industry_total_revenue_usd,
               r.revenue_share_in_industry) for k, r in rows.items()}
    assert got == {1: (30.0, 2, 30.0, 1.0), 2: (0.0, 0, 30.0, 0.0), 3: (0.0, 0, 0.0, 0.0)}


def test_pivot(silver):
    rev = funnel.revenue_by_advertiser(silver)
    piv = {r.country: (r.Gaming, r.Retail) for r in funnel.revenue_pivot(rev).collect()}
    assert piv == {"AR": (None, 0.0), "US": (0.0, 30.0)}
    # explicit headings give the same table without the heading-discovery job
    piv2 = {r.country: (r.Gaming, r.Retail) for r in funnel.revenue_pivot(rev, ["Retail", "Gaming"]).collect()}
    assert piv2 == piv


def test_funnel_rows(silver):
    a = {r.campaign_id: r.funnel_rows for r in funnel.funnel_rows(silver).collect()}
    assert a == {10: 4, 11: 1, 12: 1, 13: 1}


def test_silver_with_hot_key_splitting(raw, silver):
    """Every key counted as hot: the salted FK checks flag exactly the same rows."""
    split = build_silver_all_with(raw, {"split_hot_keys": True})
    for entity, flag in [("clicks", "is_orphan_impression_id"), ("conversions", "is_orphan_click_id")]:
        a = {r.id: r[flag] for r in silver[entity].collect()}
        assert {r.id: r[flag] for r in split[entity].collect()} == a


def build_silver_all_with(raw, fk_options):
    from tierline.operators.silver import build_silver
    from tierline.rules import build_order, get_rule
    out = {}
    for name in build_order():
        out[name] = build_silver(raw[name], get_rule(name), out, fk_options=fk_options)
    return out
