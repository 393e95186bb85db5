"""The leaf-first rollup against the joined SQL on random funnels, and exact
results when a third of all rows sit on one key."""

import random
from contextlib import contextmanager
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierline import oracle
from tierline.operators import funnel
from tierline.rules import FkCheck
from tierline.operators.asof import running_max
from tierline.operators.quality import dedup, flag_orphans
from tierline.operators.ranking import pivot_sum, rank_in_group, share_of_group, value_ranks


def _silver(spark, seed):
    """Random silver-shaped tables: unique campaign / advertiser ids, children with
    random (sometimes NULL or dangling) parents, repeated child ids, NULL costs."""
    rnd = random.Random(seed)
    adv = [(i, f"A{i}", rnd.choice(["x", "y"]), "US") for i in range(1, 6)]
    camp = [(i, rnd.choice([1, 2, 3, 4, 5, None]), f"C{i}", rnd.choice(["s", "t"]), "o") for i in range(1, 13)]
    ads = [(rnd.randrange(1, 30), rnd.choice([None] + list(range(1, 15)))) for _ in range(40)]
    imps = [(rnd.randrange(1, 60), rnd.choice([None] + list(range(1, 32))),
             rnd.choice([None, Decimal("0.010000"), Decimal("0.123456")])) for _ in range(120)]
    clicks = [(rnd.randrange(1, 80), rnd.choice([None] + list(range(1, 62))),
               rnd.choice([None, Decimal("1.5000"), Decimal("0.2500")]), rnd.random() < 0.1) for _ in range(160)]
    convs = [(rnd.randrange(1, 90), rnd.choice([None] + list(range(1, 82))),
              rnd.choice([None, Decimal("10.00"), Decimal("3.25")]), rnd.random() < 0.1) for _ in range(150)]
    return {
        "advertisers": spark.createDataFrame(adv, "id int, advertiser_name string, industry string, country string"),
        "campaigns": spark.createDataFrame(camp, "id int, advertiser_id int, campaign_name string, channel string, "
                                                 "objective string"),
        "ads": spark.createDataFrame(ads, "id int, campaign_id int"),
        "impressions": spark.createDataFrame(imps, "id int, ad_id int, cost_usd decimal(10,6)"),
        "clicks": spark.createDataFrame(clicks, "id int, impression_id int, cost_usd decimal(10,4), "
                                                "is_orphan_impression_id boolean"),
        "conversions": spark.createDataFrame(convs, "id int, click_id int, value_usd decimal(10,2), "
                                                    "is_orphan_click_id boolean"),
    }


def _by(df, key):
    return {r[key]: tuple(r) for r in df.collect()}


def _sql(s, body):
    """``body`` run by DuckDB over the six tables under their silver names."""
    con = duckdb.connect()
    for name, df in s.items():
        con.register(f"p_{name}", df.toPandas())
        types = {"int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}
        cols = ", ".join(f"CAST({c} AS {types.get(t, t.upper())}) AS {c}" for c, t in df.dtypes)
        con.execute(f"CREATE TABLE s_{name} AS SELECT {cols} FROM p_{name}")
    return con.sql(body).fetchall()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rollup_equals_joined_sql(spark, seed):
    s = _silver(spark, seed)
    cols = ["campaign_id", "impressions_count", "clicks_count", "conversions_count", "total_impression_cost_usd",
            "total_click_cost_usd", "total_conversion_value_usd"]
    want = _sql(s, f"WITH {oracle.CAMPAIGN_AGG} SELECT {', '.join(cols)} FROM camp_agg")
    assert sorted(map(tuple, funnel.campaign_performance(s).select(*cols).collect())) == sorted(want)
    rows = _sql(s, f"SELECT c.id, count(*) {oracle.FUNNEL_FROM} GROUP BY c.id")
    assert sorted(map(tuple, funnel.funnel_rows(s).collect())) == sorted(rows)


@pytest.mark.parametrize("seed", [4, 5])
def test_revenue_rollup_equals_joined_sql(spark, seed):
    s = _silver(spark, seed)  # repeated child ids included
    cols = ["advertiser_id", "total_revenue_usd", "conversions_count"]
    want = _sql(s, f"WITH {oracle.ADVERTISER_AGG} SELECT {', '.join(cols)} FROM adv_agg")
    assert sorted(map(tuple, funnel.revenue_by_advertiser(s).select(*cols).collect())) == sorted(want)


@pytest.mark.parametrize("seed", [6, 7])
def test_rollups_over_keys_of_two_columns(spark, seed):
    """Every id cut into (quotient, remainder): ids alone mean nothing, the pairs do."""
    s = _silver(spark, seed)
    two, links = {}, {}
    for name, df in s.items():
        fk = funnel.LINKS.get(name)
        for c in ["id", *(fk.child_columns if fk else [])]:
            df = df.withColumn(f"{c}_day", F.col(c) % 3).withColumn(c, F.expr(f"`{c}` div 3"))
        if fk:
            c = fk.child_columns[0]
            links[name] = FkCheck(fk.parent, ("id", "id_day"), (c, f"{c}_day"))
            if fk.flag in df.columns:
                df = df.withColumnRenamed(fk.flag, links[name].flag)
        two[name] = df
    numbers = ["funnel_rows", "impressions_count", "clicks_count", "conversions_count", "total_impression_cost_usd",
               "total_click_cost_usd", "total_conversion_value_usd"]
    key = lambda r: str(tuple(r))
    a, b = (funnel.campaign_rollup(x, l).select(*numbers).collect() for x, l in ((s, funnel.LINKS), (two, links)))
    assert sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)
    a, b = (funnel.revenue_by_advertiser(x, l).select("total_revenue_usd", "conversions_count").collect()
            for x, l in ((s, funnel.LINKS), (two, links)))
    assert sum(r[1] for r in a) == sum(r[1] for r in b) > 0 and sum(r[0] for r in a) == sum(r[0] for r in b)


def test_hot_user_running_max(spark):
    """A third of all events on one user, blocks far smaller than that user."""
    rnd = random.Random(11)
    rows = [(i, 7 if i % 3 == 0 else rnd.randrange(50), rnd.choice(["view", "click", "x"])) for i in range(3000)]
    df = spark.createDataFrame(rows, "eid long, u long, t string")
    vals = {"lv": F.when(F.col("t") == "view", F.col("eid"))}
    ours = running_max(df, "u", "eid", vals, block=64)
    ref = df.withColumn("lv", F.max(vals["lv"]).over(
        Window.partitionBy("u").orderBy("eid").rowsBetween(Window.unboundedPreceding, 0)))
    assert _by(ours.select("eid", "lv"), "eid") == _by(ref.select("eid", "lv"), "eid")


def test_hot_key_dedup_and_null_fk_flags(spark):
    n = 3000
    rows = [(0 if i % 3 == 0 else i, None if i % 3 == 1 else i % 97, float(i)) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, fk long, v double")
    kept = dedup(df, "k").where("k = 0").collect()
    assert len(kept) == 1 and kept[0].v == 0.0
    parent = spark.range(0, 97, 2).withColumnRenamed("id", "pk")
    flags = flag_orphans(df, parent, "pk", "fk").groupBy("is_orphan_fk").count()
    expected_orphans = sum(1 for _, fk, _ in rows if fk is None or fk % 2 == 1)
    assert dict((r[0], r[1]) for r in flags.collect()) == {True: expected_orphans, False: n - expected_orphans}


def test_flag_orphans_splits_hot_keys(spark):
    """Explicit hot-key splitting gives the same flags, and no task gets a hot key whole
    even without adaptive execution."""
    n = 3000
    rows = [(i, 5 if i % 3 == 0 else (None if i % 3 == 1 else i % 97)) for i in range(n)]
    df = spark.createDataFrame(rows, "cid long, fk long")
    parent = spark.range(0, 97, 2).selectExpr("CAST(id AS INT) AS pk")
    plain = {r.cid: r.is_orphan_fk for r in flag_orphans(df, parent, "pk", "fk").collect()}
    with _plain_plans(spark):
        out = flag_orphans(df, parent, "pk", "fk", split_hot_keys=True)
        assert {r.cid: r.is_orphan_fk for r in out.collect()} == plain
        assert out.columns == ["cid", "fk", "is_orphan_fk"]
        assert _largest_share(out) < 0.3
        # key 97 is absent from the parent: a hot orphan key stays an orphan when dealt out
        hot_orphan = spark.createDataFrame([(i, 97) for i in range(600)], "cid long, fk long")
        assert flag_orphans(hot_orphan, parent, "pk", "fk", split_hot_keys=True).where("is_orphan_fk").count() == 600


@contextmanager
def _plain_plans(spark):
    """No adaptive execution and no automatic broadcast: what the plan itself does."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _largest_share(df):
    """Largest share of the rows that one task of the last stage gets."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / sum(sizes)


def _reference_rank(df):
    return {r.i: r.r for r in df.withColumn(
        "r", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last()))).collect()}


@pytest.mark.parametrize("case", ["uniform", "nulls", "narrow", "hot", "special"])
def test_rank_whatever_the_values(spark, case):
    rnd = random.Random(case)
    value = {"uniform": lambda i: round(rnd.uniform(0, 1000), 2),
             "nulls": lambda i: None if i % 50 else float(i),                      # 98 % NULL
             "narrow": lambda i: 20000 + rnd.randrange(200) / 1.0,                 # within 1 %
             "hot": lambda i: 7.0 if i % 3 == 0 else rnd.uniform(0, 10),           # a third on one value
             "special": lambda i: rnd.choice([float("nan"), float("inf"), float("-inf"), -0.0, 0.0, None, 1e-300, -5.0]),
             }[case]
    rows = [(i, "hot" if i % 3 else rnd.choice(["a", "b", None]), value(i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "i long, g string, v double").repartition(4)
    want = _reference_rank(df)
    with _plain_plans(spark):
        ours = rank_in_group(df, "g", "v", "r")
        assert {r.i: r.r for r in ours.collect()} == want
        assert _largest_share(ours) < 0.35
        ranges = value_ranks(df, "g", "v")
        if case in ("uniform", "narrow"):
            sizes = [r["count"] for r in ranges.groupBy(F.spark_partition_id()).count().collect()]
            assert max(sizes) <= 0.5 * sum(sizes)


def test_hot_group_share(spark):
    rnd = random.Random(3)
    rows = [("hot" if i % 3 else rnd.choice(["a", "b", None]), round(rnd.uniform(0, 1000), 2)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double")
    with _plain_plans(spark):
        out = share_of_group(df, "g", "v", "t", "s")
        tot = {r.g: r.t for r in out.select("g", "t").distinct().collect()}
        assert _largest_share(out) < 0.5
    ref_tot = {r.g: r.t for r in df.groupBy("g").agg(F.sum("v").alias("t")).collect()}
    assert tot.keys() == ref_tot.keys() and all(abs(tot[k] - ref_tot[k]) < 1e-6 for k in tot)


def test_pivot_fails_on_an_unlisted_heading(spark):
    df = spark.createDataFrame([("x", "a", 1.0), ("x", "b", 2.0)], "r string, c string, v double")
    assert [r.asDict() for r in pivot_sum(df, "r", "c", "v").collect()] == [{"r": "x", "a": 1.0, "b": 2.0}]
    with pytest.raises(Exception, match="outside the given headings: b"):
        pivot_sum(df, "r", "c", "v", ["a"]).collect()
