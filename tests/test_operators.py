"""Operator properties against brute-force forms on small generated frames."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.columns import apply_casts, apply_named, fix_protocol, trim_strings
from tierline.operators.asof import running_max
from tierline.operators.quality import dedup, dedup_metrics, event_window, flag_orphans
from tierline.operators.ranking import pivot_sum, rank_in_group, share_of_group
from tierline.rules import REGISTRY, EntityRule, FkCheck, build_order, get_rule


def test_get_rule_rejects_unknown():
    with pytest.raises(ValueError, match="valid entities"):
        get_rule("nope")


def test_build_order_parents_first():
    order = build_order()
    assert order.index("impressions") < order.index("clicks") < order.index("conversions")
    # a registry listing the child first is reordered
    reg = {"kids": EntityRule("kids", False, fk_checks=(FkCheck("parents", "id", "pid"),)),
           "parents": EntityRule("parents", False)}
    assert build_order(reg) == ["parents", "kids"]
    cyc = {"a": EntityRule("a", False, fk_checks=(FkCheck("b", "id", "x"),)),
           "b": EntityRule("b", False, fk_checks=(FkCheck("a", "id", "y"),))}
    with pytest.raises(ValueError, match="cycle"):
        build_order(cyc)
    assert set(order) == set(REGISTRY)


def _rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_dedup_keeps_first_by_full_order(spark):
    df = spark.createDataFrame(
        [(1, "b", 2.0), (1, "a", 3.0), (1, "a", 1.0), (2, None, 5.0), (2, "z", 0.0), (None, "q", 1.0),
         (None, "p", 1.0)], "k long, s string, v double")
    out = dedup(df, "k")
    assert _rows(out, "k", "s", "v") == sorted([(1, "a", 1.0), (2, None, 5.0), (None, "p", 1.0)], key=repr)
    # idempotent, one row per key
    assert _rows(dedup(out, "k"), "k", "s", "v") == _rows(out, "k", "s", "v")
    m = dedup_metrics(df, "k").first()
    assert (m.rows_before, m.rows_after, m.duplicates_removed) == (7, 3, 4)


def test_dedup_plan_has_partial_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    plan = dedup(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_flag_orphans_matches_not_exists(spark):
    rnd = random.Random(7)
    parent = spark.createDataFrame([(i,) for i in range(0, 50, 3)], "id int")
    child_rows = [(i, rnd.choice([None, rnd.randrange(60)])) for i in range(300)]
    child = spark.createDataFrame(child_rows, "cid long, fk long")
    flagged = {r.cid: r.is_orphan_fk for r in flag_orphans(child, parent, "id", "fk").collect()}
    parents = set(range(0, 50, 3))
    assert flagged == {cid: (fk is None or fk not in parents) for cid, fk in child_rows}


@pytest.mark.parametrize("seed", [1, 4])
def test_rank_in_group_equals_window(spark, seed):
    rnd = random.Random(seed)
    vals = [None, 0.0, -0.0, -1.5, 1e-9, 3.0, 3.0, 1e12, -1e12, 7.25, 1.7e308, -1.7e308,
            float("inf"), float("-inf"), float("nan")]
    rows = [(rnd.choice(["a", "b", None]), rnd.choice(vals + [rnd.uniform(-100, 100)])) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, v double").withColumn("i", F.monotonically_increasing_id())
    ours = rank_in_group(df, "g", "v", "r")
    ref = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())))
    assert _rows(ours, "i", "r") == _rows(ref, "i", "r")


def test_rank_in_group_decimal(spark):
    df = spark.createDataFrame([("x", "1.50"), ("x", "2.25"), ("x", None), ("x", "2.25")], "g string, v string") \
        .withColumn("v", F.col("v").cast("decimal(20,2)"))
    assert sorted(r.r for r in rank_in_group(df, "g", "v", "r").collect()) == [1, 1, 3, 4]


@pytest.mark.parametrize("block", [1, 3, 1 << 16])
def test_running_max_equals_window(spark, block):
    rnd = random.Random(block)
    rows = [(i, rnd.choice([1, 2, 3, None]), rnd.choice(["view", "click", "other"])) for i in range(500)]
    df = spark.createDataFrame(rows, "eid long, u long, t string")
    vals = {"lv": F.when(F.col("t") == "view", F.col("eid")), "lc": F.when(F.col("t") == "click", F.col("eid"))}
    ours = running_max(df, "u", "eid", vals, block=block)
    w = Window.partitionBy("u").orderBy("eid").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumns({k: F.max(v).over(w) for k, v in vals.items()})
    assert _rows(ours, "eid", "lv", "lc") == _rows(ref, "eid", "lv", "lc")


def test_running_max_shuffles_the_rows_once(spark):
    df = spark.createDataFrame([(1, 1, "view", "x")], "eid long, u long, t string, payload string")
    plan = running_max(df, "u", "eid", {"lv": F.when(F.col("t") == "view", F.col("eid"))})._jdf.queryExecution()
    plan = plan.optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Window") == 2     # the carry-ins and the rows


def test_share_of_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 0.0), (None, 2.0), ("c", None)], "g string, v double")
    got = {(r.g, r.v): (r.t, r.s) for r in share_of_group(df, "g", "v", "t", "s").collect()}
    assert got == {("a", 1.0): (4.0, 0.25), ("a", 3.0): (4.0, 0.75), ("b", 0.0): (0.0, 0.0),
                   (None, 2.0): (2.0, 1.0), ("c", None): (None, 0.0)}


def test_pivot_sum(spark):
    df = spark.createDataFrame([("US", "x", 1.0), ("US", "x", 2.0), ("AR", "y", 5.0)], "r string, c string, v double")
    got = {r.r: (r.x, r.y) for r in pivot_sum(df, "r", "c", "v").collect()}
    assert got == {"US": (3.0, None), "AR": (None, 5.0)}


def test_fix_protocol_and_trim_quirks(spark):
    df = spark.createDataFrame([(" https://x",), ("HTTPS://x",), ("httpfoo.com",), (None,), ("http://ok",)], "u string")
    out = [r.u for r in trim_strings(fix_protocol(df, "u")).collect()]
    assert out == ["https:// https://x", "https://HTTPS://x", "https://httpfoo.com", None, "http://ok"]


def test_trim_only_top_level_strings(spark):
    df = spark.createDataFrame([(" a ", 1, (" n ",))], "s string, i int, st struct<x:string>")
    r = trim_strings(df).first()
    assert r.s == "a" and r.st.x == " n "


def test_casts_ansi_and_try_cast(spark):
    df = spark.createDataFrame([("12",), ("x",)], "v string")
    with pytest.raises(Exception):
        apply_casts(df, {"v": "int"}).collect()
    assert [r.v for r in apply_casts(df, {"v": "int"}, try_cast=True).collect()] == [12, None]
    with pytest.raises(ValueError):
        apply_casts(df, {"nope": "int"})


def test_apply_named_unknown(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="unknown transform"):
        apply_named(df, ["nope"])


def test_event_window(spark):
    base = dt.datetime(2024, 1, 10)
    rows = [(base + dt.timedelta(hours=h),) for h in range(-6, 80, 6)] + [(dt.datetime(2024, 1, 13),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = [r.ts for r in event_window(df, "ts", "2024-01-10", "2024-01-12").collect()]
    assert min(got) == base and max(got) < dt.datetime(2024, 1, 13)
    one = [r.ts.date() for r in event_window(df, "ts", "2024-01-11").collect()]
    assert set(one) == {dt.date(2024, 1, 11)}
    y = event_window(df, "ts", today=dt.date(2024, 1, 12)).collect()
    assert {r.ts.date() for r in y} == {dt.date(2024, 1, 11)}
    with pytest.raises(ValueError):
        event_window(df, "ts", end="2024-01-12")
    from tierline.session import scratch_dir
    path = scratch_dir(spark, "ew")
    df.write.parquet(path)
    plan = event_window(spark.read.parquet(path), "ts", "2024-01-10")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_event_window_zoned(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 10, 23, 30, tzinfo=dt.timezone.utc),)],
                               T.StructType([T.StructField("ts", T.TimestampType())]))
    assert event_window(df, "ts", "2024-01-10").count() == 1
    assert event_window(df, "ts", "2024-01-11").count() == 0


def test_flag_orphans_shuffles_each_side_once(spark):
    """With broadcast off: bigint FK vs int parent key, one exchange per join side."""
    child = spark.range(1000).selectExpr("id", "id % 77 AS fk")
    parent = spark.range(50).selectExpr("CAST(id AS INT) AS pid")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = flag_orphans(child, parent, "pid", "fk")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        assert plan.count("Exchange hashpartitioning") == 2
        assert out.where("is_orphan_fk").count() == sum(1 for i in range(1000) if i % 77 >= 50)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_checkpoint_dir_required_off_local_mode():
    from tierline.session import ensure_checkpoint_dir

    class FakeSC:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class FakeSession:
        sparkContext = FakeSC()

    with pytest.raises(ValueError, match="shared storage"):
        ensure_checkpoint_dir(FakeSession())


def test_checkpoint_dir_on_a_local_path_is_pointed_out():
    from tierline.session import ensure_checkpoint_dir

    class FakeSC:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return "file:/tmp/somewhere"

    class FakeSession:
        sparkContext = FakeSC()

    with pytest.warns(UserWarning, match="every executor"):
        assert ensure_checkpoint_dir(FakeSession()) == "file:/tmp/somewhere"


def test_map_columns_go_through_flags_ranks_and_profiles(spark):
    from tierline.operators.quality import exact_duplicate_rows
    from tierline.operators.ranking import rank_in_group, share_of_group
    df = spark.sql("SELECT id, id % 3 AS g, CAST(id AS DOUBLE) AS v, map('k', id % 2) AS m, array(map('x', 1)) AS deep "
                   "FROM range(30) UNION ALL SELECT 1, NULL, NULL, map('k', 1L), array(map('x', 1))")
    parent = spark.range(2).withColumnRenamed("id", "k")
    for split in (False, True):
        got = flag_orphans(df, parent, "k", "g", split_hot_keys=split)
        assert got.where("is_orphan_g").count() == 11 and got.columns == [*df.columns, "is_orphan_g"]
    assert rank_in_group(df, "g", "v", "r").where("r = 1").count() == 4
    assert share_of_group(df, "g", "v", "t", "s").count() == 31
    twice = df.unionAll(df.where("id < 5"))
    assert tuple(exact_duplicate_rows(twice).first()) == (37, 6)


def test_exact_duplicates_by_fingerprint(spark):
    from tierline.operators.quality import exact_duplicate_rows
    rows = [(1, "a", 0.0, None), (1, "a", -0.0, None), (None, "a", 1.0, "a"), ("a" and None, None, 1.0, "a"), (2, None, float("nan"), "x"),
            (2, None, float("nan"), "x"), (2, None, float("nan"), "x"), (None, None, None, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "a int, b string, c double, d string").repartition(3)
    slow = df.groupBy(*df.columns).count().selectExpr("sum(count)", "sum(count - 1)").first()
    assert tuple(exact_duplicate_rows(df).first()) == tuple(slow) == (9, 4)
    assert tuple(exact_duplicate_rows(df.where("false")).first()) == (0, 0)
    plan = exact_duplicate_rows(df)._jdf.queryExecution().executedPlan().toString()
    first = next(line for line in plan.splitlines() if "hashpartitioning(_f0" in line)
    assert "b#" not in first        # the counting shuffle carries the fingerprint only


def test_composite_foreign_keys_match_not_exists(spark):
    import random
    rng = random.Random(3)
    pick = lambda n: [None, *range(n)][rng.randrange(n + 1)]
    child = [(i, pick(5), rng.choice([None, "d1", "d2", "d3"])) for i in range(200)]
    parent = [(pick(4), rng.choice([None, "d1", "d2"])) for _ in range(6)]
    df = spark.createDataFrame(child, "id int, k int, day string")
    pf = spark.createDataFrame(parent, "pk long, pday string")
    for split in (False, True):
        got = {r.id: r.is_orphan_k_day for r in flag_orphans(df, pf, ["pk", "pday"], ["k", "day"], split_hot_keys=split).collect()}
        assert got == {i: k is None or d is None or (k, d) not in set(parent) for i, k, d in child}
    with pytest.raises(ValueError):
        flag_orphans(df, pf, ["pk"], ["k", "day"])
