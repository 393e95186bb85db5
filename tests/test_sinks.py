"""Sinks and incremental load: rerun behaviour."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from tierline.session import scratch_dir
from tierline.sources.landing import land_json, landing_path
from tierline.sources.tables import (PART_COL, create_table, ensure_schemas, list_tables, merge_upsert,
                                     overwrite_table, table_exists)
from tierline.streaming.incremental import load_new_files, read_bronze


@pytest.fixture()
def schema(spark):
    base = scratch_dir(spark, "t")
    name = f"t_{uuid.uuid4().hex[:8]}"
    ensure_schemas(spark, {name: "test"}, location_root=base)
    return name


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("partitions", [None, 4])
def test_upsert_semantics(spark, schema, partitions):
    t = f"{schema}.tgt"
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    assert merge_upsert(spark, t, target, "k", partitions=partitions)["created"]
    merge_upsert(spark, t, source, "k", partitions=partitions)
    once = _rows(spark.table(t).drop(PART_COL))
    # NULL keys never match: the source's NULL row is inserted next to the target's
    assert once == sorted([(1, "a"), (2, "B"), (3, "C"), (None, "n"), (None, "N")], key=repr)
    merge_upsert(spark, t, source.where("k IS NOT NULL"), "k", partitions=partitions)
    assert _rows(spark.table(t).drop(PART_COL)) == once


def test_upsert_rewrites_only_touched_partitions(spark, schema):
    """Most hash partitions are untouched by a 3-key source; a static overwrite would
    drop their rows.  The session setting is left alone."""
    t = f"{schema}.many"
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        merge_upsert(spark, t, spark.range(200).selectExpr("CAST(id AS INT) AS k", "'old' AS v"), "k",
                     partitions=16)
        merge_upsert(spark, t, spark.createDataFrame([(5, "new"), (500, "ins"), (77, "new")], "k int, v string"),
                     "k", partitions=16)
        got = {r.k: r.v for r in spark.table(t).collect()}
        assert len(got) == 201 and got[5] == got[77] == "new" and got[500] == "ins" and got[6] == "old"
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_upsert_with_moving_partition_key(spark, schema):
    """Partitioned by a non-key column (event day): a key whose day changes leaves its
    old partition; untouched days are not rewritten."""
    from tierline.sources.tables import event_day
    t = f"{schema}.ev"
    mk = lambda rows: spark.createDataFrame(rows, "id int, v string, ts string").withColumn(
        "ts", F.col("ts").cast("timestamp"))
    first = mk([(1, "a", "2024-01-01 10:00:00"), (2, "b", "2024-01-02 10:00:00"), (3, "c", "2024-01-03 23:59:59")])
    merge_upsert(spark, t, first, "id", partition_expr=event_day("ts"), sort_within=["ts"])
    merge_upsert(spark, t, mk([(1, "a2", "2024-01-05 00:00:00"), (4, "d", "2024-01-05 01:00:00")]), "id",
                 partition_expr=event_day("ts"), sort_within=["ts"])
    got = sorted((r.id, r.v, r._part) for r in spark.table(t).collect())
    assert got == [(1, "a2", 19727), (2, "b", 19724), (3, "c", 19725), (4, "d", 19727)]
    with pytest.raises(ValueError):
        merge_upsert(spark, t, first, "id", partitions=4, partition_expr=event_day("ts"))
    # keys that keep their day: the cheaper form gives the same table
    merge_upsert(spark, t, mk([(2, "b2", "2024-01-02 11:00:00")]), "id", partition_expr=event_day("ts"),
                 keys_may_move=False)
    got = sorted((r.id, r.v, r._part) for r in spark.table(t).collect())
    assert got == [(1, "a2", 19727), (2, "b2", 19724), (3, "c", 19725), (4, "d", 19727)]


def test_upsert_rejects_duplicate_source_keys(spark, schema):
    src = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError, match="holds key"):
        merge_upsert(spark, f"{schema}.x", src, "k")


def test_upsert_adds_new_columns(spark, schema):
    t = f"{schema}.evo"
    merge_upsert(spark, t, spark.createDataFrame([(1, "a")], "k int, v string"), "k", partitions=4)
    merge_upsert(spark, t, spark.createDataFrame([(2, "b", 9)], "k int, v string, extra int"), "k", partitions=4)
    got = {r.k: r.extra for r in spark.table(t).collect()}
    assert got == {1: None, 2: 9}


def test_create_overwrite_and_listing(spark, schema):
    df = spark.range(5).withColumnRenamed("id", "k")
    assert create_table(df, f"{schema}.c") == 5
    with pytest.raises(Exception):
        create_table(df, f"{schema}.c")
    assert overwrite_table(df.where("k < 2"), f"{schema}.c") == 2
    assert spark.table(f"{schema}.c").count() == 2
    assert table_exists(spark, f"{schema}.c")
    assert "c" in [r.tableName for r in list_tables(spark, schema).collect()]


def test_incremental_load(spark):
    base = scratch_dir(spark, "ingest-test")
    d1 = spark.createDataFrame([(1, "a"), (2, "b")], "id long, s string")
    d2 = spark.createDataFrame([(3, "c", 1.5)], "id long, s string, x double")
    land_json(d1, f"{base}/landing", "e", "2024-01-01")
    src, tbl = f"{base}/landing/e", f"{base}/bronze/e"
    assert load_new_files(spark, src, tbl)["batches"] == 1
    assert load_new_files(spark, src, tbl)["batches"] == 0  # nothing new
    # a same-day rerun leaves the landed folder untouched
    land_json(d2, f"{base}/landing", "e", "2024-01-01")
    assert load_new_files(spark, src, tbl)["batches"] == 0
    land_json(d2, f"{base}/landing", "e", "2024-01-02")
    load_new_files(spark, src, tbl)
    got = sorted((r.id, r.s, r.x) for r in read_bronze(spark, tbl).collect())
    assert got == [(1, "a", None), (2, "b", None), (3, "c", 1.5)]
    assert landing_path("/r", "e", "2024-01-02") == "/r/e/e_2024-01-02"
    with pytest.raises(ValueError):
        landing_path("/r", "e", "2024-13-02")


def test_replayed_batch_replaces_itself(spark):
    """A load that dies between the bronze write and the commit is replayed: its batch
    partition is replaced, not doubled."""
    import tierline.streaming.incremental as inc
    base = scratch_dir(spark, "replay")
    land_json(spark.createDataFrame([(1,), (2,)], "id long"), f"{base}/landing", "e", "2024-01-01")
    save, calls = inc._record_ranges, []

    def fail_once(*args):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("lost after the write")
        return save(*args)

    inc._record_ranges = fail_once
    try:
        with pytest.raises(Exception, match="lost after the write"):
            load_new_files(spark, f"{base}/landing/e", f"{base}/bronze/e")
        assert load_new_files(spark, f"{base}/landing/e", f"{base}/bronze/e")["batches"] == 1
    finally:
        inc._record_ranges = save
    assert sorted(r.id for r in read_bronze(spark, f"{base}/bronze/e").collect()) == [1, 2]


def test_landing_after_a_failed_write(spark):
    """A folder without the committer's marker is landed anew; a landed one stays."""
    base = scratch_dir(spark, "land")
    bad = spark.createDataFrame([(1, "x")], "id long, s string").withColumn("s", F.raise_error(F.lit("disk gone")))
    with pytest.raises(Exception, match="disk gone"):
        land_json(bad, base, "e", "2024-01-01")
    path = land_json(spark.createDataFrame([(1, "a")], "id long, s string"), base, "e", "2024-01-01")
    assert [(r.id, r.s) for r in spark.read.json(path).collect()] == [(1, "a")]
    land_json(spark.createDataFrame([(2, "b")], "id long, s string"), base, "e", "2024-01-01")
    assert spark.read.json(path).count() == 1


def test_every_extension_is_loaded(spark):
    import gzip
    base = scratch_dir(spark, "ext")
    folder = f"{base}/landing/e/e_2024-01-01".replace("file:", "")
    os.makedirs(folder)
    for i, name in enumerate(["a.json", "b.jsonl", "c.txt", "noextension"]):
        with open(f"{folder}/{name}", "w") as f:
            f.write(f'{{"id": {i}}}\n')
    with gzip.open(f"{folder}/d.json.gz", "wt") as f:
        f.write('{"id": 4}\n')
    with open(f"{folder}/_hidden", "w") as f:
        f.write("not json")
    assert load_new_files(spark, f"{base}/landing/e", f"{base}/bronze/e")["files"] == 5
    assert sorted(r.id for r in read_bronze(spark, f"{base}/bronze/e").collect()) == [0, 1, 2, 3, 4]
    only = load_new_files(spark, f"{base}/landing/e", f"{base}/bronze/j", pattern="*.json")
    assert only["files"] == 1


def test_file_count_and_batches_of_a_backlog(spark):
    base = scratch_dir(spark, "backlog")
    folder = f"{base}/landing/e/e_2024-01-01".replace("file:", "")
    os.makedirs(folder)
    for i in range(23):
        with open(f"{folder}/{i}.json", "w") as f:
            f.write(f'{{"id": {i}}}\n')
    got = load_new_files(spark, f"{base}/landing/e", f"{base}/bronze/e", max_files_per_batch=5)
    assert (got["batches"], got["files"], got["rows"]) == (5, 23, 23)
    assert read_bronze(spark, f"{base}/bronze/e").count() == 23


def test_null_columns_reach_bronze(spark):
    base = scratch_dir(spark, "nulls")
    land_json(spark.createDataFrame([(1, None)], "id long, v double"), f"{base}/landing", "e", "2024-01-01")
    load_new_files(spark, f"{base}/landing/e", f"{base}/bronze/e")
    assert read_bronze(spark, f"{base}/bronze/e").columns == ["id", "v"]


def _values(spark, table):
    return sorted((r.k, r.v) for r in spark.table(table).collect())


def test_upsert_adopts_the_recorded_layout(spark, schema):
    t = f"{schema}.adopt"
    mk = lambda rows: spark.createDataFrame(rows, "k long, v string")
    merge_upsert(spark, t, mk([(i, "old") for i in range(6)]), "k", partitions=4)
    merge_upsert(spark, t, mk([(i, "new") for i in range(6)]), "k", partitions=5)
    assert _values(spark, t) == [(i, "new") for i in range(6)]
    assert {r._part for r in spark.table(t).collect()} <= set(range(4))
    with pytest.raises(ValueError, match="laid out"):
        merge_upsert(spark, t, mk([(1, "x")]), "k", partition_expr=F.col("k").cast("int"))


@pytest.mark.parametrize("partitions", [None, 4])
def test_upsert_casts_keys_to_the_tables_type(spark, schema, partitions):
    t = f"{schema}.width{partitions or 0}"
    merge_upsert(spark, t, spark.createDataFrame([(i, "old") for i in range(6)], "k long, v string"), "k",
                 partitions=partitions)
    merge_upsert(spark, t, spark.createDataFrame([(i, "new") for i in range(4)], "k int, v string"), "k",
                 partitions=partitions)
    assert _values(spark, t) == [(i, "new") for i in range(4)] + [(4, "old"), (5, "old")]
    narrow = f"{schema}.narrow{partitions or 0}"
    merge_upsert(spark, narrow, spark.createDataFrame([(1, "a")], "k int, v string"), "k", partitions=partitions)
    with pytest.raises(Exception, match="does not fit"):
        merge_upsert(spark, narrow, spark.createDataFrame([(2 ** 40, "b")], "k long, v string"), "k",
                     partitions=partitions)
    assert _values(spark, narrow) == [(1, "a")]


def test_upsert_clears_the_null_day_and_many_emptied_days(spark, schema):
    t = f"{schema}.days"
    day = F.col("d")
    mk = lambda rows: spark.createDataFrame(rows, "k int, d int, v string")
    merge_upsert(spark, t, mk([(0, None, "old"), (1, None, "old")] + [(i, i, "old") for i in range(2, 40)]), "k",
                 partition_expr=day)
    merge_upsert(spark, t, mk([(i, 1000, "new") for i in range(0, 38)]), "k", partition_expr=day)
    assert sorted((r.k, r.d, r.v) for r in spark.table(t).collect()) == [
        (i, 1000, "new") for i in range(38)] + [(38, 38, "old"), (39, 39, "old")]
    parts = {r.partition for r in spark.sql(f"SHOW PARTITIONS {t}").collect()}
    assert parts == {f"{PART_COL}=1000", f"{PART_COL}=38", f"{PART_COL}=39"}


@pytest.mark.parametrize("with_path", [False, True])
def test_failed_unpartitioned_write_keeps_the_table(spark, schema, with_path):
    t = f"{schema}.plain{int(with_path)}"
    path = scratch_dir(spark, "plain") if with_path else None
    mk = lambda rows: spark.createDataFrame(rows, "k int, v string")
    merge_upsert(spark, t, mk([(i, "old") for i in range(4)]), "k", path=path)
    bad = mk([(1, "new")]).withColumn("v", F.raise_error(F.lit("disk gone")).cast("string"))
    with pytest.raises(Exception, match="disk gone"):
        merge_upsert(spark, t, bad, "k", path=path)
    with pytest.raises(Exception, match="disk gone"):
        overwrite_table(bad, t, path)
    assert _values(spark, t) == [(i, "old") for i in range(4)]
    merge_upsert(spark, t, mk([(1, "new"), (9, "new")]), "k", path=path)
    assert _values(spark, t) == [(0, "old"), (1, "new"), (2, "old"), (3, "old"), (9, "new")]
    assert overwrite_table(spark.table(t).where("k = 9"), t, path) == 1      # reads what it replaces
    assert _values(spark, t) == [(9, "new")]


def test_upsert_deletes_its_staged_copies(spark, schema):
    root = spark.sparkContext.getCheckpointDir().replace("file:", "")
    before = set(os.listdir(root))
    t = f"{schema}.clean"
    src = spark.createDataFrame([(1, 2, "a")], "k int, d int, v string")
    for _ in range(2):
        merge_upsert(spark, t, src, "k", partition_expr=F.col("d"))
    assert set(os.listdir(root)) == before


def test_upsert_evaluates_its_source_once(spark, schema):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    t = f"{schema}.once"
    for tag in "ab":
        src = spark.createDataFrame([(i, tag) for i in range(10)], "k int, v string")
        merge_upsert(spark, t, src.mapInArrow(count, src.schema), "k", partitions=3)
    assert seen.value == 20


def test_schemas_current_and_listing(spark):
    from tierline.sources.tables import list_schemas, use_schema
    base = scratch_dir(spark, "schemas")
    names = {f"s_{uuid.uuid4().hex[:6]}": "layer one", f"s_{uuid.uuid4().hex[:6]}": "it's two"}
    assert ensure_schemas(spark, names, location_root=base) == list(names)
    ensure_schemas(spark, names, location_root=base)  # IF NOT EXISTS: a rerun is fine
    listed = {r[0] for r in list_schemas(spark).collect()}
    assert set(names) <= listed
    before = spark.catalog.currentDatabase()
    try:
        first = list(names)[0]
        use_schema(spark, first)
        assert spark.catalog.currentDatabase() == first
        comment = [r for r in spark.sql(f"DESCRIBE SCHEMA {first}").collect() if r[0] == "Comment"][0][1]
        assert comment == "layer one"
    finally:
        use_schema(spark, before)


@pytest.mark.parametrize("layout", ["none", "hash", "day"])
def test_upsert_matches_merge_model(spark, schema, layout):
    """Random target and two successive sources (NULL keys, keys changing day, new
    keys) against a plain-Python MERGE model."""
    import random
    from tierline.sources.tables import event_day
    rnd = random.Random(len(layout))

    def rows(n, tag):
        keys = rnd.sample(range(60), n)
        return [(k if rnd.random() > 0.1 else None, f"{tag}{k}", f"2024-01-{rnd.randint(1, 9):02d} 12:00:00")
                for k in keys]

    def frame(rs):
        return spark.createDataFrame(rs, "k int, v string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))

    kw = {"none": {}, "hash": {"partitions": 5}, "day": {"partition_expr": event_day("ts")}}[layout]
    t = f"{schema}.m_{layout}"
    model = []
    for step, rs in enumerate([rows(30, "t"), rows(20, "a"), rows(25, "b")]):
        merge_upsert(spark, t, frame(rs), "k", **kw)
        incoming = {k for k, _, _ in rs if k is not None}
        model = [r for r in model if r[0] is None or r[0] not in incoming] + list(rs)
    got = sorted(((r.k, r.v) for r in spark.table(t).collect()), key=repr)
    assert got == sorted(((k, v) for k, v, _ in model), key=repr)
