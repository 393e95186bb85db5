"""Incremental loading: types that grow, bad input set aside, one scan of the files."""

import gzip
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.types import ddl, joined_type, same_type, upcast_sql
from tierline.session import scratch_dir
from tierline.sources.tables import ensure_schemas, table_exists
from tierline.streaming.incremental import (REASONS, _line_counts, _parsed_lines, latest_load, load_new_files, loaded_rows, read_bronze, read_outcomes, read_rejects,
                                            register_bronze, variant_types)


class _Landing:
    def __init__(self, spark, **options):
        self.spark, self.options = spark, options
        self.base = scratch_dir(spark, "loading")
        self.dir, self.bronze = f"{self.base}/landing/e", f"{self.base}/bronze/e"
        self.schema = f"l_{uuid.uuid4().hex[:8]}"
        ensure_schemas(spark, {self.schema: "loading test"}, location_root=self.base)

    def put(self, day, *files):
        folder = f"{self.dir.replace('file:', '')}/e_{day}"
        os.makedirs(folder, exist_ok=True)
        for i, lines in enumerate(files):
            text = lines if isinstance(lines, str) else "\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines)
            with open(f"{folder}/part-{i}.json", "w", encoding="utf-8") as f:
                f.write(text)
        return folder

    def load(self):
        return load_new_files(self.spark, self.dir, self.bronze, **self.options)

    def rows(self, *order):
        df = read_bronze(self.spark, self.bronze)
        return df, sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: r["id"])

    def listed(self):
        register_bronze(self.spark, f"{self.schema}.e", self.bronze)
        return self.spark.table(f"{self.schema}.e")


def test_types_widen_over_batches(spark):
    at = _Landing(spark)
    at.put(1, [{"id": 1, "n": 1, "s": None, "list": [1], "kept": "a", "big": 5}])
    at.load()
    one = at.listed()
    assert one.schema["n"].dataType == T.LongType() and one.schema["s"].dataType == T.StringType()
    at.put(2, [{"id": 2, "n": 0.5, "s": {"x": 1}, "list": [2, None], "big": 10 ** 25}])
    at.load()
    at.put(3, [{"id": 3, "n": "three", "s": {"x": 2.5, "y": "z"}, "list": [0.25], "kept": "b", "new": True}])
    at.load()
    df, rows = at.rows()
    assert df.schema["list"].dataType == T.ArrayType(T.DoubleType())
    assert [r["n"] for r in rows] == ["1", "0.5", "three"]
    assert [r["s"] for r in rows] == [None, {"x": 1.0, "y": None}, {"x": 2.5, "y": "z"}]
    assert [r["list"] for r in rows] == [[1.0], [2.0, None], [0.25]]
    assert [r["kept"] for r in rows] == ["a", None, "b"] and [r["new"] for r in rows] == [None, None, True]
    assert [int(r["big"]) if r["big"] is not None else None for r in rows] == [5, 10 ** 25, None]
    listed = at.listed()
    assert sorted((r.asDict(recursive=True) for r in listed.drop("_load_batch").collect()), key=lambda r: r["id"]) == rows
    assert [f.dataType for f in listed.drop("_load_batch").schema] == [f.dataType for f in df.schema]
    at.put(4, [{"id": 4, "n": 7}])          # a later batch fits: same types, the view gets its rows
    at.load()
    assert at.listed().count() == 4 and at.rows()[1][3]["n"] == "7"


def test_nested_nulls_and_spellings_over_batches(spark):
    """A nested NULL becomes a struct, and a nested name comes in another case."""
    at = _Landing(spark)
    for day, d in enumerate([{"z": None, "A": 1}, {"z": {"a": 1}, "a": 2}, {"z": {"a": 0.5}, "A": "x"}]):
        at.put(day, [{"id": day, "d": d, "e": None if not day else {"k": [None] if day == 1 else [{"q": 1}]}}])
        at.load()
    df, rows = at.rows()
    assert [r["d"]["z"] for r in rows] == [None, {"a": 1.0}, {"a": 0.5}]
    assert [r["d"]["A"] for r in rows] == ["1", "2", "x"]
    assert [r["e"] for r in rows] == [None, {"k": [None]}, {"k": [{"q": 1}]}]
    assert at.listed().count() == 3


def test_fractions_after_whole_numbers_and_back(spark):
    at = _Landing(spark)
    for day, n in enumerate([1, 0.5, 2]):
        at.put(day, [{"id": day, "n": n}])
        at.load()
    df, rows = at.rows()
    assert df.schema["n"].dataType == T.DoubleType() and [r["n"] for r in rows] == [1.0, 0.5, 2.0]


def test_bad_lines_are_set_aside_and_loading_goes_on(spark):
    at = _Landing(spark)
    good = {"id": 1, "v": "ä"}
    at.put(1, [good, "{bad", '{"id":2,"id":3}', "7", "null", "", "  ", '[{"id":4},{"id":5}]', "[1]", "[]"],
           ["{never closed"], "\n \n")
    got = at.load()
    assert got["rows"] == 3 and got["rejected"] == 6 and got["files"] == 3
    at.put(2, [{"id": 9, "v": "later"}])
    assert at.load()["rows"] == 1
    _, rows = at.rows()
    assert [(r["id"], r["v"]) for r in rows] == [(1, "ä"), (4, None), (5, None), (9, "later")]
    rejects = {(r.line, r.reason) for r in read_rejects(spark, at.bronze).collect()}
    assert {line for line, _ in rejects} == {"{bad", '{"id":2,"id":3}', "7", "null", "[1]", "{never closed"}
    assert ("7", "not an object") in rejects and ("[1]", "not a list of objects") in rejects
    by_name = {(os.path.basename(r.file), r._load_batch): r for r in read_outcomes(spark, at.bronze).collect()}
    assert {k: v.status for k, v in by_name.items()} == {
        ("part-0.json", 0): "partly", ("part-1.json", 0): "rejected", ("part-2.json", 0): "empty", ("part-0.json", 1): "loaded"}
    assert (by_name["part-0.json", 0].lines, by_name["part-0.json", 0].rows, by_name["part-0.json", 0].rejected) == (8, 3, 5)
    assert loaded_rows(spark, at.bronze) == 4 and latest_load(spark, at.bronze) == 1


def test_unreadable_files_are_set_aside(spark):
    at = _Landing(spark)
    folder = at.put(1, [{"id": 1}], [{"id": 2}], [{"id": 3}])
    with gzip.open(f"{folder}/good.json.gz", "wt") as f:
        f.write('{"id": 4}\n')
    whole = gzip.compress(b'{"id": 5}\n' * 5000)
    with open(f"{folder}/cut.json.gz", "wb") as f:
        f.write(whole[:len(whole) // 2])
    got = at.load()
    assert got["rows"] == 4 and got["unreadable"] == 1
    assert [r["id"] for r in at.rows()[1]] == [1, 2, 3, 4]
    bad = {os.path.basename(r.file): r.reason for r in read_outcomes(spark, at.bronze).where("status = 'unreadable'").collect()}
    assert set(bad) == {"cut.json.gz"} and all(bad.values())
    at.put(2, [{"id": 7}])
    assert at.load()["rows"] == 1


def test_odd_names(spark):
    at = _Landing(spark)
    at.put(1, [{"id": 1, "Name": "a", "_load_batch": 3, "we`ird n'ame.x": 1, "OBJECT<": 2, "VARIANT": "v", "back\\slash": 5, "": 8},
               {"ID": 2, "name": "b", "in": {"A": 1, "a": 2}, "empty": {}}, {"id": 3, "none": [], "deep": {"x": {"y": [{"z": None}]}}}])
    at.load()
    df = read_bronze(spark, at.bronze)
    rows = sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: r["ID"])
    assert [(r["ID"], r["Name"]) for r in rows] == [(1, "a"), (2, "b"), (3, None)] and rows[0][""] == 8
    assert rows[0]["_load_batch_data"] == 3 and rows[0]["we`ird n'ame.x"] == 1 and rows[0]["OBJECT<"] == 2
    assert rows[0]["VARIANT"] == "v" and json.loads(rows[1]["in"]) == {"A": 1, "a": 2} and rows[0]["back\\slash"] == 5
    assert rows[2]["deep"] == {"x": {"y": [{"z": None}]}}
    assert at.listed().count() == 3


def test_one_scan_of_the_files(spark, monkeypatch):
    """The landing files appear in one executed plan only: the staging of their lines."""
    at = _Landing(spark)
    at.put(1, *[[{"id": i, "v": i / 2}] for i in range(5)])
    scans, read = [], type(spark.read).text
    monkeypatch.setattr(type(spark.read), "text", lambda self, paths, *a, **k: (scans.append(paths), read(self, paths, *a, **k))[1])
    monkeypatch.setattr(type(spark.read), "json", lambda *a, **k: pytest.fail("read a second way"))
    at.load()
    assert len([p for p in scans if isinstance(p, list)]) == 1 and len(scans[0]) == 5
    assert loaded_rows(spark, at.bronze) == 5


def test_a_batch_that_fails_late_is_replayed_whole(spark, monkeypatch):
    import tierline.streaming.incremental as inc
    at = _Landing(spark)
    at.put(1, [{"id": 1, "n": 1}, "{bad"])
    at.load()
    at.put(2, [{"id": 2, "n": 0.5}, "{worse"])
    with monkeypatch.context() as m:
        m.setattr(inc, "_write_side", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            at.load()
    assert at.load()["rows"] == 1
    assert [(r["id"], r["n"]) for r in at.rows()[1]] == [(1, 1.0), (2, 0.5)]
    assert read_rejects(spark, at.bronze).count() == 2 and at.listed().count() == 2


def test_nothing_loaded_yet(spark):
    at = _Landing(spark)
    at.put(1, "", ["{bad"])
    assert at.load()["batches"] == 0
    assert not table_exists(spark, f"{at.schema}.e") and latest_load(spark, at.bronze) == -1
    assert read_rejects(spark, at.bronze).count() == 1 and loaded_rows(spark, at.bronze) == 0


def test_lattice_of_types(spark):
    order = ["void", "tinyint", "int", "bigint", "double", "string"]
    kinds = [T.DataType.fromDDL(t) if t != "void" else T.NullType() for t in order]
    for i, a in enumerate(kinds):
        for j, b in enumerate(kinds):
            assert same_type(joined_type(a, b), kinds[max(i, j)])
    pairs = [("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"), ("decimal(10,2)", "int", "decimal(12,2)"),
             ("decimal(38,2)", "bigint", "decimal(38,2)"), ("decimal(38,10)", "decimal(38,0)", "double"),
             ("float", "int", "double"), ("date", "timestamp", "timestamp"), ("boolean", "int", "string"),
             ("struct<a:int>", "struct<A:double,b:string>", "struct<a:double,b:string>"),
             ("array<int>", "array<string>", "array<string>"), ("map<string,int>", "map<string,double>", "map<string,double>"),
             ("array<int>", "int", "string")]
    for a, b, want in pairs:
        got = joined_type(T.DataType.fromDDL(a), T.DataType.fromDDL(b))
        assert ddl(got) == ddl(T.DataType.fromDDL(want)), (a, b)
    a, b = T.DataType.fromDDL("struct<a:int,l:array<int>,m:map<string,int>>"), T.DataType.fromDDL(
        "struct<a:string,l:array<double>,m:map<string,double>,n:date>")
    row = spark.sql("SELECT struct(1 AS a, array(1, NULL) AS l, map('k', 2) AS m) AS s").select(
        F.expr(upcast_sql("s", a, joined_type(a, b)))).first()[0]
    assert row.asDict(recursive=True) == {"a": "1", "l": [1.0, None], "m": {"k": 2.0}, "n": None}


def test_types_from_variant_descriptions():
    got = variant_types("OBJECT<A: BIGINT, `b: OBJECT<`: VARIANT, OBJECT: VOID, c: ARRAY<OBJECT<x: DECIMAL(21,1), y: VARIANT>>, "
                        "d: DECIMAL(25,0), e: OBJECT<>>")
    assert [(f.name, ddl(f.dataType)) for f in got.fields] == [
        ("A", "bigint"), ("b: OBJECT<", "string"), ("OBJECT", "void"), ("c", "array<struct<`x`: double, `y`: string>>"),
        ("d", "decimal(38,0)"), ("e", "void")]
    assert variant_types("VOID") == T.StructType()


def test_outcomes_are_counted_without_sorting_the_lines(spark):
    land = _Landing(spark)
    lines = ["7", "[1]", "{", {"a": 1}, [{"a": 2}, {"a": 3}], []]
    folder = land.put("2024-01-01", lines, ["7", "[1]"], ["7"], [{"a": 4}])
    counts = _line_counts(_parsed_lines(spark, [folder]))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert REASONS == sorted(REASONS)       # the reason given for a file is the least, as SQL's MIN
    got = sorted((r.file[-11:], r.lines, r.rejected, r.reason, r.rows) for r in counts.collect())
    assert got == [("part-0.json", 6, 3, 0, 3), ("part-1.json", 2, 2, 1, 0), ("part-2.json", 1, 1, 2, 0),
                   ("part-3.json", 1, 0, None, 1)]
    land.load()
    assert sorted((r.file[-11:], r.status, r.reason) for r in read_outcomes(spark, land.bronze).collect()) == [
        ("part-0.json", "partly", REASONS[0]), ("part-1.json", "rejected", REASONS[1]),
        ("part-2.json", "rejected", REASONS[2]), ("part-3.json", "loaded", None)]
