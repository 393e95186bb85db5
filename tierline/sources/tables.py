"""Table sinks and scans: staging, full overwrite, create-if-absent, keyed upsert,
schemas.

Tables are parquet: open-source Spark has no row-level MERGE on it, so the upsert
is an anti-join + union.  Every table created here is external and its files lie in
version folders below its home folder, so dropping a catalog entry never deletes rows.

* A whole new version goes to a fresh folder.  The table is pointed at it when the write
  has succeeded: by one catalog change where the columns are the same, else by a second
  entry that is complete before it takes the first one's name.
* A partitioned table (``_part``: a hash of the key, or e.g. the UTC event day) takes an
  upsert partition by partition: the touched partitions' new content is written once, to a
  fresh folder, and each partition is then pointed at its part of it.  Where many partitions
  are all replaced, that folder is a whole new version.

What a failed run leaves is finished by the next one (``_finish_swap``, ``_resume``).
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, replace
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.types import ddl, joined_type, quoted, same_type, upcast_sql
from tierline.session import scratch_dir

PART_COL = "_part"


def stage(df: DataFrame, label: str, spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` as parquet below the shared checkpoint folder and read it back.

    Cuts the lineage (a later failure restarts from the files, not from the source)
    and gives later plans a columnar, prunable input with real size statistics.
    """
    spark = spark or df.sparkSession
    path = scratch_dir(spark, label)
    df.write.mode("errorifexists").parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_path = path
    return staged


def drop_staged(spark: SparkSession, *staged: DataFrame) -> None:
    """Delete staged copies that no later plan reads."""
    for df in staged:
        path = getattr(df, "_staged_path", None)
        if path:
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system that holds it (any store Spark writes)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def _described(spark: SparkSession, name: str, partition: str = "") -> dict[str, str]:
    """Location and type from the detailed part of a table's or partition's description."""
    out, detailed = {}, False
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name} {partition}").collect():
        detailed = detailed or r.col_name.startswith("# Detailed")
        if detailed and r.col_name in ("Location", "Type"):
            out.setdefault(r.col_name, r.data_type)
    return out


def _location(spark: SparkSession, name: str) -> str:
    return _described(spark, name)["Location"].rstrip("/")


def _home(spark: SparkSession, name: str, path: str | None) -> str:
    """Folder below which a table's versions lie.  Dropping a managed table (made by other
    means) deletes its folder, so its versions go beside that."""
    if table_exists(spark, name):
        at = _described(spark, name)
        location = at["Location"].rstrip("/")
        home = path.rstrip("/") if path else re.sub(r"/[vu]-[0-9a-f]{12}$", "", location)
        inside = f"{_bare(spark, home)}/".startswith(f"{_bare(spark, location)}/")
        return f"{location}-versions" if at.get("Type") == "MANAGED" and inside else home
    if path:
        return path.rstrip("/")
    db, _, table = name.replace("`", "").rpartition(".")
    db = db or spark.catalog.currentDatabase()
    return f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/{table}"


def _path(spark: SparkSession, path: str):
    """(file system, qualified path) of a folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def _bare(spark: SparkSession, path: str) -> str:
    return _path(spark, path)[1].toUri().getPath().rstrip("/")


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def observed(counts: Observation) -> dict:
    """The observed counts; none when Spark found the input empty and dropped the node."""
    try:
        return counts.get
    except Py4JJavaError:
        return {}


def overwrite_table(df: DataFrame, name: str, path: str | None = None,
                    partition_by: Iterable[str] = (), properties: dict[str, str] | None = None) -> int:
    """Rebuild ``name`` from ``df`` (full overwrite); returns the rows written,
    counted by an ``Observation`` on the write itself (no second job).

    The rows go to a fresh folder below ``path`` (default: the table's place in its
    schema).  Only after that write the catalog entry is pointed at the folder and the
    old one deleted, so a failed write leaves the old table, and ``df`` may read it.
    ``properties`` are set beside those the table has."""
    spark = df.sparkSession
    _finish_swap(spark, name)
    parts = list(partition_by)
    fresh, rows = _write_version(df, _home(spark, name, path), name, parts)
    _point_at(spark, name, fresh, df.schema, parts, {ROWS_PROPERTY: str(rows)} | (properties or {}))
    return rows


def _write_version(df: DataFrame, home: str, name: str, parts: list[str]) -> tuple[str, int]:
    obs = Observation(f"rows_{name.replace('.', '_')}")
    fresh = f"{home}/v-{uuid.uuid4().hex[:12]}"
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
    (writer.partitionBy(*parts) if parts else writer).parquet(fresh)
    return fresh, int(observed(obs).get("rows", 0))


def _point_at(spark: SparkSession, name: str, fresh: str, schema: T.StructType, parts: list[str],
              properties: dict[str, str]) -> None:
    """Make ``name`` the table over the folder ``fresh``: catalog changes only."""
    exists = table_exists(spark, name)
    old = _location(spark, name) if exists else None
    if exists and not parts and _same_columns(spark, name, schema):
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(fresh)}")
        if properties:
            set_table_properties(spark, name, properties)
    else:
        held = table_properties(spark, name) if exists else {}
        held.pop(PENDING_PROPERTY, None)
        _new_entry(spark, _next(name), fresh, schema, parts, held | properties)
        if exists:
            spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {_next(name)} RENAME TO {name}")
    spark.catalog.refreshTable(name)
    if old is not None:
        _delete_versions(spark, old, fresh)


def _same_columns(spark: SparkSession, name: str, schema: T.StructType) -> bool:
    held = spark.table(name).schema
    plain = not any(c.isPartition for c in spark.catalog.listColumns(name))
    return plain and held.names == schema.names and all(
        same_type(a.dataType, b.dataType) for a, b in zip(held.fields, schema.fields))


def _next(name: str) -> str:
    """The entry that is made ready before it takes the table's name."""
    db, dot, table = name.rpartition(".")
    table = f"`{table.strip('`')}__next`"
    return f"{db}{dot}{table}"


def _new_entry(spark: SparkSession, name: str, folder: str, schema: T.StructType, parts: list[str],
               properties: dict[str, str]) -> None:
    """A complete external table over ``folder``, its properties part of its creation."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")       # external: no file goes with it
    cols = ", ".join(f"{quoted(f.name)} {ddl(f.dataType)}" for f in schema.fields)
    by = (f" OPTIONS ('partitionOverwriteMode' 'dynamic') PARTITIONED BY ({', '.join(quoted(p) for p in parts)})"
          if parts else "")
    with_ = (f" TBLPROPERTIES ({', '.join(f'{_text(k)} = {_text(v)}' for k, v in properties.items())})"
             if properties else "")
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet{by} LOCATION {_text(folder)}{with_}")
    if parts:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def _finish_swap(spark: SparkSession, name: str) -> None:
    """Finish a swap of catalog entries that stopped before its rename."""
    ready = _next(name)
    if table_exists(spark, name) or not table_exists(spark, ready):
        return
    if any(c.isPartition for c in spark.catalog.listColumns(ready)):
        spark.sql(f"MSCK REPAIR TABLE {ready}")
    spark.sql(f"ALTER TABLE {ready} RENAME TO {name}")


def _delete_versions(spark: SparkSession, old: str, fresh: str) -> None:
    """Delete a replaced folder, and version folders beside the fresh one.  A table that
    kept its files beside the versions loses all but the fresh one."""
    fs, old_path = _path(spark, old)
    keep = _bare(spark, fresh)
    inside = f"{keep}/".startswith(f"{_bare(spark, old)}/")
    if not inside:
        fs.delete(old_path, True)
    home = old_path if inside else _path(spark, fresh)[1].getParent()
    for entry in fs.listStatus(home):
        at = entry.getPath()
        if (inside or re.fullmatch(r"[vu]-[0-9a-f]{12}", at.getName())) and not f"{keep}/".startswith(
                f"{at.toUri().getPath()}/"):
            fs.delete(at, True)


# Table properties: how an upserted table is laid out, the rows it holds, and a
# publication that has begun.
LAYOUT_PROPERTY = "tierline.layout"
ROWS_PROPERTY = "tierline.rows"
PENDING_PROPERTY = "tierline.publishing"

# A partition of fewer rows than this is written by one task.
WRITER_ROWS = 100_000
# More partitions than this, all replaced, are published as one version, not one by one.
MANY = 16
# So many partitions are added or dropped by one catalog call.
AT_ONCE = 200


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
            if r.key.startswith("tierline.")}


def set_table_properties(spark: SparkSession, name: str, properties: dict[str, str]) -> None:
    pairs = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def table_rows(spark: SparkSession, name: str) -> int:
    """Rows of a table: as its last upsert or overwrite recorded them, else from the file
    footers."""
    recorded = table_properties(spark, name).get(ROWS_PROPERTY)
    return int(recorded) if recorded is not None else spark.table(name).count()


def create_table(df: DataFrame, name: str, path: str | None = None, partition_by: Iterable[str] = (),
                 properties: dict[str, str] | None = None) -> int:
    """Create ``name`` from ``df``; fails if it exists.  Returns rows written.  The entry
    appears under its name only when rows, partitions and properties are all there.  A
    partitioned table records dynamic partition overwrite among its options, so an
    ``INSERT OVERWRITE`` into it replaces only the partitions it writes."""
    spark = df.sparkSession
    _finish_swap(spark, name)
    if table_exists(spark, name):
        raise ValueError(f"table {name} exists")
    parts = list(partition_by)
    fresh, rows = _write_version(df, _home(spark, name, path), name, parts)
    _point_at(spark, name, fresh, df.schema, parts, {ROWS_PROPERTY: str(rows)} | (properties or {}))
    return rows


def assert_unique_keys(df: DataFrame, key: str | Iterable[str]) -> None:
    """Fail when ``df`` holds a key twice (MERGE would be ambiguous).  One partially
    aggregated job; only a single offending key is brought back."""
    keys = [key] if isinstance(key, str) else list(key)
    all_set = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        all_set = all_set & F.col(k).isNotNull()
    dup = (df.where(all_set).groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect())
    if dup:
        raise ValueError(f"upsert source holds key {tuple(dup[0])[:-1]} {dup[0]['count']} times")


def upsert_frame(target: DataFrame, source: DataFrame, key: str | Iterable[str],
                 rows: DataFrame | None = None) -> DataFrame:
    """Rows of the table after MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *:
    source rows, plus target rows whose key the source lacks.  NULL keys never match.
    Columns new in the source are added (NULL for old rows).  ``rows``: the source's rows
    to store, where they are not all of them."""
    keys = [key] if isinstance(key, str) else list(key)
    src_keys = source.select(*[F.col(k).alias(f"_sk_{k}") for k in keys])
    cond = None
    for k in keys:
        term = F.col(k) == F.col(f"_sk_{k}")
        cond = term if cond is None else cond & term
    kept = target.join(src_keys, cond, "left_anti")
    return kept.unionByName(source if rows is None else rows, allowMissingColumns=True)


def event_day(ts: str):
    """UTC day number (days since 1970-01-01) of a timestamp column: a partition
    value that does not depend on the session time zone."""
    return F.floor(F.unix_micros(F.col(ts)) / F.lit(86_400_000_000)).cast("int")


def _for_write(df: DataFrame, keys: list[str], order: list[str], partitioned: bool,
               write_spread: int) -> DataFrame:
    """Cluster rows so each write task covers few partition folders, then sort inside
    each task (partition value first, as the writer needs).  The ``rebalance`` hint
    hashes on (partition value, key salt) and lets AQE split a skewed partition into
    advisory-size pieces and merge small ones, so a day holding a third of all rows is
    written by many tasks; without AQE it is still spread over ``write_spread`` tasks."""
    if not partitioned:
        return df.sortWithinPartitions(*order) if order else df
    salt = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(write_spread))
    return (df.withColumn("_ws", salt).hint("rebalance", PART_COL, "_ws").drop("_ws")
              .sortWithinPartitions(PART_COL, *order))


@dataclass(frozen=True)
class TableLayout:
    """How an upserted table is partitioned, as recorded with it: ``plain``, by a ``hash``
    of the key into a fixed count, ``linear`` (a hash whose count grows by splitting
    partitions, so that they keep to about ``rows`` rows), or by an ``expression``."""
    kind: str = "plain"
    by: str = ""
    count: int = 0
    rows: int = 0

    def __str__(self) -> str:
        numbers = {"hash": [self.count], "linear": [self.count, self.rows]}.get(self.kind, [])
        return ":".join([self.kind, *map(str, numbers), *([self.by] if self.by else [])])

    @staticmethod
    def parse(text: str) -> TableLayout:
        kind, _, rest = text.partition(":")
        if kind == "hash":
            count, _, by = rest.partition(":")
            return TableLayout(kind, by, int(count))
        if kind == "linear":
            count, rows, by = rest.split(":", 2)
            return TableLayout(kind, by, int(count), int(rows))
        return TableLayout(kind, rest)

    def part(self, keys: list[str], partition_expr: Column | None) -> Column | None:
        if self.kind == "hash":
            return F.pmod(F.xxhash64(*keys), F.lit(self.count))
        return linear_part(F.xxhash64(*keys), self.count) if self.kind == "linear" else partition_expr


def linear_part(hashed: Column, count: int) -> Column:
    """Linear hashing: the partition of a hash among ``count``.  From count to count + 1
    only one partition's rows are divided."""
    low = 1 << (count.bit_length() - 1)
    wide = F.pmod(hashed, F.lit(2 * low))
    return F.when(wide < count, wide).otherwise(F.pmod(hashed, F.lit(low)))


def split_sources(count: int, grown: int) -> list[int]:
    """The partitions, of ``count``, whose rows are divided on the way to ``grown``."""
    out = set()
    for part in range(count, grown):
        while part >= count:
            part -= 1 << (part.bit_length() - 1)
        out.add(part)
    return sorted(out)


def _adopt_layout(spark: SparkSession, table: str, wanted: TableLayout) -> TableLayout:
    """The layout to use on an existing table.  Hash layouts are adopted as recorded (a
    row's partition must not depend on the caller's count); an expression can't be read
    back, so a different one is refused."""
    recorded = table_properties(spark, table).get(LAYOUT_PROPERTY)
    if recorded is None:
        if PART_COL in spark.table(table).columns or wanted.kind != "plain":
            raise ValueError(f"{table} has no recorded layout; it was not created by merge_upsert")
        return wanted
    held = TableLayout.parse(recorded)
    if held == wanted:
        return held
    if held.kind in ("hash", "linear") and wanted.kind != "expression" and wanted.by in ("", held.by):
        return held
    raise ValueError(f"{table} is laid out as {held}, not {wanted}")


def _like_keys(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source keys in the table's key types, so that equal keys compare and hash alike.  A
    value the table's type can't hold fails the cast rather than turning into NULL."""
    changes = {}
    for k in keys:
        if k in target.columns and source.schema[k].dataType != target.schema[k].dataType:
            to = target.schema[k].dataType.simpleString()
            cast = F.col(k).try_cast(to)
            changes[k] = F.when(F.col(k).isNotNull() & cast.isNull(), F.raise_error(
                F.concat(F.lit(f"key {k} does not fit {to}: "), F.col(k).cast("string")))).otherwise(cast)
    return source.withColumns(changes) if changes else source


def _fit_types(spark: SparkSession, table: str, source: DataFrame, keys: list[str], path: str | None,
               order: list[str], write_spread: int) -> DataFrame:
    """The source in the table's column types.  Where a value column of the source needs a
    wider type, the table is rewritten with that type first (see ``joined_type``), so no
    value is narrowed."""
    target = {f.name.lower(): f for f in spark.table(table).schema.fields}
    wider, casts = {}, {}
    for f in source.schema.fields:
        held = target.get(f.name.lower())
        if held is None or f.name in keys:
            continue
        to = joined_type(held.dataType, f.dataType)
        if not same_type(to, held.dataType):
            wider[held.name] = upcast_sql(quoted(held.name), held.dataType, to)
        if not same_type(to, f.dataType):
            casts[f.name] = upcast_sql(quoted(f.name), f.dataType, to)
    if wider:
        rows = spark.table(table).withColumns({c: F.expr(e) for c, e in wider.items()})
        parts = [PART_COL] if PART_COL in rows.columns else []
        overwrite_table(_for_write(rows, keys, order, bool(parts), write_spread), table, _home(spark, table, path), parts)
    return source.withColumns({c: F.expr(e) for c, e in casts.items()}) if casts else source


def merge_upsert(spark: SparkSession, table: str, source: DataFrame, key: str | Iterable[str],
                 path: str | None = None, partitions: int | None = None, partition_expr=None,
                 check_unique: bool = True, sort_within: Iterable[str] = (),
                 write_spread: int = 4, keys_may_move: bool = True,
                 rows_per_partition: int | None = None, remove: str | None = None,
                 properties: dict[str, str] | None = None, may_hold: DataFrame | None = None) -> dict:
    """Keyed upsert into parquet table ``table`` (created on first use): MERGE ... WHEN
    MATCHED UPDATE * WHEN NOT MATCHED INSERT *.

    Partitioning (``_part``) limits what an upsert reads and rewrites:

    * ``partitions=n``: hash of the key, ``pmod(xxhash64(key), n)`` -- a key always
      lands in the same partition, so the touched partitions are the source's.
    * ``rows_per_partition=r``: linear hashing of the key.  The first load's rows give the
      count; when the table outgrows it, just the partitions that have to be divided are
      rewritten beside the touched ones, so a partition keeps to about r rows.
    * ``partition_expr``: any column expression, e.g. ``event_day("timestamp")`` for
      event tables.  A key may move between partitions, so the partitions where the
      target holds the source's keys today are touched too (found by a semi-join on the
      key and ``_part`` columns only).  ``keys_may_move=False`` skips that scan when a
      key's partition never changes; ``may_hold``, a frame of ``_part`` values, limits it
      to the partitions that can hold the source's keys, where the caller knows them.

    The layout is recorded with the table; a later call adopts a recorded hash and
    refuses another kind of layout.  Source keys are cast to the table's key types; a value
    column whose type the source outgrows is widened.

    The source is evaluated once, into a staged copy (unless ``stage`` made it).  The touched partitions' new content
    is written once, to a fresh folder.  Then each touched partition is pointed at its
    part of it, or dropped when it has no rows left, the NULL one included; old folders
    are deleted last.  So a partition has its old or its new rows at any time, and what a
    failure left half-published the next upsert publishes first.  Readers may see some
    partitions before and some after the upsert.  An unpartitioned table's new content
    becomes a new version, and so does that of more than ``MANY`` partitions where all of
    the table's are replaced: a catalog call for each would take longer than the rows.  ``sort_within`` orders rows inside each written file so parquet
    min/max statistics let range filters skip row groups.  ``remove`` names a boolean
    column of the source: where it is true, the key's row goes and none comes; it is not
    stored.  ``properties`` are set with the upsert.  Returns ``{"created": bool,
    "rows_written": n, "rows": n}``, the last one for the whole table.
    """
    order = list(sort_within)
    keys = [key] if isinstance(key, str) else list(key)
    if sum([bool(partitions), bool(rows_per_partition), partition_expr is not None]) > 1:
        raise ValueError("give one of partitions, rows_per_partition and partition_expr")
    by = ",".join(keys)
    layout = (TableLayout("hash", by, partitions) if partitions
              else TableLayout("linear", by, 1, rows_per_partition) if rows_per_partition
              else TableLayout("expression", str(partition_expr)) if partition_expr is not None else TableLayout())
    given_staged = hasattr(source, "_staged_path")
    _finish_swap(spark, table)
    exists = table_exists(spark, table)
    if exists:
        _resume(spark, table)
        layout = _adopt_layout(spark, table, layout)
        source = _like_keys(source, spark.table(table), keys)
        source = _fit_types(spark, table, source, keys, path, order, write_spread)
    grows = layout.kind == "linear"
    if grows:       # the partitions are small: files of a few rows each would only cost time
        write_spread = max(1, min(write_spread, layout.rows // WRITER_ROWS))
    if not grows or exists:
        part = layout.part(keys, partition_expr)
        source = source if part is None else source.withColumn(PART_COL, part)
    staged = []
    if not given_staged:
        staged.append(stage(source, "upsert-source", spark))
        source = staged[0]
    more = dict(properties or {})
    try:
        if check_unique:
            assert_unique_keys(source, keys)
        rows = source.where(~F.coalesce(F.col(remove), F.lit(False))).drop(remove) if remove else source
        if not exists:
            if grows:
                layout = replace(layout, count=max(1, -(-rows.count() // layout.rows)))
                rows = rows.withColumn(PART_COL, layout.part(keys, None))
            partitioned = layout.kind != "plain"
            first = _for_write(rows, keys, order, partitioned, write_spread)
            fresh, n = _write_version(first, _home(spark, table, path), table, [PART_COL] if partitioned else [])
            _point_at(spark, table, fresh, first.schema, [PART_COL] if partitioned else [],
                      {LAYOUT_PROPERTY: str(layout), ROWS_PROPERTY: str(n)} | more)
            return {"created": True, "rows_written": n, "rows": n}
        home = _home(spark, table, path)
        if layout.kind == "plain":
            merged = upsert_frame(spark.table(table), source, keys, rows)
            fresh, n = _write_version(_for_write(merged, keys, order, False, write_spread), home, table, [])
            _point_at(spark, table, fresh, merged.schema, [],
                      {LAYOUT_PROPERTY: str(layout), ROWS_PROPERTY: str(n)} | more)
            return {"created": False, "rows_written": n, "rows": n}
        target = spark.table(table)
        fresh = f"{home}/u-{uuid.uuid4().hex[:12]}"
        touched = source.select(PART_COL)
        if partition_expr is not None and keys_may_move:
            places = target if may_hold is None else in_partitions(target, may_hold.subtract(touched))
            held = places.select(*keys, PART_COL).join(source.select(*keys), keys, "left_semi")
            touched = touched.unionByName(held.select(PART_COL))
        before = table_rows(spark, table)
        grown = _grown(layout, target, source, rows, keys, before) if grows else layout
        if grown != layout:
            divided = spark.createDataFrame([(b,) for b in split_sources(layout.count, grown.count)], "b long")
            touched = touched.unionByName(divided.select(F.col("b").cast(touched.schema[PART_COL].dataType).alias(PART_COL)))
            more[LAYOUT_PROPERTY] = str(grown)
        try:
            touched = _write_touched(touched.distinct(), fresh)
            old = in_partitions(target, touched)
            gone = old.select(PART_COL).count()
            merged = upsert_frame(old, source, keys, rows)
            if grown != layout:
                merged = merged.withColumn(PART_COL, grown.part(keys, None).cast(merged.schema[PART_COL].dataType))
            n = _write_partitions(_for_write(merged, keys, order, True, write_spread), fresh)
        except BaseException:
            delete_folder(spark, fresh)
            raise
        new = [c for c in merged.columns if c.lower() not in {x.lower() for x in target.columns}]
        total = before - gone + n
        then = {ROWS_PROPERTY: str(total)} | more
        if _replaces_all(spark, table, fresh):
            columns = [c for c in target.columns if c != PART_COL] + new + [PART_COL]
            delete_folder(spark, f"{fresh}/_touched")
            _point_at(spark, table, fresh, merged.select(*columns).schema, [PART_COL], then)
        else:
            if new:
                _add_columns(spark, table, merged, new)
            _publish(spark, table, fresh, then)
        return {"created": False, "rows_written": n, "rows": total}
    finally:
        drop_staged(spark, *staged)
        if table_exists(spark, table):
            spark.catalog.refreshTable(table)


def _grown(layout: TableLayout, target: DataFrame, source: DataFrame, rows: DataFrame, keys: list[str],
           before: int) -> TableLayout:
    """A linear layout with as many partitions as the table needs after the upsert, so that its
    rows are written once.  Counting the rows that are replaced takes the key columns only,
    and is left out where not even all rows of the source would need another partition."""
    most = before + rows.count()
    if most <= layout.count * layout.rows:
        return layout
    held = in_partitions(target, source.select(PART_COL).distinct())
    replaced = held.select(*keys).join(source.select(*keys), keys, "left_semi").count()
    return replace(layout, count=max(layout.count, -(-(most - replaced) // layout.rows)))


def _replaces_all(spark: SparkSession, table: str, fresh: str) -> bool:
    """Whether the touched partitions are all of the table's, and they or those written many."""
    present = spark.sql(f"SHOW PARTITIONS {table}").count()
    fs, root = _path(spark, fresh)
    if max(present, len(fs.listStatus(root))) <= MANY:
        return False
    touched = spark.read.parquet(f"{fresh}/_touched").select(
        F.coalesce(F.col(PART_COL).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).alias("_t"))
    known = spark.sql(f"SHOW PARTITIONS {table}").select(F.substring_index("partition", "=", -1).alias("_t"))
    return known.join(touched, "_t", "left_semi").count() == present


def _write_touched(touched: DataFrame, fresh: str) -> DataFrame:
    """Keep the touched partitions' values with the folder that replaces them."""
    path = f"{fresh}/_touched"
    touched.write.mode("errorifexists").parquet(path)
    return touched.sparkSession.read.schema(touched.schema).parquet(path)


def _write_partitions(df: DataFrame, fresh: str) -> int:
    """Write by ``_part`` below ``fresh``; returns the rows, from the written footers."""
    df.write.mode("append").partitionBy(PART_COL).parquet(fresh)
    return df.sparkSession.read.schema(df.schema).parquet(fresh).select(PART_COL).count()


def _publish(spark: SparkSession, table: str, fresh: str, then: dict[str, str]) -> None:
    """Point the touched partitions at ``fresh`` and set properties ``then``.  The intent is
    recorded first, so that a failure between any two steps can be finished."""
    set_table_properties(spark, table, {PENDING_PROPERTY: json.dumps({"fresh": fresh, "then": then})})
    _resume(spark, table)


def _resume(spark: SparkSession, table: str) -> None:
    """Do what a recorded publication has still to do; none recorded: nothing."""
    pending = table_properties(spark, table).get(PENDING_PROPERTY)
    if pending is None:
        return
    intent = json.loads(pending)
    replaced = _swap_partitions(spark, table, intent["fresh"])
    set_table_properties(spark, table, intent["then"])
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({_text(PENDING_PROPERTY)})")
    spark.catalog.refreshTable(table)
    for folder in [f"{intent['fresh']}/_touched", *replaced]:
        delete_folder(spark, folder)


def _swap_partitions(spark: SparkSession, table: str, fresh: str, at_once: int = AT_ONCE) -> list[str]:
    """Point partitions at their folders below ``fresh`` and drop touched ones that have
    none; returns the folders no longer used.  Catalog calls only, no job a partition."""
    fs, root = _path(spark, fresh)
    folders = {e.getPath().getName(): e.getPath().toString() for e in fs.listStatus(root)
               if e.isDirectory() and e.getPath().getName().startswith(f"{PART_COL}=")}
    present = {r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    replaced, added, emptied = [], [], []
    for name, folder in folders.items():
        spec = _spec(name)
        if name not in present:
            added.append(f"{spec} LOCATION {_text(folder)}")
            continue
        at = _described(spark, table, spec)["Location"]
        if _bare(spark, at) != _bare(spark, folder):
            spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION {_text(folder)}")
            replaced.append(at)
    for row in spark.read.parquet(f"{fresh}/_touched").select(F.col(PART_COL).cast("string")).toLocalIterator():
        name = f"{PART_COL}={'__HIVE_DEFAULT_PARTITION__' if row[0] is None else row[0]}"
        if name not in folders and name in present:
            replaced.append(_described(spark, table, _spec(name))["Location"])
            emptied.append(_spec(name))
    for i in range(0, len(added), at_once):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(added[i:i + at_once])}")
    for i in range(0, len(emptied), at_once):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(emptied[i:i + at_once])}")
    return replaced


def _spec(folder: str) -> str:
    """``PARTITION (...)`` of a partition folder's name."""
    value = folder.partition("=")[2]
    if value == "__HIVE_DEFAULT_PARTITION__":
        return f"PARTITION ({PART_COL} = null)"
    plain = re.fullmatch(r"-?[0-9]+", value)
    return f"PARTITION ({PART_COL} = {value if plain else _text(unquote(value))})"


def in_partitions(target: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows of the touched partitions: a literal range on ``_part`` prunes the listing (one
    aggregated row reaches the driver), the semi-join takes the exact partitions."""
    r = touched.agg(F.min(PART_COL).alias("lo"), F.max(PART_COL).alias("hi"),
                    F.count_if(F.col(PART_COL).isNull()).alias("nulls")).first()
    some = F.col(PART_COL).between(r.lo, r.hi) if r.lo is not None else F.lit(False)
    known = target.where(some).join(touched, PART_COL, "left_semi")
    return known.unionByName(target.where(F.col(PART_COL).isNull())) if r.nulls else known


def _add_columns(spark: SparkSession, table: str, df: DataFrame, cols: list[str]) -> None:
    added = ", ".join(f"{quoted(c)} {ddl(df.schema[c].dataType)}" for c in cols)
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")


def ensure_schemas(spark: SparkSession, schemas: dict[str, str],
                   location_root: str | None = None) -> list[str]:
    """CREATE SCHEMA IF NOT EXISTS for each ``{name: comment}``; returns the names."""
    for name, comment in schemas.items():
        loc = f" LOCATION '{location_root.rstrip('/')}/{name}.db'" if location_root else ""
        safe = comment.replace("'", "''")
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}` COMMENT '{safe}'{loc}")
    return list(schemas)


def use_schema(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def list_schemas(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW SCHEMAS")


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{schema}`")
