"""Incremental file load: take only files not loaded before (the job of SQL ``COPY
INTO``), with types that grow and bad input set aside.

A Structured Streaming file source (``binaryFile``, path only) remembers every file
it has taken in its checkpoint, so a rerun takes only new files, and a file
rewritten under an old path is skipped.  ``trigger(availableNow=True)`` drains what
is there and stops: a batch job with exactly-once file bookkeeping.

Per micro-batch (``foreachBatch``) the files' lines are read once, parsed into VARIANT and
staged.  The staged values give the batch's schema (``schema_of_variant_agg``) and then the
rows.  They are written into the partition ``_load_batch=<batch id>`` with dynamic
partition overwrite, so a replayed batch replaces its own output.

* **Types.**  The table's type of a column is the least one that holds all batches'
  (``functions.types``).  What was written before keeps its types: ``_schema`` records, per
  range of batches, the types of its files, and ``read_bronze`` casts older ranges upward.
* **Bad input.**  Lines that are no JSON objects go to ``_rejects`` with file and reason, a
  file that can't be read or understood at all is set aside as a whole; ``_files`` has the
  outcome of every file.  Loading goes on.
"""

from __future__ import annotations

import functools
import json
import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.types import ddl, joined_struct, quoted, same_type, stored_type, upcast_sql
from tierline.sources.tables import drop_staged, stage

BATCH_COL = "_load_batch"
# The fixed schema of Spark's binaryFile source.
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

SCHEMA_DIR, REJECTS_DIR, FILES_DIR = "_schema", "_rejects", "_files"
# Why a line is rejected; of several, a file's outcome names the first of these.
REASONS = ["not JSON, or a name twice in an object", "not a list of objects", "not an object"]
REJECTS = f"file string, line string, reason string, {BATCH_COL} bigint"
FILES = f"file string, status string, lines bigint, rows bigint, rejected bigint, reason string, {BATCH_COL} bigint"


# ---- what is recorded with the table ----------------------------------------------

def _below(table_path: str, folder: str) -> str:
    return f"{table_path.rstrip('/')}/{folder}"


def number_folders(spark: SparkSession, path: str, key: str) -> list[int]:
    """The numbers n of the sub-folders ``key=n``, ascending (a listing, no job)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    names = [e.getPath().getName() for e in fs.listStatus(p) if e.isDirectory()]
    return sorted(int(n.partition("=")[2]) for n in names if re.fullmatch(f"{key}=-?[0-9]+", n))


def _ranges(spark: SparkSession, table_path: str, before: int | None = None) -> list[tuple[int, T.StructType]]:
    """(first batch, types) of the ranges of batches written with the same types."""
    at = [n for n in number_folders(spark, _below(table_path, SCHEMA_DIR), "at") if before is None or n < before]
    if not at:
        return []
    text = spark.read.text(_below(table_path, f"{SCHEMA_DIR}/at={at[-1]}")).first()[0]
    return [(r["from"], T.StructType.fromJson(r["types"])) for r in json.loads(text)]


def _record_ranges(spark: SparkSession, table_path: str, at: int, ranges: list[tuple[int, T.StructType]]) -> None:
    text = json.dumps([{"from": first, "types": json.loads(types.json())} for first, types in ranges])
    (spark.createDataFrame([(text,)], "value string").coalesce(1)
          .write.mode("overwrite").text(_below(table_path, f"{SCHEMA_DIR}/at={at}")))


def _extended(ranges: list[tuple[int, T.StructType]], batch_id: int, found: T.StructType) -> list[tuple[int, T.StructType]]:
    """The ranges with a batch of these types.  New columns extend the last range; a column
    whose stored type changes begins a new one."""
    if not ranges:
        return [(batch_id, found)]
    first, types = ranges[-1]
    joined = joined_struct(types, found)
    changed = any(not same_type(stored_type(a.dataType), stored_type(b.dataType))
                  for a, b in zip(types.fields, joined.fields))
    return [*ranges, (batch_id, joined)] if changed else [*ranges[:-1], (first, joined)]


def has_schema(spark: SparkSession, table_path: str) -> bool:
    """Whether any load has recorded the dataset's columns."""
    return bool(number_folders(spark, _below(table_path, SCHEMA_DIR), "at"))


def latest_load(spark: SparkSession, table_path: str) -> int:
    """The last batch that brought rows (-1: none)."""
    return max(number_folders(spark, table_path, BATCH_COL), default=-1)


def loaded_rows(spark: SparkSession, table_path: str) -> int:
    """Rows of the dataset, from the outcomes of its files."""
    return int(read_outcomes(spark, table_path).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])


def _read_side(spark: SparkSession, table_path: str, folder: str, schema: str) -> DataFrame:
    path = _below(table_path, folder)
    if not number_folders(spark, path, BATCH_COL):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_rejects(spark: SparkSession, table_path: str) -> DataFrame:
    """Lines that were not loaded: ``file, line, reason, _load_batch``."""
    return _read_side(spark, table_path, REJECTS_DIR, REJECTS)


def read_outcomes(spark: SparkSession, table_path: str) -> DataFrame:
    """One row per file taken: ``file, status, lines, rows, rejected, reason, _load_batch``;
    status is loaded, partly, rejected, empty or unreadable."""
    return _read_side(spark, table_path, FILES_DIR, FILES)


# ---- reading -----------------------------------------------------------------------

def _range_filter(ranges: list[tuple[int, T.StructType]], i: int) -> str:
    bounds = [f"{BATCH_COL} >= {ranges[i][0]}"] if i else []
    bounds += [f"{BATCH_COL} < {ranges[i + 1][0]}"] if i + 1 < len(ranges) else []
    return " AND ".join(bounds) or "true"


def _upcasts(types: T.StructType, final: T.StructType) -> list[str]:
    """SQL of the final columns over files of ``types``."""
    own = {f.name.lower(): f for f in types.fields}
    out = []
    for f in final.fields:
        mine, to = own.get(f.name.lower()), stored_type(f.dataType)
        sql = (f"CAST(NULL AS {ddl(to)})" if mine is None or isinstance(mine.dataType, T.NullType)
               else upcast_sql(quoted(mine.name), mine.dataType, to))
        out.append(f"{sql} AS {quoted(f.name)}")
    return out


def read_bronze(spark: SparkSession, table_path: str, keep_batch: bool = False) -> DataFrame:
    """The bronze dataset.  Each range of batches is read with its own recorded types (no
    footers are merged) and cast upward to the table's; a column that has only had NULLs
    is a string.  Without a record: merge footers."""
    ranges = _ranges(spark, table_path)
    if not ranges:
        df = spark.read.option("mergeSchema", "true").parquet(table_path)
        return df if keep_batch else df.drop(BATCH_COL)
    df = None
    for i, (_, types) in enumerate(ranges):
        files = T.StructType([*stored_type(types).fields, T.StructField(BATCH_COL, T.LongType())])
        part = spark.read.schema(files).parquet(table_path).where(_range_filter(ranges, i))
        part = part.selectExpr(*_upcasts(types, ranges[-1][1]), BATCH_COL)
        df = part if df is None else df.unionAll(part)
    return df if keep_batch else df.drop(BATCH_COL)


# ---- loading -----------------------------------------------------------------------

def variant_types(text: str) -> T.StructType:
    """The columns that ``schema_of_variant_agg`` describes: values that agree in no type
    are strings, fractions doubles, whole numbers beyond 64 bits decimals."""
    pieces = text.split("`")
    for i in range(0, len(pieces), 2):      # outside quoted names
        piece = re.sub(r"\bOBJECT<", "STRUCT<", pieces[i])
        piece = re.sub(r"\bVARIANT\b(?!:)", "STRING", piece)
        pieces[i] = re.sub(r"([A-Za-z0-9_]+): ", r"`\1`: ", piece)
    parsed = T.DataType.fromDDL("`".join(pieces))
    return _loaded(parsed) if isinstance(parsed, T.StructType) and parsed.fields else T.StructType()


def _loaded(t: T.DataType, top: bool = True) -> T.DataType:
    if isinstance(t, T.DecimalType):
        return T.DecimalType(38, 0) if t.scale == 0 and t.precision > 18 else T.DoubleType()
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_loaded(t.elementType, False))
    if isinstance(t, T.StructType):
        if not t.fields:
            return T.NullType()
        if not top and len({f.name.lower() for f in t.fields}) < len(t.fields):
            return T.StringType()       # names that differ by case only: kept as JSON text
        return T.StructType([T.StructField(f.name, _loaded(f.dataType, False)) for f in t.fields])
    return t


def _columns(found: T.StructType) -> tuple[T.StructType, dict[str, list[str]]]:
    """Columns of a batch and the spellings of each: names that differ by case are one."""
    fields: dict[str, T.StructField] = {}
    spelled: dict[str, list[str]] = {}
    for f in found.fields:
        name = f"{f.name}_data" if f.name.lower() == BATCH_COL else f.name
        key = name.lower()
        one = T.StructType([T.StructField(fields[key].name if key in fields else name, f.dataType)])
        fields[key] = (joined_struct(T.StructType([fields[key]]), one) if key in fields else one).fields[0]
        spelled.setdefault(key, []).append(f.name)
    return T.StructType(list(fields.values())), spelled


def _parsed_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file, v, listed, n, line, reason``: each line's value and rows, or the line and why it
    has none.  The one scan of the files; blank lines don't count."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")).where(
        F.col("line").rlike(r"\S"))
    start = F.regexp_extract("line", r"^\s*(\S)", 1)
    v = F.try_parse_json("line")
    objects = F.expr("forall(try_cast(v AS array<variant>), x -> schema_of_variant(x) LIKE 'OBJECT<%')")
    why = (F.when(F.col("v").isNull(), REASONS[0])
           .when((F.col("start") == "[") & ~F.coalesce(objects, F.lit(False)), REASONS[1])
           .when(~F.col("start").isin("{", "["), REASONS[2]))
    judged = lines.select("file", "line", start.alias("start"), v.alias("v")).withColumn("reason", why)
    good, listed = F.col("reason").isNull(), F.col("start") == "["
    n = F.when(~good, 0).when(listed, F.expr("size(try_cast(v AS array<variant>))")).otherwise(1)
    return judged.select("file", F.when(good, F.col("v")).alias("v"), listed.alias("listed"), n.alias("n"),
                         F.when(~good, F.col("line")).alias("line"), "reason")


def _line_counts(lines: DataFrame) -> DataFrame:
    """Per file: ``lines``, ``rejected``, the first of its ``reason`` in ``REASONS`` (its
    number) and ``rows``.  All sums are numbers, so they are added up by hash: the least of
    strings would have every task sort its lines, values included."""
    number = F.when(F.col("reason") == REASONS[0], 0)
    for i, reason in enumerate(REASONS[1:], 1):
        number = number.when(F.col("reason") == reason, i)
    return lines.groupBy("file").agg(F.count(F.lit(1)).alias("lines"), F.count("reason").alias("rejected"),
                                     F.min(number).alias("reason"), F.sum("n").alias("rows"))


class _Part:
    """Files of a batch that were read together."""

    def __init__(self, spark: SparkSession, paths: list[str]) -> None:
        self.paths = paths
        self.lines = stage(_parsed_lines(spark, paths), "load-lines", spark)
        try:
            one = F.expr("CASE WHEN listed THEN try_cast(v AS array<variant>) ELSE array(v) END")
            self.values = self.lines.where("reason IS NULL").select("file", F.explode(one).alias("v"))
            self.types, self.spelled = _columns(variant_types(self.values.agg(F.schema_of_variant_agg("v")).first()[0]))
            self.rows(self.types)       # analysed here, where a bad name can still be set aside
        except BaseException:
            drop_staged(spark, self.lines)
            raise

    def rows(self, types: T.StructType) -> DataFrame:
        """The values as columns of the table's ``types``, those this part has: taken by this
        part's own names and types, then cast upward."""
        final = {f.name.lower(): f for f in types.fields}
        own = {f.name.lower(): f.dataType for f in self.types.fields}
        most = max((len(s) for s in self.spelled.values()), default=0)
        out = self.values
        for i in range(most):       # the i-th spelling of each column
            struct = T.StructType([T.StructField(s[i], stored_type(own[k])) for k, s in self.spelled.items() if len(s) > i])
            kind = ddl(struct).replace("\\", "\\\\").replace("'", "\\'")
            out = out.withColumn(f"_{i}", F.expr(f"try_variant_get(v, '$', '{kind}')"))
        out = out.select(*[F.coalesce(*[F.col(f"_{i}")[s] for i, s in enumerate(spellings)]).alias(f"c{n}")
                           for n, spellings in enumerate(self.spelled.values())])
        return out.select(*[F.expr(upcast_sql(f"c{n}", own[k], stored_type(final[k].dataType))).alias(final[k].name)
                            for n, k in enumerate(self.spelled)])


def _is_the_files_fault(e: Exception) -> bool:
    """A file that can't be read, or whose names can't be columns; not a lost executor."""
    return isinstance(e, (AnalysisException, ParseException)) or "FAILED_READ_FILE" in str(e)


def _parts(spark: SparkSession, paths: list[str], bad: list[tuple[str, str]]) -> list[_Part]:
    """The files read together where that works; else by halves, down to the files that
    can't be read or understood, which go to ``bad`` with the reason."""
    try:
        return [_Part(spark, paths)]
    except Exception as e:
        if not _is_the_files_fault(e):
            raise
        if len(paths) == 1:
            bad.append((paths[0], f"{type(e).__name__}: {e}"[:1000]))
            return []
    half = len(paths) // 2
    return _parts(spark, paths[:half], bad) + _parts(spark, paths[half:], bad)


def _plain_path(path: str) -> str:
    """A path as both sources of file names agree on it."""
    return re.sub(r"^file:/*", "/", unquote(path))


def _write_side(df: DataFrame, table_path: str, folder: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(BATCH_COL).parquet(_below(table_path, folder)))


def _load(spark: SparkSession, table_path: str, paths: list[str], batch_id: int) -> dict[str, int]:
    """One batch: rows, rejects, types and outcomes, each replaced when it runs again."""
    bad: list[tuple[str, str]] = []
    parts = _parts(spark, paths, bad)
    batch = F.lit(batch_id).cast("bigint").alias(BATCH_COL)
    ranges = _ranges(spark, table_path, before=batch_id)
    for p in parts:
        if p.types.fields:
            ranges = _extended(ranges, batch_id, p.types)
    # several parts of one batch share its types
    ranges = [r for i, r in enumerate(ranges) if i + 1 == len(ranges) or ranges[i + 1][0] != r[0]]
    counts = {}
    rows = None
    for p in parts:
        for r in _line_counts(p.lines).collect():
            counts[_plain_path(r.file)] = r     # as many as the batch has files
        if p.types.fields:
            mine = p.rows(ranges[-1][1])
            rows = mine if rows is None else rows.unionByName(mine, allowMissingColumns=True)
    if rows is not None:
        (rows.select("*", batch).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(BATCH_COL).parquet(table_path))
        if ranges != _ranges(spark, table_path, before=batch_id):
            # recorded before the batch commits, so a replayed batch records it again
            _record_ranges(spark, table_path, batch_id, ranges)
    if any(r.rejected for r in counts.values()):
        lines = [p.lines.where("reason IS NOT NULL").select("file", "line", "reason", batch) for p in parts]
        _write_side(functools.reduce(DataFrame.unionAll, lines), table_path, REJECTS_DIR)
    reasons, outcomes = dict(bad), []
    for path in paths:
        r = counts.get(_plain_path(path))
        if path in reasons:
            outcomes.append((path, "unreadable", 0, 0, 0, reasons[path], batch_id))
        elif r is None:
            outcomes.append((path, "empty", 0, 0, 0, None, batch_id))
        else:
            status = "loaded" if not r.rejected else "partly" if r.rejected < r.lines else "rejected"
            reason = None if r.reason is None else REASONS[r.reason]
            outcomes.append((path, status, r.lines, r.rows, r.rejected, reason, batch_id))
    _write_side(spark.createDataFrame(outcomes, FILES).coalesce(1), table_path, FILES_DIR)
    drop_staged(spark, *[p.lines for p in parts])
    return {"files": len(paths), "rows": sum(o[3] for o in outcomes), "rejected": sum(o[4] for o in outcomes),
            "unreadable": len(bad)}


def record_empty(spark: SparkSession, table_path: str, like: DataFrame) -> None:
    """Give a bronze dataset that has no rows yet the columns that ``like`` will have once
    it has gone through JSON, so later steps can read it."""
    def landed(t: T.DataType) -> T.DataType:
        if isinstance(t, T.IntegralType):
            return T.LongType()
        if isinstance(t, (T.FractionalType, T.DecimalType)):
            return T.DoubleType()
        return t if isinstance(t, (T.BooleanType, T.StructType, T.ArrayType)) else T.StringType()

    fields = [T.StructField(f.name, landed(f.dataType)) for f in like.schema.fields]
    _record_ranges(spark, table_path, -1, [(-1, T.StructType(fields))])


def load_new_files(spark: SparkSession, source_dir: str, table_path: str,
                   checkpoint: str | None = None, max_files_per_batch: int = 1000,
                   pattern: str | None = None) -> dict:
    """Append the rows of every JSON Lines file under ``source_dir`` not loaded
    before into the parquet table at ``table_path``.  Returns what this call did: micro-
    ``batches`` with rows, ``files``, ``rows``, ``rejected`` lines, ``unreadable`` files.

    Every file counts, whatever its extension (compressed ones are read by it), unless
    the caller gives a file-name ``pattern``; names that begin with ``_`` or ``.`` are
    Spark's own.  A backlog is drained in batches of ``max_files_per_batch`` files, which
    bounds the file list a batch brings to the driver.

    A line is a JSON object or a list of objects.  Other lines, and objects that give a
    name twice, are rejected.  An unreadable file is taken as done: land it again under
    another name.  See ``read_rejects`` and ``read_outcomes``.
    """
    checkpoint = checkpoint or f"{table_path.rstrip('/')}/_checkpoint"
    stats = dict.fromkeys(["batches", "files", "rows", "rejected", "unreadable"], 0)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        paths = [r[0] for r in batch.collect()]  # at most max_files_per_batch paths
        if not paths:
            return
        got = _load(spark, table_path, paths, batch_id)
        for k, n in got.items():
            stats[k] += n
        stats["batches"] += got["rows"] > 0

    # binaryFile with only ``path`` selected never reads file contents: each
    # micro-batch is just the list of files not seen before.
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("maxFilesPerTrigger", max_files_per_batch))
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    query = (reader.load(f"{source_dir.rstrip('/')}/*").select("path")
             .writeStream.foreachBatch(load_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return stats


# ---- the catalog -------------------------------------------------------------------

def register_bronze(spark: SparkSession, table: str, table_path: str) -> None:
    """List the bronze dataset at ``table_path`` in the catalog as ``table``: created on the
    first load, widened by new columns, and given the partitions of new loads.

    While all files have the same types it is a table.  Where types have grown it is a
    view over one table for each range of batches (``<table>__types<n>``), with the casts."""
    ranges = _ranges(spark, table_path)
    if not ranges:
        return
    if len(ranges) == 1:
        _bronze_table(spark, table, table_path, ranges[0][1])
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        spark.catalog.refreshTable(table)
        return
    batches, selects = number_folders(spark, table_path, BATCH_COL), []
    for i, (first, types) in enumerate(ranges):
        part = f"{table}__types{i}"
        _bronze_table(spark, part, table_path, types)
        last = ranges[i + 1][0] if i + 1 < len(ranges) else None
        mine = [b for b in batches if (not i or b >= first) and (last is None or b < last)]
        for at in range(0, len(mine), 200):
            added = " ".join(f"PARTITION ({BATCH_COL} = {b}) LOCATION '{_below(table_path, f'{BATCH_COL}={b}')}'"
                             for b in mine[at:at + 200])
            spark.sql(f"ALTER TABLE {part} ADD IF NOT EXISTS {added}")
        spark.catalog.refreshTable(part)
        selects.append(f"SELECT {', '.join(_upcasts(types, ranges[-1][1]))}, {BATCH_COL} FROM {part}")
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        spark.sql(f"DROP TABLE {table}")        # an entry over the same files
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS {' UNION ALL '.join(selects)}")


def _bronze_table(spark: SparkSession, table: str, table_path: str, types: T.StructType) -> None:
    """An external table over the dataset's files of these types, without partitions yet."""
    fields = stored_type(types).fields
    if not spark.catalog.tableExists(table):
        cols = ", ".join(f"{quoted(f.name)} {ddl(f.dataType)}" for f in fields)
        spark.sql(f"CREATE TABLE {table} ({cols}, `{BATCH_COL}` BIGINT) USING parquet "
                  f"PARTITIONED BY (`{BATCH_COL}`) LOCATION '{table_path}'")
    known = {c.name.lower() for c in spark.catalog.listColumns(table)}
    new = ", ".join(f"{quoted(f.name)} {ddl(f.dataType)}" for f in fields if f.name.lower() not in known)
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({new})")
