"""Landing zone: JSON Lines per entity and run date, and single-line JSON scans."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession


# ISO-8601 with microseconds (Spark's JSON default keeps milliseconds).
ISO_ZONED = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
ISO_LOCAL = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# The marker that Hadoop's committer leaves in a folder whose write succeeded.
COMMITTED = "_SUCCESS"


def landing_path(root: str, entity: str, run_date: str | _dt.date) -> str:
    """``<root>/<entity>/<entity>_<YYYY-MM-DD>``: one folder per entity and run date."""
    day = run_date.isoformat() if isinstance(run_date, _dt.date) else str(run_date)
    _dt.date.fromisoformat(day)  # reject malformed dates early
    return f"{root.rstrip('/')}/{entity}/{entity}_{day}"


def is_committed(spark: SparkSession, path: str) -> bool:
    """Whether a write into ``path`` has succeeded."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{COMMITTED}")
    return bool(marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker))


def land_json(df: DataFrame, root: str, entity: str, run_date: str | _dt.date | None = None) -> str:
    """Write ``df`` as JSON Lines (one object per line, NULL fields written out, executors
    write in parallel) under the entity's folder for ``run_date`` (default: today, UTC).

    A day that is landed stays as it is: the loader already took its files, and fresh
    part-file names would otherwise be loaded a second time.  Landed means that the
    committer's marker is there; what a failed write left is replaced.
    """
    run_date = run_date or _dt.datetime.now(_dt.timezone.utc).date()
    path = landing_path(root, entity, run_date)
    if not is_committed(df.sparkSession, path):
        (df.write.mode("overwrite")
           .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
           .option("ignoreNullFields", "false")
           .option("timestampFormat", ISO_ZONED)
           .option("timestampNTZFormat", ISO_LOCAL)
           .json(path))
    return path


def read_json(spark: SparkSession, paths: str | list[str], schema=None) -> DataFrame:
    """Single-line JSON scan (``multiLine`` off); schema inferred unless given."""
    reader = spark.read.option("multiLine", False)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(paths)
