"""Helpers shared by the operators: staging on shared storage, Arrow access, keys."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierline.session import scratch_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_SHIPPED: set[str] = set()
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application, the way
    ``--py-files`` does.  Where it is installed on every node that changes nothing.

    Texts go to the workers in Arrow batches of 4 MB, unless the session names a size of
    its own: a batch is whole in memory on both sides, in every task of an executor."""
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, str(4 << 20))
    sc = spark.sparkContext
    home = Path(__file__).resolve().parents[1]
    if sc.applicationId in _SHIPPED or not home.is_dir():
        return
    _SHIPPED.add(sc.applicationId)
    archive = Path(tempfile.mkdtemp(prefix="tierline-code-")) / f"{home.name}.zip"   # Spark serves it from the driver
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(home.rglob("*.py")):
            z.write(f, f.relative_to(home.parent))
    sc.addPyFile(str(archive))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """The session's shuffle partition count, the unit in which work is split."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


@contextmanager
def _shuffles_freed(spark: SparkSession):
    """Within: a finished job's shuffle files go at once.  Only for jobs whose whole
    result is written out, so nothing reads those files again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stage(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to a fresh folder below the shared checkpoint folder and read it
    back.  Cuts lineage: a lost executor costs a re-read, never a recomputation."""
    path = scratch_dir(spark, f"llm-{label}")
    with _shuffles_freed(spark):
        df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_path = path
    return staged


def drop_staged(spark: SparkSession, *staged: DataFrame) -> None:
    """Delete staged copies that no later plan reads."""
    for df in staged:
        path = getattr(df, "_staged_path", None)
        if path:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def text_bytes(col: str = "text") -> Column:
    """UTF-8 bytes of a text column; NULL counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow binary or string column, without copying the bytes."""
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


def release_memory() -> None:
    """Hand what Arrow's pool and the C library hold but don't use back to the system.
    Python workers outlive their tasks and share the executor's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):   # another C library
        pass


def tidied(run: Callable) -> Callable:
    """``run`` over a task's batches, releasing memory at the end of the task."""
    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return task


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose ``column`` holds about ``most`` bytes (one row at
    least), so that what is computed from a run stays small beside the executor."""
    _, offsets = binary_parts(batch.column(column))
    at, rows = 0, batch.num_rows
    while at < rows:
        end = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        end = min(rows, max(at + 1, end))
        yield batch.slice(at, end - at)
        at = end


def binary_column(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def frame(schema: StructType, **columns) -> pa.RecordBatch:
    """A record batch in the schema's column order from numpy arrays or Arrow arrays."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in (columns[f.name] for f in schema.fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema.fields])
