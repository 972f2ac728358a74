"""Intermediate tables in the folder shared by all executors.

``settle`` writes a frame as parquet and reads it back. It is used where a frame is read more than
once and costs a shuffle to build, and where its size has to be known. The copy lives in the folder
named by ``spark.checkpoint.dir``, so losing executors loses nothing.

What is written takes little room: files are compressed with zstd, and Spark deletes the shuffle files of
a write at its end rather than when the driver happens to collect its garbage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import Any

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup table is sent to every executor only up to this many bytes of row text.
BROADCAST_BYTES = 32 * 1024 * 1024
# What Spark takes for the size of a frame that it can't tell is far above this.
UNKNOWN_BYTES = 1 << 60
# Whether a session deletes the shuffle files of an execution at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_scope: ContextVar[str] = ContextVar("scope", default="kept")


def shared_folder(spark: SparkSession) -> str:
    """The folder of this application below ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/brokerflow/{spark.sparkContext.applicationId}"


def current_scope() -> str:
    return _scope.get()


def new_folder(spark: SparkSession, name: str, held: str | None = None) -> str:
    """A new folder in the scope ``held``, or in the current one."""
    return f"{shared_folder(spark)}/{held or _scope.get()}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scope(spark: SparkSession, name: str) -> Iterator[None]:
    """What is settled inside is deleted at the end, also after an error."""
    token = _scope.set(f"{name}-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        _delete(spark, f"{shared_folder(spark)}/{_scope.get()}")
        _scope.reset(token)


def together(*steps: Callable[[], Any]) -> list[Any]:
    """Run steps that do not need each other as concurrent Spark jobs, in this scope; the first error is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, step) for step in steps]]


def lean(df: DataFrame) -> DataFrameWriter:
    """The writer of a table that takes little room. The session goes on deleting shuffle files at the end of what it runs."""
    df.sparkSession.conf.set(CLEANUP, "true")
    return df.write.option("compression", "zstd")


def settle(df: DataFrame, name: str, held: str | None = None) -> DataFrame:
    """Write once, read many times, as long as the current scope or the scope ``held`` lasts."""
    path = new_folder(df.sparkSession, name, held)
    lean(df).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _row_bytes() -> Column:
    return F.octet_length(F.to_json(F.struct("*")))


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row, without turning it into text: those of its texts, and a fixed number for other values."""
    size = F.lit(16 * len(schema.fields)).cast("long")
    for field in schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
    return size


def settle_measured(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``settle``, and the bytes of all rows as text, summed up while they are written."""
    size = Observation()
    total = F.coalesce(F.sum(_row_bytes()), F.lit(0)).alias("bytes")
    settled = settle(df.observe(size, total), name)
    return settled, size.get["bytes"]


def stored_bytes(table: DataFrame) -> int | None:
    """Bytes of the files of the stored tables that a frame is made of; None when it is made of anything else as well."""
    leaves = table._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.length())]
    return None if any(size >= UNKNOWN_BYTES for size in sizes) else sum(sizes)


def stored_size(table: DataFrame) -> int | None:
    """Bytes of all rows of stored tables put together, as text; None when their files alone are too large to broadcast."""
    files = stored_bytes(table)
    if files is None or files > BROADCAST_BYTES:
        return None
    return table.agg(F.coalesce(F.sum(_row_bytes()), F.lit(0)).alias("bytes")).first()["bytes"]


def fits_broadcast(size: int | None) -> bool:
    return size is not None and size <= BROADCAST_BYTES


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application."""
    _delete(spark, shared_folder(spark))


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
