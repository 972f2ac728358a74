"""Intermediate tables of the text operators, in the shared folder that ``spark.checkpoint.dir`` names.

A lost executor loses none of them. ``brokerflow.plans.scratch.release`` deletes them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brokerflow.plans.scratch import shared_folder


def place(spark: SparkSession, group: str, name: str) -> str:
    """A new folder below the one of ``group``."""
    return f"{shared_folder(spark)}/llm/{group}/{name}-{uuid.uuid4().hex}"


def settle_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(df: DataFrame, group: str, name: str) -> DataFrame:
    """Write once, read many times, below the folder of ``group``."""
    return settle_at(df, place(df.sparkSession, group, name))


def numbered(df: DataFrame, group: str, name: str) -> DataFrame:
    """``settle`` with a number ``row`` of each row. It is stored with the row, so it stays the same."""
    return settle(df.withColumn("row", F.monotonically_increasing_id()), group, name)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
