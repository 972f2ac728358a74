"""CSV snapshots of the business views, read when no live view is at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_snapshot(view: DataFrame, path: str) -> None:
    view.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
