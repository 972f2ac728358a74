"""Control over where an expensive expression is evaluated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is evaluated once per row.

    Catalyst copies the expression of a plain column into every filter and projection above it, so a
    parsed document would be parsed again for each of them. It does not copy through a generator.
    """
    return df.withColumn(name, F.explode(F.array(value)))
