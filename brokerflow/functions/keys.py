"""Deterministic identifiers: the same record always gets the same key, on any retry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def raw_id(topic: Column, partition: Column, offset: Column) -> Column:
    """Identity of a delivered message: its place in the log."""
    return F.md5(F.concat_ws("|", topic, partition.cast("string"), offset.cast("string")))


def staged_id(raw: Column) -> Column:
    return F.md5(F.concat(F.lit("stg|"), raw))


def customer_id(name: Column) -> Column:
    """Hash of the normalised name, equal for spellings that differ in case or outer blanks."""
    return F.md5(F.upper(F.trim(name)))


def surrogate_key(*business_key: Column) -> Column:
    """Surrogate key of a dimension or fact row: a hash of its business key, NULL when that is NULL.

    A hash needs no coordination between tasks, and a fact can compute the key of its dimension
    row without joining to the dimension.
    """
    present = F.lit(True)
    for part in business_key:
        present = present & part.isNotNull()
    return F.when(present, F.md5(F.concat_ws("|", *business_key)))
