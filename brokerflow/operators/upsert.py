"""Keyed upsert of a snapshot: the MERGE of tables that have no transactional format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brokerflow.plans.scratch import fits_broadcast, settle, settle_measured

#: The column of ``with_repeats``.
REPEATED = "_repeated"


def repeats(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int]:
    """The hashes of the keys that several rows have, stored, and their bytes; 0 where no key is repeated."""
    many = df.groupBy(F.xxhash64(*keys).alias("_hash")).agg(F.count("*").alias("_n")).where("_n > 1")
    return settle_measured(many.select("_hash", F.lit(True).alias(REPEATED)), "repeated")


def with_repeats(df: DataFrame, keys: Sequence[str], found: tuple[DataFrame, int] | None = None) -> DataFrame:
    """Add ``REPEATED``: whether several rows have the row's key, or may have. ``found`` is what ``repeats`` gave.

    Hashes of the keys alone are dealt out, so ``df`` is read twice. Keys with the same hash count as repeated, and
    all of them do where the repeated ones are too many to broadcast; that costs time and changes no result.
    """
    repeated, size = found or repeats(df, keys)
    if not fits_broadcast(size):
        return df.withColumn(REPEATED, F.lit(True))
    flagged = df.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(repeated), "_hash", "left")
    return flagged.select(*df.columns, F.coalesce(REPEATED, F.lit(False)).alias(REPEATED))


def repeats_apart(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``with_repeats``, with the rows of repeated keys written out, so that what follows is computed for these few and not for all rows twice."""
    found = with_repeats(df, keys)
    again = settle(found.where(REPEATED), "again").withColumn(REPEATED, F.lit(True))
    # Files don't tell that a text is never NULL; whoever counts it would then have to read it.
    for field in df.schema.fields:
        if field.dataType == T.StringType() and not field.nullable:
            again = again.withColumn(field.name, F.coalesce(field.name, F.lit("")))
    return found.where(~F.col(REPEATED)).withColumn(REPEATED, F.lit(False)).unionByName(again)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` values.

    Aggregated on the map side first, so a key with many rows never meets in one task whole. Where ``df`` has the
    column of ``with_repeats``, rows without others of their key are passed on as they are.
    """
    if REPEATED in df.columns:
        single, others = (df.where(c).drop(REPEATED) for c in (~F.col(REPEATED), F.col(REPEATED)))
        return single.unionByName(latest_per_key(others, keys, order))
    values = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*values), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)


def unseen(target: DataFrame, source: DataFrame, size: int, keys: Sequence[str]) -> DataFrame:
    """The rows of ``source``, stored and measured, whose key the target does not hold.

    A small source is broadcast to the target instead of shuffling the target to it.
    """
    keys = list(keys)
    if not fits_broadcast(size):
        return source.join(target.select(*keys), keys, "left_anti")
    wanted = F.broadcast(source.select(*keys))
    known = target.select(*keys).join(wanted, keys, "left_semi").distinct()
    return source.join(F.broadcast(known), keys, "left_anti")  # known: at most the source's keys


def insert_only(target: DataFrame | None, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``source`` to append to a table whose rows never change."""
    if target is None:
        return source
    new, size = settle_measured(source, "insert")
    return unseen(target, new, size, keys)


def upsert(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    insert_cols: Sequence[str],
) -> DataFrame:
    """``target`` with the rows of ``source`` merged in by key.

    A matched row takes ``update_cols`` from the source (none: the target row stays as it is); an
    unmatched source row is added with ``insert_cols``, its other columns are NULL. Both sides hold
    one row per key. A small source, the usual micro-batch, is broadcast, so that the target is not
    shuffled; a large one meets the target in a full outer join.
    """
    keys, insert_cols = list(keys), list(insert_cols)
    if target is None:
        return source.select(*keys, *insert_cols)

    new, size = settle_measured(source, "upsert")
    fields = {f.name: f.dataType for f in target.schema.fields}

    def inserted(name: str) -> Column:
        value = F.col(name) if name in keys or name in insert_cols else F.lit(None)
        return value.cast(fields[name]).alias(name)

    renamed = new.select(
        *keys,
        F.lit(True).alias("_matched"),
        *[F.col(c).alias(f"_new_{c}") for c in new.columns if c not in keys],
    )

    def merged(name: str) -> Column:
        if name in keys or name not in update_cols:
            return F.col(name)
        return F.when(F.col("_matched"), F.col(f"_new_{name}").cast(fields[name])).otherwise(F.col(name)).alias(name)

    if fits_broadcast(size):
        kept = target
        if update_cols:
            kept = target.join(F.broadcast(renamed), keys, "left").select(*[merged(c) for c in fields])
        added = unseen(target, new, size, keys)
        return kept.unionByName(added.select(*[inserted(c) for c in fields]))

    both = target.withColumn("_old", F.lit(True)).join(renamed, keys, "full_outer")

    def either(name: str) -> Column:
        if name in keys:
            return F.col(name)
        added = F.col(f"_new_{name}").cast(fields[name]) if name in insert_cols else F.lit(None)
        return F.when(F.col("_old").isNull(), added).otherwise(merged(name)).alias(name)

    return both.select(*[either(c) for c in fields])
