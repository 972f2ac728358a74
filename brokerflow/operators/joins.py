"""Joins of many rows to a table that holds one row per key, safe against hot keys.

A third of all rows may carry the same key, or no key at all. A plain shuffle join sends those rows
to one task, and the adaptive skew join does not help when the lookup side is an aggregate. So:

* a lookup whose measured size is small is broadcast (``lookup_join``);
* otherwise both sides are dealt out by key, in as many parts as keep the lookup's rows of one in memory, and
  every key with more rows than a part of a task's share is split into as many slots as it has such parts, with
  its lookup row repeated for each slot (``hot_key_join``). No side is sorted, so that none is spilled.

No row is dropped and no key is duplicated: both ways give the plain join's result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerflow.plans.scratch import fits_broadcast, settle, settle_measured, stored_bytes, stored_size

# A key is split from this part of a task's share of the rows on.
PARTS_OF_A_TASK = 64
SPREAD = 1 << 16
# Bytes of the lookup's files whose rows one task holds in memory.
LOOKUP_BYTES = 32 * 1024 * 1024


def target_rows(rows: DataFrame, n: int) -> int:
    """Rows of ``n`` that one key may bring to one task."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, n // (PARTS_OF_A_TASK * tasks))


def _has_keys(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def _bucket(keys: Sequence[str]) -> Column:
    """Hash of the keys in ``SPREAD`` buckets; -1 for rows without a key."""
    return F.when(_has_keys(keys), F.pmod(F.xxhash64(*keys), F.lit(SPREAD))).otherwise(-1).cast("int").alias("_bucket")


def full_buckets(rows: DataFrame, keys: Sequence[str], target: int | None = None) -> tuple[DataFrame, int]:
    """The buckets with more rows than the target, and the target. A key with more rows lies in such a bucket.

    Buckets are counted in the tasks that read the rows, so that no key is dealt out to be counted; and with them the
    rows themselves.
    """
    counted, _ = settle_measured(rows.groupBy(_bucket(keys)).agg(F.count("*").alias("_n")), "buckets")
    if target is None:
        target = target_rows(rows, counted.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0])
    return counted.where(F.col("_n") > target).select("_bucket"), target


def hot_keys(rows: DataFrame, keys: Sequence[str], target: int) -> DataFrame:
    """The non-NULL keys with more than ``target`` rows, and the slots to split each into.

    There are fewer keys than rows / target, that is a few per task, and as few slots again.
    """
    counts = rows.where(_has_keys(keys)).groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > target)
    return counts.select(*keys, F.ceil(F.col("_n") / target).cast("int").alias("_slots"))


def joint_key(*columns: str) -> Column:
    """One text key for several columns that treats NULL as a value, as GROUP BY does."""
    return F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("~")) for c in columns])


def _spread(spread_by: Sequence[str]) -> Column:
    # A hash of the row's own id: the same row gets the same slot when a task is run again.
    return (F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)) + 1).cast("int")


def hot_key_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    target: int | None = None,
) -> DataFrame:
    """Join ``rows`` to ``lookup`` (unique on ``keys``) by shuffle, with the hot keys split.

    ``spread_by`` names columns that differ between rows of the same key. Both inputs are read twice, ``rows`` once
    more where there are hot keys; settle them first when they are costly to build.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    keys = list(keys)
    values = [c for c in lookup.columns if c not in keys]
    full, target = full_buckets(rows, keys, target)
    if full.isEmpty():
        return _dealt(rows, lookup, keys, how).select(*rows.columns, *values)
    near = rows.withColumn("_bucket", _bucket(keys)).join(F.broadcast(full), "_bucket", "left_semi").drop("_bucket")
    hot, size = settle_measured(hot_keys(near, keys, target), "hot")
    hot = F.broadcast(hot) if fits_broadcast(size) else hot

    spread = _spread(spread_by)
    # Rows without a key have no partner in any slot. The zero is computed from the key: a literal would
    # be folded into a filter, and the plain key would then be the only join key.
    zero = F.pmod(F.hash(*keys), F.lit(1))
    slot = F.when(~_has_keys(keys), -spread).when(F.col("_slots").isNotNull(), F.pmod(spread, "_slots")).otherwise(zero)
    slotted = rows.join(hot, keys, "left").withColumn("_slot", slot.cast("int"))
    last = F.coalesce(F.col("_slots"), F.lit(1)) - 1
    repeated = lookup.join(hot, keys, "left").select(*keys, *values, F.explode(F.sequence(F.lit(0), last)).alias("_slot"))
    return _dealt(slotted, repeated, [*keys, "_slot"], how).select(*rows.columns, *values)


def _dealt(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join by shuffle, with the lookup's rows of a task as a hash table: no row of either side is sorted.

    A lookup that doesn't come from files has no known size, and is sorted.
    """
    size = stored_bytes(lookup)
    if size is None:
        return rows.join(lookup, keys, how)
    tasks, parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // LOOKUP_BYTES
    if parts > tasks:
        rows, lookup = rows.repartition(parts, *keys), lookup.repartition(parts, *keys)
    return rows.join(lookup.hint("shuffle_hash"), keys, how)


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    name: str = "lookup",
    stored: bool = False,
    cheap: bool = False,
) -> DataFrame:
    """Join to a lookup (unique on ``keys``) in the way its measured size allows.

    The lookup is written out and measured on the way, unless it is ``stored`` already. It is
    broadcast only if it fits; otherwise ``hot_key_join`` does the work, on rows that are stored first,
    unless they are ``cheap``: stored already, or computed row by row from what is.
    """
    keys = list(keys)
    table, size = (lookup, stored_size(lookup)) if stored else settle_measured(lookup, name)
    if fits_broadcast(size):
        values = [c for c in table.columns if c not in keys]
        return rows.join(F.broadcast(table), keys, how).select(*rows.columns, *values)
    return hot_key_join(rows if cheap else settle(rows, f"{name}-rows"), table, keys, spread_by, how)
