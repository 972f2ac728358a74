"""Contiguous shards with the smallest possible largest size, in DataFrame functions alone.

Documents with equal text are one atomic group. Groups stand in the order of their text's digest, and
each shard is a stretch of that order. The capacity is the smallest with which a greedy pass, which
gives each shard as many groups as fit, needs no more than the wanted shards; it is found by binary
search. Cuts are made where the pass with that capacity makes them.

The search runs over cells: ranges of the order with the sum of their groups. A cell with one group
can't be cut. For one with more, two passes bound the truth: one that cuts only between cells, and one
that cuts inside them at any byte. Cells where these leave a cut open are counted again in finer cells,
until both agree. So the driver holds some thousand cells at a time, whatever the number of groups.

Null texts have no bytes and are one group with the empty ones. Repeated rows are rows. Groups whose
digests agree in the first 60 bits are one group. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brokerflow.llm.store import settle

SHARDS = 16
#: Bits of the order, and by how many bits cells get finer each time.
ORDER_BITS = 60
FINER_BITS = 10
#: Rows that are numbered together within a shard, about.
ROWS_PER_BLOCK = 20_000


def ordered(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the place of the text in the order."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.conv(F.substring(F.sha2(text, 256), 1, ORDER_BITS // 4), 16, 10).cast("long").alias("place"),
    )


class Cells:
    """Ranges of a stretch of the order, as (first place, bytes, groups), in order."""

    def __init__(self, rows: list[tuple[int, int, int]]):
        rows = sorted(rows)
        self.first = [r[0] for r in rows]
        self.size = np.array([r[1] for r in rows], np.int64)
        self.one = np.array([r[2] == 1 for r in rows], bool)
        self.end = np.cumsum(self.size)
        self.total = int(self.end[-1]) if rows else 0

    def cuts(self, capacity: int, inside: bool, most: int) -> list[int]:
        """The bytes before each of the first ``most`` cuts of a greedy pass; the same again where nothing fits.

        ``inside``: cells with several groups may be cut at any byte.
        """
        out, at = [], 0
        while len(out) < most and at + capacity < self.total:
            reach = at + capacity
            cell = int(np.searchsorted(self.end, reach, side="right"))
            at = reach if inside and not self.one[cell] else max(at, int(self.end[cell] - self.size[cell]))
            out.append(at)
        return out

    def shards(self, capacity: int, inside: bool, most: int) -> int:
        """Shards that the pass needs; more than ``most`` if it isn't done by then."""
        return len(self.cuts(capacity, inside, most)) + 1 if self.total else 0


def _least(stretches: list[Cells], shards: int, inside: bool) -> int:
    """The smallest capacity with which the stretches need no more than ``shards``."""
    low, high = 0, max((s.total for s in stretches), default=0)
    while low < high:
        middle = (low + high) // 2
        if sum(s.shards(middle, inside, shards) for s in stretches) > shards:
            low = middle + 1
        else:
            high = middle
    return high


def _open(stretches: list[Cells], shards: int) -> list[tuple[int, int]]:
    """(stretch, first place) of the cells with several groups in which a cut of the best capacity may lie."""
    low, high = _least(stretches, shards, True), _least(stretches, shards, False)
    found = set()
    for number, cells in enumerate(stretches):
        latest = cells.cuts(high, True, shards)
        for first, last in zip(cells.cuts(low, False, len(latest)), latest, strict=False):
            a, b = np.searchsorted(cells.end, [first, last], side="right").tolist()
            found.update((number, cells.first[c]) for c in range(a, min(b + 1, len(cells.size))) if not cells.one[c])
    return sorted(found)


def _giants(groups: DataFrame, total: int, shards: int) -> list[int]:
    """Places of the groups that are larger than an equal share of what the larger ones leave: fewer than ``shards``."""
    rest, out = total, []
    for row in groups.orderBy(F.desc("bytes"), "place").limit(shards).collect():
        if row["bytes"] * (shards - len(out)) <= rest or len(out) == shards - 1:
            break
        rest -= row["bytes"]
        out.append(row["place"])
    return sorted(out)


def _stretch(giants: list[int]) -> Column:
    """Number of giants before a place."""
    return sum((F.when(F.col("place") > g, 1).otherwise(0) for g in giants), F.lit(0))


def minimax(groups: DataFrame, shards: int) -> list[int]:
    """The places at which shards after the first begin. ``groups`` has place and bytes, a row per group.

    A group larger than an equal share is a shard of its own, since it would set the capacity for all
    others; the stretches between such groups are cut with one capacity for all of them. Where that takes
    more shards than there are, such groups are cut off like any other.
    """
    total = groups.agg(F.sum("bytes")).first()[0]
    if total is None:
        return []
    giants = _giants(groups, total, shards)
    while True:
        rest = groups.filter(~F.col("place").isin(giants)).withColumn("stretch", _stretch(giants))
        bits = ORDER_BITS - FINER_BITS
        rows = _cells(rest, bits)
        used = len({r[0] for r in rows})
        if len(giants) + used <= shards:
            break
        giants = []
    left = shards - len(giants)
    stretches = [Cells([r[1:] for r in rows if r[0] == number]) for number in range(len(giants) + 1)]
    while bits > 0 and (wide := _open(stretches, left)):
        finer = _cells(rest, bits - FINER_BITS, bits, wide)
        chosen, bits = set(wide), bits - FINER_BITS
        for number, cells in enumerate(stretches):
            kept = [(f, int(s), 1 if o else 2) for f, s, o in zip(cells.first, cells.size, cells.one, strict=True) if (number, f) not in chosen]
            stretches[number] = Cells(kept + [r[1:] for r in finer if r[0] == number])
    capacity = _least(stretches, left, False)
    starts = list(giants)
    for cells, after in zip(stretches, [0, *(g + 1 for g in giants)], strict=True):
        before, cuts = cells.end - cells.size, cells.cuts(capacity, False, left)
        starts += [max(after, cells.first[int(np.searchsorted(before, cut))]) for cut in [0, *cuts] if cells.total]
    return sorted(starts)[1:]


def _cells(groups: DataFrame, bits: int, wider: int = 0, within: list[tuple[int, int]] | None = None) -> list[tuple[int, int, int, int]]:
    """(stretch, first place, bytes, groups) of the cells of ``2 ** bits`` places, all or those within wider cells.

    At most ``2 ** FINER_BITS`` cells each of the whole order or of a wider cell; a shard has few of these open.
    """
    if within is not None:
        groups = groups.filter(F.shiftleft(F.shiftright("place", wider), wider).isin([first for _, first in within]))
    first = F.shiftleft(F.shiftright("place", bits), bits)
    summed = groups.groupBy("stretch", first.alias("first")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("groups"))
    wanted = set(within) if within is not None else None
    rows = [(r["stretch"], r["first"], r["bytes"], r["groups"]) for r in summed.collect()]
    return [r for r in rows if wanted is None or (r[0], r[1] >> wider << wider) in wanted]


def shard(docs: DataFrame, shards: int = SHARDS, group: str = "sharding") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``bytes``: shards' sizes are as near to each other as whole groups in this order allow, in
    that the largest shard is as small as it can be.
    """
    rows = settle(ordered(docs), group, "rows")
    groups = settle(rows.groupBy("place").agg(F.sum("size").alias("bytes")), group, "groups")
    starts = minimax(groups, shards)
    number: Column = F.lit(0)
    for start in starts:
        number = number + F.when(F.col("place") >= start, 1).otherwise(0)
    blocks = max(1, -(-rows.count() // (ROWS_PER_BLOCK * shards)))
    placed = rows.withColumn("shard", number.cast("int")).withColumn("block", F.pmod(F.xxhash64("doc_id", "place"), F.lit(blocks)).cast("int"))
    sizes = placed.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("block")) - F.col("n")).drop("n")
    within = F.row_number().over(Window.partitionBy("shard", "block").orderBy("place", "doc_id")) - 1
    slotted = placed.withColumn("within", within).join(before, ["shard", "block"])
    return slotted.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("within")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
