"""Exact duplicates through an index of cuckoo filters.

The index is split into buckets by digest, and a task works through its buckets one after another. Each
bucket has a cuckoo filter of short fingerprints and the stored keys. A digest that the filter doesn't
know is new. One that it may know is looked up among the bucket's stored keys, so a false hit costs a
lookup and is never a duplicate. A digest whose last document goes leaves the filter. When an insertion
finds no place, the filter is made twice as large and filled again from the stored keys.

A digest is SHA-256 of the text with each run of white space as one space. Null counts as empty. Rows are
numbered once, in a stored table, and of equal texts exactly one row is kept: of those with the smallest
``doc_id`` the first. A null ``doc_id`` is never the smallest; of a group of such rows alone one is kept, and
its ``keep_id`` is null. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerflow.llm.store import numbered, settle, tasks
from brokerflow.llm.text import record
from brokerflow.plans.scratch import fits_broadcast, settle_measured

#: Live digests of a bucket, about; a task holds one bucket at a time.
KEYS_PER_BUCKET = 50_000
SLOTS = 4
KICKS = 200

WHITE_SPACE = "[\\x20\\x09-\\x0D]+"
CHANGES = pa.schema([("bucket", pa.int64()), ("digest", pa.string()), ("low_id", pa.int64()), ("low_row", pa.int64()), ("change", pa.int64())])
CHANGES_DDL = "bucket long, digest string, low_id long, low_row long, change long"
INDEX = pa.schema([("bucket", pa.int64()), ("digest", pa.string()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("group_size", pa.int64())])
INDEX_DDL = "bucket long, digest string, keep_id long, keep_row long, group_size long"
#: The number of a row that comes to a built index, which has numbers of its own.
LATER = 1 << 62


class CuckooFilter:
    """16-bit fingerprints in two possible buckets of four slots."""

    def __init__(self, keys: int = 64):
        self.buckets = 1 << max(4, (keys * 5 // (4 * SLOTS)).bit_length())
        self.slots = array("H", bytes(2 * SLOTS * self.buckets))

    def _places(self, digest: str) -> tuple[int, int, int]:
        mark = int(digest[:4], 16) or 1
        first = int(digest[4:16], 16) & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, place: int, mark: int) -> int:
        return place ^ (mark * 0x5BD1E995 & (self.buckets - 1))

    def _put(self, place: int, mark: int) -> bool:
        for slot in range(SLOTS * place, SLOTS * place + SLOTS):
            if not self.slots[slot]:
                self.slots[slot] = mark
                return True
        return False

    def __contains__(self, digest: str) -> bool:
        mark, first, second = self._places(digest)
        return mark in self.slots[SLOTS * first : SLOTS * first + SLOTS] or mark in self.slots[SLOTS * second : SLOTS * second + SLOTS]

    def insert(self, digest: str) -> bool:
        """False if there is no place; the filter has then lost a fingerprint and must be filled anew."""
        mark, first, second = self._places(digest)
        if self._put(first, mark) or self._put(second, mark):
            return True
        place = second
        for kick in range(KICKS):
            slot = SLOTS * place + (kick + mark) % SLOTS
            mark, self.slots[slot] = self.slots[slot], mark
            place = self._other(place, mark)
            if self._put(place, mark):
                return True
        return False

    def delete(self, digest: str) -> bool:
        """Only for a digest that was inserted: another one may have the same fingerprint."""
        mark, first, second = self._places(digest)
        for place in (first, second):
            for slot in range(SLOTS * place, SLOTS * place + SLOTS):
                if self.slots[slot] == mark:
                    self.slots[slot] = 0
                    return True
        return False


class Bucket:
    """The live digests of one bucket: filter in front, stored keys behind."""

    def __init__(self):
        self.filter = CuckooFilter()
        self.stored: dict[str, list] = {}

    def _place(self, digest: str) -> None:
        placed, room = self.filter.insert(digest), max(64, len(self.stored))
        while not placed:
            room *= 2
            self.filter = CuckooFilter(room)
            placed = all(map(self.filter.insert, self.stored))

    def change(self, digest: str, low: Any, change: int) -> None:
        """Add documents of a digest, of which ``low`` comes first, or take some away; documents that aren't there can't be taken."""
        held = self.stored.get(digest) if digest in self.filter else None
        if held is None:
            if change > 0:
                self.stored[digest] = [low, change]
                self._place(digest)
            return
        held[1] += change
        if held[1] <= 0:
            del self.stored[digest]
            self.filter.delete(digest)
        elif change > 0 and low is not None and (held[0] is None or low < held[0]):
            held[0] = low


def _changes(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(bucket, digest, first document, change); a document is (whether it has no id, id, row), which is how they are ordered."""
    for bucket, digest, low_id, low_row, change in zip(*(batch.column(n).to_pylist() for n in CHANGES.names), strict=True):
        yield bucket, digest, (low_id is None, low_id or 0, low_row), change


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Changes sorted by bucket to the live digests of each bucket."""
    number, bucket = None, Bucket()

    def rows() -> pa.RecordBatch:
        stored, low = bucket.stored, [v[0] for v in bucket.stored.values()]
        ids = [None if without else i for without, i, _ in low]
        return record(INDEX, [number] * len(stored), list(stored), ids, [n for *_, n in low], [v[1] for v in stored.values()])

    for batch in batches:
        for at, digest, low, change in _changes(batch):
            if at != number:
                if bucket.stored:
                    yield rows()
                number, bucket = at, Bucket()
            bucket.change(digest, low, change)
    if bucket.stored:
        yield rows()


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One change per digest, so that copies are few before they are dealt out; a few thousand held at a time."""
    held: dict[str, list] = {}

    def rows() -> pa.RecordBatch:
        columns = zip(*((bucket, digest, None if low[0] else low[1], low[2], change) for digest, (bucket, low, change) in held.items()), strict=True)
        return record(CHANGES, *columns)

    for batch in batches:
        for bucket, digest, low, change in _changes(batch):
            sum_ = held.setdefault(digest, [bucket, low, 0])
            sum_[1], sum_[2] = min(sum_[1], low), sum_[2] + change
        if len(held) > KEYS_PER_BUCKET:
            yield rows()
            held.clear()
    if held:
        yield rows()


def digest_of(text: Column) -> Column:
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ").cast("binary"), 256)


def digests(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest_of(F.col("text")).alias("digest"))


def _buckets(digests_: int) -> int:
    return max(1, -(-digests_ // KEYS_PER_BUCKET))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.conv(F.substring("digest", 50, 15), 16, 10).cast("long"), F.lit(buckets))


def _changed(changes: DataFrame) -> DataFrame:
    dealt = changes.repartition(tasks(changes.sparkSession), "bucket").sortWithinPartitions("bucket", F.desc("change"))
    return dealt.mapInArrow(_apply, INDEX_DDL)


def _row(documents: DataFrame, otherwise: int) -> Column:
    return (F.col("row") if "row" in documents.columns else F.lit(otherwise).cast("long")).alias("low_row")


def build(keyed: DataFrame, buckets: int) -> DataFrame:
    """An index (bucket, digest, keep_id, keep_row, group_size) of the documents (doc_id, digest, and row where they are numbered)."""
    own = [_bucket(buckets).alias("bucket"), "digest", F.col("doc_id").alias("low_id"), _row(keyed, 0), F.lit(1).cast("long").alias("change")]
    return _changed(keyed.select(*own).mapInArrow(_add_up, CHANGES_DDL))


def update(index: DataFrame, buckets: int, come: DataFrame | None = None, gone: DataFrame | None = None) -> DataFrame:
    """The index after documents (doc_id, digest) came and went.

    What comes is applied before what goes. ``keep_id`` stays that of the first build while any document
    of its digest is live, as an index holds no members.
    """
    changes = index.select("bucket", "digest", F.col("keep_id").alias("low_id"), F.col("keep_row").alias("low_row"), F.col("group_size").alias("change"))
    for documents, change in ((come, 1), (gone, -1)):
        if documents is not None:
            own = [_bucket(buckets).alias("bucket"), "digest", F.col("doc_id").alias("low_id"), F.lit(LATER).alias("low_row"), F.lit(change).cast("long").alias("change")]
            changes = changes.unionByName(documents.select(*own).mapInArrow(_add_up, CHANGES_DDL))
    return _changed(changes)


def _index(rows: DataFrame, group: str) -> DataFrame:
    return settle(build(rows.select("doc_id", "digest", "row"), _buckets(rows.count())).drop("bucket"), group, "index")


def duplicates(docs: DataFrame, group: str = "exact") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = numbered(digests(docs), group, "digests")
    found = rows.join(_index(rows, group), "digest")
    return found.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.col("digest").alias("text_sha256"))


def single(docs: DataFrame, group: str = "exact") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    Texts are not dealt out where the numbers of the rows that go can be broadcast.
    """
    held = numbered(docs.select(F.struct("*").alias("doc"), digest_of(F.col("text")).alias("digest")), group, "rows")
    index = _index(held.select(F.col("doc.doc_id").cast("long").alias("doc_id"), "digest", "row"), group)
    kept = index.select(F.col("keep_row").alias("row"))
    gone, size = settle_measured(held.select("row").join(kept, "row", "left_anti"), "gone")
    return held.join(F.broadcast(gone) if fits_broadcast(size) else gone, "row", "left_anti").select("doc.*")
