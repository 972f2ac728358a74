"""Vectors as short codes: each part of a vector is replaced by the number of its nearest codebook entry.

Codebooks are found by rounds of Lloyd in whole numbers. Every part keeps the number of its entry and the
exact distance to it between rounds. When a part's entry hasn't moved in the last update, the distances to
all entries that haven't moved either are what they were, so the part is compared with the moved entries
alone; a part whose entry has moved is compared with all. Of equally near entries the lower one is taken
in both cases. Rounds in which nothing moves would change nothing and are left out.

A round reads the table that the one before has written and writes the next, with each task's sums of
parts as rows of their own; so a repeated task counts once, and a lost executor costs its tasks. The
driver holds the codebooks and their sums, whose size follows from entries and components alone.

Vectors that are null or hold null or non-finite components are left out. Vectors that are shorter than
the longest, and lengths that the parts don't divide, count as filled up with zeros. A component is held at
the bound beyond which squared distances could leave a ``long``; an error sum per label beyond it is null.
The first entries come from the smallest ids: an id that is there several times gives the smallest of its
vectors, a null id counts as the largest, and with fewer ids there are fewer entries. Repeated rows are
rows. Null labels are one label. An empty table, or one without a usable vector, gives no rows. Only
``vec_id``, ``embedding`` and ``label`` are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brokerflow.llm.store import drop, place, settle, settle_at
from brokerflow.llm.text import record
from brokerflow.operators.joins import joint_key, lookup_join

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Components that are worked on at once in a task.
CHUNK = 1 << 18
LARGEST = 1 << 30

_ROW = "vec_id long, label string, vector binary"
_STATE = f"{_ROW}, codes binary, distances binary, error long, sums array<long>"
_ROW_TYPES = [("vec_id", pa.int64()), ("label", pa.string()), ("vector", pa.binary())]
_STATE_TYPES = [*_ROW_TYPES, ("codes", pa.binary()), ("distances", pa.binary()), ("error", pa.int64()), ("sums", pa.list_(pa.int64()))]
RESULT_DDL = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def _blobs(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Binary values of the given numbers of bytes, in a row."""
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _numbers(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vectors in whole numbers, without those that can't be coded."""
    schema = pa.schema([*_ROW_TYPES, ("width", pa.int32())])
    for batch in batches:
        batch = batch.filter(batch.column("embedding").is_valid())
        vectors = batch.column("embedding")
        sizes = pc.list_value_length(vectors).to_numpy().astype(np.int64)
        flat = vectors.flatten()
        values = pc.fill_null(flat.cast(pa.float64()), math.nan).to_numpy()
        row = np.repeat(np.arange(batch.num_rows), sizes)
        kept = np.bincount(row[~np.isfinite(values)], minlength=batch.num_rows) == 0
        whole = np.clip(np.floor(values[kept[row]] * SCALE), -LARGEST, LARGEST).astype(np.int32)
        rest = batch.filter(pa.array(kept))
        yield pa.RecordBatch.from_arrays(
            [rest.column("vec_id"), rest.column("label"), _blobs(whole, 4 * sizes[kept]), pa.array(sizes[kept], pa.int32())], schema=schema
        )


def _least_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest ids that are not null, as many as there are entries."""
    least = np.zeros(0, np.int64)
    for batch in batches:
        least = np.unique(np.concatenate((least, pc.drop_null(batch.column("vec_id")).to_numpy())))[:ENTRIES]
    yield record(pa.schema([("vec_id", pa.int64())]), least)


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """One row per vector, filled up with zeros, each component within the bound for this width."""
    sizes = pc.binary_length(vectors).to_numpy().astype(np.int64) // 4
    out = np.zeros((len(vectors), width), np.int64)
    first = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(vectors)), sizes)
    out[row, np.arange(len(row)) - first[row]] = _numbers(vectors, "<i4")
    most = math.isqrt((1 << 61) // max(1, width))
    return np.clip(out, -most, most)


def distances(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    difference = parts[:, None, :] - entries[None, :, :]
    return np.einsum("nkd,nkd->nk", difference, difference)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lowest number of a nearest entry, and its distance."""
    all_of_them = distances(parts, entries)
    code = all_of_them.argmin(axis=1)
    return code, all_of_them[np.arange(len(parts)), code]


def again(parts: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``nearest``, from the entry and distance that were right before some entries moved."""
    code, distance = code.copy(), distance.copy()
    lost = moved[code]
    if lost.any():
        code[lost], distance[lost] = nearest(parts[lost], entries)
    if moved.any() and not lost.all():
        held, active = np.flatnonzero(~lost), np.flatnonzero(moved)
        which, least = nearest(parts[held], entries[active])
        which = active[which]
        won = (least < distance[held]) | ((least == distance[held]) & (which < code[held]))
        code[held[won]], distance[held[won]] = which[won], least[won]
    return code, distance


def _assign(books: np.ndarray, moved: np.ndarray | None) -> Callable:
    """Assign all parts to entries; ``moved`` is None where they have no entry yet."""
    parts, entries, size = books.shape
    schema = pa.schema(_STATE_TYPES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, step = np.zeros((parts, entries, size + 1), np.int64), max(1, CHUNK // max(1, parts * size))
        for batch in batches:
            for first in range(0, batch.num_rows, step):
                some = batch.slice(first, step)
                n = some.num_rows
                vectors = matrix(some.column("vector"), parts * size).reshape(n, parts, size)
                code, distance = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
                if moved is not None:
                    code[:] = _numbers(some.column("codes"), "u1").reshape(n, parts)
                    distance[:] = _numbers(some.column("distances"), "<i8").reshape(n, parts)
                for p in range(parts):
                    own = vectors[:, p]
                    if moved is None:
                        code[:, p], distance[:, p] = nearest(own, books[p])
                    else:
                        code[:, p], distance[:, p] = again(own, books[p], moved[p], code[:, p], distance[:, p])
                    for e in range(entries):
                        members = own[code[:, p] == e]
                        sums[p, e, 0] += len(members)
                        sums[p, e, 1:] += members.sum(axis=0)
                columns = [some.column(c) for c, _ in _ROW_TYPES]
                codes, kept = _blobs(code.astype("u1"), np.full(n, parts)), _blobs(distance.astype("<i8"), np.full(n, 8 * parts))
                yield record(schema, *columns, codes, kept, distance.sum(axis=1), pa.nulls(n))
        yield record(schema, *[pa.nulls(1)] * (len(_STATE_TYPES) - 1), [sums.ravel()])

    return run


def _rows(state: DataFrame) -> DataFrame:
    return state.filter("sums is null")


def _totals(state: DataFrame, shape: tuple[int, int, int]) -> tuple[list[int], list[list[int]]]:
    """Number and componentwise sum of the parts at every entry, added up over the tasks. At most a value per component of the codebooks."""
    cells = state.filter("sums is not null").select(F.posexplode("sums").alias("cell", "value"))
    added = cells.groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    parts, entries, size = shape
    flat = [0] * (parts * entries * (size + 1))
    for row in added:
        flat[row["cell"]] = int(row["value"])
    slots = [flat[i : i + size + 1] for i in range(0, len(flat), size + 1)]
    return [s[0] for s in slots], [s[1:] for s in slots]


def updated(books: np.ndarray, counts: list[int], sums: list[list[int]]) -> np.ndarray:
    """Every entry with parts becomes their componentwise mean, rounded down."""
    flat = books.reshape(len(counts), books.shape[2]).tolist()
    means = [[x // n for x in total] if n else old for n, total, old in zip(counts, sums, flat, strict=True)]
    return np.array(means, np.int64).reshape(books.shape)


def first_books(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """The parts of the vectors with the smallest ids, ``entries`` of them."""
    tops = rows.select("vec_id").mapInArrow(_least_ids, "vec_id long").distinct().orderBy("vec_id").limit(entries).collect()
    ids = [r["vec_id"] for r in tops]
    wanted = rows.filter(F.col("vec_id").isin(ids)) if ids else rows.limit(0)
    if len(ids) < entries:
        wanted = wanted.unionByName(rows.filter("vec_id is null"))
    held = wanted.groupBy("vec_id").agg(F.min("vector").alias("vector")).orderBy(F.asc_nulls_last("vec_id")).collect()
    vectors = matrix(pa.array([bytes(r["vector"]) for r in held], pa.binary()), width)
    return vectors.reshape(len(held), parts, width // parts).transpose(1, 0, 2).copy()


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def train(rows: DataFrame, books: np.ndarray, group: str, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The rows with their codes under the books that ``rounds`` rounds lead to, stored; and the books."""
    spark, state, moved, before = rows.sparkSession, rows, None, ""
    for turn in range(rounds + 1):
        path = place(spark, group, f"round{turn}")
        state = settle_at((_rows(state) if turn else state).mapInArrow(_assign(books, moved), _STATE), path)
        if before:
            drop(spark, before)
        before = path
        if turn == rounds:
            break
        new = updated(books, *_totals(state, books.shape))
        moved = (new != books).any(axis=2)
        books = new
        if not moved.any():
            break
    return _rows(state), books


def compress(docs: DataFrame, group: str = "vectors") -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error, codebooks_sha256."""
    spark = docs.sparkSession
    asked = docs.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding")
    rows = settle(asked.mapInArrow(_usable, f"{_ROW}, width int"), group, "vectors")
    longest = rows.agg(F.max("width")).first()[0]
    if longest is None:
        return spark.createDataFrame([], RESULT_DDL)
    width = PARTS * -(-longest // PARTS)
    rows = rows.drop("width")
    state, books = train(rows, first_books(rows, width), group)
    coded = state.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", joint_key("label").alias("label_key"))
    by_label = coded.groupBy("label_key").agg(F.try_sum("error").alias("label_error"))
    told = lookup_join(coded, by_label, ["label_key"], ["vec_id", "code"], name="label_errors")
    return told.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
