"""Reading Arrow text columns as bytes and as words, some megabytes at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are worked on at once; a longer document is worked on alone.
CHUNK_BYTES = 2 << 20

#: White space between words: space and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each text starts (one more entry than texts). Null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``CHUNK_BYTES`` of text each, with its bytes and offsets."""
    for batch in batches:
        data, offsets = utf8(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield (
                batch.slice(first, last - first),
                data[offsets[first] : offsets[last]],
                offsets[first : last + 1] - offsets[first],
            )
            first = last


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true entries; no run crosses the start of a document."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the number of each document's first word (one more entry)."""
    starts, ends = runs(~SPACE[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with a name for a value that is computed once a row, however often lambdas in it ask for it."""
    return f"transform(array({value}), {name} -> {body})[0]"


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
