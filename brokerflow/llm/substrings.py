"""Passages of words that an earlier document has too, by windows of doubling length.

Level one has windows of half the length: of each run of full windows, the half window that represents
it. Those that no other document has are dropped with all full windows around them. What is left goes
to twice the length, first as whole runs: equal runs of one document after another are settled by their
first document. Only where runs around the same half window differ are their full windows compared one
by one. Nothing longer can change the result, so the levels end there.

A window is identified by two 64-bit hashes, that of its half window and its own. Null texts have no
words. Rows with the same ``doc_id`` are one document and don't remove each other's words; rows with a
null ``doc_id`` come after all others. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerflow.llm import spans
from brokerflow.llm.store import settle
from brokerflow.llm.text import chunks, record, words

WINDOW = 50

RUNS = pa.schema([("gram", pa.int64()), ("run", pa.int64()), ("doc", pa.int64()), ("windows", pa.binary())])
KEPT = pa.schema([("doc", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])
KEPT_DDL = "doc long, n_words long, n_removed long, kept_sha256 string, kept string"


def _opened(window: int) -> Callable:
    """Runs with a half window that another document has, with the hash of each of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches):
            units = spans.word_units(data, offsets)
            found = spans.runs(units, window // 2, window, spans.Hashes(units.values))
            found = found.take(spans.repeated(found, spans.lists(batch.column("singles")), batch.num_rows))
            if not len(found.doc):
                continue
            other = spans.Hashes(units.values, 1)
            whole = other.between(found.first, found.last + window).view(np.int64)
            single = other.all(window)
            held = [single[a : b + 1].tobytes() for a, b in zip(found.first.tolist(), found.last.tolist(), strict=True)]
            yield record(RUNS, found.gram.view(np.int64), whole, batch.column("doc").to_numpy()[found.doc], held)

    return run


def _removed(window: int, with_text: bool) -> Callable:
    """What is left of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches):
            starts, ends, first = words(data, offsets)
            gone = np.zeros(len(starts), bool)
            singles, own = spans.lists(batch.column("singles")), batch.column("grams").to_numpy(zero_copy_only=False)
            if any(n > len(s) for n, s in zip(np.nan_to_num(own).tolist(), singles, strict=True)):
                gone = _gone(batch, spans.word_units(data, offsets), singles, window)
            raw, out = data.tobytes(), []
            removed = np.concatenate(([0], np.cumsum(gone)))
            for doc in range(batch.num_rows):
                a, b = int(first[doc]), int(first[doc + 1])
                n = int(removed[b] - removed[a])
                kept = raw[offsets[doc] : offsets[doc + 1]].split()
                if n:
                    kept = [w for w, g in zip(kept, gone[a:b].tolist(), strict=True) if not g]
                text = b" ".join(kept)
                out.append((b - a, n, hashlib.sha256(text).hexdigest(), text.decode() if with_text else None))
            yield record(KEPT, batch.column("doc"), *zip(*out, strict=True))

    return run


def _gone(batch: pa.RecordBatch, units: spans.Units, singles: list[np.ndarray], window: int) -> np.ndarray:
    found = spans.runs(units, window // 2, window, spans.Hashes(units.values))
    found = found.take(spans.repeated(found, singles, batch.num_rows))
    other = spans.Hashes(units.values, 1)
    whole = other.between(found.first, found.last + window).view(np.int64)
    own_runs, own_windows = spans.lists(batch.column("runs")), spans.lists(batch.column("windows"))
    starts = [np.zeros(0, np.int64)]
    edges = np.searchsorted(found.doc, np.arange(batch.num_rows + 1))
    for doc in np.unique(found.doc).tolist():
        some = slice(edges[doc], edges[doc + 1])
        open_ = ~np.isin(whole[some], own_runs[doc])
        if open_.any():
            first, last = found.first[some][open_], found.last[some][open_]
            at = np.repeat(first, last - first + 1) + _counting(last - first + 1)
            if len(own_windows[doc]):
                at = at[~np.isin(other.between(at, at + window).view(np.int64), own_windows[doc])]
            starts.append(at)
    at = np.concatenate(starts)
    return spans.covered(len(units.values), at, at, window)


def _counting(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each size, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each window of a run; each counts once per document and run."""
    schema = pa.schema([("gram", pa.int64()), ("window", pa.int64()), ("doc", pa.int64())])
    for batch in batches:
        for at in range(0, batch.num_rows, 2_000):
            part = batch.slice(at, 2_000)
            held = [np.frombuffer(w, np.int64) for w in part.column("windows").to_pylist()]
            sizes = [len(w) for w in held]
            if held:
                yield record(schema, np.repeat(part.column("gram").to_numpy(), sizes), np.concatenate(held), np.repeat(part.column("doc").to_numpy(), sizes))


def remove_repeats(docs: DataFrame, group: str = "substrings", window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256; with ``with_text`` also kept, the text."""
    texts = spans.keyed(docs)
    places = spans.gram_places(texts, spans.word_units, window // 2, window, group)
    single = places.groupBy("gram").agg(F.min("doc").alias("doc"), F.max("doc").alias("last")).filter("doc = last")
    grams = places.groupBy("doc").agg(F.count("*").alias("grams"))
    marked = settle(grams.join(spans.by_doc(single, "gram", "singles"), "doc", "left"), group, "singles")

    opened = texts.join(marked.filter("grams > coalesce(size(singles), 0)").select("doc", "singles"), "doc")
    found = opened.mapInArrow(_opened(window), "gram long, run long, doc long, windows binary")
    kinds = settle(found.groupBy("gram", "run").agg(F.min("doc").alias("doc"), F.any_value("windows").alias("windows")), group, "runs")
    several = kinds.groupBy("gram").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("gram")
    alone = kinds.select("gram", "run", "doc").join(several, "gram", "left_anti")
    windows = kinds.join(several, "gram").select("gram", "windows", "doc").mapInArrow(_exploded, "gram long, window long, doc long")
    first = windows.groupBy("gram", "window").agg(F.min("doc").alias("doc"))

    known = marked.join(spans.by_doc(alone, "run", "runs"), "doc", "left").join(spans.by_doc(first, "window", "windows"), "doc", "left")
    left = texts.join(known, "doc", "left").mapInArrow(_removed(window, with_text), KEPT_DDL)
    return left.select(spans.doc_id(), "n_words", "n_removed", "kept_sha256", *["kept"] * with_text)
