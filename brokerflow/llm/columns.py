"""Byte strings that occur twice, by a column-wise Burrows-Wheeler construction over candidate texts.

The construction adds one symbol in front of every text of a collection per round. It keeps the texts in
the order of what has been added so far, and the length of the common prefix of each with the one before
it. A round sorts the new column's symbols stably, which gives the new order, and takes each common
prefix from the least one between the two texts in the old order, plus one. Texts with a common prefix
of a whole window are equal there. A collection's symbols in a round's order are a column of its
transform.

Whole documents would need as many rounds as the longest has bytes, with a pass over everything in
each. So only candidates are inserted. A window is represented by a gram (see ``spans``), and runs of
windows whose gram occurs once are left out. Equal runs are counted first, as one text each. Those with
the same gram are a collection; they are aligned at the gram, so that equal windows start in the same
column, and a column never has to be merged into those of other rounds. The number of rounds is then
that of the bytes around a gram. The sorted shuffle files are what tasks read one collection after
another from; a task holds one batch of collections. A gram with very many texts is split at random,
and its parts' windows are counted together afterwards.

Null texts are empty. Rows with the same ``doc_id`` are taken to have the same text; each is another
place, so nothing but short texts is left of them. Rows with a null ``doc_id`` are left whole, though
what they share with others counts. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerflow.llm import spans
from brokerflow.llm.store import settle, tasks
from brokerflow.llm.text import chunks, record, runs

WINDOW = 200
GRAM = 64
#: Texts of one collection in a task; larger collections are split.
TEXTS_PER_COLLECTION = 4096
#: Texts that are inserted together, about.
TEXTS_AT_ONCE = 8192

RUNS = pa.schema([("gram", pa.int64()), ("left", pa.int32()), ("run", pa.binary()), ("doc", pa.int64()), ("first", pa.int64())])
RUNS_DDL = "gram long, left int, run binary, doc long, first long"
FOUND = pa.schema([("gram", pa.int64()), ("window", pa.int64()), ("n", pa.int32()), ("doc", pa.int64()), ("first", pa.int64()), ("count", pa.int32())])
FOUND_DDL = "gram long, window long, n int, doc long, first long, count int"
KEPT = pa.schema([("doc", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
KEPT_DDL = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def rounds(collection: np.ndarray, texts: list[bytes], left: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The order of the texts and the common prefixes after each round.

    ``collection`` numbers the collection of each text, ascending; ``left`` is where the aligned place is
    in it. Yields the column (0 at the aligned place), the order, and the length of the prefix that each
    text from there on has in common with the one before it; 0 across collections, and before a text's
    start or behind its end.
    """
    size = np.array([len(t) for t in texts])
    most_left, width = int(left.max()), int(left.max() + (size - left).max())
    table = np.full((len(texts), width), -1, np.int16)
    for row, (text, shift) in enumerate(zip(texts, (most_left - left).tolist(), strict=True)):
        table[row, shift : shift + len(text)] = np.frombuffer(text, np.uint8)
    table = np.ascontiguousarray(table.T)
    order, common = np.arange(len(texts)), np.zeros(len(texts), np.int32)
    for column in range(width - 1, -1, -1):
        symbol = table[column][order]
        key = collection[order] * 512 + symbol
        place = np.argsort(key, kind="stable")  # texts are in order but for few, which this sort profits from
        key = key[place]
        before = common
        common = before[place] + 1
        apart = np.flatnonzero(np.diff(place, prepend=-1) != 1)
        apart = apart[(apart > 0) & (key[apart] == key[apart - 1])]
        if len(apart):
            between = np.stack((place[apart - 1] + 1, place[apart] + 1), axis=1).ravel()
            common[apart] = np.minimum.reduceat(np.append(before, 0), between)[::2] + 1
        common[(np.diff(key, prepend=-1 << 40) != 0) | (symbol[place] < 0)] = 0
        order = order[place]
        yield column - most_left, order, common


def _opened(gram: int, window: int) -> Callable:
    """The text of every run whose gram occurs elsewhere too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches):
            units = spans.byte_units(data, offsets)
            found = spans.runs(units, gram, window, spans.Hashes(units.values))
            found = found.take(spans.repeated(found, spans.lists(batch.column("singles")), batch.num_rows))
            raw = data.tobytes()
            texts = [raw[a : b + window] for a, b in zip(found.first.tolist(), found.last.tolist(), strict=True)]
            docs = batch.column("doc").to_numpy()[found.doc]
            for at in range(0, len(texts), 4096):
                part = slice(at, at + 4096)
                yield record(RUNS, found.gram[part].view(np.int64), (found.place - found.first)[part], texts[part], docs[part], (found.first - offsets[found.doc])[part])

    return run


def _inserted(window: int) -> Callable:
    """Windows that occur once, as stretches of starts; of split collections, every distinct window."""

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        grams = np.array([r["gram"] for r in rows])
        part = np.array([r["part"] for r in rows])
        collection = np.cumsum((np.diff(grams, prepend=grams[0]) != 0) | (np.diff(part, prepend=part[0]) != 0))
        split = np.array([r["parts"] > 1 for r in rows])
        times = np.array([min(r["n"], 2) for r in rows])
        left, size = np.array([r["left"] for r in rows]), np.array([len(r["run"]) for r in rows])
        docs, first = [r["doc"] for r in rows], np.array([r["first"] for r in rows])
        hashes: dict[int, spans.Hashes] = {}
        out: list[tuple] = []
        alone = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for column, order, common in rounds(collection, [r["run"] for r in rows], left):
            if column > 0:
                continue
            kind = np.cumsum(common < window) - 1
            total = np.bincount(kind, weights=times[order])
            whole = (column + left >= 0) & (column + left + window <= size)
            whole = whole[order]
            once = order[whole & (total[kind] == 1) & ~split[order]]
            alone.append((once, np.full(len(once), column)))
            some = np.flatnonzero(whole & split[order])
            some = some[np.diff(kind[some], prepend=-1) != 0]
            for at in some.tolist():
                text = int(order[at])
                if text not in hashes:
                    hashes[text] = spans.Hashes(spans.byte_units(np.frombuffer(rows[text]["run"], np.uint8), np.zeros(0, np.int64)).values, 1)
                start = np.array([column + left[text]])
                digest = int(hashes[text].between(start, start + window).view(np.int64)[0])
                out.append((int(grams[text]), digest, min(2, int(total[kind[at]])), docs[text], int(first[text] + start[0]), 1))
        text, column = (np.concatenate(x) for x in zip(*alone, strict=True))
        sorted_ = np.lexsort((column, text))
        text, column = text[sorted_], column[sorted_]
        new = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(column, prepend=-1 << 40) != 1))
        counts = np.diff(np.append(new, len(text)))
        for one, at, count in zip(text[new].tolist(), column[new].tolist(), counts.tolist(), strict=True):
            out.append((int(grams[one]), None, 1, docs[one], int(first[one] + at + left[one]), count))
        return record(FOUND, *zip(*out, strict=True)) if out else record(FOUND, *[[]] * len(FOUND))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if len(held) >= TEXTS_AT_ONCE and (row["gram"], row["part"]) != (held[-1]["gram"], held[-1]["part"]):
                    yield batch_of(held)
                    held = []
                held.append(row)
        if held:
            yield batch_of(held)

    return run


def _removed(gram: int, window: int, with_text: bool) -> Callable:
    """What is left of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches):
            gone = np.zeros(len(data), bool)
            docs = batch.column("doc").to_numpy()
            singles, own = spans.lists(batch.column("singles")), np.nan_to_num(batch.column("grams").to_numpy(zero_copy_only=False))
            if any(n > len(s) and d != spans.NO_ID for n, s, d in zip(own.tolist(), singles, docs.tolist(), strict=True)):
                units = spans.byte_units(data, offsets)
                found = spans.runs(units, gram, window, spans.Hashes(units.values))
                found = found.take(spans.repeated(found, singles, batch.num_rows) & (docs[found.doc] != spans.NO_ID))
                alone = [s + (offsets[d] << 16) for d, s in enumerate(spans.lists(batch.column("alone"))) if len(s)]
                alone = np.concatenate([np.zeros(0, np.int64), *alone])
                starts = spans.covered(len(data), found.first, found.last, 1) & ~spans.covered(len(data), alone >> 16, (alone >> 16) + (alone & 0xFFFF) - 1, 1)
                at = np.flatnonzero(starts)
                gone = spans.covered(len(data), at, at, window)
            edges = np.searchsorted(runs(gone, offsets)[0], offsets)
            removed, out = np.concatenate(([0], np.cumsum(gone))), []
            for doc, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                n = int(removed[b] - removed[a])
                text = (data[a:b][~gone[a:b]] if n else data[a:b]).tobytes()
                out.append((b - a, n, int(edges[doc + 1] - edges[doc]), hashlib.sha256(text).hexdigest(), text if with_text else None))
            yield record(KEPT, batch.column("doc"), *zip(*out, strict=True))

    return run


def remove_repeats(docs: DataFrame, group: str = "columns", window: int = WINDOW, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with ``with_text`` also kept, the bytes."""
    texts = spans.keyed(docs)
    places = spans.gram_places(texts, spans.byte_units, gram, window, group)
    single = places.groupBy("gram").agg(F.sum("n").alias("n"), F.min("doc").alias("doc")).filter("n = 1")
    grams = places.groupBy("doc").agg(F.count("*").alias("grams"))
    marked = settle(grams.join(spans.by_doc(single, "gram", "singles"), "doc", "left"), group, "singles")

    opened = texts.join(marked.filter("grams > coalesce(size(singles), 0)").select("doc", "singles"), "doc")
    found = opened.mapInArrow(_opened(gram, window), RUNS_DDL)
    once = F.min(F.struct("doc", "first")).alias("at")
    kinds = found.groupBy("gram", "run").agg(F.min("left").alias("left"), F.count("*").alias("n"), once)
    kinds = settle(kinds.select("gram", "run", "left", "n", "at.doc", "at.first"), group, "runs")
    several = kinds.groupBy("gram").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    parts = F.ceil(F.col("kinds") / TEXTS_PER_COLLECTION).cast("int")
    collections = kinds.join(several, "gram").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("run"), "parts").cast("int"))
    dealt = collections.drop("kinds").repartition(tasks(docs.sparkSession), "gram", "part").sortWithinPartitions("gram", "part")
    windows = settle(dealt.mapInArrow(_inserted(window), FOUND_DDL), group, "windows")

    split = windows.filter("window is not null").groupBy("gram", "window").agg(F.sum("n").alias("n"), F.min("doc").alias("doc"), F.min("first").alias("first"))
    alone = windows.filter("window is null").select("doc", "first", "count").unionByName(split.filter("n = 1").select("doc", "first", F.lit(1).alias("count")))
    stretch = alone.select("doc", (F.shiftleft("first", 16) + F.col("count")).alias("stretch"))
    known = marked.join(spans.by_doc(stretch, "stretch", "alone"), "doc", "left")
    left = texts.join(known, "doc", "left").mapInArrow(_removed(gram, window, with_text), KEPT_DDL)
    return left.select(spans.doc_id(), "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text)
