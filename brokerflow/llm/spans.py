"""Where texts share long stretches: grams that stand for windows, and runs of windows that share a gram.

A text is a sequence of units, bytes or words. Each window of ``window`` units is represented by its
gram of ``gram`` units with the least hash, the first of them. Equal windows have equal grams at equal
places, so a window can only occur twice if its gram does. Consecutive windows with the same gram form
a run; a run's text reaches from its first window's start to its last one's end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerflow.llm.store import settle
from brokerflow.llm.text import chunks, record, words

#: Odd bases of two polynomial hashes modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_byte = np.random.default_rng(20240229).integers(0, 1 << 64, 256, np.uint64)
_powers: list[list[np.ndarray]] = [[np.ones(1, np.uint64)] * 2, [np.ones(1, np.uint64)] * 2]

#: Rows without an id count as one document with the largest id.
NO_ID = (1 << 63) - 1
PLACES = pa.schema([("gram", pa.int64()), ("doc", pa.int64()), ("n", pa.int64())])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of a base and of its inverse."""
    if len(_powers[which][0]) < size:
        base = BASES[which]
        for i, number in enumerate((base, pow(base, -1, 1 << 64))):
            grown = np.full(size + size // 4, number, np.uint64)
            grown[0] = 1
            _powers[which][i] = np.multiply.accumulate(grown)
    return _powers[which][0], _powers[which][1]


class Hashes:
    """Hashes of all stretches of a sequence of values."""

    def __init__(self, values: np.ndarray, which: int = 0):
        up, self.down = powers(which, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def all(self, length: int) -> np.ndarray:
        """Of the stretches of one length, at every start."""
        most = max(0, len(self.sums) - length)
        return mixed((self.sums[length : length + most] - self.sums[:most]) * self.down[:most])


class Units(NamedTuple):
    """Values of the units of some documents, and where each document starts (one more entry)."""

    values: np.ndarray
    offsets: np.ndarray


def byte_units(data: np.ndarray, offsets: np.ndarray) -> Units:
    return Units(_byte[data], offsets)


def word_units(data: np.ndarray, offsets: np.ndarray) -> Units:
    starts, ends, first = words(data, offsets)
    if not len(starts):
        return Units(np.zeros(0, np.uint64), first)
    return Units(Hashes(_byte[data]).between(starts, ends) + (ends - starts).astype(np.uint64), first)


class Runs(NamedTuple):
    """Runs of windows: document, first and last window's start, place and hash of the gram. In order of place."""

    doc: np.ndarray
    first: np.ndarray
    last: np.ndarray
    place: np.ndarray
    gram: np.ndarray

    def take(self, which: np.ndarray) -> Runs:
        return Runs(*(column[which] for column in self))


def runs(units: Units, gram: int, window: int, hashes: Hashes) -> Runs:
    size = len(units.values)
    if size < window:
        return Runs(*(np.zeros(0, t) for t in (np.int64,) * 4 + (np.uint64,)))
    grams = hashes.all(gram)
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width, wanted = 1, window - gram + 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < wanted:
        least = np.minimum(least[: len(least) - (wanted - width)], least[wanted - width :])
    inside = np.zeros(size + 1, np.int32)  # where a window fits into its document
    low, high = units.offsets[:-1], units.offsets[1:] - window + 1
    fits = high > low
    np.add.at(inside, low[fits], 1)
    np.add.at(inside, high[fits], -1)
    starts = np.flatnonzero(np.cumsum(inside[: len(least)]) > 0)
    place = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.diff(place, prepend=-1))
    first, last = starts[new], starts[np.append(new[1:], len(starts)) - 1] if len(new) else starts
    doc = np.searchsorted(units.offsets, first, side="right") - 1
    return Runs(doc, first, last, place[new], grams[place[new]])


def keyed(docs: DataFrame) -> DataFrame:
    """doc and text; ``doc`` is ``doc_id``, or ``NO_ID`` where that is null."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), "text")


def doc_id() -> F.Column:
    return F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id")


def distinct_pairs(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs and how often each occurs."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(value, prepend=value[:1]) != 0))
    return doc[new], value[new], np.diff(np.append(new, len(doc)))


def _places(units_of: Callable, gram: int, window: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches):
            units = units_of(data, offsets)
            found = runs(units, gram, window, Hashes(units.values))
            if len(found.doc):
                doc, value, n = distinct_pairs(found.doc, found.gram)
                yield record(PLACES, value.view(np.int64), batch.column("doc").to_numpy()[doc], n)

    return run


def gram_places(docs: DataFrame, units_of: Callable, gram: int, window: int, group: str) -> DataFrame:
    """(gram, doc, n): how often each document's windows are represented by a gram at different places."""
    return settle(docs.mapInArrow(_places(units_of, gram, window), "gram long, doc long, n long"), group, "places")


def by_doc(rows: DataFrame, column: str, name: str) -> DataFrame:
    """All values of a document in an array; at most as many as the document has units."""
    return rows.groupBy("doc").agg(F.collect_list(column).alias(name))


def lists(column: pa.Array) -> list[np.ndarray]:
    """The arrays of a list column of numbers; null is empty."""
    empty = np.zeros(0, np.int64)
    return [empty if not scalar.is_valid else scalar.values.to_numpy(zero_copy_only=False) for scalar in column]


def repeated(found: Runs, singles: list[np.ndarray], docs: int) -> np.ndarray:
    """Which runs have a gram that isn't in the list of its document."""
    out = np.zeros(len(found.doc), bool)
    edges = np.searchsorted(found.doc, np.arange(docs + 1))
    for doc in range(docs):
        a, b = edges[doc], edges[doc + 1]
        if b > a:
            out[a:b] = ~np.isin(found.gram[a:b].view(np.int64), singles[doc])
    return out


def covered(size: int, first: np.ndarray, last: np.ndarray, window: int) -> np.ndarray:
    """Which units lie in a window that starts between ``first`` and ``last`` (inclusive)."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, last + window, -1)
    return np.cumsum(edge[:-1]) > 0
