"""Fill-in-middle: a text cut at two places is put in the order that trains a model to write the middle.

Cuts are drawn in units: code points, or the pieces of ``[A-Za-z]+|[^A-Za-z]``. Texts stay UTF-8 bytes and
are never decoded. An index of exceptions holds the multibyte characters alone, with the bytes that they take
beyond the first; a place in code points becomes one in bytes, or the other way round, by a search in it.
A stretch without exceptions costs nothing but the sum.

The draws follow from ``doc_id`` alone, so a repeated row gets the same cuts and a repeated task the same
output. A null ``doc_id`` has no draws and its text stays plain. Null texts are empty, and empty texts stay
plain; so do texts that hold a mark already, as they could not be taken apart again. Texts of any length are
cut whole. In bytes that are no UTF-8, each byte that goes on no character is one. An empty table gives no rows. Of the table only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerflow.llm.text import chunks

CUTS = pa.schema(
    [
        ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
        ("prefix_bytes", pa.int64()), ("middle_bytes", pa.int64()), ("output", pa.string()),
    ]
)
CUTS_DDL = "doc_id long, n long, form string, prefix_chars long, middle_chars long, prefix_bytes long, middle_bytes long, output string"

LETTER = np.zeros(256, bool)
LETTER[ord("A") : ord("Z") + 1] = LETTER[ord("a") : ord("z") + 1] = True


class Marks(NamedTuple):
    """What stands before each part. No mark's end may be the beginning of one, so that a text can't make up a mark with the mark next to it."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


class Shares(NamedTuple):
    """Of a hundred texts, how many are cut; and of a hundred cut ones, how many have the suffix first."""

    cut: int = 90
    suffix_first: int = 20


class Exceptions:
    """The multibyte characters of some texts in a row: where they are, and their bytes beyond the first.

    Places count from the start of the first text, in bytes (``at``) or in code points (``char_at``).
    """

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead, excess, whole = data[self.at], 0, True
        for k, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
            after = data[np.minimum(self.at + k, len(data) - 1)]
            whole = whole & (lead >= least) & ((after & 0xC0) == 0x80) & (self.at + k < len(data))
            excess = excess + whole
        self.excess = np.concatenate(([0], np.cumsum(excess)))
        self.char_at = self.at - self.excess[:-1]

    def chars(self, places: np.ndarray) -> np.ndarray:
        """Code points before the given bytes, which begin characters."""
        return places - self.excess[np.searchsorted(self.at, places)]

    def bytes(self, places: np.ndarray) -> np.ndarray:
        """Bytes before the given code points."""
        return places + self.excess[np.searchsorted(self.char_at, places)]


def _pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bytes at which pieces start: each run of letters, and each other character."""
    letter = LETTER[data]
    goes_on = (data & 0xC0) == 0x80
    goes_on[1:] |= letter[1:] & letter[:-1]
    starts = offsets[:-1][np.diff(offsets) > 0]
    goes_on[starts] = False
    return np.flatnonzero(~goes_on)


def cut(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, second: np.ndarray, unit: str) -> tuple[np.ndarray, ...]:
    """Units of each text, and the two cuts of each (the smaller first) in code points and in bytes of the text.

    The cuts are after ``first`` and ``second`` units modulo one more than the text has.
    """
    index = Exceptions(data)
    starts, ends = offsets[:-1], offsets[1:]
    char_start = index.chars(starts)
    if unit == "pieces":
        pieces = np.append(_pieces(data, offsets), len(data))
        before = np.searchsorted(pieces[:-1], offsets)
        n = np.diff(before)
    else:
        n = index.chars(ends) - char_start
    out = [n]
    for place in (np.minimum(first % (n + 1), second % (n + 1)), np.maximum(first % (n + 1), second % (n + 1))):
        if unit == "pieces":
            at = np.where(place == n, ends, pieces[before[:-1] + place])
        else:
            at = index.bytes(char_start + place)
        out += [index.chars(at) - char_start, at - starts]
    return tuple(out)


def _arrange(unit: str, marks: Marks) -> Callable:
    prefix_mark, suffix_mark, middle_mark = (m.encode() for m in marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches):
            first, second = (pc.fill_null(batch.column(c), 0).to_numpy() for c in ("first", "second"))
            n, low_chars, low, high_chars, high = cut(data, offsets, first, second, unit)
            form, out = batch.column("form").to_pylist(), []
            for i, (start, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                text = data[start:end].tobytes()
                a, b = int(low[i]), int(high[i])
                if form[i] == "psm":
                    text = b"".join((prefix_mark, text[:a], suffix_mark, text[b:], middle_mark, text[a:b]))
                elif form[i] == "spm":
                    text = b"".join((suffix_mark, text[b:], prefix_mark, text[:a], middle_mark, text[a:b]))
                out.append(text)
            plain = np.array([f == "plain" for f in form], bool)
            spans = [pa.array(x, pa.int64(), mask=plain) for x in (low_chars, high_chars - low_chars, low, high - low)]
            output = pa.array(out, pa.binary()).view(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), *spans, output], schema=CUTS)

    return run


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four whole numbers below 2 ** 32 from the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def arrange(docs: DataFrame, unit: str = "pieces", seed: int = 1, shares: Shares = Shares(), marks: Marks = Marks()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n, form, the prefix's and middle's code points and bytes, and the output.

    ``form`` is ``plain`` (output is the text; the lengths are null), ``psm`` or ``spm``, by the parts' order.
    """
    if unit not in ("pieces", "chars"):
        raise ValueError(f"unknown unit {unit!r}")
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))
    first, second, third, fourth = draws(doc_id, seed)
    marked = text.contains(marks.prefix) | text.contains(marks.suffix) | text.contains(marks.middle)
    plain = doc_id.isNull() | (text == "") | marked | (third % 100 >= shares.cut)
    form = F.when(plain, "plain").when(fourth % 100 < shares.suffix_first, "spm").otherwise("psm")
    drawn = docs.select(doc_id.alias("doc_id"), text.alias("text"), first.alias("first"), second.alias("second"), form.alias("form"))
    return drawn.mapInArrow(_arrange(unit, marks), CUTS_DDL)


def restored(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text that an output was made from, found at its marks. Binary, as the parts are cut in bytes."""

    def part(after: str, before: str | None) -> Column:
        rest = F.substring_index(output, after, -1)
        return F.substring_index(rest, before, 1) if before else rest

    prefix_first = F.concat(part(marks.prefix, marks.suffix), part(marks.middle, None), part(marks.suffix, marks.middle))
    suffix_first = F.concat(part(marks.prefix, marks.middle), part(marks.middle, None), part(marks.suffix, marks.prefix))
    return F.when(form == "psm", prefix_first).when(form == "spm", suffix_first).otherwise(output).cast("binary")
