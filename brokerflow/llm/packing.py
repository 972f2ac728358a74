"""Best-fit packing of token sequences, in rounds.

Each scan task tokenises its documents and packs them best-fit among themselves. Bins that are nearly
full are final. The others are items of the next round, which has an eighth of the tasks; the last
round has one task, or as many as it takes to give none more than ``UNITS_PER_TASK`` items. A round
that has so many tasks and closes almost nothing is the last one, since its bins don't fit each other.

Null texts count as empty. An empty text is one piece that holds the end token alone. Repeated rows
are packed like any other. Only ``doc_id`` and ``text`` are read, so other columns may have any name.

The text of an added token is that token's id if ``pack`` is given it with ``added``, as the JSON file's
reader has it, and else ordinary text.
"""

from __future__ import annotations

import base64
import json
import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerflow.llm.store import settle
from brokerflow.llm.text import record

SEQUENCE = 1024
END_ID = 2
#: A bin with at most this much room left is final before the last round.
NEARLY_FULL = 4
UNITS_PER_TASK = 100_000
FAN_IN = 8
#: Distinct stretches of text whose ids a worker remembers before it starts anew.
REMEMBERED = 200_000
#: Rows that a scan task packs at once.
PIECES_AT_ONCE = 100_000

#: The same vocabulary as ``byte_bpe_50k.json``, and so the same ids, from a reader several times as fast.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: The file whose reader says what the ids are; its added tokens are not in the other one.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

ITEMS = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
     ("sequence_id", pa.int64()), ("offset", pa.int64()), ("used", pa.int64()), ("final", pa.bool_())]
)
ITEMS_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, used long, final boolean"

_encoders: dict[tuple, AddedEncoder] = {}


def added_tokens(tokenizer: str) -> dict[str, int]:
    """Text and id of the tokens that a tokenizer's JSON file adds to its vocabulary."""
    with open(tokenizer, encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    unlike = [t["content"] for t in tokens if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
    if unlike:
        raise ValueError(f"added tokens that are not taken as they stand: {unlike}")
    return {t["content"]: t["id"] for t in tokens}


class Encoder:
    """Text to ids as little-endian 32-bit numbers.

    Where no two white spaces meet, a space always begins a token, a line end is one, and a comma or full
    stop behind a letter begins one. So texts are cut there, and the ids of a word are looked up if the
    worker has met it before.
    """

    two_spaces = re.compile(r"\s\s")

    def __init__(self, vocabulary: str):
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.end = {mark: self.ids(mark) for mark in ",."}
        self.line_end = self.ids("\n")

    def ids(self, text: str) -> bytes:
        out = array("I", self.encode(text))
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def learn(self, word: str, known: dict[str, bytes], before: str) -> bytes:
        if word[-1:] in self.end and word[-2:-1].isalpha():
            stem = word[:-1]
            return (known.get(stem) or self.learn(stem, known, before)) + self.end[word[-1]]
        if len(known) > REMEMBERED:
            known.clear()
        got = known[word] = self.ids(before + word)
        return got

    def __call__(self, text: str) -> bytes:
        if self.two_spaces.search(text):
            return self.ids(text)
        first, later, learn, out = self.first, self.later, self.learn, []
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            if out:
                out.append(self.line_end)
            out.append(first.get(head) or learn(head, first, ""))
            out += [later.get(word) or learn(word, later, " ") for word in rest]
        return b"".join(out)


class AddedEncoder:
    """Ids of a text that is cut at the added tokens, leftmost first; between them it is ordinary."""

    def __init__(self, vocabulary: str, added: dict[str, int]):
        self.ordinary = Encoder(vocabulary)
        self.id = {text: np.array([id_], "<u4").tobytes() for text, id_ in added.items()}
        # of two tokens that begin at the same place, the longer one
        self.token = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None

    def __call__(self, text: str) -> bytes:
        if self.token is None:
            return self.ordinary(text)
        out, done = [], 0
        for found in self.token.finditer(text):
            out += [self.ordinary(text[done : found.start()]), self.id[found.group()]]
            done = found.end()
        return b"".join([*out, self.ordinary(text[done:])]) if out else self.ordinary(text)


def encoder(vocabulary: str, added: dict[str, int]) -> AddedEncoder:
    """The worker's own, made once."""
    key = (vocabulary, *sorted(added.items()))
    if key not in _encoders:
        _encoders[key] = AddedEncoder(vocabulary, added)
    return _encoders[key]


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each size, largest first into the fullest bin that has room; and what each bin holds."""
    bins, at, used = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set while a bin with room r is open
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen = capacity, len(used)
            used.append(0)
        bins[item], at[item] = chosen, used[chosen]
        used[chosen] += size
        if room > size:
            by_room[room - size].append(chosen)
            rooms |= 1 << (room - size)
    return bins, at, np.array(used, np.int64)


def _numbers(round_: int) -> Iterator[int]:
    """First numbers for the bins of one packing after another; different in each round and task."""
    first = round_ << 59 | TaskContext.get().partitionId() << 32
    while True:
        first += yield first


def _cut_and_pack(vocabulary: str, added: dict[str, int], capacity: int, end_id: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary, added), np.array([end_id], "<u4").tobytes()
        numbers = _numbers(0)
        first = next(numbers)
        rows: list[tuple] = []

        def packed() -> pa.RecordBatch:
            nonlocal first
            doc_id, piece, start, length, crc = zip(*rows, strict=True)
            bins, at, used = best_fit(np.array(length), capacity)
            out = record(ITEMS, doc_id, piece, start, length, crc, first + bins, at, used[bins], used[bins] >= capacity - NEARLY_FULL)
            first = numbers.send(len(used))
            rows.clear()
            return out

        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for row in range(batch.num_rows):
                doc_id = ids[row].as_py()
                tokens = encode(texts[row].as_py() or "") + end
                total, cut, piece = len(tokens) // 4, 0, 0
                while cut < total:
                    length = (total - cut) % capacity or capacity
                    rows.append((doc_id, piece, cut, length, zlib.crc32(tokens[4 * cut : 4 * (cut + length)])))
                    cut, piece = cut + length, piece + 1
                if len(rows) >= PIECES_AT_ONCE:
                    yield packed()
        if rows:
            yield packed()

    return run


def _merge(round_: int, capacity: int, last: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        items = {name: table.column(name).to_numpy() for name in ("sequence_id", "offset", "used")}
        _, one, unit = np.unique(items["sequence_id"], return_index=True, return_inverse=True)
        bins, at, used = best_fit(items["used"][one], capacity)
        bin_ = bins[unit]
        final = np.full(len(bin_), True) if last else used[bin_] >= capacity - NEARLY_FULL
        first = next(_numbers(round_))
        keep = [table.column(name).combine_chunks() for name in ITEMS.names[:5]]
        yield record(ITEMS, *keep, first + bin_, at[unit] + items["offset"], used[bin_], final)

    return run


def pack(
    docs: DataFrame, group: str = "packing", capacity: int = SEQUENCE, end_id: int = END_ID, vocabulary: str = VOCABULARY, added: dict[str, int] | None = None
) -> DataFrame:
    """Pieces of all documents with the sequence and the place of each.

    A document's ids end with ``end_id``. Only longer ones are cut, the shorter piece first. ``added``
    are the texts that are tokens of their own, with their ids.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    done = settle(source.mapInArrow(_cut_and_pack(vocabulary, added or {}, capacity, end_id), ITEMS_DDL), group, "round0")
    parts = [done.filter("final")]
    task = F.expr("shiftright(sequence_id, 32) & 134217727")
    open_, before, round_ = done.filter("not final"), None, 0
    tasks = open_.agg(F.max(task) + 1).first()[0] or 1
    while True:
        units = open_.agg(F.count_if(F.col("offset") == 0)).first()[0]
        if not units:
            break
        round_ += 1
        least = -(-units // UNITS_PER_TASK)
        stuck = before is not None and tasks <= least and units > 0.99 * before
        tasks, before = max(least, -(-tasks // FAN_IN)), units
        last = tasks == 1 or stuck or round_ == 15
        merged = open_.repartition(tasks, "sequence_id").mapInArrow(_merge(round_, capacity, last), ITEMS_DDL)
        done = settle(merged, group, f"round{round_}")
        parts.append(done.filter("final"))
        open_ = done.filter("not final")
        if last:
            break
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.drop("used", "final")
