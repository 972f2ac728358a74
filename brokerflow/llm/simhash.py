"""Near duplicates by 64-bit fingerprints of word shingles, found through Golay-code keys.

Two fingerprints link if they differ in at most two bits. A fingerprint has segments of 23, 23 and 18
bits. Two errors leave one segment without error and, whichever that is, the segment after it
(cyclically) with at most one, or else a later choice of the two does: of the three choices, one
always has an exact segment followed by one with at most one error. A key is an exact segment with a
code word near the next segment.

The binary Golay code is perfect: every 23-bit vector is within three bits of exactly one code word. A
vector at distance three has five more code words at distance four. With these as keys, two vectors
that differ in one bit always share a code word. Fingerprints that share a key are compared.

Only distinct fingerprints are compared, and a key's group yields a spanning forest of its links, not
all pairs. Components grow over these links by alternating star operations.

Null texts count as empty. A text without words has fingerprint zero and is linked like any other.
Repeated rows get equal results. Rows with a null ``doc_id`` link like any others and count in no
component's smallest id; a component of them alone has a null ``component_id``. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerflow.llm.store import settle, tasks
from brokerflow.llm.text import record, utf8
from brokerflow.operators.joins import lookup_join

SHINGLE = 3
SEED = 42
DISTANCE = 2

#: Start and width of the segments.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 (a fixed value).
GENERATOR = 0b110001110101
#: Up to so many fingerprints of a key's group are compared pairwise in blocks; beyond, by flipping bits.
PAIRWISE = 4096

FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("bits", pa.int64())])
KEYS = pa.schema([("key", pa.int64()), ("bits", pa.int64())])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])

_tables: dict[str, np.ndarray] = {}


def shingle_hashes(text: bytes, length: int = SHINGLE) -> np.ndarray:
    """The hash of every ``length`` consecutive words, in order; of all words if they are fewer."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= length:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum([len(w) for w in words]) + np.arange(len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))
    hash_, pairs = xxhash.xxh64_intdigest, zip(starts[: -length + 1].tolist(), ends[length - 1 :].tolist(), strict=True)
    return np.array([hash_(joined[a:b], SEED) for a, b in pairs], np.uint64)


def fingerprint_of(text: bytes) -> int:
    hashes = shingle_hashes(text)
    return majority(hashes) if len(hashes) else 0


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes; eight bits are counted at once, in blocks that can't overflow a byte."""
    counts = np.zeros(64, np.int64)
    blocks = np.arange(0, len(hashes), 255)
    for bit in range(8):
        sums = np.add.reduceat(hashes >> np.uint64(bit) & np.uint64(0x0101010101010101), blocks)
        counts[bit::8] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > len(hashes)).tolist())


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        bits = [fingerprint_of(data[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield record(FINGERPRINTS, batch.column("doc_id"), np.array(bits, np.uint64).view(np.int64))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and the fingerprint as a signed number, one row per row of ``docs``."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_fingerprints, "doc_id long, bits long")


def _syndromes() -> tuple[np.ndarray, np.ndarray]:
    """For each 11-bit syndrome, the error of at most three bits; for each syndrome, the syndrome of each bit is by its table."""
    if "errors" not in _tables:
        one = np.zeros(23, np.int64)
        for bit in range(23):
            rest = 1 << bit
            for high in range(22, 10, -1):
                if rest >> high & 1:
                    rest ^= GENERATOR << (high - 11)
            one[bit] = rest
        errors = np.full(2048, -1, np.int64)
        errors[0] = 0
        for a in range(23):
            errors[one[a]] = 1 << a
            for b in range(a):
                errors[one[a] ^ one[b]] = 1 << a | 1 << b
                for c in range(b):
                    errors[one[a] ^ one[b] ^ one[c]] = 1 << a | 1 << b | 1 << c
        _tables["errors"], _tables["one"] = errors, one
        low = np.arange(1 << 12)
        _tables["low"], _tables["high"] = _rests(low, one[:12]), _rests(np.arange(1 << 11), one[12:])
        # errors of four bits with the same syndrome as an error of three: the code words at distance four
        quads: dict[int, list[int]] = {}
        for a in range(23):
            for b in range(a):
                for c in range(b):
                    for d in range(c):
                        quads.setdefault(int(one[a] ^ one[b] ^ one[c] ^ one[d]), []).append(1 << a | 1 << b | 1 << c | 1 << d)
        four = np.full((2048, 5), -1, np.int64)
        for syndrome, found in quads.items():
            if bin(int(errors[syndrome])).count("1") == 3:
                four[syndrome] = found
        _tables["four"] = four
    return _tables["errors"], _tables["four"]


def _rests(values: np.ndarray, one: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values), np.int64)
    for bit, rest in enumerate(one.tolist()):
        out ^= (values >> bit & 1) * rest
    return out


def golay_keys(vectors: np.ndarray) -> np.ndarray:
    """Six columns per 23-bit vector: the index (upper 12 bits) of the nearest code word and of those at distance four, or -1.

    A code word is named by its upper 12 bits, from which its lower 11 follow.
    """
    errors, four = _syndromes()
    syndrome = _tables["low"][vectors & 0xFFF] ^ _tables["high"][vectors >> 12]
    out = np.full((len(vectors), 6), -1, np.int64)
    out[:, 0] = (vectors ^ errors[syndrome]) >> 11
    more = four[syndrome]
    out[:, 1:] = np.where(more < 0, -1, (vectors[:, None] ^ more) >> 11)
    return out


def keys_of(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys, and for each the position of its fingerprint."""
    bits = bits.view(np.uint64)
    part = [((bits >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    keys, rows = [], []
    for choice in range(3):
        near = golay_keys(part[(choice + 1) % 3])
        row, column = np.nonzero(near >= 0)
        keys.append(part[choice][row] << 14 | near[row, column] << 2 | choice)
        rows.append(row)
    return np.concatenate(keys), np.concatenate(rows)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = batch.column("bits").to_numpy(zero_copy_only=False)
        for at in range(0, len(bits), 20_000):
            part = bits[at : at + 20_000]
            key, row = keys_of(part)
            yield record(KEYS, key, part[row])


class Forest:
    """Union-find over the positions of a group."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def group_links(bits: np.ndarray) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints (sorted, unsigned).

    Small groups are compared pairwise. In large ones each fingerprint is looked up with every one and
    two bits flipped that vary within the group, which is linear in the group and finds the same links.
    """
    forest = Forest(len(bits))
    if len(bits) <= PAIRWISE:
        for i in range(len(bits) - 1):
            for j in (np.flatnonzero(np.bitwise_count(bits[i] ^ bits[i + 1 :]) <= DISTANCE) + i + 1).tolist():
                if forest.join(i, j):
                    yield i, j
        return
    varying = np.bitwise_or.reduce(bits ^ bits[0])
    flips = [np.uint64(1 << b) for b in range(64) if int(varying) >> b & 1]
    for one in range(len(flips)):
        for other in range(one, len(flips)):
            flipped = bits ^ (flips[one] if one == other else flips[one] | flips[other])
            at = np.minimum(np.searchsorted(bits, flipped), len(bits) - 1)
            for i in np.flatnonzero(bits[at] == flipped).tolist():
                if i < at[i] and forest.join(i, int(at[i])):
                    yield i, int(at[i])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each key's group; rows come sorted by key and fingerprint."""
    rest_keys, rest = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def found(keys: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
        links, edges = [], np.flatnonzero(np.diff(keys)) + 1
        starts, ends = np.concatenate(([0], edges)), np.concatenate((edges, [len(keys)]))
        for many in np.flatnonzero(ends - starts > 1).tolist():
            group = np.unique(bits[starts[many] : ends[many]])
            links += [(group[i], group[j]) for i, j in group_links(group)]
        a, b = np.array(links, np.uint64).reshape(-1, 2).view(np.int64).T
        return record(LINKS, a.copy(), b.copy())

    for batch in batches:
        keys = np.concatenate((rest_keys, batch.column("key").to_numpy()))
        bits = np.concatenate((rest, batch.column("bits").to_numpy().view(np.uint64)))
        if not len(keys):
            continue
        whole = int(np.searchsorted(keys, keys[-1]))  # the last key may go on in the next batch
        if whole:
            yield found(keys[:whole], bits[:whole])
        rest_keys, rest = keys[whole:], bits[whole:]
    if len(rest_keys):
        yield found(rest_keys, rest)


def links(distinct: DataFrame) -> DataFrame:
    """Pairs of linked fingerprints whose components are those of all links."""
    keyed = distinct.select("bits").mapInArrow(_keys, "key long, bits long")
    dealt = keyed.repartition(tasks(distinct.sparkSession), "key").sortWithinPartitions("key")
    return dealt.mapInArrow(_links, "a long, b long").distinct()


def components(edges: DataFrame, group: str) -> DataFrame:
    """(node, root) of the nodes of ``edges`` (u, v), root being the smallest node that can be reached, itself no row.

    Every round hangs each node's larger neighbours below the smallest one, and then the smaller ones too,
    until nothing changes. Each keeps at most one row per edge.
    """
    pairs = settle(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct(), group, "pairs")
    seen = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e"))
        pairs = settle(small.select("e.u", "e.v").filter("u != v").distinct(), group, "pairs")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.count_distinct("u")).first()
        if now[0] == now[2] and now == seen:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now


def classes(docs: DataFrame, group: str = "simhash") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint in hexadecimal, component_id.

    Components are those of the fingerprints, so one that only rows without an id have links others all the same.
    """
    marked = settle(fingerprints(docs), group, "fingerprints")
    distinct = settle(marked.groupBy("bits").agg(F.min("doc_id").alias("low_id")), group, "distinct")
    roots = components(links(distinct).select(F.col("a").alias("u"), F.col("b").alias("v")), group)
    rooted = distinct.join(roots, distinct.bits == roots.node, "left").select("bits", "low_id", F.coalesce("root", "bits").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low_id").alias("component_id"))
    named = lookup_join(rooted.select("bits", "root"), lowest, ["root"], ["bits"], name="components")
    found = marked.join(named.select("bits", "component_id"), "bits")
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
