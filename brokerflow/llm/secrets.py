"""Secrets in texts: fixed patterns, and a character convolution over what else may be one.

The patterns' findings stay as they are. Besides them, every run of at least ``SHORTEST`` token characters
is a candidate, letters alone too. A convolution goes over the whole candidate and the bytes around it, the
largest output of each filter counts, and their weighted sum says how likely the candidate is a secret. From a
threshold on, candidates are added as kind ``model``.

Filters are sums over the bytes they cover, so their outputs are looked up in tables of byte pairs and added,
once for every byte as surroundings and once for those of candidates as a part of theirs; a candidate takes the largest
ones of its stretch, and only those filters that lie across its ends are added up for it alone.

The network learns from the candidates of all texts: label 1 if a pattern found it, else 0. A quarter of the texts,
by a hash of doc_id (of the text where that is null), is kept out. Of the others a first network learns all candidates
that a pattern found or that are long and hold a digit, and for a start one other of every fourth text; each with and
without what surrounds it, long ones from their first and last characters. It then judges every candidate of these
texts, and those without a finding that it takes for a secret with a probability of ``HARD`` or more are learned as
well; the loss of the rest has next to no slope. A task learns from about ``PART`` examples, and after every turn the
parameters of all tasks are averaged.

Then every candidate of the texts kept out is judged and counted by label and output, in steps of ``STEP``. On these
counts the output is calibrated (Platt), and the threshold is the largest step with which ``RECALL`` of the patterns'
findings are found, those without a candidate being missed.

Null texts are empty and have no findings. Repeated rows get equal results. Texts without labelled
secrets, or without other candidates, fit no network, and nothing is added. Only ``doc_id`` and ``text``
are read. Positions are code points.
"""

from __future__ import annotations

import hashlib
import io
import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerflow.llm.fim import Exceptions
from brokerflow.llm.quality import Adam
from brokerflow.llm.store import settle
from brokerflow.llm.text import chunks, record, runs

RECALL = 0.98
SHORTEST = 6
#: From which length on a digit makes a candidate worth learning, whatever a network says of it; and from which probability on others are.
LONG, HARD = 12, 0.1
#: Examples that a task learns from, about.
PART = 40_000
#: Steps in which outputs are counted, and the largest one.
STEP, LARGEST = 1 / 64, 512.0
#: Bytes before and behind a candidate, and bytes of it that are learned from.
AROUND, LEARNED = 24, 80
WIDTH = 2 * AROUND + LEARNED
EMBEDDED, KERNEL, FILTERS = 8, 5, 24
#: Examples that a task learns from in all turns, about.
EXAMPLES, BATCH, RATE, DECAY = 60_000, 64, 4e-3, 1e-4
#: Bytes that are worked on at once: enough that few calls are made, few enough that the outputs of their filters stay near the processor.
BLOCK = 1 << 14

#: Byte classes: printable ASCII 1 to 95, other bytes 96, line ends 97, nothing 0; within a candidate larger by ``INSIDE``.
INSIDE, UNUSED = 98, 196
CODE = np.full(256, 96, np.uint8)
CODE[32:127] = np.arange(1, 96)
CODE[[10, 13]] = 97
TOKEN = np.zeros(256, bool)
TOKEN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
DIGIT = np.zeros(256, bool)
DIGIT[ord("0") : ord("9") + 1] = True

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(
    r"""(?:[pP][aA][sS][sS][wW](?:[oO][rR])?[dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
LABELLED = pa.schema([("label", pa.int32()), ("codes", pa.binary())])
COUNTED = pa.schema([("label", pa.int32()), ("step", pa.int64()), ("n", pa.int64())])
FOUND = pa.schema(
    [("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("n_model", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())]
)
FOUND_DDL = "doc_id long, n_assign long, n_access long, n_hex long, n_model long, base_sha256 string, spans string"


def base(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' findings, in order."""
    low = text.lower()  # most texts have none of the words, which is seen sooner than by the expression
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(1) >= 6] if any(w in low for w in KEYWORDS) else []
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class Candidates:
    """The candidates of some texts in a row, in order: runs of token characters, as long as can be.

    ``codes`` are the texts' byte classes with nothing around each text, ``starts`` and ``ends`` places in them.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        first, last = runs(TOKEN[data], offsets)
        kept = last - first >= SHORTEST
        first, last = first[kept], last[kept]
        self.doc = np.searchsorted(offsets, first, side="right") - 1
        pad = AROUND + KERNEL
        self.codes = np.zeros(len(data) + pad * (len(offsets) + 1), np.uint8)
        self.codes[np.arange(len(data)) + pad * (1 + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)))] = CODE[data]
        self.starts, self.ends = first + pad * (1 + self.doc), last + pad * (1 + self.doc)
        digits = np.concatenate(([0], np.cumsum(DIGIT[data])))
        self.digit = digits[last] > digits[first]
        index = Exceptions(data)
        self.text_at = index.chars(offsets)
        self.first, self.last = index.chars(first), index.chars(last)  # code points from the first text on

    def __len__(self) -> int:
        return len(self.starts)

    def met(self, found: list[list[tuple[int, int, int]]]) -> np.ndarray:
        """Which candidates share a character with a finding of their text."""
        spans = [(int(self.text_at[row]) + start, int(self.text_at[row]) + end) for row, own in enumerate(found) for start, _, end in own]
        if not spans:
            return np.zeros(len(self), bool)
        start, end = np.array(sorted(spans)).T
        reach = np.concatenate(([-1], np.maximum.accumulate(end)))
        return reach[np.searchsorted(start, self.last)] > self.first

    def missing(self, found: list[list[tuple[int, int, int]]]) -> list[int]:
        """The texts of findings that share no character with a candidate, once for each."""
        out = []
        for row, own in enumerate(found):
            for start, _, end in own:
                at = int(np.searchsorted(self.last, self.text_at[row] + start, side="right"))
                if at == len(self) or self.first[at] >= self.text_at[row] + end:
                    out.append(row)
        return out

    def examples(self, chosen: np.ndarray) -> np.ndarray:
        """``WIDTH`` numbers each: the candidate, or its first and last bytes, between its surroundings; ``UNUSED`` behind."""
        start, end = self.starts[chosen][:, None], self.ends[chosen][:, None]
        size = np.minimum(end - start, LEARNED)
        at = np.arange(WIDTH)[None, :]
        place = start - AROUND + at + np.where(at >= AROUND + LEARNED // 2, np.maximum(end - start - LEARNED, 0), 0)
        used = at < 2 * AROUND + size
        code = self.codes[np.where(used, place, 0)] + np.where((place >= start) & (place < end), INSIDE, 0)
        return np.where(used, code, UNUSED).astype(np.uint8)


def without_surroundings(x: np.ndarray) -> np.ndarray:
    return np.where(x >= INSIDE, x, 0)


def range_max(values: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The largest rows of stretches: of two halves that overlap, each as long as a power of two."""
    level = np.frexp(stop - begin)[1] - 1
    out, length = np.empty((len(begin), values.shape[1]), values.dtype), 1
    for k in range(int(level.max()) + 1):
        own = np.flatnonzero(level == k)
        if len(own):
            out[own] = np.maximum(values.take(begin[own], axis=0), values.take(stop[own] - length, axis=0))
        values = np.maximum(values[:-length], values[length:])
        length *= 2
    return out


def window_max(values: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """The largest rows of stretches of the same size: of two halves that overlap, each as long as a power of two."""
    length = 1
    while 2 * length <= size:
        values = np.maximum(values[:-length], values[length:])
        length *= 2
    out = values.take(begin, axis=0)
    return np.maximum(out, values.take(begin + size - length, axis=0), out=out)


class Network:
    """Embedding, one convolution, the largest output of each filter, and a weighted sum of them."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays

    @classmethod
    def fresh(cls) -> Network:
        random = np.random.default_rng(5)
        arrays = {
            "E": random.normal(0, 0.5, (UNUSED + 1, EMBEDDED)),
            "K": random.normal(0, (KERNEL * EMBEDDED) ** -0.5, (KERNEL * EMBEDDED, FILTERS)),
            "b": np.zeros(FILTERS),
            "w": random.normal(0, FILTERS**-0.5, FILTERS),
            "bias": np.zeros(1),
            "platt": np.array([1.0, 0.0]),
            "threshold": np.array([0.5]),
        }
        return cls({n: a.astype(np.float32) for n, a in arrays.items()})

    def forward(self, x: np.ndarray) -> dict[str, np.ndarray]:
        p = self.arrays
        embedded = p["E"][x].reshape(len(x), WIDTH * EMBEDDED)
        patches = np.lib.stride_tricks.sliding_window_view(embedded, KERNEL * EMBEDDED, axis=1)[:, ::EMBEDDED]
        convolved = patches @ p["K"] + p["b"]
        convolved[x[:, KERNEL - 1 :] == UNUSED] = -np.inf
        most = convolved.argmax(axis=1)
        pooled = np.maximum(np.take_along_axis(convolved, most[:, None], axis=1)[:, 0], 0)
        return {"patches": patches, "most": most, "pooled": pooled, "logit": pooled @ p["w"] + p["bias"]}

    def backward(self, x: np.ndarray, f: dict[str, np.ndarray], label: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.arrays, len(x)
        d_logit = ((1 / (1 + np.exp(-f["logit"])) - label) / n).astype(np.float32)
        d_pooled = np.where(f["pooled"] > 0, d_logit[:, None] * p["w"], 0)
        chosen = f["patches"][np.arange(n)[:, None], f["most"]]  # examples x filters x patch
        d_embedded = np.zeros_like(p["E"])
        d_patch = (d_pooled[:, :, None] * p["K"].T).reshape(n, FILTERS, KERNEL, EMBEDDED)
        at = x[np.arange(n)[:, None, None], f["most"][:, :, None] + np.arange(KERNEL)]
        np.add.at(d_embedded, at.ravel(), d_patch.reshape(-1, EMBEDDED))
        return {
            "E": d_embedded, "K": np.einsum("nf,nfk->kf", d_pooled, chosen), "b": d_pooled.sum(axis=0),
            "w": f["pooled"].T @ d_logit, "bias": d_logit.sum(keepdims=True),
        }

    def tables(self) -> None:
        """What a filter adds for a byte class at each of its places, and for a pair of classes at each two places in a row."""
        p = self.arrays
        self.one = np.stack([p["E"] @ p["K"][k * EMBEDDED : (k + 1) * EMBEDDED] for k in range(KERNEL)]).astype(np.float32)
        self.two = {}
        for shift in (0, INSIDE):
            own = self.one[:, shift : shift + INSIDE]
            for k in range(KERNEL - 1):
                self.two[shift, k] = np.ascontiguousarray((own[k][:, None] + own[k + 1][None]).reshape(-1, FILTERS))

    def outputs(self, c: np.ndarray, pair: np.ndarray, shift: int) -> np.ndarray:
        """The filters at every place where they lie within the classes ``c``, all inside a candidate or all outside; ``pair`` numbers each two in a row."""
        n = len(c) - KERNEL + 1
        out = self.two[shift, 0].take(pair[:n], axis=0)
        out += self.two[shift, 2].take(pair[2 : 2 + n], axis=0)
        out += self.one[4].take(c[4 : 4 + n] + shift, axis=0)
        return out

    def within(self, c: np.ndarray, pair: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The largest of the filters that lie within candidates, whose places there are ``begin`` to ``stop``; only these are looked up."""
        size = stop - begin
        first = np.cumsum(size) - size
        at = np.repeat(begin - first, size) + np.arange(int(size.sum()))
        own = self.two[INSIDE, 0].take(pair[at], axis=0)
        own += self.two[INSIDE, 2].take(pair[at + 2], axis=0)
        own += self.one[4].take(c[at + 4] + INSIDE, axis=0)
        return range_max(own, first, first + size)

    def across(self, c: np.ndarray, pair: np.ndarray, place: np.ndarray, into: bool) -> np.ndarray:
        """The largest of the filters that lie across the start (``into``) or the end of candidates."""
        first, then, most = (0, INSIDE, None) if into else (INSIDE, 0, None)
        for before in range(1, KERNEL):  # so many of a filter's bytes lie before the place
            at, total = place - before, None
            for low, high, shift in ((0, before, first), (before, KERNEL, then)):
                for k in range(low, high, 2):
                    added = self.two[shift, k].take(pair[at + k], axis=0) if k + 1 < high else self.one[k].take(c[at + k] + shift, axis=0)
                    total = added if total is None else np.add(total, added, out=total)
            most = total if most is None else np.maximum(most, total, out=most)
        return most

    def logits(self, texts: Candidates) -> np.ndarray:
        """Of every candidate over its whole length."""
        self.tables()
        found, first = np.zeros(len(texts)), 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(texts.ends, texts.starts[first] + BLOCK)))
            low, start, end = texts.starts[first] - AROUND, texts.starts[first:last], texts.ends[first:last]
            if end[-1] - low > 2 * BLOCK + AROUND:  # one long candidate
                most = self._long(texts.codes, int(start[0]), int(end[0]))[None]
            else:
                c = texts.codes[low : end[-1] + AROUND + KERNEL].astype(np.intp)
                pair, a, b, room = c[:-1] * INSIDE + c[1:], start - low, end - low, AROUND - KERNEL + 1
                outside = self.outputs(c, pair, 0)
                most = np.maximum(self.across(c, pair, a, True), self.across(c, pair, b, False))
                around = np.concatenate((a - AROUND, b))
                np.maximum(most, self.within(c, pair, a, b - KERNEL + 1), out=most)
                np.maximum.reduce([most, *window_max(outside, around, room).reshape(2, *most.shape)], out=most)
            p = self.arrays
            found[first:last] = np.maximum(most + p["b"], 0) @ p["w"] + p["bias"][0]
            first = last
        return found

    def _long(self, codes: np.ndarray, start: int, end: int) -> np.ndarray:
        """The filters' largest outputs for one candidate, a block of it after another."""

        def part(low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
            c = codes[low:high].astype(np.intp)
            return c, c[:-1] * INSIDE + c[1:]

        ends = [self.across(*part(at - KERNEL, at + KERNEL), np.array([KERNEL]), into)[0] for at, into in ((start, True), (end, False))]
        around = [self.outputs(*part(at, at + AROUND), 0).max(axis=0) for at in (start - AROUND, end)]
        inside = [self.outputs(*part(at, min(at + BLOCK + KERNEL - 1, end)), INSIDE).max(axis=0) for at in range(start, end - KERNEL + 1, BLOCK)]
        return np.maximum.reduce([*ends, *around, *inside])

    def likely(self, logit: np.ndarray) -> np.ndarray:
        slope, shift = self.arrays["platt"]
        return 1 / (1 + np.exp(-np.clip(slope * logit + shift, -500, 500)))

    def bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.arrays)
        return out.getvalue()

    @classmethod
    def read(cls, stored: bytes) -> Network:
        with np.load(io.BytesIO(stored)) as arrays:
            return cls({name: arrays[name] for name in arrays.files})


def calibrate(logit: np.ndarray, label: np.ndarray, n: np.ndarray | None = None) -> np.ndarray:
    """Slope and shift with the largest likelihood, by Newton's method; targets are drawn in a little, as Platt does. ``n`` says how often each counts."""
    n = np.ones(len(label)) if n is None else n
    positive = n[label > 0].sum()
    target = np.where(label > 0, (positive + 1) / (positive + 2), 1 / (n.sum() - positive + 2))
    x, at = np.stack((logit, np.ones_like(logit)), axis=1).astype(float), np.array([0.1, 0.0])

    def loss(at: np.ndarray) -> float:
        z = x @ at
        return float((n * (np.logaddexp(0, z) - target * z)).sum()) + 5e-4 * float(at @ at)

    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ at)))
        slope = x.T @ (n * (p - target)) + 1e-3 * at
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        while loss(at - step) > loss(at) and np.abs(step).max() > 1e-9:
            step /= 2
        at = at - step
    return at


def learn(network: Network, x: np.ndarray, label: np.ndarray, turns: int, seed: int = 3) -> None:
    """Some turns over the examples, in an order drawn anew for each."""
    random, label = np.random.default_rng(seed), label.astype(np.float32)
    steps = Adam(network.arrays, ["E", "K", "b", "w", "bias"], RATE, DECAY)
    for _ in range(turns):
        order = random.permutation(len(x))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            steps.step(network.backward(x[some], network.forward(x[some]), label[some]))


def turns_of(n: int) -> int:
    return min(12, max(2, EXAMPLES // max(1, n)))


def judge(network: Network, logit: np.ndarray, label: np.ndarray, n: np.ndarray, missed: int = 0, recall: float = RECALL) -> None:
    """Calibration and threshold from outputs that occur ``n`` times each. ``missed`` secrets have no candidate."""
    network.arrays["platt"] = calibrate(logit, label, n).astype(np.float32)
    own = label > 0
    likely, n = network.likely(logit[own]), n[own]
    order = np.argsort(likely, kind="stable")
    lost = max(0, int((1 - recall) * (int(n.sum()) + missed)) - missed)
    at = int(np.searchsorted(np.cumsum(n[order]), lost, side="right"))
    network.arrays["threshold"] = likely[order[at]][None]


def train(x: np.ndarray, label: np.ndarray, held_out: np.ndarray, missed: int = 0, recall: float = RECALL) -> Network | None:
    """From examples at hand. None if either part lacks a label. ``missed`` secrets that are kept out have no candidate."""
    if len({*label[held_out].tolist()}) < 2 or len({*label[~held_out].tolist()}) < 2:
        return None
    own, network = x[~held_out], Network.fresh()
    own = np.concatenate((own, without_surroundings(own)))
    learn(network, own, np.tile(label[~held_out], 2), turns_of(len(own)))
    logit = np.concatenate([network.forward(x[held_out][at : at + 512])["logit"] for at in range(0, int(held_out.sum()), 512)])
    judge(network, logit, label[held_out], np.ones(len(logit), np.int64), missed, recall)
    return network


def _drawn(texts: Candidates, label: np.ndarray, hashes: list[int]) -> np.ndarray:
    """The candidates that the first network learns from."""
    worth = label | (texts.digit & (texts.ends - texts.starts >= LONG))
    others, chosen = np.flatnonzero(~worth), [np.flatnonzero(worth)]
    edges = np.searchsorted(texts.doc[others], np.arange(len(hashes) + 1))
    for row, h in enumerate(hashes):
        if h % 4 == 0 and edges[row + 1] > edges[row]:
            chosen.append(others[edges[row] + (h >> 2) % (edges[row + 1] - edges[row])][None])
    return np.concatenate(chosen)


def _text_hash(text: str) -> int:
    return zlib.crc32(text.encode(errors="replace"))


def _held_out(doc_id: int | None, text: str = "") -> bool:
    return zlib.crc32(f"fit {f'text {_text_hash(text)}' if doc_id is None else doc_id}".encode()) % 4 == 0


def _part(batches: Iterator[pa.RecordBatch], held_out: bool) -> Iterator[tuple[list[str], Candidates, list[list[tuple[int, int, int]]]]]:
    """The texts of one part, their candidates and the patterns' findings."""
    for batch in batches:
        ids, held = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
        own = pa.array([_held_out(i, t) is held_out for i, t in zip(ids, held, strict=True)], pa.bool_())
        for some, data, offsets in chunks(iter([batch.filter(own)])):
            held = [t or "" for t in some.column("text").to_pylist()]
            yield held, Candidates(data, offsets), [base(t) for t in held]


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, codes): what the first network learns from, with its surroundings and without."""
    for held, texts, found in _part(batches, False):
        label = texts.met(found)
        chosen = _drawn(texts, label, [_text_hash(t) for t in held])
        x = texts.examples(chosen)
        yield record(LABELLED, np.tile(label[chosen].astype(int), 2), [e.tobytes() for e in (*x, *without_surroundings(x))])


def _hard(stored: bytes) -> Callable:
    """(label, codes): candidates without a finding that the network does not tell from secrets, for certain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network.read(stored)
        for _, texts, found in _part(batches, False):
            chosen = np.flatnonzero((network.logits(texts) >= math.log(HARD / (1 - HARD))) & ~texts.met(found))
            yield record(LABELLED, np.zeros(len(chosen), int), [e.tobytes() for e in texts.examples(chosen)])

    return run


def _counted(stored: bytes) -> Callable:
    """(label, step, n) of all candidates that are kept out; findings without a candidate have no step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network.read(stored)
        for _, texts, found in _part(batches, True):
            step = np.floor(np.clip(network.logits(texts), -LARGEST, LARGEST) / STEP).astype(np.int64)
            pairs, n = np.unique(np.stack((texts.met(found).astype(np.int64), step)), axis=1, return_counts=True)
            missed = len(texts.missing(found))
            yield record(COUNTED, [*pairs[0], 1], [*pairs[1], None], [*n, missed])

    return run


def _learn(stored: bytes, turns: int, seed: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).sort_by([("codes", "ascending"), ("label", "ascending")])
        network, x = Network.read(stored), np.frombuffer(b"".join(table.column("codes").to_pylist()), np.uint8).reshape(-1, WIDTH)
        learn(network, x, table.column("label").to_numpy(), turns, seed)
        yield pa.RecordBatch.from_pydict({"n": [len(x)], "model": [network.bytes()]})

    return run


def _learned(network: Network, examples: DataFrame, n: int, turns: int) -> Network:
    """The network after some turns: a single part takes them at once, of several the parameters are averaged after each."""
    parts = max(1, n // PART)
    dealt = examples.repartition(parts)
    for seed, some in enumerate([turns] if parts == 1 else [1] * turns):
        rows = dealt.mapInArrow(_learn(network.bytes(), some, 3 + seed), "n long, model binary").collect()
        models, total = sorted((r["n"], bytes(r["model"])) for r in rows), sum(r["n"] for r in rows)
        read = [(m / total, Network.read(stored).arrays) for m, stored in models]
        network = Network({name: sum(share * own[name] for share, own in read).astype(np.float32) for name in network.arrays})
    return network


def fit(docs: DataFrame) -> bytes:
    """The stored network; empty if there is nothing to learn."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    columns = "label int, codes binary"
    examples = settle(source.mapInArrow(_labelled, columns), "op2", "examples")
    by_label = {r["label"]: r["count"] for r in examples.groupBy("label").count().collect()}
    if len(by_label) < 2:
        return b""
    n = sum(by_label.values())
    network = _learned(Network.fresh(), examples, n, turns_of(n))
    hard = settle(source.mapInArrow(_hard(network.bytes()), columns), "op2", "hard")
    more = hard.count()
    if more:
        network = _learned(network, examples.unionByName(hard), n + more, 1)
    steps = source.mapInArrow(_counted(network.bytes()), "label int, step long, n long").groupBy("label", "step").agg(F.sum("n").alias("n")).collect()
    missed, counts = sum(r["n"] for r in steps if r["step"] is None), sorted((r["step"], r["label"], r["n"]) for r in steps if r["step"] is not None)
    if len({label for _, label, _ in counts}) < 2:
        return b""
    step, label, times = np.array(counts, np.int64).T
    judge(network, step * STEP, label, times, missed)
    return network.bytes() if network.arrays["platt"][0] > 0 else b""


def listed(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def _scan(stored: bytes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network.read(stored) if stored else None
        for batch, data, offsets in chunks(batches):
            found = [base(t or "") for t in batch.column("text").to_pylist()]
            digest = [hashlib.sha256(listed(f).encode()).hexdigest() for f in found]
            if network is not None:
                texts = Candidates(data, offsets)
                secret = (network.likely(network.logits(texts)) >= network.arrays["threshold"][0]) & ~texts.met(found)
                for i in np.flatnonzero(secret).tolist():
                    at = texts.text_at[texts.doc[i]]
                    found[texts.doc[i]].append((int(texts.first[i] - at), 3, int(texts.last[i] - at)))
            counts = [[sum(kind == k for _, kind, _ in f) for f in found] for k in range(4)]
            yield record(FOUND, batch.column("doc_id"), *counts, digest, [listed(sorted(f)) for f in found])

    return run


def scan(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, findings by kind, base_sha256 and spans; one row per row of ``docs``."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan(model), FOUND_DDL)
