"""Quality of a document by attention over its passages.

A text is cut into passages of ``PASSAGE`` bytes. Each is encoded from hashed byte pairs, shares of
character classes and how much its words repeat. Gated attention weighs the encoded passages, and the
weighted sum is scored. Weights and encoder are learned together from document labels.

The model is fitted in one task on about ``LABELLED`` labelled texts, drawn by a hash of doc_id; scores
read whole texts. With no labelled text, or with one label only, every score is the share of label 1
(0.5 for none). Null texts are empty, and an empty text is one passage without content. Repeated rows
get equal scores; a null ``doc_id`` is never labelled. Of the tables only ``doc_id``, ``text`` and
``quality`` are read; a document with several labels counts with the largest.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerflow.llm.spans import word_units
from brokerflow.llm.text import SPACE, chunks, record, words

#: Labelled texts that the model is fitted on, about.
LABELLED = 6_000
PASSAGE = 1024
PAIRS = 256
HIDDEN, GATE = 32, 16
EPOCHS, BATCH, RATE, DECAY = 24, 128, 3e-3, 1e-4

_CLASS = np.full(256, 5)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[SPACE] = 3
_CLASS[0x0A] = 4
_CLASS[128:] = 6
CLASSES = 7
FEATURES = PAIRS + CLASSES + 4

SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("weight", pa.float64()), ("passages", pa.int64())])
SCORES_DDL = "doc_id long, score double, weight double, passages long"


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the number of each document's first passage (one more entry)."""
    sizes = np.diff(offsets)
    first = np.concatenate(([0], np.cumsum(np.maximum(1, -(-sizes // PASSAGE)))))
    n = int(first[-1])
    out = np.zeros((n, FEATURES), np.float32)
    if not len(data):
        return out, first
    within = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    passage = np.repeat(first[:-1], sizes) + within // PASSAGE
    length = np.bincount(passage, minlength=n).astype(np.float32)
    scale = np.maximum(length, 1)[:, None]
    pair = data[:-1].astype(np.uint32) * np.uint32(0x9E3779B1) + data[1:].astype(np.uint32) * np.uint32(0x85EBCA77)
    keys = passage[:-1] * PAIRS + (pair * np.uint32(0xC2B2AE3D) >> np.uint32(24)).astype(np.int64)
    same = passage[:-1] == passage[1:]
    out[:, :PAIRS] = np.sqrt(np.bincount(keys[same], minlength=n * PAIRS).reshape(n, PAIRS) / scale)
    out[:, PAIRS : PAIRS + CLASSES] = np.bincount(passage * CLASSES + _CLASS[data], minlength=n * CLASSES).reshape(n, CLASSES) / scale
    starts, ends, first_word = words(data, offsets)
    if len(starts):
        value, at = word_units(data, offsets).values, passage[starts]
        count = np.maximum(np.bincount(at, minlength=n), 1)
        again = np.zeros(len(starts), bool)
        again[1:] = (value[1:] == value[:-1]) & (at[1:] == at[:-1])
        order = np.lexsort((value, at))
        new = (np.diff(at[order], prepend=-1) != 0) | (np.diff(value[order], prepend=value[:1]) != 0)
        out[:, -4] = np.bincount(at, weights=again, minlength=n) / count
        out[:, -3] = np.bincount(at[order], weights=new, minlength=n) / count
        out[:, -2] = np.bincount(at, weights=np.minimum(ends - starts, 50), minlength=n) / count / 10
    out[:, -1] = np.log1p(length) / 7
    return out, first


class Model:
    """Parameters by name; ``forward`` keeps what ``backward`` needs."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays

    @classmethod
    def fresh(cls, features: np.ndarray, share: float) -> Model:
        random = np.random.default_rng(7)
        arrays = {
            "mean": features.mean(axis=0),
            "spread": features.std(axis=0) + 1e-2,
            "W": random.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)),
            "b": np.zeros(HIDDEN),
            "V": random.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
            "U": random.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
            "w": random.normal(0, GATE**-0.5, GATE),
            "c": random.normal(0, HIDDEN**-0.5, HIDDEN),
            "bias": np.array([np.log(share / (1 - share))]),
        }
        return cls({name: a.astype(np.float32) for name, a in arrays.items()})

    def forward(self, features: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p, starts, sizes = self.arrays, first[:-1], np.diff(first)
        x = (features - p["mean"]) / p["spread"]
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        g = (t * s) @ p["w"]
        e = np.exp(g - np.repeat(np.maximum.reduceat(g, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        score = 1 / (1 + np.exp(-(z @ p["c"] + p["bias"])))
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "score": score}

    def backward(self, f: dict[str, np.ndarray], first: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy."""
        p, sizes = self.arrays, np.diff(first)
        d_logit = ((f["score"] - label) / len(label)).astype(np.float32)
        d_z = np.repeat(d_logit[:, None] * p["c"], sizes, axis=0)
        d_a = (d_z * f["h"]).sum(axis=1)
        mean = np.add.reduceat(f["a"] * d_a, first[:-1])
        d_g = f["a"] * (d_a - np.repeat(mean, sizes))
        d_gate = d_g[:, None] * p["w"]
        d_t, d_s = d_gate * f["s"] * (1 - f["t"] ** 2), d_gate * f["t"] * f["s"] * (1 - f["s"])
        d_h = f["a"][:, None] * d_z + d_t @ p["V"].T + d_s @ p["U"].T
        d_u = d_h * (1 - f["h"] ** 2)
        return {
            "W": f["x"].T @ d_u, "b": d_u.sum(axis=0), "V": f["h"].T @ d_t, "U": f["h"].T @ d_s, "w": (f["t"] * f["s"]).T @ d_g,
            "c": f["z"].T @ d_logit, "bias": d_logit.sum(keepdims=True),
        }

    def bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.arrays)
        return out.getvalue()

    @classmethod
    def read(cls, stored: bytes) -> Model:
        with np.load(io.BytesIO(stored)) as arrays:
            return cls({name: arrays[name] for name in arrays.files})


class Adam:
    """Steps with running means of gradients and their squares; ``names`` decay."""

    def __init__(self, arrays: dict[str, np.ndarray], names: list[str], rate: float, decay: float):
        self.arrays, self.names, self.rate, self.decay, self.turn = arrays, names, rate, decay, 0
        self.mean = {n: np.zeros_like(arrays[n]) for n in names}
        self.square = {n: np.zeros_like(arrays[n]) for n in names}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.turn += 1
        for n in self.names:
            self.mean[n] += 0.1 * (gradients[n] - self.mean[n])
            self.square[n] += 0.001 * (gradients[n] ** 2 - self.square[n])
            mean, square = self.mean[n] / (1 - 0.9**self.turn), self.square[n] / (1 - 0.999**self.turn)
            self.arrays[n] -= (self.rate * (mean / (np.sqrt(square) + 1e-8) + self.decay * self.arrays[n])).astype(np.float32)


def train(features: np.ndarray, first: np.ndarray, label: np.ndarray) -> Model:
    share = float(np.clip(label.mean(), 0.01, 0.99))
    model = Model.fresh(features, share)
    steps = Adam(model.arrays, ["W", "b", "V", "U", "w", "c", "bias"], RATE, DECAY)
    random = np.random.default_rng(11)
    for _ in range(EPOCHS):
        order = random.permutation(len(label))
        for at in range(0, len(label), BATCH):
            docs = order[at : at + BATCH]
            sizes = first[docs + 1] - first[docs]
            starts = np.concatenate(([0], np.cumsum(sizes)))
            rows = np.arange(int(starts[-1])) + np.repeat(first[docs] - starts[:-1], sizes)
            f = model.forward(features[rows], starts)
            steps.step(model.backward(f, starts, label[docs]))
    return model


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).sort_by("doc_id").combine_chunks()
    label = table.column("quality").to_numpy().astype(np.float32)
    features, sizes = [], []
    for _, data, offsets in chunks(table.to_batches()):
        got, first = encode(data, offsets)
        features.append(got)
        sizes.append(np.diff(first))
    first = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
    stored = train(np.concatenate(features), first, label).bytes() if 0 < label.mean() < 1 else b""
    yield pa.RecordBatch.from_pydict({"share": [float(label.mean())], "model": [stored]}, schema=pa.schema([("share", pa.float64()), ("model", pa.binary())]))


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> tuple[float, bytes]:
    """The share of label 1, and the stored model (empty if there is nothing to learn)."""
    known = labels.filter("doc_id is not null and quality is not null")
    rate = min(1 << 30, (labelled << 30) // max(1, known.count()))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < rate).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")  # about ``labelled`` rows of two numbers
    row = texts.repartition(1).mapInArrow(_train, "share double, model binary").first()
    return (row["share"], bytes(row["model"])) if row else (0.5, b"")


def _score(share: float, stored: bytes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.read(stored) if stored else None
        for batch, data, offsets in chunks(batches):
            features, first = encode(data, offsets)
            score, weight = np.full(batch.num_rows, share), 1 / np.diff(first)
            if model is not None:
                found = model.forward(features, first)
                score, weight = found["score"].astype(float), np.maximum.reduceat(found["a"], first[:-1]).astype(float)
            yield record(SCORES, batch.column("doc_id"), score, weight, np.diff(first))

    return run


def score(docs: DataFrame, model: tuple[float, bytes]) -> DataFrame:
    """doc_id, score, the largest attention weight of a passage and the number of passages; one row per row of ``docs``."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_score(*model), SCORES_DDL)
