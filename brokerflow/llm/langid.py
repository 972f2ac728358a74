"""Language shares of a document by expectation-maximisation over letter n-grams.

Each language has a smoothed distribution of hashed n-grams, counted over its labelled texts. A
document's n-grams are taken as drawn from a mixture of languages, and EM estimates the shares. Which
languages take part is chosen by penalised likelihood: languages join in the order of their shares in
the mixture of all, as long as each raises the log-likelihood by more than half the log of the number
of n-grams (the Bayesian information criterion). The uniform distribution over n-grams takes part as
"none of these"; a text in which it has a share above ``MOST_UNKNOWN`` is rejected by ``known``.

The n-gram counts are fitted on a bounded sample: per language, texts are drawn by a hash of doc_id at a
rate that leaves about ``TEXTS_PER_LANGUAGE`` of them. Predictions read whole texts.

Null texts and texts without a letter get ``und`` and score 0. Repeated rows get equal results. Only
``doc_id``, ``text`` and, for fitting, ``lang`` are read. With no labelled text there is no language to
predict, and every row gets ``und``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerflow.llm.text import record

#: Labelled texts that a language is fitted on, about.
TEXTS_PER_LANGUAGE = 4_000
#: A text is rejected if a larger share of its n-grams is in no language; keys and numbers in a short one stay below.
MOST_UNKNOWN = 0.7
BUCKETS = 1 << 14
SMOOTHING = 0.5
#: Passes of EM, and (document, n-gram) pairs that are worked on at once.
PASSES = 12
PAIRS_AT_ONCE = 200_000
CHARS_AT_ONCE = 1 << 19

COUNTS = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])
GUESSES = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("unknown", pa.float64()), ("shares", pa.string())])
GUESSES_DDL = "doc_id long, lang_pred string, score double, unknown double, shares string"

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters, looked up per code point."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, bucket) pairs of the texts as document * BUCKETS + bucket, and how often each occurs.

    N-grams are three consecutive characters of the lower-case text, where every run of other
    characters than letters is one blank; each has a letter in the middle.
    """
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("\0".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
    letter = letters()[codes]
    codes = np.where(letter, codes, 0x20)
    middle = np.flatnonzero(letter[1:-1]) + 1
    hashed = codes[middle - 1] * np.uint32(0x9E3779B1) ^ codes[middle] * np.uint32(0x85EBCA77) ^ codes[middle + 1] * np.uint32(0xC2B2AE3D)
    hashed ^= hashed >> np.uint32(15)
    hashed *= np.uint32(0x2C1B3C6D)
    keys = doc[middle - 1].astype(np.int64) * BUCKETS + (hashed >> np.uint32(18)).astype(np.int64)
    if len(texts) * BUCKETS <= 8 * len(keys) + BUCKETS:  # few long texts: count in a table
        counts = np.bincount(keys, minlength=1)
        pairs = np.flatnonzero(counts)
        return pairs, counts[pairs]
    return np.unique(keys, return_counts=True)


def parts(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with a bounded number of characters; a longer text is alone."""
    first = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > CHARS_AT_ONCE:
            yield first, i
            first, held = i, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            pairs, counts = ngrams([text])
            np.add.at(sums.setdefault(lang, np.zeros(BUCKETS, np.int64)), pairs, counts)
    for lang, counted in sums.items():
        bucket = np.flatnonzero(counted)
        yield record(COUNTS, [lang] * len(bucket), bucket, counted[bucket])


def fit(labelled: DataFrame, per_language: int = TEXTS_PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages in order of name, and a row of n-gram probabilities for each, the last row for none of them.

    The table has languages x ``BUCKETS`` numbers, whatever the number of texts.
    """
    known = labelled.filter("lang is not null and text is not null").select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return [], np.full((1, BUCKETS), 1 / BUCKETS, np.float32)
    number = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))  # rows without an id are drawn by their text
    draw = F.pmod(number, F.lit(1 << 30))
    share = F.lit(0)
    for lang in langs:
        share = F.when(F.col("lang") == lang, F.lit(min(1 << 30, (per_language << 30) // sizes[lang]))).otherwise(share)
    counts = known.filter(draw < share).select("lang", "text").mapInArrow(_count, "lang string, bucket int, n long")
    counted = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    table = np.full((len(langs) + 1, BUCKETS), SMOOTHING)
    rows = np.searchsorted(langs, np.array(counted.column("lang").to_pylist(), object)) if counted.num_rows else np.zeros(0, int)
    table[rows.astype(int), counted.column("bucket").to_numpy()] += counted.column("n").to_numpy()
    return langs, (table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def mixture(doc: np.ndarray, n: np.ndarray, likelihood: np.ndarray, docs: int, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares (documents x languages) and log-likelihood of each document, by EM over the allowed languages.

    ``doc``, ``n`` and ``likelihood`` (pairs x languages) describe the n-grams, sorted by document.
    """
    starts = np.flatnonzero(np.diff(doc, prepend=-1))
    present = doc[starts]
    shares = allowed / np.maximum(allowed.sum(axis=1, keepdims=True), 1)
    shares = shares.astype(np.float32)
    total = np.zeros((docs, 1), np.float32)
    total[present, 0] = np.add.reduceat(n, starts) if len(starts) else 0
    log = np.zeros(docs)
    for turn in range(PASSES + 1):
        joint = likelihood * shares[doc]
        whole = joint.sum(axis=1)
        if turn == PASSES or not len(starts):
            if len(starts):
                log[present] = np.add.reduceat(n * np.log(np.maximum(whole, 1e-30)), starts)
            break
        joint *= (n / np.maximum(whole, 1e-30))[:, None]
        shares[present] = np.add.reduceat(joint, starts, axis=0) / total[present]
    return shares, log


def select(doc: np.ndarray, n: np.ndarray, likelihood: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the languages that penalised likelihood selects, zero for all others; and those of all languages together."""
    kinds = likelihood.shape[1]
    all_shares, _ = mixture(doc, n, likelihood, docs, np.ones((docs, kinds), bool))
    order = np.argsort(-all_shares, axis=1, kind="stable")
    total = np.bincount(doc, weights=n, minlength=docs)
    price = 0.5 * np.log(np.maximum(total, 2))
    allowed = np.zeros((docs, kinds), bool)
    allowed[np.arange(docs), order[:, 0]] = True
    best, log = mixture(doc, n, likelihood, docs, allowed)
    going = np.ones(docs, bool)
    for turn in range(1, kinds):
        going &= all_shares[np.arange(docs), order[:, turn]] > 0
        if not going.any():
            break
        allowed[np.arange(docs), order[:, turn]] |= going
        pick = going[doc]
        number = np.cumsum(going) - 1
        some, some_log = mixture(number[doc[pick]], n[pick], likelihood[pick], int(going.sum()), allowed[going])
        rows = np.flatnonzero(going)
        better = some_log > log[rows] + price[rows]
        best[rows[better]], log[rows[better]] = some[better], some_log[better]
        going[rows[~better]] = False
    return best, all_shares


def _guess(langs: list[str], table: np.ndarray) -> Callable:
    by_bucket = np.ascontiguousarray(table.T)

    def some(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Shares of every text, the last for no language, all zero without a letter; and its likeliest language.

        That is the one with the largest share, or where none was selected the largest one of all languages together.
        """
        pairs, counts = ngrams(texts)
        doc, bucket = pairs // BUCKETS, pairs % BUCKETS
        out, likeliest = np.zeros((len(texts), len(langs) + 1), np.float32), np.zeros(len(texts), np.int64)
        first = 0
        while first < len(doc):
            last = int(np.searchsorted(doc, doc[min(first + PAIRS_AT_ONCE, len(doc)) - 1], side="right"))
            low, high = int(doc[first]), int(doc[last - 1]) + 1
            part = slice(first, last)
            out[low:high], together = select(doc[part] - low, counts[part].astype(np.float32), by_bucket[bucket[part]], high - low)
            if langs:
                named = np.where(out[low:high, :-1].any(axis=1, keepdims=True), out[low:high, :-1], together[:, :-1])
                likeliest[low:high] = named.argmax(axis=1)
            out[np.setdiff1d(np.arange(low, high), doc[part])] = 0
            first = last
        return out, likeliest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = [(np.zeros((0, len(langs) + 1), np.float32), np.zeros(0, np.int64)), *(some(texts[a:b]) for a, b in parts(texts))]
            shares, chosen = (np.concatenate(x) for x in zip(*found, strict=True))
            if langs:
                spoken = shares.sum(axis=1) > 0
                named = [langs[c] if s else "und" for c, s in zip(chosen.tolist(), spoken.tolist(), strict=True)]
                score = shares[np.arange(len(texts)), chosen]
            else:
                named, score = ["und"] * len(texts), np.zeros(len(texts))
            listed = [",".join(f"{lang}:{share:.3f}" for lang, share in zip(langs, row, strict=False) if share > 0.0005) for row in shares.tolist()]
            yield record(GUESSES, batch.column("doc_id"), named, np.clip(score, 0, 1).astype(float), shares[:, -1].astype(float), listed)

    return run


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score (its share), unknown (the share of no language) and all shares as text."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(_guess(*model), GUESSES_DDL)


def known(docs: DataFrame, model: tuple[list[str], np.ndarray], most_unknown: float = MOST_UNKNOWN) -> DataFrame:
    """The rows of ``docs``, all columns, without texts that are in no fitted language or have no letter."""
    guess = _guess(*model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = record(pa.schema([("doc_id", pa.int64()), ("text", pa.string())]), [None] * batch.num_rows, batch.column("text"))
            for got in guess([asked]):
                named = np.array(got.column("lang_pred").to_pylist(), object) != "und"
                yield batch.filter(pa.array(named & (got.column("unknown").to_numpy() <= most_unknown)))

    return docs.mapInArrow(run, docs.schema)
