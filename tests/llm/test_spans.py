"""Substring removal, by words and by bytes, against direct counting."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from brokerflow.llm import columns, spans, substrings
from tests.llm.samples import empty, frame, rows


def by_words(held, window):
    words = [[] if t is None else re.findall(r"[^\x20\x09-\x0D]+", t) for _, t in held]
    first = {}
    for (doc_id, _), w in zip(held, words, strict=True):
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            first[key] = min(first.get(key, spans.NO_ID), spans.NO_ID if doc_id is None else doc_id)
    out = []
    for (doc_id, _), w in zip(held, words, strict=True):
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < (spans.NO_ID if doc_id is None else doc_id):
                gone[s : s + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def by_bytes(held, window):
    raw = [(t or "").encode() for _, t in held]
    times = Counter(b[s : s + window] for b in raw for s in range(len(b) - window + 1))
    out = []
    for (doc_id, _), b in zip(held, raw, strict=True):
        gone = bytearray(len(b))
        for s in range(len(b) - window + 1):
            if times[b[s : s + window]] > 1 and doc_id is not None:
                gone[s : s + window] = b"\1" * window
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((doc_id, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("seed", "window"), [(1, 50), (2, 10), (3, 50)])
def test_words_equal_brute_force(spark, seed, window):
    held = rows(seed)
    got = substrings.remove_repeats(frame(spark, held), window=window)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == by_words(held, window)


@pytest.mark.parametrize(("seed", "window", "gram", "most"), [(1, 200, 64, 4096), (2, 40, 16, 4096), (3, 200, 64, 2), (4, 30, 7, 3)])
def test_bytes_equal_brute_force(spark, monkeypatch, seed, window, gram, most):
    monkeypatch.setattr(columns, "TEXTS_PER_COLLECTION", most)
    monkeypatch.setattr(columns, "TEXTS_AT_ONCE", 50)
    held = rows(seed)
    got = columns.remove_repeats(frame(spark, held), window=window, gram=gram)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == by_bytes(held, window)


def test_near_copies_of_one_text(spark):
    """Many texts around the same grams, each changed elsewhere: runs differ, their windows mostly don't."""
    r = random.Random(5)
    words = [str(r.randint(0, 10**6)) for _ in range(300)]
    held = []
    for i in range(40):
        changed = list(words)
        for _ in range(4):
            changed[r.randrange(300)] = f"own{i}"
        held.append((i, " ".join(changed)))
    assert sorted(map(tuple, substrings.remove_repeats(frame(spark, held)).collect()), key=str) == by_words(held, 50)
    assert sorted(map(tuple, columns.remove_repeats(frame(spark, held)).collect()), key=str) == by_bytes(held, 200)


def test_texts_come_back(spark):
    held = [(1, "a b c d e f"), (2, "x a b c d y"), (3, None)]
    got = {r["doc_id"]: (r["n_removed"], r["kept"]) for r in substrings.remove_repeats(frame(spark, held), window=4, with_text=True).collect()}
    assert got == {1: (0, "a b c d e f"), 2: (4, "x y"), 3: (0, "")}
    got = {r["doc_id"]: (r["n_spans"], bytes(r["kept"])) for r in columns.remove_repeats(frame(spark, held), window=7, gram=2, with_text=True).collect()}
    assert got == {1: (1, b" e f"), 2: (1, b"x  y"), 3: (0, b"")} or got[3] == (0, b"")


def test_empty_tables(spark):
    assert substrings.remove_repeats(empty(spark)).count() == 0
    assert columns.remove_repeats(empty(spark)).count() == 0


def test_rounds_order_texts_and_measure_prefixes():
    r = random.Random(3)
    texts = [bytes(r.choice(b"ab") for _ in range(r.randint(1, 12))) for _ in range(60)]
    left = np.array([r.randint(0, len(t) - 1) for t in texts])
    collection = np.sort(np.array([r.randint(0, 2) for _ in texts]))
    for column, order, common in columns.rounds(collection, texts, left):
        def suffix(i, column=column):
            return texts[i][max(0, column + left[i]) :] if 0 <= column + left[i] < len(texts[i]) else None

        for before, after, n in zip(order, order[1:], common[1:], strict=False):
            a, b = suffix(before), suffix(after)
            same = collection[before] == collection[after]
            if a is None or b is None or not same:
                assert n == 0
                continue
            shared = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert n == shared
            assert a[shared:] == b"" or b[shared:] == b"" or a <= b


def test_equal_windows_have_equal_grams():
    r = random.Random(9)
    text = bytes(r.choice(b"abc") for _ in range(400))
    data = np.frombuffer(text + b"zz" + text, np.uint8)
    units = spans.byte_units(data, np.array([0, 400, 402, 802]))
    found = spans.runs(units, 5, 20, spans.Hashes(units.values))
    one, other = found.take(found.doc == 0), found.take(found.doc == 2)
    assert (one.gram == other.gram).all() and (one.first + 402 == other.first).all() and not (found.doc == 1).any()
    assert one.first[0] == 0 and one.last[-1] == 380 and (one.first[1:] == one.last[:-1] + 1).all()
    assert ((one.place >= one.last) & (one.place <= one.first + 15)).all()
