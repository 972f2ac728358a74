from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from brokerflow.llm import winnow
from tests.llm.samples import empty, frame, rows

ITEMS = "item_id long, text string, doc_id string, window string, length string"


def words(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(held, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[s : s + n]), set()).add(item)
    lengths = {len(k) for k in windows}
    out = []
    for doc_id, text in held:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                met = windows.get(tuple(w[s : s + n]))
                if met is not None:
                    hit.update(range(s, s + n))
                    found |= {str(i) for i in met if i is not None}
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in items], ITEMS)


@pytest.mark.parametrize("short", [False, True])
def test_hits_equal_brute_force(spark, short):
    held, r = rows(), random.Random(8)
    long = [t for _, t in held if t and len(words(t)) > 40]
    items = [(None, None), (1, ""), (2, "ZZZ is in no text at all but long enough to be windows of ten"), (3, "the same " * 8)]
    for i in range(12):
        w = words(r.choice(long))
        start = r.randrange(len(w) - 20)
        part = " ".join(w[start : start + r.randint(10, 30)])
        items += [(100 + i, part.upper() if i % 2 else part), (200 + i, f"before, {part}! after")]
    items.append((100, items[4][1]))
    if short:
        items += [(300, words(long[0])[3]), (301, " ".join(words(long[1])[5:8])), (302, "end Ünïcode")]
    got = winnow.contamination(frame(spark, held), benchmark(spark, items))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(held, items)


def test_rows_are_judged_by_their_own_text(spark):
    """Rows without an id, one id with several texts, and rows that are there twice."""
    r = random.Random(5)
    part = " ".join(f"w{r.randrange(900)}" for _ in range(14))
    clean = " ".join(f"w{r.randrange(900)}" for _ in range(60))
    texts = [f"a b {part} c", clean, part, "", None, f"{clean} {part}"]
    held = [(i, t) for i in (None, 7, 8) for t in texts for _ in range(3)] + [(None, f"{clean} x{k}") for k in range(40)]
    items = [(1, part), (2, f"{part} more words than before"), (None, part), (3, clean[:20])]
    got = winnow.contamination(frame(spark, held), benchmark(spark, items))
    assert sorted(map(tuple, got.collect()), key=str) == brute(held, items)
    kept = winnow.clean(frame(spark, held), benchmark(spark, items))
    assert kept.columns == frame(spark, []).columns
    assert sorted((str(x["doc_id"]), str(x["text"])) for x in kept.collect()) == sorted((str(b[0]), str(t)) for (i, t), b in zip(held, [brute([x], items)[0] for x in held], strict=True) if not b[5])


@pytest.mark.parametrize("short", [False, True])
def test_long_texts_and_items_end(spark, short):
    r = random.Random(6)
    long = [" ".join(f"w{r.randrange(5000)}" for _ in range(20_000)) for _ in range(2)]
    held = [(1, long[0]), (2, long[1][:9000]), (3, "same " * 20_000), (4, "short one")]
    items = [(1, long[0]), (2, "same " * 3000), (3, long[1])] + ([(4, "w1 w2"), (5, "short")] if short else [])
    began = time.monotonic()
    got = winnow.contamination(frame(spark, held), benchmark(spark, items)).collect()
    assert time.monotonic() - began < 60
    assert sorted(map(tuple, got), key=str) == brute(held, items)


def test_prints_that_cannot_be_broadcast(spark, no_broadcast):
    held = rows()
    items = [(1, next(t for _, t in held if t and len(words(t)) > 60)), (2, "the same " * 8)]
    assert sorted(map(tuple, winnow.contamination(frame(spark, held), benchmark(spark, items)).collect()), key=str) == brute(held, items)


def test_empty_tables(spark):
    items = [(1, "one two three")]
    assert winnow.contamination(empty(spark), benchmark(spark, items)).count() == 0
    got = winnow.contamination(frame(spark, rows()), benchmark(spark, items).limit(0))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows(), [])


def test_no_python_in_the_plan(spark):
    plan = winnow.contamination(frame(spark, rows()), benchmark(spark, [(1, "the same " * 20)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
