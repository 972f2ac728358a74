from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from brokerflow.llm import simhash
from tests.llm.samples import empty, frame, rows


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(marked, distance=2):
    """Smallest id that can be reached, per row."""
    forest = simhash.Forest(len(marked))
    for i, (_, a) in enumerate(marked):
        for j, (_, b) in enumerate(marked[:i]):
            if (a ^ b).bit_count() <= distance:
                forest.join(i, j)
    low = {}
    for i, (doc_id, _) in enumerate(marked):
        root = forest.root(i)
        if doc_id is not None:
            low[root] = min(low.get(root, doc_id), doc_id)
    return [low.get(forest.root(i)) for i in range(len(marked))]


def test_classes_equal_brute_force(spark):
    held = rows(n=120)
    got = simhash.classes(frame(spark, held))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    marked = [(i, slow_fingerprint(t)) for i, t in held]
    want = [(i, f"{bits:016x}", root) for (i, bits), root in zip(marked, slow_components(marked), strict=True)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("pairwise", [4096, 3])
def test_dense_groups_and_long_paths(spark, monkeypatch, pairwise):
    """Fingerprints that differ in a few bits of any segment, chained over many steps."""
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    r, marked = random.Random(2), []
    for _ in range(12):
        bits = r.getrandbits(64)
        for _ in range(r.randint(1, 40)):
            marked.append((len(marked) * 3 % 1009, bits))
            for _ in range(r.randint(0, 3)):
                bits ^= 1 << r.randrange(64)
    signed = [(i, b - (1 << 64) if b >> 63 else b) for i, b in marked]
    distinct = spark.createDataFrame(signed, "low_id long, bits long").groupBy("bits").agg({"low_id": "min"}).withColumnRenamed("min(low_id)", "low_id")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs: docs)
    got = {r["doc_id"]: r["component_id"] for r in simhash.classes(spark.createDataFrame(signed, "doc_id long, bits long")).collect()}
    assert got == {i: root for (i, _), root in zip(marked, slow_components(marked), strict=True)}
    assert distinct.count() > 50


def test_a_fingerprint_without_ids_links_others(spark, monkeypatch):
    monkeypatch.setattr(simhash, "fingerprints", lambda docs: docs)
    bits = 0b1011 << 40
    rows_ = [(8, bits), (None, bits ^ 3), (5, bits ^ 15), (None, bits ^ 15), (None, 1 << 20), (9, 7 << 50)]
    got = simhash.classes(spark.createDataFrame(rows_, "doc_id long, bits long")).collect()
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in got if r["component_id"] == 5) == [("5", 5), ("8", 5), ("None", 5), ("None", 5)]
    assert {r["component_id"] for r in got} == {5, 9, None}


def test_all_pairs_within_two_bits_share_a_key():
    r = random.Random(1)
    for _ in range(300):
        a = r.getrandbits(64)
        b = a ^ 1 << r.randrange(64) ^ 1 << r.randrange(64)
        keys, row = simhash.keys_of(np.array([a, b], np.uint64).view(np.int64))
        assert set(keys[row == 0]) & set(keys[row == 1])


def test_golay_keys_of_neighbours_meet():
    r = np.random.default_rng(0)
    x = r.integers(0, 1 << 23, 2000)
    y = x ^ 1 << r.integers(0, 23, 2000)
    a, b = simhash.golay_keys(x), simhash.golay_keys(y)
    assert all(set(p[p >= 0]) & set(q[q >= 0]) for p, q in zip(a, b, strict=True))
    assert 4.5 < (a >= 0).sum() / len(a) < 5.6


def test_majority_counts_beyond_a_byte():
    hashes = np.array([3] * 700 + [1] * 699, np.uint64)
    assert simhash.majority(hashes) == 3
    assert simhash.majority(np.array([3] * 700 + [1] * 700, np.uint64)) == 1


def test_empty_table(spark):
    assert simhash.classes(empty(spark)).count() == 0
