from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from brokerflow.llm import sharding
from tests.llm.samples import empty, frame, rows


def place(text):
    return int(hashlib.sha256((text or "").encode()).hexdigest()[:15], 16)


def slow_minimax(sizes, shards):
    """Smallest largest sum of ``shards`` stretches, by trying every capacity."""
    for capacity in range(max(sizes), sum(sizes) + 1):
        used, room = 1, capacity
        for s in sizes:
            if s > room:
                used, room = used + 1, capacity
            room -= s
        if used <= shards:
            return capacity
    return 0


def check(got, held, shards):
    by_doc = {}
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None
        by_doc.setdefault(r["doc_id"], r)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in held)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    groups, shard_of = Counter(), {}
    for i, t in held:
        groups[place(t)] += len((t or "").encode()) + 1
        shard_of.setdefault(place(t), set()).add(by_doc[i]["shard"])
    order = sorted(groups)
    numbers = [shard_of[p] for p in order]
    assert all(len(n) == 1 for n in numbers)
    numbers = [n.pop() for n in numbers]
    assert numbers == sorted(numbers)
    sums = Counter()
    for p, n in zip(order, numbers, strict=True):
        sums[n] += groups[p]
    return max(sums.values()), slow_minimax([groups[p] for p in order], shards), sums


@pytest.mark.parametrize(("shards", "finer"), [(16, 10), (3, 4), (1, 10), (7, 2)])
def test_largest_shard_is_as_small_as_can_be(spark, monkeypatch, shards, finer):
    monkeypatch.setattr(sharding, "FINER_BITS", finer)
    monkeypatch.setattr(sharding, "ROWS_PER_BLOCK", 3)
    held = [(i, None if t is None else t[:300]) for i, t in rows(n=90)]
    largest, least, _ = check(sharding.shard(frame(spark, held), shards).collect(), held, shards)
    assert largest == least


def test_a_hot_group_is_a_shard_of_its_own_and_the_rest_is_even(spark):
    r = random.Random(3)
    held = [(i, "hot" * 30) for i in range(150)] + [(1000 + i, "x" * r.randint(20, 60) + str(i)) for i in range(300)]
    largest, least, sums = check(sharding.shard(frame(spark, held)).collect(), held, 16)
    assert largest == least and len(sums) == 16
    rest = sorted(sums.values())[:-1]
    assert rest[-1] < 1.3 * sum(rest) / len(rest)


def test_more_shards_than_groups_and_empty(spark):
    held = [(1, "a"), (2, "bb"), (3, None), (4, "")]
    largest, least, _ = check(sharding.shard(frame(spark, held)).collect(), held, 16)
    assert largest == least == 3
    assert sharding.shard(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = sharding.shard(frame(spark, rows()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
