from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest

from brokerflow.llm import exact
from tests.llm.samples import empty, frame, rows


def brute(held):
    digest = {i: None for i in range(len(held))}
    groups = defaultdict(list)
    for n, (_, text) in enumerate(held):
        digest[n] = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()
        groups[digest[n]].append(n)
    out = []
    for n, (doc_id, _) in enumerate(held):
        group = groups[digest[n]]
        keep = min((held[m][0] for m in group if held[m][0] is not None), default=None)
        first = next(m for m in group if held[m][0] == keep)  # one row of equal ids, whichever
        out.append((doc_id, keep, len(group), n == first, digest[n]))
    return sorted(out, key=str)


def test_groups_equal_brute_force(spark):
    held = rows() + [(9001, " a\tb"), (9000, " a\n\nb"), (9002, "a b"), (None, "alone")]
    got = exact.duplicates(frame(spark, held))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(held)


def test_one_row_of_each_group_is_kept(spark):
    """Tables delivered twice, rows without an id, one id with several texts."""
    held = [(i, f"text {i % 4}") for i in range(9)] * 2 + [(None, "text 1"), (None, "alone"), (None, "alone"), (5, "other"), (5, "text 9"), (None, None), (None, "")]
    got = exact.duplicates(frame(spark, held)).collect()
    assert sorted(map(tuple, got), key=str) == brute(held)
    texts = {r["text_sha256"] for r in got}
    assert sum(r["kept"] for r in got) == len(texts)
    kept = exact.single(frame(spark, held))
    assert kept.columns == frame(spark, []).columns
    assert sorted((str(r["doc_id"]), (r["text"] or "")) for r in kept.collect()) == sorted((str(b[0]), t or "") for (_, t), b in zip(held, [brute_of(held, n) for n in range(len(held))], strict=True) if b[3])


def brute_of(held, n):
    group = [m for m, (_, t) in enumerate(held) if (t or "") == (held[n][1] or "")]
    keep = min((held[m][0] for m in group if held[m][0] is not None), default=None)
    return held[n][0], keep, len(group), n == next(m for m in group if held[m][0] == keep)


def test_a_hot_text_and_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(exact, "KEYS_PER_BUCKET", 7)
    held = [(i, "hot" if i % 3 else f"text {i}") for i in range(300)]
    assert sorted(map(tuple, exact.duplicates(frame(spark, held)).collect()), key=str) == brute(held)


def test_empty_table(spark):
    assert exact.duplicates(empty(spark)).count() == 0


def hexes(n, seed=0):
    r = random.Random(seed)
    return [f"{r.getrandbits(256):064x}" for _ in range(n)]


def test_filter_finds_all_and_forgets_the_deleted():
    kept = exact.CuckooFilter(2000)
    keys = hexes(1500)
    assert all(map(kept.insert, keys))
    assert all(k in kept for k in keys)
    assert all(map(kept.delete, keys[:700]))
    assert all(k in kept for k in keys[700:])
    assert sum(k in kept for k in keys[:700]) < 20
    assert sum(k in kept for k in hexes(5000, 1)) < 20


def test_bucket_grows_from_its_stored_keys_and_survives_false_hits():
    bucket, keys = exact.Bucket(), hexes(4000, 2)
    start = bucket.filter.buckets
    for i, key in enumerate(keys):
        bucket.change(key, i, 1)
    assert bucket.filter.buckets > start and all(k in bucket.filter for k in keys)
    false = keys[0][:16] + "f" * 48  # same fingerprint and place, another digest
    assert false in bucket.filter
    bucket.change(false, 5, 1)
    assert bucket.stored[false] == [5, 1] and bucket.stored[keys[0]] == [0, 1]
    bucket.change(false, None, -1)
    assert false not in bucket.stored and keys[0] in bucket.filter


def test_index_takes_and_loses_documents(spark):
    docs = spark.createDataFrame([(i, f"text {i % 20}") for i in range(100)], "doc_id long, text string")
    keyed = exact.digests(docs)
    index = exact.build(keyed, 4)
    come = exact.digests(spark.createDataFrame([(200, "text 3"), (201, "new")], "doc_id long, text string"))
    gone = keyed.filter("doc_id % 20 in (3, 5)").unionByName(keyed.limit(0))
    got = {r["keep_id"]: r["group_size"] for r in exact.update(index, 4, come, gone).collect()}
    assert got == {i: 5 for i in range(20) if i not in (3, 5)} | {3: 1, 201: 1}


@pytest.mark.parametrize("missing", [0, 1])
def test_taking_what_is_not_there_changes_nothing(missing):
    bucket = exact.Bucket()
    bucket.change("ab" * 32, 1, 1)
    bucket.change("cd" * 32, None, -1)
    assert list(bucket.stored) == ["ab" * 32]
