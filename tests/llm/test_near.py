from __future__ import annotations

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from brokerflow.llm import near, simhash
from tests.llm import test_packing, test_winnow
from tests.llm.samples import empty, frame, rows

SF = "/root/testdata/sf0.001"


def slow_set(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def slow_copies(held):
    """(doc_id, smallest id that can be reached) where that is another one."""
    held = [(i, slow_set(t)) for i, t in held if i is not None]
    forest = simhash.Forest(len(held))
    first = {}
    for i, (doc_id, a) in enumerate(held):
        forest.join(first.setdefault(doc_id, i), i)
        for j, (_, b) in enumerate(held[:i]):
            if a and 5 * len(a & b) >= 4 * len(a | b):
                forest.join(i, j)
    low = {}
    for i, (doc_id, _) in enumerate(held):
        low[forest.root(i)] = min(low.get(forest.root(i), doc_id), doc_id)
    return {(doc_id, low[forest.root(i)]) for i, (doc_id, _) in enumerate(held) if low[forest.root(i)] != doc_id}


def changed(held, n, seed=3):
    """Copies with some words changed, of texts and of copies."""
    r, out = random.Random(seed), [(i, t) for i, t in held if t and len(t.split()) > 30]
    for new in range(n):
        words = r.choice(out)[1].split()
        for _ in range(r.randint(1, 1 + len(words) // 40)):
            words[r.randrange(len(words))] = f"new{r.randrange(9)}"
        out.append((9000 - new, " ".join(words)))
    return held + out[-n:]


def test_copies_equal_brute_force(spark):
    held = changed(rows(n=80), 150)
    want = slow_copies(held)
    assert len(want) > 50
    assert {tuple(r) for r in near.copies(frame(spark, held)).collect()} == want


def test_rows_are_judged_by_their_text(spark):
    """Copies among rows without an id, under one id and in a table delivered twice: one row of each group stays."""
    r = random.Random(9)
    texts = [" ".join(f"w{r.randrange(5000)}" for _ in range(120)) for _ in range(6)]
    near_copy = lambda t, k: " ".join([*t.split()[:-1], f"end{k}"])
    held = [(None, texts[0]), (None, near_copy(texts[0], 1)), (4, near_copy(texts[0], 2)), (3, texts[1]), (3, texts[2]), (3, near_copy(texts[2], 1)), (None, texts[3]), (2, texts[4]), (2, texts[4]), (None, "")]
    kept = near.apart(frame(spark, held))
    assert kept.columns == frame(spark, []).columns
    got = [(x["doc_id"], x["text"]) for x in kept.collect()]
    assert (4, near_copy(texts[0], 2)) in got and (3, texts[1]) in got and (None, texts[3]) in got and (None, "") in got
    assert len(got) == 6 and sum(t in (texts[2], near_copy(texts[2], 1)) for _, t in got) == 1 and got.count((2, texts[4])) == 1


def test_one_changed_word_is_a_copy(spark):
    """Two bits of fingerprint linked about half of these."""
    r, held = random.Random(8), []
    for i in range(40):
        words = [f"w{r.randrange(5000)}" for _ in range(150)]
        held.append((2 * i, " ".join(words)))
        words[r.randrange(150)] = "changed"
        held.append((2 * i + 1, " ".join(words)))
    kept = corpus_pipeline.near_dedup(spark, frame(spark, held), SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2 * i for i in range(40)]


def test_group_links_span_the_components():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 12, r.integers(1, 14))).astype(np.uint64) for _ in range(150)]
    fast, slow = simhash.Forest(150), simhash.Forest(150)
    assert all(fast.join(i, j) for i, j in near.group_links(sets))
    for i in range(150):
        for j in range(i):
            if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j])):
                slow.join(i, j)
    assert [fast.root(i) for i in range(150)] == [slow.root(i) for i in range(150)]


def test_sets_of_likeness_near_the_bound_share_a_key():
    r = np.random.default_rng(2)
    for size in (9, 45, 900):
        for _ in range(200):
            hashes = r.integers(0, 1 << 64, size, np.uint64)
            cut = size // 9  # likeness 7/9, just below the bound
            assert (near.band_keys(hashes[cut:]) == near.band_keys(hashes[:-cut])).any()


def test_stages_from_near_dedup_on_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stages, held = dict(corpus_pipeline.STAGES), lambda df: [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    single = stages["exact_dedup"](spark, stages["language_id"](spark, docs, SF), SF)
    gone = {i for i, _ in slow_copies(held(single))}
    apart = stages["near_dedup"](spark, single, SF)
    assert gone and apart.columns == docs.columns
    assert sorted(i for i, _ in held(apart)) == sorted(i for i, _ in held(single) if i not in gone)
    clean = stages["decontaminate"](spark, apart, SF)
    assert sorted(i for i, _ in held(clean)) == sorted(r[0] for r in test_winnow.brute(held(apart), items) if not r[5])
    read = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    test_packing.check(stages["pack"](spark, clean, SF).collect(), held(clean), read, 1024)
    assert corpus_pipeline.run(spark, SF).count() == stages["pack"](spark, clean, SF).count()


def test_linked_fingerprints_are_candidates(spark, monkeypatch):
    """Without any band: the links of op7 whose shingles are alike, all of them and no other; texts without words link to nothing."""

    def no_bands(batches):
        for _ in batches:
            pass
        return iter(())

    monkeypatch.setattr(near, "_keys", no_bands)
    held = changed(rows(n=60), 150) + [(20_000, ""), (20_001, " \t"), (20_002, None)]
    of = {r["doc_id"]: r["component_id"] for r in simhash.classes(frame(spark, held)).collect()}
    want = set()
    for component in set(of.values()):
        want |= slow_copies([(i, t) for i, t in held if i is not None and of[i] == component])
    assert len(want) > 10
    assert {tuple(r) for r in near.copies(frame(spark, held)).collect()} == want


def test_empty_table(spark):
    assert near.copies(empty(spark)).count() == 0
