"""The network learns from all texts, and its threshold counts all candidates that are kept out."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from brokerflow.llm import secrets
from brokerflow.llm.text import utf8
from tests.llm.samples import empty, frame


def sample(n, seed=4):
    """Texts with keys, with numbers and with neither; some of them without an id."""
    r, out = random.Random(seed), []
    words = ["settled", "insurance", "Reporting", "weather", "Buildings", "something", "yesterday", "collision"]
    for i in range(n):
        said = r.choices(words, k=12)
        if i % 3 == 0:
            said.insert(5, r.choice(["password: ", "token="]) + "%016x" % r.getrandbits(64))
        if i % 5 == 0:
            said.insert(2, str(r.randrange(10**13, 10**14)))
        out.append((None if i % 11 == 0 else i, " ".join(said)))
    return out


def batches(held):
    table = pa.table({"doc_id": pa.array([i for i, _ in held], pa.int64()), "text": pa.array([t for _, t in held], pa.string())})
    return iter(table.to_batches())


def test_every_finding_of_a_text_is_learned():
    """A text gave 16 of them at most."""
    text = " ".join("%032x" % random.Random(i).getrandbits(128) for i in range(60))
    kept = next(i for i in range(99) if not secrets._held_out(i))
    rows = pa.Table.from_batches(secrets._labelled(batches([(kept, text)])))
    assert rows.column("label").to_pylist().count(1) == 2 * 60


@pytest.mark.parametrize("part", [100_000, 150])
def test_threshold_counts_everything_that_is_kept_out(spark, monkeypatch, part):
    """In one task and in several; no text is left out, neither of those with an id nor of the others."""
    monkeypatch.setattr(secrets, "PART", part)
    held = sample(900)
    network = secrets.Network.read(secrets.fit(frame(spark, held)))
    out = [t for i, t in held if secrets._held_out(i, t)]
    assert 0 < sum(secrets._held_out(i, t) for i, t in held if i is None) < sum(i is None for i, _ in held)
    texts, found = secrets.Candidates(*utf8(pa.array(out))), [secrets.base(t) for t in out]
    logit, label = network.logits(texts), texts.met(found)
    step = np.floor(logit / secrets.STEP) * secrets.STEP
    assert np.allclose(secrets.calibrate(step, label), network.arrays["platt"], atol=1e-3)
    likely, missed = network.likely(step), len(texts.missing(found))
    threshold, secret = network.arrays["threshold"][0], np.sort(likely[label])
    wanted = secrets.RECALL * (len(secret) + missed)
    assert (network.likely(logit[label]) >= threshold).sum() >= min(wanted, len(secret))
    assert (secret > threshold).sum() < wanted
    assert (network.likely(logit[~label]) >= threshold).mean() < 0.05


def test_counts_equal_the_outputs_one_by_one():
    held = sample(200)
    network = secrets.Network.fresh()
    rows = pa.Table.from_batches(secrets._counted(network.bytes())(batches(held))).to_pylist()
    out = [t for i, t in held if secrets._held_out(i, t)]
    texts = secrets.Candidates(*utf8(pa.array(out)))
    assert sum(r["n"] for r in rows if r["step"] is not None) == len(texts)
    assert sum(r["n"] for r in rows if r["label"] and r["step"] is not None) == texts.met([secrets.base(t) for t in out]).sum()


def test_what_is_mistaken_for_a_secret_is_learned():
    """Wherever it stands in a text: before, a text gave one other run at most."""
    held, network = sample(200), secrets.Network.fresh()
    network.arrays["bias"] += 9  # takes everything for a secret
    rows = pa.Table.from_batches(secrets._hard(network.bytes())(batches(held)))
    own = [t for i, t in held if not secrets._held_out(i, t)]
    texts = secrets.Candidates(*utf8(pa.array(own)))
    assert rows.num_rows == (~texts.met([secrets.base(t) for t in own])).sum()


def test_weights_are_repetitions():
    r = np.random.default_rng(1)
    logit, n = r.normal(0, 2, 50), r.integers(1, 6, 50)
    label = (logit + r.normal(0, 1, 50) > 0).astype(int)
    one, many = secrets.Network.fresh(), secrets.Network.fresh()
    secrets.judge(one, np.repeat(logit, n), np.repeat(label, n), np.ones(n.sum(), int), missed=1, recall=0.8)
    secrets.judge(many, logit, label, n, missed=1, recall=0.8)
    assert np.allclose(one.arrays["platt"], many.arrays["platt"], atol=1e-5) and np.isclose(one.arrays["threshold"], many.arrays["threshold"])


def test_no_rows_and_texts_without_secrets(spark):
    assert secrets.fit(empty(spark)) == b""
    assert secrets.fit(frame(spark, [(i, "nothing of that kind here " + "word " * i) for i in range(40)] + [(99, None)])) == b""


def test_what_lies_between_candidates_is_not_looked_up_as_a_part_of_one(monkeypatch):
    """Every byte was, which took most of the time."""
    texts = secrets.Candidates(*utf8(pa.array(["a " * 300 + "deadbeef " + "b " * 300 + "0123456789ab", "c " * 400 + "something"])))
    network, looked_up, whole = secrets.Network.fresh(), [], secrets.range_max
    monkeypatch.setattr(secrets, "range_max", lambda values, begin, stop: looked_up.append(len(values)) or whole(values, begin, stop))
    got = network.logits(texts)
    assert len(texts) == 3 and sum(looked_up) == sum(n - secrets.KERNEL + 1 for n in (8, 12, 9))
    assert np.allclose(got, network.forward(texts.examples(np.arange(3)))["logit"], atol=1e-4)
