from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from brokerflow.llm import packing
from tests.llm.samples import empty, frame, rows


@pytest.fixture(scope="module")
def tokenizer():
    read = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    read.encode_special_tokens = True
    return read


def check(got, held, tokenizer, capacity):
    """Every piece is there once, with its ids, and sequences are gapless and not too long."""
    want = []
    for doc_id, text in held:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want.append((doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == sorted(want, key=str)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= capacity
    return sequences


@pytest.mark.parametrize(("capacity", "per_task"), [(1024, 100_000), (64, 5)])
def test_pieces_and_places(spark, monkeypatch, tokenizer, capacity, per_task):
    monkeypatch.setattr(packing, "UNITS_PER_TASK", per_task)
    monkeypatch.setattr(packing, "FAN_IN", 2)
    held = rows()
    got = packing.pack(frame(spark, held), capacity=capacity)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    sequences = check(got.collect(), held, tokenizer, capacity)
    total = sum(length for placed in sequences.values() for _, length in placed)
    assert len(sequences) <= 1.1 * total / capacity + 2


def test_bins_that_fit_nowhere_end_the_rounds(spark, monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "UNITS_PER_TASK", 4)
    held = [(i, "a b c d e f g") for i in range(60)]
    sequences = check(packing.pack(frame(spark, held), capacity=10).collect(), held, tokenizer, 10)
    assert len(sequences) == 60


def test_empty_table(spark):
    assert packing.pack(empty(spark)).count() == 0


def test_ids_equal_the_tokenizer_on_odd_texts(tokenizer):
    encode, r = packing.Encoder(packing.VOCABULARY), random.Random(4)
    odd = ["a", "the", "I'm", "x.", ",", ".", "\n", " ", "  ", "\t", "é", "日本", "12", "!!", "\x1c", "\x85", "　", "'s", "<|endoftext|>", "\r", "́", "Ⅷ", "²"]
    for _ in range(4000):
        text = "".join(r.choice(odd) + r.choice(["", "", " "]) for _ in range(r.randint(0, 9)))
        assert encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_best_fit_takes_the_fullest_bin_that_has_room():
    bins, at, used = packing.best_fit(np.array([6, 5, 4, 3, 2, 10]), 10)
    assert bins.tolist() == [1, 2, 1, 2, 2, 0] and used.tolist() == [10, 10, 10]
    assert at.tolist() == [0, 0, 6, 5, 8, 0]
