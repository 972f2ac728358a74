"""Added tokens in texts, against the tokenizer as the JSON file sets it up."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from brokerflow.llm import packing
from brokerflow.llm.queries import QUERIES
from tests.llm import test_packing
from tests.llm.samples import frame, rows


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_added_tokens_have_their_own_ids(tokenizer):
    encode, r = packing.encoder(packing.VOCABULARY, packing.added_tokens(packing.TOKENIZER)), random.Random(6)
    assert np.frombuffer(encode("a <|endoftext|> b"), "<u4").tolist() == [64, 220, 50256, 275]
    odd = ["a", "the", "x.", ",", ".", "\n", " ", "  ", "\t", "é", "日本", "12", "<|", "|>", "<|endoftext", "<|endoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>"]
    for _ in range(4000):
        text = "".join(r.choice(odd) + r.choice(["", "", " "]) for _ in range(r.randint(0, 9)))
        assert encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_query_and_stage_emit_them(spark, tmp_path, tokenizer):
    held = [*rows(), (5001, "a <|endoftext|> b"), (5002, "word " * 1500 + "<|endoftext|>" * 3)]
    docs = frame(spark, held)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    test_packing.check(QUERIES["op6_best_fit_packing"](spark, str(tmp_path)).collect(), held, tokenizer, 1024)
    test_packing.check(corpus_pipeline.pack(spark, docs, str(tmp_path)).collect(), held, tokenizer, 1024)
