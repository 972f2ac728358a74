"""The stages after each other, each against its brute-force version, and the registered queries against SQL."""

from __future__ import annotations

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as registered
import corpus_pipeline
from brokerflow.checks.compare import difference, duck
from brokerflow.llm.oracles import ORACLES
from brokerflow.llm.queries import QUERIES, fold
from tests.llm import test_exact, test_near, test_packing, test_winnow
from tests.llm.samples import empty

SF = "/root/testdata/sf0.001"


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def test_every_stage_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, items = docs.columns, [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "near_dedup", "decontaminate", "pack"]

    spoken = stages["language_id"](spark, docs, SF)
    assert spoken.columns == columns
    assert len(rows_of(spoken)) == sum(any(c.isalpha() for c in t or "") for _, t in rows_of(docs))

    single = stages["exact_dedup"](spark, spoken, SF)
    assert single.columns == columns
    assert sorted(i for i, _ in rows_of(single)) == sorted(r[0] for r in test_exact.brute(rows_of(spoken)) if r[3])

    apart = stages["near_dedup"](spark, single, SF)
    gone = {i for i, _ in test_near.slow_copies(rows_of(single))}
    assert gone and apart.columns == columns
    assert sorted(i for i, _ in rows_of(apart)) == sorted(i for i, _ in rows_of(single) if i not in gone)

    clean = stages["decontaminate"](spark, apart, SF)
    assert clean.columns == columns
    assert sorted(i for i, _ in rows_of(clean)) == sorted(r[0] for r in test_winnow.brute(rows_of(apart), items) if not r[5])

    read = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    test_packing.check(stages["pack"](spark, clean, SF).collect(), rows_of(clean), read, 1024)
    assert corpus_pipeline.run(spark, SF).count() == stages["pack"](spark, clean, SF).count()


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0 and empty(spark).count() == 0


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    got, wanted = QUERIES[name](spark, SF), duck(SF).sql(ORACLES[name])
    got, wanted = (pd.DataFrame(map(tuple, rows), columns=df.columns, dtype=object) for df, rows in ((got, got.collect()), (wanted, wanted.fetchall())))
    assert len(got) and difference(got, wanted) is None


def test_language_of_held_out_documents(spark):
    got = {r["doc_id"]: r for r in QUERIES["op1_language_id"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("own", fold(4) == 2).collect()
    held_out = [got[r["doc_id"]]["lang_pred"] == r["lang"] for r in docs if r["own"] and r["lang"]]
    assert all(got[r["doc_id"]]["held_out"] == r["own"] for r in docs)
    assert len(held_out) > 30 and np.mean(held_out) > 0.95


def test_registered():
    names = set(registered.queries())
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14)) and set(QUERIES) <= names
