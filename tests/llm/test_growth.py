"""Texts are not dealt out to drop a few rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from brokerflow.llm import exact, near
from tests.llm.samples import frame


def dealt(df) -> bool:
    return "Exchange hashpartitioning" in df._jdf.queryExecution().executedPlan().toString()


def test_exact_copies_go_without_dealing_texts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = exact.single(frame(spark, [(1, "a"), (2, "a"), (3, "b"), (None, "b"), (None, "c")]))
        assert not dealt(kept)
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [(1, "a"), (3, "b"), (None, "c")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sets_are_dealt_out_once_and_texts_never(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans, components = [], near.components

    def linked(links, group):
        plans.append(links._jdf.queryExecution().executedPlan().toString())
        return components(links, group)

    monkeypatch.setattr(near, "components", linked)
    words = [f"w{i}" for i in range(60)]
    held = [(1, " ".join(words)), (2, " ".join(words[:-1])), (3, "something else that is of more than five words")]
    try:
        assert [(r.doc_id, r.component_id) for r in near.copies(frame(spark, held)).collect()] == [(2, 1)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [plan.count("Exchange hashpartitioning") for plan in plans] == [1]


def test_too_many_rows_to_broadcast_are_dealt_out(spark, no_broadcast):
    words = " ".join(f"w{i}" for i in range(60))
    docs = frame(spark, [(1, words), (2, words), (3, words + " x"), (4, "b")])
    single = exact.single(docs)
    assert sorted(r.doc_id for r in single.collect()) == [1, 3, 4]
    assert sorted(r.doc_id for r in near.apart(single).collect()) == [1, 4]
    assert single.agg(F.count("*")).first()[0] == 3
