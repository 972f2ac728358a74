from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brokerflow.operators import inference, star
from brokerflow.operators.anomaly import score_claims, score_outliers, score_policies
from brokerflow.operators.upsert import insert_only, latest_per_key, upsert
from brokerflow.plans.scratch import settle
from tests.test_quality import POLICY, POLICY_SCHEMA

AS_OF = dt.date(2025, 6, 30)


def staged(spark, *changes):
    base = {**POLICY, "loaded_at": dt.datetime(2025, 1, 1)}
    rows = [tuple({**base, "stg_id": f"s{i}", **c}.values()) for i, c in enumerate(changes)]
    return spark.createDataFrame(rows, POLICY_SCHEMA + ", loaded_at timestamp_ntz")


@pytest.mark.parametrize("limit", [10**9, -1], ids=["broadcast", "shuffle"])
def test_upsert(spark, monkeypatch, limit):
    monkeypatch.setattr("brokerflow.plans.scratch.BROADCAST_BYTES", limit)
    schema = "k string, a int, b int"
    target = spark.createDataFrame([("x", 1, 1), ("y", 2, 2), ("w", None, 5)], schema)
    source = spark.createDataFrame([("y", 20, None), ("z", 30, 30), ("w", None, 50)], schema)

    def merged(updates, inserts):
        return sorted(tuple(r) for r in upsert(target, source, ["k"], updates, inserts).collect())

    assert merged(["b"], ["a", "b"]) == [("w", None, 50), ("x", 1, 1), ("y", 2, None), ("z", 30, 30)]
    assert merged([], ["a", "b"]) == [("w", None, 5), ("x", 1, 1), ("y", 2, 2), ("z", 30, 30)]
    assert merged(["a", "b"], ["a"]) == [("w", None, 50), ("x", 1, 1), ("y", 20, None), ("z", 30, None)]
    assert upsert(None, source, ["k"], ["a"], ["a", "b"]).count() == 3


def test_latest_row_wins_and_ties_break_by_id(spark):
    rows = spark.createDataFrame(
        [("p", 1, "a", None), ("p", 2, "a", "new"), ("p", 2, "b", None), ("q", 1, "a", "only")], "k string, at int, id string, v string"
    )
    kept = {r.k: (r.at, r.id, r.v) for r in latest_per_key(rows, ["k"], ["at", "id"]).collect()}
    assert kept == {"p": (2, "b", None), "q": (1, "a", "only")}


def test_policy_rows(spark):
    rows = staged(
        spark,
        {"policy_number": "P1", "loaded_at": dt.datetime(2025, 1, 2), "premium_amount": Decimal("7.00")},
        {"policy_number": "P1"},
        {"policy_number": "P2", "effective_date": dt.date(2026, 1, 1), "product_line": "ODD", "customer_name": None},
    )
    out = {r.policy_number: r for r in star.policy_rows(rows, AS_OF).collect()}
    assert len(out) == 2
    assert (out["P1"].premium_amount, out["P1"].policy_term_days, out["P1"].is_active) == (Decimal("7.00"), 365, True)
    assert out["P2"].is_active is False
    assert out["P2"].product_key is None and out["P2"].product_line == "ODD"
    assert out["P2"].customer_key is None
    products = {r.product_line: r.product_key for r in star.product_rows(spark).collect()}
    assert out["P1"].product_key == products["AUTO"]


def test_dim_policy_update_leaves_scores_alone(spark):
    first = star.policy_rows(staged(spark, {}), AS_OF).withColumn("anomaly_score", F.lit(0.7))
    later = staged(spark, {"premium_amount": Decimal("9.00")}, {"policy_number": "P2"})
    out = {r.policy_number: r for r in star.dim_policy(settle(first, "t"), star.policy_rows(later, AS_OF)).collect()}
    assert (out["P1"].premium_amount, out["P1"].anomaly_score) == (Decimal("9.00"), 0.7)
    assert out["P2"].anomaly_score is None


def test_customers_are_one_per_normalised_name_and_insert_only(spark):
    rows = staged(spark, {"customer_name": "ann"}, {"customer_name": "ANN"}, {"customer_name": "Bob Holdings"})
    out = {r.customer_name: r for r in star.customer_rows(rows).collect()}
    assert set(out) == {"ANN", "Bob Holdings"}
    assert out["Bob Holdings"].customer_segment == "CORPORATE"
    assert out["ANN"].customer_segment == "RETAIL"
    assert out["ANN"].risk_tier == "HIGH"  # 200 of premium on 2,000 insured
    kept = settle(star.customer_rows(rows).withColumn("risk_tier", F.lit("LOW")), "c")
    assert star.new_customers(kept, star.customer_rows(rows)).count() == 0
    more = staged(spark, {"customer_name": "ann"}, {"customer_name": "Cid"})
    assert [r.customer_name for r in star.new_customers(kept, star.customer_rows(more)).collect()] == ["Cid"]


def test_brokers(spark):
    rows = staged(spark, {"broker_code": "BRK_BETA"}, {"broker_code": "NEW"}, {"broker_code": None})
    out = {r.broker_code: r for r in star.broker_rows(rows, rows).collect()}
    assert set(out) == {"BRK_BETA", "NEW"}
    assert (out["BRK_BETA"].broker_name, out["BRK_BETA"].source_format) == ("Beta Risk Partners", "json")
    assert (out["NEW"].broker_name, out["NEW"].source_format) == ("NEW", None)


def test_premium_facts_are_appended_once(spark):
    first = star.policy_rows(staged(spark, {}), AS_OF)
    facts = settle(star.premium_rows(first, None), "facts")
    later = star.policy_rows(staged(spark, {"premium_amount": Decimal("9.00")}, {"policy_number": "P2"}), AS_OF)
    new = star.premium_rows(later, facts).collect()
    assert [r.premium_amount for r in new] == [Decimal("100.00")]
    assert new[0].policy_key == later.where("policy_number = 'P2'").first().policy_key


def claim(number, amount, status="OPEN", product="AUTO", **more):
    row = {
        "claim_number": number, "policy_key": "p", "broker_key": "b", "customer_key": "c", "product_key": product,
        "loss_date": dt.date(2025, 1, 1), "reported_date": dt.date(2025, 1, 2), "reporting_lag_days": 1,
        "claim_amount": amount and Decimal(amount), "claim_status": status, "loss_description": "text", "sentiment_score": 0.5,
        "loaded_at": dt.datetime(2025, 1, 1), "stg_id": "s",
    }
    return tuple({**row, **more}.values())


CLAIM_SCHEMA = (
    "claim_number string, policy_key string, broker_key string, customer_key string, product_key string, loss_date date, "
    "reported_date date, reporting_lag_days int, claim_amount decimal(18,2), claim_status string, loss_description string, "
    "sentiment_score double, loaded_at timestamp_ntz, stg_id string"
)


def test_claim_fact_updates_its_five_columns_only(spark):
    first = star.claim_rows(spark.createDataFrame([claim("C1", "5")], CLAIM_SCHEMA))
    change = claim("C1", "6", "PAID", loss_date=dt.date(2024, 1, 1), policy_key="other", reporting_lag_days=9)
    (row,) = star.fact_claim(settle(first, "f"), star.claim_rows(spark.createDataFrame([change], CLAIM_SCHEMA))).collect()
    assert (row.claim_status, row.claim_amount, row.reporting_lag_days) == ("PAID", Decimal("6.00"), 9)
    assert (row.policy_key, row.loss_date) == ("p", dt.date(2025, 1, 1))


@pytest.mark.parametrize("limit", [10**9, -1], ids=["broadcast", "shuffle"])
def test_scores_against_pandas(spark, monkeypatch, limit):
    monkeypatch.setattr("brokerflow.plans.scratch.BROADCAST_BYTES", limit)
    amounts = [(f"C{i}", str(100 + i % 7), "A" if i % 2 else None) for i in range(30)] + [("BIG", "9000", "A"), ("ONE", "5", "B")]
    rows = spark.createDataFrame([claim(n, a, product=g) for n, a, g in amounts] + [claim("NULL", None, product="A")], CLAIM_SCHEMA)
    facts = star.claim_rows(rows).withColumn("anomaly_score", F.lit(0.25)).withColumn("anomaly_reason", F.lit("old"))
    got = {r.claim_number: r for r in score_claims(facts).collect()}

    frame = pd.DataFrame(amounts, columns=["n", "x", "g"]).astype({"x": float}).fillna({"g": "~"})
    peers = frame.groupby("g")["x"]
    frame["score"] = ((frame.x - peers.transform("mean")).abs() / peers.transform("std") / 3).clip(upper=1)
    for n, score in zip(frame.n, frame.score):
        if n == "ONE":  # a group of one keeps the score it had
            assert (got[n].anomaly_score, got[n].anomaly_reason) == (0.25, "old")
        else:
            assert got[n].anomaly_score == pytest.approx(score)
    assert got["NULL"].anomaly_score is None and got["NULL"].anomaly_reason is None
    assert got["BIG"].anomaly_reason.startswith("amount 9000.00 against a mean of ")
    assert got["C1"].anomaly_reason is None


def test_flag_threshold(spark):
    """Eleven rows are the fewest that reach the default threshold."""
    for n, wanted in ((10, 0), (11, 1)):
        rows = staged(spark, *[{"policy_number": f"P{i}", "premium_amount": Decimal(1000 if i == 0 else 1)} for i in range(n)])
        scored = score_policies(star.policy_rows(rows, AS_OF))
        assert scored.where("anomaly_reason IS NOT NULL").count() == wanted
        assert score_policies(star.policy_rows(rows, AS_OF), 0.5).where("anomaly_reason IS NOT NULL").count() == 1


def test_equal_amounts_keep_their_score(spark):
    rows = star.policy_rows(staged(spark, {"policy_number": "A"}, {"policy_number": "B"}), AS_OF)
    scored = score_outliers(rows.withColumn("anomaly_score", F.lit(0.5)), "premium_amount", ["broker_key"], "policy_key")
    assert {r.anomaly_score for r in scored.collect()} == {0.5}


OUT = T.StructType([T.StructField("length", T.LongType())])


def test_provider_sees_each_distinct_input_once(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "bb", "a", None, "ccc", "a"])], "id long, t string")
    cache = spark.createDataFrame([("ccc", 99)], "t string, length long")

    def provider(batch):
        assert batch["t"].is_unique and "ccc" not in set(batch["t"])
        return pd.DataFrame({"length": batch["t"].str.len().fillna(0).astype("Int64")})

    answered, known, log = inference.infer_distinct(rows, ["t"], provider, OUT, cache, ["id"], "count")
    assert {r.id: r.length for r in answered.collect()} == {0: 1, 1: 2, 2: 1, 3: 0, 4: 99, 5: 1}
    assert {r.t: r.length for r in known.collect()} == {"a": 1, "bb": 2, None: 0}
    again, nothing, _ = inference.infer_distinct(rows, ["t"], provider, OUT, cache.unionByName(known), ["id"], "count")
    assert nothing.count() == 0 and {r.id: r.length for r in again.collect()}[3] == 0
    calls = log.collect()
    assert all(c.success and c.task == "count" and c.latency_ms >= 0 for c in calls)


def test_failed_provider_calls_are_logged_and_not_cached(spark):
    rows = spark.createDataFrame([(1, "a")], "id long, t string")

    def provider(batch):
        raise RuntimeError("no answer")

    answered, known, log = inference.infer_distinct(rows, ["t"], provider, OUT, None, ["id"], attempts=2, most_failed=1.0)
    assert answered.first().length is None
    assert known.count() == 0
    assert [(c.success, c.inputs) for c in log.collect()] == [(False, 1)] * 2
    with pytest.raises(RuntimeError, match="no answer to 1 of 1"):
        inference.infer_distinct(rows, ["t"], provider, OUT, None, ["id"])


def test_null_keys_of_several_columns_are_answered(spark):
    rows = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, "a", "x"), (4, None, "x")], "id long, s string, t string")

    def provider(batch):
        return pd.DataFrame({"length": (batch["s"].fillna("") + batch["t"].fillna("")).str.len() + 10})

    answered, known, _ = inference.infer_distinct(rows, ["s", "t"], provider, OUT, None, ["id"])
    assert {r.id: r.length for r in answered.collect()} == {1: 11, 2: 10, 3: 12, 4: 11}
    assert known.count() == 3


@pytest.mark.parametrize("limit", [10**9, -1], ids=["broadcast", "shuffle"])
def test_only_unseen_rows_are_inserted(spark, monkeypatch, limit):
    monkeypatch.setattr("brokerflow.plans.scratch.BROADCAST_BYTES", limit)
    target = spark.createDataFrame([("x", 1), ("y", 2)], "k string, a int")
    source = spark.createDataFrame([("y", 20), ("z", 30)], "k string, a int")
    assert [tuple(r) for r in insert_only(target, source, ["k"]).collect()] == [("z", 30)]
    assert insert_only(None, source, ["k"]).count() == 2
