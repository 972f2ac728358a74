from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from brokerflow.config.brokers import BROKERS
from brokerflow.functions import cleaning, keys, text
from brokerflow.operators import mapping
from brokerflow.operators.staging import stage_claims, stage_policies, unprocessed
from tests.test_mapping import raw


def one(spark, expression, value, type_="string"):
    return spark.createDataFrame([(value,)], f"v {type_}").select(expression(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize(
    "written, amount",
    [("$1,240.00", "1240.00"), ("USD 12.5", "12.50"), ("£ -7", "-7.00"), ("12.345", "12.35"), ("n/a", None), ("", None),
     (None, None), ("1-2", None), ("30000000.1", "30000000.10")],
)
def test_money(spark, written, amount):
    assert one(spark, cleaning.parse_money, written) == (Decimal(amount) if amount else None)


@pytest.mark.parametrize(
    "written, date",
    [("2025-01-31", dt.date(2025, 1, 31)), ("31/01/2025", dt.date(2025, 1, 31)), ("01/31/2025", dt.date(2025, 1, 31)),
     ("03/04/2025", dt.date(2025, 4, 3)), ("05-Mar-2025", dt.date(2025, 3, 5)), ("soon", None), ("", None), (None, None),
     ("2025-02-30", None)],
)
def test_dates(spark, written, date):
    assert one(spark, cleaning.parse_date, written) == date


def test_codes_and_names(spark):
    assert one(spark, cleaning.upper_code, " in_review ") == "IN_REVIEW"
    assert one(spark, cleaning.trimmed, "  a b ") == "a b"
    assert one(spark, keys.customer_id, " ann ") == one(spark, keys.customer_id, "ANN")
    assert one(spark, keys.surrogate_key, None) is None


@pytest.mark.parametrize(
    "product, line",
    [("Private Motor", "AUTO"), ("Buildings & Contents", "HOME"), ("Whole of Life", "LIFE"), ("PMI", "HEALTH"),
     ("Worldwide Travel", "TRAVEL"), ("Commercial Combined", "COMMERCIAL"), ("Goods in Transit", "MARINE"),
     ("Marine Cargo", "MARINE"), ("Carpet", "OTHER"), (None, "OTHER")],
)
def test_product_lines(spark, product, line):
    assert one(spark, text.classify_product, product) == line


@pytest.mark.parametrize(
    "narrative, score",
    [("Minor damage, repaired quickly", 0.5), ("Fire and flood", -1.0), ("Nothing to say", 0.0), ("  ", None), (None, None)],
)
def test_sentiment(spark, narrative, score):
    assert one(spark, text.claim_sentiment, narrative) == score


def test_stage_a_policy_and_a_claim(spark):
    policy = {"policyId": " P1 ", "insuredName": "Ann ", "coverageType": "Term Life", "annualPremium": 20000000.5,
              "inceptionDate": "01/02/2025", "renewalDate": "2026-02-01", "insuredValue": 0, "producerCode": None}
    claim = {"CLM_ID": "C1", "POL_ID": "P1", "DOL": "01/02/2025", "RPT_DT": "11-Feb-2025", "RESERVE": "USD 5", "STAT": " open",
             "REMARKS": "fire"}
    rows = raw(spark, ("BRK_BETA", "policy", policy), ("BRK_GAMMA", "claim", claim))
    seeds = mapping.seed_mappings(spark)
    (p,) = stage_policies(rows.where("record_type = 'policy'"), seeds).collect()
    assert (p.policy_number, p.customer_name, p.product_line) == ("P1", "Ann", "LIFE")
    assert (p.premium_amount, p.sum_insured) == (Decimal("20000000.50"), Decimal("0.00"))
    assert (p.effective_date, p.expiry_date) == (dt.date(2025, 2, 1), dt.date(2026, 2, 1))
    assert (p.mapping_source, p.mapping_confidence) == ("seed", 1.0)
    assert stage_policies(rows.where("record_type = 'policy'"), seeds, classify=False).first().product_line is None

    (c,) = stage_claims(rows.where("record_type = 'claim'"), seeds).collect()
    assert (c.claim_status, c.claim_amount, c.reporting_lag_days, c.sentiment_score) == ("OPEN", Decimal("5.00"), 10, -1.0)


def test_only_unstaged_rows_are_left(spark):
    rows = raw(spark, *[("BRK_BETA", "policy", {h: "1" for h in BROKERS["BRK_BETA"].headers["policy"]}) for _ in range(3)])
    assert [r.raw_id for r in unprocessed(rows, rows.where("raw_id <> 'r1'")).collect()] == ["r1"]
