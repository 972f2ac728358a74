"""Promotion of checked staging rows into dimensions and facts.

Surrogate keys are hashes of business keys, so most of them are computed in the row instead of being
looked up: promoting policies takes no join at all.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brokerflow.config.brokers import BROKERS
from brokerflow.config.canonical import PRODUCT_LINES
from brokerflow.functions.cleaning import days_between
from brokerflow.functions.keys import customer_id, surrogate_key
from brokerflow.functions.sqltext import text
from brokerflow.functions.text import customer_segment, risk_tier
from brokerflow.operators.upsert import REPEATED, insert_only, latest_per_key, upsert

POLICY_UPDATES = [
    "premium_amount", "sum_insured", "effective_date", "expiry_date", "product_line", "policy_term_days",
    "is_active", "customer_key", "broker_key", "product_key",
]
CLAIM_UPDATES = ["claim_status", "claim_amount", "reported_date", "reporting_lag_days", "sentiment_score"]


def _of_broker(attribute: str, default: str) -> str:
    cases = " ".join(f"WHEN {text(b.code)} THEN {text(getattr(b, attribute))}" for b in BROKERS.values())
    return f"CASE broker_code {cases} ELSE {default} END"


def broker_rows(policies: DataFrame, claims: DataFrame) -> DataFrame:
    """Every broker code of staging, each table collapsed before they meet.

    A broker that is not configured is named by its code.
    """
    codes = policies.select("broker_code").distinct().union(claims.select("broker_code").distinct()).distinct()
    return codes.where(F.col("broker_code").isNotNull()).select(
        surrogate_key(F.col("broker_code")).alias("broker_key"),
        "broker_code",
        F.expr(f"{_of_broker('display_name', 'broker_code')} AS broker_name"),
        F.expr(f"{_of_broker('format', 'NULL')} AS source_format"),
    )


def dim_broker(existing: DataFrame | None, rows: DataFrame) -> DataFrame:
    return upsert(existing, rows, ["broker_code"], [], ["broker_key", "broker_name", "source_format"]).select(
        *rows.columns
    )


def customer_rows(promotable: DataFrame) -> DataFrame:
    """One row per distinct customer with segment and risk tier from the customer's totals."""
    per_customer = (
        promotable.where(F.col("customer_name").isNotNull())
        .groupBy(customer_id(F.col("customer_name")).alias("customer_id"))
        .agg(
            F.min("customer_name").alias("customer_name"),
            F.sum("premium_amount").alias("premium"),
            F.sum("sum_insured").alias("insured"),
            F.max("sum_insured").alias("largest"),
        )
    )
    return per_customer.select(
        surrogate_key(F.col("customer_id")).alias("customer_key"),
        "customer_id",
        "customer_name",
        customer_segment(F.col("customer_name"), F.col("largest")).alias("customer_segment"),
        risk_tier(F.col("premium"), F.col("insured")).alias("risk_tier"),
    )


def new_customers(existing: DataFrame | None, rows: DataFrame) -> DataFrame:
    """The customers to append: a profile once made stays."""
    return insert_only(existing, rows, ["customer_id"])


def product_rows(spark: SparkSession) -> DataFrame:
    lines = spark.createDataFrame([(line,) for line in PRODUCT_LINES], "product_line string")
    return lines.select(
        surrogate_key(F.col("product_line")).alias("product_key"),
        "product_line",
        F.concat("product_line", F.lit(" insurance")).alias("description"),
    )


def policy_rows(promotable: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per policy number, the latest delivery winning."""
    latest = latest_per_key(
        promotable.select(
            "policy_number", "broker_code", "customer_name", "product_line", "premium_amount", "sum_insured",
            "effective_date", "expiry_date", "loaded_at", "stg_id",
        ),
        ["policy_number"],
        ["loaded_at", "stg_id"],
    )
    known_line = F.when(F.col("product_line").isin(*PRODUCT_LINES), F.col("product_line"))
    return latest.select(
        surrogate_key(F.col("policy_number")).alias("policy_key"),
        "policy_number",
        surrogate_key(F.col("broker_code")).alias("broker_key"),
        surrogate_key(customer_id(F.col("customer_name"))).alias("customer_key"),
        surrogate_key(known_line).alias("product_key"),
        "product_line",
        "premium_amount",
        "sum_insured",
        "effective_date",
        "expiry_date",
        days_between(F.col("effective_date"), F.col("expiry_date")).alias("policy_term_days"),
        F.lit(as_of).between(F.col("effective_date"), F.col("expiry_date")).alias("is_active"),
        F.lit(None).cast("double").alias("anomaly_score"),
        F.lit(None).cast("string").alias("anomaly_reason"),
        "loaded_at",
    )


def dim_policy(existing: DataFrame | None, rows: DataFrame) -> DataFrame:
    """Overwrites the attributes of a known policy; its anomaly columns are left alone."""
    inserted = [c for c in rows.columns if c != "policy_number"]
    return upsert(existing, rows, ["policy_number"], POLICY_UPDATES, inserted).select(*rows.columns)


def premium_rows(policies: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Premium facts to append, of the policies that have none yet.

    A later change of a policy does not alter its fact. Every policy gets its fact in the batch that
    brings it, so the policies of the batch are enough as input.
    """
    new = insert_only(existing, policies.where(F.col("policy_key").isNotNull()), ["policy_key"])
    return new.select(
        surrogate_key(F.lit("premium"), F.col("policy_key")).alias("premium_key"),
        "policy_key", "broker_key", "customer_key", "product_key", "effective_date", "premium_amount",
        "sum_insured", "loaded_at",
    )


def claim_rows(promotable: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """One row per claim number, the latest delivery winning. Takes claims with their policy keys, and keeps the ``carried`` columns.

    Only claims whose number comes again are dealt out, if ``upsert.with_repeats`` has told them apart.
    """
    latest = latest_per_key(
        promotable.select(
            "claim_number", "policy_key", "broker_key", "customer_key", "product_key", "loss_date", "reported_date",
            "reporting_lag_days", "claim_amount", "claim_status", "loss_description", "sentiment_score",
            "loaded_at", "stg_id", *carried, *[c for c in promotable.columns if c == REPEATED],
        ),
        ["claim_number"],
        ["loaded_at", "stg_id"],
    )
    return latest.select(
        surrogate_key(F.col("claim_number")).alias("claim_key"),
        *[c for c in latest.columns if c not in ("loaded_at", "stg_id")],
        F.lit(None).cast("double").alias("anomaly_score"),
        F.lit(None).cast("string").alias("anomaly_reason"),
        "loaded_at",
    )


def fact_claim(existing: DataFrame | None, rows: DataFrame) -> DataFrame:
    """Updates status, amount, report date, lag and sentiment of a known claim, nothing else."""
    inserted = [c for c in rows.columns if c != "claim_number"]
    return upsert(existing, rows, ["claim_number"], CLAIM_UPDATES, inserted).select(*rows.columns)
