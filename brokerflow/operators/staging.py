"""Landing rows to typed, cleaned staging rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brokerflow.functions import cleaning, keys
from brokerflow.functions.text import claim_sentiment, classify_product
from brokerflow.operators.mapping import project_canonical


def stage_policies(raw: DataFrame, registry: DataFrame, classify: bool = True) -> DataFrame:
    """Typed policies. ``classify=False`` leaves product_line empty, to be set after the checks."""
    text = project_canonical(raw, registry, "policy")
    line = classify_product(F.trim("product_name")) if classify else F.lit(None).cast("string")
    return text.select(
        keys.staged_id(F.col("raw_id")).alias("stg_id"),
        "raw_id",
        "broker_code",
        cleaning.trimmed(F.col("policy_number")).alias("policy_number"),
        cleaning.trimmed(F.col("customer_name")).alias("customer_name"),
        cleaning.trimmed(F.col("product_name")).alias("product_name"),
        line.alias("product_line"),
        cleaning.parse_money(F.col("premium_amount")).alias("premium_amount"),
        cleaning.parse_money(F.col("sum_insured")).alias("sum_insured"),
        cleaning.parse_date(F.col("effective_date")).alias("effective_date"),
        cleaning.parse_date(F.col("expiry_date")).alias("expiry_date"),
        cleaning.trimmed(F.col("broker_agent")).alias("broker_agent"),
        "mapping_source",
        "mapping_confidence",
        F.col("ingested_at").alias("loaded_at"),
    )


def stage_claims(raw: DataFrame, registry: DataFrame, score: bool = True) -> DataFrame:
    """Typed claims with the reporting lag and the tone of the narrative.

    ``score=False`` leaves the tone empty, to be set after the checks.
    """
    text = project_canonical(raw, registry, "claim")
    typed = text.select(
        keys.staged_id(F.col("raw_id")).alias("stg_id"),
        "raw_id",
        "broker_code",
        cleaning.trimmed(F.col("claim_number")).alias("claim_number"),
        cleaning.trimmed(F.col("policy_number")).alias("policy_number"),
        cleaning.parse_date(F.col("loss_date")).alias("loss_date"),
        cleaning.parse_date(F.col("reported_date")).alias("reported_date"),
        cleaning.parse_money(F.col("claim_amount")).alias("claim_amount"),
        cleaning.upper_code(F.col("claim_status")).alias("claim_status"),
        "loss_description",
        F.col("ingested_at").alias("loaded_at"),
    )
    return typed.select(
        *typed.columns[:-1],
        cleaning.days_between(F.col("loss_date"), F.col("reported_date")).alias("reporting_lag_days"),
        (claim_sentiment(F.col("loss_description")) if score else F.lit(None).cast("double")).alias("sentiment_score"),
        "loaded_at",
    )


def unprocessed(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """Landing rows that have not been staged yet. Both sides are unique on raw_id."""
    return raw.join(staged.select("raw_id"), "raw_id", "left_anti")
