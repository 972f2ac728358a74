"""Aggregations behind the report pages. Only the aggregated rows leave the cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerflow.operators.anomaly import FLAG_FROM
from brokerflow.plans.metrics import Catalog


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column).cast("double"), F.lit(0.0))


def _beside(*one_row_frames: DataFrame) -> DataFrame:
    """One-row frames side by side: stacked, then each column's only value taken. No join."""
    first, *others = one_row_frames
    stacked = first
    for other in others:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def _failures(catalog: Catalog) -> DataFrame:
    """ERROR and WARN failure totals."""
    summary = catalog["VALIDATION_SUMMARY"](["severity", "failure_count"])

    def of(severity: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("severity") == severity, F.col("failure_count"))), F.lit(0))

    return summary.agg(of("ERROR").alias("validation_errors"), of("WARN").alias("validation_warnings"))


def portfolio_kpis(catalog: Catalog) -> DataFrame:
    """Volumes, premium, claims, loss ratio (0 without premium) and failure totals."""
    policies = catalog["POLICIES"](["premium_amount"]).agg(
        F.count("*").alias("policy_volume"), _total("premium_amount").alias("premium_revenue")
    )
    claims = catalog["CLAIMS"](["claim_amount"]).agg(
        F.count("*").alias("claim_volume"), _total("claim_amount").alias("total_claims")
    )
    return _beside(policies, claims, _failures(catalog)).withColumn(
        "loss_ratio",
        F.when(F.col("premium_revenue") != 0, F.col("total_claims") / F.col("premium_revenue")).otherwise(0.0),
    )


def claims_by_status(catalog: Catalog) -> DataFrame:
    return (
        catalog["CLAIMS"](["claim_status", "claim_amount"])
        .groupBy("claim_status")
        .agg(F.count("*").alias("claim_count"), _total("claim_amount").alias("total_amount"))
    )


def broker_leaderboard(catalog: Catalog) -> DataFrame:
    """Brokers by premium, with the loss ratio in percent."""
    rows = catalog["BROKER_PERFORMANCE"](
        ["broker_name", "policy_count", "total_premium", "claim_count", "total_claims_amount", "loss_ratio"]
    )
    return rows.select(
        "broker_name",
        "policy_count",
        "total_premium",
        "claim_count",
        "total_claims_amount",
        F.round(F.col("loss_ratio") * 100, 1).alias("loss_ratio_pct"),
    ).orderBy(F.desc("total_premium"), "broker_name")


def health_counts(catalog: Catalog) -> DataFrame:
    """Rows landed and number of streams per status, overall."""
    rows = catalog["INGESTION_HEALTH"](["rows_landed", "ingest_status"])
    return rows.agg(
        F.coalesce(F.sum("rows_landed"), F.lit(0)).alias("rows_landed"),
        F.count_if(F.col("ingest_status") == "HEALTHY").alias("healthy"),
        F.count_if(F.col("ingest_status") == "LAGGING").alias("lagging"),
        F.count_if(F.col("ingest_status") == "STALE").alias("stale"),
    )


def rows_by_broker(catalog: Catalog) -> DataFrame:
    rows = catalog["INGESTION_HEALTH"](["broker_code", "rows_landed"])
    return rows.groupBy("broker_code").agg(F.sum("rows_landed").alias("rows_landed"))


def broker_drilldown(catalog: Catalog, broker_name: str | None = None) -> DataFrame:
    """Figures of one broker, or of all; the ratio divides by at least 1."""
    rows = catalog["BROKER_PERFORMANCE"](
        ["broker_name", "policy_count", "total_premium", "claim_count", "total_claims_amount"]
    )
    if broker_name is not None:
        rows = rows.where(F.col("broker_name") == broker_name)
    return rows.agg(
        F.coalesce(F.sum("policy_count"), F.lit(0)).alias("policies"),
        _total("total_premium").alias("premium"),
        F.coalesce(F.sum("claim_count"), F.lit(0)).alias("claims"),
        _total("total_claims_amount").alias("claims_amount"),
    ).withColumn("loss_ratio", F.col("claims_amount") / F.greatest(F.col("premium"), F.lit(1.0)))


def premium_vs_claims(catalog: Catalog) -> DataFrame:
    """Premium and claims of each broker, one row per measure."""
    rows = catalog["BROKER_PERFORMANCE"](["broker_name", "total_premium", "total_claims_amount"])
    return rows.unpivot(["broker_name"], ["total_premium", "total_claims_amount"], "measure", "amount")


def product_mix(catalog: Catalog, broker_name: str | None = None) -> DataFrame:
    rows = catalog["POLICIES"](["broker_name", "product_line", "premium_amount"])
    if broker_name is not None:
        rows = rows.where(F.col("broker_name") == broker_name)
    return rows.groupBy("broker_name", "product_line").agg(_total("premium_amount").alias("premium"))


def quality_kpis(catalog: Catalog) -> DataFrame:
    """Failure totals and the numbers of outlying policies and claims."""

    def outliers(view: str, name: str) -> DataFrame:
        rows = catalog[view](["anomaly_score"])
        return rows.agg(F.count_if(F.col("anomaly_score") >= FLAG_FROM).alias(name))

    return _beside(
        _failures(catalog), outliers("POLICIES", "anomalous_policies"), outliers("CLAIMS", "anomalous_claims")
    )


def failures_by_severity(catalog: Catalog) -> DataFrame:
    rows = catalog["VALIDATION_SUMMARY"](["entity", "severity", "failure_count"])
    return rows.groupBy("entity", "severity").agg(F.sum("failure_count").alias("failure_count"))


def failures_by_rule(catalog: Catalog) -> DataFrame:
    rows = catalog["VALIDATION_SUMMARY"](["entity", "rule_id", "rule_description", "severity", "failure_count"])
    return rows.orderBy(F.desc("failure_count"), "rule_id")


def top_anomalies(catalog: Catalog, k: int = 10) -> DataFrame:
    rows = catalog["POLICIES"](["policy_number", "broker_name", "product_line", "premium_amount", "anomaly_score"])
    return rows.orderBy(F.col("anomaly_score").desc_nulls_last(), "policy_number").limit(k)
