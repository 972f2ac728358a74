"""The metric model: dimensions and measures of the business views, with their other names."""

from __future__ import annotations

# View -> dimension -> synonyms. A dimension is the column of the same name.
DIMENSIONS: dict[str, dict[str, tuple[str, ...]]] = {
    "POLICIES": {
        "policy_number": (),
        "broker_name": ("broker", "agency"),
        "broker_code": (),
        "customer_name": ("insured", "client"),
        "customer_segment": ("segment",),
        "risk_tier": (),
        "product_line": ("product", "line of business", "lob", "coverage"),
        "is_active": ("in force", "active"),
        "effective_date": ("start date", "inception"),
        "expiry_date": ("end date", "renewal"),
    },
    "CLAIMS": {
        "claim_number": (),
        "claim_status": ("status",),
        "policy_number": (),
        "broker_name": (),
        "product_line": (),
        "customer_name": (),
        "loss_date": ("date of loss",),
        "reported_date": (),
    },
    "BROKER_PERFORMANCE": {"broker_code": (), "broker_name": ()},
    "INGESTION_HEALTH": {"broker_code": (), "record_type": (), "ingest_status": ("health", "status")},
    "VALIDATION_SUMMARY": {"entity": (), "rule_id": (), "rule_description": (), "severity": ()},
}

# View -> measure -> (aggregate, column, synonyms).
MEASURES: dict[str, dict[str, tuple[str, str, tuple[str, ...]]]] = {
    "POLICIES": {
        "policy_count": ("count", "policy_number", ("number of policies", "policy volume")),
        "total_premium": ("sum", "premium_amount", ("premium revenue", "gwp", "gross written premium")),
        "avg_premium": ("avg", "premium_amount", ()),
        "total_sum_insured": ("sum", "sum_insured", ("exposure", "tiv")),
        "avg_anomaly_score": ("avg", "anomaly_score", ()),
    },
    "CLAIMS": {
        "claim_count": ("count", "claim_number", ("number of claims", "claim volume")),
        "total_claims": ("sum", "claim_amount", ("claims paid", "incurred")),
        "avg_claim": ("avg", "claim_amount", ()),
        "avg_reporting_lag": ("avg", "reporting_lag_days", ("reporting delay",)),
    },
    "BROKER_PERFORMANCE": {
        "policy_count": ("sum", "policy_count", ()),
        "total_premium": ("sum", "total_premium", ()),
        "total_claims_amount": ("sum", "total_claims_amount", ()),
        "loss_ratio": ("avg", "loss_ratio", ("loss ratio", "claims ratio")),
    },
    "INGESTION_HEALTH": {
        "rows_landed": ("sum", "rows_landed", ()),
        "seconds_since_last": ("max", "seconds_since_last", ("lag", "staleness")),
    },
    "VALIDATION_SUMMARY": {
        "failure_count": ("sum", "failure_count", ("errors", "validation errors", "failures")),
    },
}
