"""The data-quality rule set.

Row rules are Spark SQL predicates over one staged record. ``as_of`` stands for the run date.
``policy_exists``, ``policy_copies`` and ``premium_distance`` are columns that the referential,
batch and anomaly operators attach before the rules are evaluated.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    rule_id: str
    entity: str
    description: str
    severity: str
    expression: str
    columns: tuple[str, ...]
    rule_type: str = "expression"
    explain: bool = True
    active: bool = True


SEVERITIES = ("ERROR", "WARN", "INFO")

# Rule ids, descriptions, severities and thresholds.
RULES: tuple[Rule, ...] = (
    Rule("POL_001", "policy", "Policy number must be present", "ERROR",
         "policy_number IS NOT NULL AND trim(policy_number) <> ''", ("policy_number",)),
    Rule("POL_002", "policy", "Premium must be a positive number", "ERROR",
         "premium_amount IS NOT NULL AND premium_amount > 0", ("premium_amount",)),
    Rule("POL_003", "policy", "Premium within plausible range (0 < premium <= 1,000,000)", "WARN",
         "premium_amount > 0 AND premium_amount <= 1000000", ("premium_amount",)),
    Rule("POL_004", "policy", "Effective date must be on or before expiry date", "ERROR",
         "effective_date <= expiry_date", ("effective_date", "expiry_date")),
    Rule("POL_005", "policy", "Policy term should not exceed 5 years", "WARN",
         "datediff(expiry_date, effective_date) <= 1830", ("effective_date", "expiry_date")),
    Rule("POL_006", "policy", "Customer name present (required for KYC)", "ERROR",
         "customer_name IS NOT NULL AND length(trim(customer_name)) >= 2", ("customer_name",)),
    Rule("POL_007", "policy", "Sum insured should be >= premium (sanity check)", "WARN",
         "sum_insured IS NULL OR sum_insured >= premium_amount", ("sum_insured", "premium_amount")),
    Rule("POL_008", "policy", "Product line resolved to a known class", "WARN",
         "product_line IN ('AUTO','HOME','LIFE','HEALTH','TRAVEL','COMMERCIAL','MARINE','OTHER')",
         ("product_line",)),
    Rule("CLM_001", "claim", "Claim number must be present", "ERROR",
         "claim_number IS NOT NULL AND trim(claim_number) <> ''", ("claim_number",)),
    Rule("CLM_002", "claim", "Claim must reference a policy number", "ERROR",
         "policy_number IS NOT NULL AND trim(policy_number) <> ''", ("policy_number",)),
    Rule("CLM_003", "claim", "Claim amount must be zero or positive", "ERROR",
         "claim_amount IS NOT NULL AND claim_amount >= 0", ("claim_amount",)),
    Rule("CLM_004", "claim", "Loss date cannot be in the future", "ERROR",
         "loss_date <= as_of", ("loss_date",)),
    Rule("CLM_005", "claim", "Reported date must be on or after loss date", "ERROR",
         "reported_date >= loss_date", ("loss_date", "reported_date")),
    Rule("CLM_006", "claim", "Reporting lag should be <= 365 days (late-notification flag)", "WARN",
         "datediff(reported_date, loss_date) <= 365", ("loss_date", "reported_date")),
    Rule("CLM_007", "claim", "Claim status must be a recognized value", "WARN",
         "claim_status IN ('OPEN','IN_REVIEW','APPROVED','PAID','DENIED','CLOSED','WITHDRAWN')",
         ("claim_status",)),
    Rule("CLM_008", "claim", "Referenced policy must exist in ANALYTICS (referential integrity)",
         "ERROR", "policy_exists", ("policy_number",), "referential"),
    Rule("BATCH_001", "policy", "Duplicate policy numbers within a single broker batch", "WARN",
         "policy_copies = 1", ("broker_code", "policy_number"), "batch"),
    Rule("BATCH_002", "policy", "Premium anomaly (z-score > 3 vs broker/product history)", "WARN",
         "premium_distance IS NULL OR premium_distance <= 3", ("premium_amount",), "anomaly"),
)


def rules_for(entity: str, *types: str) -> list[Rule]:
    """Active rules of an entity, limited to the given rule types (all when none is given)."""
    return [r for r in RULES if r.entity == entity and r.active and (not types or r.rule_type in types)]
