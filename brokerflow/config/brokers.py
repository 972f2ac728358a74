"""Known brokers: display name, wire format and header layout per record type."""

from __future__ import annotations

from typing import NamedTuple


class Broker(NamedTuple):
    code: str
    display_name: str
    format: str
    delimiter: str
    headers: dict[str, dict[str, str]]


# Broker codes, names, formats and their header -> canonical field layouts.
BROKERS: dict[str, Broker] = {
    "BRK_ALPHA": Broker(
        "BRK_ALPHA",
        "Alpha Insurance Brokers",
        "csv",
        ",",
        {
            "policy": {
                "Policy No": "policy_number",
                "Cust Name": "customer_name",
                "Product": "product_name",
                "Premium (USD)": "premium_amount",
                "Start": "effective_date",
                "End": "expiry_date",
                "Sum Insured": "sum_insured",
                "Agent": "broker_agent",
            },
            "claim": {
                "Claim Ref": "claim_number",
                "Policy No": "policy_number",
                "Loss Date": "loss_date",
                "Reported": "reported_date",
                "Claim Amt": "claim_amount",
                "Status": "claim_status",
                "Description": "loss_description",
            },
        },
    ),
    "BRK_BETA": Broker(
        "BRK_BETA",
        "Beta Risk Partners",
        "json",
        ",",
        {
            "policy": {
                "policyId": "policy_number",
                "insuredName": "customer_name",
                "coverageType": "product_name",
                "annualPremium": "premium_amount",
                "inceptionDate": "effective_date",
                "renewalDate": "expiry_date",
                "insuredValue": "sum_insured",
                "producerCode": "broker_agent",
            },
            "claim": {
                "claimId": "claim_number",
                "policyId": "policy_number",
                "dateOfLoss": "loss_date",
                "notifiedOn": "reported_date",
                "amountClaimed": "claim_amount",
                "claimState": "claim_status",
                "lossNarrative": "loss_description",
            },
        },
    ),
    "BRK_GAMMA": Broker(
        "BRK_GAMMA",
        "Gamma Underwriting Co.",
        "csv",
        "|",
        {
            "policy": {
                "POL_ID": "policy_number",
                "CLIENT": "customer_name",
                "LOB": "product_name",
                "PREM_AMT": "premium_amount",
                "EFF_DT": "effective_date",
                "EXP_DT": "expiry_date",
                "TSI": "sum_insured",
                "BRKR": "broker_agent",
            },
            "claim": {
                "CLM_ID": "claim_number",
                "POL_ID": "policy_number",
                "DOL": "loss_date",
                "RPT_DT": "reported_date",
                "RESERVE": "claim_amount",
                "STAT": "claim_status",
                "REMARKS": "loss_description",
            },
        },
    ),
}

# Topics, channel prefix, placeholder for a missing broker.
POLICY_TOPIC = "insurance.policies.raw"
CLAIM_TOPIC = "insurance.claims.raw"
CHANNEL_PREFIX = "broker-ingest"
UNKNOWN_BROKER = "UNKNOWN"

# Date formats in order of preference, as Spark patterns.
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd-MMM-yyyy")
