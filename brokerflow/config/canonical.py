"""Canonical fields and vocabularies that every broker layout is mapped onto."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class Field(NamedTuple):
    name: str
    type: str
    required: bool
    pii: bool


# Field names, types, required and personal-data flags.
FIELDS: dict[str, tuple[Field, ...]] = {
    "policy": (
        Field("policy_number", "string", True, False),
        Field("customer_name", "string", True, True),
        Field("product_name", "string", True, False),
        Field("product_line", "string", False, False),
        Field("premium_amount", "number", True, False),
        Field("sum_insured", "number", False, False),
        Field("effective_date", "date", True, False),
        Field("expiry_date", "date", True, False),
        Field("broker_agent", "string", False, False),
    ),
    "claim": (
        Field("claim_number", "string", True, False),
        Field("policy_number", "string", True, False),
        Field("loss_date", "date", True, False),
        Field("reported_date", "date", True, False),
        Field("claim_amount", "number", True, False),
        Field("claim_status", "string", True, False),
        Field("loss_description", "string", False, False),
    ),
}

# Controlled vocabularies.
PRODUCT_LINES = ("AUTO", "HOME", "LIFE", "HEALTH", "TRAVEL", "COMMERCIAL", "MARINE", "OTHER")
CLAIM_STATUSES = ("OPEN", "IN_REVIEW", "APPROVED", "PAID", "DENIED", "CLOSED", "WITHDRAWN")
RISK_TIERS = ("LOW", "MEDIUM", "HIGH", "SEVERE")
SEGMENTS = ("RETAIL", "SME", "CORPORATE")

# product_line is set by classification, never read from a payload.
DERIVED_FIELDS = ("product_line",)

SPARK_TYPES = {
    "string": T.StringType(),
    "number": T.DecimalType(18, 2),
    "date": T.DateType(),
}


def mapped_fields(entity: str) -> list[str]:
    """Canonical fields of an entity that a broker header may be mapped onto."""
    return [f.name for f in FIELDS[entity] if f.name not in DERIVED_FIELDS]


def struct_type(entity: str) -> T.StructType:
    """The canonical record as a Spark schema; personal data is flagged in the metadata."""
    return T.StructType(
        [
            T.StructField(f.name, SPARK_TYPES[f.type], not f.required, {"pii": f.pii})
            for f in FIELDS[entity]
        ]
    )
