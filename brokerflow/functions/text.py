"""Deterministic text enrichment as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brokerflow.config import words


def _any_phrase(phrases) -> str:
    return r"\b(" + "|".join(phrases) + r")\b"


def classify_product(product: Column) -> Column:
    """One of the eight product lines; OTHER for NULL or unclear text."""
    lowered = F.lower(F.coalesce(product, F.lit("unknown")))
    (first, phrases), *others = words.PRODUCT_PHRASES
    line = F.when(lowered.rlike(_any_phrase(phrases)), first)
    for name, phrases in others:
        line = line.when(lowered.rlike(_any_phrase(phrases)), name)
    return line.otherwise("OTHER")


def claim_sentiment(narrative: Column) -> Column:
    """(positive - negative) / (positive + negative) over lexicon words, in [-1, 1].

    NULL or blank text gives NULL, text without lexicon words gives 0.
    """
    tokens = F.split(F.lower(narrative), "[^a-z]+")
    score = F.aggregate(
        tokens,
        F.struct(F.lit(0).alias("up"), F.lit(0).alias("down")),
        lambda acc, tok: F.struct(
            (acc["up"] + F.when(tok.isin(*words.POSITIVE_WORDS), 1).otherwise(0)).alias("up"),
            (acc["down"] + F.when(tok.isin(*words.NEGATIVE_WORDS), 1).otherwise(0)).alias("down"),
        ),
        lambda acc: F.coalesce(
            F.try_divide((acc["up"] - acc["down"]).cast("double"), (acc["up"] + acc["down"]).cast("double")),
            F.lit(0.0),
        ),
    )
    return F.when(F.trim(narrative) != "", score)


def _has_token(name: Column, tokens) -> Column:
    return F.lower(name).rlike(r"\b(" + "|".join(tokens) + r")\b")


def customer_segment(name: Column, max_sum_insured: Column) -> Column:
    size = F.coalesce(max_sum_insured.cast("double"), F.lit(0.0))
    return (
        F.when(_has_token(name, words.CORPORATE_TOKENS) | (size >= words.CORPORATE_SUM_INSURED), "CORPORATE")
        .when(_has_token(name, words.SME_TOKENS) | (size >= words.SME_SUM_INSURED), "SME")
        .otherwise("RETAIL")
    )


def risk_tier(premium: Column, sum_insured: Column) -> Column:
    """Tier by premium per unit insured; SEVERE when nothing is known to be insured."""
    rate = F.try_divide(premium.cast("double"), sum_insured.cast("double"))
    tier = F.lit("SEVERE")
    for name, limit in reversed(words.RISK_LIMITS):
        tier = F.when(rate < limit, name).otherwise(tier)
    return tier
