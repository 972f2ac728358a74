"""Word lists of the deterministic text enrichment."""

# Phrases that decide a product line, tried in this order; OTHER when none fits.
PRODUCT_PHRASES = (
    ("AUTO", ("motor", "car", "vehicle", "auto")),
    ("HOME", ("homeowners", "buildings & contents", "household", "home")),
    ("LIFE", ("term life", "whole of life", "assurance", "life")),
    ("HEALTH", ("medical", "pmi", "health plan", "health")),
    ("TRAVEL", ("trip", "worldwide travel", "travel")),
    ("COMMERCIAL", ("business pack", "sme", "commercial combined", "commercial")),
    ("MARINE", ("cargo", "hull", "goods in transit", "marine")),
)

# Sentiment lexicon.
POSITIVE_WORDS = (
    "resolved", "minor", "repaired", "recovered", "prompt", "satisfied", "quickly", "covered",
    "safe", "good", "helpful", "settled",
)
NEGATIVE_WORDS = (
    "damage", "damaged", "loss", "stolen", "theft", "fire", "flood", "injury", "injured",
    "accident", "severe", "destroyed", "burst", "cracked", "collision", "broken", "delay",
    "disputed",
)

# Customer segment: name tokens and sum-insured limits.
CORPORATE_TOKENS = ("corp", "corporation", "plc", "enterprises", "industries", "group", "holdings")
SME_TOKENS = ("ltd", "llc", "inc", "co", "sons", "traders", "services")
CORPORATE_SUM_INSURED = 10_000_000
SME_SUM_INSURED = 5_000_000

# Risk tier: upper bounds of premium per unit of sum insured.
RISK_LIMITS = (("LOW", 0.04), ("MEDIUM", 0.08), ("HIGH", 0.5))
