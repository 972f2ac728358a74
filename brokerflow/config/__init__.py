"""Declarative settings: broker layouts, canonical fields, rules, metrics, word lists."""
