"""Tolerant parsing of broker text into typed values. Bad input gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brokerflow.config.brokers import DATE_FORMATS

MONEY = "decimal(18,2)"


def trimmed(text: Column) -> Column:
    return F.trim(text)


def upper_code(text: Column) -> Column:
    return F.upper(F.trim(text))


def parse_money(text: Column) -> Column:
    """Drop everything but digits, point and minus, then read a decimal(18,2)."""
    return F.regexp_replace(text, r"[^0-9.\-]", "").try_cast(MONEY)


def parse_date(text: Column) -> Column:
    """First configured format that fits. ISO accepts what the plain date cast accepts."""
    iso, *others = DATE_FORMATS
    assert iso == "yyyy-MM-dd"
    tries = [F.try_to_date(text)]
    tries += [F.try_to_date(text, fmt) for fmt in others]
    return F.coalesce(*tries)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)
