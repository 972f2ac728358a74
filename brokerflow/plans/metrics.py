"""Queries by metric name over the five business views.

Names and synonyms resolve to columns and aggregates; nothing outside the model can be reached, and
no SQL text is taken.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerflow.config.model import DIMENSIONS, MEASURES

# A catalog maps a view name to a function from the needed columns to the frame.
Catalog = dict[str, Callable[[Sequence[str]], DataFrame]]

_AGGREGATES = {"count": F.count, "sum": F.sum, "avg": F.avg, "max": F.max}
_COMPARE: dict[str, Callable[[Column, Any], Column]] = {
    "=": lambda c, v: c == v,
    "<>": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)),
}


class UnknownName(ValueError):
    """A view, dimension, measure or operator the model does not have."""


def _resolve(kind: str, name: str, entries: dict[str, Sequence[str]]) -> str:
    wanted = name.strip().lower()
    for entry, synonyms in entries.items():
        if wanted == entry or wanted in synonyms:
            return entry
    raise UnknownName(f"{kind} {name!r} is not in the model")


def metric_query(
    catalog: Catalog,
    view: str,
    measures: Sequence[str] = (),
    dimensions: Sequence[str] = (),
    filters: Sequence[tuple[str, str, Any]] = (),
    order_by: Sequence[tuple[str, str]] = (),
    limit: int | None = None,
) -> DataFrame:
    """Measures by dimensions of one view; without a measure, its rows. All of them unless ``limit`` is given.

    ``order_by`` holds (name, "asc" | "desc"); NULLs come last either way.
    """
    view = view.upper()
    if view not in MEASURES or view not in catalog:
        raise UnknownName(f"view {view!r} is not in the model")
    dims = DIMENSIONS[view]
    sums = {name: entry[2] for name, entry in MEASURES[view].items()}
    by = [_resolve("dimension", d, dims) for d in dimensions]
    wanted = [_resolve("measure", m, sums) for m in measures]
    tests = []
    for name, op, value in filters:
        if op not in _COMPARE:
            raise UnknownName(f"comparison {op!r} is not in the model")
        tests.append((_resolve("dimension", name, dims), op, value))
    if not by and not wanted:
        raise UnknownName("name at least one measure or dimension")

    needed = [*by, *[t[0] for t in tests], *[MEASURES[view][m][1] for m in wanted]]
    rows = catalog[view](list(dict.fromkeys(needed)))
    for name, op, value in tests:
        rows = rows.where(_COMPARE[op](F.col(name), value))
    if wanted:
        aggregates = [_AGGREGATES[MEASURES[view][m][0]](MEASURES[view][m][1]).alias(m) for m in wanted]
        rows = rows.groupBy(*by).agg(*aggregates)
    else:
        rows = rows.select(*by)

    order = []
    for name, direction in order_by:
        column = _resolve("column", name, {**{d: dims[d] for d in by}, **{m: sums[m] for m in wanted}})
        order.append(F.col(column).desc_nulls_last() if direction == "desc" else F.col(column).asc_nulls_last())
    if order:
        rows = rows.orderBy(*order)
    return rows if limit is None else rows.limit(limit)


# ---------------------------------------------------------------- the verified questions

def premium_by_product(catalog: Catalog) -> DataFrame:
    return metric_query(catalog, "POLICIES", ["total_premium"], ["product_line"], order_by=[("total_premium", "desc")])


def top_loss_ratio(catalog: Catalog, k: int = 10) -> DataFrame:
    """Brokers by loss ratio, those without one last; the name breaks ties."""
    rows = catalog["BROKER_PERFORMANCE"](["broker_name", "loss_ratio"])
    return (
        rows.select("broker_name", "loss_ratio")
        .orderBy(F.col("loss_ratio").desc_nulls_last(), "broker_name")
        .limit(k)
    )


def stale_streams(catalog: Catalog, only_stale: bool = True) -> DataFrame:
    rows = catalog["INGESTION_HEALTH"](["broker_code", "record_type", "seconds_since_last", "ingest_status"])
    status = F.col("ingest_status")
    return rows.where(status == "STALE" if only_stale else status != "HEALTHY").select(
        "broker_code", "record_type", "seconds_since_last", "ingest_status"
    )


def top_validation_errors(catalog: Catalog, k: int = 10) -> DataFrame:
    rows = catalog["VALIDATION_SUMMARY"](["rule_id", "rule_description", "severity", "failure_count"])
    return (
        rows.orderBy(F.desc("failure_count"), "rule_id")
        .limit(k)
        .select("rule_description", "severity", "failure_count")
    )


def open_claim_count(catalog: Catalog) -> DataFrame:
    rows = catalog["CLAIMS"](["claim_status"])
    return rows.where("claim_status = 'OPEN'").agg(F.count("*").alias("open_claims"))


def open_claims(catalog: Catalog, k: int = 20) -> DataFrame:
    """The first k open claims by number."""
    rows = catalog["CLAIMS"](["claim_number", "claim_status", "broker_name", "product_line", "claim_amount"])
    return rows.where("claim_status = 'OPEN'").orderBy("claim_number").limit(k)


def largest_policies(catalog: Catalog, k: int = 5) -> DataFrame:
    rows = catalog["POLICIES"](["policy_number", "broker_name", "product_line", "premium_amount"])
    return rows.orderBy(F.col("premium_amount").desc_nulls_last(), "policy_number").limit(k)


def portfolio_counts(catalog: Catalog) -> DataFrame:
    """Number of policies and claims, each as a row."""
    policies = catalog["POLICIES"](["policy_number"]).agg(F.count("*").alias("records"))
    claims = catalog["CLAIMS"](["claim_number"]).agg(F.count("*").alias("records"))
    return policies.select(F.lit("policies").alias("entity"), "records").unionByName(
        claims.select(F.lit("claims").alias("entity"), "records")
    )
