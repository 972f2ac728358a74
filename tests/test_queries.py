"""Registered queries against their DuckDB equivalents on the smallest scale.

The quick ones by default; all of them with ALL_QUERIES=1.
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registered
from brokerflow.checks.compare import difference, duck
from brokerflow.checks.oracles import ORACLES
from brokerflow.checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
QUICK = [
    "parse_envelope", "dead_letter", "header_signature", "read_broker_csv", "stage_claim", "parse_money", "parse_date_multi",
    "failed_rules", "catalog_only_rule", "quarantine", "explain_sample", "duplicate_check", "customer_profile", "infer_distinct", "upsert_policies",
    "fact_claim", "policy_anomaly", "claims_view", "broker_performance_fanout", "validation_summary", "metric_policies",
    "dq_kpis", "stream_freshness",
]


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("ALL_QUERIES") else QUICK)
def test_query_equals_sql(spark, connection, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert len(got)
    if name in ORACLES:
        assert difference(got, connection.sql(ORACLES[name]).df()) is None


def test_registry(spark):
    assert set(registered.oracle_sql()) <= set(registered.queries())
    assert set(QUERIES) == set(ORACLES)
    assert registered.entry(spark).columns == ["product_line", "total_premium"]
