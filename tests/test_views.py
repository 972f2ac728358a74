from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from brokerflow.plans import metrics, reports, views
from brokerflow.plans.scratch import settle
from brokerflow.sources.snapshots import read_snapshot, write_snapshot


@pytest.fixture(scope="module")
def star(spark):
    """Two policies and three claims of broker A, one policy of broker B, a broker C without anything."""
    money = lambda x: Decimal(x)
    day = dt.date(2025, 1, 1)
    brokers = spark.createDataFrame([("a", "A", "Name A"), ("b", "B", "Name B"), ("c", "C", "Name C")],
                                    "broker_key string, broker_code string, broker_name string")
    customers = spark.createDataFrame([("k1", "Ann", "RETAIL", "LOW")],
                                      "customer_key string, customer_name string, customer_segment string, risk_tier string")
    policies = spark.createDataFrame(
        [("p1", "P1", "a", "k1", "AUTO", money("100"), money("1000"), day, day, 0, True, 0.2, None),
         ("p2", "P2", "a", None, "HOME", money("300"), None, day, day, 0, False, 1.0, "why"),
         ("p3", "P3", "b", "k9", "AUTO", money("50"), money("10"), day, day, 0, True, None, None)],
        "policy_key string, policy_number string, broker_key string, customer_key string, product_line string, "
        "premium_amount decimal(18,2), sum_insured decimal(18,2), effective_date date, expiry_date date, policy_term_days int, "
        "is_active boolean, anomaly_score double, anomaly_reason string")
    claims = spark.createDataFrame(
        [("c1", "C1", "p1", "a", "k1", day, day, 0, money("10"), "OPEN", "t", 0.5, 0.1, None),
         ("c2", "C2", "p1", "a", "k1", day, day, 4, money("20"), "PAID", None, None, 0.96, "r"),
         ("c3", "C3", "p2", "a", None, day, day, 2, money("30"), "OPEN", None, None, None, None),
         ("c4", "C4", None, None, None, day, day, 2, money("99"), "OPEN", None, None, None, None)],
        "claim_key string, claim_number string, policy_key string, broker_key string, customer_key string, loss_date date, "
        "reported_date date, reporting_lag_days int, claim_amount decimal(18,2), claim_status string, loss_description string, "
        "sentiment_score double, anomaly_score double, anomaly_reason string")
    return views.Star(*[settle(t, "star") for t in (brokers, customers, policies, claims)])


def test_policies_view(star):
    rows = {r.policy_number: r for r in views.policies_view(star).collect()}
    assert tuple(rows["P1"].asDict()) == views.POLICY_COLUMNS
    assert (rows["P1"].broker_name, rows["P1"].customer_name, rows["P1"].risk_tier) == ("Name A", "Ann", "LOW")
    assert rows["P2"].customer_name is None and rows["P3"].customer_name is None


def test_claims_view(star):
    rows = {r.claim_number: r for r in views.claims_view(star).collect()}
    assert tuple(rows["C1"].asDict()) == views.CLAIM_COLUMNS
    assert (rows["C1"].policy_number, rows["C1"].product_line, rows["C1"].customer_name) == ("P1", "AUTO", "Ann")
    assert (rows["C4"].policy_number, rows["C4"].broker_name) == (None, None)


@pytest.mark.parametrize("columns", [("policy_number", "premium_amount"), ("broker_code", "product_line"), ("customer_name",)])
def test_a_view_of_some_columns_equals_the_full_view(star, columns):
    some = views.policies_view(star, columns)
    assert sorted(some.columns) == sorted(columns)
    full = views.policies_view(star).select(*some.columns)
    assert some.exceptAll(full).count() == full.exceptAll(some).count() == 0
    with pytest.raises(ValueError):
        views.claims_view(star, ("no_such_column",))


def test_broker_performance(star):
    rows = {r.broker_code: r for r in views.broker_performance(star).collect()}
    a, b, c = rows["A"], rows["B"], rows["C"]
    assert (a.policy_count, a.total_premium, a.claim_count, a.total_claims_amount) == (2, 400.0, 3, 60.0)
    assert (a.loss_ratio, a.avg_policy_anomaly) == (0.15, 0.6)
    assert (b.claim_count, b.total_claims_amount, b.loss_ratio) == (0, 0.0, None)
    assert (c.policy_count, c.total_premium, c.loss_ratio, c.avg_policy_anomaly) == (0, 0.0, None, None)


def test_fanout_equals_the_joined_pairs(star):
    b, p, c = star.dim_broker, star.dim_policy, star.fact_claim
    pairs = (
        b.join(p.select("broker_key", "policy_number", "premium_amount", F.col("anomaly_score").alias("score")), "broker_key", "left")
        .join(c.select("broker_key", "claim_number", "claim_amount"), "broker_key", "left")
        .groupBy("broker_code")
        .agg(F.countDistinct("policy_number").alias("policy_count"), F.sum("premium_amount").cast("double").alias("premium"),
             F.countDistinct("claim_number").alias("claim_count"), F.sum("claim_amount").cast("double").alias("claimed"),
             F.avg("score").alias("score"))
    )
    wanted = {r.broker_code: (r.policy_count, r.premium or 0.0, r.claim_count, r.claimed or 0.0, r.score) for r in pairs.collect()}
    got = {
        r.broker_code: (r.policy_count, r.total_premium, r.claim_count, r.total_claims_amount, r.avg_policy_anomaly)
        for r in views.broker_performance_fanout(star).collect()
    }
    assert got.keys() == wanted.keys()
    for code in got:
        assert got[code] == pytest.approx(wanted[code])


def test_health_classes_and_their_edges(spark):
    now = dt.datetime(2025, 1, 1, 12, 0, 0)
    ages = [0, 120, 121, 600, 601]
    rows = spark.createDataFrame(
        [(f"B{a}", "policy", now - dt.timedelta(seconds=a)) for a in ages], "broker_code string, record_type string, ingested_at timestamp_ntz"
    )
    health = views.ingestion_health(views.ingest_freshness(rows), now)
    got = {r.seconds_since_last: r.ingest_status for r in health.collect()}
    assert got == {0: "HEALTHY", 120: "HEALTHY", 121: "LAGGING", 600: "LAGGING", 601: "STALE"}


@pytest.fixture(scope="module")
def catalog(spark, star):
    now = dt.datetime(2025, 1, 1, 12, 0, 0)
    health = spark.createDataFrame(
        [("A", "policy", 5, now, 10, "HEALTHY"), ("A", "claim", 7, now, 300, "LAGGING"), ("B", "claim", 1, now, 900, "STALE")],
        "broker_code string, record_type string, rows_landed long, last_ingested_at timestamp_ntz, seconds_since_last long, ingest_status string")
    summary = spark.createDataFrame(
        [("policy", "POL_002", "premium", "ERROR", 5, now), ("policy", "POL_003", "range", "WARN", 7, now), ("claim", "CLM_004", "loss", "ERROR", 5, now)],
        "entity string, rule_id string, rule_description string, severity string, failure_count long, last_failure_at timestamp_ntz")
    return {
        "POLICIES": lambda columns: views.policies_view(star, columns),
        "CLAIMS": lambda columns: views.claims_view(star, columns),
        "BROKER_PERFORMANCE": lambda columns: views.broker_performance(star),
        "INGESTION_HEALTH": lambda columns: health,
        "VALIDATION_SUMMARY": lambda columns: summary,
    }


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_metric_by_synonyms(catalog):
    out = metrics.metric_query(catalog, "policies", ["GWP", "policy volume"], ["line of business"], order_by=[("gwp", "desc")])
    assert out.columns == ["product_line", "total_premium", "policy_count"]
    assert rows_of(out) == [("HOME", Decimal("300.00"), 1), ("AUTO", Decimal("150.00"), 2)]


def test_metric_filters_and_limits(catalog):
    out = metrics.metric_query(catalog, "CLAIMS", ["incurred"], filters=[("status", "=", "OPEN"), ("policy_number", "in", ["P1", "P2"])])
    assert rows_of(out) == [(Decimal("40.00"),)]
    rows = metrics.metric_query(catalog, "CLAIMS", dimensions=["claim_number"], order_by=[("claim_number", "desc")], limit=2)
    assert rows_of(rows) == [("C4",), ("C3",)]


def test_a_limit_holds_only_where_it_is_given(catalog, spark):
    many = spark.range(250).select(F.col("id").cast("string").alias("policy_number"))
    wide = {"POLICIES": lambda columns: many}
    assert metrics.metric_query(wide, "POLICIES", dimensions=["policy_number"]).count() == 250
    assert metrics.metric_query(wide, "POLICIES", ["policy_count"], ["policy_number"]).count() == 250


@pytest.mark.parametrize(
    "query",
    [
        {"view": "RAW_POLICY_STREAM", "measures": ["policy_count"]},
        {"view": "DIM_POLICY", "measures": ["policy_count"]},
        {"view": "POLICIES", "measures": ["DROP TABLE x"]},
        {"view": "POLICIES", "measures": ["policy_count"], "dimensions": ["anomaly_reason; SELECT 1"]},
        {"view": "POLICIES", "measures": ["policy_count"], "filters": [("product", "LIKE", "A%")]},
        {"view": "POLICIES", "measures": ["policy_count"], "filters": [("loaded_at", "=", 1)]},
        {"view": "POLICIES", "measures": ["policy_count"], "order_by": [("premium_amount", "asc")]},
        {"view": "POLICIES"},
    ],
)
def test_names_outside_the_model_are_refused(catalog, query):
    with pytest.raises(metrics.UnknownName):
        metrics.metric_query(catalog, **query)


def test_verified_questions(catalog):
    assert rows_of(metrics.premium_by_product(catalog)) == [("HOME", Decimal("300.00")), ("AUTO", Decimal("150.00"))]
    assert rows_of(metrics.top_loss_ratio(catalog)) == [("Name A", 0.15), ("Name B", None), ("Name C", None)]
    assert rows_of(metrics.stale_streams(catalog)) == [("B", "claim", 900, "STALE")]
    assert metrics.stale_streams(catalog, only_stale=False).count() == 2
    assert rows_of(metrics.top_validation_errors(catalog, 2)) == [("range", "WARN", 7), ("loss", "ERROR", 5)]
    assert rows_of(metrics.open_claim_count(catalog)) == [(3,)]
    assert [r.claim_number for r in metrics.open_claims(catalog, 2).collect()] == ["C1", "C3"]
    assert [r.policy_number for r in metrics.largest_policies(catalog, 2).collect()] == ["P2", "P1"]
    assert sorted(rows_of(metrics.portfolio_counts(catalog))) == [("claims", 4), ("policies", 3)]


def test_reports(catalog):
    kpis = reports.portfolio_kpis(catalog).first()
    assert (kpis.policy_volume, kpis.premium_revenue, kpis.claim_volume, kpis.total_claims) == (3, 450.0, 4, 159.0)
    assert (kpis.validation_errors, kpis.validation_warnings) == (10, 7)
    assert kpis.loss_ratio == pytest.approx(159 / 450)
    assert sorted(rows_of(reports.claims_by_status(catalog))) == [("OPEN", 3, 139.0), ("PAID", 1, 20.0)]
    board = reports.broker_leaderboard(catalog).collect()
    assert [(r.broker_name, r.loss_ratio_pct) for r in board] == [("Name A", 15.0), ("Name B", None), ("Name C", None)]
    assert rows_of(reports.health_counts(catalog)) == [(13, 1, 1, 1)]
    assert sorted(rows_of(reports.rows_by_broker(catalog))) == [("A", 12), ("B", 1)]
    assert rows_of(reports.broker_drilldown(catalog, "Name A")) == [(2, 400.0, 3, 60.0, 0.15)]
    assert rows_of(reports.broker_drilldown(catalog, "Name C")) == [(0, 0.0, 0, 0.0, 0.0)]
    assert reports.broker_drilldown(catalog).first().policies == 3
    assert reports.premium_vs_claims(catalog).count() == 6
    assert sorted(rows_of(reports.product_mix(catalog, "Name A"))) == [("Name A", "AUTO", 100.0), ("Name A", "HOME", 300.0)]
    assert tuple(reports.quality_kpis(catalog).first()) == (10, 7, 1, 1)
    assert sorted(rows_of(reports.failures_by_severity(catalog))) == [("claim", "ERROR", 5), ("policy", "ERROR", 5), ("policy", "WARN", 7)]
    assert [r.rule_id for r in reports.failures_by_rule(catalog).collect()] == ["POL_003", "CLM_004", "POL_002"]
    assert [r.policy_number for r in reports.top_anomalies(catalog, 2).collect()] == ["P2", "P1"]


def test_portfolio_without_premium(catalog, star):
    empty = views.Star(star.dim_broker, star.dim_customer, settle(star.dim_policy.where("false"), "e"), star.fact_claim)
    kpis = reports.portfolio_kpis({**catalog, "POLICIES": lambda columns: views.policies_view(empty, columns)}).first()
    assert (kpis.policy_volume, kpis.premium_revenue, kpis.loss_ratio) == (0, 0.0, 0.0)


def test_snapshot_round_trip(spark, star, tmp_path):
    view = views.broker_performance(star)
    write_snapshot(view, str(tmp_path / "snapshot"))
    back = read_snapshot(spark, str(tmp_path / "snapshot"), view.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, view.collect()))
