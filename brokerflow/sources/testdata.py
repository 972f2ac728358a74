"""Shapes the benchmark tables into policy, claim and message records.

Used by the registered queries and tests only. Every record is computed from its own row, so the
adapter scales with the tables. The exceptions (bad dates, blank names, ...) hit fixed residues of
the keys, so that every rule and every parsing path has rows to work on.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brokerflow.config.brokers import BROKERS, CLAIM_TOPIC, POLICY_TOPIC
from brokerflow.functions import keys
from brokerflow.functions.text import claim_sentiment, classify_product
from brokerflow.operators.mapping import to_broker_format
from brokerflow.operators.upsert import REPEATED

AS_OF = dt.date(2001, 12, 31)
EVENTS_AS_OF = dt.datetime(2024, 1, 30, 23, 59, 0)

SCHEMAS = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "conversations": "conv_id long, turn long, role string, text string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}

# Values of the test records.
_BROKER = "element_at(array('BRK_ALPHA', 'BRK_BETA', 'BRK_GAMMA'), cast({} % 3 + 1 AS int))"
_PRODUCT = (
    "element_at(array('Private Motor', 'Buildings & Contents', 'Term Life', 'Private Medical', "
    "'Worldwide Travel', 'Business Pack', 'Marine Cargo'), cast(o_orderkey % 7 + 1 AS int))"
)
_STATE = (
    "element_at(array('OPEN', 'IN_REVIEW', 'APPROVED', 'PAID', 'DENIED', 'CLOSED'), cast(l_partkey % 6 + 1 AS int))"
)
# A narrative names part and supplier of the line, with words that the keys choose.
_NARRATIVE = (
    "'Part ' || l_partkey || ' of supplier ' || l_suppkey || ': ' || "
    "element_at(array('damaged', 'repaired', 'weighed', 'stolen', 'recovered', 'broken', 'counted'), cast(l_suppkey % 7 + 1 AS int)) || "
    "', then ' || element_at(array('settled', 'disputed', 'noted', 'safe', 'destroyed'), cast(l_partkey % 5 + 1 AS int)) || "
    "CASE WHEN (l_partkey + l_suppkey) % 3 = 0 THEN ' without delay' ELSE '' END"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _spread(rows: DataFrame, *ids: str) -> DataFrame:
    """Let all cores work on a small table that is one unsplittable file; a larger scan stays as it is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores, *ids)


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical policies, one per order."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_orderkey % 100 AS k",
        "cast(o_totalprice AS decimal(18,2)) AS price",
        "cast(o_orderdate AS date) AS ordered",
        "o_orderdate AS ingested_at",
    )
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS o_custkey", "c_name")
    return _spread(orders, "o_orderkey").join(customers, "o_custkey").selectExpr(
        "o_orderkey AS order_key",
        f"{_BROKER.format('o_orderkey')} AS broker_code",
        "CASE k WHEN 7 THEN '' WHEN 37 THEN 'POL-' || (o_orderkey - 3) ELSE 'POL-' || o_orderkey END AS policy_number",
        "CASE k WHEN 13 THEN '' ELSE c_name END AS customer_name",
        f"CASE k WHEN 29 THEN 'Unlisted cover' ELSE {_PRODUCT} END AS product_name",
        "cast(CASE k WHEN 3 THEN -price WHEN 17 THEN price * 25 WHEN 31 THEN NULL ELSE price END AS decimal(18,2))"
        " AS premium_amount",
        "cast(CASE k WHEN 19 THEN 1 ELSE price * 30 END AS decimal(18,2)) AS sum_insured",
        "CASE k WHEN 11 THEN date_add(ordered, 365) ELSE ordered END AS effective_date",
        "CASE k WHEN 11 THEN ordered WHEN 23 THEN date_add(ordered, 2555) ELSE date_add(ordered, 365) END AS expiry_date",
        "'AG' || (100 + o_custkey % 900) AS broker_agent",
        "ingested_at",
    )


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical claims, one per line."""
    narrow = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate"
    )
    shaped = _spread(narrow, "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").selectExpr(
        "l_orderkey AS order_key",
        "(l_partkey + l_suppkey) % 100 AS defect",
        "concat_ws('-', 'CLM', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice * 100) AS bigint)) AS line_id",
        "cast(l_extendedprice AS decimal(18,2)) AS amount",
        "cast(l_shipdate AS date) AS shipped",
        "cast(l_partkey % 46 AS int) AS delay",
        f"{_STATE} AS state",
        f"CASE WHEN l_suppkey % 11 <> 0 THEN {_NARRATIVE} END AS loss_description",
        "l_shipdate AS ingested_at",
    )
    today = f"DATE '{AS_OF}'"
    return shaped.selectExpr(
        "order_key",
        "defect",
        "line_id",
        f"{_BROKER.format('order_key')} AS broker_code",
        "CASE defect WHEN 29 THEN '' ELSE line_id END AS claim_number",
        "CASE defect WHEN 13 THEN '' WHEN 23 THEN 'POL-X' || order_key ELSE 'POL-' || order_key END AS policy_number",
        f"CASE defect WHEN 3 THEN date_add({today}, 10) ELSE shipped END AS loss_date",
        f"CASE defect WHEN 3 THEN date_add({today}, 12) WHEN 7 THEN date_add(shipped, -5)"
        " WHEN 17 THEN date_add(shipped, 400) ELSE date_add(shipped, delay) END AS reported_date",
        "cast(CASE defect WHEN 11 THEN -amount WHEN 31 THEN amount * 25 ELSE amount END AS decimal(18,2)) AS claim_amount",
        "CASE defect WHEN 19 THEN 'UNKNOWN' ELSE state END AS claim_status",
        "loss_description",
        "ingested_at",
    )


# Place of a record in its topic. Several lines share an order, so a claim's offset is a 60-bit number
# from the line's identity.
POLICY_OFFSET = "order_key"
CLAIM_OFFSET = "cast(conv(substring(md5(line_id), 1, 15), 16, 10) AS long)"


def staged_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The policies as they stand in staging, classified, waiting for the quality checks."""
    raw = keys.raw_id(F.lit(POLICY_TOPIC), F.expr("order_key % 3"), F.expr(POLICY_OFFSET))
    return policies(spark, sf_dir).select(
        keys.staged_id(raw).alias("stg_id"),
        raw.alias("raw_id"),
        "broker_code", "policy_number", "customer_name", "product_name",
        classify_product(F.col("product_name")).alias("product_line"),
        "premium_amount", "sum_insured", "effective_date", "expiry_date", "broker_agent",
        F.expr("'seed' AS mapping_source"),
        F.expr("1.0D AS mapping_confidence"),
        F.expr("ingested_at AS loaded_at"),
    )


def staged_claims(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """The claims, or ``rows`` of them, as they stand in staging, waiting for the quality checks."""
    rows = claims(spark, sf_dir) if rows is None else rows
    raw = keys.raw_id(F.lit(CLAIM_TOPIC), F.expr("order_key % 3"), F.expr(CLAIM_OFFSET))
    return rows.select(
        keys.staged_id(raw).alias("stg_id"),
        raw.alias("raw_id"),
        *[c for c in rows.columns if c == REPEATED],
        "broker_code", "claim_number", "policy_number", "loss_date", "reported_date", "claim_amount",
        "claim_status", "loss_description",
        F.expr("datediff(reported_date, loss_date) AS reporting_lag_days"),
        claim_sentiment(F.col("loss_description")).alias("sentiment_score"),
        F.expr("ingested_at AS loaded_at"),
    )


# ---------------------------------------------------------------- wire form

UNSEEN_LAYOUT = 73
MAX_INT = (1 << 31) - 1
# ALPHA and GAMMA write amounts as text, BETA as a JSON number.
_NUMBERS = {"premium_amount": "premium_number", "claim_amount": "claim_number_amount"}


def _wire_date(column: str) -> str:
    return (
        f"CASE WHEN defect = 79 THEN date_format({column}, 'dd-MMM-yyyy') "
        f"WHEN defect = 83 THEN date_format({column}, 'MM/dd/yyyy') "
        f"WHEN broker_code = 'BRK_BETA' THEN date_format({column}, 'dd/MM/yyyy') "
        f"ELSE date_format({column}, 'yyyy-MM-dd') END AS {column}"
    )


def _wire_money(column: str) -> list[str]:
    """'$12.50' or 'USD 12.50' as text, 'n/a' without an amount; and the number itself."""
    return [
        f"coalesce(CASE broker_code WHEN 'BRK_ALPHA' THEN '$' ELSE 'USD ' END || {column}, 'n/a') AS {column}",
        f"{column} AS {_NUMBERS[column]}",
    ]


def _padded(column: str) -> str:
    return f"CASE defect WHEN 89 THEN '  ' || {column} || ' ' ELSE {column} END AS {column}"


def _messages(wire: DataFrame, entity: str, topic: str, record_type: str, offset: str) -> DataFrame:
    layouts = {b.code: dict(b.headers[entity]) for b in BROKERS.values()}
    titles = {f.replace("_", " ").title(): f for f in layouts["BRK_ALPHA"].values()}
    layouts["BRK_BETA"] = {h: _NUMBERS.get(f, f) for h, f in layouts["BRK_BETA"].items()}
    unseen = ", ".join(f"{field} AS `{header}`" for header, field in titles.items())
    payload = F.when(F.col("defect") == UNSEEN_LAYOUT, F.expr(f"to_json(struct({unseen}))")).otherwise(
        to_broker_format(layouts)
    )
    value = """concat('{', concat_ws(', ',
        CASE WHEN defect <> 41 THEN '"broker_code": "' || broker_code || '"' END,
        CASE broker_code WHEN 'BRK_BETA' THEN '"source_format": "json"' ELSE '"source_format": "csv"' END,
        '"record_type": "' || record_type || '"',
        CASE WHEN defect <> 43 THEN '"payload": ' || payload END), '}')"""
    sent = wire.withColumn("record_type", F.expr(record_type)).withColumn("payload", payload)
    return sent.selectExpr(
        "cast(CASE defect WHEN 67 THEN '' ELSE message_key END AS binary) AS key",
        f"cast(substring({value}, 1, CASE defect WHEN 47 THEN 60 ELSE {MAX_INT} END) AS binary) AS value",
        f"'{topic}' AS topic",
        "cast(order_key % 3 AS int) AS partition",
        f"{offset} AS offset",
        "ingested_at AS timestamp",
        "explode(CASE defect WHEN 61 THEN array(1, 2) ELSE array(1) END) AS copy",
    )


def policy_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log records of the policy topic, in the columns of the Kafka source."""
    wire = policies(spark, sf_dir).withColumn("defect", F.expr("order_key % 100")).selectExpr(
        "order_key", "defect", "broker_code", "policy_number", "policy_number AS message_key", _padded("customer_name"),
        "product_name", *_wire_money("premium_amount"), "sum_insured", _wire_date("effective_date"),
        _wire_date("expiry_date"), "broker_agent", "ingested_at",
    )
    record_type = "CASE defect WHEN 53 THEN 'endorsement' WHEN 59 THEN NULL ELSE 'policy' END"
    return _messages(wire, "policy", POLICY_TOPIC, record_type, POLICY_OFFSET)


def claim_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log records of the claim topic, in the columns of the Kafka source."""
    rows = claims(spark, sf_dir).withColumn(
        "claim_status", F.expr("CASE defect WHEN 89 THEN lower(claim_status) ELSE claim_status END")
    )
    wire = rows.selectExpr(
        "order_key", "defect", "line_id", "broker_code", "claim_number", "policy_number", "claim_number AS message_key",
        _wire_date("loss_date"), _wire_date("reported_date"), *_wire_money("claim_amount"), _padded("claim_status"),
        "loss_description", "ingested_at",
    )
    return _messages(wire, "claim", CLAIM_TOPIC, "'claim'", CLAIM_OFFSET)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing records (broker, record type, time) for the freshness views."""
    return as_raw_events(table(spark, sf_dir, "events"))


def as_raw_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        f"{_BROKER.format('user_id')} AS broker_code",
        "CASE WHEN event_type IN ('purchase', 'signup') THEN 'policy' ELSE 'claim' END AS record_type",
        "ts AS ingested_at",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log records of both topics; some come twice, which ``copy`` numbers."""
    return policy_messages(spark, sf_dir).unionByName(claim_messages(spark, sf_dir))


def delivered(sent: DataFrame, deliveries: int) -> DataFrame:
    """``messages`` with the number of the ``delivery`` each comes in.

    Policies come by the number of their order, claims with their order or one delivery later, so that some
    come before their policy. What is sent again comes one delivery later than before.
    """
    late = F.when(F.col("topic") == CLAIM_TOPIC, F.col("offset") % 2).otherwise(0)
    first = (F.col("partition") + late) % deliveries
    return sent.withColumn("delivery", F.least(first + F.col("copy") - 1, F.lit(deliveries - 1)).cast("int")).drop("copy")
