"""The registered queries: one per operator, over the whole tables of a scale folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

import pandas as pd
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brokerflow.checks.book import BATCH, Book, plain, rounded, run_time
from brokerflow.config.brokers import BROKERS
from brokerflow.config.rules import RULES, Rule, rules_for
from brokerflow.functions import cleaning, keys, payload, text
from brokerflow.operators import anomaly, enrich, inference, mapping, quality, staging, star
from brokerflow.operators.joins import lookup_join
from brokerflow.plans import metrics, reports, views
from brokerflow.plans.batch import Options, run_batch, star_of
from brokerflow.plans.scratch import lean, new_folder, scope, settle
from brokerflow.plans.tables import Tables
from brokerflow.sources import envelopes, files, snapshots, testdata
from brokerflow.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Splits the promoted policies into two deliveries.
FIRST_DELIVERY = "loaded_at < TIMESTAMP_NTZ '1998-01-01 00:00:00'"


def query(build: Callable[[Book], DataFrame]) -> Callable[[Book], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(Book(spark, sf_dir)))

    QUERIES[build.__name__] = run
    return build


# ---------------------------------------------------------------- sources and sinks

@query
def wire_to_premium_by_product(b: Book) -> DataFrame:
    """From log records to the premium per product line, through every stage."""
    checked = quality.check(b.wire_policies, rules_for("policy", "expression"), testdata.AS_OF)
    policies = star.policy_rows(quality.promotable(checked), testdata.AS_OF)
    rows = policies.groupBy("product_line").agg(F.sum("premium_amount").alias("total_premium"))
    return rows.orderBy(F.desc("total_premium"))


@query
def parse_envelope(b: Book) -> DataFrame:
    sized = payload.with_payload_map(envelopes.parse_envelopes(envelopes.drop_redelivered(b.messages)))
    return sized.select(
        "raw_id", "broker_code", "source_format", "record_type", "kafka_topic", "kafka_partition", "kafka_offset",
        "message_key", "ingest_channel", F.size("payload_map").alias("headers"),
    )


@query
def dead_letter(b: Book) -> DataFrame:
    dead = envelopes.dead_letters(envelopes.drop_redelivered(b.messages))
    size = F.when(F.col("problem") == envelopes.NO_OBJECT, F.length("value")).otherwise(0)
    return dead.select("topic", "partition", "offset", "problem", size.alias("characters"))


@query
def route_by_record_type(b: Book) -> DataFrame:
    policies, claims = envelopes.route(settle(b.landed.select("record_type", "ingest_channel"), "raw"))
    rows = policies.withColumn("landed_in", F.lit("policy")).unionByName(claims.withColumn("landed_in", F.lit("claim")))
    return rows.groupBy("landed_in", "record_type", "ingest_channel").agg(F.count("*").alias("records"))


@query
def dedupe_redelivery(b: Book) -> DataFrame:
    kept = envelopes.drop_redelivered(b.messages)
    return kept.groupBy("topic", "partition").agg(
        F.count("*").alias("records"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")
    )


DELIVERIES = 3
# Years of the log that come before each further part of it. The state of the stream holds two parts.
LOG_PARTS = (1994, 1996)
LATE = "1100 days"


def _write_log(parts: list[DataFrame], path: str) -> tuple[str, int]:
    """Parts of the log as files, one part after another, which stand for the topics on a machine without a broker.

    Every part has as many files as the largest one asks for. Returns the folder and that number.
    """
    files = max(FILES_PER_PART, *[part.count() // MESSAGES_PER_FILE for part in parts])
    for part in parts:
        rows = part.withColumn("timestamp", F.col("timestamp").cast("timestamp")).select(*LOG_COLUMNS)
        lean(rows.repartition(files, "offset")).mode("append").parquet(path)
    return path, files


FILES_PER_PART = 2  # at least
MESSAGES_PER_FILE = 100_000
LOG_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp")


def _delivered_log(b: Book) -> tuple[str, int]:
    """The deliveries as a log; the copy that they are written from is deleted."""
    path = new_folder(b.spark, "log")
    with scope(b.spark, "deliveries"):
        return _write_log(b.deliveries(DELIVERIES), path)


def _finish(stream) -> None:
    stream.awaitTermination()


@query
def source_log_stream(b: Book) -> DataFrame:
    """The log in order of time as a stream of several batches, redelivered records dropped, counted when it ends.

    What is sent again comes with the next part of the log, within the watermark.
    """
    path, year = new_folder(b.spark, "log"), F.year("timestamp")
    part = sum((F.when(year >= y, 1).otherwise(0) for y in LOG_PARTS), F.lit(0))
    with scope(b.spark, "sent"):
        sent = settle(testdata.messages(b.spark, b.sf_dir), "sent")
        placed = sent.withColumn("part", F.least(part + F.col("copy") - 1, F.lit(len(LOG_PARTS))))
        path, files = _write_log([placed.where(F.col("part") == i) for i in range(len(LOG_PARTS) + 1)], path)
    stream = ingest.read_log_files(b.spark, path, envelopes.LOG_SCHEMA, max_files=files)
    out, state = new_folder(b.spark, "log-out"), new_folder(b.spark, "log-state")
    once = envelopes.drop_redelivered(stream, LATE).select("topic", "partition", "offset")
    _finish(
        once.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        .trigger(availableNow=True).start()
    )
    return b.spark.read.parquet(out).groupBy("topic", "partition").agg(F.count("*").alias("records"))


@query
def append_raw(b: Book) -> DataFrame:
    """The log as a stream of several batches with redelivery between them, landed by record type."""
    path, files = _delivered_log(b)
    stream = ingest.read_log_files(b.spark, path, envelopes.LOG_SCHEMA, max_files=files)
    tables = Tables(b.spark, new_folder(b.spark, "landing"))
    _finish(ingest.append_raw(stream, tables, new_folder(b.spark, "landing-state"), every=None))
    policies, claims = tables.read("raw_policy"), tables.read("raw_claim")
    rows = policies.withColumn("landed_in", F.lit("policy")).unionByName(claims.withColumn("landed_in", F.lit("claim")))
    return rows.groupBy("landed_in", "broker_code").agg(
        F.count("*").alias("records"), F.countDistinct("raw_id").alias("ids")
    )


def _wire_text(b: Book, entity: str, code: str) -> DataFrame:
    """The canonical records of one broker as text under the broker's headers."""
    rows = testdata.policies(b.spark, b.sf_dir) if entity == "policy" else testdata.claims(b.spark, b.sf_dir)
    headers = BROKERS[code].headers[entity]
    return rows.where(F.col("broker_code") == code).select(
        "order_key", *[F.col(field).cast("string").alias(header) for header, field in headers.items()]
    )


def _csv_files(b: Book, entity: str, code: str) -> str:
    path = new_folder(b.spark, f"{code}-{entity}")
    (
        _wire_text(b, entity, code).drop("order_key").write.option("header", True)
        .option("sep", BROKERS[code].delimiter).option("emptyValue", "").option("escape", '"').csv(path)
    )
    return path


def _json_files(b: Book, entity: str, code: str) -> str:
    """Files of one JSON array each, of the records of 5,000 neighbouring orders: a fixed bound."""
    path = new_folder(b.spark, f"{code}-{entity}")
    headers = list(BROKERS[code].headers[entity])
    rows = _wire_text(b, entity, code).select(
        F.floor(F.col("order_key") / 5000).alias("file"), F.to_json(F.struct(*[f"`{h}`" for h in headers]), {"ignoreNullFields": "false"}).alias("r")
    )
    arrays = rows.groupBy("file").agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list("r"), ",\n"), F.lit("\n]")).alias("value")
    )
    arrays.write.partitionBy("file").text(path)
    return path


def _paths(b: Book, *codes: str) -> dict[tuple[str, str], str]:
    """Files of both record types of some brokers."""
    write = {code: _json_files if BROKERS[code].format == "json" else _csv_files for code in codes}
    return {(code, entity): write[code](b, entity, code) for code in codes for entity in ("policy", "claim")}


def _fields(rows: DataFrame) -> DataFrame:
    """One column per canonical field of both record types, read by the broker's headers."""
    names = list(dict.fromkeys(f for entity in ("policy", "claim") for f in mapping.mapped_fields(entity)))
    by_field = {f: [h for x in BROKERS.values() for e in x.headers for h, g in x.headers[e].items() if g == f] for f in names}
    read = [F.coalesce(*[F.col("values")[h] for h in dict.fromkeys(by_field[f])]).alias(f) for f in names]
    return rows.select("broker_code", "record_type", F.col(files.CORRUPT).isNotNull().alias("corrupt"), *read)


@query
def read_broker_csv(b: Book) -> DataFrame:
    """Both layouts of the comma-delimited broker."""
    return _fields(files.read_deliveries(b.spark, _paths(b, "BRK_ALPHA")))


@query
def read_broker_json(b: Book) -> DataFrame:
    return _fields(files.read_deliveries(b.spark, _paths(b, "BRK_BETA")))


@query
def read_broker_psv(b: Book) -> DataFrame:
    return _fields(files.read_deliveries(b.spark, _paths(b, "BRK_GAMMA")))


@query
def files_to_envelopes(b: Book) -> DataFrame:
    """All six layouts, by the headers that their files have."""
    signed = mapping.with_signature(files.files_to_envelopes(b.spark, _paths(b, *BROKERS)))
    return signed.groupBy("broker_code", "source_format", "record_type", "header_signature").agg(
        F.count("*").alias("records")
    )


@query
def semantic_snapshot(b: Book) -> DataFrame:
    view = views.policies_view(b.tables(), ("policy_number", "broker_code", "product_line", "premium_amount", "expiry_date"))
    path = new_folder(b.spark, "snapshot")
    snapshots.write_snapshot(view, path)
    return snapshots.read_snapshot(b.spark, path, view.schema)


# ---------------------------------------------------------------- header mapping

@query
def header_signature(b: Book) -> DataFrame:
    signed = mapping.with_signature(b.landed)
    return signed.groupBy("broker_code", "record_type", "header_signature").agg(F.count("*").alias("records"))


@query
def distinct_headers(b: Book) -> DataFrame:
    return mapping.distinct_headers(b.landed)


@query
def seed_mappings(b: Book) -> DataFrame:
    """Seeded layouts with the number of landed records that use them."""
    seen = mapping.layouts(b.landed).select("record_type", "header_signature", "records")
    seeds = mapping.seed_mappings(b.spark).select(
        "broker_code", "record_type", "header_signature", "mapping_source", "confidence", F.size("mapping").alias("fields")
    )
    return seeds.join(seen, ["record_type", "header_signature"], "left")


@query
def register_new_signatures(b: Book) -> DataFrame:
    new = mapping.new_signatures(mapping.layouts(b.landed), mapping.seed_mappings(b.spark))
    return new.select("record_type", "header_signature", "source_headers")


@query
def resolve_unmapped(b: Book) -> DataFrame:
    inferred = b.registry.where("mapping_source = 'inferred'")
    return inferred.select(
        "record_type", "header_signature", "confidence", F.explode("mapping").alias("header", "field")
    )


@query
def extract_json_block(b: Book) -> DataFrame:
    """A JSON block inside prose; every tenth text has none, every tenth a broken one."""
    events = testdata.table(b.spark, b.sf_dir, "events")
    turn = F.col("event_id") % 10
    prose = (
        F.when(turn == 0, "no object here")
        .when(turn == 1, F.concat(F.lit("cut off: "), F.replace("props", F.lit(":"), F.lit("")), F.lit(" end")))
        .otherwise(F.concat(F.lit("Here it is:\n"), "props", F.lit("\nAnything else?")))
    )
    turns = testdata.table(b.spark, b.sf_dir, "conversations").where("text IS NOT NULL")
    block = F.format_string('{"k": "%s-%s",\n "said": null}', "conv_id", "turn")
    told = turns.select(
        F.concat_ws("-", F.lit("turn"), "conv_id", "turn").alias("source"),
        payload.first_json_object(F.concat("text", F.lit(" "), block, F.lit("\n"), "text"))["k"].alias("k"),
    )
    found = events.select(F.concat_ws("-", F.lit("event"), "event_id").alias("source"), payload.first_json_object(prose)["k"].alias("k"))
    return found.unionByName(told)


@query
def invert_mapping(b: Book) -> DataFrame:
    rows = [
        mapping.invert_mapping(b.registry, entity).select(
            F.lit(entity).alias("record_type"), "header_signature", F.explode(_as_pairs("source", entity)).alias("p")
        )
        for entity in ("policy", "claim")
    ]
    return rows[0].unionByName(rows[1]).select("record_type", "header_signature", "p.field", "p.header")


def _as_pairs(struct: str, entity: str):
    names = mapping.mapped_fields(entity)
    return F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"{struct}.{n}").alias("header")) for n in names])


@query
def project_canonical(b: Book) -> DataFrame:
    """Claims and policies under canonical names, as text."""
    policies, claims = envelopes.route(b.raw)
    texts = ("policy_number", "claim_number", "loss_date", "claim_status", "loss_description", "customer_name", "product_name", "expiry_date")
    rows = [mapping.project_canonical(policies, b.registry, "policy"), mapping.project_canonical(claims, b.registry, "claim")]
    return rows[0].unionByName(rows[1], allowMissingColumns=True).select("raw_id", "broker_code", *texts)


@query
def validate_mapping(b: Book) -> DataFrame:
    """Mapping entries per record type, with the number of targets outside the canonical fields.

    Beside the registry stand the broker layouts with the policy number's target misspelt.
    """
    misspelt = F.expr("transform_values(mapping, (header, target) -> if(target = 'policy_number', 'policy_no', target))")
    seeds = mapping.seed_mappings(b.spark).withColumn("header_signature", F.concat("header_signature", F.lit("-")))
    registry = settle(b.registry.unionByName(seeds.withColumn("mapping", misspelt)), "registry")
    bad = mapping.invalid_targets(registry).groupBy("record_type").agg(F.count("*").alias("invalid"))
    entries = (
        registry.where("mapping IS NOT NULL")
        .groupBy("record_type")
        .agg(F.sum(F.size("mapping")).alias("entries"), F.count("*").alias("layouts"))
    )
    return entries.join(bad, "record_type", "left").withColumn("invalid", F.coalesce("invalid", F.lit(0)))


@query
def to_broker_format(b: Book) -> DataFrame:
    """Canonical claims and policies under their broker's headers, checked by reading some fields back."""
    out = []
    for entity, rows, key, money, date in (
        ("claim", testdata.claims(b.spark, b.sf_dir), F.col("line_id"), "claim_amount", "reported_date"),
        ("policy", testdata.policies(b.spark, b.sf_dir), F.col("order_key").cast("string"), "premium_amount", "expiry_date"),
    ):
        layouts = {x.code: x.headers[entity] for x in BROKERS.values()}
        header = {f: [h for x in BROKERS.values() for h, g in x.headers[entity].items() if g == f] for f in (money, date)}
        read = payload.with_payload_map(rows.withColumn("_native", mapping.to_broker_format(layouts)), "_native", "native")
        out.append(read.select(
            key.alias("record"),
            F.coalesce(*[F.col("native")[h] for h in header[money]]).cast("double").alias("amount"),
            F.coalesce(*[F.col("native")[h] for h in header[date]]).alias("dated"),
            F.size("native").alias("headers"),
        ))
    return out[0].unionByName(out[1])


# ---------------------------------------------------------------- cleaning and staging

@query
def trim_strings(b: Book) -> DataFrame:
    customers = testdata.table(b.spark, b.sf_dir, "customer")
    padded = F.concat(F.lit("   "), "c_name", F.lit("  "))
    return customers.select("c_custkey", cleaning.trimmed(padded).alias("customer_name"))


@query
def parse_money(b: Book) -> DataFrame:
    orders = testdata.table(b.spark, b.sf_dir, "orders")
    form = F.col("o_orderkey") % 5
    price = F.format_number("o_totalprice", 2)
    written = (
        F.when(form == 0, F.concat(F.lit("$"), price))
        .when(form == 1, F.concat(F.lit("USD "), price))
        .when(form == 2, F.concat(F.lit("£ -"), price))
        .when(form == 3, F.lit("n/a"))
        .otherwise(price)
    )
    return orders.select("o_orderkey", cleaning.parse_money(written).alias("amount"))


@query
def parse_date_multi(b: Book) -> DataFrame:
    orders = testdata.table(b.spark, b.sf_dir, "orders")
    form = F.col("o_orderkey") % 5
    date = F.col("o_orderdate").cast("date")
    written = (
        F.when(form == 0, F.date_format(date, "yyyy-MM-dd"))
        .when(form == 1, F.date_format(date, "dd/MM/yyyy"))
        .when(form == 2, F.date_format(date, "MM/dd/yyyy"))
        .when(form == 3, F.date_format(date, "dd-MMM-yyyy"))
        .otherwise(F.lit("soon"))
    )
    return orders.select("o_orderkey", cleaning.parse_date(written).alias("parsed"))


@query
def upper_codes(b: Book) -> DataFrame:
    rows = testdata.claims(b.spark, b.sf_dir)
    code = cleaning.upper_code(F.concat(F.lit(" "), F.lower("claim_status"), F.lit("  ")))
    return rows.groupBy(code.alias("claim_status")).agg(F.count("*").alias("claims"))


@query
def reporting_lag(b: Book) -> DataFrame:
    return testdata.claims(b.spark, b.sf_dir).select(
        "line_id", cleaning.days_between(F.col("loss_date"), F.col("reported_date")).alias("lag_days")
    )


@query
def stage_policy(b: Book) -> DataFrame:
    return b.wire_policies


@query
def stage_claim(b: Book) -> DataFrame:
    return b.wire_claims


@query
def incremental_unprocessed(b: Book) -> DataFrame:
    """Landing rows left after the mapped ones were staged."""
    policies, claims = envelopes.route(b.raw)
    left = staging.unprocessed(policies, b.wire_policies).unionByName(staging.unprocessed(claims, b.wire_claims))
    return left.select("raw_id", "broker_code", "record_type")


# ---------------------------------------------------------------- data quality

@query
def evaluate_rules_policy(b: Book) -> DataFrame:
    rows = quality.results(b.checked_policies, "policy", BATCH, run_time())
    return rows.select("result_id", "stg_id", "rule_id", "severity", "passed")


@query
def evaluate_rules_claim(b: Book) -> DataFrame:
    rows = quality.results(b.checked_claims, "claim", BATCH, run_time())
    return rows.select("result_id", "stg_id", "rule_id", "severity", "passed")


@query
def failed_rules(b: Book) -> DataFrame:
    """Failures with the values the rule looked at."""
    return b.failures.select("entity", "stg_id", "broker_code", "rule_id", "severity", "observed_value")


@query
def record_status(b: Book) -> DataFrame:
    policies = b.checked_policies.select(F.lit("policy").alias("entity"), "stg_id", "dq_status")
    return policies.unionByName(b.checked_claims.select(F.lit("claim").alias("entity"), "stg_id", "dq_status"))


@query
def quarantine(b: Book) -> DataFrame:
    rows = quality.quarantine(b.checked_policies, "policy", run_time()).unionByName(
        quality.quarantine(b.checked_claims, "claim", run_time())
    )
    snapshot = F.col("record_snapshot")
    return rows.select(
        "quarantine_id", "entity", "stg_id", "broker_code", "failed_rules", "resolved",
        F.get_json_object(snapshot, "$.policy_number").alias("policy_number"),
        F.coalesce(F.get_json_object(snapshot, "$.effective_date"), F.get_json_object(snapshot, "$.loss_date")).alias("first_date"),
    )


@query
def explain_sample(b: Book) -> DataFrame:
    """An explanation of every failure of an explainable rule."""
    return quality.explained(b.failures, rules_for("policy") + rules_for("claim")).select("rule_id", "stg_id", "explanation")


@query
def load_rule(b: Book) -> DataFrame:
    """A catalog with a rule switched off and another one changed, evaluated over the policies."""
    first = quality.load_rules(None, quality.rule_rows(b.spark)).withColumn("active", F.col("rule_id") != "POL_007")
    changed = [
        r._replace(description="At most one year", expression="datediff(expiry_date, effective_date) <= 365", severity="INFO")
        for r in rules_for("policy") if r.rule_id == "POL_005"
    ]
    catalog = quality.load_rules(settle(first, "catalog"), quality.rule_rows(b.spark, changed))
    rules = [r for r in quality.rules_from_catalog(catalog, "policy") if r.rule_type == "expression"]
    rows = quality.results(quality.check(b.policies, rules, testdata.AS_OF), "policy", BATCH, run_time())
    return rows.groupBy("rule_id", "severity", "passed").agg(F.count("*").alias("records"))


CATALOG_RULE = Rule("POL_X01", "policy", "Sum insured covers forty premiums of a named customer", "INFO", "sum_insured >= 40 * premium_amount AND customer_name <> ''", ())


@query
def catalog_only_rule(b: Book) -> DataFrame:
    """A rule that only the catalog holds, with the values of the columns that its expression reads."""
    first = settle(quality.load_rules(None, quality.rule_rows(b.spark)), "catalog")
    catalog = quality.load_rules(first, quality.rule_rows(b.spark, [CATALOG_RULE]))
    rules = [r for r in quality.rules_from_catalog(catalog, "policy") if r.rule_type == "expression"]
    rows = quality.results(quality.check(b.policies, rules, testdata.AS_OF), "policy", BATCH, run_time(), only_failed=True)
    return rows.where(F.col("rule_id") == CATALOG_RULE.rule_id).select("stg_id", "severity", "observed_value")


@query
def sync_rules(b: Book) -> DataFrame:
    """The catalog with the failures that each of its rules has among the records."""
    catalog = quality.load_rules(None, quality.rule_rows(b.spark))
    counted = b.failures.groupBy("rule_id").agg(F.count("*").alias("failures"))
    rows = catalog.join(counted, "rule_id", "left")
    return rows.select("rule_id", "entity", "severity", "rule_type", "active", F.coalesce("failures", F.lit(0)).alias("failures"))


@query
def batch_log(b: Book) -> DataFrame:
    logs = [
        quality.batch_log(b.checked("policy"), "policy", len(rules_for("policy", "expression")), BATCH),
        quality.batch_log(b.checked("claim"), "claim", len(rules_for("claim")), BATCH),
    ]
    return logs[0].unionByName(logs[1]).drop("started_at", "ended_at")


@query
def referential_check(b: Book) -> DataFrame:
    """Claims whose policy is not among the promoted ones."""
    rows = quality.with_policy(b.claims, b.unscored_policies).where(~F.col("policy_exists"))
    return rows.select("stg_id", "claim_number", "policy_number")


@query
def duplicate_check(b: Book) -> DataFrame:
    rows = quality.check(quality.with_policy_copies(b.policies), rules_for("policy", "batch"), testdata.AS_OF)
    failed = rows.where(F.exists("verdicts", lambda v: ~v["passed"]))
    return failed.select("stg_id", "broker_code", "policy_number", "policy_copies")


@query
def anomaly_check(b: Book) -> DataFrame:
    """Policies whose premium is far from its peers', in the audit trail."""
    return b.failures.where("rule_id = 'BATCH_002'").select("stg_id", "broker_code", "severity", "observed_value")


@query
def severity_gate(b: Book) -> DataFrame:
    policies = quality.promotable(b.checked_policies).select(F.lit("policy").alias("entity"), "broker_code", "dq_status")
    claims = quality.promotable(b.checked_claims).select(F.lit("claim").alias("entity"), "broker_code", "dq_status")
    return policies.unionByName(claims).groupBy("entity", "broker_code", "dq_status").agg(F.count("*").alias("records"))


# ---------------------------------------------------------------- enrichment

@query
def classify_product(b: Book) -> DataFrame:
    rows = testdata.policies(b.spark, b.sf_dir)
    return rows.select("order_key", "product_name", text.classify_product(F.col("product_name")).alias("product_line"))


@query
def classify_after_checks(b: Book) -> DataFrame:
    """Policies checked without a product line and classified afterwards, if they may be promoted."""
    unclassified = b.policies.withColumn("product_line", F.lit(None).cast("string"))
    checked = quality.check(unclassified, rules_for("policy", "expression"), testdata.AS_OF)
    return enrich.classify_missing(checked).groupBy("dq_status", "product_line").agg(F.count("*").alias("policies"))


@query
def sentiment_after_checks(b: Book) -> DataFrame:
    """Claims checked without a sentiment and scored afterwards, if they may be promoted."""
    unscored = b.checked_claims.withColumn("sentiment_score", F.lit(None).cast("double"))
    return rounded(enrich.score_missing_sentiment(unscored).select("stg_id", "dq_status", "sentiment_score"), 6, "sentiment_score")


TONES = ("settled", "a safe and good end", "damage and loss", "no word of it", "")


@query
def claim_sentiment(b: Book) -> DataFrame:
    """The tone of the claims' narratives, and of what is said in the conversations with some words added."""
    rows = testdata.claims(b.spark, b.sf_dir).select(F.col("line_id").alias("source"), "loss_description")
    tone = F.element_at(F.array(*map(F.lit, TONES)), (F.col("turn") % len(TONES) + 1).cast("int"))
    turns = testdata.table(b.spark, b.sf_dir, "conversations")
    said = turns.select(F.concat_ws("-", F.lit("turn"), "conv_id", "turn").alias("source"), F.concat("text", F.lit(" "), tone).alias("loss_description"))
    scored = rows.unionByName(said).select("source", text.claim_sentiment(F.col("loss_description")).alias("sentiment_score"))
    return rounded(scored, 6, "sentiment_score")


@query
def customer_profile(b: Book) -> DataFrame:
    return star.customer_rows(quality.promotable(b.checked_policies)).drop("customer_key")


@query
def customer_id(b: Book) -> DataFrame:
    customers = testdata.table(b.spark, b.sf_dir, "customer")
    return customers.select("c_custkey", keys.customer_id(F.concat(F.lit(" "), F.lower("c_name"))).alias("customer_id"))


def _classify_batch(batch: pd.DataFrame) -> pd.DataFrame:
    """A provider: the first word of the product text decides; no text is an answer too."""
    named = batch["product_name"].fillna("none given")
    return pd.DataFrame({"first_word": named.str.split().str[0].str.upper(), "characters": named.str.len()})


_ANSWER = T.StructType([T.StructField("first_word", T.StringType()), T.StructField("characters", T.LongType())])


def _asked(b: Book) -> DataFrame:
    """Product texts, some of them missing."""
    named = F.when(F.col("product_name") != "Unlisted cover", F.col("product_name"))
    return b.policies.select("stg_id", named.alias("product_name"))


def _answered(b: Book):
    """Answers with a cache that knows one text already, and another answer to it."""
    cache = b.spark.createDataFrame([("Term Life", "CACHED", 1)], "product_name string, first_word string, characters long")
    return inference.infer_distinct(_asked(b), ["product_name"], _classify_batch, _ANSWER, cache, ["stg_id"], "classify")


@query
def infer_distinct(b: Book) -> DataFrame:
    return _answered(b)[0]


@query
def model_call_log(b: Book) -> DataFrame:
    """What went out to the model: the distinct texts that the cache doesn't hold, whatever the number of calls."""
    log = _answered(b)[2]
    return log.groupBy("task", "model", "success").agg(F.sum("inputs").alias("inputs"))


@query
def anomaly_reason(b: Book) -> DataFrame:
    policies = b.dim_policy.select(F.col("policy_number").alias("number"), "anomaly_reason")
    claims = b.claim_scores.select(F.col("claim_number").alias("number"), "anomaly_reason")
    return policies.unionByName(claims).where("anomaly_reason IS NOT NULL")


# ---------------------------------------------------------------- star schema

@query
def upsert_policies(b: Book) -> DataFrame:
    """Two deliveries: the second updates the known policies and adds the others."""
    good = settle(quality.promotable(b.checked_policies).drop("verdicts"), "good")
    early = F.expr(FIRST_DELIVERY)
    first = settle(star.policy_rows(good.where(early), testdata.AS_OF).withColumn("anomaly_score", F.lit(0.5)), "first")
    merged = star.dim_policy(first, star.policy_rows(good.where(~early), testdata.AS_OF))
    return merged.select("policy_number", "premium_amount", "expiry_date", "anomaly_score", "loaded_at")


@query
def upsert_insert_only(b: Book) -> DataFrame:
    """Two deliveries of customers: a profile once made stays."""
    good = settle(quality.promotable(b.checked_policies).drop("verdicts"), "good")
    early = F.expr(FIRST_DELIVERY)
    first = settle(star.customer_rows(good.where(early)), "first")
    added = star.new_customers(first, star.customer_rows(good.where(~early)))
    return first.unionByName(added).drop("customer_key")


@query
def dim_broker(b: Book) -> DataFrame:
    return b.dim_broker


@query
def dim_customer(b: Book) -> DataFrame:
    return star.customer_rows(quality.promotable(b.checked_policies)).select("customer_key", "customer_id", "customer_name")


@query
def dim_product(b: Book) -> DataFrame:
    """The product dimension with the number of promoted policies of each line."""
    used = b.policy_rows.groupBy("product_key").agg(F.count("*").alias("policies"))
    rows = star.product_rows(b.spark).join(used, "product_key", "left")
    return rows.withColumn("policies", F.coalesce("policies", F.lit(0)))


@query
def dim_policy(b: Book) -> DataFrame:
    return b.policy_rows.drop("anomaly_score", "anomaly_reason")


@query
def policy_term_days(b: Book) -> DataFrame:
    return b.policies.select(
        "stg_id", cleaning.days_between(F.col("effective_date"), F.col("expiry_date")).alias("policy_term_days")
    )


@query
def is_active(b: Book) -> DataFrame:
    return b.policy_rows.groupBy("is_active").agg(F.count("*").alias("policies"))


@query
def fact_premium(b: Book) -> DataFrame:
    """Premium facts after two runs; the second finds the later policies only."""
    early = F.expr(FIRST_DELIVERY)
    first = settle(star.premium_rows(b.unscored_policies.where(early), None), "facts")
    second = star.premium_rows(b.unscored_policies, first)
    return first.unionByName(second)


@query
def fact_claim(b: Book) -> DataFrame:
    return b.claim_rows.drop("anomaly_score", "anomaly_reason", "loss_description")


@query
def surrogate_keys(b: Book) -> DataFrame:
    """Every key column of the claim fact against the tables it points to."""
    claims = b.claim_rows.select("claim_key", "policy_key")
    policies = b.unscored_policies.select("policy_key", F.lit(1).alias("found"))
    joined = lookup_join(claims, policies, ["policy_key"], ["claim_key"], stored=True)
    return joined.agg(
        F.count("*").alias("claims"), F.countDistinct("claim_key").alias("claim_keys"), F.sum("found").alias("with_policy")
    )


# ---------------------------------------------------------------- outliers

@query
def policy_anomaly(b: Book) -> DataFrame:
    return rounded(b.dim_policy.select("policy_number", "anomaly_score"), 6, "anomaly_score")


@query
def claim_anomaly(b: Book) -> DataFrame:
    return rounded(b.claim_scores.select("claim_number", "anomaly_score"), 6, "anomaly_score")


@query
def flag_anomalies(b: Book) -> DataFrame:
    policies = anomaly.flagged(b.dim_policy).groupBy("product_line").agg(F.count("*").alias("flagged"))
    claims = anomaly.flagged(b.claim_scores).agg(F.count("*").alias("flagged"))
    return policies.unionByName(claims.select(F.lit("all claims").alias("product_line"), "flagged"))


@query
def keep_old_score(b: Book) -> DataFrame:
    """Peers of one customer and product: many groups of one keep the score they had."""
    old = b.unscored_policies.withColumn("anomaly_score", F.lit(0.125))
    scored = anomaly.score_outliers(old, "premium_amount", ["customer_key", "product_line"], "policy_key")
    return rounded(scored.select("policy_number", "anomaly_score"), 6, "anomaly_score")


# ---------------------------------------------------------------- business views

@query
def ingest_freshness(b: Book) -> DataFrame:
    return b.health.drop("ingest_status")


@query
def policies_view(b: Book) -> DataFrame:
    return rounded(views.policies_view(b.tables()), 6, "anomaly_score")


@query
def claims_view(b: Book) -> DataFrame:
    return rounded(views.claims_view(b.tables()), 6, "anomaly_score", "sentiment_score")


@query
def broker_performance(b: Book) -> DataFrame:
    return rounded(views.broker_performance(b.tables()), 6, "avg_policy_anomaly")


@query
def broker_performance_fanout(b: Book) -> DataFrame:
    """Over-counted on purpose: amounts in thousands, as the products exceed exact doubles."""
    rows = views.broker_performance_fanout(b.tables())
    for name in ("total_premium", "total_claims_amount"):
        rows = rows.withColumn(name, F.round(F.col(name) / 1000, 0))
    return rounded(rows, 6, "avg_policy_anomaly")


@query
def ingestion_health(b: Book) -> DataFrame:
    return b.health


@query
def validation_summary(b: Book) -> DataFrame:
    return b.summary


# ---------------------------------------------------------------- metrics

@query
def metric_policies(b: Book) -> DataFrame:
    rows = metrics.metric_query(
        b.catalog(scored=True), "POLICIES",
        ["policy volume", "gwp", "avg_premium", "exposure", "avg_anomaly_score"], ["lob", "in force"],
    )
    return rounded(rows, 4, "avg_premium", "avg_anomaly_score")


@query
def metric_claims(b: Book) -> DataFrame:
    rows = metrics.metric_query(
        b.catalog(), "CLAIMS", ["claim volume", "incurred", "avg_claim", "reporting delay"], ["product_line", "status"]
    )
    return rounded(rows, 4, "avg_claim", "avg_reporting_lag")


@query
def metric_broker_performance(b: Book) -> DataFrame:
    rows = metrics.metric_query(
        b.catalog(), "BROKER_PERFORMANCE",
        ["policy_count", "total_premium", "total_claims_amount", "claims ratio"], ["broker_code"],
    )
    return rounded(rows, 4, "loss_ratio")


@query
def metric_ingestion_health(b: Book) -> DataFrame:
    return metrics.metric_query(b.catalog(), "INGESTION_HEALTH", ["rows_landed", "staleness"], ["record_type", "health"])


@query
def metric_validation_summary(b: Book) -> DataFrame:
    return metrics.metric_query(b.catalog(), "VALIDATION_SUMMARY", ["errors"], ["entity", "severity"])


@query
def metric_query_rows(b: Book) -> DataFrame:
    """A row query without measures: all its rows."""
    return metrics.metric_query(
        b.catalog(), "POLICIES", dimensions=["policy_number", "product"],
        filters=[("product", "in", ["MARINE", "LIFE"]), ("inception", ">=", dt.date(1998, 1, 1))],
        order_by=[("policy_number", "asc")],
    )


@query
def premium_by_product(b: Book) -> DataFrame:
    return metrics.premium_by_product({**b.catalog(), "POLICIES": lambda columns: b.policy_rows.select(*columns)})


@query
def top_loss_ratio(b: Book) -> DataFrame:
    return metrics.top_loss_ratio(b.catalog())


@query
def stale_streams(b: Book) -> DataFrame:
    return metrics.stale_streams(b.catalog())


@query
def unhealthy_streams(b: Book) -> DataFrame:
    return metrics.stale_streams(b.catalog(), only_stale=False)


@query
def top_validation_errors(b: Book) -> DataFrame:
    return metrics.top_validation_errors(b.catalog())


@query
def open_claim_count(b: Book) -> DataFrame:
    return metrics.open_claim_count(b.catalog())


@query
def open_claims(b: Book) -> DataFrame:
    return metrics.open_claims(b.catalog())


@query
def largest_policies(b: Book) -> DataFrame:
    return metrics.largest_policies(b.catalog())


@query
def portfolio_counts(b: Book) -> DataFrame:
    return metrics.portfolio_counts(b.catalog())


# ---------------------------------------------------------------- reports

@query
def portfolio_kpis(b: Book) -> DataFrame:
    return rounded(reports.portfolio_kpis(b.catalog()), 4, "loss_ratio")


@query
def claims_by_status(b: Book) -> DataFrame:
    return reports.claims_by_status(b.catalog())


@query
def broker_leaderboard(b: Book) -> DataFrame:
    return reports.broker_leaderboard(b.catalog())


@query
def health_counts(b: Book) -> DataFrame:
    return reports.health_counts(b.catalog())


@query
def rows_by_broker(b: Book) -> DataFrame:
    return reports.rows_by_broker(b.catalog())


@query
def broker_drilldown(b: Book) -> DataFrame:
    return rounded(reports.broker_drilldown(b.catalog(), "Beta Risk Partners"), 4, "loss_ratio")


@query
def premium_vs_claims_long(b: Book) -> DataFrame:
    return reports.premium_vs_claims(b.catalog())


@query
def product_mix(b: Book) -> DataFrame:
    return reports.product_mix(b.catalog())


@query
def dq_kpis(b: Book) -> DataFrame:
    return reports.quality_kpis(b.catalog(scored=True))


@query
def failures_by_entity_severity(b: Book) -> DataFrame:
    return reports.failures_by_severity(b.catalog())


@query
def failures_by_rule(b: Book) -> DataFrame:
    return reports.failures_by_rule(b.catalog())


@query
def top_anomalies(b: Book) -> DataFrame:
    return rounded(reports.top_anomalies(b.catalog(scored=True)), 6, "anomaly_score")


# ---------------------------------------------------------------- runs and streams

def _portfolio(tables: Tables) -> DataFrame:
    rows = views.policies_view(star_of(tables), ("broker_code", "product_line", "premium_amount", "anomaly_score"))
    claims = views.claims_view(star_of(tables), ("broker_code", "product_line", "claim_amount", "anomaly_score"))

    def totals(df: DataFrame, entity: str, amount: str) -> DataFrame:
        return df.groupBy("broker_code", "product_line").agg(
            F.lit(entity).alias("entity"),
            F.count("*").alias("records"),
            F.sum(amount).alias("amount"),
            F.count_if(F.col("anomaly_score") >= anomaly.FLAG_FROM).alias("flagged"),
        )

    return totals(rows, "policy", "premium_amount").unionByName(totals(claims, "claim", "claim_amount"))


@query
def batch_run(b: Book) -> DataFrame:
    """All messages through all stages into tables; totals of the resulting views."""
    tables = Tables(b.spark, new_folder(b.spark, "tables"))
    run_batch(b.spark, tables, 1, b.messages, testdata.AS_OF)
    return _portfolio(tables)


@query
def idempotent_rerun(b: Book) -> DataFrame:
    """Three deliveries; the first again, which is refused, and the others again after a rewind: the tables of one pass.

    Some claims come before their policy and fail, in the second pass as in the first.
    """
    tables = Tables(b.spark, new_folder(b.spark, "tables"))
    deliveries = b.deliveries(DELIVERIES)
    for i in range(DELIVERIES):
        run_batch(b.spark, tables, i, deliveries[i], testdata.AS_OF)
    try:
        run_batch(b.spark, tables, 0, deliveries[0], testdata.AS_OF)
        raise AssertionError("an older batch ran again before its followers were forgotten")
    except ValueError:
        tables.rewind(1)
    for i in range(1, DELIVERIES):
        run_batch(b.spark, tables, i, deliveries[i], testdata.AS_OF)
    return _portfolio(tables)


@query
def micro_batches(b: Book) -> DataFrame:
    """The log as a stream of three micro-batches with redelivery between them, each through all stages."""
    path, files = _delivered_log(b)
    stream = ingest.read_log_files(b.spark, path, envelopes.LOG_SCHEMA, max_files=files)
    tables = Tables(b.spark, new_folder(b.spark, "tables"))
    state = new_folder(b.spark, "batch-state")
    _finish(ingest.stream_batches(stream, tables, state, lambda: testdata.AS_OF, every=None))
    return _portfolio(tables)


@query
def failed_batch(b: Book) -> DataFrame:
    """Three deliveries, then a batch that dies when its policies are promoted and its claims are checked: the three are what readers see."""
    tables = Tables(b.spark, new_folder(b.spark, "tables"))
    for i, delivery in enumerate(b.deliveries(DELIVERIES)):
        run_batch(b.spark, tables, i, delivery, testdata.AS_OF)
    later = b.messages.withColumn("offset", F.col("offset") + (1 << 40))  # everything comes once more, from other places in the log
    lost = Rule("CLM_X01", "claim", "No rule at all", "ERROR", "raise_error('lost') IS NULL", ("claim_number",))
    try:
        run_batch(b.spark, tables, DELIVERIES, later, testdata.AS_OF, Options(rules=[*RULES, lost]))
        raise AssertionError("the batch didn't fail")
    except PySparkException:
        return _portfolio(tables)


@query
def incremental_scores(b: Book) -> DataFrame:
    """Policies in five deliveries, some of which change what an earlier one brought; scores as if all came at once."""
    sent = settle(testdata.policy_messages(b.spark, b.sf_dir).drop("copy").withColumn("delivery", F.col("offset") % 5), "deliveries")
    tables = Tables(b.spark, new_folder(b.spark, "tables"))
    for i in range(5):
        run_batch(b.spark, tables, i, sent.where(F.col("delivery") == i).drop("delivery"), testdata.AS_OF)
    return rounded(star_of(tables).dim_policy.select("policy_number", "premium_amount", "anomaly_score"), 6, "anomaly_score")


@query
def stage_log(b: Book) -> DataFrame:
    tables = Tables(b.spark, new_folder(b.spark, "tables"))
    run_batch(b.spark, tables, 1, b.messages, testdata.AS_OF)
    return tables.read_log("stage_log").select("stage", "rows_in", "rows_out", "rows_rejected", "status")


@query
def stream_freshness(b: Book) -> DataFrame:
    """Landing totals kept by a stream over the events, aged when read."""
    events = b.spark.readStream.schema(testdata.SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(b.sf_dir)
    tables = Tables(b.spark, new_folder(b.spark, "tables"))
    state = new_folder(b.spark, "freshness-state")
    _finish(ingest.stream_freshness(testdata.as_raw_events(events), tables, state, every=None))
    return views.ingestion_health(tables.current("freshness"), testdata.EVENTS_AS_OF)
