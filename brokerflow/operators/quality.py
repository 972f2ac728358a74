"""Data-quality rules: verdict per record and rule, record status, quarantine, summaries.

All rules of an entity are evaluated in one pass: every record gets an array with one verdict per
rule. Status, quarantine and counts are projections of that array, without a shuffle; only the audit
trail explodes it.
"""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brokerflow.config.rules import RULES, SEVERITIES, Rule
from brokerflow.functions.compute import once
from brokerflow.functions.keys import surrogate_key
from brokerflow.functions.sqltext import name, text
from brokerflow.operators.anomaly import POLICY_PEERS, changed_moments, moments, with_distance
from brokerflow.operators.joins import joint_key, lookup_join
from brokerflow.operators.upsert import upsert

REQUIRED = ("rule_id", "entity", "description", "expression", "rule_type")
PROMOTABLE = ("PASS", "WARN")
CATALOG_SCHEMA = (
    "rule_id string, entity string, description string, severity string, rule_type string, "
    "expression string, explain boolean, active boolean"
)


# ---------------------------------------------------------------- catalog

def rule_rows(spark: SparkSession, rules: Iterable[Rule] = RULES) -> DataFrame:
    """The rule set as catalog rows."""
    rules = list(rules)
    for rule in rules:
        if rule.severity not in SEVERITIES:
            raise ValueError(f"{rule.rule_id}: unknown severity {rule.severity!r}")
        missing = [field for field in REQUIRED if not getattr(rule, field)]
        if missing:
            raise ValueError(f"rule {rule.rule_id!r} lacks {', '.join(missing)}")
    twice = sorted(i for i, n in Counter(r.rule_id for r in rules).items() if n > 1)
    if twice:
        raise ValueError(f"rules with the same id: {', '.join(twice)}")
    return spark.createDataFrame(
        [
            (r.rule_id, r.entity, r.description, r.severity, r.rule_type, r.expression, r.explain, r.active)
            for r in rules
        ],
        CATALOG_SCHEMA,
    )


def load_rules(catalog: DataFrame | None, rules: DataFrame) -> DataFrame:
    """Upsert rules by id. An existing rule keeps its ``active`` flag."""
    columns = [c for c in rules.columns if c != "rule_id"]
    return upsert(catalog, rules, ["rule_id"], [c for c in columns if c != "active"], columns)


def rules_from_catalog(catalog: DataFrame, entity: str, rules: Sequence[Rule] = RULES) -> list[Rule]:
    """Active catalog rules of an entity (a handful of rows, read on the driver to build the plan).

    A rule that is not among ``rules``, or not with this expression, names no columns; ``check`` finds them.
    """
    columns = {(r.rule_id, r.expression): r.columns for r in rules}
    rows = catalog.where((F.col("entity") == entity) & F.col("active")).orderBy("rule_id").collect()
    return [
        Rule(r.rule_id, r.entity, r.description, r.severity, r.expression, columns.get((r.rule_id, r.expression), ()),
             r.rule_type, r.explain, r.active)
        for r in rows
    ]


# ---------------------------------------------------------------- inputs of the non-row rules

def with_policy_copies(staged: DataFrame) -> DataFrame:
    """Add how often the (broker, policy number) pair of the record occurs.

    The counts are pre-aggregated, and a pair that fills a third of the table is spread.
    """
    keyed = staged.withColumn("_pair", joint_key("broker_code", "policy_number"))
    repeated = (
        keyed.groupBy("_pair").agg(F.count("*").alias("policy_copies")).where(F.col("policy_copies") > 1)
    )
    joined = lookup_join(keyed, repeated, ["_pair"], ["stg_id"], name="repeated")
    return joined.withColumn("policy_copies", F.coalesce("policy_copies", F.lit(1))).drop("_pair")


def with_premium_distance(staged: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Add how many deviations the record's premium is from its peers' mean; NULL without a spread.

    Peers are the records of the batch and, if given, those whose moments ``history`` holds, with the same
    broker and product line. Reads ``staged`` twice.
    """
    value, group = POLICY_PEERS
    keyed = staged.withColumn("broker_key", surrogate_key(F.col("broker_code")))
    groups = changed_moments(history, moments(keyed, value, group), None)
    far = with_distance(keyed, value, group, "stg_id", groups)
    return far.select(*staged.columns, F.col("peer_distance").alias("premium_distance"))


def with_policy(
    claims: DataFrame, policies: DataFrame, stored: bool = True, cheap: bool = False, more: Sequence[str] = (), spread_by: Sequence[str] = ("stg_id",)
) -> DataFrame:
    """Add the keys of the referenced policy, whether it exists, and ``more`` columns of it. ``policies`` is a stored table or is small.

    One join serves the referential rule and the claim fact. A policy with a third of all claims is
    spread over the tasks. ``cheap`` claims are read twice rather than written out, see ``lookup_join``;
    where their id is dear to compute, other columns may tell them apart (``spread_by``).
    """
    lookup = policies.select(
        "policy_number", F.lit(True).alias("policy_exists"), "policy_key", "broker_key", "customer_key",
        "product_key", *more,
    )
    joined = lookup_join(claims, lookup, ["policy_number"], spread_by, stored=stored, cheap=cheap)
    return joined.withColumn("policy_exists", F.coalesce("policy_exists", F.lit(False)))


# ---------------------------------------------------------------- evaluation

def references(rows: DataFrame, expression: str) -> tuple[str, ...]:
    """The columns of ``rows`` that an expression reads, in the order in which it names them first.

    They are those that Spark resolves, so a name in a text or a lambda's variable is none.
    """
    found = rows.select(F.expr(expression))._jdf.queryExecution().analyzed().references().toSeq()
    written = {c.lower(): c for c in rows.columns}
    names = {written[found.apply(i).name().lower()] for i in range(found.length())}

    def place(column: str) -> int:
        at = re.search(rf"(?<![\w']){re.escape(column)}(?!\w)", expression, re.IGNORECASE)
        return at.start() if at else len(expression)

    return tuple(sorted(names, key=lambda c: (place(c), c)))


def _verdict(rule: Rule, columns: Sequence[str]) -> str:
    passed = f"coalesce({rule.expression}, false)"
    shown = [f"concat({text(c + '=')}, coalesce(cast({name(c)} AS string), 'NULL'))" for c in columns]
    observed = f"concat_ws(', ', {', '.join(shown)})" if shown else "cast(NULL AS string)"
    return (
        f"struct({text(rule.rule_id)} AS rule_id, {text(rule.severity)} AS severity, {passed} AS passed, "
        f"CASE WHEN NOT {passed} THEN {observed} END AS observed_value)"
    )


def check(staged: DataFrame, rules: Sequence[Rule], as_of: dt.date) -> DataFrame:
    """Add ``verdicts`` (one per rule; a NULL predicate counts as failed) and ``dq_status``.

    A rule that names no columns shows those that its expression reads. One that does not fit the columns of
    the records is rejected before any job starts.
    """
    dated = staged.withColumn("as_of", F.lit(as_of))
    columns = {r.rule_id: r.columns or [c for c in references(dated, r.expression) if c != "as_of"] for r in rules}
    verdicts = F.expr(f"array({', '.join(_verdict(r, columns[r.rule_id]) for r in rules)})")
    return once(dated, "verdicts", verdicts).drop("as_of").withColumn("dq_status", _status())


def _status() -> Column:
    """FAIL on a failed ERROR rule, WARN on any other failed rule, else PASS."""
    return (
        F.when(_fails("ERROR"), "FAIL").when(F.exists("verdicts", lambda v: ~v["passed"]), "WARN").otherwise("PASS")
    )


def _fails(severity: str) -> Column:
    return F.exists("verdicts", lambda v: ~v["passed"] & (v["severity"] == severity))


def promotable(checked: DataFrame) -> DataFrame:
    """ERROR blocks a record, WARN lets it through flagged, INFO only informs."""
    return checked.where(F.col("dq_status").isin(*PROMOTABLE))


def _all_pass(rules: Sequence[Rule]) -> str:
    return " AND ".join(["true", *[f"coalesce({r.expression}, false)" for r in rules]])


def promoted(staged: DataFrame, rules: Sequence[Rule], as_of: dt.date) -> DataFrame:
    """The records that ``promotable`` lets through, for whoever needs no verdicts.

    These are conditions alone. Each is evaluated where its columns are, also ahead of a join, and no array is built.
    """
    errors = [r for r in rules if r.severity == "ERROR"]
    return staged.withColumn("as_of", F.lit(as_of)).where(_all_pass(errors)).drop("as_of")


def failing(staged: DataFrame, rules: Sequence[Rule], as_of: dt.date) -> DataFrame:
    """The records that fail any rule, for whoever needs only failed verdicts."""
    return staged.withColumn("as_of", F.lit(as_of)).where(f"NOT ({_all_pass(rules)})").drop("as_of")


def results(checked: DataFrame, entity: str, batch_id: str, evaluated_at: Column, only_failed: bool = False) -> DataFrame:
    """The audit trail: one row per record and rule."""
    verdicts = F.filter("verdicts", lambda v: ~v["passed"]) if only_failed else F.col("verdicts")
    rows = checked.select("stg_id", "broker_code", F.explode(verdicts).alias("v"))
    return rows.select(
        F.md5(F.concat_ws("|", F.lit(batch_id), "stg_id", "v.rule_id")).alias("result_id"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(entity).alias("entity"),
        "stg_id",
        "broker_code",
        F.col("v.rule_id").alias("rule_id"),
        F.col("v.severity").alias("severity"),
        F.col("v.passed").alias("passed"),
        F.col("v.observed_value").alias("observed_value"),
        evaluated_at.alias("evaluated_at"),
    )


def quarantine(checked: DataFrame, entity: str, quarantined_at: Column) -> DataFrame:
    """Records with failed ERROR rules: the rule ids and the whole record as it was."""
    record = [c for c in checked.columns if c not in ("verdicts", "dq_status")]
    errors = F.filter("verdicts", lambda v: ~v["passed"] & (v["severity"] == "ERROR"))
    return checked.where(F.col("dq_status") == "FAIL").select(
        F.md5(F.concat_ws("|", F.lit(entity), "stg_id")).alias("quarantine_id"),
        F.lit(entity).alias("entity"),
        "stg_id",
        "broker_code",
        F.array_sort(F.transform(errors, lambda v: v["rule_id"])).alias("failed_rules"),
        F.to_json(F.struct(*record), {"ignoreNullFields": "false"}).alias("record_snapshot"),
        F.lit(None).cast("string").alias("explanation"),
        quarantined_at.alias("quarantined_at"),
        F.lit(False).alias("resolved"),
    )


def explanation(rules: Sequence[Rule]) -> Column:
    """Why a failed verdict of an explainable rule failed, from the verdict's own row; else NULL."""
    described = F.lit(None).cast("string")
    for rule in rules:
        if rule.explain:
            described = F.when(F.col("rule_id") == rule.rule_id, rule.description).otherwise(described)
    told = F.concat(
        described, F.lit(" - "), F.lower("severity"), F.lit(" on this "), F.col("entity"), F.lit(", which has "),
        F.col("observed_value"),
    )
    return F.when(~F.col("passed"), told)


def explained(results: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The audit trail with an explanation of every failure."""
    return results.withColumn("explanation", explanation(rules))


def batch_log(checked: DataFrame, entity: str, n_rules: int, batch_id: str, started_at: dt.datetime | None = None) -> DataFrame:
    """One row of counts per batch, with the time the checks began and that of the log."""

    def failures(severity: str) -> Column:
        failed = F.filter("verdicts", lambda v: ~v["passed"] & (v["severity"] == severity))
        return F.coalesce(F.sum(F.size(failed).cast("long")), F.lit(0).cast("long"))

    return checked.agg(
        F.count("*").alias("records_evaluated"),
        failures("ERROR").alias("error_failures"),
        failures("WARN").alias("warn_failures"),
        F.count_if(F.col("dq_status") == "FAIL").alias("quarantined"),
    ).select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(entity).alias("entity"),
        "records_evaluated",
        F.lit(n_rules).cast("long").alias("rules_evaluated"),
        "error_failures",
        "warn_failures",
        "quarantined",
        F.lit("SUCCESS").alias("status"),
        F.lit(started_at).cast("timestamp").alias("started_at"),
        F.current_timestamp().alias("ended_at"),
    )
