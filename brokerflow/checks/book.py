"""The frames the registered queries start from, built from one scale folder on first use.

A frame that a query reads several times and that costs a shuffle is written once per query
(``settle``), as its table would be in a deployment. Nothing is kept between queries.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brokerflow.config.rules import rules_for
from brokerflow.functions.keys import raw_id
from brokerflow.functions.payload import TEXT_MAP, header_signature
from brokerflow.operators import mapping, quality, star
from brokerflow.operators.anomaly import CLAIM_PEERS, moments, score_claims, score_policies
from brokerflow.operators.joins import lookup_join
from brokerflow.operators.staging import stage_claims, stage_policies
from brokerflow.operators.upsert import repeats_apart
from brokerflow.plans import views
from brokerflow.plans.metrics import Catalog
from brokerflow.plans.scratch import settle
from brokerflow.sources import testdata
from brokerflow.sources.envelopes import LANDING, NO_OBJECT, PLACE, decode, drop_redelivered, route

BATCH = "batch-1"
#: Columns of policies and customers that the claims of a book carry for those who ask for them.
CARRIED = ("policy_number", "product_line", "customer_name")
#: What tells claims of the same policy apart; their ids are hashes of hashes.
APART = ("claim_number", "claim_amount", "loss_date", "reported_date")


def run_time() -> Column:
    return F.lit(testdata.AS_OF).cast("timestamp_ntz")


def _signed(decoded: DataFrame) -> DataFrame:
    """Decoded messages with a map, and so a signature, also where the payload is missing or has no fields."""
    no_fields = F.when(F.col("payload") == "{}", F.create_map().cast(TEXT_MAP))
    mapped = decoded.withColumn("payload_map", F.coalesce("payload_map", no_fields))
    unsigned = F.when(F.size("payload_map") == 0, header_signature(F.array().cast("array<string>")))
    return mapped.withColumn("header_signature", F.coalesce("header_signature", unsigned))


class Book:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    # ------------------------------------------------------------ wire side

    @cached_property
    def messages(self) -> DataFrame:
        return testdata.messages(self.spark, self.sf_dir).drop("copy")

    def deliveries(self, n: int) -> list[DataFrame]:
        sent = settle(testdata.delivered(testdata.messages(self.spark, self.sf_dir), n), "deliveries")
        return [sent.where(F.col("delivery") == i).drop("delivery") for i in range(n)]

    @cached_property
    def landed(self) -> DataFrame:
        """The landing rows as one plan, for queries that read them once. The payload is a map, which nobody has to parse again."""
        decoded = _signed(decode(drop_redelivered(self.messages))).where(~F.col("problem").eqNullSafe(NO_OBJECT))
        return decoded.select(*[c for c in LANDING if c != "payload"], "payload_map", "header_signature")

    @cached_property
    def raw(self) -> DataFrame:
        """The landing rows as mapping and staging read them. Every message is built and decoded once; its id follows from its place."""
        place = dict(zip(("kafka_topic", "kafka_partition", "kafka_offset"), PLACE, strict=True))
        needed = ("broker_code", "record_type", "ingested_at", "payload_map", "header_signature", "problem")
        held = settle(_signed(decode(self.messages)).withColumnsRenamed(place).select(*PLACE, *needed), "raw")
        once = drop_redelivered(held, keep=lambda again: settle(again, "again")).where(~F.col("problem").eqNullSafe(NO_OBJECT))
        return once.select(raw_id(*map(F.col, PLACE)).alias("raw_id"), *needed[:-1])

    @cached_property
    def registry(self) -> DataFrame:
        return settle(mapping.registry_for(self.raw, mapping.seed_mappings(self.spark)), "registry")

    @cached_property
    def wire_policies(self) -> DataFrame:
        return stage_policies(route(self.raw)[0], self.registry)

    @cached_property
    def wire_claims(self) -> DataFrame:
        return stage_claims(route(self.raw)[1], self.registry)

    # ------------------------------------------------------------ staging and checks

    @cached_property
    def policies(self) -> DataFrame:
        return testdata.staged_policies(self.spark, self.sf_dir)

    @cached_property
    def claims(self) -> DataFrame:
        return testdata.staged_claims(self.spark, self.sf_dir)

    @cached_property
    def checked_policies(self) -> DataFrame:
        return quality.check(self.policies, rules_for("policy", "expression"), testdata.AS_OF)

    @cached_property
    def checked_claims(self) -> DataFrame:
        """Claims with all their verdicts, the referential one included."""
        return quality.check(self._with_policy(self.claims, self.unscored_policies), rules_for("claim"), testdata.AS_OF)

    def _with_policy(self, claims: DataFrame, policies: DataFrame, more: Sequence[str] = ()) -> DataFrame:
        # A claim is computed from its own line, so claims are computed again rather than written out.
        return quality.with_policy(claims, policies, cheap=True, more=more, spread_by=APART)

    def _promoted_claims(self, policies: DataFrame, more: Sequence[str] = ()) -> DataFrame:
        """Claims that pass the rules on their own line are looked up, and those with a policy kept."""
        own = quality.promoted(self.numbered_claims, rules_for("claim", "expression"), testdata.AS_OF)
        others = [r for r in rules_for("claim") if r.rule_type != "expression"]
        return quality.promoted(self._with_policy(own, policies, more), others, testdata.AS_OF)

    @cached_property
    def promoted_policies(self) -> DataFrame:
        return quality.promoted(self.policies, rules_for("policy", "expression"), testdata.AS_OF)

    def checked(self, entity: str) -> DataFrame:
        return self.checked_policies if entity == "policy" else self.checked_claims

    @cached_property
    def failures(self) -> DataFrame:
        """Failed verdicts of row, referential and batch rules, of both entities."""
        measured = quality.with_premium_distance(quality.with_policy_copies(settle(self.policies, "policies")))
        claims = self._with_policy(self.claims, self.unscored_policies)

        def failed(rows: DataFrame, entity: str) -> DataFrame:
            checked = quality.check(quality.failing(rows, rules_for(entity), testdata.AS_OF), rules_for(entity), testdata.AS_OF)
            return quality.results(checked, entity, BATCH, run_time(), only_failed=True)

        return failed(measured, "policy").unionByName(failed(claims, "claim"))

    # ------------------------------------------------------------ star schema

    @cached_property
    def policy_rows(self) -> DataFrame:
        """The policy dimension as one plan, for queries that read it once."""
        return star.policy_rows(self.promoted_policies, testdata.AS_OF)

    @cached_property
    def unscored_policies(self) -> DataFrame:
        return settle(self.policy_rows, "dim_policy")

    @cached_property
    def claim_rows(self) -> DataFrame:
        """The claim fact as one plan; whoever reads it takes the columns it needs."""
        return star.claim_rows(self._promoted_claims(self.unscored_policies))

    @cached_property
    def numbered_claims(self) -> DataFrame:
        numbered = repeats_apart(testdata.claims(self.spark, self.sf_dir), ["claim_number"])
        return testdata.staged_claims(self.spark, self.sf_dir, numbered)

    def claims_carrying(self, columns: Sequence[str]) -> DataFrame:
        """The claim fact with columns of its policy and customer, which come with the lookup of its keys.

        So claims are dealt out once, and customers are looked up for policies, which are fewer and narrower.
        """
        policies = self.named_policies if "customer_name" in columns else self.unscored_policies
        promoted = self._promoted_claims(policies, [c for c in columns if c != "policy_number"])
        referenced = F.when(F.col("policy_exists"), F.col("policy_number"))
        return star.claim_rows(promoted.withColumn("policy_number", referenced), columns)

    @cached_property
    def named_policies(self) -> DataFrame:
        """What claims take over from their policies, with the names of the customers."""
        narrow = self.unscored_policies.select("policy_number", "policy_key", "broker_key", "customer_key", "product_key", "product_line")
        names = self.dim_customer.select("customer_key", "customer_name")
        return settle(lookup_join(narrow, names, ["customer_key"], ["policy_key"], stored=True, cheap=True), "named_policies")

    @cached_property
    def dim_policy(self) -> DataFrame:
        return score_policies(self.unscored_policies)

    @cached_property
    def fact_claim(self) -> DataFrame:
        return score_claims(self.claim_rows, groups=self.claim_peers)

    @cached_property
    def claim_peers(self) -> DataFrame:
        return settle(moments(self.claim_rows, *CLAIM_PEERS), "peers")

    @cached_property
    def claim_scores(self) -> DataFrame:
        """Number, score and reason of every claim, from a copy of the columns they follow from."""
        rows = self.claim_rows.select("claim_key", "claim_number", "product_key", "claim_amount", "anomaly_score", "anomaly_reason")
        return score_claims(settle(rows, "claim_values"))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return settle(star.customer_rows(self.promoted_policies), "dim_customer")

    @cached_property
    def dim_broker(self) -> DataFrame:
        return star.broker_rows(self.policies, self.claims)

    def tables(self, scored: bool = True) -> "BookStar":
        return BookStar(self, scored)

    # ------------------------------------------------------------ views

    @cached_property
    def freshness(self) -> DataFrame:
        return views.ingest_freshness(testdata.raw_events(self.spark, self.sf_dir))

    @cached_property
    def health(self) -> DataFrame:
        return views.ingestion_health(self.freshness, testdata.EVENTS_AS_OF)

    @cached_property
    def summary(self) -> DataFrame:
        catalog = quality.load_rules(None, quality.rule_rows(self.spark))
        return views.validation_summary(self.failures, catalog)

    def catalog(self, scored: bool = False) -> Catalog:
        tables = self.tables(scored)
        return {
            "POLICIES": lambda columns: views.policies_view(tables, columns),
            "CLAIMS": lambda columns: views.claims_view(tables, columns),
            "BROKER_PERFORMANCE": lambda columns: views.broker_performance(tables),
            "INGESTION_HEALTH": lambda columns: self.health,
            "VALIDATION_SUMMARY": lambda columns: self.summary,
        }


class BookStar:
    """The star tables of a book, each built when a view first asks for it."""

    def __init__(self, book: Book, scored: bool):
        self._book = book
        self._scored = scored

    @cached_property
    def dim_broker(self) -> DataFrame:
        return settle(self._book.dim_broker, "dim_broker")

    @property
    def dim_customer(self) -> DataFrame:
        return self._book.dim_customer

    @property
    def dim_policy(self) -> DataFrame:
        return self._book.dim_policy if self._scored else self._book.unscored_policies

    stored = True

    @property
    def plain_policies(self) -> DataFrame:
        return self._book.unscored_policies

    @property
    def fact_claim(self) -> DataFrame:
        return self._book.fact_claim if self._scored else self._book.claim_rows

    def claims(self, columns: Sequence[str]) -> DataFrame:
        carried = [c for c in CARRIED if c in columns]
        if not carried:
            return self.fact_claim
        rows = self._book.claims_carrying(carried)
        return score_claims(rows, groups=self._book.claim_peers) if self._scored else rows


def plain(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Values in types that compare across engines: double, bigint, text, boolean."""
    out = []
    for field in df.schema.fields:
        if columns is not None and field.name not in columns:
            continue
        column = F.col(f"`{field.name}`")
        kind = field.dataType.simpleString()
        if kind.startswith("decimal") or kind == "float":
            column = column.cast("double")
        elif kind in ("int", "smallint", "tinyint"):
            column = column.cast("bigint")
        elif kind == "date":
            column = column.cast("string")
        elif kind.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif kind == "array<string>":
            column = F.array_join(column, "|")
        out.append(column.alias(field.name))
    return df.select(*out)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    for name in columns:
        df = df.withColumn(name, F.round(F.col(name).cast("double"), digits))
    return df
