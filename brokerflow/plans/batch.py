"""One batch through all stages: landing, staging, checks, star schema, scores.

Policies are checked and promoted before the claims are checked, so that a claim finds the policy
that came in the same batch. Product lines are set in staging, before the checks read them, unless
``Options`` ask for the other order.

A batch costs what the batch holds. It writes its own rows to the keyed tables, reads the past only in
the buckets of the keys it touches, and keeps the peer groups' moments up to date, from which scores are
computed when the star schema is read (``star_of``). It ends with a commit, before which readers see none of
its tables but the logs. Its intermediate tables are deleted at its end.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brokerflow.config.rules import RULES, Rule
from brokerflow.operators import enrich, mapping, quality, star
from brokerflow.operators.anomaly import CLAIM_PEERS, POLICY_PEERS, changed_moments, moments, score_claims, score_policies, spread
from brokerflow.operators.inference import Provider, infer_distinct
from brokerflow.operators.joins import joint_key
from brokerflow.operators.staging import stage_claims, stage_policies
from brokerflow.operators.upsert import upsert
from brokerflow.plans.landing import keep_places, new_messages
from brokerflow.plans.scratch import current_scope, fits_broadcast, scope, settle, settle_measured, together
from brokerflow.plans.tables import Batch, Keyed, Tables, View
from brokerflow.plans.views import Star
from brokerflow.sources import envelopes

POLICIES = Keyed("dim_policy", ("policy_number",), tuple(star.POLICY_UPDATES))
CLAIMS = Keyed("fact_claim", ("claim_number",), tuple(star.CLAIM_UPDATES))
CUSTOMERS = Keyed("dim_customer", ("customer_id",))
PREMIUMS = Keyed("fact_premium", ("policy_key",))
POLICY_SCORES = Keyed("dim_policy_scores", ("policy_key",), ("anomaly_score", "anomaly_reason"))
CLAIM_SCORES = Keyed("fact_claim_scores", ("claim_key",), ("anomaly_score", "anomaly_reason"))
ANSWERS = Keyed("model_answers", ("asked",))
KEYED = (POLICIES, CLAIMS, CUSTOMERS, PREMIUMS, POLICY_SCORES, CLAIM_SCORES, ANSWERS)
SCORES = {POLICIES: POLICY_SCORES, CLAIMS: CLAIM_SCORES}

LAYOUT = ("record_type", "header_signature")
STAGES = ("landing", "header_mapping", "unmapped", "dq_policy", "promote_policies", "dq_claim", "promote_claims")
STAGE_LOG = (
    "run_id string, step int, stage string, rows_in long, rows_out long, rows_rejected long, message string, status string, "
    "started_at timestamp, logged_at timestamp"
)
RUN_LOG = "run_id string, status string, message string, started_at timestamp, ended_at timestamp"
PRODUCT_ANSWER = T.StructType([T.StructField("answered_line", T.StringType())])


class Options(NamedTuple):
    """What a run may be given besides its messages.

    ``rules`` are loaded into the rule catalog, whose active rules are evaluated. ``matcher`` maps unknown
    layouts. ``product_model`` answers (product_name) with (answered_line) where the word lists leave a
    policy unclassified. ``classify_after_checks`` is the order in which the checks see no product line.
    """

    rules: Sequence[Rule] = RULES
    matcher: Callable[[DataFrame], DataFrame] = mapping.match_headers
    product_model: Provider | None = None
    model_name: str = "rules"
    classify_after_checks: bool = False


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


class BatchRun:
    """The stages of one batch. Each writes its tables and a line of the stage log."""

    batch: Batch

    def __init__(self, spark: SparkSession, tables: Tables, batch_id: int, as_of: dt.date, options: Options):
        self.spark = spark
        self.tables = tables
        self.batch_id = batch_id
        self.as_of = as_of
        self.options = options
        self.run_id = f"batch-{batch_id}"
        self.began = _now()
        self.log: dict[str, tuple] = {}
        self.rules: dict[str, list[Rule]] = {}

    def _note(self, stage: str, rows_in: int, rows_out: int, rejected: int, began: dt.datetime, message: str = "") -> None:
        self.log[stage] = (self.run_id, STAGES.index(stage), stage, rows_in, rows_out, rejected, message, "SUCCESS", began, _now())

    def run(self, messages: DataFrame) -> str:
        self.batch = self.tables.begin(self.batch_id)
        self._status("RUNNING", "")
        failure = ""
        try:
            with scope(self.spark, self.run_id):
                self._stages(messages)
                for table in KEYED:
                    self.batch.compact(table)
                self.batch.commit()
        except Exception as error:
            failure = f"{type(error).__name__}: {error}"[:500]
            raise
        finally:
            self._finish(failure)
        done = sorted(self.log.values(), key=lambda entry: entry[1])
        return " | ".join(f"{stage}: {out} out, {bad} rejected" for _, _, stage, _, out, bad, *_ in done)

    def _stages(self, messages: DataFrame) -> None:
        held = current_scope()
        with scope(self.spark, f"{self.run_id}-landing"):  # the messages are not needed beyond staging
            (new, store), _ = together(lambda: self.land(messages), self.load_catalog)
            (staged_claims, staged_policies), _ = together(lambda: self.stage(new, held), store)
        self.promote_policies(staged_policies, then=lambda: self.promote_claims(staged_claims))

    # ------------------------------------------------------------ landing

    def land(self, messages: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
        """The usable rows of what is new; and the step that appends it to landing, which may run beside those that follow."""
        began = _now()
        new, came = new_messages(self.batch, messages)

        def store() -> None:
            landed, dead, _ = together(
                lambda: self.batch.append("raw", envelopes.landed(new)),
                lambda: self.batch.append("dead_letter", envelopes.dead(new)),
                lambda: keep_places(self.batch, new),
            )
            self._note("landing", came, landed, dead, began)

        return envelopes.usable(new), store

    def stage(self, new: DataFrame, held: str) -> tuple[DataFrame, DataFrame]:
        """The claims and the policies of the new rows and of those that waited, typed and stored in the scope ``held``."""
        registry, todo = self.map_headers(new)
        policies, claims = envelopes.route(todo)
        early = not self.options.classify_after_checks
        staged_claims, _, staged_policies = together(
            lambda: settle(stage_claims(claims, registry, early), "claims", held),
            lambda: self.keep_unmapped(policies, claims, registry),
            lambda: settle(self.classified(stage_policies(policies, registry, early)), "policies", held),
        )
        return staged_claims, staged_policies

    # ------------------------------------------------------------ header mapping

    def map_headers(self, new: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The registry with the batch's layouts; and the rows to stage, with those that waited for their layout."""
        began = _now()
        known = self.batch.past.current("registry")
        if known is None:
            known = mapping.seed_mappings(self.spark)
        n = self.batch.swap("registry", mapping.registry_for(new, known, self.options.matcher))
        registry = self.batch.now.current("registry")
        waiting = self.batch.past.current("waiting_layouts")
        if waiting is None:
            return self._mapped(registry, new, n, began, "")
        mapped = registry.where("mapping IS NOT NULL").select(*LAYOUT)
        free = settle(waiting.join(mapped, list(LAYOUT), "left_semi"), "free")
        batches = [r["batch_id"] for r in free.select("batch_id").distinct().collect()]  # those in which such a layout came
        if not batches:
            return self._mapped(registry, new, n, began, "")
        rows = self.tables.read_batches("waiting", batches).withColumn("_entity", envelopes.entity_of(F.col("record_type")))
        asked = free.select("header_signature", "batch_id", F.col("record_type").alias("_entity"))
        todo = new.unionByName(rows.join(asked, ["_entity", "header_signature", "batch_id"], "left_semi").select(*new.columns))
        return self._mapped(registry, todo, n, began, f"{free.select(*LAYOUT).distinct().count()} waiting layouts released")

    def _mapped(self, registry: DataFrame, todo: DataFrame, n: int, began: dt.datetime, message: str) -> tuple[DataFrame, DataFrame]:
        self._note("header_mapping", n, n, 0, began, message)
        return registry, todo

    def keep_unmapped(self, policies: DataFrame, claims: DataFrame, registry: DataFrame) -> None:
        """Set apart the rows without a mapping, and keep which layouts wait in which batch until they have one."""
        began = _now()
        if registry.where("mapping IS NULL").isEmpty():  # it holds the layout of every row
            waiting = mapping.with_signature(policies).limit(0)
        else:
            waiting = mapping.unmapped_rows(policies, registry, "policy").unionByName(mapping.unmapped_rows(claims, registry, "claim"))
        n, held = self.batch.append("waiting", waiting), self.batch.past.current("waiting_layouts")
        if n or held is not None:
            rows = self.batch.own("waiting")  # few, and read back rather than found again
            layouts = rows.groupBy(envelopes.entity_of(F.col("record_type")).alias("record_type"), "header_signature")
            own = layouts.agg(F.count("*").alias("records")).withColumn("batch_id", F.lit(self.batch_id).cast("long"))
            mapped = registry.where("mapping IS NOT NULL").select(*LAYOUT)
            self.batch.swap("waiting_layouts", own if held is None else held.join(mapped, list(LAYOUT), "left_anti").unionByName(own))
        self._note("unmapped", n, n, 0, began, "rows waiting for a mapping" if n else "")

    # ------------------------------------------------------------ enrichment

    def classified(self, staged: DataFrame) -> DataFrame:
        """Ask the model, if there is one, about policies that the word lists leave unclassified."""
        model = self.options.product_model
        if model is None or self.options.classify_after_checks:
            return staged
        held = settle(staged, "unclassified")
        open_ = F.coalesce("product_line", F.lit("OTHER")) == "OTHER"
        asked = held.where(open_).select("stg_id", "product_name")
        names, size = settle_measured(asked.select(joint_key("product_name").alias("asked")).distinct(), "asked_names")
        cache = self.batch.past.touched(ANSWERS, names, size)  # the answers of all batches, read in the buckets of these names
        answered, fresh, calls = infer_distinct(
            asked, ["product_name"], model, PRODUCT_ANSWER, cache, ["stg_id"], "product_line", self.options.model_name
        )
        self.batch.merge(ANSWERS, fresh.withColumn("asked", joint_key("product_name")))
        self.batch.append("model_call_log", calls)
        lines = answered.select("stg_id", "answered_line")
        return held.join(lines, "stg_id", "left").withColumn(
            "product_line", F.when(open_, F.coalesce("answered_line", "product_line")).otherwise(F.col("product_line"))
        ).drop("answered_line")

    # ------------------------------------------------------------ checks

    def load_catalog(self) -> None:
        rules = quality.rule_rows(self.spark, self.options.rules)
        self.batch.swap("rule_catalog", quality.load_rules(self.batch.past.current("rule_catalog"), rules))

        catalog = self.batch.now.current("rule_catalog")
        self.rules = {entity: quality.rules_from_catalog(catalog, entity, self.options.rules) for entity in ("policy", "claim")}

    def _check(self, staged: DataFrame, entity: str) -> DataFrame:
        """Evaluate the rules and write the staged batch with its verdicts; returns it."""
        self.batch.append(f"stg_{entity}", quality.check(staged, self.rules[entity], self.as_of))
        return self.batch.own(f"stg_{entity}")

    def _report(self, checked: DataFrame, entity: str, began: dt.datetime) -> None:
        """Write audit trail, quarantine and batch log of a checked batch."""
        rules = self.rules[entity]
        now = F.lit(self.as_of).cast("timestamp_ntz")
        audit = quality.explained(quality.results(checked, entity, self.run_id, now), rules)
        summary = quality.batch_log(checked, entity, len(rules), self.run_id, began)
        _, blocked, _ = together(
            lambda: self.batch.append(f"dq_result_{entity}", audit),
            lambda: self.batch.append(f"quarantine_{entity}", quality.quarantine(checked, entity, now)),
            lambda: self.batch.append(f"dq_batch_log_{entity}", summary),
        )
        n = checked.count()
        self._note(f"dq_{entity}", n, n - blocked, blocked, began)

    # ------------------------------------------------------------ promotion

    def promote_policies(self, staged: DataFrame, then: Callable[[], None]) -> None:
        """Check and promote the policies. ``then`` is run as soon as they can be looked up, beside the rest."""
        began = _now()
        known = self.batch.past.current(f"peers_{POLICIES.name}")
        measured = quality.with_premium_distance(quality.with_policy_copies(staged), known)
        checked = self._check(measured, "policy")
        good = quality.promotable(checked)
        if self.options.classify_after_checks:
            good = settle(enrich.classify_missing(good), "classified")

        started = _now()
        rows, size = settle_measured(star.policy_rows(good, self.as_of), "policy_rows")
        n = self.batch.merge(POLICIES, rows)

        def scores() -> None:
            self._score_peers(POLICIES, POLICY_PEERS, "policy_key", rows, size)
            self._note("promote_policies", n, n, 0, started)

        together(
            scores,
            lambda: self._report(checked, "policy", began),
            lambda: self.batch.merge(CUSTOMERS, star.customer_rows(good)),
            lambda: self.batch.merge(PREMIUMS, star.premium_rows(rows, None)),
            lambda: self.batch.swap("dim_product", star.product_rows(self.spark)),
            then,
        )

    def promote_claims(self, staged: DataFrame) -> None:
        began = _now()
        numbers, size = settle_measured(staged.select("policy_number").distinct(), "numbers")
        known = self.batch.now.touched(POLICIES, numbers, size)
        checked = self._check(quality.with_policy(staged, known, stored=False, cheap=True), "claim")
        good = quality.promotable(checked)
        if self.options.classify_after_checks:
            good = settle(enrich.score_missing_sentiment(good), "scored")

        def brokers() -> None:
            codes = star.broker_rows(self.batch.own("stg_policy"), checked)
            self.batch.swap("dim_broker", star.dim_broker(self.batch.past.current("dim_broker"), codes))

        def claims() -> None:
            started = _now()
            rows, size = settle_measured(star.claim_rows(good), "claim_rows")
            n, _ = together(
                lambda: self.batch.merge(CLAIMS, rows),
                lambda: self._score_peers(CLAIMS, CLAIM_PEERS, "claim_key", rows, size),
            )
            self._note("promote_claims", n, n, 0, started)

        together(lambda: self._report(checked, "claim", began), brokers, claims)

    def _score_peers(self, table: Keyed, peers: tuple[str, tuple[str, ...]], key: str, rows: DataFrame, size: int) -> None:
        """Bring the peer groups' moments up to date, and keep scores that can't be computed any more."""
        name = table.name
        known = self.batch.past.current(f"peers_{name}")
        old = self.batch.past.touched(table, rows, size)
        if old is None:
            now, gone = rows, None
        else:
            old = settle(old, f"old_{name}")
            others = [c for c in rows.columns if c not in table.keys]
            now = settle(upsert(old, rows, table.keys, table.updates, others).select(*rows.columns), f"now_{name}")
            gone = moments(old, *peers)
        self.batch.swap(f"peers_{name}", changed_moments(known, moments(now, *peers), gone))
        kept = self._kept_scores(table, peers, key, old, now, known)
        if kept is not None:
            self.batch.merge(SCORES[table], kept)

    def _kept_scores(
        self, table: Keyed, peers: tuple[str, tuple[str, ...]], key: str, old: DataFrame | None, now: DataFrame, known: DataFrame | None
    ) -> DataFrame | None:
        """The last scores of rows whose group has no spread any more, since such rows keep theirs."""
        if old is None or known is None:
            return None
        score = score_policies if table is POLICIES else score_claims
        spread_now = spread(self.batch.now.current(f"peers_{table.name}")).select("peers")
        flat = now.withColumn("peers", joint_key(*peers[1])).join(spread_now, "peers", "left_anti").select(key)
        kept = score(old, groups=known).join(flat, key, "left_semi")
        lost, size = settle_measured(spread(known).select("peers").join(spread_now, "peers", "left_anti"), "lost")
        if not lost.isEmpty():
            others = self.batch.past.keyed(table).join(now.select(key), key, "left_anti")
            asked = F.broadcast(lost) if fits_broadcast(size) else lost
            members = others.withColumn("peers", joint_key(*peers[1])).join(asked, "peers", "left_semi").drop("peers")
            kept = kept.unionByName(score(members.select(*kept.columns), groups=known))
        return kept.where("anomaly_score IS NOT NULL").select(key, "anomaly_score", "anomaly_reason")

    # ------------------------------------------------------------ logs

    def _status(self, status: str, message: str) -> None:
        ended = None if status == "RUNNING" else _now()
        row = self.spark.createDataFrame([(self.run_id, status, message, self.began, ended)], RUN_LOG)
        self.tables.log("run_log", row, self.batch_id)

    def _finish(self, failure: str) -> None:
        rows = sorted(self.log.values(), key=lambda entry: entry[1])
        if failure:
            at = next((s for s in STAGES if s not in self.log), STAGES[-1])
            rows.append((self.run_id, STAGES.index(at), at, 0, 0, 0, failure, "ERROR", self.began, _now()))
        self.tables.log("stage_log", self.spark.createDataFrame(rows, STAGE_LOG), self.batch_id)
        self._status("FAILED" if failure else "SUCCESS", failure)


def run_batch(spark: SparkSession, tables: Tables, batch_id: int, messages: DataFrame, as_of: dt.date, options: Options | None = None) -> str:
    """Run the batch, which must be the newest one; running it again replaces what it wrote."""
    return BatchRun(spark, tables, batch_id, as_of, options or Options()).run(messages)


def waiting_rows(tables: Tables) -> DataFrame | None:
    """The rows that still wait for a mapping of their layout."""
    view = tables.view()
    if view.state.batch < 0:
        return None
    layouts = view.current("waiting_layouts")
    if layouts is None:
        return view.read("waiting").limit(0)
    rows = view.read("waiting").withColumn("_entity", envelopes.entity_of(F.col("record_type")))
    asked = layouts.select("header_signature", "batch_id", F.col("record_type").alias("_entity"))
    return rows.join(asked, ["_entity", "header_signature", "batch_id"], "left_semi").drop("_entity")


def _scored(view: View, table: Keyed, key: str) -> DataFrame:
    rows, kept = view.keyed(table), view.keyed(SCORES[table])
    if kept is not None:
        last = kept.select(key, F.struct("anomaly_score", "anomaly_reason").alias("_kept"))
        rows = rows.join(last, key, "left").select(
            *[F.col(f"_kept.{c}").alias(c) if c in ("anomaly_score", "anomaly_reason") else F.col(c) for c in rows.columns]
        )
    score = score_policies if table is POLICIES else score_claims
    return score(rows, groups=view.current(f"peers_{table.name}"))


def star_of(tables: Tables) -> Star:
    """The star schema as the last commit names it, scored against the peer groups of that time."""
    view = tables.view()
    return Star(
        view.current("dim_broker"),
        view.keyed(CUSTOMERS),
        _scored(view, POLICIES, "policy_key"),
        _scored(view, CLAIMS, "claim_key"),
        unscored=view.keyed(POLICIES),
    )
