"""Batch runs and streams."""

from __future__ import annotations

import datetime as dt
import json
import time
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brokerflow.checks.book import Book
from brokerflow.config.brokers import BROKERS
from brokerflow.config.rules import RULES, Rule
from brokerflow.plans import batch as batch_module
from brokerflow.plans import landing
from brokerflow.plans import tables as tables_module
from brokerflow.plans.batch import CLAIMS, CUSTOMERS, POLICIES, PREMIUMS, Options, run_batch, star_of, waiting_rows
from brokerflow.plans.scratch import shared_folder
from brokerflow.plans.tables import Keyed, Tables
from brokerflow.plans.views import claims_view, policies_view
from brokerflow.sources import envelopes as ev
from brokerflow.streaming import ingest
from tests.test_envelopes import log

AS_OF = dt.date(2025, 6, 30)
T_SCHEMA = StructType().add("k", "string").add("a", "integer").add("b", "integer").json()


def policy(number, premium="100", name="Ann", broker="BRK_ALPHA", **more):
    values = {"policy_number": number, "customer_name": name, "product_name": "Private Motor", "premium_amount": premium,
              "effective_date": "2025-01-01", "expiry_date": "2026-01-01", "sum_insured": "9000", "broker_agent": "A", **more}
    payload = {h: values[f] for h, f in BROKERS[broker].headers["policy"].items()}
    return json.dumps({"broker_code": broker, "source_format": "csv", "record_type": "policy", "payload": payload})


def claim(number, of, status="OPEN", amount="10", broker="BRK_GAMMA"):
    values = {"claim_number": number, "policy_number": of, "loss_date": "2025-05-01", "reported_date": "2025-05-02",
              "claim_amount": amount, "claim_status": status, "loss_description": "Minor damage"}
    payload = {h: values[f] for h, f in BROKERS[broker].headers["claim"].items()}
    return json.dumps({"broker_code": broker, "source_format": "csv", "record_type": "claim", "payload": payload})


FIRST = [policy("P1"), policy("P2", premium="-1"), claim("C1", "P1"), claim("C2", "P2"), "junk",
         json.dumps({"broker_code": "B", "record_type": "policy", "payload": {"zzz": 1}})]
SECOND = [policy("P1", premium="250"), policy("P2"), claim("C1", "P1", "paid"), claim("C3", "P2")]


def tables_after(spark, path, *batches, options=None):
    """The tables after some batches, each with its own places in the log."""
    tables = Tables(spark, str(path))
    for i, values in batches:
        run_batch(spark, tables, i, log(spark, values, start=20 * i), AS_OF, options)
    return tables


def content(tables):
    policies = policies_view(star_of(tables), ("policy_number", "premium_amount", "customer_name", "broker_name"))
    claims = claims_view(star_of(tables), ("claim_number", "claim_status", "policy_number", "claim_amount"))
    return sorted(map(str, policies.collect())), sorted(map(str, claims.collect()))


@pytest.fixture(scope="module")
def two_batches(spark, tmp_path_factory):
    return tables_after(spark, tmp_path_factory.mktemp("t"), (0, FIRST), (1, SECOND))


def test_first_batch_and_its_waiting_rows(spark, tmp_path):
    tables = tables_after(spark, tmp_path, (0, FIRST))
    assert [r.policy_number for r in tables.keyed(POLICIES).collect()] == ["P1"]
    assert [r.claim_number for r in tables.keyed(CLAIMS).collect()] == ["C1"]  # C2 refers to a blocked policy
    assert tables.read("dead_letter").count() == 1
    assert waiting_rows(tables).count() == 1
    blocked = tables.read("quarantine_claim").first()
    assert blocked.failed_rules == ["CLM_008"]
    results = tables.read("dq_result_policy")
    assert results.where("rule_id = 'POL_002' AND NOT passed").first().explanation.startswith("Premium must be a positive number - error on this policy, which has premium_amount=-1")
    log_rows = {r.stage: (r.rows_out, r.rows_rejected) for r in tables.read_log("stage_log").collect()}
    assert log_rows["landing"] == (5, 1)
    assert log_rows["dq_policy"] == (1, 1)
    assert log_rows["unmapped"] == (1, 0)

    # The unmapped row is staged as soon as its layout is known.
    known = tables.current("registry").withColumn(
        "mapping", F.when(F.col("broker_code") == "B", F.create_map(F.lit("zzz"), F.lit("policy_number"))).otherwise(F.col("mapping"))
    )
    correction = tables.begin(1)
    correction.swap("registry", known)
    correction.commit()
    run_batch(spark, tables, 2, log(spark, [policy("P9")], start=50), AS_OF)
    assert waiting_rows(tables).count() == 0
    assert sorted(r.policy_number for r in tables.read_batch("stg_policy", 2).collect()) == ["1", "P9"]


def test_second_batch_merges(spark, two_batches):
    policies = {r.policy_number: r for r in two_batches.keyed(POLICIES).collect()}
    assert {n: float(p.premium_amount) for n, p in policies.items()} == {"P1": 250.0, "P2": 100.0}
    claims = {r.claim_number: r.claim_status for r in two_batches.keyed(CLAIMS).collect()}
    assert claims == {"C1": "PAID", "C3": "OPEN"}
    premiums = {r.policy_key: float(r.premium_amount) for r in two_batches.keyed(PREMIUMS).collect()}
    assert premiums == {policies["P1"].policy_key: 100.0, policies["P2"].policy_key: 100.0}
    assert two_batches.keyed(CUSTOMERS).count() == 1
    assert waiting_rows(two_batches).count() == 1  # the unmapped row was not lost
    assert two_batches.read("raw").count() == 9


def test_running_a_batch_again_changes_nothing(spark, two_batches):
    appended = ("raw", "stg_policy", "dq_result_claim", "quarantine_policy")
    before = content(two_batches), [two_batches.read(n).count() for n in appended], two_batches.read_log("stage_log").count()
    run_batch(spark, two_batches, 1, log(spark, SECOND, start=20), AS_OF)
    assert (content(two_batches), [two_batches.read(n).count() for n in appended], two_batches.read_log("stage_log").count()) == before


def test_streamed_batches_equal_batch_runs(spark, tmp_path, two_batches):
    """Two files as two micro-batches, the query stopped in between, give the tables of two runs."""
    source, root, state = (str(tmp_path / n) for n in ("log", "tables", "state"))
    tables = Tables(spark, root)
    for i, values in enumerate((FIRST, SECOND)):
        rows = log(spark, values, start=20 * i).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        rows.coalesce(1).write.mode("append").parquet(source)
        stream = ingest.read_log_files(spark, source, ev.LOG_SCHEMA, max_files=1)
        ingest.stream_batches(stream, tables, state, lambda: AS_OF, every=None).awaitTermination()
    assert content(tables) == content(two_batches)


def test_landing_stream(spark, tmp_path):
    source, root, state = (str(tmp_path / n) for n in ("log", "tables", "state"))
    rows = log(spark, [*FIRST, "{}"]).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    rows.unionByName(rows).coalesce(1).write.parquet(source)  # everything delivered twice
    stream = ingest.read_log_files(spark, source, ev.LOG_SCHEMA)
    tables = Tables(spark, root)
    ingest.append_raw(stream, tables, state, every=None).awaitTermination()
    assert tables.read("raw_policy").count() == 4
    assert tables.read("raw_claim").count() == 2
    assert sorted(r.problem for r in tables.read("dead_letter").collect()) == ["no payload fields", "not a JSON object"]
    ingest.append_raw(stream, tables, state, every=None).awaitTermination()  # nothing new
    assert tables.read("raw_policy").count() == 4


def test_redelivery_on_a_stream(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("log", "out", "state"))
    rows = log(spark, FIRST).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    for _ in range(2):
        rows.coalesce(1).write.mode("append").parquet(source)
    stream = ev.drop_redelivered(ingest.read_log_files(spark, source, ev.LOG_SCHEMA, max_files=1), "1 day")
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
    writer.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == len(FIRST)


def test_snapshots_are_those_of_the_commit(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    assert tables.current("t") is None
    for n in range(5):
        batch = tables.begin(n)
        assert batch.swap("t", spark.range(n)) == n
        assert tables.current("t") is None if n == 0 else tables.current("t").count() == n - 1  # not before the commit
        batch.commit()
    tables.begin(9).swap("t", spark.range(99))
    assert tables.current("t").count() == 4
    assert tables.begin(4).past.current("t").count() == 3  # batch 4 starts again, from what batch 3 left
    assert tables.current("t").count() == 3
    tables.prune(3)
    assert tables.begin(3).past.current("t").count() == 2
    assert not (tmp_path / "t" / "snapshot=1").exists()


TABLE = Keyed("t", ("k",), ("a",), buckets=4)


def deliver(spark, tables, n, rows, compact=True):
    batch = tables.begin(n)
    assert batch.merge(TABLE, spark.createDataFrame(rows, "k string, a int, b int")) == len(rows)
    if compact:
        batch.compact(TABLE)
    batch.commit()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_keyed_tables_merge_deliveries_on_read(spark, tmp_path, monkeypatch):
    tables = Tables(spark, str(tmp_path))
    assert tables.keyed(TABLE) is None
    for n, rows in enumerate(([], [("x", 1, 1), ("y", 2, 2)], [("y", 20, 20)], [("y", None, 30), ("z", 3, 3)], [("x", 9, 9)])):
        deliver(spark, tables, n, rows)
        if not n:
            assert rows_of(tables.keyed(TABLE)) == []
    wanted = [("x", 9, 1), ("y", None, 2), ("z", 3, 3)]
    asked = spark.createDataFrame([("y",), ("q",)], "k string")
    nobody = spark.createDataFrame([("nobody",)], "k string")

    def check():
        assert rows_of(tables.keyed(TABLE)) == wanted
        for size in (1, 1 << 40):
            assert rows_of(tables.view().touched(TABLE, asked, size)) == [("y", None, 2)]
        assert rows_of(tables.view().touched(TABLE, nobody, 1)) == []

    check()
    assert rows_of(tables.begin(5).past.keyed(TABLE)) == wanted
    monkeypatch.setattr(tables_module, "MERGE_AT", 1)
    batch = tables.begin(5)
    assert batch.compact(TABLE)
    batch.commit()
    check()
    assert not tables.view().state.keyed["t"].changes
    deliver(spark, tables, 6, [("z", 30, 30), ("w", 5, 5)], compact=False)
    wanted = [("w", 5, 5), ("x", 9, 1), ("y", None, 2), ("z", 30, 3)]
    check()
    monkeypatch.setattr("brokerflow.plans.scratch.BROADCAST_BYTES", -1)
    check()
    tables.rewind(3)
    assert rows_of(tables.keyed(TABLE)) == [("x", 1, 1), ("y", 20, 2)]


def test_other_buckets_are_neither_read_nor_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables_module, "MERGE_AT", 3)
    tables = Tables(spark, str(tmp_path))
    names = [f"k{i}" for i in range(40)]
    bucket = {r.k: r.b for r in spark.createDataFrame([(k,) for k in names], "k string").select("k", TABLE.bucket().alias("b")).collect()}
    deliver(spark, tables, 0, [(k, 0, 0) for k in names])
    mine = [k for k in names if bucket[k] == bucket["k0"]]
    assert len(mine) < len(names)
    for n in range(1, 8):  # the bucket's base is written in batches 2 and 5, and no other one's
        files = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
        deliver(spark, tables, n, [(mine[n % len(mine)], n, n)])
        assert {p: p.stat().st_mtime_ns for p in files} == files
    written = {p.relative_to(tmp_path).parts[1:3] for p in (tmp_path / "t_base").rglob("*.parquet")}
    assert written == {(f"batch_id={n}", f"bucket={bucket['k0']}") for n in (2, 5)}
    asked = spark.createDataFrame([(mine[0],), (mine[1],)], "k string")
    read = tables.view().touched(TABLE, asked, 1).inputFiles()
    assert read and all(f"/bucket={bucket['k0']}/" in f for f in read)
    assert len(read) == 3  # the base and the changes since
    assert rows_of(tables.keyed(TABLE)) == sorted([(k, max([n for n in range(1, 8) if mine[n % len(mine)] == k], default=0), 0) for k in names], key=str)


def test_pruning_keeps_what_later_batches_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables_module, "MERGE_AT", 2)
    tables = Tables(spark, str(tmp_path))
    for n in range(7):
        deliver(spark, tables, n, [(f"k{i}", n, n) for i in range(n % 3, 12, 3)])
    want, before = rows_of(tables.keyed(TABLE)), len(list(tmp_path.rglob("*.parquet")))
    past = rows_of(tables.begin(7).past.keyed(TABLE))
    tables.prune(6)
    assert len(list(tmp_path.rglob("*.parquet"))) < before
    assert rows_of(tables.keyed(TABLE)) == want == past
    earlier = tables.begin(6).past
    assert earlier.state.batch == 5 and len(rows_of(earlier.keyed(TABLE))) == 12


def test_the_last_of_many_batches_opens_few_files(spark, tmp_path):
    """Five hundred batches of one row: what the last one lists and opens doesn't grow with their number."""
    tables, opened = Tables(spark, str(tmp_path)), {}
    parts = tables_module.Parts({b: 480 for b in range(4)}, {b: [493 + b] for b in range(4)}, {493 + b: (1, 9) for b in range(4)}, T_SCHEMA)
    for n in range(500):  # commits are small files; the tables of most batches are not needed for this
        commit = Path(tables._commit(n))
        commit.parent.mkdir(parents=True, exist_ok=True)
        commit.write_text(tables_module.State(n, {landing.RANGES: n}, {"t": parts}).text())
    for b in range(4):
        for name, number in (("t_base", 480), ("t_changes", 493 + b)):
            spark.createDataFrame([(f"{name}{b}", b, b)], "k string, a int, b int").coalesce(1).write.parquet(str(tmp_path / name / f"batch_id={number}" / f"bucket={b}"))
    spark.createDataFrame([("t", 0, 0, 499)], "topic string, partition int, first long, last long").coalesce(1).write.parquet(str(tmp_path / landing.RANGES / "snapshot=499"))
    listed, listing = [], tables._list
    tables._list = lambda path: listed.append(path) or listing(path)
    batch = tables.begin(500)
    opened["ranges"] = batch.past.current(landing.RANGES).inputFiles()
    opened["t"] = batch.past.touched(TABLE, spark.createDataFrame([("t_base0",)], "k string"), 1).inputFiles()
    assert len(opened["ranges"]) == 1 and len(opened["t"]) <= 2
    assert len(listed) <= 6 and len(listing(f"{tmp_path}/_commits")) == 1


def test_ranges_of_offsets(spark):
    held = [("t", 0, o) for o in (5, 6, 7, 9, 10, 20, 7)] + [("t", 1, 3), ("u", 0, 4), ("u", 0, 5)]
    places = spark.createDataFrame(held, "topic string, partition int, offset long")
    want = [("t", 0, 5, 7), ("t", 0, 9, 10), ("t", 0, 20, 20), ("t", 1, 3, 3), ("u", 0, 4, 5)]
    got = landing.ranges_of(places)
    assert rows_of(got) == sorted(want, key=str)
    landing_stretch = landing.STRETCH
    try:
        landing.STRETCH = 2
        assert rows_of(landing.ranges_of(places)) == sorted(want, key=str)
    finally:
        landing.STRETCH = landing_stretch
    more = spark.createDataFrame([("t", 0, 8, 8), ("t", 0, 11, 30), ("u", 0, 1, 2)], got.schema)
    assert rows_of(landing.islands(got.unionByName(more), ["topic", "partition"])) == [("t", 0, 5, 30), ("t", 1, 3, 3), ("u", 0, 1, 2), ("u", 0, 4, 5)]


@pytest.mark.parametrize("stretch", [1 << 20, 3])
def test_redelivery_is_found_by_ranges(spark, tmp_path, monkeypatch, stretch):
    """Batches that overlap, fill gaps and repeat themselves land each place once, as sets of places say."""
    monkeypatch.setattr(landing, "STRETCH", stretch)
    tables, seen = Tables(spark, str(tmp_path)), set()
    for n, offsets in enumerate(([0, 1, 2, 8, 9], [3, 4, 2, 4], [5, 6, 7, 0, 8, 11], [20, 21, 22], [10, 21, 30, 10], [])):
        batch = tables.begin(n)
        messages = log(spark, [policy(f"P{o}") for o in offsets] or ["x"]).where(F.lit(bool(offsets)))
        numbered = messages.withColumn("offset", F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets or [0]]), (F.col("offset") + 1).cast("int")))
        new, came = landing.new_messages(batch, numbered)
        got = sorted(r.kafka_offset for r in new.select("kafka_offset").collect())
        assert (got, came) == (sorted(set(offsets) - seen), len(offsets))
        landing.keep_places(batch, new)
        batch.commit()
        seen |= set(offsets)
        held = sorted(o for r in tables.current(landing.RANGES).collect() for o in range(r["first"], r["last"] + 1))
        assert held == sorted(seen)
    assert tables.current(landing.RANGES).count() == 3


def test_a_batch_without_repeats_is_stored_once(spark, tmp_path, monkeypatch):
    stored, settle = [], landing.settle
    monkeypatch.setattr(landing, "settle", lambda df, name: stored.append(name) or settle(df, name))
    batch = Tables(spark, str(tmp_path)).begin(0)
    landing.new_messages(batch, log(spark, FIRST))
    assert stored == ["decoded"]


def everything(tables):
    """All tables of a run as values, times and run numbers aside."""
    appended = ("raw", "dead_letter", "stg_policy", "stg_claim", "dq_result_policy", "dq_result_claim", "quarantine_policy", "quarantine_claim")
    skipped = {"evaluated_at", "quarantined_at"}
    rows = {n: sorted(map(str, tables.read(n).drop(*skipped).collect())) for n in appended}
    rows["star"] = content(tables)
    for table in (POLICIES, CLAIMS, CUSTOMERS, PREMIUMS):
        rows[table.name] = sorted(map(str, tables.keyed(table).collect()))
    rows["peers"] = sorted(map(str, tables.current("peers_dim_policy").collect()))
    return rows


THIRD = [policy("P5"), claim("C9", "P5"), policy("P1", premium="300")]
EARLY = [policy("P1"), claim("C9", "P5"), policy("P2", premium="-1")]  # C9's policy comes one batch later


def test_older_batches_are_refused_and_repeat_after_a_rewind(spark, tmp_path):
    batches = [(0, EARLY), (1, THIRD)]
    tables = tables_after(spark, tmp_path, *batches)
    first = everything(tables)
    assert tables.read_batch("stg_claim", 0).first().dq_status == "FAIL"
    with pytest.raises(ValueError, match="older than batch 1"):
        run_batch(spark, tables, 0, log(spark, EARLY), AS_OF)
    assert everything(tables) == first
    tables.rewind(0)
    for i, values in batches:
        run_batch(spark, tables, i, log(spark, values, start=20 * i), AS_OF)
    assert everything(tables) == first
    assert tables.read_batch("stg_claim", 0).first().dq_status == "FAIL"


def test_a_place_in_the_log_lands_once_and_empty_payloads_are_dead(spark, tmp_path):
    odd = [json.dumps({"broker_code": "B", "record_type": "policy", "payload": p}) for p in ({}, None, [1], "text")]
    tables = Tables(spark, str(tmp_path))
    run_batch(spark, tables, 0, log(spark, [*odd, "junk", policy("P1")]), AS_OF)
    run_batch(spark, tables, 1, log(spark, [policy("P1"), policy("P3")], start=5), AS_OF)  # place 5 comes again
    raw = tables.read("raw")
    assert (raw.count(), raw.select("raw_id").distinct().count()) == (6, 6)
    problems = sorted(r.problem for r in tables.read("dead_letter").collect())
    assert problems == ["no payload fields"] * 4 + ["not a JSON object"]
    assert waiting_rows(tables).count() == 0


def test_the_catalog_steers_the_checks(spark, tmp_path):
    off = [r._replace(active=False) if r.rule_id == "POL_002" else r for r in RULES]
    changed = [r._replace(expression="length(customer_name) >= 5", severity="WARN") if r.rule_id == "POL_006" else r for r in off]
    tables = tables_after(spark, tmp_path, (0, FIRST), options=Options(rules=changed))
    rules = {r.rule_id for r in tables.read("dq_result_policy").select("rule_id").distinct().collect()}
    assert "POL_002" not in rules and "BATCH_002" in rules and "BATCH_001" in rules
    assert sorted(r.policy_number for r in tables.keyed(POLICIES).collect()) == ["P1", "P2"]
    assert {r.dq_status for r in tables.read("stg_policy").where("policy_number = 'P1'").collect()} == {"WARN"}
    assert tables.current("rule_catalog").count() == len(RULES)


def test_a_rule_of_an_earlier_batch_runs_in_later_ones(spark, tmp_path):
    """The second batch knows the rule from the catalog alone."""
    extra = Rule("POL_X", "policy", "Sum insured is at most ten premiums", "WARN", "sum_insured <= 10 * premium_amount", ())
    tables = tables_after(spark, tmp_path, (0, [policy("P1")]), options=Options(rules=[*RULES, extra]))
    run_batch(spark, tables, 1, log(spark, [policy("P2")], start=20), AS_OF)
    failed = tables.read("dq_result_policy").where("rule_id = 'POL_X' AND NOT passed").orderBy("batch_id").collect()
    assert [r.observed_value for r in failed] == ["sum_insured=9000.00, premium_amount=100.00"] * 2
    assert failed[1].severity == "WARN" and tables.read_batch("stg_policy", 1).first().dq_status == "WARN"


def test_far_premiums_are_in_the_audit_trail(spark, tmp_path):
    values = [policy(f"P{i}", premium=str(100 + i % 3)) for i in range(20)] + [policy("FAR", premium="9000")]
    tables = tables_after(spark, tmp_path, (0, values))
    failed = tables.read("dq_result_policy").where("rule_id = 'BATCH_002' AND NOT passed").collect()
    assert [r.observed_value for r in failed] == ["premium_amount=9000.00"]
    assert "z-score > 3" in failed[0].explanation


def test_scores_follow_from_moments_as_if_all_was_scored_again(spark, tmp_path):
    """Updates, moves between groups, and a group that loses its spread, over five batches."""
    deliveries = [
        [policy(f"P{i}", premium=str(100 + 7 * i)) for i in range(12)],
        [policy("P3", premium="5000"), policy("Q1", premium="10", broker="BRK_GAMMA"), policy("Q2", premium="30", broker="BRK_GAMMA")],
        [policy("P4", broker="BRK_BETA"), policy("P5", broker="BRK_BETA", premium="900")],
        [policy("Q2", premium="10", broker="BRK_GAMMA")],
        [policy("P3", premium="101"), claim("C1", "P1"), claim("C2", "P2", amount="90")],
    ]
    tables = Tables(spark, str(tmp_path))
    kept = {}
    for i, values in enumerate(deliveries):
        run_batch(spark, tables, i, log(spark, values, start=30 * i), AS_OF)
        rows = tables.keyed(POLICIES).toPandas()
        rows["x"] = rows.premium_amount.astype(float)
        peers = rows.groupby(["broker_key", "product_line"])["x"]
        rows["score"] = ((rows.x - peers.transform("mean")).abs() / peers.transform("std") / 3).clip(upper=1)
        flat = ~(peers.transform("std") > 0)
        kept |= {r.policy_number: r.score for r in rows[~flat].itertuples()}
        got = {r.policy_number: r.anomaly_score for r in star_of(tables).dim_policy.collect()}
        for number in rows.policy_number:
            assert got[number] == (pytest.approx(kept[number], abs=1e-9) if number in kept else None), (i, number)


def held_scratch(spark, pattern="batch-*"):
    held = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{pattern}")
    return held.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(held)


def test_untouched_files_stay_and_scratch_is_gone(spark, tmp_path):
    tables = tables_after(spark, tmp_path, (0, [policy(f"P{i}") for i in range(30)]))
    files = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    run_batch(spark, tables, 1, log(spark, [policy("P3", premium="7")], start=40), AS_OF)
    assert {p: p.stat().st_mtime_ns for p in files} == files
    assert len(list((tmp_path / "dim_policy_changes" / "batch_id=1").rglob("*.parquet"))) == 1
    assert not held_scratch(spark)


def test_reading_the_star_writes_nothing(spark, two_batches):
    before = {str(s.getPath()) for s in held_scratch(spark, "*/*") or []}
    assert content(two_batches)[0]
    assert {str(s.getPath()) for s in held_scratch(spark, "*/*") or []} == before


@pytest.mark.parametrize("step", ["claim_rows"])
def test_readers_see_a_batch_whole_or_not_at_all(spark, tmp_path, monkeypatch, step):
    """A batch that dies between two of its tables leaves the state before it, also while it is run again."""
    tables = tables_after(spark, tmp_path, (0, FIRST))
    before = everything(tables)

    def broken(*_):
        raise RuntimeError("executor lost for good")

    monkeypatch.setattr(batch_module.star, step, broken)
    with pytest.raises(RuntimeError):
        run_batch(spark, tables, 1, log(spark, SECOND, start=20), AS_OF)
    assert (tmp_path / "raw" / "batch_id=1").exists()
    assert everything(tables) == before
    assert sorted(r.status for r in tables.read_log("run_log").collect()) == ["FAILED", "SUCCESS"]
    monkeypatch.undo()
    run_batch(spark, tables, 1, log(spark, SECOND, start=20), AS_OF)
    assert content(tables) != before["star"] and tables.read("raw").count() == 9


def test_a_failed_batch_is_logged_and_leaves_no_scratch(spark, tmp_path, monkeypatch):
    def broken(*_):
        raise RuntimeError("no space left")

    tables = Tables(spark, str(tmp_path))
    monkeypatch.setattr(batch_module.star, "claim_rows", broken)
    with pytest.raises(RuntimeError):
        run_batch(spark, tables, 0, log(spark, FIRST), AS_OF)
    last = tables.read_log("stage_log").orderBy("step").collect()[-1]
    assert (last.stage, last.status) == ("promote_claims", "ERROR") and "no space left" in last.message
    assert tables.read_log("run_log").first().status == "FAILED"
    assert not held_scratch(spark)
    monkeypatch.undo()
    run_batch(spark, tables, 0, log(spark, FIRST), AS_OF)
    assert [(r.stage, r.status) for r in tables.read_log("stage_log").orderBy("step").collect()] == [(s, "SUCCESS") for s in batch_module.STAGES]
    assert tables.read_log("run_log").first().status == "SUCCESS"


def test_a_model_answers_what_the_word_lists_leave_open(spark, tmp_path):
    asked = []

    def model(batch):
        return pd.DataFrame({"answered_line": ["MARINE" if "boat" in p else None for p in batch["product_name"]]})

    values = [policy("P1", product_name="big boat"), policy("P2", product_name="big boat"), policy("P3"), policy("P4", product_name="odd")]
    tables = tables_after(spark, tmp_path, (0, values), (1, [policy("P7", product_name="big boat")]), options=Options(product_model=model, model_name="m1"))
    lines = {r.policy_number: r.product_line for r in tables.keyed(POLICIES).collect()}
    assert lines == {"P1": "MARINE", "P2": "MARINE", "P3": "AUTO", "P4": "OTHER", "P7": "MARINE"} and not asked
    calls = tables.read("model_call_log").collect()
    assert {c.model for c in calls} == {"m1"} and all(c.batch_id == 0 for c in calls)  # batch 1 asks nothing new


def test_checks_before_classification(spark, tmp_path):
    tables = tables_after(spark, tmp_path, (0, FIRST), options=Options(classify_after_checks=True))
    assert {r.product_line for r in tables.keyed(POLICIES).collect()} == {"AUTO"}
    assert tables.read("dq_result_policy").where("rule_id = 'POL_008' AND passed").count() == 0
    assert [r.sentiment_score for r in tables.keyed(CLAIMS).collect()] == [0.0]


def test_a_stream_without_input_ages(spark, tmp_path):
    """One file of rows, and then nothing: the status goes from healthy to stale by itself."""
    source, tables = str(tmp_path / "landing"), Tables(spark, str(tmp_path / "tables"))
    rows = [("BRK_ALPHA", "policy"), ("BRK_ALPHA", "policy"), ("BRK_BETA", None)]
    landed = spark.createDataFrame(rows, "broker_code string, record_type string").withColumn("ingested_at", F.current_timestamp().cast("timestamp_ntz"))
    landed.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(landed.schema).parquet(source)
    query = ingest.stream_status(stream, tables, str(tmp_path / "state"), "1 second", healthy=30, lagging=45)
    seen, until = [], time.monotonic() + 240
    try:
        while time.monotonic() < until and (not seen or seen[-1] != {"STALE"}) and query.isActive:
            known = tables.keyed(ingest.STATUS)
            now = {r.ingest_status for r in known.collect()} if known is not None else set()
            if now and (not seen or seen[-1] != now):
                seen.append(now)
            time.sleep(0.5)
    finally:
        query.stop()
    assert query.exception() is None
    assert seen[0] == {"HEALTHY"} and {"LAGGING"} in seen and seen[-1] == {"STALE"}
    assert {(r.broker_code, r.record_type): r.rows_landed for r in tables.keyed(ingest.STATUS).collect()} == {("BRK_ALPHA", "policy"): 2, ("BRK_BETA", None): 1}


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        ev.read_envelopes(spark, {"kafka.bootstrap.servers": "localhost:9"})


def test_wire_staging_equals_the_canonical_adapter(spark):
    """Records that are plain on the wire arrive in staging as the adapter made them."""
    book = Book(spark, "/root/testdata/sf0.001")
    columns = ["raw_id", "stg_id", "policy_number", "customer_name", "product_line", "premium_amount", "sum_insured"]
    wire, canon = book.wire_policies.select(columns), book.policies.select(columns)
    assert wire.exceptAll(canon).count() == 0
    assert canon.count() - wire.count() == 30  # dead letters and empty payloads
