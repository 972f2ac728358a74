from __future__ import annotations

import datetime as dt
import json
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from brokerflow.config.brokers import BROKERS
from brokerflow.config.canonical import CLAIM_STATUSES, FIELDS, PRODUCT_LINES, RISK_TIERS, mapped_fields, struct_type
from brokerflow.functions.payload import first_json_object, header_signature, with_payload_map
from brokerflow.operators import mapping
from brokerflow.sources import files

NOW = dt.datetime(2025, 1, 1)


def raw(spark, *records):
    """Landing rows of (broker, record type, payload)."""
    rows = [(f"r{i}", b, t, json.dumps(p), NOW) for i, (b, t, p) in enumerate(records)]
    return spark.createDataFrame(
        rows, "raw_id string, broker_code string, record_type string, payload string, ingested_at timestamp_ntz"
    )


def registry_row(spark, headers: dict, entity="policy"):
    seed = mapping.seed_mappings(spark).limit(1)
    return seed.select(
        header_signature(F.array(*[F.lit(h) for h in headers])).alias("header_signature"),
        F.lit("B").alias("broker_code"),
        F.lit(entity).alias("record_type"),
        F.array(*[F.lit(h) for h in headers]).alias("source_headers"),
        F.create_map(*[F.lit(x).cast("string") for pair in headers.items() for x in pair]).alias("mapping"),
        F.lit("manual").alias("mapping_source"),
        F.lit(1.0).alias("confidence"),
        "first_seen_at",
        "last_seen_at",
    )


def test_layouts_target_canonical_fields():
    for broker in BROKERS.values():
        for entity, headers in broker.headers.items():
            assert set(headers.values()) <= {f.name for f in FIELDS[entity]}


def test_brokers_differ_on_the_wire():
    alpha, beta = (set(BROKERS[b].headers["policy"]) for b in ("BRK_ALPHA", "BRK_BETA"))
    assert not alpha & beta


def test_canonical_schema():
    schema = struct_type("policy")
    assert schema["customer_name"].metadata == {"pii": True}
    assert not schema["policy_number"].nullable
    assert schema["premium_amount"].dataType.simpleString() == "decimal(18,2)"
    assert (len(PRODUCT_LINES), len(CLAIM_STATUSES), len(RISK_TIERS)) == (8, 7, 4)


def test_signature_ignores_order(spark):
    rows = raw(spark, ("B", "policy", {"b": 1, "a": 2}), ("B", "policy", {"a": 1, "b": 2}))
    assert mapping.with_signature(rows).select("header_signature").distinct().count() == 1


def test_payload_map_keeps_exact_numbers_and_nested_values(spark):
    rows = raw(spark, ("B", "policy", {}), ("B", "policy", {"n": {"x": [1]}, "t": None}))
    rows = rows.withColumn("payload", F.when(F.col("raw_id") == "r0", '{"v": 30000000.10}').otherwise(F.col("payload")))
    maps = {r.raw_id: r.payload_map for r in with_payload_map(rows).collect()}
    assert maps["r0"] == {"v": "30000000.1"}
    assert maps["r1"] == {"n": '{"x":[1]}', "t": None}


def test_mixed_layouts_of_one_broker_get_their_own_signatures(spark):
    rows = raw(spark, ("B", "policy", {"a": 1}), ("B", "policy", {"a": 1, "b": 2}), ("B", "policy", {"a": 3}))
    found = {tuple(r.source_headers): r.records for r in mapping.layouts(rows).collect()}
    assert found == {("a",): 2, ("a", "b"): 1}


def test_equal_headers_of_two_record_types_do_not_collide(spark):
    rows = raw(spark, ("B", "policy", {"a": 1}), ("B", "claim", {"a": 1}))
    new = mapping.new_signatures(mapping.layouts(rows), mapping.seed_mappings(spark))
    assert sorted(r.record_type for r in new.collect()) == ["claim", "policy"]


def test_known_layouts_are_not_registered_again(spark):
    headers = BROKERS["BRK_GAMMA"].headers["claim"]
    rows = raw(spark, ("BRK_GAMMA", "claim", {h: "x" for h in reversed(list(headers))}))
    assert mapping.new_signatures(mapping.layouts(rows), mapping.seed_mappings(spark)).count() == 0


def test_inference_by_name_and_spelling(spark):
    payload = {"POLICY NUMBER": 1, "customer-name": 1, "insuredNam": 1, "Prem (USD)": 1, "favourite colour": 1,
               "TSI": 1, "Prod": 1, "inception date": 1, "EXP_DT": 1}
    rows = raw(spark, ("NEW", "policy", payload))
    (row,) = mapping.registry_for(rows, mapping.seed_mappings(spark)).where("broker_code = 'NEW'").collect()
    assert row.mapping == {
        "POLICY NUMBER": "policy_number",
        "customer-name": "customer_name",  # exact beats the near miss insuredNam: a field is used once
        "Prem (USD)": "premium_amount",  # short for Premium (USD)
        "TSI": "sum_insured",
        "Prod": "product_name",
        "inception date": "effective_date",
        "EXP_DT": "expiry_date",
    }
    assert (row.mapping_source, row.confidence) == ("inferred", 0.9)


def test_partly_matched_layout_stays_unmapped_and_is_reported(spark):
    rows = raw(spark, ("NEW", "claim", {"DOL": 1, "Claim Ref": 1, "colour": 1}))
    registry = mapping.registry_for(rows, mapping.seed_mappings(spark))
    (row,) = mapping.incomplete_layouts(registry.where("mapping IS NULL")).collect()
    assert row.mapping == {"DOL": "loss_date", "Claim Ref": "claim_number"}
    assert sorted(row.missing) == ["claim_amount", "claim_status", "policy_number", "reported_date"]
    assert mapping.unmapped_rows(rows, registry, "claim").count() == 1


def test_layout_nothing_matches_stays_unmapped_and_waits(spark):
    rows = raw(spark, ("NEW", "policy", {"zzz": 1}), ("BRK_BETA", "policy", {h: "1" for h in BROKERS["BRK_BETA"].headers["policy"]}))
    registry = mapping.registry_for(rows, mapping.seed_mappings(spark))
    assert registry.where("mapping IS NULL").count() == 1
    assert [r.raw_id for r in mapping.unmapped_rows(rows, registry, "policy").collect()] == ["r0"]
    assert [r.raw_id for r in mapping.project_canonical(rows, registry, "policy").collect()] == ["r1"]


def test_own_matcher(spark):
    rows = raw(spark, ("NEW", "policy", {"zzz": 1}))
    registry = mapping.seed_mappings(spark).unionByName(
        mapping.new_signatures(mapping.layouts(rows), mapping.seed_mappings(spark))
    )

    def matcher(unmapped):
        return unmapped.select("record_type", "header_signature", F.create_map(F.lit("zzz"), F.lit("policy_number")).alias("mapping"))

    resolved = mapping.resolve_unmapped(registry, matcher)
    assert resolved.where("mapping_source = 'inferred'").first().mapping == {"zzz": "policy_number"}


def test_greatest_header_wins_when_two_point_at_a_field(spark):
    registry = registry_row(spark, {"a": "policy_number", "b": "policy_number", "c": "customer_name"})
    source = mapping.invert_mapping(registry, "policy").first().source
    assert source.policy_number == "b"
    assert source.customer_name == "c"
    assert source.premium_amount is None


def test_projection_tolerates_missing_headers(spark):
    registry = registry_row(spark, {"No": "policy_number", "X": None})
    rows = raw(spark, ("B", "policy", {"No": "P1", "X": "y"}))
    (row,) = mapping.project_canonical(rows, registry, "policy").collect()
    assert row.policy_number == "P1"
    assert all(row[f] is None for f in mapped_fields("policy") if f != "policy_number")


def test_projection_is_the_same_with_a_registry_too_large_to_broadcast(spark, no_broadcast):
    headers = BROKERS["BRK_ALPHA"].headers["claim"]
    rows = raw(spark, *[("BRK_ALPHA", "claim", {h: f"{f}{i}" for h, f in headers.items()}) for i in range(20)])
    out = mapping.project_canonical(rows, mapping.seed_mappings(spark), "claim")
    assert sorted(r.claim_number for r in out.collect()) == sorted(f"claim_number{i}" for i in range(20))


def test_invalid_targets(spark):
    good, bad = {"a": "policy_number"}, {"a": "claim_number", "b": None}
    assert mapping.invalid_targets(registry_row(spark, good)).count() == 0
    assert [r.target for r in mapping.invalid_targets(registry_row(spark, bad)).collect()] == ["claim_number"]
    assert mapping.invalid_targets(mapping.seed_mappings(spark)).count() == 0


def test_native_format_drops_internal_columns(spark):
    rows = spark.createDataFrame([("B", "P1", "secret")], "broker_code string, policy_number string, _line string")
    native = rows.select(mapping.to_broker_format({"B": {"Policy No": "policy_number"}}).alias("n")).first().n
    assert json.loads(native) == {"Policy No": "P1"}


@pytest.mark.parametrize(
    "text, wanted",
    [
        ('Sure!\n```json\n{"a": "x",\n "b": null}\n``` done', {"a": "x", "b": None}),
        ("no object", None),
        ("{broken", None),
        ("{not: json}", None),
    ],
)
def test_json_block_in_prose(spark, text, wanted):
    rows = spark.createDataFrame([(text,)], "t string")
    assert rows.select(first_json_object(F.col("t")).alias("m")).first().m == wanted


def test_delimited_files_are_read_by_their_own_header(spark, tmp_path):
    headers = list(BROKERS["BRK_ALPHA"].headers["policy"])
    (tmp_path / "a.csv").write_text(
        ",".join(headers) + "\n"
        'P1,"Ann, Jr",Motor,"$1,240.00",2025-01-01,2026-01-01,100,A1\n'
        "P2,Bob,Motor,$1,240.00,2025-01-01,2026-01-01,100,A1\n"
        "P3,Cid\n\n"
    )
    (tmp_path / "b.csv").write_text("\ufeffNew Column,Policy No,Policy No\nx,P4,P5\n")  # another order and another column
    (tmp_path / "c.csv").write_text("Policy No\n")
    rows = files.read_broker_csv(spark, str(tmp_path)).collect()
    good = {r["values"]["Policy No"]: r["values"] for r in rows if r[files.CORRUPT] is None}
    assert set(good) == {"P1", "P4"}
    assert (good["P1"]["Premium (USD)"], good["P1"]["Cust Name"]) == ("$1,240.00", "Ann, Jr")
    assert good["P4"] == {"New Column": "x", "Policy No": "P4", "Policy No #2": "P5"}
    assert sorted(r[files.CORRUPT][:3] for r in rows if r[files.CORRUPT] is not None) == ["P2,", "P3,"]


def test_json_files_keep_every_field(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps([{"policyId": "P4", "annualPremium": 30000000.10, "new": {"a": 1}}, {"policyId": "P5"}], indent=1))
    (tmp_path / "broken.json").write_text('[{"policyId": ')
    (tmp_path / "none.json").write_text("[]")
    rows = files.read_broker_json(spark, str(tmp_path)).collect()
    good = {r["values"]["policyId"]: r["values"] for r in rows if r[files.CORRUPT] is None}
    assert good["P4"]["annualPremium"] in ("30000000.1", "30000000.10") and json.loads(good["P4"]["new"]) == {"a": 1}
    assert good["P5"] == {"policyId": "P5"}
    assert [r[files.CORRUPT] for r in rows if r[files.CORRUPT] is not None] == ['[{"policyId": ']


def test_files_become_envelopes_and_dead_lines(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps([{"policyId": "P4", "surplus": "s"}]))
    gamma = list(BROKERS["BRK_GAMMA"].headers["claim"])
    (tmp_path / "c.psv").write_text("|".join(gamma) + "\nC1|P1|2025-01-01|2025-01-02|5,0|OPEN|a, b\nC2|P1\n")
    paths = {("BRK_BETA", "policy"): str(tmp_path / "b.json"), ("BRK_GAMMA", "claim"): str(tmp_path / "c.psv")}
    by_type = {r.record_type: r for r in files.files_to_envelopes(spark, paths).collect()}
    assert by_type["claim"].source_format == "csv"
    assert json.loads(by_type["claim"].payload)["REMARKS"] == "a, b"
    assert json.loads(by_type["policy"].payload) == {"policyId": "P4", "surplus": "s"}
    (dead,) = files.dead_lines(files.read_deliveries(spark, paths)).collect()
    assert (dead.record_type, dead.value) == ("claim", "C2|P1")
    wrapped = files.files_to_envelopes(spark, paths).where("record_type = 'claim'").withColumn("ingested_at", F.lit(NOW).cast("timestamp_ntz"))
    assert mapping.new_signatures(mapping.layouts(wrapped), mapping.seed_mappings(spark)).count() == 0


def test_headers_that_want_one_field_share_out_the_fields(spark):
    """Both names are nearest to ``claim_number``; the one that is nearly a policy number gives way."""
    headers = [["claim_numbr", "policy_numbr"], ["claimNumber", "claim_number_", "loss_date"]]
    rows = [("claim", f"s{i}", h) for i, h in enumerate(headers)]
    unmapped = spark.createDataFrame(rows, "record_type string, header_signature string, source_headers array<string>")
    found = {r.header_signature: r.mapping for r in mapping.propose_mapping(unmapped, 0.3).collect()}
    assert found["s0"] == {"claim_numbr": "claim_number", "policy_numbr": "policy_number"}
    assert found["s1"]["loss_date"] == "loss_date" and set(found["s1"]) == set(headers[1]) and len(set(found["s1"].values())) == 3


def test_a_layout_whose_headers_compete_is_mapped_whole(spark, monkeypatch):
    """``policy_number_x`` is nearest to the policy number, which an equal header has; it takes its next best field."""
    monkeypatch.setattr(mapping, "known_headers", lambda: [("policy", "policy number", "policy_number"), ("policy", "policy name", "customer_name")])
    rows = [("policy", "s", ["policyNumber", "policy_numbe"])]
    unmapped = spark.createDataFrame(rows, "record_type string, header_signature string, source_headers array<string>")
    (row,) = mapping.propose_mapping(unmapped, 0.6).collect()
    assert row.mapping == {"policyNumber": "policy_number", "policy_numbe": "customer_name"}


def test_assignment_equals_all_permutations():
    random = np.random.default_rng(3)
    for turn in range(300):
        rows, columns = random.integers(1, 6, 2)
        weight = np.round(random.random((rows, columns)), 1) * (random.random((rows, columns)) < 0.7)
        if turn % 3 == 0:
            weight[random.integers(rows), random.integers(columns)] = rows + 1
        pairs = mapping.assignment(weight)
        assert len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs) and all(weight[i, j] > 0 for i, j in pairs)
        square = np.zeros((max(rows, columns),) * 2)
        square[:rows, :columns] = weight
        best = max(sum(square[i, j] for i, j in enumerate(p)) for p in permutations(range(len(square))))
        assert sum(weight[i, j] for i, j in pairs) == pytest.approx(best)
    assert mapping.assignment(np.zeros((0, 0))) == []
