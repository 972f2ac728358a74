from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from brokerflow.sources import envelopes as ev

SCHEMA = "key string, value string, topic string, partition int, offset long, timestamp timestamp_ntz"
NOW = dt.datetime(2025, 1, 1, 12, 0, 0)


def log(spark, values, key="k", start=0):
    rows = [(key, v, "insurance.policies.raw", 0, start + i, NOW) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA).selectExpr(
        "cast(key AS binary) key", "cast(value AS binary) value", "topic", "partition", "offset", "timestamp"
    )


def landed(spark, *values, **kw):
    return [r.asDict() for r in ev.parse_envelopes(log(spark, values, **kw)).orderBy("kafka_offset").collect()]


def test_full_envelope(spark):
    text = json.dumps({"broker_code": "B", "source_format": "csv", "record_type": "claim", "payload": {"a": 1}})
    (row,) = landed(spark, text)
    assert (row["broker_code"], row["source_format"], row["record_type"]) == ("B", "csv", "claim")
    assert json.loads(row["payload"]) == {"a": 1}
    assert row["ingest_channel"] == "broker-ingest-claim"
    assert row["message_key"] == "k"
    assert row["ingested_at"] == NOW


def test_defaults_for_missing_members(spark):
    (row,) = landed(spark, "{}", key="")
    assert row["broker_code"] == "UNKNOWN"
    assert row["payload"] == "{}"
    assert row["record_type"] is None
    assert row["ingest_channel"] == "broker-ingest-x"
    assert row["message_key"] is None


def test_null_members_count_as_missing(spark):
    (row,) = landed(spark, '{"broker_code": null, "payload": null}')
    assert row["broker_code"] == "UNKNOWN"
    assert row["payload"] == "{}"


@pytest.mark.parametrize("bad", ["not json", '{"a":', "[1, 2]", '[{"broker_code": "B"}]', '"text"', "12", "null", "", None])
def test_unreadable_messages_become_dead_letters(spark, bad):
    good = '{"broker_code": "B"}'
    messages = log(spark, [good, bad])
    assert [r.kafka_offset for r in ev.parse_envelopes(messages).collect()] == [0]
    dead = ev.dead_letters(messages).where(F.col("problem") == ev.NO_OBJECT).collect()
    assert [(r.offset, r.value) for r in dead] == [(1, bad)]


@pytest.mark.parametrize("text", ['{"broker_code": "B", "payload": {"a": 1, "a": 2}}', '{"broker_code": "B", "payload": {"a": NaN}}'])
def test_lenient_objects_are_still_landed(spark, text):
    (row,) = landed(spark, text)
    assert row["broker_code"] == "B"
    assert ev.dead_letters(log(spark, [text])).count() == 0


def test_large_numbers_keep_their_digits(spark):
    (row,) = landed(spark, '{"payload": {"sum": 30000000.10, "big": 123456789012345.67}}')
    assert '"sum":30000000.1' in row["payload"]
    assert '"big":123456789012345.67' in row["payload"]


def test_everything_that_is_no_claim_is_a_policy(spark):
    raw = ev.parse_envelopes(
        log(spark, ['{"record_type": "claim"}', '{"record_type": "policy"}', '{"record_type": "endorsement"}', "{}"])
    )
    policies, claims = ev.route(raw)
    assert claims.count() == 1
    assert policies.count() == 3


def test_redelivered_messages_are_dropped_once(spark):
    messages = log(spark, ["{}", '{"a": 1}'])
    again = messages.unionByName(messages.where("offset = 1")).unionByName(messages)
    assert ev.drop_redelivered(again).count() == 2
