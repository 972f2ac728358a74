"""Message envelopes: from log records to landing rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brokerflow.config.brokers import CHANNEL_PREFIX, CLAIM_TOPIC, POLICY_TOPIC, UNKNOWN_BROKER
from brokerflow.functions import keys
from brokerflow.functions.compute import once
from brokerflow.functions.payload import TEXT_MAP, header_signature, is_object_text
from brokerflow.operators.upsert import REPEATED, repeats, with_repeats
from brokerflow.plans.scratch import fits_broadcast, settle_measured

LOG_SCHEMA = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
PLACE = ("topic", "partition", "offset")
LANDING = (
    "raw_id", "broker_code", "source_format", "record_type", "payload", "kafka_topic", "kafka_partition", "kafka_offset",
    "message_key", "ingest_channel", "ingested_at",
)
NO_OBJECT = "not a JSON object"
NO_FIELDS = "no payload fields"
_ENVELOPE = "broker_code string, source_format string, record_type string, payload string, _corrupt string"


def read_envelopes(spark: SparkSession, options: dict[str, str], max_per_trigger: int | None = None) -> DataFrame:
    """Subscribe to the policy and claim topics from the earliest offset.

    Offsets live in the checkpoint of the query that consumes the frame, so they advance only after
    a batch was written. Needs the Kafka connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("subscribe", f"{POLICY_TOPIC},{CLAIM_TOPIC}")
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select("key", "value", "topic", "partition", "offset", "timestamp")


def decode(messages: DataFrame) -> DataFrame:
    """Landing columns, parsed once: also the payload as a map, the signature of its headers and, where
    a message can't be used, the problem and its text.

    A message that is no JSON object has no landing row. One without payload fields has, but no mapping
    will ever fit it.
    """
    text = messages.withColumn("_text", F.col("value").cast("string"))
    is_object = is_object_text(F.col("_text"))
    parsed = once(text, "_v", F.when(is_object, F.try_parse_json("_text")))

    def member(name: str) -> Column:
        return F.try_variant_get("_v", f"$.{name}", "string").alias(name)

    absent = F.lit(None).cast("string")
    exact = F.struct(member("broker_code"), member("source_format"), member("record_type"), absent.alias("payload"), absent.alias("_corrupt"))
    # Texts VARIANT refuses although they are objects: repeated members, NaN.
    loose = F.when(is_object, F.from_json("_text", _ENVELOPE, {"columnNameOfCorruptRecord": "_corrupt"}))
    decoded = once(parsed, "_env", F.when(F.col("_v").isNotNull(), exact).otherwise(loose))
    loose_map = F.when(is_object_text(F.col("_env.payload")), F.from_json("_env.payload", TEXT_MAP))
    exact_map = F.try_variant_get("_v", "$.payload", TEXT_MAP)
    mapped = once(decoded, "payload_map", F.when(F.col("_v").isNotNull(), exact_map).otherwise(loose_map))
    # The payload's text is made where it is read: who reads the map alone doesn't pay for it.
    payload = F.try_variant_get("_v", "$.payload", "variant")
    exact_text = F.when(~F.is_variant_null(payload), F.to_json(payload))
    payload_text = F.when(F.col("_v").isNotNull(), exact_text).otherwise(F.col("_env.payload"))
    readable = F.col("_env").isNotNull() & F.col("_env._corrupt").isNull()
    fields = F.coalesce(F.size("payload_map"), F.lit(0)) > 0
    return mapped.select(
        keys.raw_id(F.col("topic"), F.col("partition"), F.col("offset")).alias("raw_id"),
        F.coalesce("_env.broker_code", F.lit(UNKNOWN_BROKER)).alias("broker_code"),
        F.col("_env.source_format").alias("source_format"),
        F.col("_env.record_type").alias("record_type"),
        F.coalesce(payload_text, F.lit("{}")).alias("payload"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.when(F.length("key") > 0, F.col("key").cast("string")).alias("message_key"),
        F.concat_ws("-", F.lit(CHANNEL_PREFIX), F.coalesce("_env.record_type", F.lit("x"))).alias("ingest_channel"),
        F.col("timestamp").cast("timestamp_ntz").alias("ingested_at"),
        "payload_map",
        header_signature(F.map_keys("payload_map")).alias("header_signature"),
        F.when(~readable, NO_OBJECT).when(~fields, NO_FIELDS).alias("problem"),
        F.when(~readable | ~fields, F.col("_text")).alias("text"),
        "timestamp",
    )


def landed(decoded: DataFrame) -> DataFrame:
    """The landing rows among decoded messages."""
    return decoded.where(~F.col("problem").eqNullSafe(NO_OBJECT)).select(*LANDING)


def usable(decoded: DataFrame) -> DataFrame:
    """The landing rows that a mapping may fit, with their payload as a map."""
    return decoded.where("problem IS NULL").select(*LANDING, "payload_map", "header_signature")


def dead(decoded: DataFrame) -> DataFrame:
    """The messages that can't be used, as they came, with their place in the log and the problem."""
    return decoded.where("problem IS NOT NULL").select(
        F.col("kafka_topic").alias("topic"), F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"),
        F.col("text").alias("value"), "timestamp", "problem",
    )


def parse_envelopes(messages: DataFrame) -> DataFrame:
    """Landing rows with lineage, one per readable message."""
    return landed(decode(messages))


def dead_letters(messages: DataFrame) -> DataFrame:
    return dead(decode(messages))


def entity_of(record_type: Column) -> Column:
    """Claims are claims, everything else is handled as a policy."""
    return F.when(record_type.eqNullSafe("claim"), "claim").otherwise("policy")


def route(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(policy rows, claim rows)."""
    is_claim = F.col("record_type").eqNullSafe("claim")
    return raw.where(~is_claim), raw.where(is_claim)


def drop_redelivered(messages: DataFrame, late: str = "1 hour", keep: Callable[[DataFrame], DataFrame] = lambda again: again) -> DataFrame:
    """One row per place in the log; a message without a whole place is nobody's repeat.

    Repeats are rare and messages are wide. So a batch, which is read several times, counts hashes of places alone;
    only the messages of repeated places are dealt out to keep one each, which ``keep`` may store; without any, the batch
    is passed on as it is. On a stream, where the same place can only come again within the redelivery delay, the watermark bounds the state.
    """
    if messages.isStreaming:
        return messages.withWatermark("timestamp", late).dropDuplicatesWithinWatermark(list(PLACE))
    repeated, size = repeats(messages, PLACE)
    if not size:
        return messages
    flagged = with_repeats(messages, PLACE, (repeated, size))
    again = F.col(REPEATED) & F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull()
    single, others = (flagged.where(c).select(*messages.columns) for c in (~again, again))
    return single.unionByName(keep(others.dropDuplicates(list(PLACE))))


def without_places(messages: DataFrame, places: DataFrame) -> DataFrame:
    """The messages whose place is not among some; these are few as a rule, and then broadcast."""
    known, size = settle_measured(places, "places")
    return messages.join(F.broadcast(known) if fits_broadcast(size) else known, list(PLACE), "left_anti").select(*messages.columns)
