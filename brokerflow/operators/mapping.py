"""Header reconciliation: one mapping per distinct header layout, applied to every record of it."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brokerflow.config.brokers import BROKERS
from brokerflow.config.canonical import FIELDS, mapped_fields
from brokerflow.functions.payload import header_signature, with_payload_map
from brokerflow.functions.sqltext import name, text
from brokerflow.operators.joins import lookup_join
from brokerflow.plans.scratch import settle
from brokerflow.sources.envelopes import entity_of

REGISTRY_SCHEMA = (
    "header_signature string, broker_code string, record_type string, source_headers array<string>, "
    "mapping map<string,string>, mapping_source string, confidence double, "
    "first_seen_at timestamp_ntz, last_seen_at timestamp_ntz"
)
SEED_CONFIDENCE = 1.0
INFERRED_CONFIDENCE = 0.9
MIN_SIMILARITY = 0.8
ABBREVIATED = 0.9


def to_broker_format(layouts: dict[str, dict[str, str]]) -> Column:
    """Canonical columns as JSON text with the headers of the row's broker.

    Columns outside the layout, such as internal ones, are left out. NULL for an unknown broker.
    """
    cases = []
    for code, headers in layouts.items():
        record = ", ".join(f"{name(field)} AS {name(header)}" for header, field in headers.items())
        cases.append(f"WHEN {text(code)} THEN to_json(struct({record}), map('ignoreNullFields', 'false'))")
    return F.expr(f"CASE broker_code {' '.join(cases)} END")


def with_signature(raw: DataFrame) -> DataFrame:
    """Add the parsed payload and the signature of its own headers to every landing row, unless it has them."""
    if "header_signature" in raw.columns:
        return raw
    return with_payload_map(raw).withColumn("header_signature", header_signature(F.map_keys("payload_map")))


def layouts(raw: DataFrame) -> DataFrame:
    """Distinct header layouts with their record counts. Rows collapse before the shuffle."""
    return (
        with_signature(raw)
        .where(F.size("payload_map") > 0)
        .groupBy(
            entity_of(F.col("record_type")).alias("record_type"),
            "header_signature",
            F.array_sort(F.map_keys("payload_map")).alias("source_headers"),
        )
        .agg(
            F.min("broker_code").alias("broker_code"),
            F.count("*").alias("records"),
            F.min("ingested_at").alias("first_seen_at"),
            F.max("ingested_at").alias("last_seen_at"),
        )
    )


def distinct_headers(raw: DataFrame) -> DataFrame:
    """Headers in use per broker and record type, one row each.

    Counted per layout first, so only a handful of rows per broker is exploded.
    """
    per_layout = (
        with_signature(raw)
        .groupBy("broker_code", entity_of(F.col("record_type")).alias("record_type"), F.array_sort(F.map_keys("payload_map")).alias("headers"))
        .agg(F.count("*").alias("n"))
    )
    return (
        per_layout.select("broker_code", "record_type", F.explode("headers").alias("header"), "n")
        .groupBy("broker_code", "record_type", "header")
        .agg(F.sum("n").alias("records"))
    )


def seed_mappings(spark: SparkSession) -> DataFrame:
    """Registry rows of the configured broker layouts: one per broker and record type."""
    rows = [
        (broker.code, entity, list(headers), dict(headers))
        for broker in BROKERS.values()
        for entity, headers in broker.headers.items()
    ]
    seeds = spark.createDataFrame(
        rows, "broker_code string, record_type string, source_headers array<string>, mapping map<string,string>"
    )
    return seeds.select(
        header_signature(F.col("source_headers")).alias("header_signature"),
        "broker_code",
        "record_type",
        F.array_sort("source_headers").alias("source_headers"),
        "mapping",
        F.lit("seed").alias("mapping_source"),
        F.lit(SEED_CONFIDENCE).alias("confidence"),
        F.lit(None).cast("timestamp_ntz").alias("first_seen_at"),
        F.lit(None).cast("timestamp_ntz").alias("last_seen_at"),
    )


def new_signatures(seen: DataFrame, registry: DataFrame) -> DataFrame:
    """Unmapped registry rows for the layouts the registry does not hold.

    Both sides hold one row per layout. The key includes the record type, as a policy and a claim
    layout may have the same headers.
    """
    return seen.join(registry, ["record_type", "header_signature"], "left_anti").select(
        "header_signature",
        "broker_code",
        "record_type",
        "source_headers",
        F.lit(None).cast("map<string,string>").alias("mapping"),
        F.lit(None).cast("string").alias("mapping_source"),
        F.lit(None).cast("double").alias("confidence"),
        "first_seen_at",
        "last_seen_at",
    )


def _words(text: str) -> str:
    """Lower-case words, also those of camel case, joined by blanks."""
    apart = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", text)
    return " ".join(re.findall(r"[a-z0-9]+", apart.lower()))


def known_headers() -> list[tuple[str, str, str]]:
    """(record type, words of the header, canonical field) from the canonical names and all broker layouts."""
    known = {(entity, _words(f), f) for entity in FIELDS for f in mapped_fields(entity)}
    for broker in BROKERS.values():
        for entity, headers in broker.headers.items():
            known |= {(entity, _words(h), f) for h, f in headers.items()}
    return sorted(known)


def required_fields(entity: str) -> list[str]:
    return [f.name for f in FIELDS[entity] if f.required]


def _missing() -> Column:
    """The required fields that a mapping leaves out."""
    missing = F.array().cast("array<string>")
    for entity in FIELDS:
        wanted = F.array(*map(F.lit, required_fields(entity)))
        missing = F.when(F.col("record_type") == entity, F.array_except(wanted, F.map_values("mapping"))).otherwise(missing)
    return missing


def match_headers(unmapped: DataFrame, min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """(record_type, header_signature, mapping) of the layouts in which every required field is found."""
    found = propose_mapping(unmapped, min_similarity)
    return found.where(F.size(_missing()) == 0)


def incomplete_layouts(unmapped: DataFrame, min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """Layouts that stay unmapped: what was found of them, and the required fields that weren't."""
    found = propose_mapping(unmapped, min_similarity)
    layouts = unmapped.select("record_type", "header_signature", "source_headers").join(found, ["record_type", "header_signature"], "left")
    known = layouts.withColumn("mapping", F.coalesce("mapping", F.create_map().cast("map<string,string>")))
    return known.withColumn("missing", _missing()).where(F.size("missing") > 0)


def propose_mapping(unmapped: DataFrame, min_similarity: float) -> DataFrame:
    """(record_type, header_signature, mapping) by comparing headers with the known ones.

    A header scores 1 on equality after dropping case and punctuation, else 1 - edit distance over
    length. One whose words each begin the word at the same place in a known header, with three letters
    at least, scores ``ABBREVIATED``. Headers and fields are then paired so that the sum of the scores is
    largest: a header that loses its best field to another one gets its next best. A pair that is equal weighs
    more than all that are alike, so that it is never given up for them.
    """
    known = F.from_json(
        F.lit(json.dumps([dict(zip(("entity", "known", "field"), k)) for k in known_headers()])),
        "array<struct<entity:string,known:string,field:string>>",
    )
    apart = F.regexp_replace("header", "([a-z0-9])([A-Z])", "$1 $2")
    headers = unmapped.select("record_type", "header_signature", F.explode("source_headers").alias("header")).withColumn(
        "words", F.array_remove(F.split(F.lower(apart), "[^a-z0-9]+"), "")
    )

    def score(k: Column) -> Column:
        bare, known_bare, known_words = F.array_join("words", ""), F.replace(k["known"], F.lit(" "), F.lit("")), F.split(k["known"], " ")
        alike = 1 - F.levenshtein(bare, known_bare) / F.greatest(F.length(bare), F.length(known_bare), F.lit(1))
        begun = F.zip_with("words", known_words, lambda a, b: (a == b) | ((F.length(a) >= 3) & F.startswith(b, a)))
        short = (F.size("words") == F.size(known_words)) & F.forall(begun, lambda same: F.coalesce(same, F.lit(False)))
        return F.when(short, F.greatest(alike, F.lit(ABBREVIATED))).otherwise(alike)

    own = F.filter(known, lambda k: k["entity"] == F.col("record_type"))
    scored = headers.select(
        "record_type", "header_signature", "header", F.explode(F.transform(own, lambda k: F.struct(k["field"].alias("field"), score(k).alias("score")))).alias("s")
    )
    edges = scored.groupBy("record_type", "header_signature", "header", F.col("s.field").alias("field")).agg(F.max("s.score").alias("score"))
    # A group holds the pairs of one layout: its headers times the canonical fields.
    layouts = edges.where(F.col("score") >= min_similarity).groupBy("record_type", "header_signature")
    return layouts.applyInPandas(_assigned, "record_type string, header_signature string, mapping map<string,string>")


def _assigned(pairs: pd.DataFrame) -> pd.DataFrame:
    headers, fields = sorted(set(pairs["header"])), sorted(set(pairs["field"]))
    weight = np.zeros((len(headers), len(fields)))
    for header, field, alike in zip(pairs["header"], pairs["field"], pairs["score"], strict=True):
        weight[headers.index(header), fields.index(field)] = len(headers) + 1 if alike == 1 else alike
    mapping = {headers[i]: fields[j] for i, j in assignment(weight)}
    return pd.DataFrame({"record_type": pairs["record_type"][:1], "header_signature": pairs["header_signature"][:1], "mapping": [mapping]})


def assignment(weight: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of a row and a column, each used once at most, with the largest sum of weights; pairs of weight 0 are none.

    Rows are added one by one. Each takes the cheapest alternating path to a free column under prices that
    keep every pair's reduced cost at 0 or above (shortest augmenting paths).
    """
    size = max(weight.shape, default=0)
    cost = np.zeros((size, size))
    cost[: weight.shape[0], : weight.shape[1]] = -weight
    row_price, column_price = np.zeros(size), np.zeros(size)
    row_of = np.full(size, -1)
    for start in range(size):
        reached, via = np.full(size, np.inf), np.full(size, -1)
        done, column, row, length = np.zeros(size, bool), -1, start, 0.0
        while row >= 0:
            through = length + cost[row] - row_price[row] - column_price
            better = ~done & (through < reached)
            reached[better], via[better] = through[better], row
            column = int(np.where(done, np.inf, reached).argmin())
            length, done[column], row = reached[column], True, row_of[column]
        on_path = done & (row_of >= 0)
        row_price[start] += length
        row_price[row_of[on_path]] += length - reached[on_path]
        column_price[done] -= length - reached[done]
        while column >= 0:  # turn the path around
            row = via[column]
            before = np.flatnonzero(row_of == row)
            row_of[column] = row
            column = int(before[0]) if row != start else -1
    return [(int(i), j) for j, i in enumerate(row_of) if i < weight.shape[0] and j < weight.shape[1] and weight[i, j] > 0]


def resolve_unmapped(registry: DataFrame, matcher: Callable[[DataFrame], DataFrame] = match_headers) -> DataFrame:
    """Fill in the mapping of layouts that have none; layouts nothing matches stay unmapped.

    ``matcher`` takes the unmapped rows and returns (record_type, header_signature, mapping).
    """
    found = matcher(registry.where(F.col("mapping").isNull())).withColumnRenamed("mapping", "_found")
    joined = registry.join(found, ["record_type", "header_signature"], "left")
    resolved = F.col("mapping").isNull() & F.col("_found").isNotNull()
    return joined.select(
        "header_signature",
        "broker_code",
        "record_type",
        "source_headers",
        F.coalesce("mapping", "_found").alias("mapping"),
        F.when(resolved, "inferred").otherwise(F.col("mapping_source")).alias("mapping_source"),
        F.when(resolved, INFERRED_CONFIDENCE).otherwise(F.col("confidence")).alias("confidence"),
        "first_seen_at",
        "last_seen_at",
    )


def registry_for(
    raw: DataFrame, registry: DataFrame, matcher: Callable[[DataFrame], DataFrame] = match_headers
) -> DataFrame:
    """The registry extended by the layouts of these landing rows, resolved where possible.

    The landing rows are read once; what follows works on one row per layout.
    """
    new = settle(new_signatures(layouts(raw), registry), "layouts")
    return resolve_unmapped(registry.unionByName(new), matcher)


def invert_mapping(registry: DataFrame, entity: str) -> DataFrame:
    """Per signature of an entity, one column per canonical field naming its source header.

    When several headers point at a field, the greatest header wins.
    """

    source = ", ".join(
        f"array_max(map_keys(map_filter(mapping, (header, target) -> target = {text(f)}))) AS {name(f)}"
        for f in mapped_fields(entity)
    )
    return registry.where((F.col("record_type") == entity) & F.col("mapping").isNotNull()).select(
        "header_signature", "mapping_source", F.col("confidence").alias("mapping_confidence"),
        F.expr(f"struct({source}) AS source"),
    )


def project_canonical(raw: DataFrame, registry: DataFrame, entity: str) -> DataFrame:
    """Canonical text columns for the rows whose layout is mapped; other rows stay in landing."""
    signed = with_signature(raw).select("raw_id", "broker_code", "ingested_at", "payload_map", "header_signature")
    mapped = lookup_join(
        signed, invert_mapping(registry, entity), ["header_signature"], ["raw_id"], "inner", "registry"
    )
    return mapped.selectExpr(
        "raw_id",
        "broker_code",
        *[f"payload_map[source.{name(f)}] AS {name(f)}" for f in mapped_fields(entity)],
        "mapping_source",
        "mapping_confidence",
        "ingested_at",
    )


def unmapped_rows(raw: DataFrame, registry: DataFrame, entity: str) -> DataFrame:
    """Rows whose layout has no mapping yet; they wait for the next run."""
    signed = with_signature(raw)
    known = invert_mapping(registry, entity).select("header_signature", F.lit(True).alias("_known"))
    joined = lookup_join(signed, known, ["header_signature"], ["raw_id"], "left", "registry")
    return joined.where(F.col("_known").isNull()).drop("_known")


def invalid_targets(registry: DataFrame) -> DataFrame:
    """Mapping entries that point at something other than a canonical field of their record type."""
    valid = F.lit(False)
    for entity in FIELDS:
        valid = valid | ((F.col("record_type") == entity) & F.col("target").isin(mapped_fields(entity)))
    return (
        registry.where(F.col("mapping").isNotNull())
        .select("record_type", "header_signature", F.explode("mapping").alias("header", "target"))
        .where(F.col("target").isNotNull() & ~valid)
    )
