"""Reading semi-structured payloads.

Numbers go through VARIANT, which keeps them exact: reading a nested JSON number as text with
``from_json`` turns 30000000.10 into 3.00000001E7. ``from_json`` remains the way for the texts
VARIANT refuses (repeated keys, NaN); it is evaluated only for those rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerflow.functions.compute import once

TEXT_MAP = "map<string,string>"



def is_object_text(text: Column) -> Column:
    """Whether the text starts and ends like one JSON object, blanks aside."""
    blank = F.lit(" \t\r\n")
    # Trimming goes over the whole text; most texts have nothing to trim.
    return (text.startswith("{") | F.ltrim(text, blank).startswith("{")) & (text.endswith("}") | F.rtrim(text, blank).endswith("}"))


def with_payload_map(df: DataFrame, payload: str = "payload", out: str = "payload_map") -> DataFrame:
    """Add the payload as a map of header -> text; NULL for a payload that is not an object."""
    is_object = is_object_text(F.col(payload))
    parsed = once(df, "_variant", F.when(is_object, F.try_parse_json(payload)))
    exact = F.try_variant_get("_variant", "$", TEXT_MAP)
    loose = F.when(is_object, F.from_json(payload, TEXT_MAP))
    return once(parsed, out, F.when(F.col("_variant").isNotNull(), exact).otherwise(loose)).drop("_variant")


def header_signature(headers: Column) -> Column:
    """Order-free fingerprint of a header list."""
    return F.md5(F.array_join(F.array_sort(headers), "|"))


def first_json_object(text: Column) -> Column:
    """The outermost {...} block of free text as a map; NULL when there is none or it does not parse."""
    block = F.regexp_substr(text, F.lit(r"(?s)\{.*\}"))
    return F.from_json(block, TEXT_MAP, {"mode": "PERMISSIVE"})
