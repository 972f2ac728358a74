"""z-score outliers within peer groups.

A group is described by the number, the sum and the sum of squares of its values in hundredths. These
are exact integers, so a batch adds its new values and takes its old ones away, and the result is that
of counting everything again. Scores follow from them by a join of each row with its group's row. A
window over the group would sort a third of the table in one task when one group is that large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brokerflow.operators.joins import joint_key, lookup_join

FLAG_FROM = 0.95  # abs(z) >= 2.85

POLICY_PEERS = ("premium_amount", ("broker_key", "product_line"))
CLAIM_PEERS = ("claim_amount", ("product_key",))


def moments(rows: DataFrame, value: str, group: Sequence[str]) -> DataFrame:
    """(peers, n, total, squares) per group, of the values that are there."""
    hundredths = (F.col(value).cast("decimal(20,2)") * 100).cast("decimal(20,0)")
    counted = rows.where(F.col(value).isNotNull()).select(joint_key(*group).alias("peers"), hundredths.alias("v"))
    return counted.groupBy("peers").agg(
        F.count("*").alias("n"),
        F.sum("v").cast("decimal(38,0)").alias("total"),
        F.sum((F.col("v") * F.col("v")).cast("decimal(38,0)")).cast("decimal(38,0)").alias("squares"),
    )


def changed_moments(known: DataFrame | None, come: DataFrame, gone: DataFrame | None) -> DataFrame:
    """``known`` with the moments ``come`` added and ``gone`` taken away; groups without values are left out."""
    parts = come if known is None else known.unionByName(come)
    if gone is not None:
        parts = parts.unionByName(gone.select("peers", *[(-F.col(c)).alias(c) for c in ("n", "total", "squares")]))
    summed = parts.groupBy("peers").agg(*[F.sum(c).cast(t).alias(c) for c, t in (("n", "long"), ("total", "decimal(38,0)"), ("squares", "decimal(38,0)"))])
    return summed.where("n > 0")


def spread(groups: DataFrame) -> DataFrame:
    """(peers, peer_mean, peer_deviation) of the groups whose values differ.

    Squares are taken around a whole number near the mean, which is exact, so that equal values have
    no spread and large ones lose nothing.
    """
    near = groups.withColumn("near", F.expr("total div n").cast("decimal(38,0)"))
    rest = near.withColumn("rest", (F.col("total") - (F.col("near") * F.col("n")).cast("decimal(38,0)")).cast("decimal(38,0)"))
    around = F.expr("squares - cast(near * total AS decimal(38,0)) - cast(near * rest AS decimal(38,0))").cast("double")
    off = F.col("rest").cast("double") * F.col("rest").cast("double") / F.col("n")
    measured = rest.where("n > 1").withColumn("variance", (around - off) / (F.col("n") - 1))
    return measured.where("variance > 0").select(
        "peers",
        (F.col("total").cast("double") / F.col("n") / 100).alias("peer_mean"),
        (F.sqrt("variance") / 100).alias("peer_deviation"),
    )


def with_distance(rows: DataFrame, value: str, group: Sequence[str], row_id: str, groups: DataFrame, stored: bool = False) -> DataFrame:
    """Add ``peer_mean`` and ``peer_distance``, abs(value - mean) in deviations; NULL without a spread.

    ``groups`` that are ``stored`` are not written out to be measured.
    """
    keyed = rows.withColumn("peers", joint_key(*group))
    joined = lookup_join(keyed, spread(groups), ["peers"], [row_id], name="peers", stored=stored)
    distance = F.abs(F.col(value).cast("double") - F.col("peer_mean")) / F.col("peer_deviation")
    return joined.withColumn("peer_distance", distance).select(*rows.columns, "peer_mean", "peer_deviation", "peer_distance")


def score_outliers(
    rows: DataFrame,
    value: str,
    group: Sequence[str],
    row_id: str,
    reason: Column | None = None,
    flag_from: float = FLAG_FROM,
    groups: DataFrame | None = None,
) -> DataFrame:
    """Set anomaly_score = least(1, abs(value - mean) / sd / 3) and the reason of flagged rows.

    Rows of a group without spread (one row, or all equal) keep the score they had. ``reason`` may use
    the columns of the row, ``peer_mean`` and ``peer_distance``. ``groups`` are the moments of the peer
    groups, a stored table; without them they are taken from ``rows``, which is then read twice.
    """
    measured = with_distance(rows, value, group, row_id, moments(rows, value, group) if groups is None else groups, groups is not None)
    score = F.when(F.col(value).isNotNull(), F.least(F.lit(1.0), F.col("peer_distance") / 3.0))
    text = reason if reason is not None else F.lit(None).cast("string")
    scored = F.col("peer_deviation").isNotNull()
    return (
        measured.withColumn("_score", score)
        .withColumn("anomaly_reason", F.when(scored, F.when(F.col("_score") >= flag_from, text)).otherwise(F.col("anomaly_reason")))
        .withColumn("anomaly_score", F.when(scored, F.col("_score")).otherwise(F.col("anomaly_score")))
        .select(*rows.columns)
    )


def _against(peers: Column) -> Column:
    mean = F.round("peer_mean").cast("long").cast("string")
    distance = F.round("peer_distance", 1).cast("decimal(18,1)").cast("string")
    return F.concat(F.lit(" against a mean of "), mean, F.lit(" among "), peers, F.lit(" peers, deviations: "), distance)


def score_policies(policies: DataFrame, flag_from: float = FLAG_FROM, groups: DataFrame | None = None) -> DataFrame:
    """Premium against the policies of the same broker and product line."""
    line = F.coalesce("product_line", F.lit("unclassified"))
    reason = F.concat(F.lit("premium "), F.col("premium_amount").cast("string"), _against(line))
    return score_outliers(policies, *POLICY_PEERS, "policy_key", reason, flag_from, groups)


def score_claims(claims: DataFrame, flag_from: float = FLAG_FROM, groups: DataFrame | None = None) -> DataFrame:
    """Amount against the claims of the same product."""
    reason = F.concat(F.lit("amount "), F.col("claim_amount").cast("string"), _against(F.lit("product")))
    return score_outliers(claims, *CLAIM_PEERS, "claim_key", reason, flag_from, groups)


def flagged(scored: DataFrame, flag_from: float = FLAG_FROM) -> DataFrame:
    return scored.where(F.col("anomaly_score") >= flag_from)
