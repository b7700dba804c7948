"""Score, risk level and reason expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnrisk.functions import features as feature
from txnrisk.values import (
    DAYPARTS,
    HIGH,
    HIGH_FROM,
    LAST_DAYPART,
    LAST_SCORE_BUCKET,
    LOW,
    MEDIUM,
    MEDIUM_FROM,
    REASON_DEST_UNCHANGED,
    REASON_DRAINED,
    REASON_LARGE,
    REASON_OTHER,
    REASON_RISKY_TYPE,
    SCORE_BUCKETS,
)


def linear_probability(intercept: float, weights: Sequence[tuple[str, float]]) -> Column:
    """Logistic probability of a weighted sum, terms added in the given order."""
    z = F.lit(float(intercept))
    for name, weight in weights:
        z = z + F.lit(float(weight)) * F.col(name)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def class_probability(probs: Column, label: int = 1) -> Column:
    """Probability of ``label`` in an array of (label, prob) structs, in whatever order."""
    return F.map_from_entries(probs)[F.lit(label).cast("bigint")]


def reported_probability(probability: Column) -> Column:
    return F.round(probability, 4)


def risk_level(probability: Column) -> Column:
    """Level of the unrounded probability; a null counts as LOW.

    Nested, so that a filter on HIGH becomes one comparison of the probability.
    """
    below_high = F.when(probability >= MEDIUM_FROM, MEDIUM).otherwise(LOW)
    return F.when(probability >= HIGH_FROM, HIGH).otherwise(below_high)


def top_reason(drained: Column, unchanged: Column, large: Column, risky_type: Column) -> Column:
    """Text of the first flag that is 1."""
    return (
        F.when(drained == 1, REASON_DRAINED)
        .when(unchanged == 1, REASON_DEST_UNCHANGED)
        .when(large == 1, REASON_LARGE)
        .when(risky_type == 1, REASON_RISKY_TYPE)
        .otherwise(REASON_OTHER)
    )


def top_reason_from_row(threshold: Column) -> Column:
    """The reason worked out from the row's own type, amount and balances."""
    return top_reason(
        feature.orig_balance_zero_after(),
        feature.dest_balance_unchanged(),
        feature.is_large_transaction(threshold),
        feature.is_transfer_or_cashout(),
    )


def top_reason_from_features() -> Column:
    """The reason read from stored feature columns."""
    return top_reason(
        F.col("orig_balance_zero_after"),
        F.col("dest_balance_unchanged"),
        F.col("is_large_transaction"),
        F.col("is_transfer_or_cashout"),
    )


def score_bucket(probability: Column) -> Column:
    """Histogram label of a stored probability; a null falls in the last bucket."""
    label = F.lit(LAST_SCORE_BUCKET)
    for upper, name in reversed(SCORE_BUCKETS):
        label = F.when(probability < upper, name).otherwise(label)
    return label


def daypart(step: Column) -> Column:
    """Part of the day of an hour index; negative and null steps fall in the last one."""
    hour = step % 24
    label = F.lit(LAST_DAYPART)
    for first, last, name in reversed(DAYPARTS):
        label = F.when(hour.between(first, last), name).otherwise(label)
    return label
