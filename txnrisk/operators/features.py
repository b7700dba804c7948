"""The large-amount threshold and the feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.functions.features import feature_columns
from txnrisk.operators.quantiles import approx_quantile, exact_quantile
from txnrisk.values import LARGE_AMOUNT_QUANTILE


def large_amount_threshold(clean: DataFrame, method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """One row, ``threshold``: the 95th percentile of amount.

    ``exact`` shuffles only counts and is the one to use on very many input splits;
    ``approx`` is a single pass whose sketches all meet in one task.
    """
    if method == "exact":
        return exact_quantile(clean, "amount", LARGE_AMOUNT_QUANTILE)
    if method == "approx":
        return approx_quantile(clean, "amount", LARGE_AMOUNT_QUANTILE, accuracy=accuracy)
    raise ValueError(f"unknown method {method!r}")


def threshold_column(threshold: float | Column | DataFrame) -> Column:
    """A number, a column or a one-row frame as a column; the frame becomes a scalar subquery."""
    if isinstance(threshold, DataFrame):
        return threshold.scalar()
    if isinstance(threshold, Column):
        return threshold
    return F.lit(float(threshold))


def build_features(
    clean: DataFrame, threshold: float | Column | DataFrame | None = None
) -> DataFrame:
    """All input columns and the eleven features; the threshold is worked out when not given."""
    if threshold is None:
        threshold = large_amount_threshold(clean)
    return clean.withColumns(feature_columns(threshold_column(threshold)))


def stored_threshold(features: DataFrame) -> DataFrame:
    """One row: the threshold a feature table was built with, as far as its rows can tell.

    The largest amount that is not large separates the table's amounts exactly as the
    threshold did.
    """
    not_large = F.max(F.when(F.col("is_large_transaction") == 0, F.col("amount")))
    return features.agg(F.coalesce(not_large, F.lit(float("-inf"))).alias("threshold"))
