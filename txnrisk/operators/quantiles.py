"""Quantiles of one column over any number of rows."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.functions.exact import order_digits
from txnrisk.sources.tables import materialize

#: Ranges per binade, as a power of two, and ranges that one of them is cut into where it has too many values.
RANGE_BITS = 6
CUTS = 4096
#: Distinct values that one task may put in order.
CELL_VALUES = 4096


def exact_quantile(df: DataFrame, column: str, q: float, name: str = "threshold") -> DataFrame:
    """One row: the smallest value whose cumulative share of the non-null rows reaches ``q``; null without any.

    A prefix count over ranges. One pass over the rows counts each distinct value and stores the counts. Their sums
    per range of values are a small table, whose running sum shows the range that holds the wanted rank; only the
    values of that range are then put in order. A range with more than ``CELL_VALUES`` values is
    cut into finer ones first, so no task ever orders more than a few thousand rows, however close the values
    lie together, and a value that fills a third of the table is one row after the map-side count.

    The result is worked out when this is called, and is a frame of one known value.
    """
    value = F.col(column).cast("double")
    counted = df.where(value.isNotNull()).groupBy(value.alias("value")).agg(F.count("*").alias("n"))
    inside = materialize(counted, "value-counts")
    # Decimal, so that seven hundredths of a hundred rows are seven rows and not eight.
    rank = F.ceil(F.lit(Decimal(str(q))) * F.sum("n").over(Window.partitionBy())).cast("bigint")
    found, cell = None, order_digits(F.col("value"), (RANGE_BITS,))[0]
    while True:
        ranges = inside.groupBy(cell.alias("cell")).agg(
            F.sum("n").alias("n"), F.count("*").alias("values"), F.min("value").alias("low"), F.max("value").alias("high")
        )
        hit = _at_rank(ranges, "cell", rank)
        if hit is None:
            break
        low, high = hit["low"], hit["high"]
        inside = inside.where(F.col("value").between(low, high))
        rank = F.lit(hit["rank"] - hit["upto"] + hit["n"])
        if hit["values"] <= CELL_VALUES:
            found = _at_rank(inside, "value", rank)["value"]
            break
        # The difference, the quotient and the product grow with the value, so the cells are in its order.
        cell = F.floor((F.col("value") - low) / F.lit(high - low) * CUTS)
    return df.sparkSession.createDataFrame([(found,)], f"{name} double")


def _at_rank(counts: DataFrame, order: str, rank) -> dict | None:
    """The row of ``counts`` (``n`` rows each) in which the running sum reaches the rank."""
    up_to = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    walked = counts.withColumn("upto", F.sum("n").over(up_to)).withColumn("rank", rank)
    return walked.where((F.col("upto") - F.col("n") < F.col("rank")) & (F.col("rank") <= F.col("upto"))).first()


def approx_quantile(
    df: DataFrame, column: str, q: float, name: str = "threshold", accuracy: int = 10000
) -> DataFrame:
    """One row: a value whose rank is within 1/accuracy of ``q``, in a single pass."""
    return df.agg(F.approx_percentile(column, q, accuracy).alias(name))
