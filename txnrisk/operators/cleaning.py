"""Deduplication and validity filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from txnrisk.schemas import TRANSACTIONS
from txnrisk.values import TRANSACTION_TYPES

# The transaction key with its most varied column first: rows are sorted by the key before and
# after the shuffle, and most comparisons then end at the first column.
SORTED_KEY = ("amount", "nameOrig", "nameDest", "step")
SURVIVOR_ORDER = (
    "type",
    "oldbalanceOrg",
    "newbalanceOrig",
    "oldbalanceDest",
    "newbalanceDest",
    "isFraud",
    "isFlaggedFraud",
)


def dedup_transactions(raw: DataFrame) -> DataFrame:
    """One row per (step, nameOrig, amount, nameDest): the first in SURVIVOR_ORDER.

    Ordering by every other column makes the survivor the same on each run. The rank filter
    is applied before the shuffle as well as after it, so a key with any number of copies
    sends at most one row per input split.
    """
    by_key = Window.partitionBy(*SORTED_KEY).orderBy(
        *[F.col(name).asc_nulls_first() for name in SURVIVOR_ORDER]
    )
    return (
        raw.withColumn("row_num", F.row_number().over(by_key))
        .where(F.col("row_num") == 1)
        .drop("row_num")
    )


def filter_valid(df: DataFrame) -> DataFrame:
    """Rows with amount, both names and type present, a positive amount and a known type."""
    present = [F.col(name).isNotNull() for name in ("amount", "nameOrig", "nameDest", "type")]
    condition = (F.col("amount") > 0) & ~F.isnan("amount") & F.col("type").isin(*TRANSACTION_TYPES)
    for check in present:
        condition = condition & check
    return df.where(condition)


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Deduplicate, then filter: an invalid copy that sorts first takes its key with it."""
    return filter_valid(dedup_transactions(raw)).select(*TRANSACTIONS.names)


def clean_and_count(raw: DataFrame, seen: Observation) -> DataFrame:
    """The clean rows; the number of different keys without a null, ``keys``, is observed on the way.

    Rows that could not be clean for want of an amount or a name are left out first. The count is taken behind the
    shuffle, in the tasks that write the result, where Spark counts each task once however often it is tried.
    """
    present = raw.where("amount IS NOT NULL AND nameOrig IS NOT NULL AND nameDest IS NOT NULL")
    keys = F.count_if(F.col("step").isNotNull()).alias("keys")
    return filter_valid(dedup_transactions(present).observe(seen, keys)).select(*TRANSACTIONS.names)
