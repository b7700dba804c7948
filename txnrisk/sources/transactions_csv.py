"""Raw transactions from CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnrisk.schemas import TRANSACTIONS


def read_transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Transactions from CSV files with one header row, typed by the declared schema.

    Columns are taken by position. No value is inferred, so nothing is read twice, and a
    value that does not fit its type fails the load. Plain files are split between tasks;
    a gzip file is read by one.
    """
    return spark.read.csv(path, schema=TRANSACTIONS, header=True, mode="FAILFAST")
