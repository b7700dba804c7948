"""Small hand-made tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnrisk.schemas import TRANSACTIONS

PLAIN = {
    "step": 1,
    "type": "PAYMENT",
    "amount": 10.0,
    "nameOrig": "C1",
    "oldbalanceOrg": 100.0,
    "newbalanceOrig": 90.0,
    "nameDest": "M1",
    "oldbalanceDest": 0.0,
    "newbalanceDest": 10.0,
    "isFraud": 0,
    "isFlaggedFraud": 0,
}


def transactions(spark: SparkSession, *changes: dict) -> DataFrame:
    """One plain transaction per argument, with the given columns changed."""
    rows = [tuple({**PLAIN, **change}.values()) for change in changes]
    return spark.createDataFrame(rows, TRANSACTIONS)


def column(df: DataFrame, name: str) -> list:
    return [row[name] for row in df.collect()]
