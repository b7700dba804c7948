"""Raw transactions derived from the ``events`` table.

The benchmark tables hold no payments, so each event is turned into one, with bad values and
copies injected by rules on its id. Money is worked out in whole cents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.schemas import TRANSACTIONS
from txnrisk.values import RISKY_TYPES

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"

# The transaction type an event type stands for; any other is CASH_IN.
TYPE_OF_EVENT = {
    "view": "PAYMENT",
    "purchase": "TRANSFER",
    "click": "CASH_OUT",
    "error": "DEBIT",
}


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _money(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100.0)


def raw_transactions(events: DataFrame) -> DataFrame:
    """One transaction per event plus the injected copies, in one scan."""
    key, cents = F.col("event_id"), F.col("cents")
    kind = F.lit("CASH_IN")
    for event_type, transaction_type in TYPE_OF_EVENT.items():
        kind = F.when(F.col("event_type") == event_type, transaction_type).otherwise(kind)

    base = events.select(
        "event_id",
        "user_id",
        ((F.day("ts") - 1) * 24 + F.hour("ts") + 1).cast("bigint").alias("step"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        kind.alias("kind"),
        F.when(_every(7), 0).otherwise(key * 7919 % 20000).cast("bigint").alias("orig_before"),
        (key * 10473 % 300000).alias("dest_before"),
    ).withColumns(
        {
            "orig_after": F.when(
                F.col("kind") == "CASH_IN", F.col("orig_before") + cents
            ).otherwise(F.greatest(F.col("orig_before") - cents, F.lit(0))),
            "dest_after": F.when(_every(3), F.col("dest_before")).otherwise(
                F.col("dest_before") + cents
            ),
        }
    )

    drained = (F.col("orig_after") == 0) & (F.col("orig_before") > 0)
    fraud = (F.col("kind").isin(*RISKY_TYPES) & drained & (key % 4 != 0)) | _every(389)
    row = base.select(
        "event_id",
        "step",
        F.when(_every(181), "UNKNOWN").when(~_every(227), F.col("kind")).alias("type"),
        F.when(~_every(211), F.when(_every(197), _money(-cents)).otherwise(_money(cents))).alias(
            "amount"
        ),
        F.when(~_every(223), F.concat(F.lit("C"), F.col("user_id").cast("string"))).alias(
            "nameOrig"
        ),
        _money(F.col("orig_before")).alias("oldbalanceOrg"),
        _money(F.col("orig_after")).alias("newbalanceOrig"),
        F.when(~_every(229), F.concat(F.lit("M"), (key % 97).cast("string"))).alias("nameDest"),
        _money(F.col("dest_before")).alias("oldbalanceDest"),
        _money(F.col("dest_after")).alias("newbalanceDest"),
        F.when(fraud, 1).otherwise(0).cast("bigint").alias("isFraud"),
        F.when((F.col("kind") == "TRANSFER") & (cents > 20000), 1)
        .otherwise(0)
        .cast("bigint")
        .alias("isFlaggedFraud"),
    )

    copies = F.array(
        F.lit("original"),
        F.when(_every(101), "same"),
        F.when(_every(103), "bad type"),
        F.when(_every(107), "other destination"),
    )
    variant = F.col("variant")
    return (
        row.withColumn("variant", F.explode(copies))
        .where(variant.isNotNull())
        .withColumns(
            {
                "type": F.when(variant == "bad type", "BAD_TYPE").otherwise(F.col("type")),
                "nameDest": F.when(
                    variant == "other destination", F.concat("nameDest", F.lit("x"))
                ).otherwise(F.col("nameDest")),
            }
        )
        .select(*TRANSACTIONS.names)
    )


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events table, by declared schema so that no footer is read to plan a query."""
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")
