"""Fraud features as single column expressions over a transaction row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnrisk.values import RISKY_TYPES, TRANSACTION_TYPES


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def net_orig_change() -> Column:
    return F.col("oldbalanceOrg") - F.col("newbalanceOrig")


def net_dest_change() -> Column:
    return F.col("newbalanceDest") - F.col("oldbalanceDest")


def balance_diff_orig() -> Column:
    return net_orig_change() - F.col("amount")


def balance_diff_dest() -> Column:
    return net_dest_change() - F.col("amount")


def orig_balance_zero_after() -> Column:
    return flag((F.col("newbalanceOrig") == 0) & (F.col("oldbalanceOrg") > 0))


def dest_balance_unchanged() -> Column:
    return flag((F.col("newbalanceDest") == F.col("oldbalanceDest")) & (F.col("amount") > 0))


def amount_to_balance_ratio() -> Column:
    return F.try_divide(F.col("amount"), F.col("oldbalanceOrg") + 1)


def is_large_transaction(threshold: Column) -> Column:
    return flag(F.col("amount") > threshold)


def hour_of_step() -> Column:
    return F.col("step") % 24


def type_encoded() -> Column:
    code = F.lit(0)
    for number, name in enumerate(TRANSACTION_TYPES, start=1):
        code = F.when(F.col("type") == name, number).otherwise(code)
    return code.cast("bigint")


def is_transfer_or_cashout() -> Column:
    return flag(F.col("type").isin(*RISKY_TYPES))


def feature_columns(threshold: Column) -> dict[str, Column]:
    """The eleven features by name, in table order."""
    return {
        "balance_diff_orig": balance_diff_orig(),
        "balance_diff_dest": balance_diff_dest(),
        "orig_balance_zero_after": orig_balance_zero_after(),
        "dest_balance_unchanged": dest_balance_unchanged(),
        "amount_to_balance_ratio": amount_to_balance_ratio(),
        "is_large_transaction": is_large_transaction(threshold),
        "hour_of_step": hour_of_step(),
        "type_encoded": type_encoded(),
        "is_transfer_or_cashout": is_transfer_or_cashout(),
        "net_orig_change": net_orig_change(),
        "net_dest_change": net_dest_change(),
    }
