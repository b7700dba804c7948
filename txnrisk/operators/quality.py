"""Counts of bad rows, log rows built from them, and the gates that stop a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.functions.exact import rounded_mean
from txnrisk.values import (
    FEATURE_CHECKS,
    MAX_FRAUD_PCT,
    RISKY_TYPES,
    RUN_STATUS,
    TRANSACTION_KEY,
    VALIDATION_ACTIONS,
)


class GateError(ValueError):
    """A table failed a check that must hold before the next step."""


def null_keys() -> Column:
    condition = F.lit(False)
    for name in ("amount", "nameOrig", "nameDest", "type"):
        condition = condition | F.col(name).isNull()
    return F.count_if(condition)


def non_positive_amounts() -> Column:
    return F.count_if(F.col("amount") <= 0)


def duplicates() -> Column:
    """Rows beyond the first per key; a row with a null in its key counts as one."""
    return F.count("*") - F.count_distinct(*TRANSACTION_KEY)


def impossible_balances() -> Column:
    return F.count_if(
        F.col("type").isin(*RISKY_TYPES)
        & (F.col("amount") > F.col("oldbalanceOrg") + 1)
        & (F.col("oldbalanceOrg") > 0)
    )


def dq_null_keys(raw: DataFrame) -> DataFrame:
    return raw.agg(null_keys().alias("records_found"))


def dq_non_positive_amount(raw: DataFrame) -> DataFrame:
    return raw.agg(non_positive_amounts().alias("records_found"))


def dq_duplicates(raw: DataFrame) -> DataFrame:
    return raw.agg(duplicates().alias("records_found"))


def dq_impossible_balance(raw: DataFrame) -> DataFrame:
    return raw.agg(impossible_balances().alias("records_found"))


def _unpivot(one_row: DataFrame, name: str, value: str) -> DataFrame:
    """One row per column of a one-row frame."""
    pairs = [F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in one_row.columns]
    return one_row.select(F.inline(F.array(*pairs)))


def validation_log_rows(raw: DataFrame, run_ts: Column, keys: int | None = None) -> DataFrame:
    """The four checks of the raw table as log rows, counted in one scan.

    With the number of different keys at hand, from ``clean_and_count``, no key is shuffled.
    """
    repeats = duplicates() if keys is None else F.count("*") - F.lit(keys)
    checks = (null_keys(), non_positive_amounts(), repeats, impossible_balances())
    counted = raw.agg(*[c.alias(name) for name, c in zip(VALIDATION_ACTIONS, checks)])
    action = F.create_map(*[F.lit(part) for pair in VALIDATION_ACTIONS.items() for part in pair])
    return _unpivot(counted, "check_name", "records_found").select(
        run_ts.alias("run_date"),
        "check_name",
        F.coalesce("records_found", F.lit(0)).cast("bigint").alias("records_found"),
        action[F.col("check_name")].alias("action_taken"),
    )


def load_stats(raw: DataFrame) -> DataFrame:
    """Row count, fraud count and fraud share in percent; zeros for an empty table."""
    totals = raw.agg(
        F.count("*").alias("total_rows"),
        F.coalesce(F.sum("isFraud"), F.lit(0)).cast("bigint").alias("fraud_rows"),
    )
    share = F.try_divide(F.col("fraud_rows").cast("double"), F.col("total_rows").cast("double"))
    return totals.select(
        "total_rows",
        "fraud_rows",
        F.coalesce(F.round(share * 100, 4), F.lit(0.0)).alias("fraud_pct"),
    )


def gate_load(stats: DataFrame) -> None:
    """Raise on an empty load or a fraud share above the limit."""
    row = stats.first()
    if row.total_rows == 0:
        raise GateError("no rows were loaded")
    if row.fraud_pct > MAX_FRAUD_PCT:
        raise GateError(f"fraud share {row.fraud_pct} % is above {MAX_FRAUD_PCT} %")


def gate_non_empty(df: DataFrame) -> bool:
    """Whether there is anything to work on; reads rows only until the first is found."""
    return not df.isEmpty()


def staging_check(clean: DataFrame) -> DataFrame:
    return clean.agg(
        F.count("*").alias("clean_rows"),
        F.count_if(F.col("isFraud") == 1).alias("fraud_rows"),
        F.count_if(F.col("amount") <= 0).alias("bad_amount_rows"),
    )


def feature_checks(features: DataFrame) -> DataFrame:
    """Rows that break each feature rule, counted in one scan."""
    hour = F.col("hour_of_step")
    checks = (
        F.col("amount_to_balance_ratio") < 0,
        F.col("type_encoded") == 0,
        (hour < 0) | (hour > 23),
    )
    counted = features.agg(*[F.count_if(c).alias(name) for name, c in zip(FEATURE_CHECKS, checks)])
    return _unpivot(counted, "check_name", "records_found")


def gate_features(checks: DataFrame) -> None:
    """Raise when any feature rule is broken."""
    broken = {row.check_name: row.records_found for row in checks.collect() if row.records_found}
    if broken:
        raise GateError(f"feature checks failed: {broken}")


def ingestion_log_row(df: DataFrame, table: str, run_ts: Column) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).select(
        run_ts.alias("run_date"),
        F.lit(table).alias("table_name"),
        F.lit(RUN_STATUS).alias("status"),
        "row_count",
    )


def feature_verify(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("isFraud") == 1).alias("fraud_count"),
        F.count_if(F.col("orig_balance_zero_after") == 1).alias("zero_balance_orig_count"),
        F.count_if(F.col("dest_balance_unchanged") == 1).alias("unchanged_dest_count"),
        F.count_if(F.col("is_large_transaction") == 1).alias("large_txn_count"),
        rounded_mean("amount_to_balance_ratio", 4).alias("avg_amount_ratio"),
    )


def _feature_log_columns() -> list[Column]:
    return [
        F.count("*").alias("total_records"),
        F.count_if(F.col("isFraud") == 1).alias("fraud_records"),
        rounded_mean("amount", 2).alias("avg_amount"),
        F.count_if(F.col("is_large_transaction") == 1).alias("large_txn_count"),
        F.count_if(F.col("orig_balance_zero_after") == 1).alias("zero_balance_count"),
    ]


def feature_log_row(features: DataFrame, run_ts: Column) -> DataFrame:
    return features.agg(*_feature_log_columns()).select(run_ts.alias("run_date"), "*")


def feature_log_rows(features: DataFrame, run_ts: Column) -> DataFrame:
    """One log row per value of a run time worked out from the row."""
    return features.groupBy(run_ts.alias("run_date")).agg(*_feature_log_columns())


def latest_feature_log(feature_log: DataFrame) -> DataFrame:
    """The newest row; of several with its run time, the one with most records and then values."""
    others = [c for c in feature_log.columns if c not in ("run_date", "total_records")]
    newest = (F.col(c).desc_nulls_last() for c in ("run_date", "total_records", *others))
    return (
        feature_log.orderBy(*newest)
        .limit(1)
        .select(
            "total_records", "fraud_records", "avg_amount", "large_txn_count", "zero_balance_count"
        )
    )
