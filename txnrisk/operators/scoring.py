"""Predictions, alerts and the daily summaries made from them.

A scored frame is a feature frame with two more columns: ``predicted_isFraud`` (0 or 1) and
``probability`` (of fraud, unrounded).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.functions.exact import rounded_mean
from txnrisk.functions.features import flag
from txnrisk.functions.scoring import (
    linear_probability,
    reported_probability,
    risk_level,
    top_reason_from_features,
    top_reason_from_row,
)
from txnrisk.operators.features import threshold_column
from txnrisk.schemas import FRAUD_PREDICTIONS, HIGH_RISK_ALERTS, RUN_DAY
from txnrisk.values import (
    DECISION_THRESHOLD,
    HIGH,
    LOW,
    MEDIUM,
    NEW_ALERT_STATUS,
    REPORT_KEY,
    SCORE_AFTER_STEP,
)

# Columns that make the order of equally scored rows the same on each run.
TIE_BREAK = ("step", "nameOrig", "amount", "nameDest", "type")


def score_window(features: DataFrame, after_step: int = SCORE_AFTER_STEP) -> DataFrame:
    return features.where(F.col("step") > after_step)


def score_linear(
    features: DataFrame, intercept: float, weights: Sequence[tuple[str, float]]
) -> DataFrame:
    """Score with given logistic weights."""
    return features.withColumn("probability", linear_probability(intercept, weights)).withColumn(
        "predicted_isFraud", flag(F.col("probability") > DECISION_THRESHOLD)
    )


def on_run_date(df: DataFrame, timestamp: str, run_date: dt.date | None) -> DataFrame:
    """Rows of one run date; reads only that day's files when the table is stored by day."""
    if run_date is None:
        return df
    same_day = F.to_date(timestamp) == F.lit(run_date)
    if RUN_DAY in df.columns:
        same_day = same_day & (F.col(RUN_DAY) == F.lit(run_date))
    return df.where(same_day)


def _with_report_columns(scored: DataFrame, run_ts: Column) -> DataFrame:
    return scored.withColumns(
        {
            "prediction_date": run_ts,
            "fraud_probability": reported_probability(F.col("probability")),
            "risk_level": risk_level(F.col("probability")),
        }
    )


def fraud_predictions(scored: DataFrame, run_ts: Column) -> DataFrame:
    """The prediction table: each scored row once, no join."""
    return _with_report_columns(scored, run_ts).select(*FRAUD_PREDICTIONS.names)


def rejoin_on_key(predictions: DataFrame, features: DataFrame) -> DataFrame:
    """Inner join of predictions to feature rows on (nameOrig, step, amount).

    Rows that share those three columns but differ in nameDest match each other, so they
    multiply; every column the two sides share, apart from the key, comes from the feature
    row. Feature columns are read from the right side.
    """
    kept = [c for c in predictions.columns if c not in features.columns or c in REPORT_KEY]
    return predictions.select(*kept).join(features, list(REPORT_KEY), "inner")


def fraud_predictions_rejoined(
    scored: DataFrame, features: DataFrame, run_ts: Column, after_step: int = SCORE_AFTER_STEP
) -> DataFrame:
    """The prediction table as a join of scores back to the feature table, with its fan-out."""
    scores = scored.select(*REPORT_KEY, "predicted_isFraud", "probability")
    joined = rejoin_on_key(scores, score_window(features, after_step))
    return _with_report_columns(joined, run_ts).select(*FRAUD_PREDICTIONS.names)


def _as_alerts(df: DataFrame, run_ts: Column, reason: Column) -> DataFrame:
    return df.withColumns(
        {
            "alert_date": run_ts,
            "alert_status": F.lit(NEW_ALERT_STATUS),
            "top_reason": reason,
        }
    ).select(*HIGH_RISK_ALERTS.names)


def high_risk_alerts(
    predictions: DataFrame,
    threshold: float | Column | DataFrame,
    run_ts: Column,
    run_date: dt.date | None = None,
) -> DataFrame:
    """One alert per HIGH prediction of the run date, its reason taken from the same row."""
    high = on_run_date(predictions, "prediction_date", run_date).where(F.col("risk_level") == HIGH)
    return _as_alerts(high, run_ts, top_reason_from_row(threshold_column(threshold)))


def high_risk_alerts_rejoined(
    predictions: DataFrame, features: DataFrame, run_ts: Column, run_date: dt.date | None = None
) -> DataFrame:
    """Alerts from a join of HIGH predictions to the feature table, with its fan-out.

    Only the flags come from the feature side; type and nameDest are the prediction's own.
    """
    high = on_run_date(predictions, "prediction_date", run_date).where(F.col("risk_level") == HIGH)
    flags = features.select(
        *REPORT_KEY,
        "orig_balance_zero_after",
        "dest_balance_unchanged",
        "is_large_transaction",
        "is_transfer_or_cashout",
    )
    joined = high.join(flags, list(REPORT_KEY), "inner")
    return _as_alerts(joined, run_ts, top_reason_from_features())


def _summary_columns() -> list[Column]:
    at_risk = F.when(F.col("risk_level").isin(HIGH, MEDIUM), F.col("amount")).otherwise(0.0)
    return [
        F.count("*").alias("total_transactions"),
        F.count_if(F.col("predicted_isFraud") == 1).alias("flagged_count"),
        F.count_if(F.col("risk_level") == HIGH).alias("high_risk_count"),
        F.count_if(F.col("risk_level") == MEDIUM).alias("medium_risk_count"),
        F.count_if(F.col("risk_level") == LOW).alias("low_risk_count"),
        F.round(F.sum(at_risk), 2).alias("total_amount_at_risk"),
        rounded_mean("fraud_probability", 4).alias("avg_fraud_probability"),
    ]


def daily_summary(
    predictions: DataFrame, run_ts: Column, model: str, run_date: dt.date | None = None
) -> DataFrame:
    """One summary row of the run date's predictions."""
    rows = on_run_date(predictions, "prediction_date", run_date)
    return (
        rows.agg(*_summary_columns())
        .withColumn("model_used", F.lit(model))
        .select(run_ts.alias("summary_date"), "*")
    )


def daily_summaries(predictions: DataFrame, model: str) -> DataFrame:
    """One summary row for each run date in the predictions."""
    return (
        predictions.groupBy(F.to_date("prediction_date").alias("summary_date"))
        .agg(*_summary_columns())
        .withColumn("model_used", F.lit(model))
    )


def risk_level_hit_rate(predictions: DataFrame, run_date: dt.date | None = None) -> DataFrame:
    """How often each risk level really is fraud, best first."""
    fraud = F.count_if(F.col("isFraud") == 1)
    return (
        on_run_date(predictions, "prediction_date", run_date)
        .groupBy("risk_level")
        .agg(
            F.count("*").alias("total"),
            fraud.alias("actual_fraud"),
            F.round(fraud / F.count("*") * 100, 2).alias("hit_rate_pct"),
            rounded_mean("fraud_probability", 4).alias("avg_score"),
        )
        .orderBy(F.col("hit_rate_pct").desc(), "risk_level")
    )


def by_score(df: DataFrame) -> list[Column]:
    """Highest stored probability first, equal scores in row-key order."""
    return [F.col("fraud_probability").desc_nulls_last()] + [
        F.col(name).asc_nulls_last() for name in TIE_BREAK if name in df.columns
    ]


def top_risk_transactions(
    predictions: DataFrame, run_date: dt.date | None = None, n: int = 20
) -> DataFrame:
    """The n highest scored transactions of the run date."""
    rows = on_run_date(predictions, "prediction_date", run_date)
    return (
        rows.orderBy(*by_score(rows))
        .limit(n)
        .select(
            "type", "amount", "nameOrig", "nameDest", "fraud_probability", "risk_level", "isFraud"
        )
    )


def prediction_count(predictions: DataFrame, run_date: dt.date | None = None) -> DataFrame:
    return on_run_date(predictions, "prediction_date", run_date).agg(
        F.count("*").alias("prediction_count")
    )


def alert_totals(alerts: DataFrame, run_date: dt.date | None = None) -> DataFrame:
    """Number and summed amount of the day's HIGH alerts; zeros when there are none."""
    return (
        on_run_date(alerts, "alert_date", run_date)
        .where(F.col("risk_level") == HIGH)
        .agg(
            F.count("*").alias("high_risk"),
            F.coalesce(F.round(F.sum("amount"), 2), F.lit(0.0)).alias("total_amount"),
        )
    )
