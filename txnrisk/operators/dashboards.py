"""The queries behind the three dashboard pages."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.functions.exact import rounded_mean
from txnrisk.functions.scoring import daypart, score_bucket
from txnrisk.operators.scoring import by_score, on_run_date
from txnrisk.schemas import RUN_DAY

# ---------------------------------------------------------------- filters


def filter_date_range(
    df: DataFrame, timestamp: str, first: dt.date | None, last: dt.date | None
) -> DataFrame:
    """Rows whose date lies in the range; an open end is None."""
    by_day = F.col(RUN_DAY) if RUN_DAY in df.columns else None
    for bound, keep in ((first, Column.__ge__), (last, Column.__le__)):
        if bound is not None:
            df = df.where(keep(F.to_date(timestamp), F.lit(bound)))
            if by_day is not None:
                df = df.where(keep(by_day, F.lit(bound)))
    return df


def filter_dropdown(df: DataFrame, **choices: Iterable[str] | None) -> DataFrame:
    """Rows whose columns hold one of the chosen values; None leaves a column unfiltered."""
    for name, values in choices.items():
        if values is not None:
            df = df.where(F.col(name).isin(*values))
    return df


def _share(n: Column, total: Column, digits: int = 2) -> Column:
    return F.round(n * 100.0 / total, digits)


def _fraud_count() -> Column:
    return F.count_if(F.col("isFraud") == 1)


# ---------------------------------------------------------------- page 1


def kpi_total_transactions(summary: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return on_run_date(summary, "summary_date", as_of).agg(
        F.sum("total_transactions").alias("total_transactions")
    )


def kpi_high_risk(summary: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return on_run_date(summary, "summary_date", as_of).agg(
        F.sum("high_risk_count").alias("high_risk_count")
    )


def kpi_amount_at_risk(summary: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return on_run_date(summary, "summary_date", as_of).agg(
        F.round(F.sum("total_amount_at_risk"), 2).alias("total_amount_at_risk")
    )


def kpi_avg_score(summary: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Mean of the daily means, unweighted."""
    return on_run_date(summary, "summary_date", as_of).agg(
        rounded_mean("avg_fraud_probability", 4).alias("avg_fraud_probability")
    )


def daily_risk_trend(summary: DataFrame) -> DataFrame:
    counts = ("high_risk_count", "medium_risk_count", "low_risk_count")
    return (
        summary.groupBy(F.to_date("summary_date").alias("summary_date"))
        .agg(*[F.sum(c).alias(c) for c in counts])
        .orderBy(F.col("summary_date").desc())
    )


def _counts_with_share(df: DataFrame, key: str, count: str, share: str) -> DataFrame:
    """Rows per key value and their share of all rows; the total is summed over the groups."""
    total = F.sum(count).over(Window.partitionBy())
    return (
        df.groupBy(key)
        .agg(F.count("*").alias(count))
        .withColumn(share, _share(F.col(count), total))
        .orderBy(F.col(count).desc(), key)
    )


def risk_distribution(predictions: DataFrame) -> DataFrame:
    return _counts_with_share(predictions, "risk_level", "transaction_count", "pct_of_total")


def fraud_by_type(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy("type")
        .agg(
            F.count("*").alias("total_transactions"),
            _fraud_count().alias("actual_fraud_count"),
            F.count_if(F.col("predicted_isFraud") == 1).alias("predicted_fraud_count"),
            _share(_fraud_count(), F.count("*")).alias("fraud_rate_pct"),
        )
        .orderBy(F.col("actual_fraud_count").desc(), "type")
    )


# ---------------------------------------------------------------- page 2


def alert_queue(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(*by_score(alerts)).select(
        F.to_date("alert_date").alias("alert_date"),
        "type",
        F.round("amount", 2).alias("amount"),
        "nameOrig",
        "nameDest",
        F.round("fraud_probability", 4).alias("fraud_probability"),
        "risk_level",
        "top_reason",
        "alert_status",
    )


def alerts_by_status(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy("alert_status")
        .agg(F.count("*").alias("alert_count"))
        .orderBy(F.col("alert_count").desc(), "alert_status")
    )


def top_alert_reasons(alerts: DataFrame, n: int = 10) -> DataFrame:
    return _counts_with_share(alerts, "top_reason", "occurrence_count", "pct_of_alerts").limit(n)


def alerts_by_type(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy("type")
        .agg(
            F.count("*").alias("alert_count"),
            F.round(F.sum("amount"), 2).alias("total_amount_at_risk"),
            rounded_mean("amount", 2).alias("avg_alert_amount"),
            rounded_mean("fraud_probability", 4).alias("avg_fraud_score"),
        )
        .orderBy(F.col("total_amount_at_risk").desc_nulls_last(), "type")
    )


def alerts_by_hour(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy(F.hour("alert_date").cast("bigint").alias("alert_hour"))
        .agg(
            F.count("*").alias("alert_count"),
            rounded_mean("fraud_probability", 4).alias("avg_fraud_probability"),
            F.round(F.sum("amount"), 2).alias("total_amount"),
        )
        .orderBy("alert_hour")
    )


def top_risk_accounts(alerts: DataFrame, n: int = 20) -> DataFrame:
    """Origin accounts with more than one alert, most alerts first."""
    return (
        alerts.groupBy("nameOrig")
        .agg(
            F.count("*").alias("alert_count"),
            F.round(F.sum("amount"), 2).alias("total_amount_flagged"),
            F.round(F.max("fraud_probability"), 4).alias("max_fraud_score"),
            F.sort_array(F.collect_set("type")).alias("transaction_types"),
        )
        .where(F.col("alert_count") > 1)
        .orderBy(F.col("alert_count").desc(), "nameOrig")
        .limit(n)
    )


# ---------------------------------------------------------------- page 3


def _rounded(*metrics: str) -> list[Column]:
    return [F.round(metric, 4).alias(metric) for metric in metrics]


def latest_model_metrics(evaluation_log: DataFrame, model_name: str | None = None) -> DataFrame:
    """The newest evaluation, of any model unless one is named."""
    rows = filter_dropdown(evaluation_log, model_name=[model_name] if model_name else None)
    return (
        rows.orderBy(F.col("run_date").desc(), "model_name")
        .limit(1)
        .select("model_name", *_rounded("f1_score", "precision", "recall", "roc_auc"))
    )


def model_history(evaluation_log: DataFrame) -> DataFrame:
    return evaluation_log.orderBy(F.col("run_date").desc(), "model_name").select(
        F.to_date("run_date").alias("run_date"),
        "model_name",
        *_rounded("f1_score", "precision", "recall", "roc_auc", "log_loss"),
    )


def model_comparison(evaluation_log: DataFrame) -> DataFrame:
    newest_best = (F.col("run_date").desc(), F.col("f1_score").desc_nulls_last(), "model_name")
    return evaluation_log.orderBy(*newest_best).select(
        "model_name",
        F.to_date("run_date").alias("run_date"),
        *_rounded("f1_score", "precision", "recall", "roc_auc", "log_loss"),
        "status",
    )


def training_volume(training_log: DataFrame) -> DataFrame:
    return training_log.orderBy(F.col("run_date").desc(), "model_name").select(
        "model_name",
        F.to_date("run_date").alias("run_date"),
        "training_rows",
        "eval_rows",
        "threshold_used",
    )


def score_histogram(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy(score_bucket(F.col("fraud_probability")).alias("prob_bucket"))
        .agg(
            F.count("*").alias("transaction_count"),
            _fraud_count().alias("actual_fraud_count"),
            _share(_fraud_count(), F.count("*")).alias("fraud_hit_rate_pct"),
        )
        .orderBy("prob_bucket")
    )


def fraud_rate_heatmap(features: DataFrame) -> DataFrame:
    return (
        features.groupBy("type", daypart(F.col("step")).alias("time_of_day"))
        .agg(
            F.count("*").alias("transaction_count"),
            _fraud_count().alias("fraud_count"),
            _share(_fraud_count(), F.count("*"), digits=4).alias("fraud_rate_pct"),
        )
        .orderBy(F.col("fraud_rate_pct").desc(), "type", "time_of_day")
    )


def amount_vs_score(predictions: DataFrame, above: float = 0.1, n: int = 5000) -> DataFrame:
    """The n highest scored rows above a score, as points of a scatter chart."""
    return (
        predictions.where(F.col("fraud_probability") > above)
        .orderBy(*by_score(predictions))
        .limit(n)
        .select(
            "type",
            F.round("amount", 2).alias("amount"),
            F.round("fraud_probability", 4).alias("fraud_probability"),
            "risk_level",
            F.col("isFraud").alias("actual_fraud_label"),
        )
    )
