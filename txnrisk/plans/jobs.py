"""The five batch jobs, each reading and writing the named tables.

Every job takes the time of its run, in the time zone of the session, so that it can be repeated
for a past day. Jobs that find their input empty return False and write nothing.
"""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txnrisk.operators import models, quality, scoring
from txnrisk.operators.cleaning import clean_and_count
from txnrisk.operators.evaluation import (
    compare_models,
    evaluate_classifier,
    evaluation_log_row,
    training_log_rows,
)
from txnrisk.operators.features import build_features, large_amount_threshold, stored_threshold
from txnrisk.sources.files import exists
from txnrisk.sources.tables import read_table, scratch, write_append, write_replace
from txnrisk.sources.transactions_csv import read_transactions_csv
from txnrisk.values import BOOSTED_TREE, DEFAULT_SPLIT_STEP, KMEANS, LOGISTIC, RANDOM_FOREST

TREE_TRAINERS = {
    BOOSTED_TREE: models.train_boosted_tree,
    RANDOM_FOREST: models.train_random_forest,
}


def _stamp(run_ts: dt.datetime) -> Column:
    """The run time as read by the session, whatever zone the driver's clock is in."""
    if run_ts.tzinfo is not None:
        raise ValueError("give the run time without a zone, in the session's zone")
    return F.to_timestamp(F.lit(run_ts.isoformat(sep=" ")))


def ingest(spark: SparkSession, csv_path: str, run_ts: dt.datetime) -> None:
    """Load the CSV over the raw table, check it, and log the load."""
    write_replace(read_transactions_csv(spark, csv_path), "raw.transactions")
    raw = read_table(spark, "raw.transactions")
    quality.gate_load(quality.load_stats(raw))
    log_row = quality.ingestion_log_row(raw, "raw.transactions", _stamp(run_ts))
    write_append(log_row, "raw.ingestion_log")


def preprocess(spark: SparkSession, run_ts: dt.datetime) -> DataFrame | bool:
    """Count and log bad rows, write the clean table, and return its counts.

    Rows are sorted by step inside each file: later steps then skip row groups when they read
    one side of the split, in this table and in the feature table made from it. The number of different
    keys is counted as the deduplicated rows pass by, so keys are shuffled once.
    """
    raw = read_table(spark, "raw.transactions")
    if not quality.gate_non_empty(raw):
        return False
    seen = Observation("deduplicated")
    clean = clean_and_count(raw, seen).sortWithinPartitions("step")
    write_replace(clean, "staging.transactions_clean")
    log_rows = quality.validation_log_rows(raw, _stamp(run_ts), seen.get["keys"])
    write_append(log_rows, "staging.validation_log")
    return quality.staging_check(read_table(spark, "staging.transactions_clean"))


def engineer_features(
    spark: SparkSession, run_ts: dt.datetime, threshold_method: str = "exact"
) -> DataFrame | bool:
    """Write the feature table, check it, log its counts, and return the newest log row."""
    clean = read_table(spark, "staging.transactions_clean")
    if not quality.gate_non_empty(clean):
        return False
    with scratch(spark):
        threshold = large_amount_threshold(clean, threshold_method)
        write_replace(build_features(clean, threshold), "features.transaction_features")
    features = read_table(spark, "features.transaction_features")
    quality.gate_features(quality.feature_checks(features))
    write_append(quality.feature_log_row(features, _stamp(run_ts)), "features.feature_log")
    return quality.latest_feature_log(read_table(spark, "features.feature_log"))


def train(
    spark: SparkSession,
    run_ts: dt.datetime,
    model_dir: str,
    split_step: int = DEFAULT_SPLIT_STEP,
    tree: str = BOOSTED_TREE,
) -> DataFrame | bool:
    """Fit, save and evaluate the models, log the run, and return the evaluation log by F1."""
    features = read_table(spark, "features.transaction_features")
    if not quality.gate_non_empty(features):
        return False
    training, evaluate = models.split_by_step(features, split_step)
    for name, trainer in ((LOGISTIC, models.train_logistic), (tree, TREE_TRAINERS[tree])):
        model = _saved(trainer(training), model_dir, name)
        metrics = evaluate_classifier(models.predict(model, evaluate))
        write_append(
            evaluation_log_row(metrics, name, _stamp(run_ts)), "ml_models.model_evaluation_log"
        )
    _saved(models.train_kmeans(training), model_dir, KMEANS)
    log_rows = training_log_rows(features, _stamp(run_ts), (LOGISTIC, tree, KMEANS), split_step)
    write_append(log_rows, "ml_models.training_log")
    return compare_models(read_table(spark, "ml_models.model_evaluation_log"))


def score_day(
    spark: SparkSession,
    run_ts: dt.datetime,
    model_dir: str,
    model_name: str = LOGISTIC,
    join_mode: str = "carry",
    write_mode: str = "replace_run_date",
) -> DataFrame | bool:
    """Score the window, write predictions, alerts and the summary, and return alert totals.

    ``join_mode="rejoin"`` joins scores and alerts back to the feature table on three columns
    and keeps the rows this multiplies. ``write_mode="append"`` keeps the rows of an earlier
    run on the same day, and the summary then counts both.
    """
    model = load_model(model_dir, model_name)
    if model is None:
        return False
    day, stamp = run_ts.date(), _stamp(run_ts)
    features = read_table(spark, "features.transaction_features")
    window = scoring.score_window(features)
    scored = models.predict(model, window)
    if join_mode == "carry":
        rows = scoring.fraud_predictions(scored, stamp)
    elif join_mode == "rejoin":
        rows = scoring.fraud_predictions_rejoined(scored, features, stamp)
    else:
        raise ValueError(f"unknown join mode {join_mode!r}")
    write = partial(write_append, mode=write_mode, run_date=day)
    write(rows, "reports.fraud_predictions", by="position")

    predictions = read_table(spark, "reports.fraud_predictions")
    if join_mode == "carry":
        alerts = scoring.high_risk_alerts(predictions, stored_threshold(window), stamp, day)
    else:
        alerts = scoring.high_risk_alerts_rejoined(predictions, window, stamp, day)
    write(alerts, "reports.high_risk_alerts")
    summary = scoring.daily_summary(predictions, stamp, model_name, day)
    write(summary, "reports.daily_summary")
    return scoring.alert_totals(read_table(spark, "reports.high_risk_alerts"), day)


def _saved(model: PipelineModel, model_dir: str, name: str) -> PipelineModel:
    """The model as it was saved: without the training rows and the session that a fitted one holds on to."""
    model.write().overwrite().save(f"{model_dir}/{name}")
    return PipelineModel.load(f"{model_dir}/{name}")


def load_model(model_dir: str, name: str) -> PipelineModel | None:
    """A saved model, or None when there is none of that name. A damaged one is an error."""
    path = f"{model_dir}/{name}"
    return PipelineModel.load(path) if exists(SparkSession.active(), path) else None
