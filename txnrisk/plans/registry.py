"""Every operator as a query over one folder of benchmark tables.

Dates are returned as dates, so that the result does not depend on a time zone.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.functions import scoring as score
from txnrisk.functions.features import feature_columns
from txnrisk.operators import cleaning, dashboards, evaluation, models, quality, scoring
from txnrisk.operators.features import large_amount_threshold, threshold_column
from txnrisk.operators.certificates import boosting_step, lloyd_step, logistic_gradient
from txnrisk.plans.tables import AS_OF, LOG_LOSS_CLAMP, RunTables, fixed_models, run_ts
from txnrisk.plans.trial_tables import TRIALS
from txnrisk.sources.tables import materialize, shared_dir
from txnrisk.sources.transactions_csv import read_transactions_csv
from txnrisk.values import (
    BOOSTED_TREE,
    CLASS_WEIGHTS,
    CLASSIFIER_FEATURES,
    HIGH,
    JOB_SPLIT_STEP,
    KMEANS,
    LOGISTIC,
    RANDOM_FOREST,
    RISKY_TYPES,
    TRANSACTION_KEY,
)

# A slope or a shift below this is none; both are free of units.
FLAT = 1e-6

Query = Callable[[RunTables], DataFrame]

# A week of the replayed history, for the date control of the dashboards.
RANGE = (dt.date(2024, 1, 27), dt.date(2024, 1, 29))

# Eight centroids in the units of the seven cluster features, in their order:
# two balance gaps, the ratio, and four flags.
CENTROIDS = (
    (0.0, 0.0, 0.5, 0, 0, 0, 0),
    (0.0, 0.0, 0.5, 0, 0, 0, 1),
    (0.0, -50.0, 1.0, 0, 1, 0, 0),
    (0.0, -50.0, 1.0, 0, 1, 0, 1),
    (-50.0, 0.0, 20.0, 0, 0, 0, 0),
    (-20.0, 0.0, 5.0, 1, 0, 0, 1),
    (-200.0, 0.0, 10.0, 1, 0, 1, 1),
    (-200.0, -200.0, 100.0, 0, 1, 1, 0),
)

SOURCES: dict[str, Query] = {
    "read_transactions_csv": lambda t: _through_csv(t),
}

CHECKS: dict[str, Query] = {
    "ingestion_log_row": lambda t: quality.ingestion_log_row(t.raw, "raw.transactions", _today()),
    "load_stats": lambda t: quality.load_stats(t.raw),
    "dq_null_keys": lambda t: quality.dq_null_keys(t.raw),
    "dq_non_positive_amount": lambda t: quality.dq_non_positive_amount(t.raw),
    "dq_duplicates": lambda t: quality.dq_duplicates(t.raw),
    "dq_impossible_balance": lambda t: quality.dq_impossible_balance(t.raw),
    "validation_log_rows": lambda t: quality.validation_log_rows(t.raw, _today()),
    "staging_check": lambda t: quality.staging_check(t.clean),
    "feature_checks": lambda t: quality.feature_checks(t.features),
}

CLEANING: dict[str, Query] = {
    "dedup_transactions": lambda t: cleaning.dedup_transactions(t.raw),
    "filter_valid": lambda t: cleaning.filter_valid(t.raw),
    "clean_transactions": lambda t: t.clean,
}

FEATURES: dict[str, Query] = {
    "large_amount_threshold": lambda t: t.threshold,
    "large_amount_threshold_approx": lambda t: large_amount_threshold(t.clean, method="approx"),
    "build_features": lambda t: t.features,
    "feature_verify": lambda t: quality.feature_verify(t.features),
    "feature_log_row": lambda t: quality.feature_log_row(t.features, _today()),
    "latest_feature_log": lambda t: quality.latest_feature_log(t.feature_log),
}

MODELS: dict[str, Query] = {
    "split_by_step": lambda t: _split(t),
    "split_by_step_100": lambda t: _split(t, JOB_SPLIT_STEP),
    "class_weights": lambda t: _class_weights(t),
    "train_logistic": lambda t: _optimality(t),
    "train_logistic_evaluated": lambda t: _trained(t, LOGISTIC, models.train_logistic),
    "train_boosted_tree": lambda t: _boosted(t),
    "train_boosted_tree_evaluated": lambda t: _trained(t, BOOSTED_TREE, models.train_boosted_tree),
    "train_random_forest": lambda t: _trained(t, RANDOM_FOREST, models.train_random_forest),
    "train_kmeans": lambda t: _fixed_point(t),
    "train_kmeans_clusters": lambda t: _clusters(t),
    "kmeans_assign": lambda t: _keyed(
        models.kmeans_assign(t.features, CENTROIDS),
        "centroid_id",
        F.round("centroid_distance", 4).alias("centroid_distance"),
    ),
    "evaluate_classifier": lambda t: _metrics(t),
    "predict": lambda t: _predicted_by_rows(t),
    "predict_trained": lambda t: _predicted(t),
    "score_linear": lambda t: _keyed(
        t.scored, "predicted_isFraud", F.round("probability", 4).alias("probability")
    ),
    "model_weights": lambda t: models.model_weights(fixed_models()[LOGISTIC]),
    "model_weights_trained": lambda t: models.model_weights(
        models.train_logistic(_stored_splits(t)[0])
    ),
    "global_explain": lambda t: _attributions(t, LOGISTIC),
    "global_explain_boosted": lambda t: _attributions(t, BOOSTED_TREE),
    "feature_importances": lambda t: models.feature_importances(
        models.train_boosted_tree(_stored_splits(t)[0])
    ),
    "evaluation_log_row": lambda t: evaluation.evaluation_log_row(
        evaluation.evaluate_classifier(t.scored, clamp=LOG_LOSS_CLAMP), LOGISTIC, _today()
    ),
    "training_log_rows": lambda t: evaluation.training_log_rows(t.clean, _today()),
    "compare_models": lambda t: evaluation.compare_models(t.evaluation_log),
}

SCORING: dict[str, Query] = {
    "score_window": lambda t: _keyed(scoring.score_window(t.features)),
    "fraud_probability": lambda t: _looked_up_probability(t),
    "risk_level": lambda t: _keyed(
        t.scored, score.risk_level(F.col("probability")).alias("risk_level")
    ),
    "fraud_predictions": lambda t: _dated(t.predictions, "prediction_date"),
    "fraud_predictions_rejoined": lambda t: _dated(
        scoring.fraud_predictions_rejoined(t.scored, t.features, run_ts()), "prediction_date"
    ),
    "rejoin_on_key": lambda t: scoring.rejoin_on_key(
        t.predictions.select(*TRANSACTION_KEY, "fraud_probability", "risk_level"),
        t.features,
    ),
    "top_reason": lambda t: _keyed(t.scored, score.top_reason_from_features().alias("top_reason")),
    "high_risk_alerts": lambda t: _dated(t.alerts, "alert_date"),
    "high_risk_alerts_rejoined": lambda t: _dated(
        scoring.high_risk_alerts_rejoined(t.predictions, t.features, run_ts(), AS_OF), "alert_date"
    ),
    "daily_summary": lambda t: scoring.daily_summary(t.predictions, _today(), LOGISTIC, AS_OF),
    "daily_summary_history": lambda t: t.past_summaries,
    "risk_level_hit_rate": lambda t: scoring.risk_level_hit_rate(t.predictions, AS_OF),
    "top_risk_transactions": lambda t: scoring.top_risk_transactions(t.predictions, AS_OF),
    "prediction_count": lambda t: scoring.prediction_count(t.predictions, AS_OF),
    "alert_totals": lambda t: scoring.alert_totals(t.alerts, AS_OF),
}

DASHBOARDS: dict[str, Query] = {
    "kpi_total_transactions": lambda t: dashboards.kpi_total_transactions(t.past_summaries, AS_OF),
    "kpi_high_risk": lambda t: dashboards.kpi_high_risk(t.past_summaries, AS_OF),
    "kpi_amount_at_risk": lambda t: dashboards.kpi_amount_at_risk(t.past_summaries, AS_OF),
    "kpi_avg_score": lambda t: dashboards.kpi_avg_score(t.past_summaries, AS_OF),
    "daily_risk_trend": lambda t: dashboards.daily_risk_trend(t.past_summaries),
    "risk_distribution": lambda t: dashboards.risk_distribution(t.past_predictions),
    "fraud_by_type": lambda t: dashboards.fraud_by_type(t.past_predictions),
    "alert_queue": lambda t: dashboards.alert_queue(t.past_alerts),
    "alerts_by_status": lambda t: dashboards.alerts_by_status(t.past_alerts),
    "top_alert_reasons": lambda t: dashboards.top_alert_reasons(t.past_alerts),
    "alerts_by_type": lambda t: dashboards.alerts_by_type(t.past_alerts),
    "alerts_by_hour": lambda t: dashboards.alerts_by_hour(t.past_alerts),
    "top_risk_accounts": lambda t: _types_as_text(dashboards.top_risk_accounts(t.past_alerts)),
    "latest_model_metrics": lambda t: dashboards.latest_model_metrics(t.evaluation_log),
    "model_history": lambda t: dashboards.model_history(t.evaluation_log),
    "model_comparison": lambda t: dashboards.model_comparison(t.evaluation_log),
    "training_volume": lambda t: dashboards.training_volume(t.training_log),
    "score_histogram": lambda t: dashboards.score_histogram(t.past_predictions),
    "fraud_rate_heatmap": lambda t: dashboards.fraud_rate_heatmap(t.clean),
    "amount_vs_score": lambda t: dashboards.amount_vs_score(t.past_predictions),
    "filter_date_range": lambda t: dashboards.alerts_by_type(
        dashboards.filter_date_range(t.past_alerts, "alert_date", *RANGE)
    ),
    "filter_date_range_summary": lambda t: dashboards.daily_risk_trend(
        dashboards.filter_date_range(t.past_summaries, "summary_date", *RANGE)
    ),
    "filter_dropdown": lambda t: dashboards.alerts_by_status(
        dashboards.filter_dropdown(
            t.past_alerts, risk_level=[HIGH], type=RISKY_TYPES, alert_status=None
        )
    ),
}


def _today() -> Column:
    return F.lit(AS_OF)


def _keyed(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select(*TRANSACTION_KEY, *columns)


def _dated(df: DataFrame, timestamp: str) -> DataFrame:
    return df.withColumn(timestamp, F.to_date(timestamp))


def _through_csv(t: RunTables) -> DataFrame:
    """The raw transactions after a trip through CSV files in the shared folder."""
    path = f"{shared_dir(t.spark)}/transactions-{uuid.uuid4().hex}"
    t.raw.write.csv(path, header=True)
    return read_transactions_csv(t.spark, path)


def _one_feature(name: str) -> Query:
    """A feature worked out on the cleaned rows, next to the row key."""

    def query(t: RunTables) -> DataFrame:
        return _keyed(t.clean, feature_columns(threshold_column(t.threshold))[name].alias(name))

    return query


def _split(t: RunTables, split_step: int | None = None) -> DataFrame:
    """Both sides of the split with their name."""
    args = () if split_step is None else (split_step,)
    train, evaluate = models.split_by_step(t.clean, *args)
    return _keyed(train, F.lit("train").alias("split")).unionByName(
        _keyed(evaluate, F.lit("eval").alias("split"))
    )


def _class_weights(t: RunTables) -> DataFrame:
    train, _ = models.split_by_step(t.clean)
    explicit = models.class_weights(train, CLASS_WEIGHTS, "explicit_weight")
    return _keyed(
        models.class_weights(explicit, "auto", "auto_weight"),
        "isFraud",
        "explicit_weight",
        F.round("auto_weight", 6).alias("auto_weight"),
    )


def _metrics(t: RunTables) -> DataFrame:
    metrics = evaluation.evaluate_classifier(t.scored, clamp=LOG_LOSS_CLAMP)
    return metrics.select(*[F.round(c, 4).alias(c) for c in metrics.columns])


def _looked_up_probability(t: RunTables) -> DataFrame:
    """The fraud probability found by label in class probabilities sorted by size."""

    def entry(label: int, probability: Column) -> Column:
        return F.struct(probability.alias("prob"), F.lit(label).cast("bigint").alias("label"))

    p = F.col("probability")
    by_size = F.sort_array(F.array(entry(0, 1 - p), entry(1, p)), asc=False)
    probs = F.transform(by_size, lambda e: F.struct(e.label.alias("label"), e.prob.alias("prob")))
    return _keyed(
        t.scored.withColumn("probs", probs),
        score.reported_probability(score.class_probability(F.col("probs"))).alias(
            "fraud_probability"
        ),
    )


def _types_as_text(accounts: DataFrame) -> DataFrame:
    return accounts.withColumn("transaction_types", F.array_join("transaction_types", ","))


def _stored_splits(t: RunTables) -> tuple[DataFrame, DataFrame]:
    """Both sides of the split, read from a stored feature table as training does."""
    return models.split_by_step(materialize(t.features, "transaction_features"))


def _trained(
    t: RunTables, name: str, train: Callable[[DataFrame], PipelineModel]
) -> DataFrame:
    """Fit on the training side and return the log row of the evaluation side."""
    training, evaluate = _stored_splits(t)
    scored = models.predict(train(training), evaluate)
    return evaluation.evaluation_log_row(evaluation.evaluate_classifier(scored), name, _today())


def _clusters(t: RunTables) -> DataFrame:
    """Fit k-means on the training side and count the rows and fraud of each cluster."""
    training, _ = _stored_splits(t)
    assigned = models.assign_clusters(models.train_kmeans(training), training)
    return assigned.groupBy(F.lit(KMEANS).alias("model_name"), "centroid_id").agg(
        F.count("*").alias("rows"), F.sum("isFraud").alias("fraud_rows")
    )


def _predicted(t: RunTables) -> DataFrame:
    training, evaluate = _stored_splits(t)
    scored = models.predict(models.train_logistic(training), evaluate)
    return _keyed(scored, "predicted_isFraud", F.round("probability", 4).alias("probability"))


def _predicted_by_rows(t: RunTables) -> DataFrame:
    """Scores of the evaluation side by a given model of each kind."""
    _, evaluate = models.split_by_step(t.features)
    found = None
    for name, rows in fixed_models().items():
        scored = models.predict(rows, evaluate)
        one = _keyed(scored, F.lit(name).alias("model_name"), "predicted_isFraud", F.round("probability", 4).alias("probability"))
        found = one if found is None else found.unionByName(one)
    return found


def _row_name() -> Column:
    """The transaction key as text, with the amount in whole cents."""
    cents = F.round(F.col("amount") * 100).cast("bigint")
    return F.concat_ws("|", F.col("step").cast("string"), "nameOrig", cents.cast("string"), "nameDest")


def _attributions(t: RunTables, name: str) -> DataFrame:
    """Attributions of a given model on the evaluation side."""
    _, evaluate = models.split_by_step(t.features)
    found = models.global_explain(fixed_models()[name], evaluate, _row_name(), clamp=LOG_LOSS_CLAMP)
    return found.select("feature", F.round("attribution", 6).alias("attribution"))


def _optimality(t: RunTables) -> DataFrame:
    """Whether the weighted loss of the logistic model, fitted on the training side, is flat along each weight."""
    training, _ = _stored_splits(t)
    gradient = logistic_gradient(models.train_logistic(training), training)
    return gradient.select("feature", "rows", (F.abs("gradient") < FLAT).alias("optimal"))


def _boosted(t: RunTables) -> DataFrame:
    """Whether every leaf of the boosted trees, fitted on the training side, is the mean it must be."""
    training, _ = _stored_splits(t)
    leaves = boosting_step(models.train_boosted_tree(training), training)
    settled = leaves.agg((F.max("gap") < FLAT).alias("settled")).scalar()
    return training.agg(F.count("*").alias("rows")).select(F.lit(BOOSTED_TREE).alias("model_name"), "rows", settled.alias("settled"))


def _fixed_point(t: RunTables) -> DataFrame:
    """Whether the centres of k-means, fitted on the training side, are the means of their rows."""
    training, _ = _stored_splits(t)
    step = lloyd_step(models.train_kmeans(training, iterations=500, tolerance=0.0), training)
    return step.agg(
        F.count("*").alias("clusters"),
        F.sum("rows").alias("rows"),
        (F.max("shift") < FLAT).alias("settled"),
    ).select(F.lit(KMEANS).alias("model_name"), "*")


# The feature queries, named after the feature they add to the row key.
FEATURES.update({f"f_{name}": _one_feature(name) for name in CLASSIFIER_FEATURES})

ALL: dict[str, Query] = {
    **SOURCES,
    **CHECKS,
    **CLEANING,
    **FEATURES,
    **MODELS,
    **SCORING,
    **DASHBOARDS,
    **TRIALS,
}


def _bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: query(RunTables(spark, folder))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Each query as a function of a session and a folder of Parquet tables."""
    return {name: _bind(query) for name, query in ALL.items()}
