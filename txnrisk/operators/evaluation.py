"""Classifier metrics and the evaluation and training logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.functions.exact import order_digits
from txnrisk.values import (
    DECISION_THRESHOLD,
    DEFAULT_SPLIT_STEP,
    LABEL,
    LOGGED_MODELS,
    RUN_STATUS,
)

#: Ranges per binade and cells per range, as powers of two.
RANGE_BITS = (9, 12)

METRICS = ("precision", "recall", "f1_score", "roc_auc", "log_loss")


def evaluate_classifier(
    scored: DataFrame, by: Sequence[str] = (), clamp: float = 1e-15
) -> DataFrame:
    """Precision, recall and F1 of the fraud class, ROC AUC and log loss, per ``by`` group.

    Rows are first counted per score, so no score is too frequent for one task. The AUC counts,
    for each fraud row, the other rows with a lower score, and half of those with the same. A prefix count: scores are
    put in order inside fine cells, the sums of cells inside ranges, and the sums of ranges by group, so an
    ordered sum sees one cell, one range or the ranges, and never all scores. A ratio with an empty denominator is null.
    """
    label = F.col(LABEL).cast("double")
    flagged = F.col("predicted_isFraud") == 1
    counted = (
        scored.where(F.col(LABEL).isNotNull() & F.col("probability").isNotNull())
        .groupBy(*by, "probability")
        .agg(
            F.sum(label).alias("pos"),
            F.sum(1.0 - label).alias("neg"),
            F.count_if(flagged & (F.col(LABEL) == 1)).cast("double").alias("hit"),
            F.count_if(flagged).cast("double").alias("flagged"),
        )
    )
    # Everything else is a matter of the score, so it is worked out once for each.
    p = F.least(F.greatest(F.col("probability"), F.lit(clamp)), F.lit(1.0 - clamp))
    loss = -(F.col("pos") * F.ln(p) + F.col("neg") * F.ln(F.lit(1.0) - p))
    coarse, fine = order_digits(F.col("probability"), RANGE_BITS)
    counted = counted.select(
        *by,
        "probability",
        coarse.alias("range"),
        fine.alias("cell"),
        (F.col("pos") + F.col("neg")).alias("n"),
        *("pos", "neg", "hit", "flagged"),
        loss.alias("loss"),
        (F.col("pos") * F.col("neg") / 2).alias("pairs_won"),
    )
    totals = ("n", "pos", "neg", "hit", "flagged", "loss", "pairs_won")
    for around, order in ((("range", "cell"), "probability"), (("range",), "cell"), ((), "range")):
        lower = Window.partitionBy(*by, *around).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        beaten = F.coalesce(F.sum("neg").over(lower), F.lit(0.0))
        counted = (
            counted.withColumn("pairs_won", F.col("pairs_won") + F.col("pos") * beaten)
            .groupBy(*by, *around)
            .agg(*[F.sum(c).alias(c) for c in totals])
        )
    hit, pos = F.col("hit"), F.col("pos")
    return counted.select(
        *by,
        F.try_divide(hit, F.col("flagged")).alias("precision"),
        F.try_divide(hit, pos).alias("recall"),
        F.try_divide(2 * hit, F.col("flagged") + pos).alias("f1_score"),
        F.try_divide(F.col("pairs_won"), pos * F.col("neg")).alias("roc_auc"),
        F.try_divide(F.col("loss"), F.col("n")).alias("log_loss"),
    )


def evaluation_log_row(metrics: DataFrame, model_name: str | Column, run_ts: Column) -> DataFrame:
    """Metrics rounded to four places as evaluation log rows."""
    name = F.lit(model_name) if isinstance(model_name, str) else model_name
    return metrics.select(
        run_ts.alias("run_date"),
        name.alias("model_name"),
        *[F.round(metric, 4).alias(metric) for metric in METRICS],
        F.lit(RUN_STATUS).alias("status"),
    )


def per_model(one_row: DataFrame, names: Sequence[str]) -> DataFrame:
    """Repeat each row once per model name."""
    return one_row.select(
        F.explode(F.array(*[F.lit(name) for name in names])).alias("model_name"), "*"
    )


def training_log_rows(
    features: DataFrame,
    run_ts: Column,
    names: Sequence[str] = LOGGED_MODELS,
    split_step: int = DEFAULT_SPLIT_STEP,
) -> DataFrame:
    """One row per model with the sizes of both sides of the split."""
    sizes = features.agg(
        F.count_if(F.col("step") <= split_step).alias("training_rows"),
        F.count_if(F.col("step") > split_step).alias("eval_rows"),
    )
    return per_model(sizes, names).select(
        run_ts.alias("run_date"),
        "model_name",
        "training_rows",
        "eval_rows",
        F.lit(DECISION_THRESHOLD).alias("threshold_used"),
        F.lit(RUN_STATUS).alias("status"),
    )


def compare_models(evaluation_log: DataFrame) -> DataFrame:
    return evaluation_log.select(
        "model_name", "precision", "recall", "f1_score", "roc_auc"
    ).orderBy(F.col("f1_score").desc_nulls_last(), "model_name")
