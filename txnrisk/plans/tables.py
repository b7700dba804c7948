"""The tables of a run over one folder of benchmark data, as lazy frames.

Scores come from two fixed sets of logistic weights, so that every table below has one right
content. The run tables hold a single run that scores everything after the split step; the
history tables replay one run a day, with the run date worked out from the step.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.functions.features import flag
from txnrisk.functions.scoring import linear_probability
from txnrisk.operators.cleaning import clean_transactions
from txnrisk.operators.evaluation import evaluate_classifier, evaluation_log_row, per_model
from txnrisk.operators.features import build_features, large_amount_threshold
from txnrisk.operators.model_rows import BOOSTED, FOREST, INTERCEPT, LINEAR, ModelRows, Node, Weight
from txnrisk.operators.quality import feature_log_rows
from txnrisk.operators.scoring import (
    daily_summaries,
    fraud_predictions,
    high_risk_alerts,
    score_linear,
    score_window,
)
from txnrisk.sources.events import raw_transactions, read_events
from txnrisk.values import (
    BOOSTED_TREE,
    DECISION_THRESHOLD,
    DEFAULT_SPLIT_STEP,
    LOGGED_MODELS,
    LOGISTIC,
    RANDOM_FOREST,
    RUN_STATUS,
)

# The run of the run tables and the day the dashboards look at.
RUN_TIME = "2024-01-30 06:00:00"
AS_OF = dt.date(2024, 1, 30)
HISTORY_START = "2024-01-01 00:00:00"

# Intercept and weights of the two exact models, in the order of summation.
MODEL_A = (
    -4.0,
    (
        ("orig_balance_zero_after", 2.5),
        ("dest_balance_unchanged", 1.0),
        ("is_transfer_or_cashout", 1.5),
        ("is_large_transaction", 1.2),
        ("amount_to_balance_ratio", 0.05),
        ("balance_diff_orig", -0.002),
        ("hour_of_step", 0.01),
    ),
)
MODEL_B = (
    -3.0,
    (
        ("orig_balance_zero_after", 3.0),
        ("is_transfer_or_cashout", 2.0),
        ("dest_balance_unchanged", -0.5),
        ("type_encoded", 0.1),
    ),
)
LOG_LOSS_CLAMP = 0.0001

# The nodes of two small ensembles, as (tree, node, feature, threshold, left, right, value).
# A leaf of the forest has its share of fraud, one of the boosted trees what it adds to the sum.
FOREST_NODES = (
    (0, 0, "orig_balance_zero_after", 0.5, 1, 2, None),
    (0, 1, "balance_diff_orig", -100.0, 3, 4, None),
    (0, 2, "is_transfer_or_cashout", 0.5, 5, 6, None),
    (0, 3, None, None, None, None, 0.125),
    (0, 4, None, None, None, None, 0.03125),
    (0, 5, None, None, None, None, 0.25),
    (0, 6, None, None, None, None, 0.875),
    (1, 0, "type_encoded", 1.5, 1, 2, None),
    (1, 1, None, None, None, None, 0.0625),
    (1, 2, "type_encoded", 3.5, 3, 4, None),
    (1, 3, "amount_to_balance_ratio", 0.95, 5, 6, None),
    (1, 4, None, None, None, None, 0.1875),
    (1, 5, None, None, None, None, 0.3125),
    (1, 6, None, None, None, None, 0.9375),
    (2, 0, "hour_of_step", 11.0, 1, 2, None),
    (2, 1, None, None, None, None, 0.375),
    (2, 2, "net_dest_change", 0.0, 3, 4, None),
    (2, 3, None, None, None, None, 0.4375),
    (2, 4, None, None, None, None, 0.5),
)
BOOSTED_NODES = (
    (0, 0, "orig_balance_zero_after", 0.5, 1, 2, None),
    (0, 1, "net_orig_change", 60.0, 3, 4, None),
    (0, 2, "is_transfer_or_cashout", 0.5, 5, 6, None),
    (0, 3, None, None, None, None, -0.9375),
    (0, 4, None, None, None, None, -0.75),
    (0, 5, None, None, None, None, -0.5),
    (0, 6, None, None, None, None, 0.6875),
    (1, 0, "dest_balance_unchanged", 0.5, 1, 2, None),
    (1, 1, None, None, None, None, -0.0625),
    (1, 2, "is_large_transaction", 0.5, 3, 4, None),
    (1, 3, None, None, None, None, 0.09375),
    (1, 4, None, None, None, None, 0.21875),
    (2, 0, "balance_diff_dest", -50.0, 1, 2, None),
    (2, 1, None, None, None, None, 0.03125),
    (2, 2, None, None, None, None, -0.015625),
)


def fixed_models() -> dict[str, ModelRows]:
    """A model of each kind with given rows."""
    linear = ((INTERCEPT, MODEL_A[0]), *MODEL_A[1])
    return {
        LOGISTIC: ModelRows(LINEAR, tuple(Weight(*row) for row in linear)),
        RANDOM_FOREST: ModelRows(FOREST, tuple(Node(*row) for row in FOREST_NODES)),
        BOOSTED_TREE: ModelRows(BOOSTED, tuple(Node(*row) for row in BOOSTED_NODES)),
    }


def run_ts() -> Column:
    """The time of the single run, free of any time zone."""
    return F.lit(RUN_TIME).cast("timestamp_ntz")


def replay_time(step: Column) -> Column:
    """The hour an hour index stands for, free of any time zone."""
    start = F.lit(HISTORY_START).cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), (step - 1).cast("int"))


def replay_date(step: Column) -> Column:
    return F.to_date(replay_time(step))


class RunTables:
    """Lazy frames of every table, from raw transactions to reports."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    @cached_property
    def raw(self) -> DataFrame:
        return raw_transactions(read_events(self.spark, self.folder))

    @cached_property
    def clean(self) -> DataFrame:
        return clean_transactions(self.raw)

    @cached_property
    def threshold(self) -> DataFrame:
        return large_amount_threshold(self.clean)

    @cached_property
    def features(self) -> DataFrame:
        return build_features(self.clean, self.threshold)

    @cached_property
    def scored(self) -> DataFrame:
        return score_linear(score_window(self.features), *MODEL_A)

    @cached_property
    def predictions(self) -> DataFrame:
        return fraud_predictions(self.scored, run_ts())

    @cached_property
    def alerts(self) -> DataFrame:
        return high_risk_alerts(self.predictions, self.threshold, run_ts(), AS_OF)

    # -------------------------------------------------------- replayed history

    @cached_property
    def past_predictions(self) -> DataFrame:
        return fraud_predictions(self.scored, replay_time(F.col("step")))

    @cached_property
    def past_alerts(self) -> DataFrame:
        return high_risk_alerts(self.past_predictions, self.threshold, F.col("prediction_date"))

    @cached_property
    def past_summaries(self) -> DataFrame:
        return daily_summaries(self.past_predictions, LOGISTIC)

    @cached_property
    def feature_log(self) -> DataFrame:
        return feature_log_rows(self.features, replay_date(F.col("step")))

    @cached_property
    def evaluation_log(self) -> DataFrame:
        """Metrics of both exact models per run date; each row is scored by both at once."""
        scores = F.array(
            *[
                F.struct(F.lit(name).alias("model_name"), linear_probability(*model).alias("p"))
                for name, model in ((LOGISTIC, MODEL_A), (BOOSTED_TREE, MODEL_B))
            ]
        )
        scored = score_window(self.features).select(
            replay_date(F.col("step")).alias("run_date"), "isFraud", F.inline(scores)
        )
        metrics = evaluate_classifier(
            scored.withColumnRenamed("p", "probability").withColumn(
                "predicted_isFraud", flag(F.col("probability") > DECISION_THRESHOLD)
            ),
            by=["run_date", "model_name"],
            clamp=LOG_LOSS_CLAMP,
        )
        return evaluation_log_row(metrics, F.col("model_name"), F.col("run_date"))

    @cached_property
    def training_log(self) -> DataFrame:
        """Per run date and model: all training rows, and the rows evaluated that day."""
        step = F.col("step")
        training_rows = self.clean.agg(F.count_if(step <= DEFAULT_SPLIT_STEP)).scalar()
        per_day = (
            score_window(self.clean)
            .groupBy(replay_date(step).alias("run_date"))
            .agg(F.count("*").alias("eval_rows"))
        )
        return per_model(per_day, LOGGED_MODELS).select(
            "run_date",
            "model_name",
            training_rows.alias("training_rows"),
            "eval_rows",
            F.lit(DECISION_THRESHOLD).alias("threshold_used"),
            F.lit(RUN_STATUS).alias("status"),
        )
