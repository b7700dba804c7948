"""One key, account, amount or score holds a third of all rows: results stay whole."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from txnrisk.operators import cleaning, dashboards, quality, scoring
from txnrisk.operators.evaluation import evaluate_classifier
from txnrisk.operators.features import build_features
from txnrisk.operators.quantiles import exact_quantile
from txnrisk.values import TRANSACTION_KEY

ROWS = 9000


@pytest.fixture(scope="module")
def raw(spark):
    """A third of the rows are one transaction with changing balances, the rest are spread."""
    i = F.col("id")
    hot = i % 3 == 0

    def spread(column, other):
        return F.when(hot, F.lit(other)).otherwise(column)

    return spark.range(0, ROWS, 1, 8).select(
        spread(i % 700, 7).cast("bigint").alias("step"),
        F.when(i % 3000 == 0, "BAD_TYPE").otherwise("TRANSFER").alias("type"),
        spread((i % 997) / 4.0 + 1, 147.42).cast("double").alias("amount"),
        spread(F.concat(F.lit("C"), (i % 50).cast("string")), "C0").alias("nameOrig"),
        (i % 113).cast("double").alias("oldbalanceOrg"),
        (i % 7).cast("double").alias("newbalanceOrig"),
        spread(F.concat(F.lit("M"), (i % 89).cast("string")), "M0").alias("nameDest"),
        F.lit(5.0).alias("oldbalanceDest"),
        (i % 2 + 5.0).cast("double").alias("newbalanceDest"),
        (i % 10 == 0).cast("bigint").alias("isFraud"),
        F.lit(0).cast("bigint").alias("isFlaggedFraud"),
    )


def test_dedup_against_sorting_all_rows(raw):
    rows = raw.toPandas()
    order = [*TRANSACTION_KEY, *cleaning.SURVIVOR_ORDER]
    expected = rows.sort_values(order).groupby(list(TRANSACTION_KEY), as_index=False).first()
    found = cleaning.dedup_transactions(raw).toPandas()
    columns = list(rows.columns)
    pd.testing.assert_frame_equal(
        found[columns].sort_values(columns, ignore_index=True),
        expected[columns].sort_values(columns, ignore_index=True),
    )
    assert quality.dq_duplicates(raw).first().records_found == ROWS - len(expected)


@pytest.mark.parametrize("q, rank", [(0.05, 450), (0.5, 4500), (0.95, 8550), (1.0, 9000)])
def test_quantile_with_a_hot_value(raw, q, rank):
    found = exact_quantile(raw, "amount", q).first().threshold
    assert found == sorted(raw.toPandas().amount)[rank - 1]


def test_rejoin_of_a_hot_key_keeps_every_pair(spark, raw):
    features = build_features(raw.where("step = 7 and type = 'TRANSFER'").limit(300), 100.0)
    joined = scoring.rejoin_on_key(features.select(*scoring.REPORT_KEY, "isFraud"), features)
    counts = features.groupBy(*scoring.REPORT_KEY).count().toPandas()["count"]
    assert joined.count() == (counts**2).sum()


def test_hot_account(raw):
    alerts = raw.select(
        "nameOrig", "type", "amount", F.lit(0.9).alias("fraud_probability")
    )
    top = dashboards.top_risk_accounts(alerts).collect()
    by_name = raw.toPandas().groupby("nameOrig").size()
    assert top[0].nameOrig == "C0" and top[0].alert_count == by_name["C0"] >= ROWS / 3
    assert top[0].transaction_types == ["BAD_TYPE", "TRANSFER"]
    assert [row.alert_count for row in top] == sorted(by_name, reverse=True)[:20]


def test_hot_score(raw):
    scored = raw.select(
        "isFraud",
        F.when(F.col("nameOrig") == "C0", 0.3).otherwise(F.rand(3)).alias("probability"),
    ).withColumn("predicted_isFraud", (F.col("probability") > 0.5).cast("bigint")).cache()
    rows = scored.toPandas()
    ranks = rows.probability.rank(method="average")
    positives, negatives = rows.isFraud.sum(), (1 - rows.isFraud).sum()
    won = ranks[rows.isFraud == 1].sum() - positives * (positives + 1) / 2
    found = evaluate_classifier(scored).first()
    assert found.roc_auc == pytest.approx(won / (positives * negatives), abs=1e-12)
    scored.unpersist()


def test_one_run_date_holds_all_rows(raw):
    predictions = raw.select(
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("prediction_date"),
        "amount",
        (F.col("isFraud")).alias("predicted_isFraud"),
        F.lit("HIGH").alias("risk_level"),
        F.lit(0.9).alias("fraud_probability"),
    )
    (row,) = scoring.daily_summaries(predictions, "m").collect()
    assert row.total_transactions == row.high_risk_count == ROWS
