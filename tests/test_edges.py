"""Hand-made rows at the edges of every rule."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.rows import column, transactions
from txnrisk.functions import scoring as score
from txnrisk.functions.features import feature_columns
from txnrisk.operators import cleaning, dashboards, evaluation, models, quality, scoring
from txnrisk.operators.features import build_features, large_amount_threshold, stored_threshold
from txnrisk.operators.quantiles import exact_quantile


# ---------------------------------------------------------------- cleaning


def test_exact_copies_leave_one_row(spark):
    raw = transactions(spark, {}, {}, {})
    assert cleaning.clean_transactions(raw).count() == 1


def test_invalid_copy_that_sorts_first_takes_the_key_with_it(spark):
    raw = transactions(spark, {"type": "TRANSFER"}, {"type": "BAD_TYPE"})
    assert column(cleaning.dedup_transactions(raw), "type") == ["BAD_TYPE"]
    assert cleaning.clean_transactions(raw).count() == 0


def test_null_type_sorts_before_any_other(spark):
    raw = transactions(spark, {"type": "CASH_IN"}, {"type": None})
    assert column(cleaning.dedup_transactions(raw), "type") == [None]


def test_other_destination_is_another_transaction(spark):
    raw = transactions(spark, {}, {"nameDest": "M2"})
    assert cleaning.clean_transactions(raw).count() == 2


@pytest.mark.parametrize(
    "change",
    [{name: None} for name in ("amount", "nameOrig", "nameDest", "type")]
    + [{"amount": 0.0}, {"amount": -1.0}, {"amount": float("nan")}, {"type": "UNKNOWN"}],
)
def test_invalid_rows_are_removed(spark, change):
    assert cleaning.filter_valid(transactions(spark, change)).count() == 0


def test_null_keys_survive_dedup_once_but_count_as_duplicates(spark):
    raw = transactions(spark, {"nameOrig": None}, {"nameOrig": None}, {})
    assert cleaning.dedup_transactions(raw).count() == 2
    assert column(quality.dq_duplicates(raw), "records_found") == [2]


# ---------------------------------------------------------------- quality


def test_checks(spark):
    raw = transactions(
        spark,
        {},
        {},
        {"amount": None},
        {"amount": 0.0},
        {"amount": -1.0},
        {"type": "TRANSFER", "amount": 102.0, "oldbalanceOrg": 101.0},
        {"type": "TRANSFER", "amount": 102.01, "oldbalanceOrg": 101.0},
        {"type": "CASH_OUT", "amount": 5.0, "oldbalanceOrg": 0.0},
    )
    rows = quality.validation_log_rows(raw, F.lit(dt.date(2024, 1, 1))).collect()
    assert {row.check_name: row.records_found for row in rows} == {
        "null_amount_records": 1,
        "negative_amount_records": 2,
        "duplicate_records": 2,
        "impossible_balance": 1,
    }


def test_empty_table(spark):
    raw = transactions(spark, {}).where("false")
    assert not quality.gate_non_empty(raw)
    assert tuple(quality.load_stats(raw).first()) == (0, 0, 0.0)
    with pytest.raises(quality.GateError):
        quality.gate_load(quality.load_stats(raw))
    checks = quality.validation_log_rows(raw, F.lit(dt.date(2024, 1, 1)))
    assert column(checks, "records_found") == [0, 0, 0, 0]
    assert large_amount_threshold(raw).first().threshold is None
    assert build_features(raw).count() == 0


def test_fraud_share_gate_is_strict(spark):
    def loaded(fraud, total):
        return spark.range(total).select((F.col("id") < fraud).cast("bigint").alias("isFraud"))

    quality.gate_load(quality.load_stats(loaded(10, 100)))
    with pytest.raises(quality.GateError):
        quality.gate_load(quality.load_stats(loaded(101, 1000)))


@pytest.mark.parametrize(
    "change, broken",
    [
        ({"oldbalanceOrg": -2.0}, "negative_ratio"),
        ({"type": "OTHER"}, "invalid_type"),
        ({"step": -1}, "hour_range"),
    ],
)
def test_feature_gate(spark, change, broken):
    checks = quality.feature_checks(build_features(transactions(spark, {}, change), 50.0))
    assert {r.check_name: r.records_found for r in checks.collect() if r.records_found} == {broken: 1}
    with pytest.raises(quality.GateError, match=broken):
        quality.gate_features(checks)


def test_feature_gate_passes_clean_rows(spark):
    quality.gate_features(quality.feature_checks(build_features(transactions(spark, {}), 50.0)))


# ---------------------------------------------------------------- features


def test_features_of_one_row(spark):
    raw = transactions(
        spark, {"type": "CASH_OUT", "amount": 100.0, "newbalanceOrig": 0.0, "newbalanceDest": 0.0}
    )
    row = build_features(raw, 99.99).first().asDict()
    assert {name: row[name] for name in feature_columns(F.lit(0.0))} == {
        "balance_diff_orig": 0.0,
        "balance_diff_dest": -100.0,
        "orig_balance_zero_after": 1,
        "dest_balance_unchanged": 1,
        "amount_to_balance_ratio": 100.0 / 101.0,
        "is_large_transaction": 1,
        "hour_of_step": 1,
        "type_encoded": 3,
        "is_transfer_or_cashout": 1,
        "net_orig_change": 100.0,
        "net_dest_change": 0.0,
    }


def test_null_balances_give_null_amounts_and_zero_flags(spark):
    raw = transactions(
        spark, {name: None for name in ("oldbalanceOrg", "newbalanceOrig", "newbalanceDest")}
    )
    row = build_features(raw, 50.0).first()
    assert row.balance_diff_orig is None and row.amount_to_balance_ratio is None
    assert (row.orig_balance_zero_after, row.dest_balance_unchanged) == (0, 0)


def test_ratio_at_special_balances(spark):
    raw = transactions(spark, *[{"oldbalanceOrg": b} for b in (-1.0, 0.0, -2.0)])
    assert column(build_features(raw, 50.0), "amount_to_balance_ratio") == [None, 10.0, -10.0]


def test_large_means_strictly_above_the_threshold(spark):
    raw = transactions(spark, *[{"amount": a} for a in (49.99, 50.0, 50.01)])
    features = build_features(raw, 50.0)
    assert column(features, "is_large_transaction") == [0, 0, 1]
    again = build_features(raw, stored_threshold(features))
    assert column(again, "is_large_transaction") == [0, 0, 1]


def test_stored_threshold_when_all_rows_are_large(spark):
    raw = transactions(spark, {"amount": 60.0}, {"amount": 70.0})
    again = build_features(raw, stored_threshold(build_features(raw, 50.0)))
    assert column(again, "is_large_transaction") == [1, 1]


@pytest.mark.parametrize("step, hour", [(0, 0), (23, 23), (24, 0), (100, 4), (601, 1), (-1, -1)])
def test_hour_of_step(spark, step, hour):
    assert column(build_features(transactions(spark, {"step": step}), 50.0), "hour_of_step") == [hour]


amounts = st.one_of(
    st.integers(-500, 500).map(float),
    st.floats(allow_nan=False, allow_infinity=False, width=32),
    st.sampled_from([0.0, 7.0, 147.42]),
)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(amounts, min_size=1, max_size=60), percent=st.integers(1, 100))
def test_exact_quantile_against_sorting(spark, values, percent):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "amount double")
    rank = -(-percent * len(values) // 100)
    found = exact_quantile(df, "amount", percent / 100).first().threshold
    assert found == sorted(values)[rank - 1]


def test_approximate_threshold_is_close_in_rank(spark):
    df = spark.range(10000).select((F.col("id") / 7.0).alias("amount"))
    found = large_amount_threshold(df, "approx").first().threshold
    assert abs(found * 7.0 - 9500) <= 2
    with pytest.raises(ValueError):
        large_amount_threshold(df, "guess")


# ---------------------------------------------------------------- scores


def test_levels_use_the_unrounded_probability(spark):
    df = spark.createDataFrame(
        [(0.2,), (0.4,), (0.39999,), (0.7,), (0.69996,), (None,)], "p double"
    ).select(
        score.risk_level(F.col("p")).alias("level"),
        score.reported_probability(F.col("p")).alias("stored"),
    )
    assert [tuple(row) for row in df.collect()] == [
        ("LOW", 0.2),
        ("MEDIUM", 0.4),
        ("LOW", 0.4),
        ("HIGH", 0.7),
        ("MEDIUM", 0.7),
        ("LOW", None),
    ]


def test_score_buckets(spark):
    df = spark.createDataFrame([(p,) for p in (0.0, 0.2, 0.4, 0.6, 0.8, None)], "p double")
    assert column(df.select(score.score_bucket(F.col("p")).alias("b")), "b") == [
        "0.0 – 0.2",
        "0.2 – 0.4",
        "0.4 – 0.6",
        "0.6 – 0.8",
        "0.8 – 1.0",
        "0.8 – 1.0",
    ]


def test_dayparts(spark):
    df = spark.createDataFrame([(s,) for s in (0, 5, 6, 11, 12, 17, 18, 23, 24, -1, None)], "s bigint")
    names = column(df.select(score.daypart(F.col("s")).alias("d")), "d")
    assert [name.split()[0] for name in names] == (
        ["Night"] * 2 + ["Morning"] * 2 + ["Afternoon"] * 2 + ["Evening"] * 2
        + ["Night", "Evening", "Evening"]
    )


def test_probability_is_found_by_label_not_position(spark):
    schema = "probs array<struct<label:bigint,prob:double>>"
    df = spark.createDataFrame([([(1, 0.9), (0, 0.1)],), ([(0, 0.8), (1, 0.2)],)], schema)
    assert column(df.select(score.class_probability(F.col("probs")).alias("p")), "p") == [0.9, 0.2]


def test_reason_is_the_first_that_holds(spark):
    flags = [(1, 1, 1, 1), (0, 1, 1, 1), (0, 0, 1, 1), (0, 0, 0, 1), (0, 0, 0, 0)]
    df = spark.createDataFrame(flags, "a int, b int, c int, d int")
    reason = score.top_reason(*[F.col(c) for c in df.columns])
    assert column(df.select(reason.alias("r")), "r") == [
        "Account drained to zero",
        "Destination balance unchanged",
        "Large transaction amount",
        "High-risk transaction type",
        "Multiple fraud signals detected",
    ]


def _scored(spark, *rows):
    return spark.createDataFrame(rows, "isFraud bigint, predicted_isFraud bigint, probability double")


def test_metrics_without_predicted_positives(spark):
    row = evaluation.evaluate_classifier(_scored(spark, (1, 0, 0.3), (0, 0, 0.1))).first()
    assert (row.precision, row.recall, row.f1_score, row.roc_auc) == (None, 0.0, 0.0, 1.0)


def test_metrics_of_one_class(spark):
    row = evaluation.evaluate_classifier(_scored(spark, (0, 0, 0.3), (0, 1, 0.6))).first()
    assert (row.precision, row.recall, row.roc_auc) == (0.0, None, None)


def test_tied_scores_count_half(spark):
    row = evaluation.evaluate_classifier(
        _scored(spark, (1, 1, 0.6), (0, 1, 0.6), (0, 1, 0.6), (1, 1, 0.6))
    ).first()
    assert row.roc_auc == 0.5


def test_log_loss_of_a_sure_and_wrong_score_is_finite(spark):
    scored = _scored(spark, (1, 0, 0.0), (0, 1, 1.0))
    loss = evaluation.evaluate_classifier(scored, clamp=0.0001).first().log_loss
    assert abs(loss - 9.21034) < 1e-4


def test_nearest_centroid_and_ties(spark):
    df = spark.createDataFrame([(0.0, 0.0), (4.0, 3.0), (1.0, 0.0)], "x double, y double")
    rows = models.kmeans_assign(df, [(0, 0), (2, 0), (4, 0)], ("x", "y")).collect()
    assert [(r.centroid_id, r.centroid_distance) for r in rows] == [(1, 0.0), (3, 3.0), (1, 1.0)]
    assert rows[0].asDict().keys() == {"x", "y", "centroid_id", "centroid_distance"}


def test_weights_are_ordered_by_size(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", -3.0), ("c", 2.0), ("d", -2.0)], "feature string, weight double")
    assert column(models.largest_weights(df, 3), "feature") == ["b", "c", "d"]


# ---------------------------------------------------------------- reports


def test_no_alerts_total_zero(spark):
    alerts = spark.createDataFrame([], "alert_date timestamp, risk_level string, amount double")
    assert tuple(scoring.alert_totals(alerts, dt.date(2024, 1, 1)).first()) == (0, 0.0)


def test_filters(spark):
    rows = [(dt.datetime(2024, 1, d, 23, 59), level) for d, level in ((1, "HIGH"), (2, "LOW"), (3, "HIGH"))]
    df = spark.createDataFrame(rows, "alert_date timestamp, risk_level string")
    day = lambda d: dt.date(2024, 1, d)
    assert dashboards.filter_date_range(df, "alert_date", day(2), day(3)).count() == 2
    assert dashboards.filter_date_range(df, "alert_date", None, day(1)).count() == 1
    assert dashboards.filter_date_range(df, "alert_date", None, None).count() == 3
    assert dashboards.filter_dropdown(df, risk_level=["HIGH"]).count() == 2
    assert dashboards.filter_dropdown(df, risk_level=None).count() == 3
    assert dashboards.filter_dropdown(df, risk_level=["MEDIUM"]).count() == 0


def test_latest_metrics_may_be_of_one_model(spark):
    schema = "run_date date, model_name string, f1_score double, precision double, recall double, roc_auc double"
    log = spark.createDataFrame(
        [(dt.date(2024, 1, d), m, 0.5, 0.5, 0.5, 0.5) for d, m in ((1, "a"), (2, "b"), (2, "c"))], schema
    )
    assert dashboards.latest_model_metrics(log).first().model_name == "b"
    assert dashboards.latest_model_metrics(log, "a").first().model_name == "a"
