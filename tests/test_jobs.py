"""The five jobs in order, from a CSV file to the dashboards."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import MEDIUM
from txnrisk.operators import dashboards, quality
from txnrisk.plans import jobs
from txnrisk.plans.tables import RunTables
from txnrisk.sources.tables import drop_tables, ensure_tables, read_table
from txnrisk.values import BOOSTED_TREE, JOB_SPLIT_STEP, LOGGED_MODELS, LOGISTIC, RANDOM_FOREST

RUN = dt.datetime(2024, 1, 30, 6, 0)


def _fresh_tables(spark):
    drop_tables(spark)
    ensure_tables(spark)


@pytest.fixture(scope="module")
def model_dir(spark, tmp_path_factory):
    """Everything up to trained models, on the medium fixture."""
    folder = tmp_path_factory.mktemp("jobs")
    _fresh_tables(spark)
    RunTables(spark, MEDIUM).raw.write.csv(f"{folder}/csv", header=True)
    jobs.ingest(spark, f"{folder}/csv", RUN)
    assert jobs.preprocess(spark, RUN).first().clean_rows == 9712
    assert jobs.engineer_features(spark, RUN).first().large_txn_count == 485
    compared = jobs.train(spark, RUN, f"{folder}/models", tree=RANDOM_FOREST)
    assert {row.model_name for row in compared.collect()} == {LOGISTIC, RANDOM_FOREST}
    return f"{folder}/models"


def _count(spark, name):
    return read_table(spark, name).count()


def test_logs(spark, model_dir):
    assert read_table(spark, "raw.ingestion_log").first().row_count == 10292
    assert {r.check_name: r.records_found for r in read_table(spark, "staging.validation_log").collect()} == {
        "null_amount_records": 182,
        "negative_amount_records": 50,
        "duplicate_records": 334,
        "impossible_balance": 799,
    }
    training = read_table(spark, "ml_models.training_log").collect()
    assert len(training) == 3 and {(r.training_rows, r.eval_rows) for r in training} == {(8099, 1613)}
    assert all(r.roc_auc > 0.9 for r in read_table(spark, "ml_models.model_evaluation_log").collect())


def test_preprocess_shuffles_keys_once(spark):
    """The counts of a run that deduplicates and counts in one pass are those of the separate checks."""
    from pyspark.sql import Observation

    from txnrisk.operators.cleaning import clean_and_count, clean_transactions
    from txnrisk.sources.tables import materialize

    raw = RunTables(spark, MEDIUM).raw
    raw = materialize(raw.unionByName(raw.limit(20).withColumn("step", F.lit(None).cast("bigint"))), "raw")
    seen = Observation("keys")
    clean = clean_and_count(raw, seen)
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    clean = materialize(clean, "clean")
    assert clean.exceptAll(clean_transactions(raw)).count() == 0
    assert clean.count() == clean_transactions(raw).count()
    log_rows = quality.validation_log_rows(raw, F.current_date(), seen.get["keys"])
    assert "Exchange hash" not in log_rows._jdf.queryExecution().executedPlan().toString()
    assert log_rows.collect() == quality.validation_log_rows(raw, F.current_date()).collect()


def test_only_a_missing_model_is_none(spark, model_dir):
    assert jobs.load_model(model_dir, "no_such_model") is None
    import shutil

    shutil.copytree(f"{model_dir}/{LOGISTIC}/metadata", f"{model_dir}/damaged/metadata")
    with pytest.raises(Exception):
        jobs.load_model(model_dir, "damaged")


def test_scoring_twice_leaves_one_copy(spark, model_dir):
    for _ in range(2):
        totals = jobs.score_day(spark, RUN, model_dir).first()
    assert _count(spark, "reports.fraud_predictions") == 1613
    summary = read_table(spark, "reports.daily_summary")
    assert summary.count() == 1
    row = summary.first()
    assert (row.total_transactions, row.high_risk_count, row.model_used) == (
        1613,
        totals.high_risk,
        LOGISTIC,
    )
    assert _count(spark, "reports.high_risk_alerts") == totals.high_risk > 0
    kpi = dashboards.kpi_total_transactions(summary, RUN.date()).first()
    assert kpi.total_transactions == 1613
    assert dashboards.kpi_total_transactions(summary, dt.date(2024, 2, 1)).first()[0] is None


def test_reasons_do_not_need_the_feature_table(spark, model_dir):
    """The reason worked out from a prediction is the one its feature row gives."""
    jobs.score_day(spark, RUN, model_dir)
    alerts = read_table(spark, "reports.high_risk_alerts").drop("alert_date", "run_day")
    features = read_table(spark, "features.transaction_features")
    key = ["step", "nameOrig", "amount", "nameDest"]
    expected = alerts.drop("top_reason").join(
        features.selectExpr(
            *key,
            """case when orig_balance_zero_after = 1 then 'Account drained to zero'
                    when dest_balance_unchanged = 1 then 'Destination balance unchanged'
                    when is_large_transaction = 1 then 'Large transaction amount'
                    when is_transfer_or_cashout = 1 then 'High-risk transaction type'
                    else 'Multiple fraud signals detected' end as top_reason""",
        ),
        key,
    )
    assert alerts.exceptAll(expected.select(*alerts.columns)).count() == 0


def test_appending_runs_count_both(spark, model_dir):
    day = dt.datetime(2024, 2, 5, 6, 0)
    for expected in (1613, 2 * 1613):
        jobs.score_day(spark, day, model_dir, write_mode="append")
        summaries = read_table(spark, "reports.daily_summary").where("run_day = '2024-02-05'")
        assert max(r.total_transactions for r in summaries.collect()) == expected
    assert dashboards.kpi_total_transactions(summaries, day.date()).first()[0] == 3 * 1613


def test_rejoin_multiplies_rows(spark, model_dir):
    day = dt.datetime(2024, 2, 6, 6, 0)
    jobs.score_day(spark, day, model_dir, RANDOM_FOREST, join_mode="rejoin")
    rows = read_table(spark, "reports.fraud_predictions").where("run_day = '2024-02-06'")
    assert rows.count() == 1645
    summary = read_table(spark, "reports.daily_summary").where("run_day = '2024-02-06'").first()
    assert (summary.total_transactions, summary.model_used) == (1645, RANDOM_FOREST)


def test_missing_model_stops_the_day(spark, model_dir):
    before = _count(spark, "reports.fraud_predictions")
    assert jobs.score_day(spark, RUN, model_dir, BOOSTED_TREE) is False
    assert _count(spark, "reports.fraud_predictions") == before


def test_training_with_the_other_split_and_boosted_trees(spark, model_dir):
    day = dt.datetime(2024, 2, 7, 6, 0)
    compared = jobs.train(spark, day, model_dir, split_step=JOB_SPLIT_STEP)
    assert BOOSTED_TREE in {row.model_name for row in compared.collect()}
    logged = read_table(spark, "ml_models.training_log").where("run_date > '2024-02-01'").collect()
    assert {row.model_name for row in logged} == set(LOGGED_MODELS)
    assert {(row.training_rows, row.eval_rows) for row in logged} == {(1381, 9712 - 1381)}
    newest = dashboards.latest_model_metrics(read_table(spark, "ml_models.model_evaluation_log"))
    assert newest.first().model_name == BOOSTED_TREE and newest.first().roc_auc > 0.9


def test_clean_files_are_sorted_by_step(spark, model_dir):
    for path in read_table(spark, "staging.transactions_clean").inputFiles():
        steps = [row.step for row in spark.read.parquet(path).select("step").collect()]
        assert steps == sorted(steps)


def test_unknown_join_mode(spark, model_dir):
    with pytest.raises(ValueError):
        jobs.score_day(spark, RUN, model_dir, join_mode="outer")


def test_date_filter_reads_one_day_of_files(spark, model_dir):
    from txnrisk.operators.scoring import prediction_count

    jobs.score_day(spark, dt.datetime(2024, 3, 1, 6, 0), model_dir)
    counted = prediction_count(read_table(spark, "reports.fraud_predictions"), dt.date(2024, 3, 1))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_day" in plan
    assert counted.first().prediction_count == 1613


def test_empty_tables_stop_each_job(spark, model_dir):
    saved = read_table(spark, "features.transaction_features").collect()
    _fresh_tables(spark)
    assert jobs.preprocess(spark, RUN) is False
    assert jobs.engineer_features(spark, RUN) is False
    assert jobs.train(spark, RUN, model_dir) is False
    assert saved


def test_empty_load_fails(spark, model_dir, tmp_path):
    (tmp_path / "empty.csv").write_text("step,type\n")
    with pytest.raises(quality.GateError):
        jobs.ingest(spark, str(tmp_path / "empty.csv"), RUN)
