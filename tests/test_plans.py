"""The physical plans hold what makes them scale."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from txnrisk.operators import cleaning, evaluation, models, scoring
from txnrisk.operators.features import large_amount_threshold
from txnrisk.plans.registry import all_queries
from txnrisk.plans.tables import RunTables
from txnrisk.sources.tables import materialize

QUERIES = all_queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    df.collect()
    return plan(df)


@pytest.fixture(scope="module")
def stored(spark):
    return materialize(RunTables(spark, SMALL).features, "features")


def test_no_query_crosses_rows_or_runs_python(spark):
    for name, query in QUERIES.items():
        if name.startswith("train_") or name.endswith(("_trained", "_importances")):
            continue
        text = plan(query(spark, SMALL))
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
            assert operator not in text, name


def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark):
    text = plan(cleaning.dedup_transactions(RunTables(spark, SMALL).raw))
    before, after = text.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after
    assert text.count("Exchange") == 1


def test_validity_filters_on_the_key_run_before_the_shuffle(spark):
    """Rows without a key, which could all share one, never reach the shuffle."""
    stored_raw = materialize(RunTables(spark, SMALL).raw, "raw")
    text = plan(cleaning.clean_transactions(stored_raw))
    pushed = re.search(r"PushedFilters: \[([^\]]*)", text).group(1)
    for part in ("IsNotNull(nameOrig)", "IsNotNull(nameDest)", "GreaterThan(amount,0.0)"):
        assert part in pushed
    scan_side = text.split("Exchange hashpartitioning", 1)[1]
    assert "isnotnull(nameOrig" in scan_side


def test_split_reaches_the_scan_with_few_columns(stored):
    train, evaluate = models.split_by_step(stored)
    assert "LessThanOrEqual(step,600)" in plan(train)
    text = plan(scoring.score_window(stored).groupBy("type").agg(F.count("*")))
    assert "GreaterThan(step,600)" in text
    assert "ReadSchema: struct<step:bigint,type:string>" in text


def test_threshold_reads_the_rows_once(spark, monkeypatch):
    """The rows are counted by value in one pass; nothing else of the table is read or moved."""
    from txnrisk.operators import quantiles

    stored_counts = []

    def spy(df, label):
        stored_counts.append(plan(df))
        return materialize(df, label)

    monkeypatch.setattr(quantiles, "materialize", spy)
    clean = materialize(RunTables(spark, SMALL).clean, "clean")
    found = large_amount_threshold(clean)
    (text,) = stored_counts
    assert text.count("FileScan") == 1 and "ReadSchema: struct<amount:double>" in text
    assert text.count("Exchange") == 1 and "partial_count(1)" in text.split("Exchange")[1]
    assert "FileScan" not in plan(found) and "Exchange" not in plan(found)


def test_ordered_steps_of_the_threshold_are_small(spark, monkeypatch):
    """Values that lie close together are cut into finer ranges before any of them is put in order."""
    from txnrisk.operators import quantiles

    monkeypatch.setattr(quantiles, "CELL_VALUES", 50)
    sizes = []
    at_rank = quantiles._at_rank

    def spy(counts, order, rank):
        sizes.append(counts.count())
        return at_rank(counts, order, rank)

    monkeypatch.setattr(quantiles, "_at_rank", spy)
    values = sorted([1.0 + i * 2.0**-40 for i in range(20_000)] * 2 + [float(i) for i in range(300)])
    frame = spark.createDataFrame([(v,) for v in values], "amount double")
    for q in (0.1, 0.5, 0.9):
        assert quantiles.exact_quantile(frame, "amount", q).first().threshold == values[int(q * len(values)) - 1]
    assert len(sizes) > 6 and max(sizes) <= quantiles.CUTS + 1


def test_threshold_is_a_value_in_the_plans_that_use_it(spark):
    """The deduplication is planned once, for the rows themselves, however often the threshold is needed."""
    tables = RunTables(spark, SMALL)
    for frame in (tables.features, tables.alerts):
        assert plan(frame).count("WindowGroupLimit") == plan(tables.clean).count("WindowGroupLimit")


def test_reports_limit_without_a_full_sort(spark):
    for name in ("top_risk_transactions", "top_risk_accounts", "amount_vs_score", "latest_model_metrics"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SMALL)), name


def test_auc_orders_scores_not_rows(spark):
    """Below the ordered sums there is a partial count per score."""
    tables = RunTables(spark, SMALL)
    text = plan(evaluation.evaluate_classifier(tables.scored))
    below_ordered_sums = text.rsplit("Window [sum(neg", 1)[1]
    assert "partial_sum(" in below_ordered_sums.split("WindowGroupLimit")[0]
    assert text.count("Window [sum(neg") == 3


def test_carried_predictions_need_no_join(stored):
    scored = scoring.score_linear(scoring.score_window(stored), -1.0, [("is_large_transaction", 1.0)])
    predictions = scoring.fraud_predictions(scored, F.lit("2024-01-01").cast("timestamp"))
    text = plan(scoring.high_risk_alerts(predictions, 50.0, F.current_timestamp()))
    assert "Join" not in text and "Exchange" not in text


def test_checks_share_one_scan(spark, stored):
    from txnrisk.operators.quality import feature_checks, validation_log_rows

    raw = materialize(RunTables(spark, SMALL).raw, "raw")
    assert plan(validation_log_rows(raw, F.current_date())).count("FileScan") == 1
    assert plan(feature_checks(stored)).count("FileScan") == 1
