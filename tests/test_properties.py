"""What must hold between the tables of one run."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from txnrisk.operators import dashboards, models
from txnrisk.plans.tables import RunTables
from txnrisk.values import TRANSACTION_KEY


@pytest.fixture(scope="module")
def tables(spark):
    return RunTables(spark, SMALL)


def test_clean_keys_are_unique(tables):
    assert tables.clean.count() == tables.clean.select(*TRANSACTION_KEY).distinct().count()


def test_features_keep_the_rows(tables):
    assert tables.features.count() == tables.clean.count()


def test_risk_counts_sum_to_the_total(tables):
    for row in tables.past_summaries.collect():
        parts = row.high_risk_count + row.medium_risk_count + row.low_risk_count
        assert parts == row.total_transactions


def test_alerts_are_the_high_predictions(tables):
    high = tables.predictions.where("risk_level = 'HIGH'").select(*TRANSACTION_KEY)
    alerts = tables.alerts.select(*TRANSACTION_KEY)
    assert alerts.exceptAll(high).count() == 0 and alerts.count() == high.count()


def test_histogram_and_heatmap_cover_their_input(tables):
    for report, source in (
        (dashboards.score_histogram(tables.past_predictions), tables.past_predictions),
        (dashboards.fraud_rate_heatmap(tables.features), tables.features),
    ):
        assert report.agg(F.sum("transaction_count")).first()[0] == source.count()


def test_shares_sum_to_one_hundred(tables):
    shares = dashboards.risk_distribution(tables.past_predictions)
    assert abs(shares.agg(F.sum("pct_of_total")).first()[0] - 100) < 0.05


@pytest.mark.parametrize("split_step", [100, 600])
def test_split_is_a_partition(tables, split_step):
    train, evaluate = models.split_by_step(tables.clean, split_step)
    assert train.count() + evaluate.count() == tables.clean.count()
    assert train.agg(F.max("step")).first()[0] <= split_step < evaluate.agg(F.min("step")).first()[0]
