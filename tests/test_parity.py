"""Every query with an oracle gives the oracle's rows, names and types."""

import pytest

import __spark_entry__ as entry_point
from oracle.sql import ORACLE
from tests.conftest import MEDIUM
from tests.parity import duckdb_rows, open_tables, spark_rows
from txnrisk.plans.registry import all_queries

QUERIES = all_queries()
WITHOUT_ORACLE = {
    "large_amount_threshold_approx",
    "train_logistic_evaluated",
    "train_boosted_tree_evaluated",
    "train_random_forest",
    "train_kmeans_clusters",
    "predict_trained",
    "model_weights_trained",
    "feature_importances",
}


@pytest.fixture(scope="module")
def duck():
    connection = open_tables(MEDIUM)
    yield connection
    connection.close()


def test_only_models_and_the_sketch_lack_an_oracle():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_ORACLE
    assert set(ORACLE) <= set(QUERIES)


def test_the_entry_point_has_every_query_and_its_oracle():
    assert set(QUERIES) <= set(entry_point.queries())
    assert ORACLE.items() <= entry_point.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    expected_types, expected = duckdb_rows(duck, ORACLE[name])
    types, rows = spark_rows(QUERIES[name](spark, MEDIUM))
    assert types == expected_types
    assert rows == expected
    assert rows


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["risk_level", "total", "actual_fraud", "hit_rate_pct", "avg_score"]
    assert 0 < result.count() <= 3


def test_published_fixture_values(spark):
    row = QUERIES["load_stats"](spark, MEDIUM).first()
    assert tuple(row) == (10292, 660, 6.4127)
    assert QUERIES["large_amount_threshold"](spark, MEDIUM).first()[0] == 147.42
    levels = {r.risk_level: (r.total, r.actual_fraud) for r in QUERIES["risk_level_hit_rate"](spark, MEDIUM).collect()}
    assert levels == {"HIGH": (107, 41), "MEDIUM": (185, 52), "LOW": (1321, 4)}


def test_result_does_not_depend_on_the_session_time_zone(spark):
    names = ("daily_summary_history", "alerts_by_hour", "risk_level_hit_rate")
    expected = {name: spark_rows(QUERIES[name](spark, MEDIUM)) for name in names}
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        for name in names:
            assert spark_rows(QUERIES[name](spark, MEDIUM)) == expected[name]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
