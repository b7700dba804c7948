"""Training, saving, and the metrics against Spark's own evaluators."""

import hashlib
import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tests.conftest import MEDIUM
from txnrisk.operators import models
from txnrisk.operators.certificates import boosting_step, lloyd_step, logistic_gradient
from txnrisk.operators.evaluation import evaluate_classifier
from txnrisk.operators.explain import shift
from txnrisk.operators.model_rows import LINEAR, ModelRows, Weight, model_rows
from txnrisk.operators.ranks import numbered
from txnrisk.plans.tables import RunTables
from txnrisk.sources.tables import materialize
from txnrisk.values import CLASSIFIER_FEATURES

TRAINERS = {
    "logistic": models.train_logistic,
    "boosted": lambda train: models.train_boosted_tree(train, rounds=5),
    "forest": models.train_random_forest,
}


@pytest.fixture(scope="module")
def splits(spark):
    return models.split_by_step(materialize(RunTables(spark, MEDIUM).features, "features"))


@pytest.fixture(scope="module")
def fitted(splits):
    return {name: train(splits[0]) for name, train in TRAINERS.items()}


@pytest.mark.parametrize("name", TRAINERS)
def test_metrics_agree_with_the_evaluators(fitted, splits, name):
    scored = materialize(models.predict(fitted[name], splits[1]), "scored").select(
        F.col("isFraud").cast("double").alias("label"), "isFraud", "predicted_isFraud", "probability"
    )
    row = evaluate_classifier(scored).first()
    scored = scored.select(
        "label",
        F.col("predicted_isFraud").cast("double").alias("prediction"),
        "probability",
        array_to_vector(F.array(1 - F.col("probability"), "probability")).alias("vector"),
    )
    auc = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0).evaluate(scored)
    assert row.roc_auc == pytest.approx(auc, abs=1e-9) and auc > 0.9
    for metric, spark_name in (
        ("precision", "precisionByLabel"),
        ("recall", "recallByLabel"),
        ("f1_score", "fMeasureByLabel"),
        ("log_loss", "logLoss"),
    ):
        evaluator = MulticlassClassificationEvaluator(
            metricName=spark_name, metricLabel=1.0, probabilityCol="vector"
        )
        assert row[metric] == pytest.approx(evaluator.evaluate(scored), abs=1e-9)


@pytest.mark.parametrize("name", TRAINERS)
def test_predict_keeps_the_input_columns(fitted, splits, name):
    scored = models.predict(fitted[name], splits[1])
    assert scored.columns == [*splits[1].columns, "predicted_isFraud", "probability"]
    assert scored.where("probability < 0 or probability > 1").count() == 0
    assert scored.where("predicted_isFraud <> cast(probability > 0.5 as int)").count() == 0


def test_scoring_after_an_observation_in_the_session(spark, splits):
    """A fitted model goes to the tasks without the session it was fitted in."""
    seen = Observation()
    splits[0].observe(seen, F.count("*").alias("rows")).write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == splits[0].count()
    for train in (models.train_logistic, models.train_random_forest):
        scored = models.predict(train(splits[0]), splits[1])
        assert scored.where("probability is null").count() == 0


def test_saved_model_gives_equal_predictions(fitted, splits, tmp_path):
    for name, model in fitted.items():
        model.write().overwrite().save(f"{tmp_path}/{name}")
        again = PipelineModel.load(f"{tmp_path}/{name}")
        before = models.predict(model, splits[1]).select("nameOrig", "step", "probability")
        after = models.predict(again, splits[1]).select("nameOrig", "step", "probability")
        assert before.exceptAll(after).count() == 0


def test_scores_near_zero_keep_their_order(spark):
    rare = spark.range(100_000).select(
        (F.col("id") % 1000 == 0).cast("bigint").alias("isFraud"),
        F.lit(0).alias("predicted_isFraud"),
        F.when(F.col("id") % 1000 == 0, 4e-5).otherwise(F.col("id") * 2.9e-10).alias("probability"),
    )
    assert evaluate_classifier(rare).first().roc_auc == 1.0


@pytest.mark.parametrize("rows", [3, 50, 400, 600])
def test_boosted_trees_fit_on_few_rows(splits, rows):
    few = materialize(splits[0].orderBy("step", "nameOrig", "amount").limit(rows), "few")
    model = models.train_boosted_tree(few, rounds=2)
    assert models.predict(model, few).count() == rows
    models.train_boosted_tree(few, rounds=1, holdout_share=0.0)


def test_a_row_with_missing_balances_is_scored(fitted, splits):
    broken = splits[1].limit(3).withColumns(
        {c: F.lit(None).cast("double") for c in ("balance_diff_orig", "amount_to_balance_ratio")}
    )
    for model in fitted.values():
        scored = models.predict(model, broken)
        assert scored.where("probability is null").count() == 0
        assert scored.where("balance_diff_orig is null").count() == 3


def test_explanations(fitted, spark):
    weights = models.model_weights(fitted["logistic"], 5).collect()
    sizes = [abs(row.weight) for row in weights]
    assert len(weights) == 5 and sizes == sorted(sizes, reverse=True)
    assert "__INTERCEPT__" in [row.feature for row in models.model_weights(fitted["logistic"], 12).collect()]
    for name in ("boosted", "forest"):
        rows = models.feature_importances(fitted[name]).collect()
        assert {row.feature for row in rows} == set(CLASSIFIER_FEATURES)
        assert sum(row.importance for row in rows) == pytest.approx(1.0)


@pytest.mark.parametrize("name", TRAINERS)
def test_a_model_as_rows_scores_like_the_pipeline(fitted, splits, name):
    """Also where feature values are missing."""
    holes = {c: F.when(F.col("step") % 7 != i, F.col(c)) for i, c in enumerate(models.NULLABLE_FEATURES)}
    rows = materialize(splits[1].withColumns(holes), "holes")
    by_rows = model_rows(fitted[name])
    key = ["step", "nameOrig", "amount", "nameDest"]
    first = models.predict(fitted[name], rows).select(*key, "predicted_isFraud", "probability")
    second = models.predict(by_rows, rows).select(*key, F.col("predicted_isFraud").alias("label"), F.col("probability").alias("p"))
    both = first.join(second, key)
    assert both.count() == rows.count()
    apart = both.where((F.col("predicted_isFraud") != F.col("label")) | (F.abs(F.col("probability") - F.col("p")) > 1e-12))
    assert apart.count() == 0
    table = by_rows.frame(rows.sparkSession)
    assert table.count() == len(by_rows.rows)


def plain_importance(rows, probability, seed=42, clamp=1e-15):
    """Attributions with all rows at hand."""
    names = [f"{seed}:{r.step}|{r.nameOrig}|{round(r.amount * 100)}|{r.nameDest}" for r in rows]
    order = sorted(range(len(rows)), key=lambda i: hashlib.md5(names[i].encode()).hexdigest())
    ordered = [rows[i].asDict() for i in order]

    def loss(moved=None, places=0):
        total = 0.0
        for i, row in enumerate(ordered):
            if moved:
                row = row | {moved: ordered[(i + places) % len(ordered)][moved]}
            p = min(max(probability(row), clamp), 1 - clamp)
            total -= math.log(p if row["isFraud"] == 1 else 1 - p)
        return total / len(ordered)

    return {f: loss(f, shift(f, len(rows), seed)) - loss() for f in CLASSIFIER_FEATURES}


def test_permutation_importance_against_all_rows(splits):
    def probability(row):
        z = -3 + 4 * row["orig_balance_zero_after"] + row["is_transfer_or_cashout"] - 0.01 * row["balance_diff_orig"]
        return 1 / (1 + math.exp(-z))

    weights = (("__INTERCEPT__", -3.0), ("orig_balance_zero_after", 4.0), ("is_transfer_or_cashout", 1.0), ("balance_diff_orig", -0.01))
    model = ModelRows(LINEAR, tuple(Weight(*w) for w in weights))
    cents = F.round(F.col("amount") * 100).cast("bigint").cast("string")
    name = F.concat_ws("|", F.col("step").cast("string"), "nameOrig", cents, "nameDest")
    found = models.global_explain(model, splits[1], name).collect()
    expected = plain_importance(splits[1].collect(), probability)
    assert {row.feature: row.attribution for row in found} == pytest.approx(expected, abs=1e-9)
    assert found[0].feature == "orig_balance_zero_after"
    assert [row.attribution for row in found] == sorted((row.attribution for row in found), reverse=True)
    unused = [row.attribution for row in found if row.feature not in dict(weights)]
    assert unused == [0.0] * 8


def test_permutation_importance_of_a_fitted_model_and_of_few_rows(fitted, splits):
    found = models.global_explain(fitted["boosted"], splits[1]).collect()
    assert {row.feature for row in found} == set(CLASSIFIER_FEATURES) and found[0].attribution > 0.01
    one = materialize(splits[1].limit(1), "one")
    assert [row.attribution for row in models.global_explain(fitted["logistic"], one).collect()] == [0.0] * 11
    assert models.global_explain(fitted["logistic"], splits[1].limit(0)).collect() == []


def test_every_value_is_used_once(spark):
    """Numbering is one-to-one whatever the cells, and a shift never leaves a row in place."""
    frame = spark.range(3000).select("id", F.md5(F.col("id").cast("string")).alias("order"))
    places = [row.rank for row in numbered(frame, "order").orderBy("order").collect()]
    assert places == list(range(3000))
    same = frame.select("id", F.md5(F.lit("x")).alias("order"))
    assert [row.rank for row in numbered(same, "order", ["id"]).orderBy("id").collect()] == list(range(3000))
    assert all(0 < shift(f, rows) < rows for f in CLASSIFIER_FEATURES for rows in (2, 3, 100))


def test_certificates_tell_optimal_from_other_models(splits, fitted):
    def steepest(model):
        return max(abs(row.gradient) for row in logistic_gradient(model, splits[0]).collect())

    assert steepest(fitted["logistic"]) < 1e-6 < 1e-3 < steepest(models.train_logistic(splits[0], iterations=2))
    settled = models.train_kmeans(splits[0], iterations=500, tolerance=0.0)
    assert max(row.shift for row in lloyd_step(settled, splits[0]).collect()) < 1e-9
    assert max(row.shift for row in lloyd_step(models.train_kmeans(splits[0], iterations=1), splits[0]).collect()) > 1e-4


def test_leaves_of_boosted_trees_are_the_means_of_their_rows(splits, fitted):
    leaves = boosting_step(fitted["boosted"], splits[0]).collect()
    assert len({row.tree for row in leaves}) == len(fitted["boosted"].stages[-1].treeWeights) > 1
    assert max(row.gap for row in leaves) < 1e-9 and min(row.rows for row in leaves) > 0
    other = models.train_boosted_tree(splits[0].where("step % 2 = 0"), rounds=3)
    assert max(row.gap for row in boosting_step(other, splits[0]).collect()) > 1e-3
    whole = models.train_boosted_tree(splits[0], rounds=2, holdout_share=0.0)
    assert max(row.gap for row in boosting_step(whole, splits[0], 0.0).collect()) < 1e-9


def test_trees_store_no_node_of_each_row(fitted):
    """Trees this shallow find a row's node faster than they store it again at each level."""
    for name in ("boosted", "forest"):
        assert not fitted[name].stages[-1].getCacheNodeIds()


def test_auto_weights_give_both_classes_the_same_total(splits):
    totals = (
        models.class_weights(splits[0]).groupBy("isFraud").agg(F.sum("class_weight").alias("w")).collect()
    )
    assert totals[0].w == pytest.approx(totals[1].w)


def test_held_out_rows(splits):
    marked = models.hold_out(splits[0], 0.2)
    held_out = marked.where(models.VALIDATION).count()
    assert 0.17 < held_out / splits[0].count() < 0.23
    assert models.hold_out(splits[0], 0.0).where(models.VALIDATION).count() == 0


def test_kmeans(splits):
    model = models.train_kmeans(splits[0])
    assigned = models.assign_clusters(model, splits[0])
    assert assigned.columns == [*splits[0].columns, "centroid_id"]
    ids = {row.centroid_id for row in assigned.select("centroid_id").distinct().collect()}
    assert ids <= set(range(1, 9)) and len(ids) > 4
