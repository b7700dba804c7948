"""Checks of fitted models by what an optimum must satisfy, worked out from the training rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.operators.model_rows import INTERCEPT, model_rows
from txnrisk.operators.models import VALIDATION, WEIGHT, class_weights, hold_out
from txnrisk.sources.tables import materialize
from txnrisk.values import CLASS_WEIGHTS, CLASSIFIER_FEATURES, CLUSTER_FEATURES, LABEL


def logistic_gradient(
    model: PipelineModel, train: DataFrame, weights: str | Mapping[int, float] = CLASS_WEIGHTS
) -> DataFrame:
    """``feature``, ``rows`` and ``gradient``: the slope of the weighted log loss along each weight of the model.

    The slope is the weighted sum of (probability - label) * value, divided by the weighted sum of the value's
    size, so it lies between -1 and 1 whatever the unit; it is 0 at the optimum. One pass over the rows.
    """
    fitted = model_rows(model)
    rows = class_weights(train.where(F.col(LABEL).isNotNull()), weights)
    residual = F.col(WEIGHT) * (F.col("probability") - F.col(LABEL))
    rows = rows.withColumn("probability", fitted.probability()).withColumn("residual", residual)
    found = []
    for name in (INTERCEPT, *CLASSIFIER_FEATURES):
        value = F.lit(1.0) if name == INTERCEPT else fitted.value(name)
        slope = F.try_divide(F.sum(F.col("residual") * value), F.sum(F.col(WEIGHT) * F.abs(value)))
        found.append(F.struct(F.lit(name).alias("feature"), F.coalesce(slope, F.lit(0.0)).alias("gradient")))
    return rows.agg(F.count("*").alias("rows"), F.array(*found).alias("found")).select("rows", F.inline("found"))


def lloyd_step(model: PipelineModel, train: DataFrame) -> DataFrame:
    """``centroid_id`` (from 1), ``rows`` and ``shift``: how far a centre lies from the mean of the rows nearest to it.

    The largest gap along any standardised feature; it is 0 for every centre once the clustering has settled.
    A centre without rows has none.
    """
    centers = model.stages[-1].clusterCenters()
    vector = vector_to_array("features_vector")
    names = [f"x_{i}" for i in range(len(CLUSTER_FEATURES))]
    rows = model.transform(train).select("cluster", *[vector[i].alias(name) for i, name in enumerate(names)])
    means = rows.groupBy("cluster").agg(F.count("*").alias("rows"), *[F.avg(name).alias(name) for name in names])
    center = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centers])[F.col("cluster")]
    gaps = F.array(*[F.abs(F.col(name) - center[i]) for i, name in enumerate(names)])
    return means.select((F.col("cluster") + 1).cast("bigint").alias("centroid_id"), "rows", F.array_max(gaps).alias("shift"))


def boosting_step(model: PipelineModel, train: DataFrame, holdout_share: float = 0.2) -> DataFrame:
    """``tree``, ``node``, ``rows`` and ``gap`` of every leaf of boosted trees: how far its value is from the one it must have.

    A leaf of the first tree holds the weighted mean of its rows' labels, as 1 and -1; one of a later tree that of
    what the trees before leave of them, the slope of the log loss at their sum. Only rows that were not held out count.
    """
    fitted = model_rows(model)
    rates = model.stages[-1].treeWeights
    rows = hold_out(class_weights(train.where(F.col(LABEL).isNotNull())), holdout_share)
    held_out = F.col(VALIDATION)
    if not (rows.where(held_out).isEmpty() or rows.where(~held_out).isEmpty()):
        rows = rows.where(~held_out)
    label = F.when(F.col(LABEL) == 1, 1.0).otherwise(-1.0).alias("label")
    values = [value.alias(f"value_{t}") for t, value in enumerate(fitted.trees())]
    leaves = [leaf.alias(f"leaf_{t}") for t, leaf in enumerate(fitted.trees("node"))]
    rows = materialize(rows.select(label, F.col(WEIGHT).alias("weight"), *values, *leaves), "boosted-rows")

    steps, total = [], F.lit(0.0)
    for t in range(len(rates)):
        rest = F.col("label") if t == 0 else 4.0 * F.col("label") / (1.0 + F.exp(2.0 * F.col("label") * total))
        steps.append(F.struct(F.lit(t).alias("tree"), F.col(f"leaf_{t}").alias("node"), rest.alias("rest")))
        total = total + F.col(f"value_{t}")
    means = (
        rows.select("weight", F.inline(F.array(*steps)))
        .groupBy("tree", "node")
        .agg(F.count("*").alias("rows"), (F.sum(F.col("weight") * F.col("rest")) / F.sum("weight")).alias("mean"))
    )
    held = fitted.frame(train.sparkSession).where("feature IS NULL")
    rate = F.array(*[F.lit(float(r)) for r in rates])[F.col("tree")]
    gap = F.abs(F.col("value") / rate - F.coalesce("mean", F.lit(float("inf"))))
    return held.join(means, ["tree", "node"], "left").select("tree", "node", F.coalesce("rows", F.lit(0)).alias("rows"), gap.alias("gap"))
