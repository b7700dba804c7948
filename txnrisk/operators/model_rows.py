"""A fitted classifier as rows, and scoring by column expressions made from them.

A linear model is one row per weight. A tree ensemble is one row per node: an inner node has a feature, a threshold
and two children, and rows with a value up to the threshold go left; a leaf has the value that it adds to the
ensemble's sum. Missing feature values are filled first, as the pipeline does that the rows were taken from.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    LogisticRegressionModel,
    RandomForestClassificationModel,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from txnrisk.functions.features import flag
from txnrisk.schemas import TRANSACTION_FEATURES
from txnrisk.sources.tables import shared_dir
from txnrisk.values import CLASSIFIER_FEATURES

LINEAR, FOREST, BOOSTED = "linear", "forest", "boosted"
INTERCEPT = "__INTERCEPT__"
WHOLE_FEATURES = {f.name for f in TRANSACTION_FEATURES if isinstance(f.dataType, LongType)}


class Weight(NamedTuple):
    feature: str
    weight: float


class Node(NamedTuple):
    tree: int
    node: int
    feature: str | None
    threshold: float | None
    left: int | None
    right: int | None
    value: float | None


NODE_SCHEMA = "tree int, node int, feature string, threshold double, left int, right int, value double"


@dataclass(frozen=True)
class ModelRows:
    """``kind`` tells how the sum becomes a probability: logistic of it (linear), of twice it (boosted), or its mean (forest)."""

    kind: str
    rows: tuple[Weight | Node, ...]
    fills: Mapping[str, float] = field(default_factory=dict)

    def frame(self, spark: SparkSession) -> DataFrame:
        """The rows as a table: a few weights, or the nodes of a few small trees."""
        schema = "feature string, weight double" if self.kind == LINEAR else NODE_SCHEMA
        return spark.createDataFrame([tuple(row) for row in self.rows], schema)

    def value(self, feature: str) -> Column:
        """A feature as the model sees it."""
        column = F.col(feature).cast("double")
        if feature not in self.fills:
            return column
        return F.when(column.isNull() | F.isnan(column), F.lit(float(self.fills[feature]))).otherwise(column)

    def trees(self, of_leaf: str = "value") -> list[Column]:
        """For each tree the value of the leaf that a row falls into, or its number, as ``node``."""
        by_tree: dict[int, dict[int, Node]] = {}
        for row in self.rows:
            by_tree.setdefault(row.tree, {})[row.node] = row

        def walk(nodes: dict[int, Node], number: int) -> Column:
            node = nodes[number]
            if node.feature is None:
                return F.lit(node.node) if of_leaf == "node" else F.lit(float(node.value))
            left, right = walk(nodes, node.left), walk(nodes, node.right)
            return F.when(self.value(node.feature) <= F.lit(float(node.threshold)), left).otherwise(right)

        return [walk(by_tree[tree], 0) for tree in sorted(by_tree)]

    def sum(self) -> Column:
        """The weighted sum, or the sum of the leaves that a row falls into, in the order of the rows."""
        if self.kind == LINEAR:
            terms = [
                F.lit(float(weight)) if feature == INTERCEPT else F.lit(float(weight)) * self.value(feature)
                for feature, weight in self.rows
            ]
        else:
            terms = self.trees()
        total = F.lit(0.0)
        for term in terms:
            total = total + term
        return total

    def probability(self) -> Column:
        total = self.sum()
        if self.kind == FOREST:
            return total / F.lit(float(len({row.tree for row in self.rows})))
        steepness = 2.0 if self.kind == BOOSTED else 1.0
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-steepness) * total))


def score_rows(model: ModelRows, df: DataFrame) -> DataFrame:
    """Input columns, the predicted label and the probability of fraud."""
    scored = df.withColumn("probability", model.probability())
    label = flag(F.col("probability") > 0.5)
    return scored.select(*df.columns, label.alias("predicted_isFraud"), "probability")


def model_rows(model: PipelineModel, features: Sequence[str] = CLASSIFIER_FEATURES) -> ModelRows:
    """The rows of a fitted pipeline of this package."""
    classifier, fills = model.stages[-1], {}
    for stage in model.stages[:-1]:
        if hasattr(stage, "surrogateDF"):
            fills.update(stage.surrogateDF.first().asDict())
    # A whole number is filled with a whole number.
    fills = {name: float(int(v)) if name in WHOLE_FEATURES else v for name, v in fills.items()}
    if isinstance(classifier, LogisticRegressionModel):
        weights = [Weight(INTERCEPT, float(classifier.intercept))]
        weights += [Weight(name, float(w)) for name, w in zip(features, classifier.coefficients)]
        return ModelRows(LINEAR, tuple(weights), fills)
    if isinstance(classifier, GBTClassificationModel):
        return ModelRows(BOOSTED, _nodes(classifier, features, boosted=True), fills)
    if isinstance(classifier, RandomForestClassificationModel):
        return ModelRows(FOREST, _nodes(classifier, features, boosted=False), fills)
    raise TypeError(f"no rows for a {type(classifier).__name__}")


def _nodes(classifier, features: Sequence[str], boosted: bool) -> tuple[Node, ...]:
    """The nodes as the ensemble's own saved table has them; some thousands at most."""
    spark = SparkSession.active()
    path = f"{shared_dir(spark)}/ensemble-{uuid.uuid4().hex}"
    classifier.write().save(path)
    saved = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    nodes = []
    for row in saved:
        if row.leftChild >= 0:
            feature, threshold = features[row.split.featureIndex], row.split.leftCategoriesOrThreshold[0]
            nodes.append(Node(row.treeID, row.id, feature, threshold, row.leftChild, row.rightChild, None))
            continue
        stats = row.impurityStats
        value = row.prediction * classifier.treeWeights[row.treeID] if boosted else stats[1] / sum(stats)
        nodes.append(Node(row.treeID, row.id, None, None, None, None, value))
    return tuple(nodes)
