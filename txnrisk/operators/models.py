"""Training, prediction and explanation with Spark ML."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.operators.explain import permutation_importance
from txnrisk.operators.model_rows import ModelRows, model_rows, score_rows
from txnrisk.sources.files import delete
from txnrisk.sources.tables import ensure_checkpoint_dir, scratch_dir
from txnrisk.values import (
    CLASS_WEIGHTS,
    CLASSIFIER_FEATURES,
    CLUSTER_FEATURES,
    DEFAULT_SPLIT_STEP,
    LABEL,
    TRANSACTION_KEY,
)

SEED = 42
WEIGHT = "class_weight"
VALIDATION = "is_validation"
# The flags and codes are never null; these can be, when a balance or the step is.
NULLABLE_FEATURES = (
    "balance_diff_orig",
    "balance_diff_dest",
    "amount_to_balance_ratio",
    "hour_of_step",
    "net_orig_change",
    "net_dest_change",
)


def split_by_step(
    features: DataFrame, split_step: int = DEFAULT_SPLIT_STEP
) -> tuple[DataFrame, DataFrame]:
    """Rows up to and including the split step for training, later ones for evaluation."""
    return features.where(F.col("step") <= split_step), features.where(F.col("step") > split_step)


def class_weights(
    df: DataFrame, spec: str | Mapping[int, float] = "auto", name: str = WEIGHT
) -> DataFrame:
    """Add a weight column: the given weight per class, or ``auto`` for equal class totals."""
    label = F.col(LABEL)
    if spec == "auto":
        sizes = df.where(label.isNotNull()).agg(
            F.struct(
                F.count_if(label == 0).alias("negatives"),
                F.count_if(label == 1).alias("positives"),
            ).alias("sizes")
        )
        sizes = sizes.scalar()
        negatives, positives = sizes.getField("negatives"), sizes.getField("positives")
        of_class = F.when(label == 1, positives).otherwise(negatives)
        weight = F.try_divide((negatives + positives).cast("double"), of_class * 2.0)
    else:
        weight = F.lit(None).cast("double")
        for value, class_weight in spec.items():
            weight = F.when(label == value, F.lit(float(class_weight))).otherwise(weight)
    return df.withColumn(name, weight)


def hold_out(train: DataFrame, share: float) -> DataFrame:
    """Mark about that share of the rows as held out.

    A hash of the row key decides, so a row keeps its side when a task is run again.
    """
    slices = 1_000_000_000
    slot = F.pmod(F.xxhash64(*TRANSACTION_KEY, F.lit(SEED)), F.lit(slices))
    return train.withColumn(VALIDATION, slot < int(share * slices))


def _vector_stages(columns: Sequence[str], output: str) -> list:
    """Replace nulls by the training mean, then assemble the feature vector."""
    nullable = [c for c in columns if c in NULLABLE_FEATURES]
    filled = [f"{c}_filled" for c in nullable]
    replaced = dict(zip(nullable, filled))
    return [
        Imputer(strategy="mean", inputCols=nullable, outputCols=filled),
        VectorAssembler(inputCols=[replaced.get(c, c) for c in columns], outputCol=output),
    ]


def _fit_classifier(train: DataFrame, classifier: Estimator) -> PipelineModel:
    stages = _vector_stages(CLASSIFIER_FEATURES, "features_vector") + [classifier]
    return Pipeline(stages=stages).fit(train)


def _without_summary(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The model as it is after saving and loading, without the summary of its training.

    The summary of a two-class model holds the session. Scoring sends the model to the tasks, which fails with a
    session that has had an ``Observation``, as that of a job that counts while it writes.
    """
    path = f"{scratch_dir(spark)}/model-{uuid.uuid4().hex}"
    try:
        model.write().save(path)
        return PipelineModel.load(path)
    finally:
        delete(spark, path)


def _labelled(train: DataFrame, *extra: str) -> DataFrame:
    kept = dict.fromkeys([*CLASSIFIER_FEATURES, LABEL, *extra])
    return train.where(F.col(LABEL).isNotNull()).select(*kept)


def train_logistic(
    train: DataFrame, weights: str | Mapping[int, float] = CLASS_WEIGHTS, iterations: int = 20
) -> PipelineModel:
    """Logistic regression in which one fraud row weighs as much as ten others."""
    classifier = LogisticRegression(
        featuresCol="features_vector", labelCol=LABEL, weightCol=WEIGHT, maxIter=iterations
    )
    model = _fit_classifier(class_weights(_labelled(train), weights), classifier)
    return _without_summary(model, train.sparkSession)


def train_boosted_tree(
    train: DataFrame,
    rounds: int = 20,
    max_depth: int = 6,
    learn_rate: float = 0.1,
    min_info_gain: float = 0.0,
    holdout_share: float = 0.2,
) -> PipelineModel:
    """Gradient-boosted trees on balanced classes, stopped early on held-out rows.

    One tree is grown per round: Spark has no counterpart to several parallel trees in a
    round, so the number of rounds is the parameter. ``min_info_gain`` is the least mean gain
    of a split. ``holdout_share`` of the rows decide the early stop, whatever the number of rows;
    with 0, or when that leaves one side empty, all rows train and all rounds are run.
    The node of each row is not stored between levels: walking down a tree this shallow takes less time and memory.
    """
    ensure_checkpoint_dir(train.sparkSession)
    marked = hold_out(class_weights(_labelled(train, *TRANSACTION_KEY)), holdout_share)
    classifier = GBTClassifier(
        featuresCol="features_vector",
        labelCol=LABEL,
        weightCol=WEIGHT,
        maxIter=rounds,
        maxDepth=max_depth,
        stepSize=learn_rate,
        minInfoGain=min_info_gain,
        seed=SEED,
    )
    held_out = F.col(VALIDATION)
    if not (marked.where(held_out).isEmpty() or marked.where(~held_out).isEmpty()):
        classifier.setValidationIndicatorCol(VALIDATION)
    return _fit_classifier(marked, classifier)


def train_random_forest(
    train: DataFrame, trees: int = 10, max_depth: int = 4, subsample: float = 0.8
) -> PipelineModel:
    """Random forest on balanced classes.

    Every row trains: a forest has no early stop, so nothing is held out automatically.
    """
    ensure_checkpoint_dir(train.sparkSession)
    classifier = RandomForestClassifier(
        featuresCol="features_vector",
        labelCol=LABEL,
        weightCol=WEIGHT,
        numTrees=trees,
        maxDepth=max_depth,
        subsamplingRate=subsample,
        seed=SEED,
    )
    model = _fit_classifier(class_weights(_labelled(train)), classifier)
    return _without_summary(model, train.sparkSession)


def train_kmeans(
    train: DataFrame, clusters: int = 8, iterations: int = 20, tolerance: float = 1e-4
) -> PipelineModel:
    """k-means on standardised features, seeded by the parallel form of k-means++.

    It ends when no centre moves by more than the tolerance, or after the last iteration.
    """
    stages = _vector_stages(CLUSTER_FEATURES, "raw_vector") + [
        StandardScaler(
            inputCol="raw_vector", outputCol="features_vector", withMean=True, withStd=True
        ),
        KMeans(
            featuresCol="features_vector",
            predictionCol="cluster",
            k=clusters,
            initMode="k-means||",
            maxIter=iterations,
            tol=tolerance,
            seed=SEED,
        ),
    ]
    return Pipeline(stages=stages).fit(train.select(*CLUSTER_FEATURES))


def predict(model: PipelineModel | ModelRows, df: DataFrame) -> DataFrame:
    """Input columns, the predicted label and the probability of fraud, by a fitted pipeline or a model's rows."""
    if isinstance(model, ModelRows):
        return score_rows(model, df)
    return model.transform(df).select(
        *df.columns,
        F.col("prediction").cast("bigint").alias("predicted_isFraud"),
        vector_to_array("probability").getItem(1).alias("probability"),
    )


def assign_clusters(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Input columns and the number of the nearest centroid, counted from 1."""
    return model.transform(df).select(
        *df.columns, (F.col("cluster") + 1).cast("bigint").alias("centroid_id")
    )


def kmeans_assign(
    df: DataFrame, centroids: Sequence[Sequence[float]], columns: Sequence[str] = CLUSTER_FEATURES
) -> DataFrame:
    """Number (from 1) of and distance to the nearest given centroid; the first wins a tie."""

    def squared_distance(centroid: Sequence[float]) -> Column:
        total = F.lit(0.0)
        for name, value in zip(columns, centroid):
            gap = F.col(name) - F.lit(float(value))
            total = total + gap * gap
        return total

    nearest = F.array_min("distances")
    return (
        df.withColumn("distances", F.array(*[squared_distance(c) for c in centroids]))
        .withColumn("centroid_id", F.array_position("distances", nearest))
        .withColumn("centroid_distance", F.sqrt(nearest))
        .drop("distances")
    )


def model_weights(model: PipelineModel | ModelRows, n: int = 5) -> DataFrame:
    """The n largest logistic weights by size, the intercept among them."""
    rows = model if isinstance(model, ModelRows) else model_rows(model)
    return largest_weights(rows.frame(SparkSession.active()), n)


def largest_weights(weights: DataFrame, n: int = 5) -> DataFrame:
    return weights.orderBy(F.abs("weight").desc(), "feature").limit(n)


def global_explain(model: PipelineModel | ModelRows, df: DataFrame, row_name: Column | None = None, **options) -> DataFrame:
    """Attribution of each feature, largest first: the log loss it saves, by permutation over the given rows.

    ``row_name`` is a text that tells rows apart, by default all columns of the transaction key.
    """
    if row_name is None:
        row_name = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in TRANSACTION_KEY])
    return permutation_importance(lambda rows: predict(model, rows), df, row_name, **options)


def feature_importances(model: PipelineModel) -> DataFrame:
    """Share of each feature in the gain of a tree ensemble's splits, largest first."""
    importances = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(CLASSIFIER_FEATURES, importances)]
    # One row per feature.
    shares = SparkSession.active().createDataFrame(rows, "feature string, importance double")
    return shares.orderBy(F.col("importance").desc(), "feature")
