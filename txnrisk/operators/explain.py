"""Global attributions of a model's features by permutation."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.operators.ranks import numbered
from txnrisk.sources.tables import materialize
from txnrisk.values import CLASSIFIER_FEATURES, LABEL

SEED = 42


def shift(feature: str, rows: int, seed: int = SEED) -> int:
    """How many places the values of a feature move: 1 to ``rows - 1``, 0 where there is one row."""
    if rows < 2:
        return 0
    digits = hashlib.md5(f"{seed}:{feature}".encode()).hexdigest()[:7]
    return 1 + int(digits, 16) % (rows - 1)


def log_loss(label: Column, probability: Column, clamp: float) -> Column:
    p = F.least(F.greatest(probability, F.lit(clamp)), F.lit(1.0 - clamp))
    return -F.ln(F.when(label == 1, p).otherwise(F.lit(1.0) - p))


def permutation_importance(
    score: Callable[[DataFrame], DataFrame],
    df: DataFrame,
    row_name: Column,
    features: Sequence[str] = CLASSIFIER_FEATURES,
    seed: int = SEED,
    clamp: float = 1e-15,
) -> DataFrame:
    """``feature`` and ``attribution``: by how much the mean log loss grows when the feature's values change rows.

    ``score`` adds ``probability`` to a frame with the feature columns. Rows are put in a random order once, by
    the md5 of the seed and ``row_name``, a text that tells rows apart. Each feature is then moved along that
    order by a number of places of its own, so every row gets the value of one other row and every value is used
    once. Values travel by row number, and all features are scored in one pass over the rows,
    each row once as it is and once for each feature. Rows without a label or a score are left out.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), row_name)).alias("order")
    rows = df.where(F.col(LABEL).isNotNull()).select(order, LABEL, *features)
    rows = materialize(rows, "explained-rows")
    ranked = materialize(numbered(rows, "order", [*features, LABEL]).drop("order"), "ranked-rows")
    count = ranked.count()

    # The value at place r + shift goes to the row at place r.
    moves = [
        F.struct(
            F.pmod(F.col("rank") - shift(name, count, seed), F.lit(max(count, 1))).alias("rank"),
            F.lit(i).alias("feature"),
            F.col(name).cast("double").alias("value"),
        )
        for i, name in enumerate(features)
    ]
    sent = ranked.select(F.inline(F.array(*moves)))
    values = [F.max(F.when(F.col("feature") == i, F.col("value"))).alias(f"moved_{i}") for i in range(len(features))]
    received = sent.groupBy("rank").agg(*values)
    variants = ranked.join(received, "rank").withColumn("variant", F.explode(F.sequence(F.lit(-1), F.lit(len(features) - 1))))
    kinds = dict(df.dtypes)
    moved = {
        name: F.when(F.col("variant") == i, F.col(f"moved_{i}").cast(kinds[name])).otherwise(F.col(name))
        for i, name in enumerate(features)
    }
    scored = score(variants.select("variant", LABEL, *[column.alias(name) for name, column in moved.items()]))
    losses = (
        scored.where(F.col("probability").isNotNull())
        .groupBy("variant")
        .agg(F.avg(log_loss(F.col(LABEL), F.col("probability"), clamp)).alias("loss"))
    )
    names = F.array(*[F.lit(name) for name in features])
    # One row for each feature and one for the rows as they are.
    base = losses.where("variant = -1").select("loss").scalar()
    return (
        losses.where("variant >= 0")
        .select(F.get(names, F.col("variant")).alias("feature"), (F.col("loss") - base).alias("attribution"))
        .orderBy(F.col("attribution").desc(), "feature")
    )
