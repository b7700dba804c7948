"""Results that must not depend on how rows are dealt over tasks."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from txnrisk.functions.exact import DIGITS, order_digits
from txnrisk.operators.quantiles import exact_quantile
from txnrisk.plans.registry import all_queries

MEANS = ["alerts_by_type", "alerts_by_hour", "kpi_avg_score", "feature_verify"]


@pytest.mark.parametrize("name", MEANS)
def test_equal_rows_for_any_partitions(spark, name):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")
    before = [spark.conf.get(k) for k in keys]
    found = []
    try:
        for partitions, adaptive in ((1, "false"), (8, "false"), (16, "true")):
            spark.conf.set(keys[0], partitions)
            spark.conf.set(keys[1], adaptive)
            found.append(sorted(map(str, all_queries()[name](spark, SMALL).collect())))
    finally:
        for key, value in zip(keys, before):
            spark.conf.set(key, value)
    assert all(rows == found[0] for rows in found)


def test_digits_sort_like_the_value(spark):
    rnd = random.Random(3)
    values = [struct.unpack("d", rnd.randbytes(8))[0] for _ in range(2000)]
    values = [v for v in values if v == v] + [0.0, 5e-324, -5e-324, 1.0, 2.0, 2.0**-1022, 1e308, float("inf")]
    values += [x * (1 + k * 2.0**-52) for x in (0.5, 1.0, 3.0, 1e-9, 4e5) for k in (-1, 1, 2)]
    df = spark.createDataFrame([(v,) for v in set(values)], "value double")
    rows = df.select("value", *order_digits(F.col("value"))).collect()
    ordered = sorted(rows, key=lambda r: r.value)
    keys = [tuple(row[d] for d in DIGITS) for row in ordered]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


def test_quantile_of_values_close_together(spark):
    """A million distinct amounts within a thousandth: no cell that is put in order grows with them."""
    df = spark.range(1_000_000).select((F.lit(1_000_000.0) + F.col("id") * 0.0009).alias("amount"))
    assert exact_quantile(df, "amount", 0.95).first().threshold == pytest.approx(1_000_000 + 949_999 * 0.0009)
    top = df.select(*order_digits(F.col("amount"))).groupBy(DIGITS[0]).count().count()
    assert top < 1000
