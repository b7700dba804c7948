"""Reading the given tables and writing intermediate ones to shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnrisk.sources.tables import discard, materialize

__all__ = ["bound_batches", "discard", "read", "stored"]

BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_DEFAULT = "67108864b"
BATCH_BYTES = 4 << 20


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    The folder is in ``spark.checkpoint.dir``, so the copy outlives any executor. ``discard`` deletes it, and so
    does the end of a ``scratch`` block around all of the work.
    """
    return materialize(df, label)


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of a batch that goes to Python, unless the session says how many.

    Batches are counted in rows otherwise, so long texts make large ones.
    """
    if spark.conf.get(BATCH_SETTING, None) in (None, BATCH_DEFAULT):
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
