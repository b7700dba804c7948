"""Session settings used by the tests, the bench and the jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "txnrisk",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with adaptive execution on, UTC dates and no web page.

    On a cluster leave ``shuffle_partitions`` unset and size the shuffle with
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum``: adaptive execution
    merges small partitions and splits skewed ones from there.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # The call site of every column expression is of use only in a debugger.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
