"""The table writers and the gates as queries: write what a run would, and return what can be read back.

They work on tables of their own, in the shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.operators import quality
from txnrisk.plans.tables import AS_OF, RunTables, run_ts
from txnrisk.schemas import RUN_DAY, RUN_TIMESTAMP, TABLES
from txnrisk.sources.files import delete
from txnrisk.sources.tables import (
    append_log_row,
    databases_named,
    drop_tables,
    ensure_tables,
    materialize,
    read_table,
    shared_dir,
    write_append,
    write_replace,
)

PREFIX = "trial_"


@contextmanager
def trial_tables(spark: SparkSession) -> Iterator[None]:
    """Empty tables in databases of their own in the shared folder, removed at the end."""
    databases = sorted({name.split(".")[0] for name in TABLES})
    root = f"{shared_dir(spark)}/{PREFIX}tables-{uuid.uuid4().hex}"
    with databases_named(PREFIX):
        for name in databases:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {PREFIX}{name} LOCATION '{root}/{name}.db'")
        drop_tables(spark)
        ensure_tables(spark)
        try:
            yield
        finally:
            drop_tables(spark)
            for name in databases:
                spark.sql(f"DROP DATABASE {PREFIX}{name}")
            delete(spark, root)


def _read_back(t: RunTables, name: str) -> DataFrame:
    """A copy of a table that outlives it; the run's timestamp as a date."""
    rows = read_table(t.spark, name).drop(RUN_DAY)
    stamp = RUN_TIMESTAMP.get(name, "run_date")
    if stamp in rows.columns:
        rows = rows.withColumn(stamp, F.to_date(stamp))
    return materialize(rows, "read-back")


def replaced(t: RunTables) -> DataFrame:
    """A table replaced by some of its own rows."""
    with trial_tables(t.spark):
        write_replace(t.raw, "raw.transactions")
        write_replace(read_table(t.spark, "raw.transactions").where("step <= 100"), "raw.transactions")
        return _read_back(t, "raw.transactions")


def found_again(t: RunTables) -> DataFrame:
    """A table that a new catalog finds in its folder."""
    with trial_tables(t.spark):
        write_replace(t.clean, "staging.transactions_clean")
        for name in TABLES:
            t.spark.sql(f"DROP TABLE {PREFIX}{name}")  # the files stay
        ensure_tables(t.spark)
        return _read_back(t, "staging.transactions_clean")


def appended(t: RunTables) -> DataFrame:
    """Daily summaries written day by day, the last day twice."""
    with trial_tables(t.spark):
        summaries = materialize(t.past_summaries.withColumn("summary_date", F.col("summary_date").cast("timestamp")), "summaries")
        write_append(summaries, "reports.daily_summary")
        again = summaries.where(F.to_date("summary_date") == F.lit(AS_OF))
        write_append(again, "reports.daily_summary", run_date=AS_OF)
        return _read_back(t, "reports.daily_summary")


def logged(t: RunTables) -> DataFrame:
    """A log row of literal values, as the ingestion writes it."""
    stats = quality.load_stats(t.raw).first()
    stamp = t.spark.range(1).select(run_ts().cast("timestamp")).first()[0]
    with trial_tables(t.spark):
        append_log_row(t.spark, "raw.ingestion_log", (stamp, "raw.transactions", "SUCCESS", stats.total_rows))
        return _read_back(t, "raw.ingestion_log")


def _passes(gate: Callable[[], object]) -> bool:
    try:
        return gate() is not False
    except quality.GateError:
        return False


def _verdicts(t: RunTables, gate: Callable[[DataFrame], object], cases: dict[str, DataFrame]) -> DataFrame:
    rows = [(name, _passes(lambda rows=rows: gate(rows))) for name, rows in cases.items()]
    return t.spark.createDataFrame(rows, "rows_checked string, passes boolean")


def load_gate(t: RunTables) -> DataFrame:
    """Whether loads of all rows, of none, of fraud alone and of each type pass."""
    raw = materialize(t.raw, "raw")
    cases = {"all": raw, "none": raw.limit(0), "fraud": raw.where("isFraud = 1")}
    cases |= {name: raw.where(F.col("type") == name) for name in ("PAYMENT", "TRANSFER", "CASH_OUT", "DEBIT", "CASH_IN")}
    return _verdicts(t, lambda rows: quality.gate_load(quality.load_stats(rows)), cases)


def non_empty_gate(t: RunTables) -> DataFrame:
    """Whether there are rows of each hour of the day, and after the last step."""
    raw = materialize(t.raw.select("step"), "steps")
    cases = {f"hour {h}": raw.where(F.col("step") % 24 == h) for h in (0, 5, 23)} | {"later": raw.where("step > 100000")}
    return _verdicts(t, quality.gate_non_empty, cases)


def feature_gate(t: RunTables) -> DataFrame:
    """Whether the features pass as they are, and with a balance below zero in the ratio."""
    features = materialize(t.features, "features")
    debts = features.withColumn(
        "amount_to_balance_ratio",
        F.when(F.col("orig_balance_zero_after") == 1, -F.col("amount")).otherwise(F.col("amount_to_balance_ratio")),
    )
    return _verdicts(t, lambda rows: quality.gate_features(quality.feature_checks(rows)), {"all": features, "debts": debts})


TRIALS = {
    "write_replace": replaced,
    "ensure_tables": found_again,
    "write_append": appended,
    "append_log_row": logged,
    "gate_load": load_gate,
    "gate_non_empty": non_empty_gate,
    "gate_features": feature_gate,
}
