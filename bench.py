"""Wall time of the headline queries: one JSON line.

Queries run from raw rows to their result, planning included, into a sink that discards the
rows. Each query runs once to warm up and then BENCH_RUNS times, of which the best counts;
training runs once. The full-size part runs the jobs once, from a CSV load to the dashboards,
on repeated events.

    BENCH_SF_DIR    folder of Parquet tables (default /root/testdata/sf0.1)
    BENCH_CPUS      local cores (default 8)
    BENCH_RUNS      counted runs per query (default 1)
    BENCH_REPEAT    copies of the events for the full-size run (default 60: 6 million events at
                    sf0.1); 0 leaves it out
"""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.operators import dashboards
from txnrisk.operators.models import split_by_step, train_logistic
from txnrisk.plans import jobs
from txnrisk.plans.registry import all_queries
from txnrisk.plans.tables import RunTables
from txnrisk.session import build_session
from txnrisk.sources.tables import ensure_tables, read_table
from txnrisk.values import LOGISTIC

HEADLINE = (
    "load_stats",
    "validation_log_rows",
    "clean_transactions",
    "large_amount_threshold",
    "build_features",
    "kmeans_assign",
    "evaluate_classifier",
    "fraud_predictions",
    "fraud_predictions_rejoined",
    "high_risk_alerts",
    "risk_level_hit_rate",
    "daily_risk_trend",
    "alert_queue",
    "top_risk_accounts",
    "model_comparison",
    "fraud_rate_heatmap",
)
# Training and what was timed under these names from the start: the evaluation of the fitted model.
TRAINING = {
    "train_logistic": "train_logistic_evaluated",
    "train_random_forest": "train_random_forest",
    "train_boosted_tree": "train_boosted_tree_evaluated",
    "train_kmeans": "train_kmeans_clusters",
}
# Dashboard queries over the tables that the jobs have written.
REPORTS = {
    "risk_distribution": (dashboards.risk_distribution, "reports.fraud_predictions"),
    "fraud_by_type": (dashboards.fraud_by_type, "reports.fraud_predictions"),
    "score_histogram": (dashboards.score_histogram, "reports.fraud_predictions"),
    "amount_vs_score": (dashboards.amount_vs_score, "reports.fraud_predictions"),
    "top_risk_accounts": (dashboards.top_risk_accounts, "reports.high_risk_alerts"),
    "alerts_by_hour": (dashboards.alerts_by_hour, "reports.high_risk_alerts"),
    "daily_risk_trend": (dashboards.daily_risk_trend, "reports.daily_summary"),
    "fraud_rate_heatmap": (dashboards.fraud_rate_heatmap, "features.transaction_features"),
}
RUN = dt.datetime(2024, 1, 30, 6, 0)


def seconds(query, spark: SparkSession, folder: str) -> float:
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def best_of(names, spark: SparkSession, folder: str, runs: int) -> dict[str, float]:
    queries = all_queries()
    times = {}
    for name in names:
        seconds(queries[name], spark, folder)
        times[name] = round(min(seconds(queries[name], spark, folder) for _ in range(runs)), 3)
    return times


def repeat_events(spark: SparkSession, folder: str, copies: int, target: str) -> DataFrame:
    """The events ``copies`` times over, with ids and users of their own."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    top = events.agg(F.max("event_id"), F.max("user_id")).first()
    repeated = events.repartition(24).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    repeated.withColumns(
        {
            "event_id": F.col("event_id") + (F.col("copy") - 1) * (top[0] + 1),
            "user_id": F.col("user_id") + (F.col("copy") - 1) * (top[1] + 1),
        }
    ).drop("copy").write.parquet(f"{target}/events.parquet")
    return spark.read.parquet(f"{target}/events.parquet")


def run_jobs(spark: SparkSession, folder: str, work: str) -> dict[str, float]:
    """Time of each job over named tables, then of dashboard queries on what they wrote."""
    RunTables(spark, folder).raw.write.csv(f"{work}/csv", header=True)
    ensure_tables(spark)
    times = {}

    def timed(name, action):
        started = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - started, 3)

    def fit():
        training, _ = split_by_step(read_table(spark, "features.transaction_features"))
        train_logistic(training).write().overwrite().save(f"{work}/models/{LOGISTIC}")

    timed("ingest", lambda: jobs.ingest(spark, f"{work}/csv", RUN))
    timed("preprocess", lambda: jobs.preprocess(spark, RUN).collect())
    timed("engineer_features", lambda: jobs.engineer_features(spark, RUN).collect())
    timed("train_logistic", fit)
    timed("score_day", lambda: jobs.score_day(spark, RUN, f"{work}/models").collect())
    for name, (report, table) in REPORTS.items():
        timed(name, lambda: report(read_table(spark, table)).collect())
    return times


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    copies = int(os.environ.get("BENCH_REPEAT", "60"))
    work = tempfile.mkdtemp(prefix="bench-")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        **{
            "spark.driver.memory": "16g",
            "spark.sql.files.maxPartitionBytes": "16m",
            "spark.sql.warehouse.dir": f"{work}/warehouse",
            "spark.checkpoint.dir": f"{work}/shared",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = best_of(HEADLINE, spark, folder, runs)
    trainers = all_queries()
    times.update({name: round(seconds(trainers[query], spark, folder), 3) for name, query in TRAINING.items()})
    result = {
        "metric": "total wall time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(os.path.basename(os.path.normpath(folder)).removeprefix("sf")),
    }
    if copies:
        rows = repeat_events(spark, folder, copies, f"{work}/full").count()
        spark.conf.set("spark.sql.shuffle.partitions", str(2 * cpus))
        result["full_size"] = {"events": rows, "jobs": run_jobs(spark, f"{work}/full", work)}
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
