"""CSV in, tables out."""

import datetime as dt
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.rows import transactions
from txnrisk.plans.tables import RunTables
from txnrisk.schemas import RUN_DAY, RUN_TIMESTAMP, TABLES, TRANSACTIONS
from txnrisk.sources.tables import (
    append_log_row,
    discard,
    drop_tables,
    ensure_tables,
    materialize,
    read_table,
    scratch,
    shared_dir,
    write_append,
    write_replace,
)
from txnrisk.sources.transactions_csv import read_transactions_csv


ROOT = Path(__file__).parent.parent


@pytest.fixture()
def tables(spark):
    drop_tables(spark)
    ensure_tables(spark)
    return spark


def _summary(spark, day, total):
    names = TABLES["reports.daily_summary"].names
    row = (dt.datetime(2024, 1, day, 6), total, 0, 0, 0, total, 0.0, 0.1, "m")
    return spark.createDataFrame([row], TABLES["reports.daily_summary"]).select(*names)


def test_csv_round_trip(spark, tmp_path):
    raw = RunTables(spark, SMALL).raw
    raw.write.csv(f"{tmp_path}/csv", header=True)
    again = read_transactions_csv(spark, f"{tmp_path}/csv")
    assert again.schema == TRANSACTIONS
    assert again.exceptAll(raw).count() == 0 and again.count() == raw.count()


def test_csv_columns_are_taken_by_position(spark, tmp_path):
    path = tmp_path / "renamed.csv"
    path.write_text("a,b,c,d,e,f,g,h,i,j,k\n1,PAYMENT,2.5,C1,,0,M1,0,0,1,0\n")
    row = read_transactions_csv(spark, str(path)).first()
    assert (row.step, row.amount, row.oldbalanceOrg, row.isFraud) == (1, 2.5, None, 1)


def test_csv_with_a_bad_value_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(",".join(TRANSACTIONS.names) + "\none,PAYMENT,2.5,C1,0,0,M1,0,0,1,0\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        read_transactions_csv(spark, str(path)).collect()


def test_tables_have_their_schema_and_are_kept(tables):
    for name, schema in TABLES.items():
        table = read_table(tables, name)
        stored = [f for f in table.schema.fields if f.name != RUN_DAY]
        assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in schema]
        assert (RUN_DAY in table.columns) == (name in RUN_TIMESTAMP)
        assert table.isEmpty()
    append_log_row(tables, "raw.ingestion_log", (dt.datetime(2024, 1, 1), "t", "SUCCESS", 1))
    ensure_tables(tables)
    assert read_table(tables, "raw.ingestion_log").count() == 1


def test_replace(tables):
    for rows in (({}, {"step": 2}), ({"step": 3},)):
        write_replace(transactions(tables, *rows), "raw.transactions")
        assert read_table(tables, "raw.transactions").count() == len(rows)
    assert read_table(tables, "raw.transactions").schema == TRANSACTIONS


def test_a_write_that_fails_leaves_the_old_rows(tables):
    write_replace(transactions(tables, {}, {"step": 2}), "raw.transactions")
    reading = read_table(tables, "raw.transactions")
    broken = transactions(tables, *[{"step": i} for i in range(50)]).withColumn(
        "step", F.when(F.col("step") == 40, F.raise_error(F.lit("lost"))).otherwise(F.col("step")).cast("bigint")
    )
    with pytest.raises(Exception, match="lost"):
        write_replace(broken, "raw.transactions")
    assert read_table(tables, "raw.transactions").count() == 2
    write_replace(read_table(tables, "raw.transactions").where("step = 2"), "raw.transactions")
    assert read_table(tables, "raw.transactions").count() == 1
    assert reading.count() == 2  # a query that began before still has its version


def test_a_process_killed_in_a_write_leaves_the_old_rows(tables):
    """The rows are written but not committed when the process ends; a new process reads the old ones."""
    write_replace(transactions(tables, {}, {"step": 2}), "raw.transactions")
    run = """
import os
from txnrisk.sources import tables
tables._commit = lambda *args: os._exit(9)
tables.write_replace(tables.read_table(spark, "raw.transactions").unionByName(tables.read_table(spark, "raw.transactions")), "raw.transactions")
"""
    assert in_other_process(tables, run).returncode == 9
    assert read_table(tables, "raw.transactions").count() == 2
    found = in_other_process(tables, "print('rows', read_table(spark, 'raw.transactions').count())")
    assert "rows 2" in found.stdout


def in_other_process(spark, code):
    """Run code in a new process with a session over the same warehouse."""
    start = f"""
from txnrisk.session import build_session
from txnrisk.sources.tables import *
spark = build_session(master="local[2]", shuffle_partitions=2, **{{
    "spark.sql.warehouse.dir": {spark.conf.get("spark.sql.warehouse.dir")!r},
    "spark.checkpoint.dir": {spark.conf.get("spark.checkpoint.dir")!r},
}})
ensure_tables(spark)
"""
    return subprocess.run([sys.executable, "-c", start + code], capture_output=True, text=True, timeout=300, cwd=ROOT)


def test_a_second_process_finds_the_tables(tables):
    write_replace(transactions(tables, {}, {"step": 2}), "raw.transactions")
    for day, total in ((1, 5), (2, 6)):
        write_append(_summary(tables, day, total), "reports.daily_summary")
    run = """
import datetime as dt
print("rows", read_table(spark, "raw.transactions").count())
print("days", sorted(r.run_day.day for r in read_table(spark, "reports.daily_summary").collect()))
write_append(read_table(spark, "reports.daily_summary").where("run_day = DATE '2024-01-01'").drop("run_day"), "reports.daily_summary", mode="append")
write_replace(read_table(spark, "raw.transactions").where("step = 2"), "raw.transactions")
append_log_row(spark, "raw.ingestion_log", (dt.datetime(2024, 1, 1), "t", "SUCCESS", 1))
"""
    found = in_other_process(tables, run)
    assert "rows 2" in found.stdout and "days [1, 2]" in found.stdout, found.stderr[-3000:]
    # What the other process wrote is seen here.
    assert read_table(tables, "raw.transactions").count() == 1
    assert read_table(tables, "raw.ingestion_log").count() == 1
    assert sorted(r.run_day.day for r in read_table(tables, "reports.daily_summary").collect()) == [1, 1, 2]


def test_tables_of_another_kind_are_left_alone(spark):
    drop_tables(spark)
    transactions(spark, {}).write.saveAsTable("raw.transactions")
    with pytest.raises(RuntimeError, match="was not made here"):
        ensure_tables(spark)
    assert spark.read.table("raw.transactions").count() == 1
    drop_tables(spark)


def test_replace_casts_to_the_declared_types(tables):
    loose = transactions(tables, {}).withColumns(
        {"step": F.col("step").cast("int"), "amount": F.col("amount").cast("decimal(10,2)")}
    )
    write_replace(loose.select(*reversed(loose.columns)), "staging.transactions_clean")
    assert read_table(tables, "staging.transactions_clean").schema == TRANSACTIONS


def test_append_by_name_and_by_position(tables):
    row = tables.createDataFrame(
        [("SUCCESS", 7, dt.datetime(2024, 1, 1), "t")],
        "status string, row_count bigint, run_date timestamp, table_name string",
    )
    write_append(row, "raw.ingestion_log")
    by_position = row.select("run_date", "table_name", "status", "row_count").toDF("a", "b", "c", "d")
    write_append(by_position, "raw.ingestion_log", by="position")
    assert read_table(tables, "raw.ingestion_log").distinct().count() == 1
    assert read_table(tables, "raw.ingestion_log").count() == 2
    with pytest.raises(ValueError):
        write_append(by_position.drop("d"), "raw.ingestion_log", by="position")
    with pytest.raises(ValueError):
        write_append(row, "raw.ingestion_log", mode="replace_run_date")


def test_second_run_on_a_day_replaces_only_that_day(tables):
    name = "reports.daily_summary"
    for day, total in ((1, 5), (2, 6), (2, 8)):
        write_append(_summary(tables, day, total), name)
    totals = {r.run_day.day: r.total_transactions for r in read_table(tables, name).collect()}
    assert totals == {1: 5, 2: 8}


def test_an_empty_second_run_empties_its_day(tables):
    name = "reports.daily_summary"
    for day in (1, 2):
        write_append(_summary(tables, day, 5), name, run_date=dt.date(2024, 1, day))
    write_append(_summary(tables, 2, 5).where("false"), name, run_date=dt.date(2024, 1, 2))
    assert [r.run_day.day for r in read_table(tables, name).collect()] == [1]


def test_second_run_on_a_day_can_be_added(tables):
    name = "reports.daily_summary"
    for total in (6, 8):
        write_append(_summary(tables, 2, total), name, mode="append")
    assert read_table(tables, name).count() == 2


def test_intermediate_tables_go_to_the_configured_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = materialize(spark.range(5), "numbers")
    assert df.count() == 5
    assert df.inputFiles()[0].startswith("file:" + spark.conf.get("spark.checkpoint.dir")) or df.inputFiles()[
        0
    ].startswith("file://" + spark.conf.get("spark.checkpoint.dir"))


def test_scratch_results_last_as_long_as_the_run(spark, tmp_path, monkeypatch):
    folder = tmp_path / "shared"
    monkeypatch.setattr("txnrisk.sources.tables.shared_dir", lambda _: str(folder))
    with scratch(spark):
        first = materialize(spark.range(5), "first")
        second = materialize(first.where("id > 2"), "second")
        discard(first)
        assert second.count() == 2  # its files are there to be read again
        with scratch(spark):
            inner = materialize(second, "inner")
            assert inner.count() == 2
        assert len(list(folder.glob("scratch-*/*"))) == 1
        with pytest.raises(ValueError):
            with scratch(spark):
                materialize(second, "failed")
                raise ValueError
        assert len(list(folder.glob("scratch-*"))) == 1
    assert list(folder.iterdir()) == []
