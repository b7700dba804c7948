"""The named tables: creation, reading and the writers.

A table lies in a folder of its own below its database's folder, in one subfolder per version. A version counts from
the moment its marker file exists, which is made after all its rows are written, and the newest such version is
the table. So replacing a table never takes away the old rows before the new ones are there, and any
process that knows the warehouse folder finds all tables again.
"""

from __future__ import annotations

import datetime as dt
import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from txnrisk.schemas import RUN_DAY, RUN_TIMESTAMP, TABLES
from txnrisk.sources.files import children, delete, exists, touch

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
MARKER = "_committed"
VERSION = re.compile(r"/v[0-9]{8}-[0-9a-f]{32}$")
#: Versions that are kept, so that queries on the one before can end.
KEPT_VERSIONS = 2


_prefix: ContextVar[str] = ContextVar("prefix", default="")


@contextmanager
def databases_named(prefix: str):
    """Let all functions here work on databases of their own, whose names begin with the prefix."""
    token = _prefix.set(prefix)
    try:
        yield
    finally:
        _prefix.reset(token)


def _in_catalog(name: str) -> str:
    return _prefix.get() + name


def _root(spark: SparkSession, name: str) -> str:
    database, table = _in_catalog(name).split(".")
    return f"{spark.catalog.getDatabase(database).locationUri}/{table}"


def _versions(spark: SparkSession, name: str) -> list[str]:
    """The committed versions of a table, oldest first."""
    root = _root(spark, name)
    return [f"{root}/{v}" for v in sorted(children(spark, root)) if exists(spark, f"{root}/{v}/{MARKER}")]


def _next_version(spark: SparkSession, name: str) -> str:
    """A folder for a new version; whatever an ended job left in it is no concern, as its name is new."""
    numbers = [int(v.rsplit("/v", 1)[1].split("-")[0]) for v in _versions(spark, name)]
    return f"{_root(spark, name)}/v{max(numbers, default=0) + 1:08d}-{uuid.uuid4().hex}"


def _commit(spark: SparkSession, name: str, path: str) -> None:
    """Make a written version the table, and remove versions that nobody can be reading any more."""
    touch(spark, f"{path}/{MARKER}")
    _point(spark, name, path)
    for old in _versions(spark, name)[:-KEPT_VERSIONS]:
        delete(spark, old)


def _location(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(_in_catalog(name)):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {_in_catalog(name)}").where("col_name = 'Location'").first()
    return described.data_type


def _point(spark: SparkSession, name: str, path: str) -> None:
    """Let the catalog's table be a version, which is what other queries of the session see."""
    known = _location(spark, name)
    if known is not None and known.rsplit("/", 1)[1] == path.rsplit("/", 1)[1]:
        return
    if known is not None and not VERSION.search(known):
        raise RuntimeError(f"{_in_catalog(name)} at {known} was not made here; move it before its rows could be lost")
    table = _in_catalog(name)
    if known is not None and name not in RUN_TIMESTAMP:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # the files of an external table stay
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in TABLES[name])
        by_day = f", {RUN_DAY} DATE) USING parquet PARTITIONED BY ({RUN_DAY})" if name in RUN_TIMESTAMP else ") USING parquet"
        spark.sql(f"CREATE TABLE {table} ({columns}{by_day} LOCATION '{path}'")
        if name in RUN_TIMESTAMP:
            spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def ensure_tables(spark: SparkSession) -> None:
    """Find each of the eleven tables in the warehouse folder, or create it, empty, with its schema."""
    for name, schema in TABLES.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_in_catalog(name).split('.')[0]}")
        found = _versions(spark, name)
        if found:
            _point(spark, name, found[-1])
        else:
            _write_version(spark.createDataFrame([], schema), name)


def drop_tables(spark: SparkSession) -> None:
    """Remove the tables with their rows."""
    for name in TABLES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_in_catalog(name).split('.')[0]}")
        spark.sql(f"DROP TABLE IF EXISTS {_in_catalog(name)}")
        delete(spark, _root(spark, name))


def _write_version(df: DataFrame, name: str) -> None:
    spark = df.sparkSession
    path = _next_version(spark, name)
    writer = _with_run_day(df, name).write
    if name in RUN_TIMESTAMP:
        writer = writer.partitionBy(RUN_DAY)
    writer.parquet(path)
    _commit(spark, name, path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table with its declared columns, and the run day where it is stored by day.

    Another process may have replaced the table or added to it, so its newest version is looked up first.
    """
    _point(spark, name, _versions(spark, name)[-1])
    if name in RUN_TIMESTAMP:
        spark.catalog.recoverPartitions(_in_catalog(name))
    spark.catalog.refreshTable(_in_catalog(name))
    return spark.read.table(_in_catalog(name))


def _with_run_day(df: DataFrame, name: str) -> DataFrame:
    if name not in RUN_TIMESTAMP:
        return df
    return df.withColumn(RUN_DAY, F.to_date(RUN_TIMESTAMP[name]))


def _conform(df: DataFrame, name: str, by: str) -> DataFrame:
    """The declared columns in order, cast to the declared types."""
    schema = TABLES[name]
    if by == "position":
        if len(df.columns) != len(schema):
            raise ValueError(f"{name} has {len(schema)} columns, the query {len(df.columns)}")
        df = df.toDF(*schema.names)
    elif by != "name":
        raise ValueError(f"unknown column matching {by!r}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def write_replace(df: DataFrame, name: str) -> None:
    """Replace the whole table by the query result, which may read the table itself.

    The old rows stay readable until all new ones are written, also for queries that run by then.
    """
    _write_version(_conform(df, name, "name"), name)


def write_append(
    df: DataFrame,
    name: str,
    by: str = "name",
    mode: str | None = None,
    run_date: dt.date | None = None,
) -> None:
    """Add the query result to a table, columns matched by name or by position.

    Tables stored by run day are rerun safely: the result replaces the given run date, even
    when it is empty, or without one the days it contains. ``mode="append"`` adds to them
    instead. All other tables are appended to.
    """
    if mode is None:
        mode = "replace_run_date" if name in RUN_TIMESTAMP else "append"
    rows = _conform(df, name, by)
    _point(df.sparkSession, name, _versions(df.sparkSession, name)[-1])
    if mode == "append":
        _with_run_day(rows, name).write.insertInto(_in_catalog(name))
    elif mode != "replace_run_date" or name not in RUN_TIMESTAMP:
        raise ValueError(f"cannot write {name} in mode {mode!r}")
    elif run_date is None:
        with _dynamic_overwrite(df.sparkSession):
            _with_run_day(rows, name).write.insertInto(_in_catalog(name), overwrite=True)
    else:
        df.sparkSession.sql(
            f"INSERT OVERWRITE TABLE {_in_catalog(name)} PARTITION ({RUN_DAY} = DATE '{run_date}') "
            "SELECT * FROM {rows}",
            rows=rows,
        )


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """Let an overwrite touch only the partitions it writes, whatever the table was made with."""
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def append_log_row(spark: SparkSession, name: str, row: Row | dict | tuple) -> None:
    """Add one row of literal values."""
    write_append(spark.createDataFrame([row], TABLES[name]), name)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, from ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="txnrisk-"))
    return context.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative training cut its lineage in the shared folder."""
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession):
    """Keep intermediate results only as long as this lasts.

    Whatever is materialized inside goes to one folder in the shared folder, which is deleted at the end, also after an
    error. Until then all of it stays, so lost executors read it again. Results must be written or
    collected inside. An inner one deletes its own results only.
    """
    folder = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        delete(spark, folder)


def scratch_dir(spark: SparkSession) -> str:
    """Where intermediate results go: the folder of the innermost ``scratch``, or the shared folder itself."""
    return _scratch.get() or shared_dir(spark)


def materialize(df: DataFrame, label: str, outlast: bool = False) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back; to ``outlast`` a ``scratch`` around it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark) if outlast else scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a materialized result that nothing reads any more."""
    folders = {file.rsplit("/", 1)[0] for file in df.inputFiles()}
    for folder in folders:
        delete(df.sparkSession, folder)
