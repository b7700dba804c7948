"""Row numbers over any number of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Leading hex digits of the order that make a cell: 4096 cells.
CELL_DIGITS = 3


def numbered(df: DataFrame, order: str, ties: Sequence[str | Column] = (), name: str = "rank") -> DataFrame:
    """Add each row's place, from 0, in the order of a column of evenly spread hex digits, such as an md5.

    A prefix count: rows are numbered inside the cell of their first digits, and the sizes of the cells, a table of at
    most 4096 rows, tell how many rows lie before each cell. No task orders more than a cell.
    """
    cell = F.substring(order, 1, CELL_DIGITS)
    sizes = df.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("cell_start"))
    inside = F.row_number().over(Window.partitionBy("cell").orderBy(order, *ties)) - 1
    # The cells are at most 4096 rows.
    placed = df.withColumn("cell", cell).withColumn("inside", inside).join(F.broadcast(starts), "cell")
    return placed.withColumn(name, F.col("cell_start") + F.col("inside")).drop("cell", "inside", "cell_start")
