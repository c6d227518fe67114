"""Global positions and running totals without a single-task window.

Both sort by ranges over all tasks, store the sorted rows once, and add to each
row what lies in the partitions before its own. Only one row per partition goes
through a window of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deedlens.sources.scratch import stored

# monotonically_increasing_id keeps the partition above and the row below this bit.
_ROW_BITS = 33


def _sorted_rows(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    numbered = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    return stored(numbered, "sorted").withColumn("_part", F.shiftright("_id", _ROW_BITS))


def _with_offsets(rows: DataFrame, amount: Column) -> DataFrame:
    """Add ``_before``: the sum of ``amount`` over all earlier partitions.

    The list has one row per partition, so its size is that of the task list,
    not of the data: it is broadcast.
    """
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_part")
        .agg(F.sum(amount).alias("_amount"))
        .select("_part", F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias("_before"))
    )
    return rows.join(F.broadcast(offsets), "_part")


def global_position(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Number all rows from zero in ``order``, which must leave no ties."""
    rows = _with_offsets(_sorted_rows(df, order), F.lit(1))
    row = F.col("_id").bitwiseAND(F.lit(2**_ROW_BITS - 1))
    return rows.withColumn(out, F.col("_before") + row).drop("_id", "_part", "_before")


def running_total(df: DataFrame, order: Sequence[Column], column: str, out: str) -> DataFrame:
    """Sum of ``column`` over this and all earlier rows in ``order``."""
    rows = _with_offsets(_sorted_rows(df, order), F.col(column))
    inside = Window.partitionBy("_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.col("_before") + F.sum(column).over(inside)).drop("_id", "_part", "_before")
