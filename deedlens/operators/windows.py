"""Group summaries, shares, ranks and yearly averages.

Where a window with DISTINCT says the same as a GROUP BY, the GROUP BY is used:
it combines rows before the shuffle, so a group with a third of all rows costs
one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deedlens.functions.scalars import percent


def group_summary(df: DataFrame, by: Sequence[str], count: str, maximum: str) -> DataFrame:
    """Per group: non-null ``count`` values as ``n`` and the largest ``maximum`` as ``max_value``."""
    return df.groupBy(*by).agg(F.count(count).alias("n"), F.max(maximum).alias("max_value"))


def percent_of_total(df: DataFrame, column: str, out: str = "percentage", digits: int = 2) -> DataFrame:
    """Each row's percentage of the column total.

    The total is a scalar subquery over the same plan, so no row leaves its
    partition; a window without partition keys would move all rows to one task.
    """
    whole = df.agg(F.sum(column).alias("whole")).scalar()
    return df.withColumn(out, percent(F.col(column), whole, digits))


def dense_rank_top(df: DataFrame, column: str, k: int, out: str = "rank") -> DataFrame:
    """Rows whose dense rank by ``column``, highest first, is at most ``k``.

    Ties may make that more than ``k`` rows. Only the ``k`` highest distinct
    values are numbered in one task; all rows then join that list, so a long tie
    stays spread out. The list has at most ``k`` rows, hence the broadcast. The
    frame is read twice: hand over a stored one if it is costly to compute.
    """
    values = df.select(column).distinct().orderBy(F.desc_nulls_last(column)).limit(k)
    ranked = values.select(
        F.col(column).alias("_value"),
        F.row_number().over(Window.orderBy(F.desc_nulls_last(column))).alias(out),
    )
    return df.join(F.broadcast(ranked), F.col(column).eqNullSafe(F.col("_value"))).drop("_value")


def yearly_average(df: DataFrame, date: str, region: str, columns: Mapping[str, str]) -> DataFrame:
    """Rounded averages per year and region; ``columns`` maps price columns to output names."""
    return (
        df.groupBy(F.year(date).alias("year"), F.col(region).alias("region"))
        .agg(*[F.round(F.avg(source)).alias(target) for source, target in columns.items()])
        .orderBy("year", "region")
    )
