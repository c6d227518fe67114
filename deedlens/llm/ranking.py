"""Ranks within groups of any size, without a group in one task and without sampling the input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def rank_in_group(rows: DataFrame, group: str, draw: str, ties: Sequence[str], buckets: int) -> DataFrame:
    """Add ``rank`` (from 0) in the order of ``draw`` and ``ties`` within the group, and ``in_group``, its size.

    ``draw`` must be spread evenly over [0, 2**63), as a hash is. Its range is
    cut into ``buckets`` equal parts; a row's rank is the number of rows of its
    group in earlier parts plus its number in its own, and what the shuffle
    deals out are parts of groups. A hot group is spread over all tasks. The
    rows are read twice, so they should be a stored table. NULL is a group.
    """
    width = 2**63 // buckets + 1
    rows = rows.withColumn("_part", F.expr(f"`{draw}` div {width}"))
    whole = Window.partitionBy("_of_group")
    earlier = whole.orderBy("_of_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        rows.groupBy(F.col(group).alias("_of_group"), F.col("_part").alias("_of_part"))
        .agg(F.count("*").alias("_n"))
        .select(
            "_of_group",
            "_of_part",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_n").over(whole).alias("in_group"),
        )
    )
    within = Window.partitionBy(group, "_part").orderBy(draw, *ties)
    same = F.col(group).eqNullSafe(F.col("_of_group")) & (F.col("_part") == F.col("_of_part"))
    return (
        rows.withColumn("_number", F.row_number().over(within))
        .join(counts, same)
        .withColumn("rank", F.col("_before") + F.col("_number") - 1)
        .drop("_part", "_of_part", "_of_group", "_number", "_before")
    )
