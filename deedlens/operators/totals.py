"""Grouped totals and price comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedlens.functions.scalars import equals_ignore_case, filled_text, in_units, percent, ratio


def group_counts(df: DataFrame, by: str, out: str = "n") -> DataFrame:
    """Count of ``by`` per value, so that the NULL group shows 0; smallest first."""
    return df.groupBy(by).agg(F.count(by).alias(out)).orderBy(F.asc(out), by)


def flagged_counts(df: DataFrame, by: str, label: str = "is_fraud", k: int | None = None) -> DataFrame:
    """Flagged rows per value, most first, ties by value; ``k`` keeps the top of the list."""
    counts = (
        df.filter(F.col(label) == 1)
        .groupBy(by)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_first(by))
    )
    return counts if k is None else counts.limit(k)


def group_totals(df: DataFrame, by: str, value: str, unit: int) -> DataFrame:
    """Per group: ``n_rows`` (NULL group: 0) and the sum of ``value`` in ``unit``, one digit."""
    return df.groupBy(by).agg(
        F.count(by).alias("n_rows"),
        in_units(F.sum(value), unit).alias("total"),
    )


def region_totals(df: DataFrame, by: str, value: str, unit: int = 1_000_000) -> DataFrame:
    """Totals of all named groups, largest count first."""
    named = df.filter(F.col(by).isNotNull())
    return group_totals(named, by, value, unit).orderBy(F.desc("n_rows"), by)


def top_totals(df: DataFrame, by: str, value: str, unit: int, k: int = 15) -> DataFrame:
    """The ``k`` groups with the largest sum; the NULL group takes part."""
    return (
        group_totals(df, by, value, unit)
        .orderBy(F.desc_nulls_last("total"), F.asc_nulls_first(by))
        .limit(k)
    )


def top_totals_within(
    df: DataFrame, by: str, value: str, unit: int, within: str, name: str, exclude: str, k: int = 15
) -> DataFrame:
    """:func:`top_totals` inside one parent area, one group left out."""
    inside = df.filter(equals_ignore_case(F.col(within), name) & (F.col(by) != exclude))
    return top_totals(inside, by, value, unit, k)


def price_ratio(
    good: DataFrame,
    bad: DataFrame,
    county: str | None = None,
    good_region: str = "RegionName",
    good_price: str = "AveragePrice",
    bad_county: str = "County",
    bad_district: str = "District",
    bad_price: str = "PricePaid",
) -> DataFrame:
    """Average title price against the average index price of the same area.

    Each side is averaged before the join. Within an area every title meets
    every index row equally often, so the averages are those of the joined
    rows, which are never built.
    """
    titles = bad.filter(filled_text(F.col(bad_district)))
    if county is not None:
        titles = titles.filter(equals_ignore_case(F.col(bad_county), county))
    left = titles.groupBy(F.col(bad_county).alias("county"), F.col(bad_district).alias("district")).agg(
        F.round(F.avg(bad_price)).alias("avg_title_price")
    )
    right = good.groupBy(F.col(good_region).alias("region")).agg(
        F.round(F.avg(good_price)).alias("avg_index_price")
    )
    compared = left.join(right, F.lower("district") == F.lower("region"))
    whole = F.floor(F.round(ratio(F.col("avg_title_price"), F.col("avg_index_price"))))
    return compared.select(
        "county", "district", "avg_title_price", "avg_index_price", whole.cast("bigint").alias("price_ratio")
    )


def top_price_ratios(ratios: DataFrame, counts: DataFrame, exclude: str, k: int = 15) -> DataFrame:
    """Price ratios with the number of titles per district, the ``k`` largest first.

    ``counts`` comes from :func:`group_counts`; the common column may differ in case.
    """
    return (
        ratios.join(counts, on="district")
        .filter(F.col("district") != exclude)
        .select("county", "district", "n", "avg_title_price", "avg_index_price", "price_ratio")
        .orderBy(F.desc("n"), "district", "county")
        .limit(k)
    )


def share_of_total(top: DataFrame, column: str, out: str = "percentage") -> DataFrame:
    """Each row's percentage of the sum over ``top``, for a report of any size: no window, no single task."""
    whole = top.agg(F.sum(column).alias("whole")).scalar()
    return top.withColumn("_whole", whole).withColumn(out, percent(F.col(column), F.col("_whole"), 1)).drop("_whole")


def global_ratio(good: DataFrame, bad: DataFrame, good_price: str, bad_price: str) -> DataFrame:
    """Sums of both sides and their ratio, from one aggregate over a union."""
    nothing = F.lit(None).cast("double")
    both = good.select(F.col(good_price).cast("double").alias("good"), nothing.alias("bad")).unionByName(
        bad.select(nothing.alias("good"), F.col(bad_price).cast("double").alias("bad"))
    )
    sums = both.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    return sums.select(
        F.round("good", 2).alias("good_total"),
        F.round("bad", 2).alias("bad_total"),
        F.round(ratio(F.col("bad"), F.col("good")), 2).alias("price_ratio"),
    )


def report_totals(report: DataFrame, count: str, total: str, per: int = 1000) -> DataFrame:
    """Sum of a report's counts, and of its totals in a unit ``per`` times larger."""
    larger: Column = F.round(F.sum(total) / F.lit(float(per)), 3)
    return report.agg(F.sum(count).alias("count_total"), larger.alias("value_total"))
