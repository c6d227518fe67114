"""Joins between titles, reports and the price index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedlens.functions.scalars import equals_ignore_case
from deedlens.functions.text import quoted
from deedlens.sources.scratch import stored


def missing_from(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``; a NULL key is kept.

    One shuffle of the key column of ``other``; AQE splits a frequent key of ``df``.
    """
    keys = other.select(F.col(quoted(key)).alias("_key")).filter(F.col("_key").isNotNull())
    return df.join(keys, F.col(quoted(key)) == F.col("_key"), "left_anti")


def ci_join(left: DataFrame, right: DataFrame, left_col: str, right_col: str) -> DataFrame:
    """Inner join of many rows on the left with a dimension on the right, ignoring case.

    The dimension is stored first: below the broadcast threshold the left rows
    stay where they are, above it AQE splits the left rows of a frequent key.
    """
    matches = F.lower(F.col(f"l.{left_col}")) == F.lower(F.col(f"r.{right_col}"))
    return left.alias("l").join(stored(right, "dimension").alias("r"), matches)


def max_row_join(
    groups: DataFrame,
    base: DataFrame,
    group: str,
    maximum: str,
    value: str,
    columns: Sequence[str],
    also_on: Sequence[str] = (),
) -> DataFrame:
    """Base rows that hold their group's maximum; ties give several rows.

    The join is on the group name and the value only. ``also_on`` names further
    columns, for instance to keep equally named groups apart. The list of groups
    is worked out once; while it is small, ``base`` is filtered by it in place.
    """
    groups = stored(groups, "groups")
    # Join keys are renamed so that either side may use the same names.
    keys = {group: "_group", value: "_value", **{name: f"_also_{name}" for name in also_on}}
    wanted = base.select(
        *[F.col(old).alias(new) for old, new in keys.items()],
        *[F.col(c).alias(f"base_{c}") for c in columns],
    )
    matches = (F.col(group) == F.col("_group")) & (F.col(maximum) == F.col("_value"))
    for name in also_on:
        matches = matches & F.col(name).eqNullSafe(F.col(f"_also_{name}"))
    return groups.join(wanted, matches).drop(*keys.values())


def combine(
    good: DataFrame,
    bad: DataFrame,
    county: str,
    region: str,
    good_region: str = "RegionName",
    bad_region: str = "District",
    bad_county: str = "County",
    out: str = "index_rows",
) -> DataFrame:
    """Every distinct title of one region with the distinct index rows of that region as a sorted array.

    One row per title: what pairs both sides is the region alone, so the pairs
    themselves say no more than the two lists. The array holds one index row
    per month of the region, all columns of ``good``.
    """
    rows = F.array_sort(F.collect_set(F.struct(*[F.col(quoted(c)) for c in good.columns])))
    # The list is one value, not a side of a join: nothing is shuffled on the one region.
    listed = good.filter(equals_ignore_case(F.col(good_region), region)).agg(rows.alias(out)).scalar()
    picked = bad.filter(
        equals_ignore_case(F.col(bad_county), county) & equals_ignore_case(F.col(bad_region), region)
    ).distinct()
    joined = picked.withColumns({"region_name": F.lower(F.lit(region)), out: listed}).filter(F.size(out) > 0)
    return joined.select("region_name", *picked.columns, out)
