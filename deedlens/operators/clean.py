"""Cleaning: rogue values, casts, dropped and all-null columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from deedlens.functions.scalars import finite
from deedlens.operators.profile import null_profile


def drop_rogue(df: DataFrame, column: str, values: Sequence[str], keep_nulls: bool = False) -> DataFrame:
    """Drop rows holding one of ``values``.

    By default a NULL goes too, as with SQL's ``<>``.
    """
    keep = ~F.col(column).isin(*values)
    if keep_nulls:
        keep = keep | F.col(column).isNull()
    return df.filter(keep)


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast columns; with ``strict=False`` text that does not fit turns into NULL."""
    casts = {
        name: F.col(name).cast(kind) if strict else F.col(name).try_cast(kind)
        for name, kind in types.items()
    }
    return df.withColumns(casts)


def all_null_columns(df: DataFrame, threshold: float = 100.0, rounded: bool = False) -> list[str]:
    """Columns whose share of NULLs reaches ``threshold`` percent.

    One aggregate job; what reaches the driver is one row per column. With
    ``rounded`` the share is first rounded to one digit, so 99.96 % counts as 100.
    """
    share = F.col("null_pct") if rounded else F.col("null_count") * 100.0 / F.col("row_count")
    hit = null_profile(df).filter((F.col("row_count") > 0) & (share >= threshold))
    return [row["column"] for row in hit.select("column").collect()]


def prune_null_columns(df: DataFrame, threshold: float = 100.0, rounded: bool = False) -> DataFrame:
    """Drop the columns that :func:`all_null_columns` finds; the others keep type and order."""
    return df.drop(*all_null_columns(df, threshold, rounded))


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select and rename columns for a report, in the order given."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def drop_non_finite(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows where a number is NULL, NaN or infinite."""
    keep = F.lit(True)
    for name in columns:
        keep = keep & finite(F.col(name)).isNotNull()
    return df.filter(keep)


def lacks_value(df: DataFrame, columns: Sequence[str]) -> Column:
    """True where one of ``columns`` is NULL or not a number; never NULL itself."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (FloatType, DoubleType))}
    lacking = F.lit(False)
    for name in columns:
        lacking = lacking | F.col(name).isNull()
        if name in floating:
            lacking = lacking | F.isnan(name)
    return lacking


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in all of ``columns``; the NULL tests reach the file scan."""
    return df.filter(~lacks_value(df, columns))
