"""Profiles: NULL shares, descriptive statistics, value counts, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from deedlens.functions.scalars import ratio
from deedlens.functions.text import literal, quoted, rows_of


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: rows, NULLs and their percentage, from one aggregate.

    The percentage is NULL for an empty frame. Highest share first.
    """
    counts = df.selectExpr(
        "count(1) AS row_count", *[f"count({quoted(c)}) AS filled_{i}" for i, c in enumerate(df.columns)]
    )
    structs = []
    for i, name in enumerate(df.columns):
        nulls = f"row_count - filled_{i}"
        structs.append(
            f"named_struct('column', {literal(name)}, 'row_count', row_count, 'null_count', {nulls}, "
            f"'null_pct', round(({nulls}) / nullif(row_count, 0) * 100, 1))"
        )
    return counts.selectExpr(rows_of(structs)).orderBy(F.desc("null_pct"), "column")


def null_profile_of(statistics: DataFrame) -> DataFrame:
    """The same profile from column statistics of the catalog; rows are not read."""
    share = F.round(F.col("null_count") / F.nullif("row_count", F.lit(0)) * 100, 1)
    return statistics.select("column", "row_count", "null_count", share.alias("null_pct")).orderBy(F.desc("null_pct"), "column")


def null_report(profile: DataFrame) -> DataFrame:
    """The profile as text lines: column, tab, percentage."""
    line = F.concat(F.col("column"), F.lit("\t"), F.col("null_pct").cast("string"), F.lit("%"))
    return profile.select(line.alias("column_null_percentage"))


def null_summary(profile: DataFrame, rounded: bool = False) -> DataFrame:
    """How many columns hold no value at all, as count and percentage."""
    if rounded:
        empty = F.col("null_pct") == 100.0
    else:
        empty = (F.col("row_count") > 0) & (F.col("null_count") == F.col("row_count"))
    return profile.agg(
        F.count(F.lit(1)).alias("columns"),
        F.count_if(empty).alias("empty_columns"),
    ).withColumn(
        "empty_pct", F.round(ratio(F.col("empty_columns"), F.col("columns")) * 100, 1)
    )


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns of a frame."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("columns", F.lit(len(df.columns)))


def describe_columns(df: DataFrame, digits: int = 2) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per column, one row each.

    Text columns have no mean or deviation; the extremes come as text, since
    one column holds those of numbers and of words.
    """
    numbers, texts = numeric_columns(df), string_columns(df)
    aggregates, structs = [], []
    for i, name in enumerate(numbers + texts):
        value = quoted(name)
        aggregates += [
            f"count({value}) AS n_{i}",
            f"cast(min({value}) AS string) AS lo_{i}",
            f"cast(max({value}) AS string) AS hi_{i}",
        ]
        mean = deviation = "cast(NULL AS double)"
        if name in numbers:
            aggregates += [f"avg({value}) AS m_{i}", f"stddev_samp({value}) AS s_{i}"]
            mean, deviation = f"round(m_{i}, {digits})", f"round(s_{i}, {digits})"
        structs.append(
            f"named_struct('column', {literal(name)}, 'value_count', n_{i}, 'mean', {mean}, "
            f"'stddev', {deviation}, 'min_value', lo_{i}, 'max_value', hi_{i})"
        )
    return df.selectExpr(*aggregates).selectExpr(rows_of(structs))


def unpivot_strings(df: DataFrame, columns: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Text columns as (column, value) rows, with ``keep`` columns beside them."""
    names = list(columns) if columns is not None else [c for c in string_columns(df) if c not in keep]
    return df.unpivot(
        ids=[F.col(quoted(c)) for c in keep],
        values=[F.col(quoted(c)) for c in names],
        variableColumnName="column",
        valueColumnName="value",
    )


def category_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Value counts of all text columns at once; NULL is a value of its own."""
    return unpivot_strings(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))


def histograms(df: DataFrame, columns: Sequence[str], bins: int = 20, by: str | None = None) -> DataFrame:
    """Counts in ``bins`` equal bins from minimum to maximum of each column, the last bin closed.

    Empty bins are listed with 0; NULL, NaN and infinite values are not counted.
    A column with a single value has it in the middle of a range of one. With
    ``by`` (a tag with few values, such as the name of a source) every tag is
    counted over the same bins. Two passes: one for all ranges, one for all counts.
    """
    tags = [quoted(by)] if by else []
    # NaN sorts above infinity, so this leaves out both.
    values = [
        f"CASE WHEN abs(cast({quoted(c)} AS double)) < double('Infinity') THEN cast({quoted(c)} AS double) END"
        for c in columns
    ]
    bounds = []
    for i, value in enumerate(values):
        # Half a unit around a single value, or what still changes a large one.
        half = f"if(min({value}) = max({value}), greatest(0.5D, abs(max({value})) * 1e-9D), 0.0D)"
        bounds.append(f"'lo_{i}', min({value}) - {half}, 'hi_{i}', max({value}) + {half}")
    ranges = df.selectExpr(f"named_struct({', '.join(bounds)}) AS bounds")
    bounded = df.selectExpr(*tags, *[f"{value} AS x_{i}" for i, value in enumerate(values)]).withColumn(
        "bounds", ranges.scalar()
    )
    long = bounded.selectExpr(
        *tags,
        rows_of(
            [
                f"named_struct('column', {literal(name)}, 'x', x_{i}, 'lo', bounds.lo_{i}, "
                f"'width', if(bounds.hi_{i} - bounds.lo_{i} < double('Infinity'), (bounds.hi_{i} - bounds.lo_{i}) / {bins}D, "
                f"bounds.hi_{i} / {bins}D - bounds.lo_{i} / {bins}D))"
                for i, name in enumerate(columns)
            ]
        ),
    )
    # Differences beyond the double limit are divided before they are taken.
    place = "if(x - lo < double('Infinity'), (x - lo) / width, x / width - lo / width)"
    counted = (
        long.filter("x IS NOT NULL")
        .withColumn("bin", F.expr(f"cast(least(floor({place}), {bins - 1}) AS int)"))
        .groupBy(*tags, "column", "lo", "width")
        .agg(*[F.expr(f"count_if(bin = {i}) AS bin_{i}") for i in range(bins)])
    )

    def edge(i: int) -> str:
        halves = f"lo + width * {i // 2}D + width * {i - i // 2}D"
        return f"if(width * {bins}D < double('Infinity'), lo + width * {i}D, {halves})"

    structs = [
        f"named_struct('bin', {i}, 'bin_start', {edge(i)}, 'bin_end', {edge(i + 1)}, 'n', bin_{i})"
        for i in range(bins)
    ]
    return counted.selectExpr(*tags, "column", rows_of(structs))


def histogram(df: DataFrame, column: str, bins: int = 20, by: str | None = None) -> DataFrame:
    """:func:`histograms` of one column."""
    return histograms(df, [column], bins, by).drop("column")


def histogram_overlay(
    original: DataFrame, synthetic: DataFrame, columns: Sequence[str], bins: int = 20
) -> DataFrame:
    """Histograms over two frames on shared bins, with a ``source`` column."""
    both = [
        df.select(F.lit(name).alias("source"), *[F.col(quoted(c)).cast("double").alias(c) for c in columns])
        for name, df in (("original", original), ("synthetic", synthetic))
    ]
    return histograms(both[0].unionByName(both[1]), columns, bins, by="source")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows, flagged rows, percentage and fraction of the flagged, in one aggregate."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(label) == 1).alias("flagged"),
        F.count_if(F.col(label) == 0).alias("unflagged"),
    )
    share = ratio(F.col("flagged"), F.col("total"))
    return counts.select(
        "total",
        "flagged",
        "unflagged",
        F.round(share * 100, 2).alias("flagged_pct"),
        share.alias("flagged_fraction"),
    )


def population_stddev(df: DataFrame, by: str, column: str) -> DataFrame:
    """Population standard deviation per group, as a float."""
    return df.groupBy(by).agg(F.stddev_pop(column).cast("float").alias("stddev"))
