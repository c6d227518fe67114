"""Set operations, reconciliation and the comparison of synthetic with original rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, FloatType, MapType, StructType, UserDefinedType

from deedlens.functions.text import literal, quoted, rows_of
from deedlens.operators.profile import numeric_columns, unpivot_strings


def union_all(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both, columns matched by name."""
    return first.unionByName(second)


def except_rows(first: DataFrame, second: DataFrame, duplicates: bool = False) -> DataFrame:
    """Rows of ``first`` not in ``second``; ``duplicates`` counts equal rows one by one.

    Either way equal rows are combined before the one shuffle.
    """
    if duplicates:
        return first.exceptAll(second)
    only_first = (F.col("n_first") > 0) & (F.col("n_second") == 0)
    return row_differences(first, second).filter(only_first).select(*[F.col(quoted(c)) for c in first.columns])


def row_differences(first: DataFrame, second: DataFrame) -> DataFrame:
    """Every distinct row with how often either frame holds it.

    One shuffle over both frames, repeated rows combined before it. NULLs equal
    each other.
    """
    tagged = first.withColumns({"_first": F.lit(1), "_second": F.lit(0)}).unionByName(
        second.withColumns({"_first": F.lit(0), "_second": F.lit(1)})
    )
    return tagged.groupBy(*[F.col(quoted(c)) for c in first.columns]).agg(
        F.sum("_first").alias("n_first"), F.sum("_second").alias("n_second")
    )


def reconcile(first: DataFrame, second: DataFrame) -> DataFrame:
    """One row: sizes of both frames and the rows that only one of them holds.

    Both directions, counting duplicates, so that an empty or doubled read-back
    does not pass for a match.
    """
    surplus = F.col("n_first") - F.col("n_second")
    zero = F.lit(0)
    return (
        row_differences(first, second)
        .agg(
            F.coalesce(F.sum("n_first"), zero).alias("rows_first"),
            F.coalesce(F.sum("n_second"), zero).alias("rows_second"),
            F.coalesce(F.sum(F.greatest(surplus, zero)), zero).alias("only_first"),
            F.coalesce(F.sum(F.greatest(-surplus, zero)), zero).alias("only_second"),
        )
        .withColumn("matched", (F.col("only_first") == 0) & (F.col("only_second") == 0))
    )


def reconcile_keys(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What became of the rows of each key, as ``measure, column, n``.

    ``equal rows`` are rows that both frames hold. What is left of a key on both
    sides is paired: ``changed rows`` counts the pairs, ``only first`` and
    ``only second`` the rows without a partner. ``changed`` counts, for each
    column beside the keys, the pairs that must differ in it, however the rows
    of a key are paired; with one row per key those are the pairs that do.

    Rows that both sides hold end in the first group-by; only the others are
    taken apart by column, and counted by key, column and value, so that a key
    with many rows is spread over tasks. A NULL key is a key, and NULLs equal
    each other. Columns are matched by name; a frame that lacks one is an error.
    """
    lacking = [k for k in keys if k not in first.columns]
    if not keys or lacking or sorted(first.columns) != sorted(second.columns):
        raise ValueError(f"both frames need the same columns, the keys among them: {lacking or list(keys)}")
    names = [c for c in first.columns if c not in keys]
    key = f"struct({', '.join(quoted(k) for k in keys)})"
    rest = f"to_json(struct({', '.join(quoted(c) for c in names)}), map('ignoreNullFields', 'false'))" if names else "''"
    # The whole row stands for itself under no name, equal rows under the number 0.
    cells = [f"struct(1 AS kind, cast(NULL AS string) AS name, {rest} AS value)"]
    cells += [f"struct(2 AS kind, {literal(c)} AS name, {_cell(first, c)} AS value)" for c in names]
    surplus = row_differences(first, second).selectExpr(
        f"if(n_first = n_second, NULL, {key}) AS key",
        "n_first - n_second AS more",
        "least(n_first, n_second) AS equal",
        f"if(n_first = n_second, array(struct(0 AS kind, cast(NULL AS string) AS name, cast(NULL AS string) AS value)), "
        f"array(struct(0 AS kind, cast(NULL AS string) AS name, cast(NULL AS string) AS value), {', '.join(cells)})) AS cells",
    )
    by_value = (
        surplus.selectExpr("key", "more", "equal", "inline(cells)")
        .selectExpr("if(kind = 0, NULL, key) AS key", "kind", "name", "value", "if(kind = 0, 0, more) AS more", "if(kind = 0, equal, 0) AS equal")
        .groupBy("key", "kind", "name", "value")
        .agg(F.sum("more").alias("more"), F.sum("equal").alias("equal"))
    )
    by_key = by_value.groupBy("key", "kind", "name").agg(
        F.sum(F.greatest("more", F.lit(0))).alias("f"), F.sum(F.greatest(-F.col("more"), F.lit(0))).alias("s"), F.sum("equal").alias("equal")
    )
    counted = by_key.groupBy("kind", "name").agg(
        F.sum(F.least("f", "s")).alias("changed"),
        F.sum(F.col("f") - F.least("f", "s")).alias("only_first"),
        F.sum(F.col("s") - F.least("f", "s")).alias("only_second"),
        F.sum("equal").alias("equal"),
    )
    # One row, so that measures without any row come out as 0.
    totals = counted.agg(
        F.coalesce(F.sum(F.when(F.col("kind") == 0, F.col("equal"))), F.lit(0)).alias("equal"),
        *[
            F.coalesce(F.sum(F.when(F.col("kind") == 1, F.col(c))), F.lit(0)).alias(c)
            for c in ("changed", "only_first", "only_second")
        ],
        *[
            F.coalesce(F.sum(F.when((F.col("kind") == 2) & (F.col("name") == c), F.col("changed"))), F.lit(0)).alias(f"_{i}")
            for i, c in enumerate(names)
        ],
    )
    measures = [("equal rows", "equal"), ("changed rows", "changed"), ("only first", "only_first"), ("only second", "only_second")]
    structs = [f"struct({literal(m)} AS measure, cast(NULL AS string) AS column, {c} AS n)" for m, c in measures]
    structs += [f"struct('changed' AS measure, {literal(c)} AS column, _{i} AS n)" for i, c in enumerate(names)]
    return totals.selectExpr(rows_of(structs))


def _cell(df: DataFrame, name: str) -> str:
    """A value as text such that equal values, and only they, have equal texts."""
    kind = df.schema[name].dataType
    if isinstance(kind, (DoubleType, FloatType)):
        # Adding zero takes the sign off a zero.
        return f"cast({quoted(name)} + 0.0D AS string)"
    if isinstance(kind, BinaryType):
        return f"hex({quoted(name)})"
    if isinstance(kind, (ArrayType, MapType, StructType, UserDefinedType)):
        return f"nullif(to_json(struct({quoted(name)} AS v)), '{{}}')"
    return f"cast({quoted(name)} AS string)"


def quality_report(tagged: DataFrame, synthetic: str, digits: int = 2) -> DataFrame:
    """Compare synthetic with original rows of one frame, told apart by a boolean column.

    Long form: section (shape, describe, category), column, statistic, and the
    figure for either kind with the difference. Shape and description come from
    one aggregate, category counts from one unpivot.
    """
    columns = [c for c in tagged.columns if c != synthetic]
    numbers = [c for c in numeric_columns(tagged) if c != synthetic]
    made = quoted(synthetic)
    kinds = {"original": f"NOT {made}", "synthetic": made}
    statistics = {"count": "count", "mean": "avg", "stddev": "stddev_samp", "min": "min", "max": "max"}
    aggregates = [f"cast(count_if({condition}) AS double) AS rows_{kind}" for kind, condition in kinds.items()]
    structs = [
        _figures("shape", "cast(NULL AS string)", "rows", "rows_original", "rows_synthetic"),
        _figures("shape", "cast(NULL AS string)", "columns", f"{len(columns)}D", f"{len(columns)}D"),
    ]
    for i, name in enumerate(numbers):
        for statistic, function in statistics.items():
            for kind, condition in kinds.items():
                value = f"{function}(CASE WHEN {condition} THEN {quoted(name)} END)"
                aggregates.append(f"cast({value} AS double) AS {statistic}_{i}_{kind}")
            pair = [f"round({statistic}_{i}_{kind}, {digits})" for kind in kinds]
            structs.append(_figures("describe", literal(name), statistic, *pair))
    figures = tagged.selectExpr(*aggregates).selectExpr(rows_of(structs))
    categories = (
        unpivot_strings(tagged, keep=[synthetic])
        .groupBy("column", F.col("value").alias("statistic"))
        .agg(*[F.expr(f"cast(count_if({condition}) AS double) AS {kind}") for kind, condition in kinds.items()])
        .select(F.lit("category").alias("section"), "column", "statistic", "original", "synthetic")
    )
    return figures.unionByName(categories).withColumn(
        "difference", F.round(F.col("synthetic") - F.col("original"), digits)
    )


def _figures(section: str, column: str, statistic: str, original: str, synthetic: str) -> str:
    return (
        f"named_struct('section', '{section}', 'column', {column}, 'statistic', '{statistic}', "
        f"'original', {original}, 'synthetic', {synthetic})"
    )


def synthetic_quality(original: DataFrame, synthetic: DataFrame, digits: int = 2) -> DataFrame:
    """:func:`quality_report` for two frames of the same columns."""
    tagged = original.withColumn("is_synthetic", F.lit(False)).unionByName(
        synthetic.withColumn("is_synthetic", F.lit(True))
    )
    return quality_report(tagged, "is_synthetic", digits)
