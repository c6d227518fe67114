"""Feature preparation: indexing, imputation, scaling, encoding, vectors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml.feature import Binarizer, FeatureHasher, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedlens.functions.scalars import finite
from deedlens.functions.text import quoted
from deedlens.operators.clean import complete_rows, lacks_value
from deedlens.operators.joins import missing_from
from deedlens.operators.ranking import global_position
from deedlens.sources.scratch import stored


def label_index(df: DataFrame, column: str, out: str) -> DataFrame:
    """Distinct values with an index from zero: most frequent first, ties by value.

    The list stays a DataFrame, whatever its length.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    numbered = global_position(counts, [F.desc("_n"), F.asc(column)], out)
    return numbered.select(column, F.col(out).cast("double").alias(out))


def string_index(df: DataFrame, column: str, out: str, invalid: str = "error") -> DataFrame:
    """Index a text column by frequency.

    ``invalid`` says what becomes of a NULL: ``skip`` drops the row, ``keep``
    gives it the index after the last, ``error`` fails the job.
    """
    if invalid not in ("skip", "keep", "error"):
        raise ValueError("invalid must be skip, keep or error")
    index = stored(label_index(df, column, out), "labels")
    joined = df.join(index, on=column, how="inner" if invalid == "skip" else "left")
    if invalid == "skip":
        found: Column = F.col(out)
    elif invalid == "keep":
        found = F.coalesce(F.col(out), index.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar())
    else:
        problem = F.raise_error(F.lit(f"NULL in {column}")).cast("double")
        found = F.when(F.col(out).isNotNull(), F.col(out)).otherwise(problem)
    return joined.select(*[F.col(c) for c in df.columns], found.alias(out))


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill NULL, NaN and infinite numbers with the column mean over the finite ones."""
    means = df.agg(F.struct(*[F.avg(finite(F.col(c))).alias(c) for c in columns]).alias("means")).scalar()
    filled = df.withColumn("_means", means)
    return filled.withColumns(
        {c: F.coalesce(finite(F.col(c)), F.col("_means").getField(c)) for c in columns}
    ).drop("_means")


def impute_by_group(df: DataFrame, columns: Sequence[str], levels: Sequence[Sequence[str]]) -> DataFrame:
    """Fill NULL, NaN and infinite numbers with the mean of the row's group, or of a wider one that has a mean.

    ``levels`` go from narrow to wide, each within the one before, as
    ``[["County", "District"], ["County"]]``; the mean over all rows comes last.
    All levels are one pass of grouping sets. A row with a NULL in a level's
    columns belongs to no group of that level. The means of all groups are a
    stored table with one row per narrowest group, in which what is missing is
    taken from the wider ones; the rows meet it in one join, whose side of means
    Catalyst broadcasts if it is small. A column without any number stays as it
    is, NaN and infinity becoming NULL. Filled columns are doubles.
    """
    narrow = list(levels[0])
    if any(not set(wide) <= set(before) for before, wide in zip(levels, levels[1:])):
        raise ValueError("each level must lie within the one before")
    sets = [list(level) for level in levels] + [[]]
    means = {f"_mean_{i}": F.avg(finite(F.col(quoted(c)).cast("double"))) for i, c in enumerate(columns)}
    known = {f"_is_{j}": F.col(quoted(g)).isNotNull().cast("int") for j, g in enumerate(narrow)}
    # Which of the group columns a row of means is about; without one, NULL is a value.
    grouped = [F.grouping(quoted(g)).alias(f"_over_{j}") for j, g in enumerate(narrow)]
    found = stored(
        df.groupingSets([[F.col(quoted(g)) for g in level] for level in sets], *[F.col(quoted(g)) for g in narrow])
        .agg(*[m.alias(name) for name, m in means.items()], *grouped)
        .withColumns(known),
        "group-means",
    )

    def level_rows(level: Sequence[str]) -> DataFrame:
        rows = found
        for j, g in enumerate(narrow):
            rows = rows.filter(F.col(f"_over_{j}") == (0 if g in level else 1))
        return rows

    def renamed(level: Sequence[str], n: int) -> DataFrame:
        whole = level_rows(level).filter(" AND ".join(f"_is_{narrow.index(g)} = 1" for g in level) or "true")
        own = [F.col(quoted(g)).alias(f"_g{n}_{narrow.index(g)}") for g in level]
        return whole.select(*own, *[F.col(m).alias(f"{m}_{n}") for m in means])

    filled = level_rows(narrow).select(*[F.col(quoted(g)).alias(f"_n{j}") for j, g in enumerate(narrow)])
    for n, level in enumerate(levels):
        same = reduce(and_, [F.col(f"_n{narrow.index(g)}") == F.col(f"_g{n}_{narrow.index(g)}") for g in level])
        filled = filled.join(renamed(level, n), same, "left")
    overall = level_rows([]).select(F.struct(*means).alias("overall")).scalar()
    filled = filled.withColumn("_overall", overall).select(
        *[f"_n{j}" for j in range(len(narrow))],
        *[F.coalesce(*[F.col(f"{m}_{n}") for n in range(len(levels))], F.col(f"_overall.{m}")).alias(m) for m in means],
    )
    at = reduce(and_, [F.col(quoted(g)).eqNullSafe(F.col(f"_n{j}")) for j, g in enumerate(narrow)])
    number = {c: F.coalesce(finite(F.col(quoted(c)).cast("double")), F.col(f"_mean_{i}")) for i, c in enumerate(columns)}
    joined = df.join(stored(filled, "filled-means"), at, "left")
    return joined.select(*[number[c].alias(c) if c in number else F.col(quoted(c)) for c in df.columns])


def scaling(df: DataFrame, columns: Sequence[str], sample: bool = True) -> DataFrame:
    """One row of means and standard deviations, columns ``<c>_mean`` and ``<c>_std``.

    ``sample`` divides by n - 1; otherwise the population form is taken.
    """
    deviation = F.stddev_samp if sample else F.stddev_pop
    aggregates = []
    for c in columns:
        aggregates += [F.avg(c).alias(f"{c}_mean"), deviation(c).alias(f"{c}_std")]
    return df.agg(*aggregates)


def _scaling_struct(stats: DataFrame) -> Column:
    return stats.select(F.struct("*").alias("stats")).scalar()


def standardise(df: DataFrame, columns: Sequence[str], stats: DataFrame) -> DataFrame:
    """(x - mean) / std; a column without spread becomes 0. ``stats`` comes from :func:`scaling`."""
    scaled = df.withColumn("_stats", _scaling_struct(stats))
    values = {}
    for c in columns:
        mean, std = F.col(f"_stats.{c}_mean"), F.col(f"_stats.{c}_std")
        values[c] = F.when(std.isNull() | (std == 0), F.when(F.col(c).isNotNull(), F.lit(0.0))).otherwise((F.col(c) - mean) / std)
    return scaled.withColumns(values).drop("_stats")


def unstandardise(df: DataFrame, columns: Sequence[str], stats: DataFrame) -> DataFrame:
    """x * std + mean, the inverse of :func:`standardise`."""
    scaled = df.withColumn("_stats", _scaling_struct(stats))
    return scaled.withColumns(
        {c: F.col(c) * F.col(f"_stats.{c}_std") + F.col(f"_stats.{c}_mean") for c in columns}
    ).drop("_stats")


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features", invalid: str = "skip") -> DataFrame:
    """Vector of numeric columns; ``skip`` drops rows with a NULL. An older ``out`` is replaced."""
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid=invalid).transform(df.drop(out))


@dataclass(frozen=True)
class Features:
    """Rows with a feature vector, and the rows that were too incomplete to get one."""

    rows: DataFrame
    kept: DataFrame
    needed: tuple[str, ...]
    key: str

    @property
    def dropped(self) -> DataFrame:
        """Rows whose key occurs nowhere in ``kept``."""
        # A complete row has its own key among the kept ones; only the others need the join.
        lacking = self.rows.filter(F.col(self.key).isNull() | lacks_value(self.rows, self.needed))
        return missing_from(lacking, complete_rows(self.rows, self.needed), self.key)


def build_features(
    df: DataFrame,
    categories: Sequence[str],
    numbers: Sequence[str],
    key: str,
    nulls: str = "skip",
) -> Features:
    """Feature vector of ``numbers`` for rows that are complete in ``categories`` and ``numbers``.

    With ``nulls="keep"`` a NULL category does not drop the row. Index columns
    that nobody reads afterwards are not built: completeness is all they decide.
    """
    needed = (*(categories if nulls == "skip" else ()), *numbers)
    return Features(df, assemble(complete_rows(df, needed), numbers), needed, key)


def one_hot(df: DataFrame, columns: Sequence[str], drop_last: bool = True, invalid: str = "error") -> DataFrame:
    """Index and one-hot vector per text column: ``<c>_index`` and ``<c>_vec``, for any number of values.

    The index is joined from a frame of the values, see :func:`string_index`;
    the sparse vector needs no more than index and number of values.
    """
    for c in columns:
        df = string_index(df, c, f"{c}_index", invalid)
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_vec" for c in columns], dropLast=drop_last
    )
    return encoder.fit(df).transform(df)


def flag_stages(
    encoded: Sequence[str],
    hashed: Sequence[str],
    borders: Mapping[str, Sequence[float]],
    hashed_size: int = 256,
    out: str = "features",
) -> list:
    """Pipeline stages from text and number columns to one vector of 0/1 features.

    The caller says how a text column is encoded. ``encoded`` ones are one-hot
    encoded: exact, but the fitted values are held by the driver and by every
    task, which suits columns whose values are known to be few. A ``hashed`` one
    has ``hashed_size`` slots, whatever the number of values; values that meet
    in a slot are one feature to the model. A number has a feature for each of
    its ``borders``: whether it lies above. Rows with a NULL number are skipped.
    """
    stages, parts = [], []
    above = [(column, border, f"{column}_above_{i}") for column, own in borders.items() for i, border in enumerate(own)]
    if above:
        columns, thresholds, names = (list(x) for x in zip(*above, strict=True))
        # A NULL or NaN is neither above nor below: the assembler of the numbers themselves skips the row.
        stages.append(VectorAssembler(inputCols=list(borders), outputCol=f"{out}_numbers", handleInvalid="skip"))
        stages.append(Binarizer(inputCols=columns, outputCols=names, thresholds=thresholds))
        parts += names
    if encoded:
        names = list(encoded)
        indexes, vectors = [f"{c}_index" for c in names], [f"{c}_vec" for c in names]
        stages.append(
            StringIndexer(
                inputCols=names, outputCols=indexes, handleInvalid="keep", stringOrderType="frequencyDesc"
            )
        )
        stages.append(OneHotEncoder(inputCols=indexes, outputCols=vectors))
        parts += vectors
    for c in hashed:
        # A hasher of its own for each column: no two columns meet in a slot, so each is 0 or 1.
        stages.append(FeatureHasher(inputCols=[c], outputCol=f"{c}_slots", numFeatures=hashed_size, categoricalCols=[c]))
        parts.append(f"{c}_slots")
    stages.append(VectorAssembler(inputCols=parts, outputCol=out, handleInvalid="skip"))
    return stages


def hashed_slots(df: DataFrame, hashed: Sequence[str], out: Sequence[str], hashed_size: int = 256) -> DataFrame:
    """Add the slot of each ``hashed`` column of :func:`flag_stages`, as the text of its vector; a NULL has a slot of its own."""
    for c, name in zip(hashed, out, strict=True):
        hasher = FeatureHasher(inputCols=[c], outputCol=name, numFeatures=hashed_size, categoricalCols=[c])
        df = hasher.transform(df).withColumn(name, F.col(name).cast("string"))
    return df


def flagged_rows(df: DataFrame, borders: Mapping[str, Sequence[float]]) -> DataFrame:
    """Rows that :func:`flag_stages` does not skip."""
    if not any(borders.values()):
        return df
    return df.filter(reduce(and_, [F.col(quoted(c)).isNotNull() & ~F.isnan(quoted(c)) for c in borders]))


def flag_keys(encoded: Sequence[str], slots: Sequence[str], borders: Mapping[str, Sequence[float]]) -> list[Column]:
    """What decides the vector of :func:`flag_stages`: rows that are equal in all of these have the same.

    ``slots`` are the columns that :func:`hashed_slots` added. Of a number it is
    how many of its ``borders`` lie below.
    """
    above = [sum(((F.col(quoted(c)) > b).cast("int") for b in own), F.lit(0)) for c, own in borders.items() if own]
    return [*above, *[F.col(quoted(c)) for c in (*encoded, *slots)]]


def date_parts(df: DataFrame, column: str) -> DataFrame:
    """Year, month and day of a date as number columns."""
    return df.withColumns(
        {"year": F.year(column), "month": F.month(column), "day": F.dayofmonth(column)}
    )

