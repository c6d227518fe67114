"""Bootstrap, split, shuffle and per-group samples, all repeatable by key."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deedlens.functions.hashing import poisson_count, poisson_limits, poisson_thresholds, poisson_times, uniform
from deedlens.functions.text import quoted


def share_of(part: DataFrame, whole: DataFrame) -> DataFrame:
    """Rows of ``part`` over rows of ``whole`` as a one-row frame with the column ``rate``."""
    both = part.select(F.lit(1).alias("part"), F.lit(0).alias("whole")).unionByName(
        whole.select(F.lit(0).alias("part"), F.lit(1).alias("whole"))
    )
    return both.agg((F.sum("part") / F.nullif(F.sum("whole"), F.lit(0))).alias("rate"))


def share_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet a condition over all rows, as a one-row frame with the column ``rate``: one aggregate."""
    return df.agg((F.count_if(condition) / F.nullif(F.count("*"), F.lit(0))).alias("rate"))


def row_key(df: DataFrame, *key: str) -> Column:
    """Text that identifies a row: its key columns, and for a row with a NULL among them a digest of all columns.

    So rows without a key are drawn one by one like others, and do not meet in one task.
    """
    parts = [F.coalesce(F.col(quoted(k)).cast("string"), F.lit("\\0")) for k in key]
    lacking = reduce(or_, [F.col(quoted(k)).isNull() for k in key])
    whole = F.xxhash64(*[F.col(quoted(c)) for c in df.columns]).cast("string")
    joined = F.concat_ws("|", *parts) if len(parts) > 1 else parts[0]
    return F.when(lacking, F.concat(joined, F.lit("\\0"), whole)).otherwise(joined)


def _with_times(df: DataFrame, fraction: float | DataFrame, seed: int, key: str) -> DataFrame:
    """Add ``_times``, the number of draws of each row."""
    # Key and draw are columns of their own so that they are worked out once per row.
    drawn = df.withColumn("_key", row_key(df, key)).withColumn("_u", uniform(F.col("_key"), seed))
    if isinstance(fraction, DataFrame):
        drawn = drawn.withColumn("_limits", fraction.select(poisson_limits(F.col("rate"))).scalar())
        times = poisson_times(F.col("_u"), F.col("_key"), seed, F.col("_limits"))
    elif fraction <= 1:
        times = poisson_count(F.col("_u"), [F.lit(t) for t in poisson_thresholds(fraction)])
    else:
        times = poisson_times(F.col("_u"), F.col("_key"), seed, poisson_limits(F.lit(float(fraction))))
    # Without any rows to take a share of, the rate is NULL and nothing is drawn.
    return drawn.withColumn("_times", F.coalesce(times, F.lit(0))).drop("_key", "_u", "_limits")


def bootstrap(df: DataFrame, fraction: float | DataFrame, seed: int, key: str, copy: str = "copy") -> DataFrame:
    """Sample with replacement at ``fraction``: each row comes out a Poisson number of times.

    ``key`` identifies a row; ``copy`` numbers its repeats from one. No shuffle,
    and the draw does not depend on the partitioning. The fraction is a number,
    or the frame of :func:`share_of`.
    """
    return augment(df, fraction, seed, key, copy).filter(F.col(copy) > 0)


def augment(df: DataFrame, fraction: float | DataFrame, seed: int, key: str, copy: str = "copy") -> DataFrame:
    """The rows themselves (``copy`` 0) together with a bootstrap of them (1 and up).

    One scan instead of a union of two.
    """
    # The sequence is never empty; the outer form spares a filter that would repeat the draw.
    copies = F.explode_outer(F.sequence(F.lit(0), F.col("_times")))
    return _with_times(df, fraction, seed, key).withColumn(copy, copies).drop("_times")


def shuffle_rows(df: DataFrame, seed: int, *key: str, partitions: int | None = None) -> DataFrame:
    """Rows in a random order that a seed reproduces; ``key`` columns identify a row.

    Rows are ordered by a digest. Digests are uniform, so equal ranges of them
    are equal parts of the rows: each row goes straight to its range, without
    the sampling pass that a sort over unknown values needs, and the order is
    the same for any number of ``partitions``.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    digest = F.md5(F.concat_ws("|", row_key(df, *key), F.lit(str(seed))))
    part = F.shiftright(F.conv(F.substring("_digest", 1, 8), 16, 10).cast("bigint") * n, 32).cast("int")
    return (
        df.withColumn("_digest", digest)
        .repartitionById(n, part)
        .sortWithinPartitions("_digest", *key)
        .drop("_digest")
    )


def split(df: DataFrame, weights: Mapping[str, float], seed: int, key: str, out: str = "part") -> DataFrame:
    """Mark every row with the part it falls in, parts sized by ``weights``.

    A filter on ``out`` gives one part. No sort and no shuffle.
    """
    whole = sum(weights.values())
    u = uniform(row_key(df, key), seed)
    *names, last = weights
    passed = 0.0
    part = None
    for name in names:
        passed += weights[name]
        below = u < F.lit(passed / whole)
        part = F.when(below, name) if part is None else part.when(below, name)
    return df.withColumn(out, F.lit(last) if part is None else part.otherwise(last))


def rows_per_group(df: DataFrame, group: str, n: int, *order: str) -> DataFrame:
    """At most ``n`` rows of every group, the first by ``order``.

    Each task keeps its own first ``n`` rows per group before the shuffle.
    """
    spec = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("row_in_group", F.row_number().over(spec)).filter(F.col("row_in_group") <= n)
