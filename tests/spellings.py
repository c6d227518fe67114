"""Direct spellings of some operators, for checking results and comparing times."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deedlens.functions.scalars import filled_text


def price_ratio_by_join(good, bad):
    """Join every title with every index row of its area, then average."""
    joined = bad.filter(filled_text(F.col("District"))).join(good, F.lower("District") == F.lower("RegionName"))
    averaged = joined.groupBy("County", "RegionName", "District").agg(
        F.round(F.avg("PricePaid")).alias("avg_title_price"), F.round(F.avg("AveragePrice")).alias("avg_index_price")
    )
    whole = F.floor(F.round(F.col("avg_title_price") / F.nullif(F.col("avg_index_price"), F.lit(0.0))))
    return averaged.select(
        F.col("County").alias("county"),
        F.col("District").alias("district"),
        "avg_title_price",
        "avg_index_price",
        whole.cast("bigint").alias("price_ratio"),
    )


def group_summary_by_window(df, by, count, maximum):
    spec = Window.partitionBy(*by)
    return df.select(
        *by, F.count(count).over(spec).alias("n"), F.max(maximum).over(spec).alias("max_value")
    ).distinct()


def dense_rank_top_by_window(df, column, k):
    rank = F.dense_rank().over(Window.orderBy(F.desc_nulls_last(column)))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)


def yearly_average_by_window(df, date, region, columns):
    year = F.date_format(date, "yyyy").cast("int")
    spec = Window.partitionBy(year, F.col(region))
    averages = [F.round(F.avg(source).over(spec)).alias(target) for source, target in columns.items()]
    return df.select(year.alias("year"), F.col(region).alias("region"), *averages).distinct()


def null_profile_by_column(df):
    """One count job per column."""
    rows = df.count()
    return {c: round(df.filter(F.col(c).isNull()).count() / rows * 100, 1) for c in df.columns}


def category_counts_by_column(df, columns):
    """One group-by job per column."""
    return {c: df.groupBy(c).count().collect() for c in columns}


def polarity_by_udf(df, key, text, lexicon):
    """A row-at-a-time Python function."""
    from pyspark.sql.types import FloatType

    from deedlens.operators.text import SEPARATORS

    table = str.maketrans(SEPARATORS, " " * len(SEPARATORS))

    @F.udf(FloatType())
    def score(value):
        if value is None:
            return None
        found = [lexicon[w] for w in value.lower().translate(table).split(" ") if w in lexicon]
        return sum(found) / len(found) if found else 0.0

    return df.select(key, score(text).alias("polarity"))
