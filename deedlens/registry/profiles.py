"""Profiles and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedlens.operators import profile
from deedlens.plans.ownership import clean_titles
from deedlens.registry.base import query
from deedlens.registry.reports import labelled
from deedlens.standins import INDEX_SQL, LABELLED_SQL, price_index, titles

_TITLE_COLUMNS = (
    "TitleNumber",
    "Tenure",
    "PropertyAddress",
    "District",
    "County",
    "Region",
    "Postcode",
    "MultipleAddressIndicator",
    "PricePaid",
    "ProprietorName1",
    "ProprietorName2",
    "Proprietor1Address1",
    "CountryIncorporated1",
    "Proprietor2Address3",
    "DateProprietorAdded",
)
_TEXT_COLUMNS = tuple(c for c in _TITLE_COLUMNS if c not in ("PricePaid", "DateProprietorAdded"))


def _profile_sql(source: str) -> str:
    rows = "\n  UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT(*) AS row_count, COUNT(*) - COUNT("{c}") AS null_count FROM {source}"""
        for c in _TITLE_COLUMNS
    )
    return f"""{LABELLED_SQL},
counts AS ({rows}),
profile AS (SELECT *, round(null_count / row_count * 100, 1) AS null_pct FROM counts)"""


@query(f"""WITH {_profile_sql("clean")} SELECT * FROM profile ORDER BY null_pct DESC, "column" """)
def q_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs per column of the clean titles."""
    return profile.null_profile(clean_titles(titles(spark, sf_dir)))


@query(
    f"""
WITH {_profile_sql("clean")}
SELECT COUNT(*) AS columns, COUNT(CASE WHEN null_count = row_count THEN 1 END) AS empty_columns,
  round(COUNT(CASE WHEN null_count = row_count THEN 1 END) / COUNT(*) * 100, 1) AS empty_pct FROM profile
"""
)
def q_null_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of columns without any value."""
    return profile.null_summary(profile.null_profile(clean_titles(titles(spark, sf_dir))))


@query(
    f"""
WITH {LABELLED_SQL}
SELECT COUNT(*) AS total, COUNT(CASE WHEN is_fraud = 1 THEN 1 END) AS flagged,
  COUNT(CASE WHEN is_fraud = 0 THEN 1 END) AS unflagged,
  round(COUNT(CASE WHEN is_fraud = 1 THEN 1 END) / COUNT(*) * 100, 2) AS flagged_pct,
  round(COUNT(CASE WHEN is_fraud = 1 THEN 1 END) / COUNT(*), 6) AS flagged_fraction FROM labelled
"""
)
def q_class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged and unflagged titles."""
    balance = profile.class_balance(labelled(spark, sf_dir), "is_fraud")
    return balance.withColumn("flagged_fraction", F.round("flagged_fraction", 6))


@query(
    f"""
WITH {LABELLED_SQL}
SELECT 'PricePaid' AS "column", COUNT("PricePaid") AS value_count, round(AVG("PricePaid"), 2) AS mean,
  round(stddev_samp("PricePaid"), 2) AS stddev, CAST(MIN("PricePaid") AS VARCHAR) AS min_value,
  CAST(MAX("PricePaid") AS VARCHAR) AS max_value FROM clean
"""
    + "".join(
        f"""  UNION ALL SELECT '{c}', COUNT("{c}"), NULL, NULL, MIN("{c}"), MAX("{c}") FROM clean
"""
        for c in _TEXT_COLUMNS
    )
)
def q_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, mean, deviation and extremes of all number and text columns of titles."""
    return profile.describe_columns(clean_titles(titles(spark, sf_dir)))


@query(
    f"WITH {LABELLED_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", "{c}" AS value, COUNT(*) AS n FROM clean GROUP BY 2
"""
        for c in _TEXT_COLUMNS
    )
)
def q_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of every text column with its count."""
    return profile.category_counts(clean_titles(titles(spark, sf_dir)))


_BIN = "CAST(LEAST(floor(({x} - lo) / ((hi - lo) / 20.0)), 19) AS INTEGER)"
_EDGES = "round(lo + (hi - lo) / 20.0 * bin, 4) AS bin_start, round(lo + (hi - lo) / 20.0 * (bin + 1), 4) AS bin_end"


def _rounded_bins(df: DataFrame) -> DataFrame:
    return df.withColumns({"bin_start": F.round("bin_start", 4), "bin_end": F.round("bin_end", 4)})


@query(
    f"""
WITH {LABELLED_SQL},
bounds AS (SELECT CAST(MIN("PricePaid") AS DOUBLE) AS lo, CAST(MAX("PricePaid") AS DOUBLE) AS hi FROM labelled),
bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range(20)),
hits AS (SELECT {_BIN.format(x='"PricePaid"')} AS bin, COUNT(*) AS n FROM labelled, bounds GROUP BY 1)
SELECT bin, {_EDGES}, COALESCE(n, 0) AS n FROM bins LEFT JOIN hits USING (bin), bounds
"""
)
def q_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices paid in twenty equal bins."""
    return _rounded_bins(profile.histogram(labelled(spark, sf_dir), "PricePaid"))


@query(
    f"""
WITH {LABELLED_SQL},
pair AS (SELECT 'original' AS source, CAST("PricePaid" AS DOUBLE) AS x FROM titles WHERE "PricePaid" IS NOT NULL
  UNION ALL SELECT 'synthetic', CAST("PricePaid" AS DOUBLE) FROM bad),
bounds AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM pair),
bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range(20)),
sources AS (SELECT DISTINCT source FROM pair),
hits AS (SELECT source, {_BIN.format(x="x")} AS bin, COUNT(*) AS n FROM pair, bounds GROUP BY 1, 2)
SELECT source, bin, {_EDGES}, COALESCE(n, 0) AS n FROM sources CROSS JOIN bins
  LEFT JOIN hits USING (source, bin), bounds
"""
)
def q_histogram_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of all titles and of flagged titles over the same bins."""
    flagged = labelled(spark, sf_dir).filter(F.col("is_fraud") == 1)
    overlay = profile.histogram_overlay(titles(spark, sf_dir), flagged, ["PricePaid"])
    return _rounded_bins(overlay.drop("column"))


@query(
    f"""WITH {INDEX_SQL} SELECT MIN("AveragePrice") AS lo, MAX("AveragePrice") AS hi FROM price_index"""
)
def q_value_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lowest and highest average price."""
    return profile.value_range(price_index(spark, sf_dir), "AveragePrice")


@query(f"""WITH {LABELLED_SQL} SELECT COUNT(*) AS row_count, {len(_TITLE_COLUMNS)} AS columns FROM clean""")
def q_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns of the clean titles."""
    return profile.shape(clean_titles(titles(spark, sf_dir)))


@query(
    f"""WITH {LABELLED_SQL} SELECT "County" AS county, CAST(stddev_pop("PricePaid") AS FLOAT) AS stddev FROM titles GROUP BY 1"""
)
def q_stddev_pop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population deviation of the price per county."""
    return profile.population_stddev(titles(spark, sf_dir), "County", "PricePaid").withColumnRenamed(
        "County", "county"
    )
