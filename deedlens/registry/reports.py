"""Ownership and price questions: totals, joins, shares, ranks, yearly averages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedlens.operators import joins, totals, windows
from deedlens.plans.ownership import clean_titles, labelled_titles, leftover_titles
from deedlens.registry.base import query
from deedlens.sources.scratch import stored
from deedlens.standins import (
    INDEX_SQL,
    LABELLED_SQL,
    OWNERSHIP,
    PRICES,
    TITLES_SQL,
    price_index,
    titles,
)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_titles(clean_titles(titles(spark, sf_dir)), OWNERSHIP).drop("features")


def bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).filter(F.col("is_fraud") == 1)


@query(
    f"""
WITH {TITLES_SQL}
SELECT "CountryIncorporated1" AS country, COUNT("CountryIncorporated1") AS n_rows,
  round(CAST(SUM("PricePaid") AS BIGINT) / 1e6, 1) AS total
FROM titles GROUP BY 1
ORDER BY total DESC NULLS LAST, country ASC NULLS FIRST LIMIT 15
"""
)
def q_top_jurisdictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifteen countries with the largest sum paid, in millions."""
    top = totals.top_totals(titles(spark, sf_dir), "CountryIncorporated1", "PricePaid", 1_000_000)
    return top.withColumnRenamed("CountryIncorporated1", "country")


@query(
    f"""
WITH {LABELLED_SQL}
SELECT "Region" AS region, COUNT("Region") AS n_rows, round(CAST(SUM("PricePaid") AS BIGINT) / 1e6, 1) AS total
FROM bad WHERE "Region" IS NOT NULL GROUP BY 1 ORDER BY n_rows DESC, region
"""
)
def q_region_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged titles and sum paid per region, in millions."""
    return totals.region_totals(bad(spark, sf_dir), "Region", "PricePaid").withColumnRenamed("Region", "region")


@query(
    f"""
WITH {LABELLED_SQL},
report AS (
  SELECT "Region" AS region, COUNT("Region") AS n_rows, round(CAST(SUM("PricePaid") AS BIGINT) / 1e6, 1) AS total
  FROM bad WHERE "Region" IS NOT NULL GROUP BY 1)
SELECT CAST(SUM(n_rows) AS BIGINT) AS count_total, round(SUM(total) / 1000.0, 3) AS value_total FROM report
"""
)
def q_report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All regions together: titles, and sum paid in billions."""
    report = totals.region_totals(bad(spark, sf_dir), "Region", "PricePaid")
    return totals.report_totals(report, "n_rows", "total")


@query(
    f"""
WITH {LABELLED_SQL}
SELECT "District" AS district, COUNT("District") AS n_rows, round(CAST(SUM("PricePaid") AS BIGINT) / 1e6, 1) AS total
FROM bad WHERE upper("County") = 'EUROPE' AND "District" <> 'NATION_8' GROUP BY 1
ORDER BY total DESC NULLS LAST, district ASC NULLS FIRST LIMIT 15
"""
)
def q_county_district_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Districts of one county by sum paid, one district left out."""
    top = totals.top_totals_within(
        bad(spark, sf_dir), "District", "PricePaid", 1_000_000, within="County", name="Europe", exclude="NATION_8"
    )
    return top.withColumnRenamed("District", "district")


@query(
    f"""
WITH {LABELLED_SQL}
SELECT "CountryIncorporated1" AS country, COUNT(*) AS n FROM labelled WHERE is_fraud = 1
GROUP BY 1 ORDER BY n DESC, country ASC NULLS FIRST LIMIT 20
"""
)
def q_fraud_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty countries with most flagged titles."""
    counts = totals.flagged_counts(labelled(spark, sf_dir), "CountryIncorporated1", k=20)
    return counts.withColumnRenamed("CountryIncorporated1", "country")


@query(
    f"""
WITH {TITLES_SQL}
SELECT "District" AS district, COUNT("District") AS n FROM titles GROUP BY 1 ORDER BY n, district
"""
)
def q_group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles per district, fewest first; titles without district show as 0."""
    return totals.group_counts(titles(spark, sf_dir), "District").withColumnRenamed("District", "district")


@query(
    f"""
WITH {LABELLED_SQL}
SELECT "TitleNumber", "District", "Region", "PricePaid" FROM clean c
WHERE NOT EXISTS (SELECT 1 FROM complete f WHERE f."TitleNumber" = c."TitleNumber")
"""
)
def q_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean titles that were too incomplete for features."""
    dropped = leftover_titles(clean_titles(titles(spark, sf_dir)))
    return dropped.select("TitleNumber", "District", "Region", "PricePaid")


@query(
    f"""
WITH {LABELLED_SQL}, {INDEX_SQL},
regional AS (SELECT "RegionName", round(AVG("AveragePrice"), 2) AS region_price FROM price_index GROUP BY 1)
SELECT "TitleNumber", "District", "PricePaid", "RegionName", region_price
FROM regional LEFT JOIN bad ON lower("RegionName") = lower("District") WHERE "District" IS NOT NULL
"""
)
def q_ci_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged titles beside the average index price of their district."""
    regional = price_index(spark, sf_dir).groupBy("RegionName").agg(
        F.round(F.avg("AveragePrice"), 2).alias("region_price")
    )
    joined = joins.ci_join(bad(spark, sf_dir), regional, "District", "RegionName")
    return joined.select("TitleNumber", "District", "PricePaid", "RegionName", "region_price")


@query(
    f"""
WITH {LABELLED_SQL},
summary AS (SELECT "District" AS district, "County" AS county, COUNT("District") AS n, MAX("PricePaid") AS max_value
  FROM labelled GROUP BY 1, 2),
ranked AS (SELECT *, dense_rank() OVER (ORDER BY n DESC) AS rank FROM summary),
top AS (SELECT * FROM ranked WHERE rank <= 10)
SELECT top.district, top.county, CAST(top.rank AS INTEGER) AS rank, top.max_value,
  h."ProprietorName1" AS company, h."CountryIncorporated1" AS country, h."Tenure" AS tenure,
  substr(h."PropertyAddress", 1, 50) AS address, h."MultipleAddressIndicator" AS several_addresses
FROM top JOIN labelled h ON top.district = h."District" AND top.max_value = h."PricePaid"
"""
)
def q_max_row_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most expensive titles of the districts with most titles."""
    rows = labelled(spark, sf_dir)
    summary = windows.group_summary(rows, ["District", "County"], "District", "PricePaid")
    top = windows.dense_rank_top(stored(summary), "n", 10)
    found = joins.max_row_join(
        top,
        rows,
        group="District",
        maximum="max_value",
        value="PricePaid",
        columns=[
            "ProprietorName1",
            "CountryIncorporated1",
            "Tenure",
            "PropertyAddress",
            "MultipleAddressIndicator",
        ],
    )
    return found.select(
        F.col("District").alias("district"),
        F.col("County").alias("county"),
        "rank",
        "max_value",
        F.col("base_ProprietorName1").alias("company"),
        F.col("base_CountryIncorporated1").alias("country"),
        F.col("base_Tenure").alias("tenure"),
        F.substring("base_PropertyAddress", 1, 50).alias("address"),
        F.col("base_MultipleAddressIndicator").alias("several_addresses"),
    )


_COMBINED_TITLE = (
    "TitleNumber",
    "Tenure",
    "PropertyAddress",
    "District",
    "County",
    "Region",
    "PricePaid",
    "is_fraud",
    "rule_id",
)
_COMBINED_INDEX = ("Datetaken", "RegionName", "AreaCode", "SalesVolume", "AveragePrice", "FlatPrice")


@query(
    f"""
WITH {LABELLED_SQL}, {INDEX_SQL},
months AS (SELECT DISTINCT {", ".join(f'"{c}"' for c in _COMBINED_INDEX)} FROM price_index WHERE upper("RegionName") = 'NATION_7'),
listed AS (SELECT lower("RegionName") AS region_name, CAST(COUNT(*) AS INTEGER) AS n_index_rows,
  string_agg(CAST("Datetaken" AS VARCHAR) || ' ' || "AreaCode" || ' ' || "SalesVolume" || ' '
    || CAST(round("AveragePrice" * 100) AS BIGINT), ';' ORDER BY "Datetaken") AS index_text FROM months GROUP BY 1)
SELECT DISTINCT region_name,
  {", ".join(f'b."{c}"' if c not in ("is_fraud", "rule_id") else f"b.{c}" for c in _COMBINED_TITLE)},
  n_index_rows, index_text
FROM bad b JOIN listed ON lower(b."District") = region_name WHERE upper(b."County") = 'ASIA'
"""
)
def q_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged titles of one region, each with the monthly index rows of it as text."""
    index = price_index(spark, sf_dir).select(*_COMBINED_INDEX)
    found = joins.combine(index, bad(spark, sf_dir).select(*_COMBINED_TITLE), county="Asia", region="Nation_7")
    row = "concat_ws(' ', r.Datetaken, r.AreaCode, r.SalesVolume, cast(round(r.AveragePrice * 100) AS bigint))"
    return found.select(
        "region_name",
        *_COMBINED_TITLE,
        F.size("index_rows").alias("n_index_rows"),
        F.expr(f"array_join(transform(index_rows, r -> {row}), ';')").alias("index_text"),
    )


_RATIO_SQL = f"""
{LABELLED_SQL}, {INDEX_SQL},
t AS (SELECT "County" AS county, "District" AS district, round(AVG("PricePaid")) AS avg_title_price
  FROM bad WHERE COALESCE("District", 'NULL') <> 'NULL' GROUP BY 1, 2),
g AS (SELECT "RegionName" AS region, round(AVG("AveragePrice")) AS avg_index_price FROM price_index GROUP BY 1),
ratios AS (SELECT county, district, avg_title_price, avg_index_price,
  CAST(floor(round(avg_title_price / avg_index_price)) AS BIGINT) AS price_ratio
  FROM t JOIN g ON lower(district) = lower(region)),
counts AS (SELECT "District" AS district, COUNT("District") AS n FROM bad GROUP BY 1),
top AS (SELECT county, district, n, avg_title_price, avg_index_price, price_ratio
  FROM ratios JOIN counts USING (district) WHERE district <> 'NATION_7'
  ORDER BY n DESC, district, county LIMIT 15)"""


def _ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.price_ratio(price_index(spark, sf_dir), bad(spark, sf_dir))


def _top_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = totals.group_counts(bad(spark, sf_dir), "District")
    return totals.top_price_ratios(_ratios(spark, sf_dir), counts, exclude="NATION_7")


@query(f"WITH {_RATIO_SQL} SELECT * FROM ratios")
def q_price_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average title price against average index price per district."""
    return _ratios(spark, sf_dir)


@query(f"WITH {_RATIO_SQL} SELECT * FROM ratios WHERE lower(county) = 'europe'")
def q_price_ratio_county(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same within one county, whatever the case it is written in."""
    return totals.price_ratio(price_index(spark, sf_dir), bad(spark, sf_dir), county="Europe")


@query(f"WITH {_RATIO_SQL} SELECT * FROM top")
def q_top_price_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifteen districts with most titles and their price ratios."""
    return _top_ratios(spark, sf_dir)


@query(
    f"WITH {_RATIO_SQL} SELECT district, n, round(n / (SELECT SUM(n) FROM top) * 100, 1) AS percentage FROM top"
)
def q_top_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each of those districts in their sum."""
    return totals.share_of_total(_top_ratios(spark, sf_dir).select("district", "n"), "n")


@query(
    f"""
WITH {LABELLED_SQL}, {INDEX_SQL},
g AS (SELECT SUM("AveragePrice") AS good FROM price_index),
b AS (SELECT CAST(SUM("PricePaid") AS DOUBLE) AS bad FROM bad)
SELECT round(good, 2) AS good_total, round(bad, 2) AS bad_total, round(bad / good, 2) AS price_ratio FROM g, b
"""
)
def q_global_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum paid for flagged titles against the sum of index prices."""
    return totals.global_ratio(price_index(spark, sf_dir), bad(spark, sf_dir), "AveragePrice", "PricePaid")


_SUMMARY_SQL = f"""
{LABELLED_SQL},
summary AS (SELECT "District" AS district, "County" AS county, COUNT("District") AS n, MAX("PricePaid") AS max_value
  FROM labelled GROUP BY 1, 2)"""


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = windows.group_summary(labelled(spark, sf_dir), ["District", "County"], "District", "PricePaid")
    return summary.withColumnsRenamed({"District": "district", "County": "county"})


@query(f"WITH {_SUMMARY_SQL} SELECT * FROM summary")
def q_district_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles and highest price per district and county."""
    return _summary(spark, sf_dir)


@query(
    f"""
WITH {_SUMMARY_SQL}
SELECT district, county, n, round(n / SUM(n) OVER () * 100, 2) AS percentage FROM summary ORDER BY n DESC
"""
)
def q_percent_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each district's percentage of all titles."""
    counts = _summary(spark, sf_dir).drop("max_value")
    return windows.percent_of_total(counts, "n").orderBy(F.desc("n"), "district", "county")


@query(
    f"""
WITH {_SUMMARY_SQL},
ranked AS (SELECT *, CAST(dense_rank() OVER (ORDER BY n DESC) AS INTEGER) AS rank FROM summary)
SELECT * FROM ranked WHERE rank <= 10
"""
)
def q_dense_rank_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Districts whose rank by number of titles is at most ten."""
    return windows.dense_rank_top(stored(_summary(spark, sf_dir)), "n", 10)


@query(
    f"""
WITH {INDEX_SQL}
SELECT CAST(year("Datetaken") AS INTEGER) AS year, "RegionName" AS region,
  {", ".join(f'round(AVG("{source}")) AS {target}' for source, target in PRICES.items())}
FROM price_index GROUP BY 1, 2 ORDER BY 1, 2
"""
)
def q_yearly_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average prices per year and region."""
    return windows.yearly_average(price_index(spark, sf_dir), "Datetaken", "RegionName", PRICES)

