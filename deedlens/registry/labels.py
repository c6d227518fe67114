"""Cleaning and labelling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedlens.operators import clean, label
from deedlens.plans.ownership import ROGUE_TENURES
from deedlens.registry.base import query
from deedlens.registry.reports import labelled
from deedlens.standins import (
    INDEX_SQL,
    INDEX_THRESHOLD,
    LABELLED_SQL,
    OWNERSHIP,
    TITLES_SQL,
    TRANSACTIONS_SQL,
    price_index,
    titles,
    transactions,
)


@query(f"""WITH {LABELLED_SQL} SELECT "TitleNumber", is_fraud, rule_id FROM labelled""")
def q_rule_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label of every complete title and the rule that set it."""
    return labelled(spark, sf_dir).select("TitleNumber", "is_fraud", "rule_id")


@query(
    f"""
WITH {TITLES_SQL}
SELECT "TitleNumber", CASE WHEN "ProprietorName1" IS NULL OR "ProprietorName2" IS NULL THEN 1 ELSE 0 END
  AS missing_proprietor_name FROM titles
"""
)
def q_missing_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with a proprietor name missing."""
    flagged = label.missing_any(titles(spark, sf_dir), OWNERSHIP.names, "missing_proprietor_name")
    return flagged.select("TitleNumber", "missing_proprietor_name")


@query(
    f"""
WITH {INDEX_SQL}
SELECT "Datetaken", "RegionName",
  CASE WHEN "FlatPrice" < {INDEX_THRESHOLD} THEN 0 ELSE 1 END AS is_fraud,
  CASE WHEN "FlatPrice" < {INDEX_THRESHOLD} THEN 1 ELSE 0 END AS is_non_fraud
FROM price_index
"""
)
def q_threshold_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows labelled by price, in both polarities; no price counts as not below."""
    index = price_index(spark, sf_dir)
    one_way = label.threshold_label(index, "FlatPrice", INDEX_THRESHOLD, below=0)
    both = label.threshold_label(one_way, "FlatPrice", INDEX_THRESHOLD, below=1, out="is_non_fraud")
    return both.select("Datetaken", "RegionName", "is_fraud", "is_non_fraud")


@query(
    f"""
WITH {TRANSACTIONS_SQL}
SELECT transaction_id, CASE WHEN is_fraud THEN 1 ELSE 0 END AS is_fraud_numeric FROM transactions
"""
)
def q_bool_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fraud flag of transactions as a number."""
    numbered = label.bool_label(transactions(spark, sf_dir), "is_fraud", "is_fraud_numeric")
    return numbered.select("transaction_id", "is_fraud_numeric")


@query(f"""WITH {TITLES_SQL} SELECT "TitleNumber", "Tenure" FROM titles WHERE "Tenure" <> '93347'""")
def q_drop_rogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles without the rogue tenure value."""
    kept = clean.drop_rogue(titles(spark, sf_dir), "Tenure", ROGUE_TENURES)
    return kept.select("TitleNumber", "Tenure")


@query(
    f"""
WITH {TITLES_SQL}
SELECT "TitleNumber", "Tenure", "PropertyAddress", "District", "County", "Region", "Postcode",
  "MultipleAddressIndicator", "PricePaid", "ProprietorName1", "ProprietorName2", "Proprietor1Address1",
  "CountryIncorporated1", "DateProprietorAdded"
FROM titles
"""
)
def q_prune_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles without the columns that hold no value."""
    return clean.prune_null_columns(titles(spark, sf_dir))


@query(
    f"""
WITH {TITLES_SQL}
SELECT "TitleNumber", TRY_CAST("Tenure" AS INTEGER) AS "Tenure", CAST("PricePaid" AS DOUBLE) AS "PricePaid",
  CAST("DateProprietorAdded" AS VARCHAR) AS "DateProprietorAdded" FROM titles
"""
)
def q_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Casts that must fit, and one of text that may not: only a rogue tenure is a number."""
    columns = ["TitleNumber", "Tenure", "PricePaid", "DateProprietorAdded"]
    fitting = clean.cast_columns(
        titles(spark, sf_dir).select(*columns), {"PricePaid": "double", "DateProprietorAdded": "string"}
    )
    return clean.cast_columns(fitting, {"Tenure": "int"}, strict=False)


@query(
    f"""
WITH {TITLES_SQL}
SELECT "TitleNumber" AS title, "ProprietorName1" AS company, "CountryIncorporated1" AS country_incorporated,
  "PricePaid" AS value_in_gbp FROM titles
"""
)
def q_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report columns under report names."""
    names = {
        "TitleNumber": "title",
        "ProprietorName1": "company",
        "CountryIncorporated1": "country_incorporated",
        "PricePaid": "value_in_gbp",
    }
    return clean.rename_columns(titles(spark, sf_dir), names)


@query(
    f"""
WITH {LABELLED_SQL}
SELECT 'flagged' AS class, COUNT(*) AS n, CAST(SUM("PricePaid") AS BIGINT) AS paid FROM labelled WHERE is_fraud = 1
UNION ALL
SELECT 'unflagged', COUNT(*), CAST(SUM("PricePaid") AS BIGINT) FROM labelled WHERE is_fraud = 0
"""
)
def q_class_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and sum paid of both classes, taken apart by filter."""
    flagged, unflagged = label.class_split(labelled(spark, sf_dir))

    def size(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n"), F.sum("PricePaid").alias("paid")).select(
            F.lit(name).alias("class"), "n", "paid"
        )

    return size(flagged, "flagged").unionByName(size(unflagged, "unflagged"))
