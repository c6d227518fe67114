"""Scalar functions over the titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedlens.functions import scalars as fn
from deedlens.operators.features import date_parts
from deedlens.registry.base import query
from deedlens.standins import INDEX_SQL, TITLES_SQL, price_index, table, titles


@query(
    f"""
WITH {TITLES_SQL}
SELECT "TitleNumber", substr("PropertyAddress", 1, 50) AS address, substr("PropertyAddress", 3, 5) AS part,
  lower("District") AS district_lower, upper("Tenure") AS tenure_upper, COALESCE("District", "Region") AS place,
  "Tenure" || chr(9) || CAST("PricePaid" AS VARCHAR) || '%' AS line,
  round("PricePaid" / 1000.0, 1) AS thousands, CAST(floor("PricePaid" / 1000.0) AS BIGINT) AS whole_thousands,
  "PricePaid" / NULLIF(length("Region"), 0) AS price_ratio,
  COALESCE("District", 'NULL') <> 'NULL' AS has_district,
  strftime("DateProprietorAdded", '%Y-%m-%d %H:%M:%S') AS added_text,
  lpad(CAST("PricePaid" AS VARCHAR), CAST(greatest(8, length(CAST("PricePaid" AS VARCHAR))) AS INTEGER), '0') AS padded, '12345' || "Postcode" AS numbered, repeat('!', 5) AS marks
FROM titles
"""
)
def q_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text, number and date functions on every title."""
    price = F.col("PricePaid")
    return titles(spark, sf_dir).select(
        "TitleNumber",
        F.substring("PropertyAddress", 1, 50).alias("address"),
        fn.slice_text(F.col("PropertyAddress"), 3, 7).alias("part"),
        F.lower("District").alias("district_lower"),
        F.upper("Tenure").alias("tenure_upper"),
        F.coalesce("District", "Region").alias("place"),
        F.concat("Tenure", F.lit("\t"), price.cast("string"), F.lit("%")).alias("line"),
        fn.in_units(price, 1000).alias("thousands"),
        F.floor(price / 1000).alias("whole_thousands"),
        fn.ratio(price, F.length("Region")).alias("price_ratio"),
        fn.filled_text(F.col("District")).alias("has_district"),
        fn.timestamp_text(F.col("DateProprietorAdded").cast("timestamp")).alias("added_text"),
        fn.pad_left(price, 8, "0").alias("padded"),
        fn.pad_with_sequence(F.col("Postcode"), 5).alias("numbered"),
        fn.repeat_char("!", 5).alias("marks"),
    )


@query(
    f"""
WITH {INDEX_SQL}
SELECT "Datetaken", "RegionName", CAST(year("Datetaken") AS INTEGER) AS year,
  CAST(month("Datetaken") AS INTEGER) AS month, CAST(day("Datetaken") AS INTEGER) AS day FROM price_index
"""
)
def q_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year, month and day of every index row."""
    return date_parts(price_index(spark, sf_dir).select("Datetaken", "RegionName"), "Datetaken")


@query(
    """
SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, round(CAST(embedding[pos] AS DOUBLE) / 255.0::DOUBLE, 12) AS value
FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS pos FROM embeddings)
"""
)
def q_scaled_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array elements divided by 255."""
    scaled = table(spark, sf_dir, "embeddings").select("vec_id", fn.scale_array(F.col("embedding")).alias("scaled"))
    return scaled.select("vec_id", F.posexplode("scaled").alias("pos", "value")).withColumn(
        "value", F.round("value", 12)
    )
