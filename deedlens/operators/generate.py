"""Generated rows for load tests and demonstrations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deedlens.functions.hashing import bucket, random_letters, standard_normal, wide_bucket
from deedlens.functions.scalars import (
    clustered,
    clustered_fraction,
    pad_by_value,
    pad_left,
    randomised,
    repeat_char,
    scattered,
)

# Invented campaigns, templates and brands of a sample message; nothing depends on their values.
CAMPAIGNS = ["SPRING", "SUMMER", "AUTUMN", "WINTER"]
TEMPLATES = ["WELCOME", "REMINDER", "RECEIPT", "NOTICE", "SURVEY"]
BRANDS = ["NORTH", "SOUTH", "EAST"]


def pick(values: Sequence[str], key: Column, seed: int | str, part: int = 0) -> Column:
    """One of ``values``, fixed by key and seed."""
    index = (bucket(key, seed, part) % len(values)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), index)


def generated_columns(df: DataFrame, x: str, n: Column, seed: int) -> DataFrame:
    """Add generator columns for ids ``x`` counted from one, ``n`` rows in all."""
    key = F.col(x)
    return df.withColumns(
        {
            "clustered": clustered(key, n),
            "clustered_fraction": clustered_fraction(key, n),
            "scattered": scattered(key, n),
            "randomised": randomised(key, n, seed),
            "spread": F.abs(standard_normal(key, seed) * n),
            "random_string": random_letters(key, seed, 50),
            "small_vc": pad_left(key, 10, " "),
            "padded": pad_by_value(key, 20, seed),
            "padding": repeat_char("x", 40),
        }
    )


def generate_rows(spark: SparkSession, n: int, seed: int) -> DataFrame:
    """``n`` generated rows with ids from one."""
    ids = spark.range(1, n + 1)
    return generated_columns(ids, "id", F.lit(n), seed)


def demo_people(df: DataFrame, key: str, seed: int = 42, missing: float = 0.1) -> DataFrame:
    """A mixed-type row per row of ``df``: age with gaps, price, gender, district."""
    k = F.col(key)
    age = (bucket(k, seed, 0) % 47).cast("int") + 18
    gap = bucket(k, seed, 1) < F.lit(int(missing * 2**32))
    return df.select(
        k,
        F.when(~gap, age).alias("age"),
        ((bucket(k, seed, 2) % 400_000).cast("int") + 100_000).alias("price"),
        pick(["M", "F"], k, seed, 3).alias("gender"),
        pick(["A", "B", "C", "D"], k, f"{seed}d").alias("district"),
    )


def sample_messages(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """A broadcast message per row of ``df``, with numbers of wrong length and wrong start."""
    k = F.col(key)
    digits = F.lpad((bucket(k, seed, 0) % 1_000_000_000).cast("string"), 9, "0")
    number = (
        F.when(k % 7 == 0, F.concat(F.lit("7"), F.substring(digits, 1, 8)))
        .when(k % 11 == 0, F.concat(F.lit("9"), digits))
        .otherwise(F.concat(F.lit("7"), digits))
    )
    return df.select(
        pick(CAMPAIGNS, k, seed, 1).alias("sms_campaign_code"),
        number.alias("target_mobile_no"),
        pick(TEMPLATES, k, seed, 2).alias("sms_template_code"),
        (bucket(k, seed, 3) % 90_000_000 + 10_000_000).alias("sms_request_external_ref"),
        (bucket(k, f"{seed}t") + 100_000_000_000).alias("sms_request_external_txn_ref"),
        F.struct(
            pick(BRANDS, k, f"{seed}b").alias("brand_code"),
            (wide_bucket(k, f"{seed}p") % 9_000_000_000 + 1_000_000_000).cast("string").alias("ocis_mrg_pty_id"),
        ).alias("sms_template_variables"),
    )
