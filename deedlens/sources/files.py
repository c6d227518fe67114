"""Delimited text, XML, CSV reports and partitioned parquet."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_delimited(
    spark: SparkSession, path: str, ddl: str | StructType, sep: str = "\t", header: bool = True
) -> DataFrame:
    """Read delimited text with a fixed schema; a row that does not fit fails the read."""
    return (
        spark.read.schema(ddl)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path, sep=sep, header=header)
    )


def write_delimited(df: DataFrame, path: str, sep: str = "\t", header: bool = True) -> None:
    df.write.mode("overwrite").csv(path, sep=sep, header=header)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str | StructType) -> DataFrame:
    """One row per ``row_tag`` element; a broken element fails the job.

    The schema is declared, not inferred: inference costs a scan and would turn
    phone digits into numbers and drop their leading zeros.
    """
    return spark.read.format("xml").option("rowTag", row_tag).option("mode", "FAILFAST").schema(schema).load(path)


def read_xml_or_raw(
    spark: SparkSession, path: str, row_tag: str, schema: str | StructType, raw: str = "_raw"
) -> DataFrame:
    """One row per ``row_tag`` element, a broken one with its text in ``raw`` and whatever could be read beside it.

    Broken are elements that are no well-formed XML and values that do not fit
    the declared type. ``raw`` is NULL for all others.

    The XML reader gives up a file at the first broken element. So the text is
    cut into elements first: behind each closing tag, which is how the text
    reader splits files over tasks, and before each opening tag, so that an
    element without an end does not take the next one along. Each is then parsed
    by itself, which keeps its neighbours. Row elements that are nested, empty
    (``<tag/>``) or quoted in a comment are not told apart from others.
    """
    declared = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    whole = StructType([*declared, StructField(raw, StringType())])
    chunks = spark.read.option("lineSep", f"</{row_tag}>").text(path)
    opening = rf"<{re.escape(row_tag)}(?=[\s>])"
    parts = F.split("value", f"(?={opening})")
    # Only the last part of a chunk was followed by a closing tag.
    elements = chunks.select(F.size(parts).alias("n"), F.posexplode(parts).alias("at", "element")).where(
        F.col("element").rlike(f"^{opening}")
    )
    closed = F.when(F.col("at") == F.col("n") - 1, F.concat("element", F.lit(f"</{row_tag}>"))).otherwise(F.col("element"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": raw, "rowTag": row_tag}
    return elements.select(F.from_xml(closed, whole, options).alias("row")).select("row.*")


def write_xml(df: DataFrame, path: str, row_tag: str, root_tag: str) -> None:
    (
        df.write.format("xml")
        .mode("overwrite")
        .option("rowTag", row_tag)
        .option("rootTag", root_tag)
        .save(path)
    )


def write_csv_report(df: DataFrame, path: str) -> None:
    """One CSV file with a header. Only for reports whose size is fixed by the schema."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> None:
    """Partitioned parquet; overwriting replaces only the partitions in the frame.

    The rebalance hint gathers each partition value in few files, and AQE
    splits a value that holds a large share of the rows over several tasks.
    """
    (
        df.hint("rebalance", *by)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def read_partitioned(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Read with declared types, so that partition values keep theirs."""
    return spark.read.schema(schema).parquet(path)
