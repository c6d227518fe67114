"""Sources and sinks that live outside Spark, as option mappings.

The BigQuery and Redis connectors are separate packages that must be on the
classpath; the functions only say what to ask of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class SourceSpec:
    """A format name and its options."""

    format: str
    options: Mapping[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format(self.format).options(**self.options).load()

    def write(self, df: DataFrame, mode: str) -> None:
        df.write.format(self.format).options(**self.options).mode(mode).save()


@dataclass(frozen=True)
class JdbcPartitioning:
    """Split of a JDBC read into ``parts`` parallel range queries on one column."""

    column: str
    lower: str
    upper: str
    parts: int


def jdbc(
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str,
    fetchsize: int = 10_000,
    partitioning: JdbcPartitioning | None = None,
) -> SourceSpec:
    options = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "fetchsize": str(fetchsize),
    }
    if partitioning is not None:
        options |= {
            "partitionColumn": partitioning.column,
            "lowerBound": str(partitioning.lower),
            "upperBound": str(partitioning.upper),
            "numPartitions": str(partitioning.parts),
        }
    return SourceSpec("jdbc", options)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str,
    fetchsize: int = 10_000,
    partitioning: JdbcPartitioning | None = None,
    predicates: Sequence[str] = (),
) -> DataFrame:
    """Read a database table.

    Without ``partitioning`` or ``predicates`` the whole table comes through one
    connection; give one of them for anything large. Predicates must not
    overlap and must cover the table; they suit a column whose values are
    uneven, where equal ranges would leave one task with most of the rows.
    """
    spec = jdbc(url, table, user, password, driver, fetchsize, partitioning)
    if not predicates:
        return spec.read(spark)
    properties = {k: v for k, v in spec.options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str,
    mode: str,
    connections: int = 16,
    batchsize: int = 10_000,
) -> None:
    """Write through at most ``connections`` parallel connections."""
    options = dict(jdbc(url, table, user, password, driver).options)
    del options["fetchsize"]
    options |= {"numPartitions": str(connections), "batchsize": str(batchsize)}
    SourceSpec("jdbc", options).write(df, mode)


def bigquery(dataset: str, table: str, credentials_file: str) -> SourceSpec:
    return SourceSpec(
        "bigquery",
        {"credentialsFile": credentials_file, "dataset": dataset, "table": table},
    )


def redis(table: str, key_column: str, infer_schema: bool = False) -> SourceSpec:
    options = {"table": table, "key.column": key_column}
    if infer_schema:
        options["infer.schema"] = "true"
    return SourceSpec("org.apache.spark.sql.redis", options)
