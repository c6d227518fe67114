"""Catalog tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DateType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from deedlens.functions.text import quoted


def load_table(spark: SparkSession, db: str, name: str, analyze: bool = False) -> DataFrame:
    """Read a catalog table, failing when it is absent.

    ``analyze`` runs a job that refreshes the statistics from which Catalyst sizes its joins.
    """
    full_name = f"{quoted(db)}.{quoted(name)}"
    if not spark.catalog.tableExists(full_name):
        raise LookupError(f"no such table: {db}.{name}")
    if analyze:
        spark.sql(f"ANALYZE TABLE {full_name} COMPUTE STATISTICS")
    return spark.table(full_name)


def table_rows(spark: SparkSession, db: str, name: str) -> int:
    """Number of rows of a table, counted from the files' footers."""
    return spark.table(f"{quoted(db)}.{quoted(name)}").count()


_ANALYZED = "deedlens.analyzed"


def _files_state(spark: SparkSession, full_name: str) -> str:
    """Number, bytes and newest change of a table's files."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {full_name}").where("col_name = 'Location'").first()
    path = spark._jvm.org.apache.hadoop.fs.Path(described["data_type"])
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    n = size = newest = 0
    while found.hasNext():
        file = found.next()
        # Spark's marker files say nothing about the rows.
        if file.getPath().getName().startswith(("_", ".")):
            continue
        n, size, newest = n + 1, size + file.getLen(), max(newest, file.getModificationTime())
    return f"{n} {size} {newest}"


def analyze_columns(spark: SparkSession, db: str, name: str) -> None:
    """Have row count, NULL counts, minima and maxima of a table kept in the catalog.

    One pass over the table. Columns of types that the catalog keeps no figures
    of, such as vectors, are left out. The state of the files is noted, so that
    :func:`column_statistics` can tell figures that no longer hold.
    """
    full_name = f"{quoted(db)}.{quoted(name)}"
    known = (NumericType, StringType, BooleanType, BinaryType, DateType, TimestampType, TimestampNTZType)
    columns = [quoted(f.name) for f in spark.table(full_name).schema if isinstance(f.dataType, known)]
    spark.catalog.refreshTable(full_name)
    state = _files_state(spark, full_name)
    spark.sql(f"ANALYZE TABLE {full_name} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    spark.sql(f"ALTER TABLE {full_name} SET TBLPROPERTIES ('{_ANALYZED}' = '{state}')")


def column_statistics(spark: SparkSession, db: str, name: str) -> DataFrame:
    """``column, row_count, null_count, distinct_count, minimum, maximum`` from the catalog, without reading a row.

    ``distinct_count`` is an estimate, minimum and maximum are text and NULL for
    columns that have none. A table that was never analyzed, or whose files have
    changed since, is refused with a LookupError: its figures would be wrong.
    """
    full_name = f"{quoted(db)}.{quoted(name)}"
    if not spark.catalog.tableExists(full_name):
        raise LookupError(f"no such table: {db}.{name}")
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {full_name}").collect()}
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {full_name}").where("col_name = 'Statistics'").first()
    counted = re.search(r"(\d+) rows", described["data_type"]) if described else None
    if _ANALYZED not in properties or counted is None:
        raise LookupError(f"no statistics of {db}.{name}: analyze it first")
    if properties[_ANALYZED] != _files_state(spark, full_name):
        raise LookupError(f"the files of {db}.{name} have changed since it was analyzed")
    rows = []
    for field in spark.table(full_name).schema:
        info = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {full_name} {quoted(field.name)}").collect()}
        if info.get("num_nulls") in (None, "NULL"):
            continue
        low, high = (None if info.get(k) in (None, "NULL") else info[k] for k in ("min", "max"))
        rows.append((field.name, int(counted[1]), int(info["num_nulls"]), int(info["distinct_count"]), low, high))
    return spark.createDataFrame(
        rows, "column string, row_count long, null_count long, distinct_count long, minimum string, maximum string"
    )


def load_labelled(spark: SparkSession, db: str, good: str, bad: str) -> tuple[DataFrame, DataFrame]:
    """Both labelled tables; either one missing is an error."""
    return load_table(spark, db, good), load_table(spark, db, bad)


def _own_name(df: DataFrame, name: str) -> str:
    """The name a frame itself gives to a column, which may differ in case."""
    return next(c for c in df.columns if c.lower() == name.lower())


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast to a declared schema.

    A column the frame lacks is an error. A NULL in a field declared NOT NULL
    fails the job that meets it.
    """
    lacking = [f.name for f in schema if f.name.lower() not in {c.lower() for c in df.columns}]
    if lacking:
        raise ValueError(f"columns not in the frame: {lacking}")
    columns = []
    for field in schema:
        value = F.col(quoted(field.name))
        # A column that already has the type is left alone; vectors know no cast.
        if df.schema[_own_name(df, field.name)].dataType != field.dataType:
            value = value.cast(field.dataType)
        if not field.nullable:
            message = F.lit(f"NULL in required column {field.name}")
            value = F.when(value.isNotNull(), value).otherwise(F.raise_error(message).cast(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns)


def write_table(
    df: DataFrame,
    db: str,
    name: str,
    schema: StructType | None = None,
    path: str | None = None,
) -> None:
    """Overwrite a catalog table with the declared schema; errors are not swallowed."""
    out = conform(df, schema) if schema is not None else df
    writer = out.write.mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(f"{db}.{name}")
