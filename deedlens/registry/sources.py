"""Tables written and read back through every file format and the catalog.

Each query must give the rows it had before the trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from deedlens.operators import profile, staging
from deedlens.operators.windows import yearly_average
from deedlens.plans.ownership import clean_titles, labelled_titles, write_ownership_tables
from deedlens.plans.prices import round_trip
from deedlens.registry.base import SQL, query
from deedlens.registry.reports import bad
from deedlens.registry.samples import augmented_sql
from deedlens.sources import catalog, files
from deedlens.sources.connectors import SourceSpec
from deedlens.sources.schemas import titles_schema
from deedlens.sources.scratch import scratch_path
from deedlens.standins import (
    FULL_LABELLED_SQL,
    INDEX_SQL,
    LABELLED_SQL,
    OWNERSHIP,
    PRICES,
    TRANSACTIONS_DDL,
    TRANSACTIONS_SQL,
    full_titles,
    messages,
    price_index,
    titles,
    transactions,
)


@query(SQL["q_messages"])
def q_xml_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as XML records."""
    path = scratch_path(spark, "messages-xml")
    files.write_xml(messages(spark, sf_dir), path, staging.ROW_TAG, staging.ROOT_TAG)
    read = files.read_xml(spark, path, staging.ROW_TAG, staging.MESSAGE_DDL)
    return read.select("*", "sms_template_variables.*").drop("sms_template_variables")


@query(SQL["q_stage_accepted"])
def q_partitioned_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted messages as parquet partitioned by broadcast and brand."""
    path = scratch_path(spark, "staged")
    accepted, _ = staging.stage_messages(messages(spark, sf_dir), F.current_date())
    files.write_partitioned(accepted, path, staging.PARTITIONS)
    return files.read_partitioned(spark, path, staging.STAGED_DDL)


@query(f"WITH {TRANSACTIONS_SQL} SELECT * FROM transactions")
def q_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as tab-separated text."""
    path = scratch_path(spark, "transactions-tsv")
    files.write_delimited(transactions(spark, sf_dir), path)
    return files.read_delimited(spark, path, TRANSACTIONS_DDL)


@query(
    SQL["q_null_profile"].replace(
        "SELECT * FROM profile", """SELECT "column" || chr(9) || null_pct || '%' AS column_null_percentage FROM profile"""
    )
)
def q_csv_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The NULL report as one CSV file."""
    path = scratch_path(spark, "null-report")
    report = profile.null_report(profile.null_profile(clean_titles(titles(spark, sf_dir))))
    files.write_csv_report(report, path)
    return spark.read.schema("column_null_percentage string").csv(path, header=True)


@query(f"""WITH {LABELLED_SQL} SELECT * EXCLUDE (rule_id) FROM bad""")
def q_catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged titles as a catalog table with a declared schema."""
    path = scratch_path(spark, "flagged-table")
    name = "deedlens_" + path.rsplit("-", 1)[1]
    schema = StructType(titles(spark, sf_dir).schema.fields)
    for flag in ("missing_proprietor_name", "is_fraud"):
        schema = schema.add(flag, IntegerType(), False)
    catalog.write_table(bad(spark, sf_dir), "default", name, schema, path=path)
    return catalog.load_table(spark, "default", name)


_CLEANED = [f.name for f in titles_schema()]
_CLEANED_SQL = ", ".join(f'"{c}"' for c in _CLEANED)


@query(f"WITH {FULL_LABELLED_SQL} SELECT {_CLEANED_SQL} FROM clean")
def q_drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with all their columns, cleaned: two of them are dropped."""
    return clean_titles(full_titles(spark, sf_dir))


@query(f"WITH {FULL_LABELLED_SQL} SELECT {_CLEANED_SQL} FROM clean")
def q_write_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned titles as a catalog table with the declared schema, read back."""
    path = scratch_path(spark, "titles-table")
    name = "deedlens_" + path.rsplit("-", 1)[1]
    catalog.write_table(clean_titles(full_titles(spark, sf_dir)), "default", name, titles_schema(), path=path)
    return catalog.load_table(spark, "default", name)


@query(
    f"""
WITH {FULL_LABELLED_SQL}
SELECT 'good' AS loaded, {_CLEANED_SQL}, missing_proprietor_name, is_fraud FROM labelled WHERE is_fraud = 0
UNION ALL SELECT 'bad', {_CLEANED_SQL}, missing_proprietor_name, is_fraud FROM bad
"""
)
def q_load_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both labelled tables, written with the declared schema and loaded together."""
    rows = labelled_titles(clean_titles(full_titles(spark, sf_dir)), OWNERSHIP)
    path = scratch_path(spark, "labelled")
    mark = path.rsplit("-", 1)[1]
    for kind, value in (("good", 0), ("bad", 1)):
        part = rows.filter(F.col("is_fraud") == value)
        catalog.write_table(part, "default", f"{kind}_{mark}", titles_schema(labelled=True), path=f"{path}/{kind}")
    good, bad_rows = catalog.load_labelled(spark, "default", f"good_{mark}", f"bad_{mark}")
    marked = good.withColumn("loaded", F.lit("good")).unionByName(bad_rows.withColumn("loaded", F.lit("bad")))
    return marked.select("loaded", *_CLEANED, "missing_proprietor_name", "is_fraud")


def _analyzed_titles(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "analyzed")
    name = "deedlens_" + path.rsplit("-", 1)[1]
    catalog.write_table(clean_titles(titles(spark, sf_dir)), "default", name, path=path)
    catalog.analyze_columns(spark, "default", name)
    return name


@query(SQL["q_null_profile"])
def q_profile_from_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The NULL profile of cleaned titles from the statistics that the catalog keeps."""
    return profile.null_profile_of(catalog.column_statistics(spark, "default", _analyzed_titles(spark, sf_dir)))


@query(
    f"""
WITH {LABELLED_SQL}
SELECT 'PricePaid' AS "column", CAST(min("PricePaid") AS VARCHAR) AS minimum, CAST(max("PricePaid") AS VARCHAR) AS maximum FROM clean
UNION ALL SELECT 'DateProprietorAdded', CAST(min("DateProprietorAdded") AS VARCHAR), CAST(max("DateProprietorAdded") AS VARCHAR) FROM clean
"""
)
def q_ranges_from_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smallest and largest price and date from the same statistics."""
    found = catalog.column_statistics(spark, "default", _analyzed_titles(spark, sf_dir))
    return found.select("column", "minimum", "maximum").where("minimum IS NOT NULL")


def _tables_sql() -> str:
    flags = "missing_proprietor_name, is_fraud"
    parts = {
        "bad_data": f"{flags} FROM augmented WHERE copy = 0",
        "synthetic_bad_data": f"{flags} FROM augmented WHERE copy > 0",
        "bad_fraud_data": f"{flags} FROM augmented",
        "good_offshore_data": 'NULL, NULL FROM clean c WHERE NOT EXISTS (SELECT 1 FROM complete k WHERE k."TitleNumber" = c."TitleNumber")',
    }
    selects = [f"SELECT '{name}' AS table_name, {_CLEANED_SQL}, {rest}" for name, rest in parts.items()]
    return f"WITH {augmented_sql(FULL_LABELLED_SQL)} {' UNION ALL '.join(selects)}"


@query(_tables_sql())
def q_ownership_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow's four tables, all columns but the vector, from one reading of the titles."""
    path = scratch_path(spark, "all-titles")
    mark = path.rsplit("-", 1)[1]
    write_ownership_tables(
        full_titles(spark, sf_dir), "default", OWNERSHIP, name=f"titles_{mark}", path=path, prefix=f"v{mark}_"
    )
    out = None
    for name in ("bad_data", "synthetic_bad_data", "bad_fraud_data", "good_offshore_data"):
        rows = spark.table(f"default.v{mark}_{name}").withColumn("table_name", F.lit(name)).drop("features")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out.select("table_name", *_CLEANED, "missing_proprietor_name", "is_fraud")


@query(
    f"""
WITH {INDEX_SQL},
years AS (SELECT DISTINCT year("Datetaken"), "RegionName" FROM price_index)
SELECT COUNT(*) AS rows_first, COUNT(*) AS rows_second, CAST(0 AS BIGINT) AS only_first, CAST(0 AS BIGINT) AS only_second,
  TRUE AS matched FROM years
"""
)
def q_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly averages computed from a saved index, saved, read back and reconciled."""
    source = SourceSpec("parquet", {"path": scratch_path(spark, "index")})
    target = SourceSpec("orc", {"path": scratch_path(spark, "yearly")})
    source.write(price_index(spark, sf_dir), "overwrite")
    return round_trip(spark, source, target, lambda index: yearly_average(index, "Datetaken", "RegionName", PRICES))
