"""Ownership tables derived from a star schema of orders, lines and events.

The real titles and price index belong to whoever holds them; these stand-ins
have the same columns and grow with the tables they are derived from. NULLs are
put in by key arithmetic. ``*_SQL`` says the same in ANSI SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedlens.functions.hashing import bucket
from deedlens.operators.generate import BRANDS, CAMPAIGNS, TEMPLATES, sample_messages
from deedlens.operators.label import OwnershipRules
from deedlens.sources.schemas import titles_schema

# The ninth decile of the order totals; a million would flag nothing here.
OWNERSHIP = OwnershipRules(high_price=450_000)
INDEX_THRESHOLD = 51_000
PRICES = {
    "AveragePrice": "avg_price",
    "FlatPrice": "avg_flat_price",
    "TerracedPrice": "avg_terraced_price",
    "SemiDetachedPrice": "avg_semi_detached_price",
    "DetachedPrice": "avg_detached_price",
}


# Columns of the star schema, so that opening a table reads no file.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One title per order."""
    # Large tables first: the two small ones then join without moving rows.
    sold = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    )
    return sold.selectExpr(
        "concat('T', o_orderkey) AS TitleNumber",
        "CASE WHEN o_orderkey % 97 = 0 THEN '93347' WHEN o_orderstatus = 'F' THEN 'Freehold' ELSE 'Leasehold' END AS Tenure",
        "concat(c_name, ', ', n_name) AS PropertyAddress",
        "CASE WHEN o_orderkey % 23 <> 0 THEN n_name END AS District",
        "r_name AS County",
        "CASE WHEN o_orderkey % 29 <> 0 THEN c_mktsegment END AS Region",
        "concat('PC', c_custkey % 100) AS Postcode",
        "CASE WHEN o_orderkey % 5 = 0 THEN 'Y' ELSE 'N' END AS MultipleAddressIndicator",
        "CASE WHEN o_orderkey % 11 <> 0 THEN cast(round(o_totalprice) AS int) END AS PricePaid",
        "CASE WHEN o_orderkey % 31 <> 0 THEN c_name END AS ProprietorName1",
        "CASE WHEN o_orderkey % 4 <> 0 THEN c_mktsegment END AS ProprietorName2",
        "CASE WHEN o_orderkey % 41 <> 0 THEN c_name END AS Proprietor1Address1",
        "CASE WHEN o_orderkey % 37 <> 0 THEN if(o_orderkey % 3 = 0, 'UK', n_name) END AS CountryIncorporated1",
        "cast(NULL AS string) AS Proprietor2Address3",
        "cast(o_orderdate AS date) AS DateProprietorAdded",
    )


TITLES_SQL = """
titles AS (
  SELECT 'T' || o_orderkey AS "TitleNumber",
    CASE WHEN o_orderkey % 97 = 0 THEN '93347' WHEN o_orderstatus = 'F' THEN 'Freehold' ELSE 'Leasehold' END AS "Tenure",
    c_name || ', ' || n_name AS "PropertyAddress",
    CASE WHEN o_orderkey % 23 <> 0 THEN n_name END AS "District",
    r_name AS "County",
    CASE WHEN o_orderkey % 29 <> 0 THEN c_mktsegment END AS "Region",
    'PC' || (c_custkey % 100) AS "Postcode",
    CASE WHEN o_orderkey % 5 = 0 THEN 'Y' ELSE 'N' END AS "MultipleAddressIndicator",
    CASE WHEN o_orderkey % 11 <> 0 THEN CAST(round(o_totalprice) AS INTEGER) END AS "PricePaid",
    CASE WHEN o_orderkey % 31 <> 0 THEN c_name END AS "ProprietorName1",
    CASE WHEN o_orderkey % 4 <> 0 THEN c_mktsegment END AS "ProprietorName2",
    CASE WHEN o_orderkey % 41 <> 0 THEN c_name END AS "Proprietor1Address1",
    CASE WHEN o_orderkey % 37 <> 0 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'UK' ELSE n_name END END AS "CountryIncorporated1",
    CAST(NULL AS VARCHAR) AS "Proprietor2Address3",
    CAST(o_orderdate AS DATE) AS "DateProprietorAdded"
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

LABELLED_SQL = (
    TITLES_SQL
    + """,
clean AS (SELECT * FROM titles WHERE "Tenure" <> '93347'),
complete AS (
  SELECT * FROM clean
  WHERE "Tenure" IS NOT NULL AND "PropertyAddress" IS NOT NULL AND "District" IS NOT NULL AND "County" IS NOT NULL
    AND "Region" IS NOT NULL AND "Postcode" IS NOT NULL AND "MultipleAddressIndicator" IS NOT NULL
    AND "PricePaid" IS NOT NULL),
labelled AS (
  SELECT *,
    CASE WHEN "ProprietorName1" IS NULL OR "ProprietorName2" IS NULL THEN 1 ELSE 0 END AS missing_proprietor_name,
    CASE WHEN "PricePaid" > 450000 THEN 1
      WHEN "ProprietorName1" IS NULL OR "ProprietorName2" IS NULL OR "Proprietor1Address1" IS NULL THEN 1
      WHEN "CountryIncorporated1" <> 'UK' THEN 1 ELSE 0 END AS is_fraud,
    CASE WHEN "PricePaid" > 450000 THEN 'high_price'
      WHEN "ProprietorName1" IS NULL OR "ProprietorName2" IS NULL OR "Proprietor1Address1" IS NULL THEN 'missing_proprietor'
      WHEN "CountryIncorporated1" <> 'UK' THEN 'foreign_company' END AS rule_id
  FROM complete),
bad AS (SELECT * FROM labelled WHERE is_fraud = 1)"""
)


# Position among the columns decides how often one that the star schema knows nothing about is NULL.
_FULL_COLUMNS = [f.name for f in titles_schema(loaded=True)]
_SHORT_COLUMNS = re.findall(r'AS "(\w+)"', TITLES_SQL)


def full_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with all columns of the declared schema, also those that cleaning drops."""
    k = F.col("_k")
    made = {name: n for n, name in enumerate(_FULL_COLUMNS) if name not in _SHORT_COLUMNS}
    kinds = F.array(*[F.struct(F.lit(f"{name}-").alias("name"), F.lit(n).alias("n")) for name, n in made.items()])
    # One expression over a list, not one for each column: together these are more code than the JVM compiles in a method.
    values = F.transform(kinds, lambda c: F.when(k % (c["n"] + 3) != 0, F.concat(c["name"], (k % (c["n"] + 5)).cast("string"))))
    numbered = titles(spark, sf_dir).withColumn("_k", F.substring("TitleNumber", 2, 20).cast("bigint"))
    columns = {name: F.col("_made")[i] for i, name in enumerate(made)}
    return numbered.withColumn("_made", values).withColumns(columns).select(*_FULL_COLUMNS)


def _full_column_sql(n: int, name: str) -> str:
    if name in _SHORT_COLUMNS:
        return f'"{name}"'
    return f"""CASE WHEN k % {n + 3} <> 0 THEN '{name}-' || (k % {n + 5}) END AS "{name}\""""


# The same as TITLES_SQL and LABELLED_SQL, on titles with all columns.
FULL_TITLES_SQL = (
    TITLES_SQL.replace("titles AS (", "short_titles AS (", 1)
    + f"""
, titles AS (SELECT {", ".join(_full_column_sql(n, name) for n, name in enumerate(_FULL_COLUMNS))}
  FROM (SELECT *, CAST(substr("TitleNumber", 2) AS BIGINT) AS k FROM short_titles))"""
)
FULL_LABELLED_SQL = FULL_TITLES_SQL + LABELLED_SQL.removeprefix(TITLES_SQL)


def price_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly average prices per nation.

    Lines are summed per supplier and month before they meet the suppliers, so
    a supplier with many lines is one row per task and month in that join.
    """
    pence = "cast(round(l_extendedprice * 100) AS bigint)"
    kinds = {
        "AveragePrice": "true",
        "FlatPrice": "l_returnflag = 'A'",
        "TerracedPrice": "l_returnflag = 'R'",
        "SemiDetachedPrice": "l_returnflag = 'N'",
        "DetachedPrice": "l_linestatus = 'O'",
    }
    sums = [f"sum(CASE WHEN {condition} THEN {pence} END) AS {name}_sum" for name, condition in kinds.items()]
    counts = [f"count_if({condition}) AS {name}_n" for name, condition in kinds.items()]
    by_supplier = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", F.expr("trunc(cast(l_shipdate AS date), 'month') AS Datetaken"))
        .agg(*[F.expr(e) for e in sums + counts])
    )
    monthly = (
        by_supplier.join(table(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey"))
        .groupBy("Datetaken", "n_name", "n_nationkey")
        .agg(*[F.expr(f"sum({name}_{part}) AS {name}_{part}") for name in kinds for part in ("sum", "n")])
    )
    return monthly.selectExpr(
        "Datetaken",
        "lower(n_name) AS RegionName",
        "concat('E', n_nationkey) AS AreaCode",
        "cast(AveragePrice_n AS double) AS SalesVolume",
        *[f"{name}_sum / nullif({name}_n, 0) / 100 AS {name}" for name in kinds],
    )


def _price_sql(name: str, condition: str) -> str:
    cents = "CAST(round(l_extendedprice * 100) AS BIGINT)"
    return (
        f"CAST(SUM(CASE WHEN {condition} THEN {cents} END) AS BIGINT) "
        f'/ NULLIF(COUNT(CASE WHEN {condition} THEN 1 END), 0) / 100 AS "{name}"'
    )


INDEX_SQL = f"""
price_index AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Datetaken",
    lower(n_name) AS "RegionName", 'E' || n_nationkey AS "AreaCode",
    CAST(COUNT(*) AS DOUBLE) AS "SalesVolume",
    {_price_sql("AveragePrice", "TRUE")},
    {_price_sql("FlatPrice", "l_returnflag = 'A'")},
    {_price_sql("TerracedPrice", "l_returnflag = 'R'")},
    {_price_sql("SemiDetachedPrice", "l_returnflag = 'N'")},
    {_price_sql("DetachedPrice", "l_linestatus = 'O'")}
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY 1, 2, 3)"""


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A card transaction per event; most large ones are fraud."""
    events = table(spark, sf_dir, "events")
    fraud = (F.col("value") > 120) & (bucket(F.col("event_id"), "fraud") < int(0.8 * 2**32))
    return events.select(
        F.col("event_id").cast("bigint").alias("transaction_id"),
        F.col("value").alias("amount"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("merchant"),
        F.col("event_type").alias("category"),
        fraud.alias("is_fraud"),
    )


TRANSACTIONS_DDL = "transaction_id BIGINT, amount DOUBLE, merchant STRING, category STRING, is_fraud BOOLEAN"


def sql_bucket(key: str, seed: int | str, part: int = 0) -> str:
    """:func:`deedlens.functions.hashing.bucket` in SQL."""
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), {1 + 8 * part}, 8) AS BIGINT)"


def sql_wide_bucket(key: str, seed: int | str) -> str:
    """:func:`deedlens.functions.hashing.wide_bucket` in SQL."""
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), 1, 13) AS BIGINT)"


TRANSACTIONS_SQL = f"""
transactions AS (
  SELECT event_id AS transaction_id, value AS amount, 'u' || user_id AS merchant, event_type AS category,
    value > 120 AND {sql_bucket("event_id", "fraud")} < {int(0.8 * 2**32)} AS is_fraud
  FROM events)"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A broadcast message per event."""
    return sample_messages(table(spark, sf_dir, "events"), "event_id")


def _sql_pick(values: list[str], key: str, seed: int | str, part: int = 0) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[CAST({sql_bucket(key, seed, part)} % {len(values)} AS INTEGER) + 1]"


_DIGITS = f"lpad(CAST({sql_bucket('event_id', 42)} % 1000000000 AS VARCHAR), 9, '0')"
MESSAGES_SQL = f"""
messages AS (
  SELECT {_sql_pick(CAMPAIGNS, "event_id", 42, 1)} AS sms_campaign_code,
    CASE WHEN event_id % 7 = 0 THEN '7' || substr({_DIGITS}, 1, 8)
      WHEN event_id % 11 = 0 THEN '9' || {_DIGITS} ELSE '7' || {_DIGITS} END AS target_mobile_no,
    {_sql_pick(TEMPLATES, "event_id", 42, 2)} AS sms_template_code,
    {sql_bucket("event_id", 42, 3)} % 90000000 + 10000000 AS sms_request_external_ref,
    {sql_bucket("event_id", "42t")} + 100000000000 AS sms_request_external_txn_ref,
    {_sql_pick(BRANDS, "event_id", "42b")} AS brand_code,
    CAST({sql_wide_bucket("event_id", "42p")} % 9000000000 + 1000000000 AS VARCHAR) AS ocis_mrg_pty_id
  FROM events),
checked AS (
  SELECT *, CASE WHEN target_mobile_no IS NULL THEN 'missing number'
    WHEN NOT regexp_matches(target_mobile_no, '^[0-9]+$') THEN 'not a number'
    WHEN length(target_mobile_no) <> 10 THEN 'wrong length'
    WHEN NOT starts_with(target_mobile_no, '7') THEN 'wrong start' END AS reason
  FROM messages)"""


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A card account per event, with block codes, a flag, a status and a due time."""
    events = table(spark, sf_dir, "events")
    k = F.col("event_id")
    return events.select(
        k.alias("account_id"),
        F.upper(F.substring("event_type", 1, 1)).alias("block_code_1"),
        F.when(k % 13 != 0, F.substring(F.lit("ABCDEFGH"), (k % 8 + 1).cast("int"), F.lit(1))).alias("block_code_2"),
        (k % 3).cast("int").alias("pmt_ach_flag"),
        F.substring(F.lit("ABCD"), (k % 4 + 1).cast("int"), F.lit(1)).alias("int_status"),
        F.col("ts").alias("due"),
    )


ACCOUNTS_SQL = """
accounts AS (
  SELECT event_id AS account_id, upper(substr(event_type, 1, 1)) AS block_code_1,
    CASE WHEN event_id % 13 <> 0 THEN substr('ABCDEFGH', CAST(event_id % 8 + 1 AS INTEGER), 1) END AS block_code_2,
    CAST(event_id % 3 AS INTEGER) AS pmt_ach_flag,
    substr('ABCD', CAST(event_id % 4 + 1 AS INTEGER), 1) AS int_status, ts AS due
  FROM events)"""
