"""Samples, splits, generated rows and comparisons of frames."""

from __future__ import annotations

import re
from itertools import product
from math import factorial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedlens.operators import compare, generate, sampling
from deedlens.operators.compare import quality_report
from deedlens.plans.ownership import BAD, clean_titles, mark_titles
from deedlens.plans.prices import index_flow, regional_sample
from deedlens.registry.base import query
from deedlens.registry.reports import bad, labelled
from deedlens.standins import (
    INDEX_SQL,
    INDEX_THRESHOLD,
    LABELLED_SQL,
    OWNERSHIP,
    TITLES_SQL,
    price_index,
    sql_bucket,
    sql_wide_bucket,
    table,
    titles,
)

_SEED = 42


def _poisson_sql(key: str, seed: int, rate: str) -> str:
    """Times a row is drawn: how many values of the Poisson distribution function lie at or below its draw."""
    u = f"({sql_bucket(key, seed)} / 4294967296.0::DOUBLE)"
    partial = "CAST(1.0 AS DOUBLE)"
    steps = [f"CAST({u} >= exp(-{rate}) AS INTEGER)"]
    for k in range(1, 13):
        partial += f" + pow({rate}, {k}) / {factorial(k)}.0::DOUBLE"
        steps.append(f"CAST({u} >= exp(-{rate}) * ({partial}) AS INTEGER)")
    return " + ".join(steps)


def augmented_sql(labelled_sql: str) -> str:
    """Flagged titles and their draws, after the labelled titles of any stand-in."""
    return f"""
{labelled_sql},
share AS (SELECT (SELECT COUNT(*) FROM bad) / (SELECT COUNT(*) FROM titles) AS rate),
drawn AS (SELECT b.*, {_poisson_sql('b."TitleNumber"', _SEED, "rate")} AS times FROM bad b, share),
augmented AS (SELECT * EXCLUDE (times), CAST(unnest(generate_series(0, times)) AS INTEGER) AS copy FROM drawn)"""


_AUGMENTED_SQL = augmented_sql(LABELLED_SQL)


def augmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = bad(spark, sf_dir)
    rate = sampling.share_where(mark_titles(titles(spark, sf_dir), OWNERSHIP), F.col("part") == BAD)
    return sampling.augment(flagged, rate, _SEED, "TitleNumber")


@query(f"""WITH {_AUGMENTED_SQL} SELECT "TitleNumber", "PricePaid", copy FROM augmented""")
def q_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged titles with synthetic copies drawn at their own share, in random order."""
    rows = augmented(spark, sf_dir).select("TitleNumber", "PricePaid", "copy")
    return sampling.shuffle_rows(rows, _SEED, "TitleNumber", "copy")


@query(
    f"""
WITH {INDEX_SQL},
good AS (SELECT *, "RegionName" || '|' || CAST("Datetaken" AS VARCHAR) AS row_key
  FROM price_index WHERE "AveragePrice" < {INDEX_THRESHOLD}),
share AS (SELECT (SELECT COUNT(*) FROM good) / (SELECT COUNT(*) FROM price_index) AS rate),
drawn AS (SELECT good.*, {_poisson_sql("row_key", _SEED, "rate")} AS times FROM good, share)
SELECT "RegionName", "Datetaken", "AveragePrice", CAST(unnest(generate_series(0, times)) AS INTEGER) AS copy FROM drawn
"""
)
def q_bootstrap_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows below the threshold with synthetic copies drawn at their share."""
    run = index_flow(price_index(spark, sf_dir), INDEX_THRESHOLD, _SEED)
    return run.augmented.select("RegionName", "Datetaken", "AveragePrice", "copy")


@query(
    f"""
WITH {LABELLED_SQL}
SELECT "TitleNumber", CASE WHEN {sql_bucket('"TitleNumber"', _SEED)} / 4294967296.0::DOUBLE < 0.8::DOUBLE
  THEN 'train' ELSE 'test' END AS part FROM labelled
"""
)
def q_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled titles in training and test rows."""
    parts = sampling.split(labelled(spark, sf_dir), {"train": 0.8, "test": 0.2}, _SEED, "TitleNumber")
    return parts.select("TitleNumber", "part")


@query(
    f"""
WITH {LABELLED_SQL}
SELECT "TitleNumber", "PricePaid" FROM bad ORDER BY md5("TitleNumber" || '|{_SEED}'), "TitleNumber"
"""
)
def q_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged titles in a random order that the seed repeats."""
    return sampling.shuffle_rows(bad(spark, sf_dir).select("TitleNumber", "PricePaid"), _SEED, "TitleNumber")


@query(
    f"""
WITH {TITLES_SQL},
numbered AS (SELECT "TitleNumber", "District",
  CAST(row_number() OVER (PARTITION BY "District" ORDER BY "TitleNumber") AS INTEGER) AS row_in_group FROM titles)
SELECT * FROM numbered WHERE row_in_group <= 5
"""
)
def q_n_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five titles of every district."""
    return sampling.rows_per_group(titles(spark, sf_dir).select("TitleNumber", "District"), "District", 5, "TitleNumber")


@query(
    f"""
WITH {INDEX_SQL},
numbered AS (SELECT *, row_number() OVER (PARTITION BY "RegionName" ORDER BY "Datetaken") AS n
  FROM price_index WHERE "RegionName" IN ('nation_3', 'nation_15'))
SELECT "RegionName", "Datetaken", "AveragePrice" FROM numbered WHERE n <= 12
"""
)
def q_regional_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twelve months of two regions."""
    sample = regional_sample(price_index(spark, sf_dir), ["nation_3", "nation_15"], 12)
    return sample.select("RegionName", "Datetaken", "AveragePrice")


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_RANDOM_SQL = " || ".join(
    f"substr('{_LETTERS}', CAST({sql_bucket('x', f'{_SEED}|{n // 16}', n % 16 // 4)} // {52 ** (n % 4)} % 52 AS INTEGER) + 1, 1)"
    for n in range(50)
)


@query(
    f"""
WITH ids AS (SELECT o_orderkey + 1 AS x, (SELECT COUNT(*) FROM orders) AS n FROM orders)
SELECT x, CAST(floor(x - 1) AS DOUBLE) / n AS clustered, CAST(x - 1 AS DOUBLE) / n AS clustered_fraction,
  CAST((x - 1) % n AS DOUBLE) AS scattered, CAST({sql_wide_bucket("x", _SEED)} % n AS DOUBLE) AS randomised,
  round(abs(sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {sql_bucket("x", _SEED, 0)} / 4294967296.0::DOUBLE))
    * cos(2.0::DOUBLE * pi() * ({sql_bucket("x", _SEED, 1)} / 4294967296.0::DOUBLE)) * n), 4) AS spread,
  {_RANDOM_SQL} AS random_string,
  lpad(CAST(x AS VARCHAR), CAST(greatest(10, length(CAST(x AS VARCHAR))) AS INTEGER), ' ') AS small_vc,
  substr({_RANDOM_SQL}, 1, GREATEST(20 - x, 0)) || x AS padded,
  repeat('x', 40) AS padding
FROM ids
"""
)
def q_generator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generator columns for as many rows as there are orders."""
    orders = table(spark, sf_dir, "orders")
    n = orders.agg(F.count(F.lit(1)).alias("n")).scalar()
    ids = orders.select((F.col("o_orderkey") + 1).alias("x"))
    return generate.generated_columns(ids, "x", n, _SEED).withColumn("spread", F.round("spread", 4))


@query(
    f"""
SELECT c_custkey,
  CASE WHEN {sql_bucket("c_custkey", 42, 1)} >= {int(0.1 * 2**32)}
    THEN CAST({sql_bucket("c_custkey", 42, 0)} % 47 + 18 AS INTEGER) END AS age,
  CAST({sql_bucket("c_custkey", 42, 2)} % 400000 + 100000 AS INTEGER) AS price,
  (['M', 'F'])[CAST({sql_bucket("c_custkey", 42, 3)} % 2 AS INTEGER) + 1] AS gender,
  (['A', 'B', 'C', 'D'])[CAST({sql_bucket("c_custkey", "42d")} % 4 AS INTEGER) + 1] AS district
FROM customer
"""
)
def q_demo_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A demonstration row per customer."""
    return generate.demo_people(table(spark, sf_dir, "customer"), "c_custkey")


_TITLE_COLUMNS = re.findall(r'AS "(\w+)"', TITLES_SQL)
_QUALITY_TEXT = [*(c for c in _TITLE_COLUMNS if c not in ("PricePaid", "DateProprietorAdded")), "rule_id"]
_QUALITY_NUMBERS = ["PricePaid", "missing_proprietor_name", "is_fraud"]
_FIGURES = {
    "count": "COUNT",
    "mean": "AVG",
    "stddev": "stddev_samp",
    "min": "MIN",
    "max": "MAX",
}


def _quality_sql() -> str:
    parts = [
        """SELECT 'shape' AS section, CAST(NULL AS VARCHAR) AS "column", 'rows' AS statistic,
  CAST(COUNT(CASE WHEN copy = 0 THEN 1 END) AS DOUBLE) AS original,
  CAST(COUNT(CASE WHEN copy > 0 THEN 1 END) AS DOUBLE) AS synthetic FROM augmented""",
        f"SELECT 'shape', NULL, 'columns', {len(_QUALITY_TEXT) + 4}, {len(_QUALITY_TEXT) + 4}",
    ]
    for c, (statistic, function) in product(_QUALITY_NUMBERS, _FIGURES.items()):
        pair = ", ".join(
            f'round(CAST({function}(CASE WHEN copy {test} THEN "{c}" END) AS DOUBLE), 2)' for test in ("= 0", "> 0")
        )
        parts.append(f"SELECT 'describe', '{c}', '{statistic}', {pair} FROM augmented")
    for c in _QUALITY_TEXT:
        name = f'"{c}"'
        parts.append(
            f"""SELECT 'category', '{c}', {name}, CAST(COUNT(CASE WHEN copy = 0 THEN 1 END) AS DOUBLE),
  CAST(COUNT(CASE WHEN copy > 0 THEN 1 END) AS DOUBLE) FROM augmented GROUP BY {name}"""
        )
    return "\n  UNION ALL ".join(parts)


@query(
    f"""
WITH {_AUGMENTED_SQL},
report AS ({_quality_sql()})
SELECT *, round(synthetic - original, 2) AS difference FROM report
"""
)
def q_synth_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic against original flagged titles."""
    tagged = augmented(spark, sf_dir).withColumn("is_synthetic", F.col("copy") > 0).drop("copy", "features")
    return quality_report(tagged, "is_synthetic")


@query(
    f"""
WITH {LABELLED_SQL}
SELECT "TitleNumber", is_fraud FROM bad
UNION ALL SELECT "TitleNumber", is_fraud FROM labelled WHERE is_fraud = 0
"""
)
def q_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged and unflagged titles together again."""
    rows = labelled(spark, sf_dir).select("TitleNumber", "is_fraud")
    return compare.union_all(rows.filter("is_fraud = 1"), rows.filter("is_fraud = 0"))


_WHOLE = ", ".join(f'"{c}"' for c in _TITLE_COLUMNS)


@query(f"WITH {LABELLED_SQL} SELECT {_WHOLE} FROM clean EXCEPT SELECT {_WHOLE} FROM bad")
def q_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean titles that are not flagged, by all their columns."""
    return compare.except_rows(clean_titles(titles(spark, sf_dir)), bad(spark, sf_dir).select(*_TITLE_COLUMNS))


@query(f"WITH {_AUGMENTED_SQL} SELECT {_WHOLE} FROM augmented EXCEPT ALL SELECT {_WHOLE} FROM clean")
def q_except_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Augmented flagged titles without the clean ones, equal rows counted one by one: the synthetic copies."""
    rows = augmented(spark, sf_dir).select(*_TITLE_COLUMNS)
    return compare.except_rows(rows, clean_titles(titles(spark, sf_dir)), duplicates=True)


@query(
    f"""
WITH {_AUGMENTED_SQL},
a AS (SELECT {_WHOLE} FROM clean),
b AS (SELECT {_WHOLE} FROM augmented)
SELECT (SELECT COUNT(*) FROM a) AS rows_first, (SELECT COUNT(*) FROM b) AS rows_second,
  (SELECT COUNT(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_first,
  (SELECT COUNT(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_second, FALSE AS matched
"""
)
def q_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean titles against augmented flagged titles, by all columns."""
    rows = augmented(spark, sf_dir).select(*_TITLE_COLUMNS)
    return compare.reconcile(clean_titles(titles(spark, sf_dir)), rows)


def _altered_titles(cleaned: DataFrame) -> DataFrame:
    """Clean titles as they might come back: some gone, some twice, some with other values."""
    k = F.substring("TitleNumber", 2, 20).cast("bigint")
    times = F.when(k % 70 == 0, 0).when(k % 80 == 1, 2).otherwise(1)
    return (
        cleaned.withColumn("_k", k)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest(times, F.lit(1)))))
        .where(F.col("_k") % 70 != 0)
        .withColumn("PricePaid", F.when(F.col("_k") % 50 == 2, F.col("PricePaid") + 1).otherwise(F.col("PricePaid")))
        .withColumn("District", F.when(F.col("_k") % 60 != 3, F.col("District")))
        .withColumn("Postcode", F.when((F.col("_copy") == 2) & (F.col("_k") % 3 == 0), "none").otherwise(F.col("Postcode")))
        .drop("_k", "_copy")
    )


_OTHERS = [c for c in _TITLE_COLUMNS if c != "TitleNumber"]


def _reconcile_keys_sql() -> str:
    """Every measure from the rows that the frames do not share, counted by key and value."""
    listed = ", ".join(f'"{c}"' for c in _TITLE_COLUMNS)

    def pairs(value: str, figure: str) -> str:
        return f"""(SELECT CAST(COALESCE(SUM({figure}), 0) AS BIGINT) FROM (
  SELECT "TitleNumber", SUM(greatest(d, 0)) AS f, SUM(greatest(-d, 0)) AS s FROM (
    SELECT "TitleNumber", {value}, SUM(d) AS d FROM surplus GROUP BY ALL) GROUP BY "TitleNumber"))"""

    whole = ", ".join(f'"{c}"' for c in _OTHERS)
    figures = {"changed rows": "least(f, s)", "only first": "f - least(f, s)", "only second": "s - least(f, s)"}
    parts = [f"SELECT '{m}' AS measure, NULL AS \"column\", {pairs(whole, figure)} AS n" for m, figure in figures.items()]
    parts += [f"SELECT 'changed', '{c}', {pairs(chr(34) + c + chr(34), 'least(f, s)')}" for c in _OTHERS]
    return f"""
WITH {LABELLED_SQL},
altered AS (
  SELECT * REPLACE (
    CASE WHEN k % 50 = 2 THEN "PricePaid" + 1 ELSE "PricePaid" END AS "PricePaid",
    CASE WHEN k % 60 <> 3 THEN "District" END AS "District",
    CASE WHEN copy = 2 AND k % 3 = 0 THEN 'none' ELSE "Postcode" END AS "Postcode")
  FROM (SELECT *, CAST(substr("TitleNumber", 2) AS BIGINT) AS k FROM clean)
  JOIN (VALUES (1), (2)) copies(copy) ON copy = 1 OR k % 80 = 1
  WHERE k % 70 <> 0),
both_sides AS (SELECT {listed}, 1 AS a, 0 AS b FROM clean UNION ALL SELECT {listed}, 0, 1 FROM altered),
counted AS (SELECT {listed}, SUM(a) AS a, SUM(b) AS b FROM both_sides GROUP BY {listed}),
surplus AS (SELECT *, a - b AS d FROM counted WHERE a <> b)
SELECT 'equal rows' AS measure, NULL AS "column", CAST(SUM(least(a, b)) AS BIGINT) AS n FROM counted
UNION ALL {" UNION ALL ".join(parts)}
"""


@query(_reconcile_keys_sql())
def q_reconcile_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean titles against an altered copy of them, title by title, over all columns."""
    cleaned = clean_titles(titles(spark, sf_dir))
    return compare.reconcile_keys(cleaned, _altered_titles(cleaned), ["TitleNumber"])
