from __future__ import annotations

import pytest
import spellings
from conftest import rows
from pyspark.sql import functions as F

from deedlens.operators import joins, totals, windows
from deedlens.plans.ownership import clean_titles, labelled_titles
from deedlens.standins import OWNERSHIP, PRICES, price_index, titles

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bad(spark):
    return labelled_titles(clean_titles(titles(spark, SF_DIR)), OWNERSHIP).filter("is_fraud = 1").drop("features")


def test_group_count_of_null_is_zero(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, None)], "g string, x int")
    assert rows(totals.group_totals(df, "g", "x", 1)) == [("a", 1, 1.0), (None, 0, 2.0)]
    assert totals.group_counts(df, "g").collect()[0]["n"] == 0
    assert rows(totals.region_totals(df, "g", "x", 1)) == [("a", 1, 1.0)]


def test_top_is_settled_by_name_on_ties(spark):
    df = spark.createDataFrame([(f"c{i}", 1_000_000) for i in range(9, -1, -1)], "g string, x int")
    top = totals.top_totals(df, "g", "x", 1_000_000, k=3)
    assert [r["g"] for r in top.collect()] == ["c0", "c1", "c2"]


def test_price_ratio_equals_join_then_average(spark, bad):
    index = price_index(spark, SF_DIR)
    fast = totals.price_ratio(index, bad)
    slow = spellings.price_ratio_by_join(index, bad)
    assert rows(fast) == rows(slow.select(fast.columns))
    assert fast.count() > 0


def test_price_ratio_guards(spark):
    good = spark.createDataFrame([("n1", 10.0), ("N1", 20.0), ("n2", 0.0)], "RegionName string, AveragePrice double")
    sold = spark.createDataFrame(
        [("London", "N1", 100), ("LONDON", "NULL", 5), ("London", None, 5), ("Kent", "n2", 7), ("London", "n2", 7)],
        "County string, District string, PricePaid int",
    )
    found = rows(totals.price_ratio(good, sold, county="london"))
    assert found == [("London", "N1", 100.0, 10.0, 10), ("London", "N1", 100.0, 20.0, 5), ("London", "n2", 7.0, 0.0, None)]


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "g string, n int")
    assert rows(totals.share_of_total(df, "n")) == [("a", 1, 25.0), ("b", 3, 75.0)]


def test_global_ratio_of_nothing(spark):
    empty = spark.createDataFrame([], "p double")
    assert rows(totals.global_ratio(empty, empty, "p", "p")) == [(None, None, None)]


def test_summary_equals_window(bad):
    by = ["District", "County"]
    fast = windows.group_summary(bad, by, "District", "PricePaid")
    assert rows(fast) == rows(spellings.group_summary_by_window(bad, by, "District", "PricePaid"))


def test_yearly_average_equals_window(spark):
    index = price_index(spark, SF_DIR)
    fast = windows.yearly_average(index, "Datetaken", "RegionName", PRICES)
    assert rows(fast) == rows(spellings.yearly_average_by_window(index, "Datetaken", "RegionName", PRICES))


def test_percent_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 0)], "g string, n long")
    assert rows(windows.percent_of_total(df, "n")) == [("a", 1, 33.33), ("b", 2, 66.67), (None, 0, 0.0)]
    zero = df.filter("n = 0")
    assert rows(windows.percent_of_total(zero, "n")) == [(None, 0, None)]


@pytest.mark.parametrize("k", [1, 2, 3, 10])
def test_dense_rank_equals_window(spark, k):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 3), ("d", 1), ("e", None), ("f", 1)], "g string, n int")
    assert rows(windows.dense_rank_top(df, "n", k)) == rows(spellings.dense_rank_top_by_window(df, "n", k))


def test_max_row_join_multiplies_ties(spark):
    base = spark.createDataFrame(
        [("d", "x", 9, "one"), ("d", "x", 9, "two"), ("d", "y", 9, "three"), ("d", "y", 1, "four"), (None, "x", 9, "five")],
        "district string, county string, price int, owner string",
    )
    groups = windows.group_summary(base, ["district", "county"], "district", "price")
    found = joins.max_row_join(groups, base, "district", "max_value", "price", ["owner"])
    # Both counties of that name take every row with the price.
    assert found.count() == 6
    apart = joins.max_row_join(groups, base, "district", "max_value", "price", ["owner"], also_on=["county"])
    assert rows(apart.select("county", "base_owner")) == [("x", "one"), ("x", "two"), ("y", "three")]


def test_missing_from_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    other = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(joins.missing_from(df, other, "k")) == [("b", 3), (None, 4)]


def test_ci_join(spark):
    left = spark.createDataFrame([("Leeds", 1), ("LEEDS", 2), (None, 3), ("York", 4)], "d string, v int")
    right = spark.createDataFrame([("leeds", 10.0), (None, 0.0)], "r string, p double")
    assert rows(joins.ci_join(left, right, "d", "r").select("v", "p")) == [(1, 10.0), (2, 10.0)]


def test_combine_lists_index_rows(spark):
    good = spark.createDataFrame([("Leeds", 1), ("leeds", 1), ("Leeds", 1), ("York", 2)], "RegionName string, v int")
    sold = spark.createDataFrame(
        [("T1", "LEEDS", "Yorkshire"), ("T1", "LEEDS", "Yorkshire"), ("T2", "leeds", "Kent")],
        "TitleNumber string, District string, County string",
    )
    found = joins.combine(good, sold, county="YORKSHIRE", region="leeds")
    assert found.columns == ["region_name", "TitleNumber", "District", "County", "index_rows"]
    assert [tuple(r)[:4] for r in found.collect()] == [("leeds", "T1", "LEEDS", "Yorkshire")]
    assert [tuple(r) for r in found.first()["index_rows"]] == [("Leeds", 1), ("leeds", 1)]


@pytest.fixture
def many_rows_of_one_key(spark):
    """A third of all rows share one key; joins must not broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    hot = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string")))
    yield spark.range(0, 60_000, numPartitions=8).select("id", hot.alias("k"), F.md5(F.col("id").cast("string")).alias("pad"))
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_key_is_split(spark, many_rows_of_one_key):
    dimension = spark.range(997).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("r")).unionByName(
        spark.createDataFrame([("hot",)], "r string")
    )
    joined = joins.ci_join(many_rows_of_one_key, dimension, "k", "r")
    assert len(joined.collect()) == 60_000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_hot_missing_key_is_split(spark, many_rows_of_one_key):
    known = spark.range(997).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    missing = joins.missing_from(many_rows_of_one_key, known, "k")
    assert len(missing.collect()) == 20_000
    assert "skew=true" in missing._jdf.queryExecution().executedPlan().toString()
