from __future__ import annotations

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from deedlens.operators import clean, profile

TITLES = "title string, tenure string, price int, note string"


@pytest.fixture
def frame(spark):
    data = [
        ("T1", "Freehold", 10, None),
        ("T2", "93347", 20, None),
        ("T3", None, None, None),
        (None, "Leasehold", 40, None),
    ]
    return spark.createDataFrame(data, TITLES)


def test_drop_rogue_takes_null_along(frame):
    assert rows(clean.drop_rogue(frame, "tenure", ["93347"]).select("title")) == [("T1",), (None,)]


def test_drop_rogue_can_keep_null(frame):
    kept = clean.drop_rogue(frame, "tenure", ["93347"], keep_nulls=True)
    assert rows(kept.select("title")) == [("T1",), ("T3",), (None,)]


def test_cast(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    assert rows(clean.cast_columns(df, {"a": "int"}, strict=False)) == [(1,), (None,), (None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.cast_columns(df, {"a": "int"}).collect()


def test_null_profile(frame):
    found = {r["column"]: (r["row_count"], r["null_count"], r["null_pct"]) for r in profile.null_profile(frame).collect()}
    assert found == {"note": (4, 4, 100.0), "title": (4, 1, 25.0), "tenure": (4, 1, 25.0), "price": (4, 1, 25.0)}


def test_null_profile_is_one_job_over_one_scan(spark, frame, tmp_path):
    frame.write.parquet(str(tmp_path / "t"))
    plan = profile.null_profile(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_null_profile_of_nothing(spark):
    empty = spark.createDataFrame([], TITLES)
    assert {r["null_pct"] for r in profile.null_profile(empty).collect()} == {None}
    assert clean.prune_null_columns(empty).columns == empty.columns
    assert profile.null_summary(profile.null_profile(empty)).first()["empty_columns"] == 0


def test_null_report_and_summary(frame):
    lines = [r[0] for r in profile.null_report(profile.null_profile(frame)).collect()]
    assert lines == ["note\t100.0%", "price\t25.0%", "tenure\t25.0%", "title\t25.0%"]
    assert rows(profile.null_summary(profile.null_profile(frame))) == [(4, 1, 25.0)]


def test_almost_all_null(spark):
    df = spark.range(2500).select("id", F.when(F.col("id") == 7, 1).alias("rare"))
    assert clean.prune_null_columns(df).columns == ["id", "rare"]
    assert clean.prune_null_columns(df, rounded=True).columns == ["id"]


def test_prune_keeps_types(frame):
    pruned = clean.prune_null_columns(frame)
    assert pruned.dtypes == [("title", "string"), ("tenure", "string"), ("price", "int")]


def test_describe_like_spark(spark, frame):
    found = {r["column"]: r for r in profile.describe_columns(frame).collect()}
    spark_says = {r["summary"]: r["price"] for r in frame.describe("price").collect()}
    price = found["price"]
    assert price["value_count"] == int(spark_says["count"])
    assert price["mean"] == round(float(spark_says["mean"]), 2)
    assert price["stddev"] == round(float(spark_says["stddev"]), 2)
    assert (price["min_value"], price["max_value"]) == ("10", "40")
    assert found["note"]["value_count"] == 0
    assert found["tenure"]["min_value"] == "93347"


def test_category_counts(frame):
    found = {(r["column"], r["value"]): r["n"] for r in profile.category_counts(frame).collect()}
    assert found[("note", None)] == 4
    assert found[("tenure", None)] == 1
    assert found[("tenure", "Freehold")] == 1
    assert sum(n for (c, _), n in found.items() if c == "title") == 4


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 5, 10, 20)] + [(None,)], "x double")
    found = profile.histogram(df, "x", bins=4).orderBy("bin").collect()
    assert [r["n"] for r in found] == [2, 1, 1, 1]
    assert [r["bin_start"] for r in found] == [0.0, 5.0, 10.0, 15.0]
    assert found[-1]["bin_end"] == 20.0


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(3,), (3,), (3,)], "x int")
    found = profile.histogram(df, "x", bins=4).orderBy("bin").collect()
    assert [r["n"] for r in found] == [0, 0, 3, 0]
    assert (found[0]["bin_start"], found[-1]["bin_end"]) == (2.5, 3.5)


def test_histogram_leaves_out_what_is_not_finite(spark):
    data = [(0.0,), (4.0,), (math.nan,), (math.inf,), (-math.inf,), (None,)]
    found = profile.histogram(spark.createDataFrame(data, "x double"), "x", bins=2).orderBy("bin").collect()
    assert [(r["n"], r["bin_start"], r["bin_end"]) for r in found] == [(1, 0.0, 2.0), (1, 2.0, 4.0)]


def test_odd_column_names(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "`it's``odd.name` string, `a b` int")
    found = {r["column"]: r["null_count"] for r in profile.null_profile(df).collect()}
    assert found == {"it's`odd.name": 1, "a b": 0}
    assert {r["column"] for r in profile.describe_columns(df).collect()} == set(found)
    assert profile.histogram(df, "a b", bins=2).count() == 2
    assert profile.category_counts(df).count() == 2


def test_histogram_of_nothing(spark):
    assert profile.histogram(spark.createDataFrame([], "x int"), "x").count() == 0


def test_histogram_overlay_shares_bins(spark):
    a = spark.createDataFrame([(0.0, 1.0), (10.0, 2.0)], "x double, y double")
    b = spark.createDataFrame([(5.0, 3.0)], "x double, y double")
    found = profile.histogram_overlay(a, b, ["x", "y"], bins=2)
    by = {(r["source"], r["column"], r["bin"]): (r["n"], r["bin_start"]) for r in found.collect()}
    assert by[("original", "x", 0)] == (1, 0.0)
    assert by[("synthetic", "x", 1)] == (1, 5.0)
    assert by[("synthetic", "x", 0)] == (0, 0.0)
    assert by[("original", "y", 1)] == (1, 2.0)


def test_class_balance(spark):
    df = spark.createDataFrame([(1,), (1,), (0,), (None,)], "is_fraud int")
    assert rows(profile.class_balance(df, "is_fraud")) == [(4, 2, 1, 50.0, 0.5)]


def test_population_stddev(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 4), ("b", 5)], "g string, x int")
    found = dict(rows(profile.population_stddev(df, "g", "x")))
    assert math.isclose(found["a"], 1.247219, rel_tol=1e-6)
    assert found["b"] == 0.0
    assert profile.population_stddev(df, "g", "x").schema["stddev"].dataType.typeName() == "float"


def test_finite_rows(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,), (math.inf,), (-math.inf,), (None,)], "x double")
    assert rows(clean.drop_non_finite(df, ["x"])) == [(1.0,)]
    assert clean.complete_rows(df, ["x"]).count() == 3


def test_histogram_of_large_values(spark):
    for values, n in (([1e17, 1e17], 2), ([-1.7e308, 1.7e308, 0.0], 3), ([0.0, 0.0], 2)):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        bins = profile.histogram(df, "x", 4).collect()
        assert sum(r["n"] for r in bins) == n and len(bins) == 4
        assert all(abs(r["bin_start"]) < float("inf") for r in bins)
    # The extremes of a wide range lie in different bins.
    wide = spark.createDataFrame([(-1.7e308,), (1.7e308,)], "x double")
    assert [r["n"] for r in profile.histogram(wide, "x", 4).orderBy("bin").collect()] == [1, 0, 0, 1]
