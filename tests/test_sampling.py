from __future__ import annotations

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from deedlens.functions import hashing
from deedlens.operators import compare, generate, sampling


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.range(20_000).select(F.concat(F.lit("T"), F.col("id").cast("string")).alias("k"), "id")


def both_ways(df, step):
    return rows(step(df.repartition(1))), rows(step(df.repartition(7)))


def test_bucket_value(spark):
    df = spark.createDataFrame([(1,)], "k int")
    assert df.select(hashing.bucket(F.col("k"), 42)).first()[0] == 614422250


def test_uniform_parts_are_spread(keyed):
    for part in range(4):
        mean = keyed.agg(F.avg(hashing.uniform(F.col("k"), 1, part))).first()[0]
        assert abs(mean - 0.5) < 0.01


def test_standard_normal(keyed):
    z = hashing.standard_normal(F.col("k"), 3)
    mean, std = keyed.agg(F.avg(z), F.stddev(z)).first()
    assert abs(mean) < 0.03 and abs(std - 1) < 0.03


@pytest.mark.parametrize("rate", [0.0, 0.3, 1.0, 2.5, 40.0])
def test_poisson_moments(keyed, rate):
    thresholds = [F.lit(t) for t in hashing.poisson_thresholds(rate)]
    n = hashing.poisson_count(hashing.uniform(F.col("k"), 5), thresholds)
    mean, variance = keyed.agg(F.avg(n), F.variance(n)).first()
    tolerance = 5 * math.sqrt(max(rate, 0.01) / 20_000)
    assert abs(mean - rate) <= tolerance
    assert abs(variance - rate) <= 0.1 * rate + 1e-9


def test_poisson_thresholds_end_below_a_draw():
    for rate in (0.1, 1.0, 8.0, 100.0):
        thresholds = hashing.poisson_thresholds(rate)
        assert thresholds == sorted(thresholds)
        assert 1.0 - thresholds[-1] < 1e-9
    with pytest.raises(ValueError):
        hashing.poisson_thresholds(-1)


def test_bootstrap_does_not_depend_on_partitions(keyed):
    one, seven = both_ways(keyed, lambda df: sampling.bootstrap(df, 0.65, 42, "k"))
    assert one == seven
    assert abs(len(one) - 13_000) < 500


def test_rate_from_the_plan_draws_like_a_number(keyed):
    part = keyed.filter("id % 4 = 0")
    computed = sampling.bootstrap(part, sampling.share_of(part, keyed), 42, "k")
    given = sampling.bootstrap(part, 0.25, 42, "k")
    assert rows(computed) == rows(given)


@pytest.mark.parametrize("rate", [3.0, 2.5])
def test_rates_above_one(keyed, rate):
    few = sampling.share_of(keyed, keyed.filter(f"id < {int(20_000 / rate)}"))
    for fraction in (rate, few):
        copies = sampling.bootstrap(keyed, fraction, 42, "k").groupBy("id").count()
        row = copies.agg(F.sum("count").alias("n"), F.sum(F.col("count") * F.col("count")).alias("squares")).first()
        mean = row["n"] / 20_000
        assert abs(mean - rate) < 0.05 and abs(row["squares"] / 20_000 - mean**2 - rate) < 0.2


def test_rows_without_a_key_are_not_lost(spark):
    df = spark.range(4_000).select(F.when(F.col("id") % 2 == 0, F.concat(F.lit("T"), "id")).alias("k"), "id")
    both = sampling.augment(df, 0.5, 7, "k")
    assert both.filter("copy = 0").count() == 4_000
    drawn = both.filter("copy > 0 AND k IS NULL").count()
    assert 850 < drawn < 1150
    parts = {r["part"]: r["count"] for r in sampling.split(df, {"a": 0.5, "b": 0.5}, 3, "k").filter("k IS NULL").groupBy("part").count().collect()}
    assert min(parts.values()) > 900
    spread = sampling.shuffle_rows(df, 3, "k", partitions=8).filter("k IS NULL").groupBy(F.spark_partition_id()).count()
    assert spread.count() == 8


def test_augment_is_originals_and_bootstrap(keyed):
    both = sampling.augment(keyed, 0.5, 7, "k")
    assert rows(both.filter("copy = 0").drop("copy")) == rows(keyed)
    assert rows(both.filter("copy > 0")) == rows(sampling.bootstrap(keyed, 0.5, 7, "k"))


def test_split_is_a_partition(keyed):
    one, seven = both_ways(keyed, lambda df: sampling.split(df, {"train": 8, "test": 1, "rest": 1}, 42, "k"))
    assert one == seven
    sizes = {}
    for *_, part in one:
        sizes[part] = sizes.get(part, 0) + 1
    assert sum(sizes.values()) == 20_000
    assert abs(sizes["train"] - 16_000) < 400 and abs(sizes["rest"] - 2_000) < 200
    assert {r["part"] for r in sampling.split(keyed.limit(3), {"all": 1.0}, 1, "k").collect()} == {"all"}


def test_shuffle_order_is_the_same_for_any_partitioning(keyed):
    orders = [
        [r["k"] for r in sampling.shuffle_rows(keyed.repartition(n), 9, "k", partitions=parts).collect()]
        for n, parts in ((1, 1), (7, 5), (3, 16))
    ]
    assert orders[0] == orders[1] == orders[2]
    assert sorted(orders[0]) == sorted(r["k"] for r in keyed.collect())
    assert orders[0] != [r["k"] for r in sampling.shuffle_rows(keyed, 10, "k").collect()]


def test_shuffle_has_no_sampling_pass(keyed):
    plan = sampling.shuffle_rows(keyed, 9, "k")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_rows_per_group(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", 1), (None, 5), (None, 4)], "g string, x int")
    found = sampling.rows_per_group(df, "g", 2, "x")
    assert rows(found) == [("a", 0, 1), ("a", 1, 2), ("b", 1, 1), (None, 4, 1), (None, 5, 2)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 2, Partial" in plan


def test_except_and_reconcile(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1), ("y", None), ("z", 3)], "k string, v int")
    b = spark.createDataFrame([("x", 1), ("y", None), ("w", 4)], "k string, v int")
    assert rows(compare.except_rows(a, b)) == rows(a.subtract(b)) == [("z", 3)]
    assert rows(compare.except_rows(a, b, duplicates=True)) == [("x", 1), ("z", 3)]
    assert rows(compare.reconcile(a, b)) == [(4, 3, 2, 1, False)]
    assert rows(compare.reconcile(a, a)) == [(4, 4, 0, 0, True)]
    assert rows(compare.reconcile(a, a.filter("false"))) == [(4, 0, 4, 0, False)]
    nothing = a.filter("false")
    assert rows(compare.reconcile(nothing, nothing)) == [(0, 0, 0, 0, True)]


def test_reconcile_sees_doubled_rows(spark):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    assert a.union(a).subtract(a).count() == 0
    assert rows(compare.reconcile(a.union(a), a)) == [(2, 1, 1, 0, False)]


def test_union_matches_names(spark):
    a = spark.createDataFrame([(1, "a")], "x int, y string")
    b = spark.createDataFrame([("b", 2)], "y string, x int")
    assert rows(compare.union_all(a, b)) == [(1, "a"), (2, "b")]


def test_quality_of_equal_frames(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), (None, None)], "g string, x int")
    report = compare.synthetic_quality(df, df)
    assert {r["difference"] for r in report.collect()} == {0.0}
    found = {(r["section"], r["column"], r["statistic"]): (r["original"], r["synthetic"]) for r in report.collect()}
    assert found[("shape", None, "rows")] == (3.0, 3.0)
    assert found[("shape", None, "columns")] == (2.0, 2.0)
    assert found[("describe", "x", "mean")] == (2.0, 2.0)
    assert found[("category", "g", None)] == (1.0, 1.0)


def test_quality_counts_values_of_one_side(spark):
    a = spark.createDataFrame([("a", 1)], "g string, x int")
    b = spark.createDataFrame([("b", 5), ("b", 7)], "g string, x int")
    found = {(r["column"], r["statistic"]): r["difference"] for r in compare.synthetic_quality(a, b).collect()}
    assert found[("g", "a")] == -1.0 and found[("g", "b")] == 2.0 and found[("x", "max")] == 6.0


def test_generated_rows(spark):
    df = generate.generate_rows(spark, 30, 5)
    assert rows(df) == rows(generate.generate_rows(spark, 30, 5).repartition(7))
    first = df.filter("id = 1").first()
    assert (first["clustered"], first["scattered"]) == (0.0, 0.0)
    assert first["small_vc"] == "         1"
    assert len(first["padded"]) == 20 and first["padded"].endswith("1")
    last = df.filter("id = 30").first()
    assert last["padded"] == "30" and last["padding"] == "x" * 40
    assert df.filter(~F.col("random_string").rlike("^[A-Za-z]{50}$")).count() == 0
    assert df.filter("randomised < 0 or randomised >= 30 or randomised <> floor(randomised)").count() == 0
    assert df.select("random_string").distinct().count() == 30


def test_demo_people(spark):
    df = generate.demo_people(spark.range(5_000), "id")
    low, high, missing = df.agg(F.min("age"), F.max("age"), F.count_if(F.col("age").isNull())).first()
    assert (low, high) == (18, 64) and abs(missing - 500) < 100
    assert df.filter("price < 100000 or price >= 500000").count() == 0
    assert {r[0] for r in df.select("gender").distinct().collect()} == {"M", "F"}
    assert {r[0] for r in df.select("district").distinct().collect()} == set("ABCD")


KEYED = "k int, v double, g string"


def key_measures(spark, a, b, keys=("k",)):
    found = compare.reconcile_keys(spark.createDataFrame(a, KEYED), spark.createDataFrame(b, KEYED), list(keys))
    return {(r["measure"], r["column"]): r["n"] for r in found.collect()}


def test_reconcile_keys(spark):
    a = [(1, 1.0, "x"), (2, 2.0, "x"), (3, 3.0, None), (4, 0.0, "x"), (5, 5.0, "x"), (None, 1.0, "n")]
    b = [(1, 1.0, "x"), (2, 2.5, "y"), (3, 3.0, ""), (4, -0.0, "x"), (6, 6.0, "x"), (None, 1.0, "m")]
    assert key_measures(spark, a, b) == {
        ("equal rows", None): 2,
        ("changed rows", None): 3,
        ("only first", None): 1,
        ("only second", None): 1,
        ("changed", "v"): 1,
        ("changed", "g"): 3,
    }


def test_reconcile_keys_with_repeated_keys(spark):
    # Three rows against two of one key: one is equal, one pair differs in v alone, one row has no partner.
    a = [(1, 1.0, "x"), (1, 2.0, "x"), (1, 3.0, "x")]
    b = [(1, 1.0, "x"), (1, 9.0, "x")]
    found = key_measures(spark, a, b)
    assert (found[("equal rows", None)], found[("changed rows", None)], found[("only first", None)]) == (1, 1, 1)
    assert (found[("changed", "v")], found[("changed", "g")]) == (1, 0)
    # However the rows are paired, the same values stand on both sides of g.
    a, b = [(1, 1.0, "x"), (1, 2.0, "y")], [(1, 3.0, "y"), (1, 4.0, "x")]
    found = key_measures(spark, a, b)
    assert (found[("changed", "v")], found[("changed", "g")], found[("changed rows", None)]) == (2, 0, 2)


def test_reconcile_keys_of_doubled_and_empty_frames(spark):
    a = [(i, float(i), None) for i in range(5)]
    found = key_measures(spark, a, a + a)
    assert (found[("equal rows", None)], found[("only second", None)], found[("changed rows", None)]) == (5, 5, 0)
    found = key_measures(spark, a, [])
    assert (found[("only first", None)], found[("equal rows", None)]) == (5, 0)
    assert set(key_measures(spark, [], []).values()) == {0}
    assert key_measures(spark, a, [(0, float("nan"), None), *a[1:]], keys=("k", "g"))[("changed", "v")] == 1


def test_reconcile_keys_refuses_other_columns(spark):
    a = spark.createDataFrame([(1, 1)], "k int, v int")
    for other, keys in ((a.withColumnRenamed("v", "w"), ["k"]), (a, ["z"]), (a, [])):
        with pytest.raises(ValueError):
            compare.reconcile_keys(a, other, keys)


def test_reconcile_keys_hot_key_and_odd_columns(spark):
    rows_a = [(i % 3 and i, [i, 1], {"a": i}, bytearray([i % 256]), i) for i in range(300)]
    schema = "`the key` int, l array<int>, m map<string,int>, b binary, `of.it` int"
    a = spark.createDataFrame(rows_a, schema).drop("m")
    b = a.withColumn("of.it", F.col("`of.it`") + 1)
    found = {(r["measure"], r["column"]): r["n"] for r in compare.reconcile_keys(a, b, ["the key"]).collect()}
    assert found[("changed rows", None)] == 300 and found[("changed", "l")] == 0 and found[("changed", "b")] == 0
    # The key 0 holds a third of the rows: its values on both sides differ only where they do not overlap.
    assert found[("changed", "of.it")] == 300
