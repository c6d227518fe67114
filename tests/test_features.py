from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from deedlens.functions.hashing import draw_digits, poisson_count, poisson_count_of_digits, poisson_thresholds, uniform
from deedlens.operators import features, latent, models, ranking


@pytest.fixture(scope="module")
def places(spark):
    data = ["b"] * 3 + ["a"] * 3 + ["c"] * 5 + ["d"] + [None] * 2
    return spark.createDataFrame(list(enumerate(data)), "id int, d string")


def test_string_index_like_spark(places):
    known = places.filter("d is not null")
    wanted = StringIndexer(inputCol="d", outputCol="i").fit(known).transform(known)
    assert rows(features.string_index(places, "d", "i", invalid="skip")) == rows(wanted)


def test_string_index_of_null(places):
    kept = {r["id"]: r["i"] for r in features.string_index(places, "d", "i", invalid="keep").collect()}
    assert (kept[6], kept[3], kept[0], kept[11], kept[13]) == (0.0, 1.0, 2.0, 3.0, 4.0)
    with pytest.raises(Exception, match="NULL in d"):
        features.string_index(places, "d", "i").collect()
    with pytest.raises(ValueError):
        features.string_index(places, "d", "i", invalid="guess")


def test_global_position_over_many_partitions(spark):
    df = spark.range(0, 10_000, numPartitions=6).select(((F.col("id") * 7919) % 10_007).alias("v"))
    found = [(r["v"], r["p"]) for r in ranking.global_position(df, [F.asc("v")], "p").collect()]
    values = sorted(v for v, _ in found)
    assert dict(found) == {v: i for i, v in enumerate(values)}


def test_running_total(spark):
    random.seed(1)
    data = [(i, random.randint(-5, 50)) for i in range(3_000)]
    df = spark.createDataFrame(data, "k int, v int").repartition(5)
    found = {r["k"]: r["t"] for r in ranking.running_total(df, [F.asc("k")], "v", "t").collect()}
    total = 0
    for k, v in data:
        total += v
        assert found[k] == total


def test_impute_mean(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, math.inf), (4, 3.0), (5, math.nan)], "id int, x double")
    assert rows(features.impute_mean(df, ["x"])) == [(1, 1.0), (2, 2.0), (3, 2.0), (4, 3.0), (5, 2.0)]
    empty = df.filter("id = 2")
    assert rows(features.impute_mean(empty, ["x"])) == [(2, None)]


def test_standardise_like_spark(spark):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate((1, 2, 4, 9))], "id int, x double")
    vectors = VectorAssembler(inputCols=["x"], outputCol="v").transform(df)
    model = StandardScaler(inputCol="v", outputCol="s", withMean=True).fit(vectors)
    wanted = [r[0] for r in model.transform(vectors).orderBy("id").select(vector_to_array("s")[0]).collect()]
    stats = features.scaling(df, ["x"])
    found = [r["x"] for r in features.standardise(df, ["x"], stats).orderBy("id").collect()]
    assert np.allclose(found, wanted)
    back = features.unstandardise(features.standardise(df, ["x"], stats), ["x"], stats).orderBy("id")
    assert np.allclose([r["x"] for r in back.collect()], [1, 2, 4, 9])
    population = features.standardise(df, ["x"], features.scaling(df, ["x"], sample=False))
    assert math.isclose(population.agg(F.stddev_pop("x")).first()[0], 1.0)


def test_standardise_without_spread(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    assert rows(features.standardise(df, ["x"], features.scaling(df, ["x"]))) == [(0.0,), (0.0,), (None,)]


def test_one_hot_keeps_all_levels(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "g string")
    hot = features.one_hot(df, ["g"], drop_last=False).select(vector_to_array("g_vec"))
    assert sorted(tuple(r[0]) for r in hot.collect()) == [(0.0, 1.0), (1.0, 0.0), (1.0, 0.0)]
    dropped = features.one_hot(df, ["g"]).select(vector_to_array("g_vec"))
    assert sorted(tuple(r[0]) for r in dropped.collect()) == [(0.0,), (1.0,), (1.0,)]


def test_one_hot_of_many_values(spark):
    df = spark.range(12_000).select(F.col("id").cast("string").alias("g"))
    hot = features.one_hot(df, ["g"], drop_last=False)
    sizes = hot.select(F.col("g_vec").cast("string").alias("v"), "g_index").collect()
    assert {r["v"].split(",")[0] for r in sizes} == {"(12000"} and len({r["g_index"] for r in sizes}) == 12_000


def test_assemble_twice(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    once = features.assemble(df, ["x"])
    assert once.count() == 1
    assert features.assemble(once, ["x"]).columns == ["x", "features"]


def test_build_features_accounts_for_every_row(spark):
    data = [("T1", "a", 1), ("T2", None, 2), ("T3", "a", None), (None, "a", 3), (None, None, 4), ("T1", None, 5)]
    df = spark.createDataFrame(data, "k string, g string, p int")
    built = features.build_features(df, ["g"], ["p"], "k")
    assert rows(built.kept.select("k", "p")) == [("T1", 1), (None, 3)]
    # T1 is kept once, so its incomplete row is not left over; rows without a key always are.
    assert rows(built.dropped) == [("T2", None, 2), ("T3", "a", None), (None, "a", 3), (None, None, 4)]
    sql = spark.sql(
        "SELECT h.* FROM {h} h WHERE NOT EXISTS (SELECT 1 FROM {f} f WHERE h.k = f.k)", h=df, f=built.kept.drop("features")
    )
    assert rows(sql) == rows(built.dropped)
    kept = features.build_features(df, ["g"], ["p"], "k", nulls="keep")
    assert kept.kept.count() == 5
    assert rows(kept.dropped.select("k", "p")) == [("T3", None), (None, 3), (None, 4)]


def test_encodings_are_the_callers_choice(spark):
    kinds = [type(s).__name__ for s in features.flag_stages(["g"], ["m"], {})]
    assert kinds == ["StringIndexer", "OneHotEncoder", "FeatureHasher", "VectorAssembler"]
    kinds = [type(s).__name__ for s in features.flag_stages(["g"], [], {"x": [1.0, 2.0]})]
    assert kinds == ["VectorAssembler", "Binarizer", "StringIndexer", "OneHotEncoder", "VectorAssembler"]


def test_standardise_one_row(spark):
    df = spark.createDataFrame([(5.0,)], "x double")
    assert rows(features.standardise(df, ["x"], features.scaling(df, ["x"]))) == [(0.0,)]


def brute_auc(pairs):
    positive = [s for s, y in pairs if y == 1]
    negative = [s for s, y in pairs if y != 1]
    won = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    return won / (len(positive) * len(negative))


@pytest.mark.parametrize("levels", [3, 40, 10_000])
def test_auc(spark, levels):
    random.seed(levels)
    pairs = [(random.randint(0, levels) / 7, int(random.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame(pairs, "score double, label int")
    found = models.auc(df, "score", "label").first()
    assert math.isclose(found["auc"], brute_auc(pairs), rel_tol=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert math.isclose(found["auc"], evaluator.evaluate(df), rel_tol=1e-9)


def test_auc_of_one_class(spark):
    df = spark.createDataFrame([(0.5, 1), (0.7, 1)], "score double, label int")
    assert rows(models.auc(df, "score", "label")) == [(2, 0, None)]


def test_forest_on_separable_rows(spark):
    df = spark.range(2_000).select(
        "id",
        (F.col("id") % 100).cast("double").alias("amount"),
        F.concat(F.lit("m"), (F.col("id") % 300).cast("string")).alias("merchant"),
        ((F.col("id") % 100) > 70).cast("int").alias("label"),
    )
    forest = models.random_forest(df, "label", [], ["merchant"], ["amount"], "id", trees=5)
    report = {r["part"]: r for r in models.forest_report(forest, "label").collect()}
    assert report["test"]["auc"] > 0.95
    assert report["train"]["positives"] + report["test"]["positives"] == 580


def _mixed_rows(spark, n=15_000):
    """More rows than MLlib's own candidate sample has, with repeated and missing keys."""
    k = F.col("id")
    return spark.range(n).select(
        F.when(k % 50 != 0, k % (n - 100)).alias("id"),
        (k * 37 % 1009).cast("double").alias("amount"),
        F.when(k % 40 != 0, (k % 13).cast("double")).alias("level"),
        F.concat(F.lit("m"), (k % 300).cast("string")).alias("merchant"),
        F.concat(F.lit("g"), (k % 3).cast("string")).alias("kind"),
        ((k * 37 % 1009 + k % 13 * 40 + F.crc32(k.cast("string")) % 300) > 900).cast("int").alias("label"),
    )


def test_forest_does_not_depend_on_partitions(spark):
    df = _mixed_rows(spark)
    found = []
    for n in (1, 7, 64):
        forest = models.random_forest(df.repartition(n), "label", ["kind"], ["merchant"], ["amount", "level"], "id", trees=4)
        found.append(rows(models.forest_report(forest, "label").withColumn("auc", F.round("auc", 9))))
        debug = [t.toDebugString.split("\n", 1)[1] for t in forest.trees]
        assert len(set(debug)) == 4
    assert found[0] == found[1] == found[2]
    assert all(0.9 < auc < 1 for _, _, auc, _ in found[0])
    # Rows without a number are left out, as the vector assembler does.
    assert sum(p + n for p, n, _, _ in found[0]) == df.where("level IS NOT NULL").count()


def test_forest_fits_kinds_of_rows_as_the_rows(spark, monkeypatch):
    k = F.col("id")
    df = spark.range(4_000).select(
        "id", (k % 20).cast("double").alias("x"), F.concat(F.lit("g"), (k % 3).cast("string")).alias("g"), ((k % 20 + k % 7) > 14).cast("int").alias("label")
    )
    fitted = []

    class Learner(models.RandomForestClassifier):
        def fit(self, rows):
            fitted.append(rows.count())
            return super().fit(rows)

    monkeypatch.setattr(models, "RandomForestClassifier", Learner)
    forest = models.random_forest(df, "label", ["g"], [], ["x"], "id", trees=3)
    # 20 values of x, 3 of g and 2 of the label, each kind two rows at most, whatever the number of rows.
    assert len(fitted) == 3 and max(fitted) <= 240
    assert sorted(forest.train.union(forest.test).columns) == sorted(["id", "label", "g", "x", "part", "features", "score"])
    assert forest.train.count() + forest.test.count() == 4_000
    limits = [F.lit(t) for t in models.poisson_thresholds(1.0)]
    for i, tree in enumerate(forest.trees):
        drawn = models.poisson_count(models.uniform(models.row_key(df, "id"), f"42.tree.{i}"), limits).cast("double")
        single = forest.train.drop("score").withColumn("w", drawn).filter("w > 0")
        learner = RandomForestClassifier(
            labelCol="label", weightCol="w", numTrees=1, bootstrap=False, featureSubsetStrategy="sqrt", maxDepth=5, seed=42 + i
        )
        assert learner.fit(single).toDebugString.split("\n", 1)[1] == tree.toDebugString.split("\n", 1)[1]


def test_forest_makes_vectors_of_kinds_only(spark, monkeypatch):
    k = F.col("id")
    words = F.concat(F.lit("é"), F.expr("repeat('x', cast(id % 5 as int))"), (k % 30).cast("string"))
    # NULL and NaN numbers are left out, NULL texts are a kind of their own; so is a number that has no border.
    df = spark.range(3_000).select(
        "id",
        F.when(k % 9 != 0, F.when(k % 7 == 0, F.lit(math.nan)).otherwise((k % 4).cast("double"))).alias("x"),
        F.when(k % 11 != 0, F.lit(1.0)).alias("one"),
        F.when(k % 10 != 0, words).alias("w"),
        F.when(k % 6 != 0, F.concat(F.lit("g"), (k % 2).cast("string"))).alias("g"),
        (k % 4 + k % 2 > 2).cast("int").alias("label"),
    )
    seen = []
    prepared = models.Forest.prepared
    monkeypatch.setattr(models.Forest, "prepared", lambda forest, rows: seen.append(rows.count()) or prepared(forest, rows))
    forest = models.random_forest(df, "label", ["g"], ["w"], ["x", "one"], "id", trees=2)
    monkeypatch.undo()
    both = forest.train.union(forest.test)
    # Kinds: four numbers, 31 words, three groups, two labels, two parts; all 3,000 rows before.
    assert len(seen) == 1 and seen[0] <= both.select("x", "w", "g", "label", "part").distinct().count() < both.count()
    # Each row has the vector that the preparation gives it.
    own = {r["id"]: r["f"] for r in forest.prepared(df).select("id", F.col("features").cast("string").alias("f")).collect()}
    assert {r["id"]: r["f"] for r in both.select("id", F.col("features").cast("string").alias("f")).collect()} == own
    assert both.count() == len(own) == df.where("x IS NOT NULL AND NOT isnan(x) AND one IS NOT NULL").count()


def test_draws_by_digits(spark):
    df = spark.range(20_000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"))
    limits = poisson_thresholds(1.0)
    digits = poisson_count_of_digits(draw_digits(F.col("k"), "7.tree"), limits)
    number = poisson_count(uniform(F.col("k"), "7.tree"), [F.lit(t) for t in limits])
    assert df.where(~digits.eqNullSafe(number)).count() == 0
    ends = spark.createDataFrame([("00000000",), ("ffffffff",), (None,)], "d string")
    assert [r[0] for r in ends.select(poisson_count_of_digits(F.col("d"), limits)).collect()][::2] == [0, None]


def test_forest_on_rows_that_are_all_alike(spark):
    df = spark.range(60).select("id", F.lit("a").alias("g"), F.lit(1).alias("label"))
    forest = models.random_forest(df, "label", [], ["g"], [], "id", trees=2)
    assert {r.score for r in forest.train.union(forest.test).collect()} == {1.0}


def test_forest_on_rows_of_one_value(spark):
    df = spark.range(40).select("id", F.lit(5.0).alias("x"), (F.col("id") % 4).cast("double").alias("y"), (F.col("id") % 4 > 1).cast("int").alias("label"))
    forest = models.random_forest(df, "label", [], [], ["x", "y"], "id", trees=3)
    assert models.split_candidates(df, ["x", "y"], "id") == {"x": [], "y": [0.0, 1.0, 2.0]}
    assert {r["auc"] for r in models.forest_report(forest, "label").collect()} == {1.0}


def test_split_candidates_follow_keys(spark):
    df = _mixed_rows(spark)
    a, b = (models.split_candidates(df.repartition(n), ["amount", "level"], "id", rows=500) for n in (1, 9))
    assert a == b and len(a["amount"]) == 31 and len(a["level"]) == 12
    assert models.split_candidates(df.limit(0), ["amount"], "id") == {"amount": []}


def test_latent_rows_keep_moments_and_direction(spark):
    z = F.col("id")
    df = spark.range(6_000).select(
        "id",
        (F.sin(z) * 10 + 100).alias("a"),
        (F.sin(z) * -20 + F.cos(z * 7) * 0.5 + 50).alias("b"),
        F.when(z % 10 != 0, F.cos(z) * 3).alias("c"),
        F.lit(4.0).alias("flat"),
    )
    model = latent.fit_latent(df, ["a", "b", "c", "flat"])
    drawn = latent.draw_latent(df, "id", model)
    assert rows(drawn.limit(5)) == rows(latent.draw_latent(df.repartition(7), "id", model).filter("id < 5"))
    stats = drawn.agg(F.avg("a"), F.stddev("a"), F.corr("a", "b"), F.min("flat"), F.max("flat")).first()
    assert abs(stats[0] - 100) < 0.5
    assert abs(stats[1] - 7.07) < 0.5
    assert stats[2] < -0.9
    assert (stats[3], stats[4]) == (4.0, 4.0)


def test_one_hot_columns(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "g string")
    hot, names = latent.one_hot_columns(df, "g", ["a", "b"])
    assert names == ["g_0", "g_1"]
    assert rows(hot.select(names)) == [(0.0, 0.0), (0.0, 1.0), (1.0, 0.0)]


def _correlated(spark, n=3_000):
    """Two latent normals behind four columns; gaps depend on a column that is observed."""
    z = [latent.standard_normal(F.col("id"), s) for s in "ab"]
    e = [latent.standard_normal(F.col("id"), f"e{i}") for i in range(4)]
    full = spark.range(n).select(
        "id",
        (z[0] * 3 + e[0] * 0.3 + 10).alias("a"),
        (z[0] * -2 + z[1] + e[1] * 0.3).alias("b"),
        (z[1] * 5 + e[2] * 0.3 - 4).alias("c"),
        (z[0] + z[1] + e[3] * 0.3).alias("d"),
    )
    # Mostly where a is large: a mean over what is left would be too small.
    return full, full.withColumn("d", F.when((F.col("a") < 10) | (F.col("id") % 4 == 0), F.col("d")))


def test_latent_fit_is_not_led_astray_by_gaps(spark):
    full, gaps = _correlated(spark)
    true = full.agg(F.avg("d"), F.stddev_pop("d")).first()
    left = gaps.agg(F.avg("d")).first()[0]
    model = latent.fit_latent(gaps, ["a", "b", "c", "d"])
    assert abs(left - true[0]) > 0.3 and abs(model.means[3] - true[0]) < 0.06
    spread = model.deviations[3] * np.sqrt((model.weights[3] ** 2).sum() + model.noise)
    assert abs(spread - true[1]) < 0.1


def test_latent_fit_without_gaps_is_principal_components(spark):
    full, _ = _correlated(spark)
    names = ["a", "b", "c", "d"]
    model = latent.fit_latent(full, names)
    x = np.array(full.select(names).collect())
    covariance = np.cov(((x - x.mean(axis=0)) / x.std(axis=0)).T, bias=True)
    values, vectors = np.linalg.eigh(covariance)
    noise = values[:2].mean()
    assert np.isclose(model.noise, noise, rtol=1e-6)
    assert np.allclose(model.weights @ model.weights.T, vectors[:, 2:] @ np.diag(values[2:] - noise) @ vectors[:, 2:].T, atol=1e-6)
    assert np.allclose(model.means, x.mean(axis=0))


def test_latent_rounds_in_tasks_equal_those_on_the_driver(spark, monkeypatch):
    _, gaps = _correlated(spark, 400)
    names = ["a", "b", "c", "d"]
    monkeypatch.setattr(latent, "ROUNDS", 8)
    here = latent.fit_latent(gaps, names)
    monkeypatch.setattr(latent, "PATTERNS", 1)
    there = latent.fit_latent(gaps.repartition(5), names)
    assert np.allclose(here.weights, there.weights) and np.isclose(here.noise, there.noise)


def test_latent_columns_without_spread_or_values(spark):
    data = [(i, float(i), None, 5.0, float("nan") if i % 2 else float("inf")) for i in range(20)]
    df = spark.createDataFrame([*data, (20, None, None, None, None)], "id long, a double, none double, one double, odd double")
    model = latent.fit_latent(df, ["a", "none", "one", "odd"])
    drawn = latent.draw_latent(df, "id", model)
    assert rows(drawn.select("none", "one", "odd").distinct()) == [(None, 5.0, None)]
    assert drawn.where("a IS NULL").count() == 0
    empty = latent.fit_latent(df.limit(0), ["a", "one"])
    assert rows(latent.draw_latent(df, "id", empty).select("a", "one").distinct()) == [(None, None)]


def brute_group_means(data, levels):
    """The first mean over finite values of the groups of a row, from narrow to wide."""
    out = []
    for row in data:
        k, v = row[0], row[-1]
        if v is None or not math.isfinite(v):
            v = None
            for level in [*levels, ()]:
                if any(row[i] is None for i in level):
                    continue
                own = [r[-1] for r in data if all(r[i] == row[i] for i in level) and r[-1] is not None and math.isfinite(r[-1])]
                if own:
                    v = sum(own) / len(own)
                    break
        out.append((k, v))
    return sorted(out)


def test_impute_by_group(spark):
    rng = random.Random(2)
    places = [("c1", "d1"), ("c1", "d2"), ("c2", "d1"), ("c1", None), (None, "d1"), (None, None), ("c3", "d3")]
    data = []
    for i in range(300):
        c, d = rng.choice(places)
        v = rng.choice([None, float("nan"), float("-inf"), float(i)])
        # No value in d2 of c1, none in c3 at all.
        data.append((i, c, d, None if d == "d2" or c == "c3" else v))
    df = spark.createDataFrame(data, "id int, c string, d string, v double").withColumn("w", F.lit(None).cast("double"))
    filled = features.impute_by_group(df, ["v", "w"], [["c", "d"], ["c"]])
    assert filled.columns == df.columns
    got = sorted((r["id"], r["v"]) for r in filled.collect())
    expected = brute_group_means(data, [(1, 2), (1,)])
    assert [g[0] for g in got] == [e[0] for e in expected]
    assert all(math.isclose(g[1], e[1]) for g, e in zip(got, expected, strict=True))
    assert filled.where("w IS NOT NULL").count() == 0
    one = features.impute_by_group(df.select("id", "d", "v"), ["v"], [["d"]])
    assert all(
        math.isclose(g[1], e[1])
        for g, e in zip(sorted(tuple(r)[::2] for r in one.collect()), brute_group_means([(i, d, v) for i, _, d, v in data], [(1,)]), strict=True)
    )
    assert features.impute_by_group(df.limit(0), ["v"], [["c", "d"]]).collect() == []


def test_impute_by_group_is_one_grouping(spark):
    with pytest.raises(ValueError):
        features.impute_by_group(spark.range(3).withColumn("a", F.lit(1)), ["id"], [["a"], ["id"]])


def plain_points(pairs, bins, low, high):
    counts = {}
    for s, y in pairs:
        b = min(max(math.floor((s - low) * bins / (high - low)) if high > low else 0, 0), bins - 1)
        p, n = counts.get(b, (0, 0))
        counts[b] = (p + (y == 1), n + (y != 1))
    out, tp, fp = [], 0, 0
    for b in sorted(counts, reverse=True):
        tp, fp = tp + counts[b][0], fp + counts[b][1]
        out.append((b, tp, fp))
    return out


@pytest.mark.parametrize("bins", [1, 7, 1000])
def test_roc_points_and_area(spark, bins):
    random.seed(bins)
    pairs = [(random.gauss(0.2, 1) if y else random.gauss(-0.2, 1), y) for y in random.choices([0, 1], k=500)]
    df = spark.createDataFrame([*pairs, (None, 1), (float("nan"), 0), (0.5, None)], "score double, label int")
    low, high = min(s for s, _ in pairs), max(s for s, _ in pairs)
    points = models.roc_points(df, "score", "label", bins)
    assert [(r["bin"], r["tp"], r["fp"]) for r in points.collect()] == plain_points(pairs, bins, low, high)
    found = models.curve_area(points).first()
    exact = brute_auc(pairs)
    assert abs(found["area"] - exact) <= found["bound"] + 1e-12
    # One bin says nothing; seven leave about a fourth of all pairs open, which count half.
    assert found["bound"] == pytest.approx(0.5) if bins == 1 else found["bound"] < (0.2 if bins == 7 else 0.01)
    assert (found["positives"], found["negatives"]) == (sum(y for _, y in pairs), sum(1 - y for _, y in pairs))
    outside = models.roc_points(df, "score", "label", bins, low=-0.5, high=0.5)
    assert [(r["bin"], r["tp"], r["fp"]) for r in outside.collect()] == plain_points(pairs, bins, -0.5, 0.5)


def test_roc_points_of_one_score_one_class_and_nothing(spark):
    one = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.5, 0)], "score double, label int")
    assert models.curve_area(models.roc_points(one, "score", "label")).first()["area"] == 0.5
    positives = one.where("label = 1")
    assert rows(models.curve_area(models.roc_points(positives, "score", "label"))) == [(1, 0, None, None)]
    assert rows(models.curve_area(models.roc_points(one.limit(0), "score", "label"))) == [(0, 0, None, None)]
    assert models.roc_points(one.limit(0), "score", "label").collect() == []
