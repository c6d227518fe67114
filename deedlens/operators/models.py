"""Random forest and area under the ROC curve."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from multiprocessing.pool import ThreadPool
from operator import and_

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deedlens.functions.hashing import bucket, draw_digits, poisson_count, poisson_count_of_digits, poisson_thresholds, uniform  # noqa: F401
from deedlens.functions.text import quoted
from deedlens.operators.features import flag_keys, flag_stages, flagged_rows, hashed_slots
from deedlens.operators.ranking import running_total
from deedlens.operators.sampling import row_key, split
from deedlens.sources.scratch import stored


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Exact area under the ROC curve, tied scores counted half.

    Rows are first reduced to one per score; a running count of negatives over
    the sorted scores then gives, for each positive, the negatives below it.
    """
    scores = (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    )
    ranked = running_total(scores, [F.asc("score")], "neg", "neg_to_here")
    # Whole numbers throughout; pairs of a trillion rows need more than 64 bits.
    wide = "decimal(38,0)"
    below_twice = (F.col("neg_to_here") * 2 - F.col("neg")).cast("decimal(19,0)")
    pairs = F.sum((F.col("pos").cast("decimal(18,0)") * below_twice).cast(wide))
    return ranked.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"),
        pairs.cast("double").alias("_pairs"),
    ).select(
        "positives",
        "negatives",
        (F.col("_pairs") / F.nullif(F.col("positives").cast("double") * F.col("negatives") * 2, F.lit(0.0))).alias(
            "auc"
        ),
    )


def roc_points(df: DataFrame, score: str, label: str, bins: int = 1000, low: float | None = None, high: float | None = None) -> DataFrame:
    """The curve as at most ``bins`` points: ``bin, threshold, tp, fp, tpr, fpr``, highest scores first.

    Scores are counted in bins of equal width from ``low`` to ``high``, by
    default the smallest and largest score, so what is held is one row per bin
    whatever the number of scores, and counts of parts can be added. ``tp`` and
    ``fp`` count the positives and negatives in this and all higher bins;
    ``threshold`` is the bin's lower edge. Scores beyond an end count in the bin
    at that end; NULL and NaN scores and NULL labels are left out.
    """
    rows = df.select(F.col(quoted(score)).cast("double").alias("score"), (F.col(quoted(label)) == 1).alias("positive")).where(
        "score IS NOT NULL AND NOT isnan(score) AND positive IS NOT NULL"
    )
    if low is None or high is None:
        ends = rows.agg(F.struct(F.min("score").alias("low"), F.max("score").alias("high")).alias("ends")).scalar()
        rows = rows.withColumn("_ends", ends)
        first, last = F.col("_ends.low"), F.col("_ends.high")
    else:
        first, last = F.lit(float(low)), F.lit(float(high))
    at = F.floor((F.col("score") - first) * F.lit(bins) / F.nullif(last - first, F.lit(0.0)))
    counted = (
        rows.select(
            F.greatest(F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1)), F.lit(0)).cast("int").alias("bin"),
            "positive",
            first.alias("first"),
            last.alias("last"),
        )
        .groupBy("bin", "first", "last")
        .agg(F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("neg"))
    )
    # No more rows than bins: one task sums them up.
    higher = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()
    sums = counted.select(
        "bin",
        (F.col("first") + F.col("bin") * (F.col("last") - F.col("first")) / F.lit(bins)).alias("threshold"),
        F.sum("pos").over(higher).alias("tp"),
        F.sum("neg").over(higher).alias("fp"),
        F.sum("pos").over(everything).alias("_p"),
        F.sum("neg").over(everything).alias("_n"),
    )
    rates = {"tpr": F.col("tp") / F.nullif("_p", F.lit(0)), "fpr": F.col("fp") / F.nullif("_n", F.lit(0))}
    return sums.withColumns(rates).drop("_p", "_n").orderBy(F.desc("bin"))


def curve_area(points: DataFrame) -> DataFrame:
    """Area under :func:`roc_points` by trapezoids, and how far the exact area may be from it.

    Only pairs within a bin are not ordered by their bins. They count half, so
    the exact area lies within half their share of all pairs: ``bound``.
    """
    before = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    steps = points.select(
        "tp", "fp", F.coalesce(F.max("tp").over(before), F.lit(0)).alias("tp0"), F.coalesce(F.max("fp").over(before), F.lit(0)).alias("fp0")
    )
    wide = "decimal(19,0)"
    pos, neg = (F.col("tp") - F.col("tp0")).cast(wide), (F.col("fp") - F.col("fp0")).cast(wide)
    pairs = F.sum((neg * (F.col("tp") + F.col("tp0")).cast(wide)).cast("decimal(38,0)")).cast("double")
    within = F.sum((pos * neg).cast("decimal(38,0)")).cast("double")
    total = F.nullif(F.max("tp").cast("double") * F.max("fp").cast("double"), F.lit(0.0))
    return steps.agg(
        F.coalesce(F.max("tp"), F.lit(0)).alias("positives"),
        F.coalesce(F.max("fp"), F.lit(0)).alias("negatives"),
        (pairs / total / 2).alias("area"),
        (within / total / 2).alias("bound"),
    )


#: Rows, taken by key digest, that the split candidates of numbers are read from, as MLlib takes about as many.
CANDIDATE_ROWS = 10_000
#: Split candidates of a number, at most.
CANDIDATES = 31
#: Trees that are fitted at a time.
PARALLEL_TREES = 4
#: With fewer kinds of rows than these, a tree may draw one kind alone.
FEW_KINDS = 100


def split_candidates(
    df: DataFrame, numbers: Sequence[str], key: str, seed: int = 42, rows: int = CANDIDATE_ROWS, most: int = CANDIDATES
) -> dict[str, list[float]]:
    """Values between which trees may split each number: quantiles over ``rows`` rows.

    The rows are those with the smallest digests of key and seed, so the
    candidates do not depend on the partitioning, and what reaches the driver is
    bounded by ``rows``. A number with one value has no candidate.
    """
    draw = bucket(row_key(df, key), f"{seed}.candidates")
    values = df.select(draw.alias("_draw"), *[F.col(quoted(c)).cast("double").alias(c) for c in numbers])
    # All columns decide ties, so that equal draws leave no choice.
    sample = values.orderBy("_draw", *[quoted(c) for c in numbers]).limit(rows).drop("_draw").collect()
    found = {}
    for i, name in enumerate(numbers):
        own = np.array([r[i] for r in sample if r[i] is not None and np.isfinite(r[i])])
        if not own.size:
            found[name] = []
            continue
        # The largest value is no border: nothing lies above it.
        borders = np.quantile(own, np.arange(1, most + 1) / (most + 1), method="lower")
        found[name] = [float(v) for v in np.unique(borders) if v < own.max()]
    return found


def _flags(vector: str, out: str, size: int) -> Column:
    """The vector marked as 0/1 features, so that MLlib need not look for split candidates of its own."""
    flags = [{"idx": i, "vals": ["0", "1"]} for i in range(size)]
    return F.col(vector).alias(out, metadata={"ml_attr": {"attrs": {"binary": flags}, "num_attrs": size}})


@dataclass(frozen=True)
class Forest:
    """Fitted preprocessing and trees, with scored training and test rows."""

    preparation: PipelineModel
    trees: list[RandomForestClassificationModel]
    size: int
    train: DataFrame | None = None
    test: DataFrame | None = None

    def prepared(self, df: DataFrame) -> DataFrame:
        """Rows with their vector of 0/1 features; rows with a NULL number are left out."""
        rows = self.preparation.transform(df)
        return rows.withColumn("features", _flags("features", "features", self.size))

    def scored(self, prepared: DataFrame) -> DataFrame:
        """Add ``score``, the mean over the trees of the probability of class 1."""
        names = [f"_tree_{i}" for i in range(len(self.trees))]
        rows = prepared
        for name, tree in zip(names, self.trees, strict=True):
            rows = tree.transform(rows).drop("rawPrediction", "prediction").withColumn(name, vector_to_array("probability")[1]).drop("probability")
        return rows.withColumn("score", sum((F.col(n) for n in names[1:]), F.col(names[0])) / len(names)).drop(*names)


def random_forest(
    df: DataFrame,
    label: str,
    encoded: Sequence[str],
    hashed: Sequence[str],
    numbers: Sequence[str],
    key: str,
    trees: int = 10,
    train_share: float = 0.8,
    seed: int = 42,
    depth: int = 5,
    subset: str = "sqrt",
) -> Forest:
    """Split by key, fit the preprocessing and a forest on the training part, score both parts.

    The forest is a function of rows, keys and seed, however the rows lie in
    partitions: a tree takes each training row as often as a Poisson draw of its
    key says (as a weight, without copies), and numbers become 0/1 features, one
    for each of the :func:`split_candidates`. MLlib's own draws, which go by
    partition, are not used. Counts of such rows are whole numbers, so the order
    of their sums does not matter either. So rows of equal features and label are
    drawn one by one, but fitted and scored as one row with their summed weight:
    what a tree passes over are the kinds of rows, and the rows themselves are
    read a few times, whatever the number of trees. Kinds are told apart by
    what decides the features (:func:`flag_keys`), so a row's own vector is
    neither made nor moved.

    ``key`` decides split and draws and is no feature; see :func:`flag_stages`
    for ``encoded`` and ``hashed`` text columns. ``subset`` is how many features a
    node chooses from, as MLlib names it; few values in many slots want more
    than the root of their number. Trees are fitted some at a time, each over
    the same stored kinds of rows.
    """
    kept = [F.col(quoted(c)) for c in (key, label, *encoded, *hashed)]
    needed = df.select(*kept, *[F.col(quoted(c)).cast("double").alias(c) for c in numbers])
    split_rows = split(needed, {"train": train_share, "test": 1.0 - train_share}, seed, key)
    slots = [f"_slot_{i}" for i in range(len(hashed))]
    slotted = hashed_slots(split_rows, hashed, slots).withColumn("_row", F.monotonically_increasing_id())
    parts = stored(slotted.select(*split_rows.columns, "_row", *slots), "training")
    train = parts.filter(F.col("part") == "train")
    # Rows without a key are told apart by all columns given here: not by their place.
    borders = split_candidates(train.select(*split_rows.columns), numbers, key, seed)
    preparation = Pipeline(stages=flag_stages(encoded, hashed, borders)).fit(train)
    sizes = preparation.transform(train.limit(1)).schema["features"].metadata["ml_attr"]
    forest = Forest(preparation, [], sizes["num_attrs"])
    # Equal in these, equal in features: whole vectors are made of one row of each kind only.
    flags = {f"_flag_{i}": c for i, c in enumerate(flag_keys(encoded, slots, borders))}
    rows = flagged_rows(parts, borders).withColumns(flags).drop(*slots)
    kinds = _kinds(rows, list(flags), row_key(needed, key), label, [f"{seed}.tree.{t}" for t in range(trees)])
    first = parts.select("_row", *[F.col(quoted(c)) for c in dict.fromkeys([*encoded, *hashed, *numbers])])
    kinds = stored(forest.prepared(kinds.join(first, "_row")).select(*kinds.columns, "features"), "kinds")
    training = kinds.filter(F.col("part") == "train")
    if training.limit(FEW_KINDS).count() < FEW_KINDS:
        # MLlib wants two rows at least: where a tree may draw a single kind, each is two rows of half the weight.
        training = training.withColumns({f"_weight_{t}": F.col(f"_weight_{t}") / 2 for t in range(trees)}).withColumn(
            "_half", F.explode(F.array(F.lit(0), F.lit(1)))
        )

    def fit(tree: int) -> RandomForestClassificationModel:
        weight = f"_weight_{tree}"
        learner = RandomForestClassifier(
            labelCol=label,
            featuresCol="features",
            weightCol=weight,
            numTrees=1,
            bootstrap=False,
            featureSubsetStrategy=subset if trees > 1 else "all",
            maxDepth=depth,
            seed=seed + tree,
        )
        return learner.fit(training.filter(F.col(weight) > 0).select(label, "features", weight))

    with ThreadPool(min(PARALLEL_TREES, trees)) as pool:
        fitted = pool.map(inheritable_thread_target(df.sparkSession)(fit), range(trees))
    forest = replace(forest, trees=fitted)
    scores = stored(forest.scored(kinds.dropDuplicates(list(flags)).select(*flags, "features")), "scores")
    found = scores.select(*[F.col(f).alias(f"_of{f}") for f in flags], "features", "score")
    same = reduce(and_, [F.col(f).eqNullSafe(F.col(f"_of{f}")) for f in flags], F.lit(True))
    scored = rows.join(found, same).select(*split_rows.columns, "features", "score")
    return replace(forest, train=scored.filter(F.col("part") == "train"), test=scored.filter(F.col("part") == "test"))


def _kinds(rows: DataFrame, flags: Sequence[str], key: Column, label: str, seeds: Sequence[str]) -> DataFrame:
    """Rows of equal flags, label and part as one row: what a tree needs of them, once for all trees.

    ``_weight_<i>`` is how often the tree of ``seeds[i]`` draws these rows, added
    up over them, so a fit sees the same sums as over single rows. ``_row`` is
    the smallest number of these rows.
    """
    draws = [F.when(F.col("part") == "train", draw_digits(key, s)).alias(f"_draw_{i}") for i, s in enumerate(seeds)]
    limits = poisson_thresholds(1.0)
    weights = [
        F.sum(F.coalesce(poisson_count_of_digits(F.col(f"_draw_{i}"), limits), F.lit(0))).cast("double").alias(f"_weight_{i}")
        for i in range(len(seeds))
    ]
    grouped = (
        rows.select(*flags, F.col(quoted(label)), "part", "_row", *draws)
        .groupBy(*flags, quoted(label), "part")
        .agg(F.min("_row").alias("_row"), *weights)
    )
    # Stored, so that Catalyst knows how few they are before it joins them with the rows.
    return stored(grouped, "grouped")


def forest_report(forest: Forest, label: str) -> DataFrame:
    """Area under the curve on both parts, one row each."""
    train = auc(forest.train, "score", label).withColumn("part", F.lit("train"))
    return train.unionByName(auc(forest.test, "score", label).withColumn("part", F.lit("test")))
