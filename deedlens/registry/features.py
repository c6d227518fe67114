"""Feature preparation, models and text polarity."""

from __future__ import annotations

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedlens.functions.hashing import bucket
from deedlens.operators import features, generate, label, latent, models, text
from deedlens.operators.profile import histogram_overlay
from deedlens.plans.ownership import clean_titles, labelled_titles, prepare_titles
from deedlens.plans.prices import with_row_key
from deedlens.registry.base import SQL, query
from deedlens.standins import (
    INDEX_SQL,
    INDEX_THRESHOLD,
    LABELLED_SQL,
    OWNERSHIP,
    TITLES_SQL,
    TRANSACTIONS_SQL,
    price_index,
    sql_bucket,
    table,
    titles,
    transactions,
)

_LEVELS_SQL = """
levels AS (SELECT "{column}" AS value, row_number() OVER (ORDER BY COUNT(*) DESC, "{column}") - 1 AS position
  FROM {source} WHERE "{column}" IS NOT NULL GROUP BY 1)"""


@query(
    f"""
WITH {TITLES_SQL}, {_LEVELS_SQL.format(column="District", source="titles")}
SELECT "TitleNumber", CAST(COALESCE(position, (SELECT COUNT(*) FROM levels)) AS DOUBLE) AS district_index
FROM titles LEFT JOIN levels ON "District" = value
"""
)
def q_string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District of every title as an index by frequency; no district gets the last index."""
    rows = titles(spark, sf_dir).select("TitleNumber", "District")
    return features.string_index(rows, "District", "district_index", invalid="keep").drop("District")


@query(
    f"""
WITH {TITLES_SQL}, {_LEVELS_SQL.format(column="PropertyAddress", source="titles")}
SELECT "TitleNumber", CAST(position AS DOUBLE) AS address_index
FROM titles JOIN levels ON "PropertyAddress" = value
"""
)
def q_string_index_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a column with about as many values as owners."""
    rows = titles(spark, sf_dir).select("TitleNumber", "PropertyAddress")
    return features.string_index(rows, "PropertyAddress", "address_index", invalid="skip").drop("PropertyAddress")


@query(
    f"""
WITH {TITLES_SQL}
SELECT "TitleNumber", round(COALESCE(CAST("PricePaid" AS DOUBLE), (SELECT AVG("PricePaid") FROM titles)), 6) AS "PricePaid"
FROM titles
"""
)
def q_impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing prices filled with the mean price."""
    filled = features.impute_mean(titles(spark, sf_dir).select("TitleNumber", "PricePaid"), ["PricePaid"])
    return filled.withColumn("PricePaid", F.round("PricePaid", 6))


# A district without prices, a county without prices, NULL districts, and numbers that are none.
_GAPS_SQL = """
gaps AS (SELECT "TitleNumber", "County", "District",
    CASE WHEN "District" IN ('NATION_1', 'NATION_2') OR "County" = 'ASIA' THEN NULL
      WHEN k % 19 = 0 THEN 'NaN'::DOUBLE WHEN k % 17 = 0 THEN 'Infinity'::DOUBLE ELSE CAST("PricePaid" AS DOUBLE) END AS price,
    CASE WHEN k % 13 <> 0 THEN CAST(k % 1000 AS DOUBLE) END AS points
  FROM (SELECT *, CAST(substr("TitleNumber", 2) AS BIGINT) AS k FROM titles))"""


def _first_mean_sql(column: str) -> str:
    finite = f"CASE WHEN isfinite({column}) THEN {column} END"
    return f"""round(COALESCE({finite},
    CASE WHEN "District" IS NOT NULL AND "County" IS NOT NULL THEN avg({finite}) OVER (PARTITION BY "County", "District") END,
    CASE WHEN "County" IS NOT NULL THEN avg({finite}) OVER (PARTITION BY "County") END, avg({finite}) OVER ()), 5) AS {column}"""


@query(
    f"""WITH {TITLES_SQL}, {_GAPS_SQL}
SELECT "TitleNumber", "County", "District", {_first_mean_sql("price")}, {_first_mean_sql("points")} FROM gaps"""
)
def q_impute_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns filled with the mean of the district, of the county or of all."""
    k = F.substring("TitleNumber", 2, 20).cast("bigint")
    gone = F.coalesce(F.col("District").isin("NATION_1", "NATION_2"), F.lit(False)) | (F.col("County") == "ASIA")
    price = F.when(gone, None).when(k % 19 == 0, F.lit(float("nan"))).when(k % 17 == 0, F.lit(float("inf")))
    rows = titles(spark, sf_dir).select(
        "TitleNumber",
        "County",
        "District",
        price.otherwise(F.col("PricePaid").cast("double")).alias("price"),
        F.when(k % 13 != 0, (k % 1000).cast("double")).alias("points"),
    )
    filled = features.impute_by_group(rows, ["price", "points"], [["County", "District"], ["County"]])
    return filled.withColumns({c: F.round(c, 5) for c in ("price", "points")})


@query(
    f"""
WITH {LABELLED_SQL}, {_LEVELS_SQL.format(column="Region", source="complete")}
SELECT "TitleNumber", CAST(slots.position AS INTEGER) AS slot, CAST(slots.position = levels.position AS INTEGER) AS hot
FROM complete JOIN levels ON "Region" = levels.value CROSS JOIN levels slots
"""
)
def q_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 0/1 row per title and region, the most frequent region in slot 0."""
    rows = prepare_titles(clean_titles(titles(spark, sf_dir))).kept.select("TitleNumber", "Region")
    hot = features.one_hot(rows, ["Region"], drop_last=False)
    slots = hot.select("TitleNumber", F.posexplode(vector_to_array("Region_vec")).alias("slot", "hot"))
    return slots.withColumn("hot", F.col("hot").cast("int"))


@query(
    f"""
WITH {TITLES_SQL},
stats AS (SELECT AVG("PricePaid") AS mean, stddev_samp("PricePaid") AS std FROM titles)
SELECT "TitleNumber", round(("PricePaid" - mean) / std, 6) AS scaled,
  round(("PricePaid" - mean) / std * std + mean, 2) AS restored
FROM titles, stats
"""
)
def q_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised prices, and the prices restored from them."""
    rows = titles(spark, sf_dir).select("TitleNumber", F.col("PricePaid").cast("double").alias("price"))
    stats = features.scaling(rows, ["price"])
    scaled = features.standardise(rows, ["price"], stats)
    restored = features.unstandardise(scaled.withColumn("scaled", F.col("price")), ["price"], stats)
    return restored.select(
        "TitleNumber", F.round("scaled", 6).alias("scaled"), F.round("price", 2).alias("restored")
    )


@query(
    f"""WITH {LABELLED_SQL} SELECT "TitleNumber", CAST("PricePaid" AS DOUBLE) AS feature_0 FROM complete"""
)
def q_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature vector of every complete title, unpacked."""
    kept = prepare_titles(clean_titles(titles(spark, sf_dir))).kept
    return kept.select("TitleNumber", vector_to_array("features")[0].alias("feature_0"))


_AUC_SQL = """
WITH scored AS (SELECT {score} AS score, quality AS label FROM documents JOIN labels USING (doc_id)),
ranked AS (SELECT label, (rank() OVER (ORDER BY score) + rank() OVER (ORDER BY score)
  + COUNT(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS mean_rank FROM scored),
sums AS (SELECT COUNT(CASE WHEN label = 1 THEN 1 END) AS positives, COUNT(CASE WHEN label <> 1 THEN 1 END) AS negatives,
  SUM(CASE WHEN label = 1 THEN mean_rank END) AS rank_sum FROM ranked)
SELECT positives, negatives,
  round((rank_sum - positives * (positives + 1) / 2.0::DOUBLE) / (positives * negatives), 9) AS auc FROM sums
"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")


@query(_AUC_SQL.format(score="n_chars"))
def q_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well the length of a document tells its quality."""
    return models.auc(_scored(spark, sf_dir), "n_chars", "quality").withColumn("auc", F.round("auc", 9))


@query(_AUC_SQL.format(score="CAST(floor(n_chars / 100.0) AS BIGINT)"))
def q_auc_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a coarse score, so that many documents tie."""
    coarse = _scored(spark, sf_dir).withColumn("hundreds", F.floor(F.col("n_chars") / 100))
    return models.auc(coarse, "hundreds", "quality").withColumn("auc", F.round("auc", 9))


_BINS = 40
_POINTS_SQL = f"""
scored AS (SELECT CAST(n_chars AS DOUBLE) AS score, quality = 1 AS positive FROM documents JOIN labels USING (doc_id)
  WHERE n_chars IS NOT NULL AND quality IS NOT NULL),
ends AS (SELECT min(score) AS low, max(score) AS high FROM scored),
binned AS (SELECT CAST(least(floor((score - low) * {_BINS} / (high - low)), {_BINS - 1}) AS INTEGER) AS bin, low, high,
  COUNT(*) FILTER (WHERE positive) AS pos, COUNT(*) FILTER (WHERE NOT positive) AS neg
  FROM scored, ends GROUP BY ALL),
points AS (SELECT bin, low + bin * (high - low) / {_BINS} AS threshold, pos, neg,
  CAST(SUM(pos) OVER (ORDER BY bin DESC) AS BIGINT) AS tp, CAST(SUM(neg) OVER (ORDER BY bin DESC) AS BIGINT) AS fp,
  CAST(SUM(pos) OVER () AS BIGINT) AS p, CAST(SUM(neg) OVER () AS BIGINT) AS n FROM binned)"""


@query(
    f"""WITH {_POINTS_SQL}
SELECT bin, round(threshold, 6) AS threshold, tp, fp, round(tp / p, 9) AS tpr, round(fp / n, 9) AS fpr FROM points"""
)
def q_roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curve of document lengths against quality as forty points."""
    points = models.roc_points(_scored(spark, sf_dir), "n_chars", "quality", bins=_BINS)
    digits = {"threshold": 6, "tpr": 9, "fpr": 9}
    return points.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query(
    f"""WITH {_POINTS_SQL},
exact AS (SELECT SUM(a.pos * b.neg) AS x FROM binned a, binned b WHERE a.bin > b.bin),
tied AS (SELECT SUM(pos * neg) AS x FROM binned)
SELECT max(p) AS positives, max(n) AS negatives, round(((SELECT x FROM exact) + (SELECT x FROM tied) / 2) / (max(p) * max(n)), 9) AS area,
  round((SELECT x FROM tied) / 2 / (max(p) * max(n)), 9) AS bound, TRUE AS holds FROM points"""
)
def q_curve_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The area under those points, its bound, and that the exact area lies within it."""
    rows = _scored(spark, sf_dir)
    exact = models.auc(rows, "n_chars", "quality").select("auc").scalar()
    found = models.curve_area(models.roc_points(rows, "n_chars", "quality", bins=_BINS)).withColumn("exact", exact)
    holds = F.abs(F.col("exact") - F.col("area")) <= F.col("bound") + F.lit(1e-12)
    return found.select("positives", "negatives", F.round("area", 9).alias("area"), F.round("bound", 9).alias("bound"), holds.alias("holds"))


def _parts_sql(source: str, key: str, label: str) -> str:
    """Rows of both classes on either side of the split, and that the forest has learnt something."""
    u = f"{sql_bucket(key, 42)} / 4294967296.0::DOUBLE"
    return f"""
SELECT CASE WHEN {u} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS part, COUNT(CASE WHEN {label} THEN 1 END) AS positives,
  COUNT(CASE WHEN NOT {label} THEN 1 END) AS negatives, TRUE AS learnt FROM {source} GROUP BY 1"""


def _learnt(forest: models.Forest, label: str, train: float, test: float) -> DataFrame:
    """The report with ``learnt`` for an area above each part's floor instead of the area, which depends on the fit."""
    report = models.forest_report(forest, label)
    floor = F.when(F.col("part") == "train", train).otherwise(test)
    return report.select("part", "positives", "negatives", (F.col("auc") > floor).alias("learnt"))


@query(f"WITH {TRANSACTIONS_SQL} {_parts_sql('transactions', 'transaction_id', 'is_fraud')}")
def q_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random forest on transactions, judged on training and test rows."""
    rows = label.bool_label(transactions(spark, sf_dir), "is_fraud", "label")
    forest = models.random_forest(rows, "label", ["category"], ["merchant"], ["amount"], "transaction_id", trees=20)
    return _learnt(forest, "label", 0.8, 0.8)


# Stand-in prices know no season and no region, so a model would have nothing to learn: both are put on them.
_LIVELY = """"AveragePrice" * (1 + 0.15::DOUBLE * month("Datetaken") + 0.1::DOUBLE * CAST(substr("AreaCode", 2) AS INTEGER))"""
_LIVELY_THRESHOLD = 160_000


@query(
    f"""WITH {INDEX_SQL},
keyed AS (SELECT "RegionName" || '|' || CAST("Datetaken" AS VARCHAR) AS row_key, {_LIVELY} AS price FROM price_index)
{_parts_sql('keyed', 'row_key', f'price >= {_LIVELY_THRESHOLD}')}"""
)
def q_forest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a price index with seasons and regions: date parts, region and area code against a high price."""
    index = with_row_key(price_index(spark, sf_dir))
    season, area = F.month("Datetaken") * F.lit(0.15), F.substring("AreaCode", 2, 9).cast("int") * F.lit(0.1)
    lively = index.withColumn("AveragePrice", F.col("AveragePrice") * (F.lit(1) + season + area))
    rows = features.date_parts(label.threshold_label(lively, "AveragePrice", _LIVELY_THRESHOLD, below=0), "Datetaken")
    hashed, numbers = ["RegionName", "AreaCode"], ["year", "month", "day"]
    forest = models.random_forest(rows, "is_fraud", [], hashed, numbers, "row_key", subset="onethird")
    return _learnt(forest, "is_fraud", 0.7, 0.7)


@query(f"""WITH {LABELLED_SQL} {_parts_sql('labelled', '"TitleNumber"', 'is_fraud = 1')}""")
def q_forest_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on titles: country, names, address indicator and price against the rule label."""
    rows = labelled_titles(clean_titles(titles(spark, sf_dir)), OWNERSHIP).drop("features")
    hashed = ["CountryIncorporated1", "ProprietorName2"]
    forest = models.random_forest(rows, "is_fraud", ["MultipleAddressIndicator"], hashed, ["PricePaid"], "TitleNumber")
    return _learnt(forest, "is_fraud", 0.7, 0.7)


@query()
def q_latent_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demonstration rows against rows drawn from the latent model: numbers and one-hot columns."""
    people = generate.demo_people(table(spark, sf_dir, "customer"), "c_custkey")
    people, genders = latent.one_hot_columns(people, "gender", ["M", "F"])
    people, districts = latent.one_hot_columns(people, "district", ["A", "B", "C", "D"])
    model = latent.fit_latent(people, ["age", "price", *genders, *districts])
    drawn = latent.draw_latent(people, "c_custkey", model)
    return histogram_overlay(people, drawn, ["age", "price"])


@query()
def q_latent_synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histograms of index prices and of prices drawn from the latent model fitted to them."""
    numbers = ["AveragePrice", "FlatPrice", "TerracedPrice", "SemiDetachedPrice", "DetachedPrice", "SalesVolume"]
    index = with_row_key(price_index(spark, sf_dir))
    model = latent.fit_latent(index, numbers)
    drawn = latent.draw_latent(index, "row_key", model)
    return histogram_overlay(index, drawn, numbers)


def _normal_sql(seed: str) -> str:
    """:func:`deedlens.functions.hashing.standard_normal` of the row key in SQL."""
    u = [f"({sql_bucket('row_key', seed, part)} / 4294967296.0::DOUBLE)" for part in (0, 1)]
    return f"(sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {u[0]})) * cos({2 * math.pi!r}::DOUBLE * {u[1]}))"


# With two columns and one dimension the model is any bivariate normal distribution. Where only the second column
# has gaps, its likelihood splits: the first column from all rows, the second's regression on it from the complete ones.
@query(
    f"""
WITH {INDEX_SQL},
pairs AS (SELECT "RegionName" || '|' || CAST("Datetaken" AS VARCHAR) AS row_key, "AveragePrice" AS x,
  CASE WHEN {sql_bucket("row_key", "gap")} % 4 <> 0 THEN "SemiDetachedPrice" END AS y
  FROM (SELECT *, "RegionName" || '|' || CAST("Datetaken" AS VARCHAR) AS row_key FROM price_index)),
scale AS (SELECT avg(x) AS mx, stddev_pop(x) AS dx, avg(y) AS my, stddev_pop(y) AS dy FROM pairs),
unit AS (SELECT (x - mx) / dx AS x, (y - my) / dy AS y FROM pairs, scale),
line AS (SELECT avg(x) AS ax, avg(y) AS ay, covar_pop(x, y) / var_pop(x) AS slope,
  var_pop(y) - covar_pop(x, y) * covar_pop(x, y) / var_pop(x) AS rest FROM unit WHERE y IS NOT NULL),
moments AS (SELECT avg(x) AS ux, var_pop(x) AS a FROM unit),
spread AS (SELECT ux, ay + slope * (ux - ax) AS uy, a, slope * a AS b, rest + slope * slope * a AS c FROM line, moments),
eigen AS (SELECT *, sqrt((a - c) * (a - c) / 4 + b * b) AS half, atan2(2 * b, a - c) / 2 AS turn FROM spread),
model AS (SELECT ux, uy, (a + c) / 2 - half AS noise, sqrt(2 * half) * cos(turn) AS wx, sqrt(2 * half) * sin(turn) AS wy FROM eigen),
signed AS (SELECT ux, uy, noise, wx * sign(CASE WHEN abs(wx) >= abs(wy) THEN wx ELSE wy END) AS wx,
  wy * sign(CASE WHEN abs(wx) >= abs(wy) THEN wx ELSE wy END) AS wy FROM model)
SELECT row_key,
  round(mx + dx * (ux + wx * {_normal_sql("42.0")} + sqrt(noise) * {_normal_sql("42.noise.0")}), 0) AS "AveragePrice",
  round(my + dy * (uy + wy * {_normal_sql("42.0")} + sqrt(noise) * {_normal_sql("42.noise.1")}), 0) AS "SemiDetachedPrice"
FROM pairs, scale, signed
"""
)
def q_latent_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows drawn from a latent model of two prices, one of which is missing in a fourth of the rows."""
    index = with_row_key(price_index(spark, sf_dir))
    gaps = F.when(bucket(F.col("row_key"), "gap") % 4 != 0, F.col("SemiDetachedPrice"))
    rows = index.select("row_key", "AveragePrice", gaps.alias("SemiDetachedPrice"))
    prices = ["AveragePrice", "SemiDetachedPrice"]
    drawn = latent.draw_latent(rows, "row_key", latent.fit_latent(rows, prices, dimensions=1))
    return drawn.select("row_key", *[F.round(c, 0).alias(c) for c in prices])


# A small lexicon of words that the texts hold.
LEXICON = {
    "best": 1.0,
    "clown": -0.25,
    "idiot": -0.75,
    "pathetic": -1.0,
    "scum": -0.875,
    "stupid": -0.75,
    "trash": -0.5,
    "vile": -1.0,
    "worthless": -0.875,
}
_SEPARATORS_SQL = "'" + text.SEPARATORS.replace("'", "''")[:-3] + "' || chr(9) || chr(10) || chr(13)"
_LEXICON_SQL = ", ".join(f"('{word}', {weight}::DOUBLE)" for word, weight in LEXICON.items())


@query(
    f"""
WITH lexicon(word, weight) AS (VALUES {_LEXICON_SQL}),
tokens AS (SELECT doc_id, unnest(string_split(
  translate(lower(text), {_SEPARATORS_SQL}, repeat(' ', {len(text.SEPARATORS)})), ' ')) AS word FROM documents),
means AS (SELECT doc_id, AVG(weight) AS mean FROM tokens JOIN lexicon USING (word) GROUP BY 1)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN CAST(COALESCE(mean, 0) AS FLOAT) END AS polarity
FROM documents LEFT JOIN means USING (doc_id)
"""
)
def q_polarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polarity of every document."""
    return text.polarity(table(spark, sf_dir, "documents"), "text", LEXICON).select("doc_id", "polarity")


@query(SQL["q_polarity"])
def q_polarity_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a lexicon of words that no text holds beside those that do, looked up by hash."""
    documents = table(spark, sf_dir, "documents")
    rows = [(word, weight) for word, weight in LEXICON.items()]
    own = spark.createDataFrame(rows, "word string, weight double")
    # As many words more as there are documents.
    others = documents.select(F.concat(F.lit("zz9"), F.col("doc_id").cast("string")).alias("word"), F.lit(1.0).alias("weight"))
    return text.polarity(documents, "text", own.union(others)).select("doc_id", "polarity")
