from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from deedlens.llm import positive, queries

SF_DIR = "/root/testdata/sf0.01"
DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"


def gaussians(n, prior, seed=1):
    """Features of positives and of a mixture, two of them telling."""
    rng = np.random.default_rng(seed)
    p, u = rng.normal(0, 1, (n, 6)), rng.normal(0, 1, (2 * n, 6))
    good = rng.random(2 * n) < prior
    p[:, :2] += 2
    u[:, :2] += np.where(good, 2, -2)[:, None]
    p[:, 5] = u[:, 5] = 1
    return p, u, good


@pytest.mark.parametrize("prior", [0.2, 0.5, 0.85])
def test_prior_and_risk(prior):
    p, u, good = gaussians(2000, prior)
    found = positive.class_prior(p, u)
    assert abs(found - prior) < 0.07
    weights = positive.nonnegative_risk(p, u, found)
    assert ((u @ weights > 0) == good).mean() > 0.97
    # The risk that is minimised has its loss near the one with all labels known.
    probability = 1 / (1 + np.exp(-(u @ weights)))
    assert abs(probability.mean() - prior) < 0.07


def test_labels_of_negatives_are_not_used(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice(["good", "text", "and", "more"]) if i % 4 else rng.choice(["A###", "$$%"]) for _ in range(50))) for i in range(200)]
    good = [(i, 1, 0) for i in range(200) if i % 4 and i % 2]
    bad = [(i, 0, 0) for i in range(0, 200, 4)]
    d = spark.createDataFrame(docs, DOCS)
    a = positive.fit(d, spark.createDataFrame(good, LABELS))
    b = positive.fit(d, spark.createDataFrame(good + bad, LABELS))
    assert np.array_equal(a.weights, b.weights) and a.prior == b.prior
    scores = {r.doc_id: r.s for r in d.select("doc_id", positive.score(F.col("text"), a, spark).alias("s")).collect()}
    assert all((scores[i] > 0.7) == bool(i % 4) for i in scores)


def test_same_model_for_any_partitioning(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    a, b = (positive.fit(documents.repartition(n), labels) for n in (1, 5))
    assert np.array_equal(a.weights, b.weights)


def test_edges(spark):
    docs = [(None, "x y"), (1, None), (2, ""), (3, " \n\t"), (4, "word " * 400_000), (5, "z" * 2_000_000), (1, "a b"), (1, "a b"), (6, "\x00 é 日本")]
    d = spark.createDataFrame(docs, DOCS)
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (2, 0, 0), (None, 1, 0), (4, None, 0), (9, 1, 1)], LABELS)
    model = positive.fit(d, labels)
    rows = d.select("doc_id", positive.score(F.col("text"), model, spark).alias("s")).collect()
    assert len(rows) == len(docs) and all(0 <= r.s <= 1 for r in rows)
    by_text = d.select("text", positive.score(F.col("text"), model, spark).alias("s")).distinct().collect()
    assert len({r.s for r in by_text if not (r.text or "").strip()}) == 1
    for empty in (positive.fit(d, labels.limit(0)), positive.fit(d.limit(0), labels)):
        assert {r.s for r in d.select(positive.score(F.col("text"), empty, spark).alias("s")).collect()} == {0.5}
    assert d.limit(0).select(positive.score(F.col("text"), model, spark)).collect() == []


def test_clashing_names(spark):
    names = "doc_id long, text string, _id long, _good int, _doc long, _text string, f string, quality int"
    rows = [(i, f"text number {i}", 0, 0, 0, "x", "y", 0) for i in range(20)]
    labels = spark.createDataFrame([(i, 1, 5, 5) for i in range(5)], "doc_id long, quality int, _id int, text int")
    model = positive.fit(spark.createDataFrame(rows, names), labels)
    plain = positive.fit(spark.createDataFrame([r[:2] for r in rows], DOCS), labels.select("doc_id", "quality"))
    assert np.array_equal(model.weights, plain.weights)


def test_features_of_pieces(monkeypatch):
    text = ("One two two, thrée\nfour ## four four\n" * 40).encode()
    whole = positive.features(text)
    monkeypatch.setattr(positive, "PIECE", 64)
    cut = positive.features(text)
    assert np.allclose(whole[: positive.DENSE], cut[: positive.DENSE])
    # Only trigrams across a cut are missing.
    assert np.abs(whole[positive.DENSE :] - cut[positive.DENSE :]).max() < 0.1
    words = text.split()
    assert whole[positive.DENSE - 6] == pytest.approx(np.log1p(len(words)))
    assert whole[positive.DENSE - 4] == pytest.approx(len(set(words)) / len(words))
    assert not positive.features(b" \n").any() and len(positive.features(b"a")) == positive.SIZE


def test_query_on_held_out_labels(spark):
    result = queries.QUERIES["op13_quality_classifier"](spark, SF_DIR)
    assert [(f.name, f.dataType.simpleString()) for f in result.schema] == [
        ("doc_id", "bigint"),
        ("held_out", "boolean"),
        ("score", "double"),
        ("predicted", "int"),
    ]
    rows = result.collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)


@pytest.mark.parametrize(("sf_dir", "least"), [(SF_DIR, 0.85), ("/root/testdata/sf0.1", 0.95)])
def test_held_out_labels(spark, sf_dir, least):
    rows = queries.QUERIES["op13_quality_classifier"](spark, sf_dir).where("held_out").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    told = [(r.score, labels[r.doc_id]) for r in rows if r.doc_id in labels]
    good, bad = ([s for s, q in told if q == k] for k in (1, 0))
    # The smaller table has 19 bad documents to judge.
    assert np.mean([s >= 0.7 for s in good]) > least and np.mean([s < 0.7 for s in bad]) > least
    assert np.mean([g > b for g in good for b in bad]) > 0.95
