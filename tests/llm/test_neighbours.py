from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from deedlens.llm import queries
from deedlens.llm.neighbours import hilbert_keys, nearest

SCHEMA = "vec_id long, embedding array<float>, label string, at int"


def plain(rows, asks, k=10):
    out = {}
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q in vectors:
        if asks(q):
            scored = sorted((float(np.sqrt(((v - vectors[q]) ** 2).sum())), i) for i, v in vectors.items() if i != q)
            out[q] = scored[:k]
    return out


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_neighbouring_cells(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def by_query(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_of_query(spark):
    path = "/root/testdata/sf0.1/embeddings.parquet"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(path).collect()]
    expected = plain(rows, lambda q: q % 100 == 0)
    found = by_query(queries.QUERIES["op4_hilbert_neighbours"](spark, "/root/testdata/sf0.1"))
    assert set(found) == set(expected) and all(len(v) == 10 for v in found.values())
    hits = [len({i for _, i in found[q]} & {i for _, i in expected[q]}) for q in expected]
    assert np.mean(hits) / 10 >= 0.9
    exact = {i: np.array(v, float) for i, v in rows}
    for q, near in found.items():
        assert near == sorted(near)
        for score, i in near:
            assert score == pytest.approx(float(np.linalg.norm(exact[i] - exact[q])), rel=1e-12)


def test_full_windows_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-2, 3, 3).astype(float).tolist()) for i in range(3000)]
    rows = [(i, v) for i, v in rows if any(v)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    found = by_query(nearest(df, F.col("vec_id") % 100 == 0, share=1.0))
    assert found == plain(rows, lambda q: q % 100 == 0)


@pytest.mark.parametrize("times", [2, 12])
def test_repeated_rows_are_one_candidate(spark, times):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=3).round(3).tolist()) for i in range(150)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows for _ in range(times)], SCHEMA)
    found = by_query(nearest(df, F.col("vec_id") % 50 == 0, share=1.0))
    assert found == plain(rows, lambda q: q % 50 == 0)


def test_repeated_ids_across_blocks(spark):
    # More rows than a block: one id with many near vectors, which must not take the places of the others.
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=3).round(3).tolist()) for i in range(1500)]
    again = [(7, [x + 0.001 * j for x in rows[0][1]]) for j in range(1500)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + again], SCHEMA)
    found = by_query(nearest(df, F.col("vec_id") == 0, share=1.0))
    nearest_of = {}
    own = np.array(rows[0][1], np.float32).astype(float)
    for i, v in rows[1:] + again:
        score = float(np.sqrt(((np.array(v, np.float32).astype(float) - own) ** 2).sum()))
        nearest_of[i] = min(score, nearest_of.get(i, score))
    assert found == {0: sorted((s, i) for i, s in nearest_of.items())[:10]}


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0, 0.0], [None, 1.0], [nan, 1.0], [inf, 1.0]]
    rows = [(i, v, None, None) for i, v in enumerate(bad)] + [(None, [1.0, 1.0], None, None)]
    rows += [(100, [1.0, 0.0], "a", 1), (101, [1.0, 0.0], "a", 1), (102, [2.0, 0.0], "a", 1), (102, [1.5, 0.0], "a", 1)]
    rows += [(103, [1.0, 2.0, 3.0], "a", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert by_query(nearest(df, F.col("vec_id") % 100 == 0)) == {100: [(0.0, 101), (0.5, 102)]}
    assert nearest(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
