"""Approximate nearest neighbours on shifted space-filling curves.

Every vector is projected several times onto a few random directions, shifted,
and put on a Hilbert curve; sorted by its place on the curve, near vectors tend
to lie near each other in one ordering or another. A query looks at a window of
ranks around its own in each ordering, and the candidates of all windows are
reranked by their distance in double precision.

``SHARE`` is the half width of a window as a share of all rows, so that recall
does not depend on the size of the table. Data of low inner dimension do with a
small one. Vectors without structure, such as noise around a few centres, need
a large one, and then the work grows with queries times rows.

Windows are compared in tiles of ``BLOCK`` ranks against the queries of
``64 * BLOCK`` ranks, which bounds what a task holds; windows are counted in
ranks, so copies and ties cannot fill a block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, LongType
from pyspark.sql.window import Window

from deedlens.llm.arrow import lists
from deedlens.operators.ranking import global_position

ORDERINGS = 8
#: Directions of a projection and bits of each: 60 bits of curve.
DIRECTIONS, BITS = 4, 15
SHARE = 0.1
#: A window never has fewer ranks to a side than this.
LEAST = 100
#: Vectors that centre and spread of the projections are taken from, at most.
SAMPLE = 4_096
BLOCK = 2_048
SEED = 42


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of whole numbers below ``2 ** bits`` (Skilling's transform)."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    top = 1 << (bits - 1)
    step = top
    while step > 1:
        low = step - 1
        for i in range(len(x)):
            high = (x[i] & step) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        step >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros(len(cells), np.int64)
    step = top
    while step > 1:
        flip ^= np.where((x[-1] & step) != 0, step - 1, 0)
        step >>= 1
    key = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | ((axis ^ flip) >> bit & 1)
    return key


@dataclass
class Curves:
    """Projections of all orderings: directions, and the lower corner and width of the grid of each."""

    directions: np.ndarray
    low: np.ndarray
    width: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, orderings: int = ORDERINGS, seed: int = SEED) -> Curves:
        rng = np.random.default_rng(seed)
        dims = sample.shape[1]
        used = min(DIRECTIONS, dims)
        directions = np.stack([np.linalg.qr(rng.normal(size=(dims, used)))[0].T for _ in range(orderings)])
        projected = np.einsum("okd,nd->nok", directions, sample)
        spread = np.maximum(projected.std(axis=0), 1e-12)
        shift = rng.uniform(-1, 1, spread.shape) * spread
        return cls(directions, projected.mean(axis=0) - 5 * spread + shift, 10 * spread)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """One key per vector and ordering."""
        projected = np.einsum("okd,nd->nok", self.directions, vectors, optimize=True)
        cells = np.clip((projected - self.low) / self.width * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
        return np.column_stack([hilbert_keys(cells[:, o], BITS) for o in range(cells.shape[1])])


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def usable(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, vector`` of the rows that take part.

    Left out are NULL ids, vectors that are NULL, empty or zero, and those with
    a component that is NULL, NaN or infinite.
    """
    v = F.col("vector")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return df.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0)
    )


def _nearest(dims: int, k: int):
    """Of one block and one tile of queries: each query's nearest ids, each at its nearest row."""

    def search(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks()
        if not table.num_rows:
            return
        asks = table.column("asks").to_numpy()
        ids = table.column("vec_id").to_numpy()
        vectors = _matrix(table.column("vector").combine_chunks(), dims)
        queries, rows = np.flatnonzero(asks), np.flatnonzero(~asks)
        rows = rows[np.argsort(ids[rows], kind="stable")]
        block = vectors[rows]
        # Rows of one id stand together and count once, so that k of them are k candidates.
        block_ids, firsts = np.unique(ids[rows], return_index=True)
        if not len(block_ids):
            return
        found = []
        for q in queries:
            score = np.minimum.reduceat(np.sqrt(np.square(block - vectors[q]).sum(axis=1)), firsts)
            score[block_ids == ids[q]] = np.inf
            near = np.argsort(score, kind="stable")[:k] if len(score) <= 4 * k else _smallest(score, k)
            near = near[np.isfinite(score[near])]
            found.append((np.full(len(near), ids[q]), block_ids[near], score[near]))
        if found:
            columns = (np.concatenate(c) for c in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    return search


def _smallest(score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest values, ties to the earlier position."""
    border = np.partition(score, k - 1)[k - 1]
    inside = np.flatnonzero(score <= border)
    return inside[np.argsort(score[inside], kind="stable")[:k]]


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 10,
    share: float = SHARE,
    orderings: int = ORDERINGS,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every query the k nearest rows that the windows hold.

    ``is_query`` is a condition on ``vec_id``. Candidates are all rows but those
    with the query's own id; nearest first, ties to the smaller id. With fewer
    candidates than k, all are returned. See ``usable`` for rows that take no
    part; vectors whose length differs from that of most sampled ones take none
    either. A repeated id is one candidate, at its nearest vector; as a query it
    asks with each of its vectors and keeps the nearest answers of all. An
    empty table gives an empty frame. Jobs run while this is called.
    """
    spark = df.sparkSession
    rows = usable(df, vec_id, vector)
    sample = rows.orderBy(F.xxhash64(F.lit(SEED), "vec_id"), "vec_id").limit(SAMPLE).select("vector").collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sample:
        return spark.createDataFrame([], schema)
    sizes = [len(r[0]) for r in sample]
    dims = max(set(sizes), key=lambda n: (sizes.count(n), n))
    curves = Curves.fit(np.array([r[0] for r in sample if len(r[0]) == dims], float), orderings)

    @arrow_udf(ArrayType(LongType()))
    def keys(column: pa.Array) -> pa.Array:
        found = curves.keys(_matrix(column, dims))
        return lists(found.reshape(-1), [orderings] * len(found), pa.int64())

    placed = rows.where(F.size("vector") == dims).select("vec_id", "vector", F.posexplode(keys("vector")).alias("ordering", "key"))
    order = [F.col("ordering"), F.col("key"), F.col("vec_id"), F.col("vector")]
    numbered = global_position(placed, order, "position")
    # Every ordering has each row once.
    n = numbered.count() // orderings
    width = max(LEAST, math.ceil(share * n))
    tile = 64 * BLOCK
    numbered = numbered.withColumn("at", F.col("position") % n).drop("key", "position")
    reach = F.sequence(
        F.expr(f"greatest(at - {width}, 0) div {BLOCK}"), F.expr(f"least(at + {width}, {n - 1}) div {BLOCK}")
    )
    tiles = F.sequence(F.expr(f"greatest(at - {width}, 0) div {tile}"), F.expr(f"least(at + {width}, {n - 1}) div {tile}"))
    asking = numbered.where(is_query).select(
        "ordering", F.explode(reach).alias("block"), F.expr(f"at div {tile}").alias("tile"), F.lit(True).alias("asks"), "vec_id", "vector"
    )
    asked = numbered.select(
        "ordering", F.expr(f"at div {BLOCK}").alias("block"), F.explode(tiles).alias("tile"), F.lit(False).alias("asks"), "vec_id", "vector"
    )
    found = (
        asking.union(asked)
        .groupBy("ordering", "block", "tile")
        .applyInArrow(_nearest(dims, k), "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
    )
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
