"""Near-duplicate documents by SimHash, compared exactly in tiles.

1. A document's fingerprint is the bitwise majority of the XXH64 values of its
   three-word shingles.
2. Equal fingerprints collapse. Distinct fingerprints are dealt into tiles by
   their number of set bits and, within one number, by a hash, so that a tile
   holds about ``TILE`` of them.
3. Two fingerprints within the radius differ by at most the radius in their
   number of set bits, so only such tile pairs are formed; in a task the two
   tiles are cut into runs of rows with alike bit counts per 16-bit word, and
   runs whose counts are too far apart are skipped in the same way. The rest
   is compared by exclusive-or and bit counts. Nothing that is linked is lost.
4. A task reports the links of its tile pair as a spanning forest, never as
   pairs, and distributed union-find joins the forests.

The comparison grows with the square of the distinct fingerprints, divided by
what the bit counts rule out; what a task holds is two tiles, whatever the size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from deedlens.llm.arrow import raw
from deedlens.llm.components import Forest, connected_components
from deedlens.sources.scratch import stored

SEED = 42
RADIUS = 3
SHINGLE = 3
#: Fingerprints in a tile: 256 KB, and about a second for a full tile pair.
TILE = 32_768
#: Rows in a run of a tile.
RUN = 256
_AT_ONCE = 1 << 16


def fingerprint(text: bytes) -> int:
    """The unsigned fingerprint of a text in UTF-8."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - SHINGLE + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = (starts + lengths)[-n:]
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _AT_ONCE):
        spans = zip(starts[i : min(n, i + _AT_ONCE)].tolist(), ends[i : i + _AT_ONCE].tolist(), strict=True)
        values = np.array([xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in spans], np.uint64)
        bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > n, bitorder="little")
    return int.from_bytes(majority.tobytes(), "little")


@arrow_udf(LongType())
def _fingerprints(text: pa.Array) -> pa.Array:
    values = np.fromiter(map(fingerprint, raw(text)), np.uint64, len(text))
    return pa.array(values.view(np.int64))


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, row, fp``: the fingerprint's 64 bits as a signed long, one row per row of ``df``.

    NULL, empty and blank texts have fingerprint 0. A text with fewer words than
    a shingle is one shingle of all its words.
    """
    return df.select(
        F.col(f"`{doc_id}`").alias("doc_id"), _row_hash(df).alias("row"), _fingerprints(F.col(f"`{text}`")).alias("fp")
    )


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))


def _runs(values: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]], np.ndarray, np.ndarray]:
    """Values in the order of their bit counts by word; runs of them; least and most counts of each run."""
    counts = np.bitwise_count(values.view(np.uint16).reshape(-1, 4))
    order = np.lexsort(counts.T[::-1])
    counts = counts[order].astype(np.int16)
    cuts = [(i, min(i + RUN, len(values))) for i in range(0, len(values), RUN)]
    least = np.array([counts[s:e].min(axis=0) for s, e in cuts])
    most = np.array([counts[s:e].max(axis=0) for s, e in cuts])
    return order, cuts, least, most


def close_forest(left: np.ndarray, right: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the links between two tiles of unsigned values, as pairs of positions in left + right.

    With one and the same tile on both sides, links within it.
    """
    same = left is right
    order_l, cuts_l, least_l, most_l = _runs(left)
    order_r, cuts_r, least_r, most_r = (order_l, cuts_l, least_l, most_l) if same else _runs(right)
    sorted_l, sorted_r = left[order_l], right[order_r]
    shift = 0 if same else len(left)
    forest, links = Forest(len(left) + (0 if same else len(right))), []
    for i, (s, e) in enumerate(cuts_l):
        apart = np.maximum(0, np.maximum(least_r - most_l[i], least_l[i] - most_r)).sum(axis=1)
        for j in np.flatnonzero(apart <= radius).tolist():
            if same and j < i:
                continue
            u, v = cuts_r[j]
            near = np.bitwise_count(sorted_l[s:e, None] ^ sorted_r[None, u:v]) <= radius
            if same and i == j:
                near = np.triu(near, 1)
            for x, y in np.argwhere(near).tolist():
                p, q = int(order_l[s + x]), int(order_r[u + y]) + shift
                if forest.join(p, q):
                    links.append((p, q))
    return links


def _tile_links(key: tuple, groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one tile pair; rows of the pair's first tile have ``side`` 0, of its second 1."""
    table = pa.Table.from_batches(groups)
    side = table.column("side").to_numpy()
    values = table.column("fp").to_numpy().view(np.uint64)
    left = values[side == 0]
    right = left if key[1].as_py() else values[side == 1]
    if len(left) and len(right):
        both = left if right is left else np.concatenate([left, right])
        links = np.array(close_forest(left, right), np.int64).reshape(-1, 2)
        ends = both[links].view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])


def close_links(distinct: DataFrame, radius_bits: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) that span every group of close ones."""
    spark = distinct.sparkSession
    rows = distinct.select("fp", F.bit_count("fp").alias("ones"))
    # At most 65 rows.
    sizes = {r["ones"]: r["n"] for r in rows.groupBy("ones").agg(F.count("*").alias("n")).collect()}
    tiles = {p: -(-n // tile) for p, n in sizes.items()}
    # The tile pairs of each number of bits, as ranges: (other number, its tiles), at most 7 of them.
    plan = [
        (p, tiles[p], q, tiles[q]) for p in sorted(tiles) for q in range(p - radius_bits, p + radius_bits + 1) if q in tiles
    ]
    if not plan:
        return spark.createDataFrame([], "a long, b long")
    pairs = F.broadcast(spark.createDataFrame(plan, "ones int, own int, other int, other_tiles int"))
    mine = F.pmod(F.xxhash64("fp"), F.col("own")).cast("int")
    dealt = (
        rows.join(pairs, "ones")
        .withColumn("mine", mine)
        .withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col("other_tiles") - 1)))
    )
    before = (F.col("ones") < F.col("other")) | ((F.col("ones") == F.col("other")) & (F.col("mine") <= F.col("theirs")))
    own, other = F.struct(F.col("ones").alias("p"), F.col("mine").alias("t")), F.struct(
        F.col("other").alias("p"), F.col("theirs").alias("t")
    )
    dealt = dealt.select(
        F.xxhash64(F.least(own, other), F.greatest(own, other)).alias("pair"),
        (own == other).alias("same"),
        F.when(before, 0).otherwise(1).alias("side"),
        "fp",
    )
    return dealt.groupBy("pair", "same").applyInArrow(_tile_links, "a long, b long")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, row, fp, root, component_id``, one row per row of ``df``.

    Documents are linked when their fingerprints differ in at most ``RADIUS``
    bits; ``component_id`` is the smallest id that links reach, the own one
    included, and ``root`` a fingerprint that tells components apart. Texts
    without a word share fingerprint 0 and are linked as any others. Rows with a
    NULL id take part; a component of such rows alone has a NULL
    ``component_id``. Repeated rows give repeated rows; ``row`` is a hash of all
    columns of ``df``. An empty table gives an empty frame. Jobs run while this
    is called.
    """
    docs = stored(fingerprints(df, doc_id, text), "fingerprints")
    classes = stored(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    roots = connected_components(close_links(classes.select("fp")))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        classes["fp"], "least", F.coalesce("root", classes["fp"]).alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "of_root")
    named = rooted.join(least, F.col("root") == F.col("of_root")).select(F.col("fp").alias("of_fp"), "root", "component_id")
    return docs.join(stored(named, "fingerprint-components"), F.col("fp") == F.col("of_fp")).select(
        "doc_id", "row", "fp", "root", "component_id"
    )


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each component the row with the smallest id stays.

    Rows without an id come last, ties go to the smaller hash of the row, and of
    rows that are equal in every column one stays.
    """
    units = near_duplicates(df, doc_id, text).groupBy("root", "doc_id", "row").agg(F.count("*").alias("copies"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "copies")).alias("first")
    chosen = stored(units.groupBy("root").agg(first).select("first.*"), "documents-kept")
    ids = chosen.select(F.col("doc_id").alias("_of_id"), F.col("row").alias("_of_row"))
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("_of_id")) & (_row_hash(df) == F.col("_of_row"))
    kept = df.join(ids, same, "left_semi")
    return kept if chosen.where("copies > 1").isEmpty() else kept.dropDuplicates()


def hexadecimal(fp: str) -> Column:
    """The 16 lower-case hexadecimal digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
