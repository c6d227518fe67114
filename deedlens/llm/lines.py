"""Line dedup: equal and nearly equal lines, by MinHash.

1. Lines with a character other than white space take part, without the white
   space around them. Equal lines are one line, by a 64-bit hash.
2. A line's signature are ``BANDS * ROWS`` minima over its shingles of
   ``SHINGLE`` characters, letter case of A-Z aside. Lines that agree in all
   minima of a band are candidates: at a Jaccard similarity of 0.8, 99.7 % of
   pairs agree in at least one band.
3. All lines of a band's bucket go to the group of its pivot, the bucket's
   smallest line. There they are compared exactly, Jaccard of the shingle sets;
   lines that are linked already need no comparison. Large groups are cut into
   tiles, each with the pivot; lines of such a group that nothing links to the
   pivot are compared with all other tiles in a second pass. So no candidate
   pair is lost, and no task holds more than a tile or two.
4. Groups report spanning forests. Distributed union-find joins them, and of
   each component the line with the smallest place is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, LongType, StringType

from deedlens.llm.arrow import lists, texts
from deedlens.llm.components import Forest, connected_components
from deedlens.sources.scratch import stored

SHINGLE = 8
BANDS, ROWS = 8, 3
SIMILARITY = 0.8
#: Lines of a group that one task compares.
TILE = 512
#: Characters whose shingles a worker holds at once, one longer line excepted; few enough for the processor's cache.
_AT_ONCE = 1 << 16
_SEED = 42


def shingle_values(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit value for each run of ``SHINGLE`` characters of each line, and where each line's values begin.

    A shorter line is one run, filled up with a number that is no character.
    All lines are worked on as one row of characters; runs across two lines are left out.
    """
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    padded = np.maximum(lengths, SHINGLE)
    starts = np.cumsum(padded) - padded
    codes = np.full(int(padded.sum()), 0x110000, np.uint64)
    read = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes[np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(read))] = np.where(
        (read >= 65) & (read <= 90), read + 32, read
    )
    n = max(len(codes) - SHINGLE + 1, 0)
    value = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        value *= np.uint64(0x9E3779B97F4A7C15)
        value += codes[i : i + n]
        value ^= value >> np.uint64(29)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(32)
    within = np.ones(len(codes), bool)
    within[((starts + padded)[:, None] - np.arange(1, SHINGLE)).reshape(-1)] = False
    counts = padded - SHINGLE + 1
    return value[within[:n]], np.cumsum(counts) - counts


def _portions(lines: list[str]) -> Iterator[list[str]]:
    """Lines of ``_AT_ONCE`` characters together, one longer line excepted."""
    start = 0
    while start < len(lines):
        end, size = start, 0
        while end < len(lines) and (end == start or size + len(lines[end]) <= _AT_ONCE):
            size += max(len(lines[end]), SHINGLE)
            end += 1
        yield lines[start:end]
        start = end


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    n = BANDS * ROWS
    return rng.integers(0, 2**32, n, np.uint32) | np.uint32(1), rng.integers(0, 2**32, n, np.uint32)


def band_keys(lines: list[str]) -> np.ndarray:
    """One row of ``BANDS`` keys per line."""
    factors, offsets = _multipliers()
    keys, start = np.empty((len(lines), BANDS), np.int64), 0
    for own in _portions(lines):
        values, firsts = shingle_values(own)
        values = (values >> np.uint64(32)).astype(np.uint32)
        minima = np.column_stack(
            [np.minimum.reduceat(values * a + b, firsts) for a, b in zip(factors, offsets, strict=True)]
        ).astype(np.uint64)
        for band in range(BANDS):
            key = np.full(len(own), band + 1, np.uint64)
            for column in minima[:, band * ROWS : (band + 1) * ROWS].T:
                key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(31)
            keys[start : start + len(own), band] = key.view(np.int64)
        start += len(own)
    return keys


@arrow_udf(ArrayType(LongType()))
def _bands(line: pa.Array) -> pa.Array:
    keys = band_keys(list(texts(line)))
    return lists(keys.reshape(-1), [BANDS] * len(keys), pa.int64())


def similar_forest(
    left: list[np.ndarray], right: list[np.ndarray] | None = None, least: float = SIMILARITY
) -> list[tuple[int, int]]:
    """A spanning forest of the links among sorted shingle sets, or between two lists of them.

    Pairs are positions in left + right. A set is compared with all others that
    it is not linked to yet at once; the first set of a list comes first, so a
    group that resembles it is settled by one comparison.
    """
    sets = left + (right or [])
    n, first = len(sets), len(left)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    roots = np.arange(n)
    links = []
    for i in range(first):
        others = np.arange(i + 1 if right is None else first, n)
        low, high = np.minimum(sizes[i], sizes[others]), np.maximum(sizes[i], sizes[others])
        # Sets of too different sizes are out, linked ones are settled.
        others = others[(roots[others] != roots[i]) & (low >= least * high)]
        if not len(others):
            continue
        values = np.concatenate([sets[j] for j in others])
        at = np.minimum(np.searchsorted(sets[i], values), sizes[i] - 1)
        starts = np.cumsum(sizes[others]) - sizes[others]
        both = np.add.reduceat(sets[i][at] == values, starts, dtype=np.int64)
        for j in others[both >= least * (sizes[i] + sizes[others] - both)].tolist():
            if roots[i] != roots[j]:
                roots[roots == max(roots[i], roots[j])] = min(roots[i], roots[j])
                links.append((i, j))
    return links


def _distinct(values: np.ndarray) -> np.ndarray:
    ordered = np.sort(values)
    first = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    return ordered[first]


def shingle_sets(lines: list[str]) -> list[np.ndarray]:
    """The different values of each line, sorted."""
    sets = []
    for own in _portions(lines):
        values, firsts = shingle_values(own)
        sets += map(_distinct, np.split(values, firsts[1:]))
    return sets


def _sets(table: pa.Table) -> list[np.ndarray]:
    return shingle_sets(table.column("line").to_pylist())


_FOUND = "a long, b long, pivot long, loose boolean"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "b", "pivot", "loose"]
    )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, list[int], list[str]]]]:
    """Whole groups ``(pivot, hashes, lines)`` out of sorted rows, as many at a time as ``_AT_ONCE`` characters hold."""
    done, current, size = [], None, 0
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("pivot", "tile", "h", "line"))
        for pivot, tile, h, line in zip(*columns, strict=True):
            if current is None or current[0] != (pivot, tile):
                if size > _AT_ONCE:
                    yield done
                    done, size = [], 0
                current = ((pivot, tile), [], [])
                done.append((pivot, current[1], current[2]))
            current[1].append(h)
            current[2].append(line)
            size += len(line)
    if done:
        yield done


def _alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted shingle sets are similar enough."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if len(small) < SIMILARITY * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int(np.count_nonzero(large[np.minimum(at, len(large) - 1)] == small))
    return both >= SIMILARITY * (len(a) + len(b) - both)


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each tile, and the lines that stay apart from the pivot, as ``loose`` rows.

    Tiles come one after the other, the pivot first in each. Most have two
    lines, so what is done per tile is kept small, and the shingles of many
    tiles are taken together.
    """
    for groups in _groups(batches):
        sets = iter(shingle_sets([line for _, _, lines in groups for line in lines]))
        rows = []
        for pivot, ids, _ in groups:
            own = [next(sets) for _ in ids]
            if len(ids) == 2:
                alike = _alike(*own)
                rows.append((ids[0], ids[1], pivot, False) if alike else (ids[1], ids[1], pivot, True))
                continue
            links = similar_forest(own)
            rows += [(ids[i], ids[j], pivot, False) for i, j in links]
            forest = Forest(len(ids))
            for i, j in links:
                forest.join(i, j)
            rows += [(h, h, pivot, True) for i, h in enumerate(ids) if forest.root(i) != forest.root(0)]
        if rows:
            yield _batch(rows)


def _across(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between loose lines and one tile of their group."""
    table = pa.Table.from_batches(batches).sort_by([("h", "ascending")])
    loose = table.filter(table.column("loose"))
    others = table.filter(pc.invert(table.column("loose")))
    ids = loose.column("h").to_pylist() + others.column("h").to_pylist()
    rows = [(ids[i], ids[j], None, False) for i, j in similar_forest(_sets(loose), _sets(others)) if ids[i] != ids[j]]
    if rows:
        yield _batch(rows)


def lines_of(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, row, line_no, line, h``: the lines with a character other than white space; ``row`` tells texts apart."""
    docs = df.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.xxhash64(F.col(f"`{text}`")).alias("row"),
        F.posexplode(F.split(F.col(f"`{text}`"), "\n")).alias("line_no", "line"),
    )
    line = F.trim(F.col("line"), F.lit(" \t\x0b\x0c\r"))
    return (
        docs.withColumn("line", line)
        .where(F.col("line") != "")
        .select("doc_id", "row", F.col("line_no").cast("long").alias("line_no"), "line", F.xxhash64("line").alias("h"))
    )


def _tiled(edges: DataFrame, tile: int) -> DataFrame:
    """``pivot, h, tile, tiles, is_pivot``: lines of each group in tiles, its pivot in each of them."""
    sizes = edges.groupBy("pivot").agg(F.ceil(F.count("*") / tile).cast("long").alias("tiles")).withColumnRenamed("pivot", "p")
    members = edges.join(sizes, F.col("pivot") == F.col("p")).select(
        "pivot", "h", F.pmod(F.xxhash64("h"), F.col("tiles")).alias("tile"), "tiles", F.lit(False).alias("is_pivot")
    )
    pivots = sizes.select(
        F.col("p").alias("pivot"),
        F.col("p").alias("h"),
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"),
        "tiles",
        F.lit(True).alias("is_pivot"),
    )
    return members.union(pivots)


def line_components(df: DataFrame, doc_id: str = "doc_id", text: str = "text", tile: int = TILE) -> DataFrame:
    """``doc_id, row, line_no, h, keep_doc_id, keep_row, keep_line_no, kept`` for each line that takes part.

    The kept line of a component is that of the smallest (doc_id, row, line_no),
    NULL ids first. Rows of ``df`` that are equal in id and text share their
    places, so they keep and lose the same lines. Jobs run while this is called.
    """
    lines = lines_of(df, doc_id, text)
    place = F.struct("doc_id", "row", "line_no")
    # Of equal lines, the text and the bands of one are enough; bands are made after lines have met.
    firsts = lines.select("h", F.struct(place.alias("place"), "line").alias("first")).groupBy("h").agg(F.min("first").alias("first"))
    distinct = stored(firsts.select("h", "first.place", "first.line").withColumn("bands", _bands("line")), "lines")
    banded = distinct.select("h", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("h").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    edges = stored(
        banded.join(buckets.select(F.col("key").alias("k"), "pivot"), F.col("key") == F.col("k"))
        .where("h != pivot")
        .select("pivot", "h")
        .distinct(),
        "line-candidates",
    )
    members = _tiled(edges, tile)
    lined = distinct.select(F.col("h").alias("of_h"), "line")
    texts_of = stored(
        members.join(lined, F.col("h") == F.col("of_h")).select("pivot", "h", "tile", "tiles", "is_pivot", "line"), "line-texts"
    )
    sorted_tiles = texts_of.repartition("pivot", "tile").sortWithinPartitions("pivot", "tile", F.desc("is_pivot"), "h")
    found = stored(sorted_tiles.select("pivot", "tile", "h", "line").mapInArrow(_within, _FOUND), "line-links")
    links = found.where("NOT loose").select("a", "b")
    several = F.col("tiles") > 1
    loose = (
        found.where("loose")
        .select(F.col("a").alias("h"), "pivot")
        .join(texts_of.where(several).select(F.col("pivot").alias("p"), F.col("h").alias("m")), (F.col("pivot") == F.col("p")) & (F.col("h") == F.col("m")), "left_semi")
    )
    loose = stored(loose, "loose-lines")
    if not loose.isEmpty():
        links = links.union(_loose_links(loose, texts_of.where(several), tile))
    roots = connected_components(links)
    rooted = distinct.join(roots, F.col("h") == F.col("node"), "left").select(
        "h", "place", F.coalesce("root", "h").alias("root")
    )
    kept = rooted.groupBy("root").agg(F.min(F.struct("place", "h")).alias("keep")).withColumnRenamed("root", "of_root")
    named = rooted.join(kept, F.col("root") == F.col("of_root")).select(F.col("h").alias("of_h"), "keep")
    same = (
        (F.col("h") == F.col("keep.h"))
        & F.col("doc_id").eqNullSafe(F.col("keep.place.doc_id"))
        & (F.col("row") == F.col("keep.place.row"))
        & (F.col("line_no") == F.col("keep.place.line_no"))
    )
    return (
        lines.drop("line")
        .join(stored(named, "line-components"), F.col("h") == F.col("of_h"))
        .select(
            "doc_id",
            "row",
            "line_no",
            "h",
            F.col("keep.place.doc_id").alias("keep_doc_id"),
            F.col("keep.place.row").alias("keep_row"),
            F.col("keep.place.line_no").alias("keep_line_no"),
            same.alias("kept"),
        )
    )


def _loose_links(loose: DataFrame, members: DataFrame, tile: int) -> DataFrame:
    """Links between loose lines and the other tiles of their groups."""
    chunks = loose.groupBy("pivot").agg(F.ceil(F.count("*") / tile).cast("long").alias("chunks")).withColumnRenamed("pivot", "p")
    groups = members.where("NOT is_pivot").join(chunks, F.col("pivot") == F.col("p")).drop("p")
    others = groups.select(
        "pivot", "tile", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "h", F.lit(False).alias("loose"), "line"
    )
    mine = loose.select(F.col("pivot").alias("lp"), F.col("h").alias("lh"))
    apart = groups.join(mine, (F.col("pivot") == F.col("lp")) & (F.col("h") == F.col("lh"))).select(
        "pivot",
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"),
        F.pmod(F.xxhash64("h"), F.col("chunks")).alias("chunk"),
        "h",
        F.lit(True).alias("loose"),
        "line",
    )
    return others.union(apart).groupBy("pivot", "tile", "chunk").applyInArrow(_across, _FOUND).select("a", "b")


@arrow_udf(StringType())
def _without(text: pa.Array, dropped: pa.Array) -> pa.Array:
    def rest(t: str | None, numbers: list[int] | None) -> str | None:
        if t is None or not numbers:
            return t
        gone = set(numbers)
        return "\n".join(line for i, line in enumerate(t.split("\n")) if i not in gone)

    return pa.array([rest(t.as_py(), d.as_py()) for t, d in zip(text, dropped, strict=True)], pa.string())


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The same rows and columns, with one line of each component left in the corpus.

    Blank lines stay. A document that loses all its lines stays with what is
    left, perhaps an empty text. NULL texts stay NULL, and an empty table gives
    an empty frame. See ``line_components``.
    """
    lost = (
        line_components(df, doc_id, text)
        .where("NOT kept")
        .groupBy(F.col("doc_id").alias("_of_id"), F.col("row").alias("_of_row"))
        .agg(F.collect_set("line_no").alias("_lost"))
    )
    t = F.col(f"`{text}`")
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("_of_id")) & (F.xxhash64(t) == F.col("_of_row"))
    return df.join(lost, same, "left").withColumn(text, _without(t, F.col("_lost"))).select(*(F.col(f"`{c}`") for c in df.columns))
