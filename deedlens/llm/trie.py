"""Prefix trie of conversations by truncation peeling.

A conversation is the row of its turns, and a node of depth d is a distinct row
of first d turns. Depths are peeled from the deepest up: the nodes of depth
d + 1 lose their last turn, conversations of exactly d turns join them, and one
group-by makes both the nodes of depth d. Whatever is summed over a subtree is
summed on the way, so no prefix is ever written out for each conversation. The
end of a conversation that no different one shares is peeled at once.

A turn is stood for by ``RECORD`` bytes: the SHA-256 of role and text, and the
text's length in bytes. A ``path`` is the records of a row of turns one after
the other; to strip the last turn is to cut off its record. Equal whole
conversations are one row before the first round, so groups of copies cost
nothing, and a round shuffles partial sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deedlens.sources.scratch import scratch_path, stored, stored_at

#: Bytes of a path for each turn: a digest and a length.
RECORD = 32 + 8
#: Ids within a span of this size are written into one row before they are hashed.
SPAN = 4096

_ENDED = "path binary, conv_id long, n_convs long, ends_sha256 string"


def depth_of(path: Column) -> Column:
    return (F.octet_length(path) / RECORD).cast("long")


def first_turns(path: Column, n: Column | int) -> Column:
    """The path of the first ``n`` turns."""
    return F.substr(path, F.lit(1), (F.lit(n) * RECORD).cast("int"))


def after_turns(path: Column, n: Column | int) -> Column:
    """The path of the turns after the first ``n``."""
    return F.substr(path, (F.lit(n) * RECORD + 1).cast("int"))


def sequences(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id, path``: each conversation's turns in order.

    Turns go by their number, NULL first, and equal numbers by their digest, so
    repeated rows stay, next to each other. NULL roles and texts are empty. Rows
    without a ``conv_id`` belong to no conversation and are left out.
    """
    said, by = F.coalesce(F.col(f"`{text}`"), F.lit("")), F.coalesce(F.col(f"`{role}`"), F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said), 256)
    record = F.concat(digest, F.lpad(F.hex(F.octet_length(said).cast("long")), 16, "0"))
    number = F.col(f"`{turn}`").cast("long")
    return (
        turns.select(
            F.col(f"`{conv_id}`").cast("long").alias("conv_id"),
            # What orders turns is small: texts are not collected.
            F.struct(number.isNotNull(), F.coalesce(number, F.lit(0)), record.alias("record")).alias("turn"),
        )
        .where("conv_id IS NOT NULL")
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("turn")).alias("turns"))
        .select("conv_id", F.unhex(F.array_join("turns.record", "")).alias("path"))
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each run of equal paths; the ids of a run are hashed as they come."""
    current, least, n, digest = None, None, 0, None

    def done() -> pa.RecordBatch:
        columns = [pa.array([current], pa.binary()), pa.array([least], pa.int64()), pa.array([n], pa.int64())]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array([digest.hexdigest()])], ["path", "conv_id", "n_convs", "ends_sha256"]
        )

    for batch in batches:
        finished = []
        for row in batch.to_pylist():
            if digest is None or row["path"] != current:
                if digest is not None:
                    finished.append(done())
                current, least, n, digest = row["path"], row["least"], 0, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(row["ids"].encode())
            n += row["n"]
        if finished:
            yield pa.Table.from_batches(finished).combine_chunks().to_batches()[0]
    if digest is not None:
        yield done()


def _ended(paths: DataFrame) -> DataFrame:
    """``path, conv_id, n_convs, ends_sha256, depth``: one row for each distinct whole conversation."""
    spans = paths.groupBy("path", F.expr(f"conv_id div {SPAN}").alias("span")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids"),
        F.min("conv_id").alias("least"),
        F.count("*").alias("n"),
    )
    runs = spans.repartition("path").sortWithinPartitions("path", "span").select("path", "ids", "least", "n")
    return runs.mapInArrow(_digests, _ENDED).withColumn("depth", depth_of(F.col("path")))


def _bytes_of_turn(path: Column, n: Column) -> Column:
    """Length in bytes of the ``n``-th turn's text."""
    return F.conv(F.hex(F.substr(path, ((n - 1) * RECORD + 33).cast("int"), F.lit(8))), 16, 10).cast("long")


def _name(path: Column) -> Column:
    """What stands for a node in the result and in the join with its parent."""
    return F.unhex(F.sha2(path, 256))


def _with_shared_depth(ended: DataFrame) -> DataFrame:
    """Add ``start``: a depth behind which a conversation shares no turn with a different one.

    It is the smallest power of two at which its node belongs to it alone, or
    its own depth. Whatever lies deeper need not be peeled turn by turn.
    """
    powers = F.array(*(F.lit(2**i).cast("long") for i in range(31)))
    marks = ended.select("path", F.explode(F.filter(powers, lambda p: p <= F.col("depth"))).alias("mark"))
    prefix = first_turns(F.col("path"), F.col("mark"))
    alone = marks.groupBy(prefix.alias("prefix"), "mark").agg(F.count("*").alias("n"), F.min("path").alias("of_path")).where("n = 1")
    first = alone.groupBy("of_path").agg(F.min("mark").alias("mark"))
    joined = ended.join(first, F.col("path") == F.col("of_path"), "left")
    return joined.withColumn("start", F.coalesce("mark", "depth")).drop("of_path", "mark")


def _unshared(ended: DataFrame) -> DataFrame:
    """Nodes that lie deeper than ``start``: each has the members of one distinct conversation."""
    deep = ended.where("depth > start").withColumn("d", F.explode(F.sequence(F.col("start") + 1, F.col("depth"))))
    last = F.col("d") == F.col("depth")
    rows = deep.select(
        _name(F.col("path")).alias("whole"),
        _name(first_turns(F.col("path"), F.col("d"))).alias("node"),
        _name(first_turns(F.col("path"), F.col("d") - 1)).alias("parent"),
        F.col("d").alias("depth"),
        "conv_id",
        "n_convs",
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * _bytes_of_turn(F.col("path"), F.col("d"))).alias("own"),
        F.when(last, F.col("ends_sha256")).otherwise(F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
    # One conversation's turns, from the last up.
    below = Window.partitionBy("whole").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("saved_tokens", F.sum("own").over(below)).select(*_NODE)


_NODE = ["node", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_NODE_TYPE = (
    "node binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)


def trie(paths: DataFrame) -> DataFrame:
    """The nodes of a trie over ``conv_id, path``, one row per conversation; an empty path ends at the root.

    ``node`` names a node, ``depth`` its turns, ``conv_id`` its smallest member
    and ``parent_conv_id`` its parent's (NULL at the root). ``n_convs`` counts
    members, ``n_children`` children, ``n_leaves`` the childless nodes of the
    subtree. ``saved_tokens`` sums, over the subtree, the bytes of a node's last
    text for each member but one. ``ends_sha256`` hashes the ids of the members
    that end here, ascending and joined by commas. Without conversations there
    is no node, not even a root.

    The turns at the end of a conversation that it shares with no different one
    are peeled in one step. The others take one round per depth, so rounds follow
    the longest shared start (up to the next power of two), not the longest
    conversation. Jobs run while this is called; each round is a stored table.
    """
    spark = paths.sparkSession
    ended_path, nodes_path = scratch_path(spark, "ended"), scratch_path(spark, "trie")
    kind = f"{_ENDED}, depth long, start long"
    whole = stored(_ended(paths), "conversations")
    _with_shared_depth(whole).write.partitionBy("start").parquet(ended_path)
    ended = spark.read.schema(kind).parquet(ended_path)
    stored_at(_unshared(ended), f"{nodes_path}/unshared")
    deepest = ended.agg(F.max("start")).first()[0]
    level, levels = None, [f"{nodes_path}/unshared"]
    for depth in range(-1 if deepest is None else deepest, -1, -1):
        cut = F.col("depth") > F.col("start")
        tail = F.aggregate(
            F.sequence(F.col("start") + 1, F.col("depth")),
            F.lit(0).cast("long"),
            lambda total, d: total + (F.col("n_convs") - 1) * _bytes_of_turn(F.col("path"), d),
        )
        rows = ended.where(F.col("start") == depth).select(
            first_turns(F.col("path"), depth).alias("first_turns"),
            "conv_id",
            "n_convs",
            F.when(cut, 1).otherwise(0).cast("long").alias("n_children"),
            F.when(cut, 1).otherwise(0).cast("long").alias("n_leaves"),
            F.when(cut, tail).otherwise(0).alias("saved_tokens"),
            F.when(~cut, F.col("ends_sha256")).alias("ends_sha256"),
        ).withColumnRenamed("first_turns", "path")
        if level is not None:
            stripped = level.select(
                first_turns(F.col("path"), depth).alias("path"),
                "conv_id",
                "n_convs",
                F.lit(1).cast("long").alias("n_children"),
                "n_leaves",
                "saved_tokens",
                F.lit(None).cast("string").alias("ends_sha256"),
            )
            rows = rows.union(stripped)
        own = _bytes_of_turn(F.col("path"), F.lit(depth)) if depth else F.lit(0).cast("long")
        parent = _name(first_turns(F.col("path"), depth - 1)) if depth else F.lit(None).cast("binary")
        levels.append(f"{nodes_path}/{depth}")
        level = stored_at(
            rows.groupBy("path")
            .agg(
                F.min("conv_id").alias("conv_id"),
                *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
                F.max("ends_sha256").alias("ends_sha256"),
            )
            .withColumn("n_leaves", F.greatest("n_leaves", F.lit(1)))
            .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * own)
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
            .withColumns({"node": _name(F.col("path")), "parent": parent, "depth": F.lit(depth).cast("long")}),
            levels[-1],
        )
    nodes = spark.read.schema(_NODE_TYPE).parquet(*levels)
    parents = nodes.select(F.col("node").alias("of_node"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(parents, F.col("parent") == F.col("of_node"), "left").select(
        "node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def prefix_trie(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The trie of a table of turns; see ``sequences`` and ``trie``.

    Other columns are not read, whatever their names; texts of any length are
    hashed whole; an empty table gives an empty frame.
    """
    return trie(stored(sequences(turns, conv_id, turn, role, text), "paths"))


def shared_starts(paths: DataFrame, starts: Column, of: Column) -> DataFrame:
    """Rebuild each conversation on another's start.

    The first ``starts`` turns of the conversation whose id is ``of`` (all if it
    has fewer, none if it does not exist) replace the first ``starts`` turns of
    its own. ``starts`` and ``of`` are columns of ``conv_id``.
    """
    rows = paths.select("conv_id", "path", starts.alias("starts"), of.alias("of"))
    bases = paths.select(F.col("conv_id").alias("base"), F.col("path").alias("base_path"))
    start = F.coalesce(first_turns(F.col("base_path"), F.col("starts")), F.lit(b""))
    return rows.join(bases, F.col("of") == F.col("base"), "left").select(
        "conv_id", F.concat(start, after_turns(F.col("path"), F.col("starts"))).alias("path")
    )
