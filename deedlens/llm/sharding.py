"""Proportional stratified interleaving, in DataFrame operations only.

Rows of a source are ranked in a seeded random order; the fraction
``(rank + 1/2) / rows of the source`` spreads every source evenly over (0, 1).
Sorted by that fraction, any stretch of the corpus holds each source in the
proportion of the whole, so cutting the sorted corpus into equal stretches
gives shards of equal row counts that all match the mixture: a source's count
in a shard differs from its share by less than two rows.

Neither ranking sorts a source, or the corpus, in one task. Rows fall into
``buckets`` equal ranges of the ordering value, a row's rank is the number of
rows in earlier ranges plus its number within its own range, and the ranges are
what the shuffle deals out. A source with a third of all rows is therefore
spread over all tasks.

Everything is a function of row content and seed, so lost executors and other
cluster sizes give the same shards. Rows that are equal in every column used
are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deedlens.llm.ranking import rank_in_group
from deedlens.sources.scratch import stored

#: Bytes that a row takes besides its text.
ROW_OVERHEAD = 8


def _earlier(*order: Column) -> Window:
    return Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def interleaved_shards(
    df: DataFrame,
    shards: int = 24,
    seed: int = 42,
    buckets: int = 1024,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Deal rows into shards whose counts differ by at most one and which all match the source mixture.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard, source``:
    ``size`` is the UTF-8 length of the text plus ``ROW_OVERHEAD``, ``law`` is
    always ``rows``, ``slot`` numbers the rows of a shard from 0 without gaps,
    and ``grown_shard`` is NULL, for the law makes no promise about another
    shard count. With fewer rows than shards, some shards stay empty.

    A NULL text counts as empty. A NULL source is a source of its own, a NULL
    id an id like others. Repeated rows are kept, each with its own slot. An
    empty table gives an empty frame. Other columns are not looked at.

    ``buckets`` is how finely the two orderings are dealt out; it must grow
    with the cluster (a few times its cores), not with the data.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    size = (F.octet_length(body) + F.lit(ROW_OVERHEAD)).cast("long")
    checksum = F.crc32(body.cast("binary"))
    rows = df.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        size.alias("size"),
        checksum.alias("text_crc32"),
    ).withColumn("draw", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size", "source"), 1))
    # Both rankings read their rows twice, once to count: narrow rows are stored for that, texts are read once.
    ranked = rank_in_group(
        stored(rows, "shard-rows"), "source", "draw", ["doc_id", "text_crc32", "size"], buckets
    ).withColumnRenamed("in_group", "in_source")
    # floor(buckets * (rank + 1/2) / in_source), in whole numbers
    place = F.expr(f"(2 * rank + 1) * {buckets} div (2 * in_source)")
    ranked = stored(ranked.withColumn("place", place), "shard-ranks")
    counts = ranked.groupBy("place").agg(F.count("*").alias("n"))
    # One row per bucket, whatever the size of the table.
    before = F.broadcast(
        counts.select(
            F.col("place").alias("of_place"),
            F.coalesce(F.sum("n").over(_earlier(F.col("place"))), F.lit(0)).alias("before"),
            F.sum("n").over(Window.partitionBy()).alias("total"),
        )
    )
    fraction = (F.col("rank") + 0.5) / F.col("in_source")
    order = Window.partitionBy("place").orderBy(
        fraction, "source", "rank", "draw", "doc_id", "text_crc32", "size"
    )
    return (
        ranked.withColumn("number", F.row_number().over(order))
        .join(before, F.col("place") == F.col("of_place"))
        .withColumn("position", F.col("before") + F.col("number") - 1)
        .withColumn("shard", F.expr(f"position * {shards} div total"))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            F.expr(f"position - (shard * total + {shards - 1}) div {shards}").cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "source",
        )
    )
