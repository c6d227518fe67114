"""Ranked lexical search by scanning the documents with an Aho-Corasick automaton.

Documents are not indexed. The terms of all items form one automaton, in which
each term stands between two boundary marks; a text is folded (separators become
the mark, A-Z become a-z) and read once, and what the automaton reports is how
often each item term occurs in it. A term leads to the items that hold it, so
the counts of a text become its scores for all items.

Two scans: the first counts documents, terms and document frequencies over all
rows, the second scores each document and keeps, per task, the best ``k`` of each
item. Ranking these is all that is shuffled.

Items are dealt into blocks of at most ``BLOCK`` item terms (one longer item
excepted), and each block scans the documents, so what is broadcast has a bound
whatever the number of items.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, BinaryType
from pyspark.sql.window import Window

from deedlens.llm.arrow import raw
from deedlens.operators.ranking import running_total
from deedlens.sources.scratch import stored

K = 20
#: Item terms of a block: one for each different term of an item.
BLOCK = 200_000
#: Bytes of a text that the automaton reads at once, a longer term excepted.
PIECE = 1 << 20
#: Bytes of a term that the automaton holds as they are. Longer ones stand in it as their SHA-256, in items and texts alike.
LONGEST = 256
#: Scores and item terms that a task works on at once, a single document excepted.
_AT_ONCE = 1 << 21
#: Groups that the best rows of the tasks of one item are dealt into before its last ranking.
_PARTS = 256

_DOCUMENTS, _TERMS = -1, -2


def _folded(byte: int) -> int:
    """Digits, a-z and all bytes beyond ASCII stay, A-Z become a-z, everything else is the boundary mark."""
    if 0x41 <= byte <= 0x5A:
        return byte + 32
    return byte if 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A or byte >= 0x80 else 0x20


_FOLD = bytes(map(_folded, range(256)))


def terms(text: bytes) -> list[bytes]:
    """All terms of a text in UTF-8, in order."""
    return text.translate(_FOLD).split()


def _short(term: bytes) -> bytes:
    """The term, or its digest behind a byte that no term holds."""
    return term if len(term) <= LONGEST else b"\0" + hashlib.sha256(term).digest().hex().encode()


def _pieces(text: bytes) -> Iterator[bytes]:
    """The folded text, cut before boundary marks."""
    folded = text.translate(_FOLD)
    start = 0
    while start < len(folded):
        end = folded.find(b" ", start + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[start:end]
        start = end


@dataclass
class Block:
    """The automaton of a block of items, and where its terms lead.

    ``item`` and ``times`` of the term ``t`` stand from ``first[t]`` to
    ``first[t + 1]``: the items that hold it and how often.
    """

    automaton: ahocorasick.Automaton | None
    ids: list[int | None]
    first: np.ndarray
    item: np.ndarray
    times: np.ndarray
    weight: np.ndarray | None = None
    documents: int = 0
    terms: int = 0

    @classmethod
    def of(cls, rows: list[tuple[int | None, bytes, int]]) -> Block:
        """From ``(item_id, term, times)``, each pair of item and term once."""
        ids = sorted({r[0] for r in rows}, key=lambda i: (i is not None, i))
        position = {item: p for p, item in enumerate(ids)}
        rows = sorted(((term, position[item], times) for item, term, times in rows))
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        first = []
        for at, (term, _, _) in enumerate(rows):
            if not at or rows[at - 1][0] != term:
                automaton.add_word(f" {_short(term).decode('latin-1')} ", len(first))
                first.append(at)
        automaton.make_automaton()
        columns = np.array([(p, n) for _, p, n in rows], np.int64).reshape(-1, 2)
        return cls(automaton, ids, np.array([*first, len(rows)], np.int64), columns[:, 0], columns[:, 1])

    def counts(self, text: bytes) -> tuple[int, Counter]:
        """The number of terms of a text, and how often each term of the block occurs in it."""
        n, found = 0, Counter()
        for piece in _pieces(text):
            words = piece.split()
            n += len(words)
            if words and max(map(len, words)) > LONGEST:
                piece = b" ".join(map(_short, words))
            found.update(map(itemgetter(1), self.automaton.iter(f" {piece.decode('latin-1')} ")))
        return n, found

    def set_weights(self, sums: dict[int, int]) -> None:
        """Term weights from the document frequencies and totals of all documents."""
        self.documents, self.terms = sums.get(_DOCUMENTS, 0), sums.get(_TERMS, 0)
        frequency = np.array([sums.get(t, 0) for t in range(len(self.first) - 1)], float)
        self.weight = np.floor(1000 * np.log((2.0 * self.documents + 2) / (2 * frequency + 1))).astype(np.int64)

    def scores(self, lengths: list[int], found: list[Counter]) -> np.ndarray:
        """Documents times items: the scores of documents from their numbers of terms and counts."""
        m = np.array([75 + 25 * n * self.documents // self.terms for n in lengths], np.int64)
        sizes = np.array([len(f) for f in found], np.int64)
        document = np.repeat(np.arange(len(found)), sizes)
        term = np.fromiter((t for f in found for t in f), np.int64, int(sizes.sum()))
        tf = np.fromiter((n for f in found for n in f.values()), np.int64, len(term))
        value = self.weight[term] * (10**9 * tf // (1000 * tf + 12 * m[document]))
        # From terms to the items that hold them.
        spread = self.first[term + 1] - self.first[term]
        at = np.repeat(self.first[term] - np.cumsum(spread) + spread, spread) + np.arange(int(spread.sum()))
        cell = np.repeat(document * len(self.ids), spread) + self.item[at]
        total = np.zeros(len(found) * len(self.ids), np.int64)
        np.add.at(total, cell, np.repeat(value, spread) * self.times[at])
        return total.reshape(len(found), -1)


class _Best:
    """The best ``k`` documents of each item so far: highest score first, then NULL and smaller ids."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.floor = np.ones(items, np.int64)
        self.kept = np.empty((0, 4), np.int64)
        self.most = 2 * items * k + (1 << 16)

    def add(self, ids: list[int | None], scores: np.ndarray) -> None:
        document, item = np.nonzero(scores >= self.floor)
        known = np.array([i is not None for i in ids], np.int64)
        number = np.array([i or 0 for i in ids], np.int64)
        new = np.column_stack([item, -scores[document, item], known[document], number[document]])
        self.kept = np.concatenate([self.kept, new])
        if len(self.kept) > self.most:
            self.cut()

    def cut(self) -> None:
        rows = self.kept[np.lexsort(self.kept.T[::-1])]
        start = np.flatnonzero(np.diff(rows[:, 0], prepend=-1))
        rank = np.arange(len(rows)) - np.repeat(start, np.diff(start, append=len(rows)))
        last = rows[rank == self.k - 1]
        self.floor[last[:, 0]] = -last[:, 1]
        self.kept = rows[rank < self.k]


def _batches(batches: Iterator[pa.RecordBatch], block: Block) -> Iterator[tuple[list, list[int], list[Counter]]]:
    """Ids, numbers of terms and counts of documents with a term, some at a time."""
    ids, lengths, found, size = [], [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), raw(batch.column(1)), strict=True):
            n, counts = block.counts(text)
            if not n:
                continue
            ids.append(doc_id.as_py()), lengths.append(n), found.append(counts)
            size += len(block.ids) + sum(int(block.first[t + 1] - block.first[t]) for t in counts)
            if size > _AT_ONCE:
                yield ids, lengths, found
                ids, lengths, found, size = [], [], [], 0
    if ids:
        yield ids, lengths, found


@arrow_udf(ArrayType(BinaryType()))
def _terms(text: pa.Array) -> pa.Array:
    return pa.array([terms(t) for t in raw(text)], pa.list_(pa.binary()))


def _item_terms(items: DataFrame, item_id: str, text: str, block: int) -> DataFrame:
    """``item_id, term, times, block``, stored."""
    pairs = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.explode(_terms(F.col(f"`{text}`"))).alias("term"))
    rows = stored(pairs.groupBy("item_id", "term").agg(F.count("*").alias("times")), "item-terms")
    sizes = rows.groupBy(F.col("item_id").alias("of_item")).agg(F.count("*").alias("n"))
    total = running_total(sizes, [F.col("of_item").asc_nulls_first()], "n", "upto")
    blocks = total.select("of_item", F.expr(f"(upto - n) div {block}").alias("block"))
    return stored(rows.join(blocks, F.col("item_id").eqNullSafe(F.col("of_item"))).drop("of_item"), "item-blocks")


def _best_of_block(docs: DataFrame, block: Block, k: int) -> DataFrame:
    """``item_id, doc_id, score, part``: the best documents of each item that every task has seen, stored."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(block)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        documents, total = 0, 0
        frequency = np.zeros(len(block.first) - 1, np.int64)
        for _, lengths, found in _batches(batches, block):
            documents += len(lengths)
            total += sum(lengths)
            for counts in found:
                frequency[list(counts)] += 1
        seen = np.flatnonzero(frequency)
        keys = np.concatenate([seen, [_DOCUMENTS, _TERMS]])
        values = np.concatenate([frequency[seen], [documents, total]])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(values, pa.int64())], ["term", "n"])

    # One row for each term of the block and two more.
    sums = docs.mapInArrow(frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    shared.unpersist()
    block.set_weights({row.term: row.n for row in sums})
    weighted = context.broadcast(block)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = weighted.value
        top = _Best(len(block.ids), k)
        for ids, lengths, found in _batches(batches, block):
            top.add(ids, block.scores(lengths, found))
        top.cut()
        item, score, known, number = top.kept.T
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([block.ids[i] for i in item.tolist()], pa.int64()),
                pa.array(number, pa.int64(), mask=known == 0),
                pa.array(-score, pa.int64()),
            ],
            ["item_id", "doc_id", "score"],
        )

    found = docs.mapInArrow(best, "item_id long, doc_id long, score long")
    result = stored(found.withColumn("part", F.spark_partition_id() % _PARTS), "lexical")
    weighted.unpersist()
    return result


def search(
    items: DataFrame,
    docs: DataFrame,
    k: int = K,
    item_id: str = "item_id",
    item_text: str = "text",
    doc_id: str = "doc_id",
    text: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item its ``k`` documents of the highest positive score.

    Ids are longs. Rows of one ``item_id`` are one item, which has the terms of
    all its texts; NULL is an id like any other. Each row of ``docs`` is a
    document, also if rows are repeated; a NULL id sorts before all others.
    NULL, empty and blank texts have no terms: such a document does not count,
    such an item has no rows. Equal scores go by ascending ``doc_id``. Other
    columns are not read, and empty tables give an empty frame. Texts of any
    length are read whole, in pieces. Jobs run while this is called.
    """
    spark = docs.sparkSession
    rows = _item_terms(items, item_id, item_text, block)
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long, part int")
    for number in [r.block for r in rows.select("block").distinct().orderBy("block").collect()]:
        own = rows.where(F.col("block") == number).select("item_id", "term", "times").collect()
        found = found.union(_best_of_block(texts, Block.of([(r.item_id, bytes(r.term), r.times) for r in own]), k))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    nearer = F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*order))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return (
        found.withColumn("rank", nearer)
        .where(F.col("rank") <= k)
        .withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )
