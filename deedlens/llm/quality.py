"""Quality rules judged by an isolation forest.

Each text is reduced to rule statistics. An isolation forest over them splits
random features at random values, within what good and bad labelled documents
show; a path ends where no more than one good document is left. Documents that
few splits separate from the good ones are anomalous, also where bad ones lie
close together. The score is ``2 ** -(mean path length / expected length)``, and
the border between kept and rejected is calibrated on the labelled rows.

Each tree draws its own rows from all labelled documents, as the method has it,
and the border is calibrated on the scores of all of them. Statistics and
verdicts cover every document and its whole text.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from deedlens.llm.arrow import raw
from deedlens.operators.ranking import global_position, running_total
from deedlens.sources.scratch import stored

#: Up to so many labelled documents, all reach the driver; of more, those that a tree draws.
SAMPLE = 8_192
TREES = 100
#: Documents that a tree splits. More than the usual 256: bad documents are rare, and so are good ones next to them.
TREE_SAMPLE = 4_096
SEED = 42
#: Rules of the base: fewest words, and highest share of words in repeated windows, in percent.
LEAST_WORDS = 10
MOST_REPEATED = 20
WINDOW = 5

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_CONTINUATION = bytes(range(0x80, 0xC0))

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_MORE = ["n_upper", "n_digits"]


def _count(text: bytes, of: bytes) -> int:
    return len(text) - len(text.translate(None, of))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of words found twice or more in the text, first finds included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    base, span, wide = len(numbers), 1, ids
    # Number the windows: append word after word, and number anew before the numbers outgrow 63 bits.
    while span < window:
        if int(wide.max()) + 1 > (1 << 62) // base:
            wide = np.unique(wide, return_inverse=True)[1]
        wide = wide[: len(words) - span] * base + ids[span:]
        span += 1
    _, inverse, counts = np.unique(wide, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def counts_of(text: bytes) -> tuple[int, ...]:
    """``COUNTS`` and ``_MORE`` of a text in UTF-8."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    characters = len(text) - _count(text, _CONTINUATION)
    return (
        len(words),
        characters - _count(text, _SPACE),
        _count(text, _SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        _count(text, _UPPER),
        _count(text, _DIGITS),
    )


def _counts(column: pa.Array) -> np.ndarray:
    return np.array([counts_of(value) for value in raw(column)], np.int64).reshape(-1, len(COUNTS) + len(_MORE))


def statistics(text: Column) -> Column:
    """A struct of the counts of a text, all longs; NULL counts as empty."""
    names = [*COUNTS, *_MORE]

    @arrow_udf(StructType([StructField(name, LongType()) for name in names]))
    def counted(column: pa.Array) -> pa.Array:
        table = _counts(column)
        return pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(len(names))], names)

    return counted(text)


def features(counts: np.ndarray) -> np.ndarray:
    """Rule statistics of rows of ``COUNTS`` and ``_MORE``: shares and means, which do not depend on the length."""
    words, chars, symbols, _, _, upper, digits = counts.T.astype(float)
    words, chars = np.maximum(words, 1), np.maximum(chars, 1)
    return np.column_stack([np.minimum(symbols / words, 1), upper / chars, digits / chars, chars / words])


def _expected(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` values."""
    n = np.asarray(n, float)
    many = np.maximum(n, 3)
    return np.where(
        n > 2, 2 * (np.log(many - 1) + np.euler_gamma) - 2 * (many - 1) / many, np.where(n == 2, 1.0, 0.0)
    )


@dataclass
class IsolationForest:
    """Trees as arrays: feature (-1 at a leaf), border, index of the lower child, and path length at a leaf."""

    feature: np.ndarray
    border: np.ndarray
    child: np.ndarray
    length: np.ndarray
    roots: np.ndarray
    normal: float
    threshold: float = 1.0

    @classmethod
    def fit(
        cls,
        rows: np.ndarray,
        good: np.ndarray,
        trees: int = TREES,
        sample: int = TREE_SAMPLE,
        seed: int = SEED,
        draws: list[np.ndarray] | None = None,
    ) -> IsolationForest:
        """Grow the trees; ``draws`` are the rows of each, where they were drawn beforehand from more than these."""
        rng = np.random.default_rng(seed)
        size = min(sample, len(rows)) if draws is None else len(draws[0])
        deepest = int(np.ceil(np.log2(max(size, 2))))
        feature, border, child, length, roots, good_drawn = [], [], [], [], [], 0

        def leaf() -> int:
            feature.append(-1), border.append(0.0), child.append(0), length.append(0.0)
            return len(feature) - 1

        for tree in range(trees):
            drawn = rng.choice(len(rows), size, replace=False) if draws is None else draws[tree]
            good_drawn += int(good[drawn].sum())
            roots.append(leaf())
            todo = [(roots[-1], drawn, 0)]
            while todo:
                node, ids, depth = todo.pop()
                inside, n = rows[ids], int(good[ids].sum())
                low, high = (inside.min(axis=0), inside.max(axis=0)) if n > 1 else (0, 0)
                open_to = np.flatnonzero(high > low)
                if depth >= deepest or not len(open_to):
                    length[node] = depth + float(_expected(n))
                    continue
                f = int(rng.choice(open_to))
                feature[node], border[node] = f, float(rng.uniform(low[f], high[f]))
                below = inside[:, f] < border[node]
                child[node] = leaf()
                leaf()
                todo += [(child[node], ids[below], depth + 1), (child[node] + 1, ids[~below], depth + 1)]
        arrays = (np.array(x) for x in (feature, border, child, length, roots))
        return cls(*arrays, max(1.0, float(_expected(good_drawn / trees))))

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Near 1 for anomalies, below one half for rows amid the others."""
        total = np.zeros(len(rows))
        everyone = np.arange(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            while (inner := self.feature[at] >= 0).any():
                who = everyone[inner]
                node = at[who]
                at[who] = self.child[node] + (rows[who, self.feature[node]] >= self.border[node])
            total += self.length[at]
        return 2.0 ** (-total / len(self.roots) / self.normal)

    def calibrate(self, rows: np.ndarray, good: np.ndarray) -> None:
        """Set the border where good and bad labelled rows are told apart best.

        Best is the largest balanced accuracy; among equals, the middle of the
        highest stretch. Without labels of both kinds nothing is rejected.
        """
        if good.all() or not good.any():
            self.threshold = 1.0
            return
        score = self.score(rows)
        borders, inverse = np.unique(score, return_inverse=True)
        kept = np.cumsum(np.bincount(inverse, good, len(borders))) / good.sum()
        bad_kept = np.cumsum(np.bincount(inverse, ~good, len(borders))) / (~good).sum()
        best = np.flatnonzero(np.isclose(kept - bad_kept, (kept - bad_kept).max()))[-1]
        after = borders[best + 1] if best + 1 < len(borders) else 1.0
        self.threshold = float(borders[best] + after) / 2


def fit(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> IsolationForest:
    """A calibrated forest from labelled documents.

    ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 bad). Rows with a NULL
    in either are left out; an id labelled twice counts as bad if any label is.
    Each tree draws ``TREE_SAMPLE`` rows from all labelled documents, so what
    reaches the driver has a bound; the border is set by all of them. Base
    failures are not part of the fit, for the method does not judge them.
    Without labelled documents the forest keeps everything.
    """
    chosen = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .select(F.col("doc_id").alias("_id"), "quality")
    )
    # Counts come first: the join then moves no texts.
    rows = stored(
        df.select(F.col(f"`{doc_id}`").alias("_doc"), statistics(F.col(f"`{text}`")).alias("s"))
        .join(chosen, F.col("_doc") == F.col("_id"))
        .groupBy("_doc")
        # An id that stands on several rows counts once. A filter before this would have the texts counted twice.
        .agg(F.max(F.when(~base_failed("s"), F.struct("s", "quality"))).alias("r"))
        .where("r IS NOT NULL")
        .select("_doc", "r.quality", "r.s"),
        "labelled",
    )
    n = rows.count()
    if not n:
        return IsolationForest.fit(features(np.zeros((1, len(COUNTS) + len(_MORE)))), np.array([True]))
    draws = None
    if n <= SAMPLE:
        found = rows.orderBy("_doc").select("quality", "s.*").toPandas()
    else:
        rng = np.random.default_rng(SEED)
        drawn = [rng.choice(n, min(TREE_SAMPLE, n), replace=False) for _ in range(TREES)]
        wanted = np.unique(np.concatenate(drawn))
        places = df.sparkSession.createDataFrame(pa.table({"_at": wanted}))
        numbered = global_position(rows, [F.asc("_doc")], "_at")
        found = numbered.join(F.broadcast(places), "_at").select("_at", "quality", "s.*").toPandas().sort_values("_at")
        draws = [np.searchsorted(wanted, d) for d in drawn]
    good = found["quality"].to_numpy() == 1
    forest = IsolationForest.fit(features(found[[*COUNTS, *_MORE]].to_numpy()), good, draws=draws)
    return replace(forest, threshold=_border(rows, forest))


def _border(rows: DataFrame, forest: IsolationForest) -> float:
    """What :meth:`IsolationForest.calibrate` finds, from all rows of ``quality`` and counts ``s``."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    @arrow_udf(DoubleType())
    def score(column: pa.Array) -> pa.Array:
        counts = np.column_stack([field.to_numpy(zero_copy_only=False) for field in column.flatten()])
        return pa.array(shared.value.score(features(counts)))

    scored = stored(rows.select(score("s").alias("score"), (F.col("quality") == 1).alias("good")), "scores")
    found = scored.groupBy("score").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    total = found.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    if not total.good or not total.bad:
        return 1.0
    by_score = [F.asc("score")]
    summed = running_total(running_total(found, by_score, "good", "kept"), by_score, "bad", "bad_kept")
    gains = stored(summed.select("score", (F.col("kept") / total.good - F.col("bad_kept") / total.bad).alias("gain")), "gains")
    most = gains.agg(F.max("gain")).first()[0]
    # As np.isclose has it.
    best = gains.where(F.abs(F.col("gain") - most) <= 1e-8 + 1e-5 * abs(most)).agg(F.max("score")).first()[0]
    after = gains.where(F.col("score") > best).agg(F.min("score")).first()[0]
    return (best + (1.0 if after is None else after)) / 2


def base_failed(s: str) -> Column:
    """The base rules on a struct of counts."""
    n, repeated = F.col(f"{s}.n_words"), F.col(f"{s}.n_repeat_words")
    return (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)


def judge(df: DataFrame, forest: IsolationForest, text: str = "text", out: str = "quality") -> DataFrame:
    """Add a struct ``out``: the counts, ``base_failed``, ``score`` and ``kept``.

    A document is kept if it passes the base rules and its score does not
    exceed the forest's border. NULL, empty and blank texts have no words and
    fail the base. Every row and column stays, a column named ``out`` excepted.
    """
    shared = df.sparkSession.sparkContext.broadcast(forest)
    names = [*COUNTS, *_MORE]
    kind = StructType([*(StructField(name, LongType()) for name in names), StructField("score", DoubleType())])

    # Counts and score in one function: a second one would need workers of its own.
    @arrow_udf(kind)
    def judged(column: pa.Array) -> pa.Array:
        counts = _counts(column)
        columns = [pa.array(counts[:, i]) for i in range(len(names))]
        return pa.StructArray.from_arrays([*columns, pa.array(shared.value.score(features(counts)))], [*names, "score"])

    s = F.col(out)
    return (
        df.withColumn(out, judged(F.col(f"`{text}`")))
        .withColumn(out, s.withField("base_failed", base_failed(out)))
        .withColumn(out, s.withField("kept", ~F.col(f"{out}.base_failed") & (F.col(f"{out}.score") <= forest.threshold)))
    )
