"""Quality classifier from trusted positives and unlabelled text.

Only texts known to be good are taken as labelled; the others are a mixture of
good and bad in an unknown share. The share of good ones, the class prior, is
estimated first: where a plain classifier of positives against unlabelled text
is surest, the unlabelled share above a score is, up to noise, the prior times
the positive share above it. A linear model then minimises the non-negative
unbiased risk

    prior * E_p[loss(f)] + max(0, E_u[loss(-f)] - prior * E_p[loss(-f)])

with logistic loss, so its output is a probability. A batch in which the second
part falls below zero, which no true risk does, is stepped back from instead.

The model is fitted on a bounded sample: at most ``POSITIVES`` good documents and
``UNLABELLED`` documents whatever their labels, by smallest hashes of the id.
Features are computed where the texts are, and every whole text is scored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType, DoubleType

from deedlens.llm.arrow import raw

#: Documents that the model is fitted on, at most.
POSITIVES, UNLABELLED = 4_096, 8_192
#: Buckets that character trigrams are hashed into.
BUCKETS = 512
#: Bytes of a text that are worked on at once, a longer word excepted.
PIECE = 1 << 20
SEED = 42
EPOCHS, BATCHES, RATE, DECAY = 200, 16, 0.02, 3e-3
#: Random halves that the prior is estimated over, and the training on them.
PRIOR_SPLITS, PRIOR_EPOCHS, PRIOR_DECAY = 3, 100, 1e-1
#: The smallest share of positives that the estimate of the prior looks at.
LEAST_SHARE = 0.05

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_GROUPS = [range(65, 91), range(97, 123), range(48, 58), b" \t", b"\n", range(128, 256)]
_PUNCTUATION = [c for c in range(33, 127) if not chr(c).isalnum()]
_KINDS = [np.isin(np.arange(256), list(kind)) for kind in [*_GROUPS, *([c] for c in _PUNCTUATION)]]
#: Kinds of bytes, each mark being one, then: words, mean length, distinct, most frequent, repeated at once, repeated lines.
DENSE = len(_KINDS) + 6
SIZE = DENSE + BUCKETS
_KIND_OF = np.array(_KINDS, np.int64)


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text cut behind white space."""
    start = 0
    while start < len(text):
        end = min(start + PIECE, len(text))
        while end < len(text) and text[end : end + 1].strip():
            end += 1
        yield text[start:end]
        start = end


def features(text: bytes) -> np.ndarray:
    """``SIZE`` numbers that describe a text in UTF-8; zeros for one without a word."""
    out = np.zeros(SIZE, np.float32)
    kinds, trigrams = np.zeros(256, np.int64), np.zeros(BUCKETS, np.int64)
    words, at_once, last = Counter(), 0, None
    for piece in _pieces(text):
        kinds += np.bincount(np.frombuffer(piece, np.uint8), minlength=256)
        codes = np.frombuffer(piece.translate(_LOWER), np.uint8).astype(np.uint32)
        mixed = (codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:]) * np.uint32(0x9E3779B1)
        trigrams += np.bincount(mixed >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS)
        found = piece.split()
        if found:
            words.update(found)
            at_once += sum(map(eq, found, found[1:])) + (found[0] == last)
            last = found[-1]
    n = words.total()
    if not n:
        return out
    lines = [line for line in text.split(b"\n") if line.strip()]
    out[: len(_KINDS)] = np.sqrt(_KIND_OF @ kinds / len(text))
    out[len(_KINDS) : DENSE] = [
        np.log1p(n),
        min(sum(len(w) * c for w, c in words.items()) / n, 100) / 10,
        len(words) / n,
        max(words.values()) / n,
        np.sqrt(at_once / n),
        np.sqrt(1 - len(set(lines)) / len(lines)),
    ]
    out[DENSE:] = np.sqrt(trigrams / max(trigrams.sum(), 1))
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class _Adam:
    """Steps of a weight vector along gradients."""

    def __init__(self, size: int):
        self.mean, self.square, self.t = np.zeros(size), np.zeros(size), 0

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.mean = 0.9 * self.mean + 0.1 * gradient
        self.square = 0.999 * self.square + 0.001 * gradient**2
        return RATE * (self.mean / (1 - 0.9**self.t)) / (np.sqrt(self.square / (1 - 0.999**self.t)) + 1e-8)


def _batches(positive: np.ndarray, unlabelled: np.ndarray, seed: int, epochs: int = EPOCHS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    rng = np.random.default_rng(seed)
    n = min(BATCHES, len(positive), len(unlabelled))
    for _ in range(epochs):
        p, u = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
        for a, b in zip(np.array_split(p, n), np.array_split(u, n), strict=True):
            yield positive[a], unlabelled[b]


def nonnegative_risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = SEED) -> np.ndarray:
    """Weights that minimise the risk over rows of features, a constant last one included.

    Steps forth and back end nowhere, so the weights of the last half of the steps are averaged.
    """
    weights, adam, passed = np.zeros(positive.shape[1]), _Adam(positive.shape[1]), []
    for p, u in _batches(positive, unlabelled, seed):
        zp, zu = p @ weights, u @ weights
        # Logistic loss: log(1 + exp(-z)) of a positive, log(1 + exp(z)) of a negative.
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        slope = u.T @ _sigmoid(zu) / len(u) - prior * (p.T @ _sigmoid(zp)) / len(p)
        if negative >= 0:
            gradient = slope - prior * (p.T @ _sigmoid(-zp)) / len(p)
        else:
            gradient = -slope
        weights = weights - adam.step(gradient + DECAY * weights)
        passed.append(weights)
    return np.mean(passed[len(passed) // 2 :], axis=0)


def _against(positive: np.ndarray, unlabelled: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Weights of a plain classifier of positives against unlabelled rows."""
    weights, adam = np.zeros(positive.shape[1]), _Adam(positive.shape[1])
    for p, u in _batches(positive, unlabelled, seed, PRIOR_EPOCHS):
        gradient = u.T @ _sigmoid(u @ weights) / len(u) - p.T @ _sigmoid(-(p @ weights)) / len(p)
        weights = weights - adam.step(gradient + PRIOR_DECAY * weights)
    return weights


def _share(p: np.ndarray, u: np.ndarray) -> float:
    """The prior from scores of positives and of unlabelled rows that the classifier has not seen.

    Of all scores, that with the smallest upper bound of (unlabelled share
    above) / (positive share above) gives the estimate.
    """
    p, u = np.sort(p), np.sort(u)
    above_p = 1 - np.arange(len(p)) / len(p)
    above_u = 1 - np.searchsorted(u, p) / len(u)
    enough = above_p >= LEAST_SHARE
    # What chance may add to both shares.
    noise = np.sqrt(np.log(20) / (2 * len(u))) + np.sqrt(np.log(20) / (2 * len(p)))
    best = int(np.argmin((above_u[enough] + noise) / above_p[enough]))
    return float(above_u[enough][best] / above_p[enough][best])


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives in unlabelled rows: the mean of estimates over random halves.

    One half of both trains a classifier of the one against the other, the other
    half is scored by it, and the reverse.
    """
    if min(len(positive), len(unlabelled)) < 2:
        return 0.5
    rng = np.random.default_rng(SEED)
    found = []
    for _ in range(PRIOR_SPLITS):
        p, u = rng.permutation(positive), rng.permutation(unlabelled)
        for own, other in ((0, 1), (1, 0)):
            weights = _against(p[own::2], u[own::2])
            found.append(_share(p[other::2] @ weights, u[other::2] @ weights))
    return float(np.clip(np.mean(found), 0.05, 0.95))


@dataclass
class Model:
    """A linear model over scaled features. ``score`` is the probability of the label 1."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    @classmethod
    def fit(cls, positive: np.ndarray, unlabelled: np.ndarray) -> Model:
        """From features of trusted positives and of unlabelled texts; without either of them nothing is learnt."""
        if not len(positive) or not len(unlabelled):
            return cls(np.zeros(SIZE), np.ones(SIZE), np.zeros(SIZE + 1), 0.5)
        centre, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3
        model = cls(centre, scale, np.zeros(SIZE + 1), 0.5)
        p, u = model._scaled(positive), model._scaled(unlabelled)
        model.prior = class_prior(p, u)
        model.weights = nonnegative_risk(p, u, model.prior)
        return model

    def _scaled(self, rows: np.ndarray) -> np.ndarray:
        scaled = np.clip((rows - self.centre) / self.scale, -8, 8)
        # The many trigrams weigh together about as much as the few other features.
        scaled[:, DENSE:] /= np.sqrt(BUCKETS / DENSE)
        return np.column_stack([scaled, np.ones(len(rows))])

    def score(self, rows: np.ndarray) -> np.ndarray:
        # Rounded, so that the last digits do not depend on how rows are batched.
        return np.round(_sigmoid(self._scaled(rows) @ self.weights), 9)


@arrow_udf(BinaryType())
def _features(text: pa.Array) -> pa.Array:
    return pa.array([features(t).tobytes() for t in raw(text)], pa.binary())


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model from documents and the labels of some of them; both should be those that may be learnt from.

    ``labels`` has ``doc_id`` and ``quality``; only 1 is used, and not for an id
    that is labelled 0 too. Rows with a NULL id or label teach nothing. Of an id
    that stands on several rows one text counts.
    """
    order = [F.xxhash64(F.lit(SEED), "_id"), F.col("_id")]
    good = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.min("quality").alias("quality"))
        .where("quality = 1")
    )
    rows = docs.select(F.col(f"`{doc_id}`").alias("_doc"), F.col(f"`{text}`").alias("_text")).where("_doc IS NOT NULL")
    present = rows.select(F.col("_doc").alias("_id")).distinct()
    trusted = good.join(present, "_id", "left_semi").orderBy(*order).limit(POSITIVES).select("_id", F.lit(1).alias("_good"))
    others = present.orderBy(*order).limit(UNLABELLED).select("_id", F.lit(0).alias("_good"))
    # The list is bounded by the two sizes above.
    sample = (
        rows.join(F.broadcast(trusted.union(others)), F.col("_doc") == F.col("_id"))
        .select("_id", "_good", _features("_text").alias("f"))
        .groupBy("_id", "_good")
        .agg(F.max("f").alias("f"))
        .orderBy("_good", "_id")
        .collect()
    )

    def table(kind: int) -> np.ndarray:
        found = [np.frombuffer(r.f, np.float32) for r in sample if r["_good"] == kind]
        return np.array(found, np.float64).reshape(-1, SIZE)

    return Model.fit(table(1), table(0))


def score(text: Column, model: Model, spark: SparkSession) -> Column:
    """Probability that a text is good, a double from 0 to 1.

    NULL, empty and blank texts are scored like any other, by features that are
    all zero. Texts of any length are read whole.
    """
    shared = spark.sparkContext.broadcast(model)

    @arrow_udf(DoubleType())
    def scored(column: pa.Array) -> pa.Array:
        rows = np.array([features(t) for t in raw(column)], np.float64).reshape(-1, SIZE)
        return pa.array(shared.value.score(rows))

    return scored(text)
