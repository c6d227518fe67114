"""Synthetic rows drawn from a two-dimensional latent space.

The latent model is probabilistic principal components, whose maximum
likelihood fit is also the optimum of a linear variational autoencoder
(Tipping and Bishop 1999; Lucas et al. 2019). Missing values are not filled in:
the fit maximises the likelihood of what was observed, by expectation and
maximisation. Given the latent rows' model, all that a row adds to the fit is
linear and quadratic in its values, so counts, sums and products per pattern of
observed columns are enough. One distributed pass makes them, and rounds run
over patterns, not rows. Drawing and decoding are column arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedlens.functions.hashing import standard_normal
from deedlens.functions.scalars import finite
from deedlens.functions.text import quoted
from deedlens.operators.features import scaling
from deedlens.sources.scratch import stored

#: Patterns of observed columns that the driver works on itself; more are worked on in tasks, round by round.
PATTERNS = 4096
ROUNDS, TOLERANCE = 5000, 1e-13


@dataclass(frozen=True)
class LatentModel:
    """Decoder: per column its mean, its deviation and one weight per latent dimension."""

    columns: tuple[str, ...]
    means: np.ndarray
    deviations: np.ndarray
    weights: np.ndarray
    #: Variance, in standardised units, that the latent dimensions leave to each column.
    noise: float = 0.0


def one_hot_columns(df: DataFrame, column: str, levels: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """A 0/1 column per level; the levels are given, so the schema does not depend on the data."""
    names = [f"{column}_{i}" for i in range(len(levels))]
    hot = {
        name: F.coalesce(F.col(column) == F.lit(level), F.lit(False)).cast("double")
        for name, level in zip(names, levels)
    }
    return df.withColumns(hot), names


def _pattern_statistics(df: DataFrame, names: Sequence[str], means: np.ndarray, deviations: np.ndarray) -> DataFrame:
    """``seen`` (0 or 1 per column), ``n`` and ``sums``: one row per pattern of observed columns.

    ``sums`` are those of the standardised values and then of their products,
    row by row of the lower triangle; a missing value counts as 0.
    """
    value = {
        i: (finite(F.col(quoted(c))) - F.lit(float(m))) / F.lit(float(d))
        for i, (c, m, d) in enumerate(zip(names, means, deviations, strict=True))
    }
    rows = df.select(*[v.alias(f"x{i}") for i, v in value.items()])
    zero = [F.coalesce(F.col(f"x{i}"), F.lit(0.0)) for i in value]
    sums = [F.sum(z) for z in zero] + [F.sum(zero[i] * zero[j]) for i in value for j in range(i + 1)]
    seen = F.concat(*[F.col(f"x{i}").isNotNull().cast("int").cast("string") for i in value])
    return rows.groupBy(seen.alias("seen")).agg(F.count("*").alias("n"), F.array(*sums).alias("sums"))


@dataclass
class _Fit:
    """Parameters in standardised units: per column its weights and its mean, and the noise variance."""

    weights: np.ndarray
    mean: np.ndarray
    noise: float

    def expected(self, rows: Iterator[tuple[str, int, Sequence[float]]]) -> np.ndarray:
        """What maximisation needs, summed over patterns.

        Per column: products of the latent row (with a constant last one) with
        itself, with the column's value, the value's square, and the count.
        """
        d, k = self.weights.shape
        total = np.zeros((d, (k + 1) ** 2 + k + 1 + 2))
        for seen, n, sums in rows:
            on = np.flatnonzero(np.frombuffer(seen.encode(), np.uint8) == ord("1"))
            if not len(on):
                continue
            first = np.asarray(sums[:d], float)
            second = np.zeros((d, d))
            second[np.tril_indices(d)] = sums[d:]
            second = second + np.tril(second, -1).T
            w, mean = self.weights[on], self.mean[on]
            x, xx = first[on], second[np.ix_(on, on)]
            inverse = np.linalg.inv(w.T @ w + self.noise * np.eye(k))
            to_latent = inverse @ w.T
            # Sums of z, of z z' and of x z' over the rows of the pattern.
            z = to_latent @ (x - n * mean)
            centred = xx - np.outer(mean, x) - np.outer(x, mean) + n * np.outer(mean, mean)
            zz = n * self.noise * inverse + to_latent @ centred @ to_latent.T
            xz = (xx - np.outer(x, mean)) @ to_latent.T
            own = np.block([[zz, z[:, None]], [z[None, :], np.array([[float(n)]])]])
            total[on, : (k + 1) ** 2] += own.reshape(-1)
            total[on, (k + 1) ** 2 : -2] += np.column_stack([xz, x])
            total[on, -2] += np.diag(xx)
            total[on, -1] += n
        return total

    @classmethod
    def maximised(cls, total: np.ndarray, k: int) -> _Fit:
        left = total[:, : (k + 1) ** 2].reshape(-1, k + 1, k + 1)
        right = total[:, (k + 1) ** 2 : -2]
        solved = np.linalg.solve(left, right[..., None])[..., 0]
        rest = total[:, -2] - (solved * right).sum(axis=1)
        return cls(solved[:, :k], solved[:, k], max(float(rest.sum() / total[:, -1].sum()), 1e-12))

    def far_from(self, other: _Fit) -> float:
        mine, others = self.weights @ self.weights.T, other.weights @ other.weights.T
        return max(np.abs(mine - others).max(), np.abs(self.mean - other.mean).max(), abs(self.noise - other.noise))


def _start(patterns: list, d: int, k: int) -> _Fit:
    """Principal components of the products of what was observed, a missing value counting as the mean."""
    second = np.zeros((d, d))
    for _, _, sums in patterns:
        own = np.zeros((d, d))
        own[np.tril_indices(d)] = sums[d:]
        second += own + np.tril(own, -1).T
    values, vectors = np.linalg.eigh(second / max(sum(n for _, n, _ in patterns), 1))
    values, vectors = values[::-1], vectors[:, ::-1]
    noise = max(float(values[k:].mean()), 1e-3)
    return _Fit(vectors[:, :k] * np.sqrt(np.clip(values[:k] - noise, 1e-3, None)), np.zeros(d), noise)


def _rounds(statistics: DataFrame, d: int, k: int) -> _Fit:
    """Expectation and maximisation until nothing moves any more."""
    known = [(r.seen, r.n, r.sums) for r in statistics.limit(PATTERNS + 1).collect()]
    local = len(known) <= PATTERNS
    fit = _start(known, d, k)
    for _ in range(ROUNDS):
        total = fit.expected(known) if local else _expected_in_tasks(statistics, fit)
        after = _Fit.maximised(total, k)
        moved, fit = fit.far_from(after), after
        if moved < TOLERANCE:
            break
    return fit


def _expected_in_tasks(statistics: DataFrame, fit: _Fit) -> np.ndarray:
    """The same sums from tasks; each sends one row, and the driver receives one."""

    def expected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((r["seen"], r["n"], r["sums"]) for batch in batches for r in batch.to_pylist())
        values = fit.expected(rows).reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["at", "value"])

    summed = statistics.mapInArrow(expected, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    k = fit.weights.shape[1]
    return np.array([r.value for r in summed.orderBy("at").collect()]).reshape(-1, (k + 1) ** 2 + k + 3)


def fit_latent(df: DataFrame, columns: Sequence[str], dimensions: int = 2) -> LatentModel:
    """Standardise and fit. ``columns`` are numeric; NULL, NaN and infinity are missing values.

    The driver receives two figures per column and, for up to ``PATTERNS``
    patterns of observed columns, their counts, sums and products. The axes of
    the latent space are put in order of their spread, and each points to where
    its largest weight is positive, so equal tables give equal models. A column
    of one value keeps it, a column without values is drawn as NULL.
    """
    names = tuple(columns)
    values = df.select(*[finite(F.col(quoted(c)).cast("double")).alias(c) for c in names])
    stats = scaling(values, names, sample=False).first()
    means = np.array([np.nan if stats[2 * i] is None else stats[2 * i] for i in range(len(names))])
    deviations = np.array([stats[2 * i + 1] or 0.0 for i in range(len(names))])
    active = np.flatnonzero(deviations > 0)
    weights, noise = np.zeros((len(names), dimensions)), 0.0
    if len(active) == 1:
        noise = 1.0
    elif len(active):
        k = min(dimensions, len(active) - 1)
        chosen = [names[i] for i in active]
        statistics = stored(_pattern_statistics(values, chosen, means[active], deviations[active]), "patterns")
        fit = _rounds(statistics, len(active), k)
        axes, lengths, _ = np.linalg.svd(fit.weights, full_matrices=False)
        own = axes * lengths
        own *= np.sign(own[np.abs(own).argmax(axis=0), np.arange(k)])
        weights[active, :k], noise = own, fit.noise
        means[active] += fit.mean * deviations[active]
    return LatentModel(names, means, deviations, weights, noise)


def draw_latent(df: DataFrame, key: str, model: LatentModel, seed: int = 42) -> DataFrame:
    """One synthetic row per row of ``df``: draw z ~ N(0, 1), decode, add the noise, undo the scaling.

    Draws depend on key and seed only; a row without a key gets NULLs.
    """
    dimensions = model.weights.shape[1]
    drawn = df.select(
        F.col(key),
        *[standard_normal(F.col(key), f"{seed}.{d}").alias(f"_z{d}") for d in range(dimensions)],
    )
    decoded = []
    for i, name in enumerate(model.columns):
        value = F.lit(None).cast("double") if np.isnan(model.means[i]) else F.lit(float(model.means[i]))
        if model.noise > 0:
            spread = float(np.sqrt(model.noise) * model.deviations[i])
            value = value + standard_normal(F.col(key), f"{seed}.noise.{i}") * F.lit(spread)
        for d in range(dimensions):
            value = value + F.col(f"_z{d}") * F.lit(float(model.weights[i, d] * model.deviations[i]))
        decoded.append(value.alias(name))
    return drawn.select(key, *decoded)
