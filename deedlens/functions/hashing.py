"""Repeatable randomness.

``rand`` and ``sample`` depend on how rows are spread over partitions, so a
retried or repartitioned stage may draw other numbers. Everything here is a
function of a row key and a seed alone: the same rows come out whatever the
partitioning, and a lost executor recomputes the same result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 2**32
# One draw has 32 bits, so a Poisson tail below 2**-32 can never be reached.
_TAIL = 1.0 / BUCKETS


def bucket(key: Column, seed: int | str, part: int = 0) -> Column:
    """Integer in [0, 2**32) from a key and a seed; ``part`` 0..3 picks independent draws."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1 + 8 * part, 8), 16, 10).cast("bigint")


def wide_bucket(key: Column, seed: int | str) -> Column:
    """Integer in [0, 2**52) from a key and a seed, for ranges of more than 32 bits."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


def uniform(key: Column, seed: int | str, part: int = 0) -> Column:
    """Double in [0, 1)."""
    return bucket(key, seed, part) / F.lit(float(BUCKETS))


def standard_normal(key: Column, seed: int | str) -> Column:
    """N(0, 1) draw by the Box-Muller transform."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform(key, seed, 0)))
    return radius * F.cos(F.lit(2.0 * math.pi) * uniform(key, seed, 1))


def poisson_thresholds(rate: float) -> list[float]:
    """Poisson distribution function at 0, 1, 2, … until the rest is below any possible draw; rates up to 100.

    A larger rate is a sum of smaller ones, see ``poisson_times``.
    """
    if not 0 <= rate <= 100:
        raise ValueError("one draw takes a rate between 0 and 100")
    term = math.exp(-rate)
    total = term
    thresholds = [total]
    k = 0
    while 1.0 - total >= _TAIL and (k <= rate or term >= _TAIL * 1e-3):
        k += 1
        term *= rate / k
        total += term
        thresholds.append(total)
    return thresholds


def poisson_thresholds_of(rate: Column) -> list[Column]:
    """The same for a rate of at most one that is computed in the plan; ``poisson_times`` adds such draws for larger ones."""
    first = F.exp(-rate)
    partial = F.lit(1.0)
    thresholds = [first]
    # Twelve more terms leave a tail below 2**-32.
    for k in range(1, 13):
        partial = partial + F.pow(rate, F.lit(float(k))) / F.lit(float(math.factorial(k)))
        thresholds.append(first * partial)
    return thresholds


def poisson_count(u: Column, thresholds: list[Column]) -> Column:
    """How often a row with uniform draw ``u`` is taken: the thresholds it reaches."""
    return sum(((u >= t).cast("int") for t in thresholds[1:]), (u >= thresholds[0]).cast("int"))


def draw_digits(key: Column, seed: int | str) -> Column:
    """The eight hexadecimal digits of :func:`bucket`, which compare as the number does and cost less to make."""
    return F.substring(F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}"))), 1, 8)


def poisson_count_of_digits(digits: Column, thresholds: list[float]) -> Column:
    """:func:`poisson_count` of a draw given as :func:`draw_digits`; it ends at the first threshold that is not reached."""
    reachable = [f"{border:08x}" for border in (math.ceil(t * BUCKETS) for t in thresholds) if border < BUCKETS]
    count = F.when(digits.isNull(), F.lit(None))
    for n, border in enumerate(reachable):
        count = count.when(digits < border, n)
    return count.otherwise(len(reachable))


def poisson_limits(rate: Column) -> Column:
    """What :func:`poisson_times` needs of a rate, to be worked out once per rate, not per row: ``parts`` and ``limits``.

    Any rate is the sum of ``parts`` equal ones of at most 1.
    """
    parts = F.greatest(F.ceil(rate), F.lit(1)).cast("int")
    return F.struct(parts.alias("parts"), F.array(*poisson_thresholds_of(rate / parts)).alias("limits"))


def poisson_times(u: Column, key: Column, seed: int | str, limits: Column) -> Column:
    """Poisson count at any rate, fixed by key and seed; ``u`` is ``uniform(key, seed)`` and ``limits`` of :func:`poisson_limits`.

    The first part draws as a single count of the same key and seed does; only
    rates above 1 have further ones.
    """
    first = poisson_count(u, [F.element_at(limits["limits"], k) for k in range(1, 14)])

    def count(part: Column) -> Column:
        own = uniform(F.concat(key.cast("string"), F.lit("#"), part.cast("string")), seed)
        return F.size(F.filter(limits["limits"], lambda t: own >= t))

    more = F.aggregate(F.sequence(F.lit(1), limits["parts"] - 1), F.lit(0), lambda total, part: total + count(part))
    return F.when(limits["parts"] > 1, first + more).otherwise(first)


def random_letters(key: Column, seed: int | str, length: int) -> Column:
    """``length`` ASCII letters of both cases, all equally likely, that depend on key and seed only.

    A digest gives four draws of 32 bits, a draw four letters: its remainder by
    52, and so on with what is left. 52 cubed goes 30,545 times into the range of a
    draw, so the last of the four is one of 30,545 numbers by 52, and no letter is
    likelier than another by more than 1 in 587.
    """
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
    letters = []
    for n in range(length):
        block, place = divmod(n, 16)
        draw = bucket(key, f"{seed}|{block}", place // 4)
        letters.append(F.substr(alphabet, (F.floor(draw / F.lit(52 ** (place % 4))) % 52 + 1).cast("int"), F.lit(1)))
    return F.concat(*letters) if letters else F.lit("")
