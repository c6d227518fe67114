"""Scalar helpers used by reports and row generators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deedlens.functions.hashing import random_letters, wide_bucket


def timestamp_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a timestamp."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def slice_text(text: Column, start: int, end: int) -> Column:
    """Characters ``start`` to ``end``, counted from one, both included; NULL stays NULL."""
    if start < 1:
        raise ValueError("start counts from 1")
    return F.substring(text, start, max(0, end - start + 1))


def same_text(left: Column, right: Column) -> Column:
    """Equality that ignores case."""
    return F.lower(left) == F.lower(right)


def equals_ignore_case(text: Column, value: str) -> Column:
    return F.upper(text) == F.lit(value.upper())


def filled_text(text: Column) -> Column:
    """True for text that is neither NULL nor the word 'NULL'."""
    return text.isNotNull() & (text != F.lit("NULL"))


def finite(number: Column) -> Column:
    """Turn NaN and both infinities into NULL."""
    value = number.cast("double")
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(~bad, value)


def ratio(top: Column, bottom: Column) -> Column:
    """Division that yields NULL instead of failing on a zero divisor."""
    return top / F.nullif(bottom, F.lit(0))


def percent(part: Column, whole: Column, digits: int) -> Column:
    return F.round(ratio(part, whole) * 100, digits)


def in_units(total: Column, unit: int, digits: int = 1) -> Column:
    """A sum in thousands, millions, billions, …, rounded."""
    return F.round(total / F.lit(float(unit)), digits)


def floor_mod(number: Column, n: int | Column) -> Column:
    """Modulo that is never negative for a positive ``n``."""
    return F.pmod(number, F.lit(n) if isinstance(n, int) else n)


def pad_left(value: Column, length: int, char: str) -> Column:
    """Value as text, padded on the left up to ``length``; a longer value is never cut."""
    text = value.cast("string")
    return F.lpad(text, F.greatest(F.lit(length), F.char_length(text)), F.lit(char))


def pad_by_value(value: Column, length: int, seed: int = 0, offset: int = 0) -> Column:
    """Put ``length - value - offset`` random letters before the value.

    The number of letters follows the *value*, not its number of digits, so
    small ids give long strings and ids past ``length`` get no padding.
    """
    letters = random_letters(value, seed, length)
    count = F.greatest(F.lit(length - offset) - value, F.lit(0)).cast("int")
    return F.concat(F.substring(letters, F.lit(1), count), value.cast("string"))


def pad_with_sequence(value: Column, n: int) -> Column:
    """The numbers 1 to n, written together, before the value."""
    return F.concat(F.lit("".join(str(i) for i in range(1, n + 1))), value.cast("string"))


def repeat_char(char: str, n: int) -> Column:
    return F.repeat(F.lit(char), n)


def clustered(x: Column, n: Column) -> Column:
    """floor(x - 1) / n: neighbouring ids share a small value range."""
    return F.floor(x - 1).cast("double") / n


def clustered_fraction(x: Column, n: Column) -> Column:
    """(x - 1) / n without the floor, for fractional x."""
    return (x - 1).cast("double") / n


def scattered(x: Column, n: Column) -> Column:
    """|(x - 1) mod n| as a double: neighbouring ids get different values."""
    return F.abs(floor_mod(x - 1, n)).cast("double")


def randomised(x: Column, n: Column, seed: int) -> Column:
    """Whole number in [0, n) as a double, fixed by x and the seed."""
    return floor_mod(wide_bucket(x, seed), n).cast("double")


def scale_array(values: Column, divisor: float = 255.0) -> Column:
    """Divide every element of an array."""
    return F.transform(values, lambda v: v.cast("double") / F.lit(divisor))
