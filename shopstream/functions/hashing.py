"""Reproducible stand-ins for random draws: each is a pure function of a key.

A lost task that is run again draws the same values, which a random generator
would not guarantee.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 7


def hash_number(key: Column) -> Column:
    """A BIGINT in [0, 16^7) taken from the md5 of the key."""
    digits = F.substring(F.md5(key.cast("string")), 1, _HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("long")


def hash_fraction(key: Column) -> Column:
    """A double in [0, 1); exact, since the divisor is a power of two."""
    return hash_number(key) / F.lit(16**_HEX_DIGITS)


def hash_uniform(key: Column, lo: float, hi: float) -> Column:
    """A double in [lo, hi)."""
    return F.lit(float(lo)) + hash_fraction(key) * F.lit(float(hi) - float(lo))


def hash_integer(key: Column, lo: int, hi: int) -> Column:
    """A BIGINT in [lo, hi)."""
    return F.lit(lo) + F.pmod(hash_number(key), F.lit(hi - lo).cast("long"))


def weighted_label(key: Column, labels: Sequence[str], weights: Sequence[float]) -> Column:
    """One of the labels, each with its share of the keys."""
    if len(labels) != len(weights):
        raise ValueError("labels and weights differ in length")
    draw = hash_fraction(key)
    upper, choice = 0.0, F
    for label, weight in list(zip(labels, weights))[:-1]:
        upper = round(upper + weight, 12)
        choice = choice.when(draw < upper, F.lit(label))
    return choice.otherwise(F.lit(labels[-1])) if choice is not F else F.lit(labels[-1])
