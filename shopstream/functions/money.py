"""Money as whole cents.

Amounts arrive as doubles with two decimals. Summing them as doubles gives a
result that depends on the order in which partial sums meet, so totals here are
sums of BIGINT cents: exact, order-free and as cheap as a double sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column | str) -> Column:
    """Amount in whole cents as BIGINT; NULL stays NULL, and what is not finite counts as nothing."""
    amount = (F.col(amount) if isinstance(amount, str) else amount).cast("double")
    return F.floor(F.when(F.abs(amount) < float("inf"), amount) * 100 + 0.5)


def from_cents(total: Column) -> Column:
    """Cents back to a currency value."""
    return total / F.lit(100)


def money(amount: Column, scale: int = 2) -> Column:
    """Round half up on the decimal value, so 2.675 becomes 2.68."""
    return F.round(amount.cast("decimal(38,10)"), scale).cast("double")


def rounded_mean(total_cents: Column, n: Column) -> Column:
    """Mean value per row, rounded half up to two decimals; NULL when n is 0."""
    mean = F.try_divide(total_cents.cast("decimal(19,0)"), n.cast("decimal(19,0)"))
    return from_cents(F.round(mean, 0).cast("long"))


def exact_mean(total_cents: Column, n: Column) -> Column:
    """Mean value per row without rounding; NULL when n is 0."""
    return F.try_divide(total_cents, n * 100)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double; NULL when whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def line_value(unit_price: Column, quantity: Column) -> Column:
    """Price times quantity, rounded to cents."""
    return money(unit_price.cast("decimal(18,6)") * quantity.cast("decimal(12,0)"))


def money_text(amount: Column) -> Column:
    """Amount as text with one or two decimals: 100.0, 6.55."""
    return F.regexp_replace(amount.cast("decimal(38,2)").cast("string"), r"(\.\d)0$", "$1")
