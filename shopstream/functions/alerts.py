"""Expressions behind payment alerts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopstream.functions.hashing import hash_number
from shopstream.functions.money import money_text

# Fixed values of the score: bounds, base, amount per point, and jitter in hundredths.
SCORE_FLOOR = "75.00"
SCORE_CAP = "99.90"
SCORE_BASE = "78.0"
AMOUNT_PER_POINT = 80
JITTER_LOW, JITTER_HIGH = 210, 1280


def risk_score(amount: Column, event_id: Column) -> Column:
    """Score between 75.00 and 99.90 that grows with the amount.

    The jitter of 2.10 to 12.80 comes from the event id, so the same event always
    scores the same. A NULL or NaN amount scores the floor. Amounts are cut at a
    million first: the cap is reached long before that, and it keeps the decimal exact.
    """
    known = F.nanvl(amount.cast("double"), F.lit(None).cast("double"))
    bounded = F.when(known.isNotNull(), F.greatest(F.least(known, F.lit(1e6)), F.lit(-1e6))).cast("decimal(14,6)")
    jitter = JITTER_LOW + F.pmod(hash_number(event_id), F.lit(JITTER_HIGH - JITTER_LOW + 1).cast("long"))
    raw = (
        F.lit(SCORE_BASE).cast("decimal(4,1)")
        + bounded / F.lit(AMOUNT_PER_POINT).cast("decimal(4,0)")
        + jitter.cast("decimal(8,0)") * F.lit("0.01").cast("decimal(3,2)")
    )
    floor, cap = (F.lit(v).cast("decimal(24,12)") for v in (SCORE_FLOOR, SCORE_CAP))
    # greatest skips NULL, so a row without an amount gets the floor.
    score = F.least(cap, F.greatest(floor, raw.cast("decimal(24,12)")))
    return F.round(score, 2).cast("decimal(5,2)")


def alert_key(event_id: Column, customer_id: Column, order_id: Column, amount: Column) -> Column:
    """The event id, or customer, order and amount joined where an event has none."""
    parts = [F.coalesce(c, F.lit("None")) for c in (customer_id.cast("string"), order_id.cast("string"), money_text(amount))]
    return F.coalesce(event_id.cast("string"), F.concat_ws("_", *parts))


def alert_id(key: Column, length: int = 8) -> Column:
    """ALT- and the first hex digits of the key's md5.

    Eight digits are 32 bits: about 77,000 alerts give an even chance of two sharing
    an id. Pass a larger length (up to 32) where the id has to stay unique.
    """
    return F.concat(F.lit("ALT-"), F.upper(F.substring(F.md5(key.cast("string")), 1, length)))


def alert_details(amount: Column, method: Column) -> Column:
    """Readable line for the alert table."""
    shown = F.coalesce(money_text(F.nanvl(amount.cast("double"), F.lit(None).cast("double"))), F.lit("0"))
    return F.concat(F.lit("Failed attempt of BRL "), shown, F.lit(" via "), F.coalesce(method, F.lit("None")))
