"""Text and default-value expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopstream.functions.money import money_text

# Labels and defaults the reports must show.
STANDARD_TIER = "Standard"
GENERAL_CATEGORY = "General_Merchandise"
DEFAULT_UNIT_PRICE = 49.99
ANONYMOUS = "ANONYMOUS"
NO_ORDER = "N/A"
BRAND_PREFIX = "Olist_Certified_"
MERCHANT_PREFIX = "Partner_Merchant_"
PLACEHOLDER = "-"


def default_fill(value: Column, default) -> Column:
    """The value, or the default where it is NULL."""
    return F.coalesce(value, F.lit(default))


def brand_name(category: Column, prefix: str = BRAND_PREFIX) -> Column:
    """Prefix and the first four letters of the category in capitals."""
    return F.concat(F.lit(prefix), F.upper(F.substring(category, 1, 4)))


def merchant_name(seller_id: Column, prefix: str = MERCHANT_PREFIX) -> Column:
    """Prefix and the first six characters of the seller id."""
    return F.concat(F.lit(prefix), F.substring(seller_id.cast("string"), 1, 6))


def placeholder(value: Column) -> Column:
    """The value as text, or "-" for NULL, NaN and empty text."""
    text = value.cast("string")
    return F.when(text.isNull() | text.isin("", "None", "nan", "NaN"), F.lit(PLACEHOLDER)).otherwise(text)


def feed_amount(*amounts: Column) -> Column:
    """First amount that is neither NULL nor NaN, as text; "-" when there is none."""
    missing = F.lit(None).cast("double")
    present = [F.nanvl(a.cast("double"), missing) for a in amounts]
    return placeholder(money_text(F.coalesce(*present)))
