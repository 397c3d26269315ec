"""Reject rules, routing and deduplication."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.functions.events import normalize_event_time
from shopstream.functions.alerts import alert_details, alert_id, alert_key, risk_score
from shopstream.functions.text import ANONYMOUS, NO_ORDER, default_fill
from shopstream.operators.skew import as_list, lookup, top_per_group
from shopstream.sources.schemas import ALERT_COLUMNS, CORRUPT, TOPIC_OF

# Reject reasons and rule name as they appear in the reject log and alerts.
MISSING_FIELD = "Missing required UUID or ISO timestamp"
OUT_OF_RANGE = "Negative transaction monetary value or zero quantity"
RAPID_RULE = "RAPID_FAILED_PAYMENT_ATTEMPTS_DETECTED"

REASON = "dlq_reason"


@dataclass(frozen=True)
class Rule:
    """A reject reason, the rows it applies to, and a join that adds what the test needs."""

    reason: str
    broken: Callable[[DataFrame], Column]
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df


def _missing(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(True)
    return F.col(name).isNull() | (F.trim(F.col(name).cast("string")) == "")


def required(cols: Sequence[str], reason: str = MISSING_FIELD) -> Rule:
    """Reject where any of the fields is absent, NULL or empty."""

    def broken(df: DataFrame) -> Column:
        test = F.lit(False)
        for name in cols:
            test = test | _missing(df, name)
        return test

    return Rule(reason, broken)


def in_range(amount: str = "amount", quantity: str = "quantity", reason: str = OUT_OF_RANGE) -> Rule:
    """Reject negative and non-finite amounts, and quantities that are below one or not finite;
    an absent field passes."""

    def outside(df: DataFrame, name: str, good: Callable[[Column], Column]) -> Column:
        value = F.col(name).cast("double")
        # NaN counts as larger than infinity
        return ~F.coalesce(good(value) & (value < F.lit(float("inf"))), F.lit(True)) if name in df.columns else F.lit(False)

    def broken(df: DataFrame) -> Column:
        return outside(df, amount, lambda x: x >= 0) | outside(df, quantity, lambda x: x > 0)

    return Rule(reason, broken)


def uuid_format(col: str = "event_id", reason: str = "Invalid UUID") -> Rule:
    """Reject ids that are not in UUID form."""
    pattern = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
    return Rule(reason, lambda df: ~F.coalesce(F.col(col).cast("string").rlike(pattern), F.lit(False)))


def iso_timestamp(col: str = "event_timestamp", reason: str = "Invalid timestamp") -> Rule:
    """Reject timestamps that do not parse as ISO-8601."""
    return Rule(reason, lambda df: normalize_event_time(F.col(col).cast("string")).isNull())


def known_type(col: str = "event_type", known: Sequence[str] = tuple(TOPIC_OF), reason: str = "Unknown event type") -> Rule:
    """Reject event types no topic carries."""
    return Rule(reason, lambda df: ~F.coalesce(F.col(col).isin(*known), F.lit(False)))


def parses_as_schema(col: str = CORRUPT, reason: str = "Invalid JSON or schema mismatch") -> Rule:
    """Reject lines the schema could not take."""
    return Rule(reason, lambda df: F.col(col).isNotNull() if col in df.columns else F.lit(False))


def exists_in(dim: DataFrame, key: str, reason: str | None = None) -> Rule:
    """Reject rows whose key is not in the master table."""
    marker = f"_known_{key}"

    def prepare(df: DataFrame) -> DataFrame:
        known = dim.select(key).filter(F.col(key).isNotNull()).distinct().withColumn(marker, F.lit(True))
        return lookup(df, known, key)

    return Rule(reason or f"Unknown {key}", lambda df: F.col(marker).isNull(), prepare)


STANDARD_RULES = (required(["event_id", "event_timestamp"]), in_range())


def tag_rejects(df: DataFrame, rules: Sequence[Rule] = STANDARD_RULES) -> DataFrame:
    """Adds the reason of the first rule a row breaks, NULL for a good row."""
    prepared = df
    for rule in rules:
        prepared = rule.prepare(prepared)
    reasons = [F.when(rule.broken(prepared), F.lit(rule.reason)) for rule in rules]
    reason = F.coalesce(*reasons) if reasons else F.lit(None).cast("string")
    return prepared.withColumn(REASON, reason).select(*df.columns, REASON)


def split_valid(
    df: DataFrame, rules: Sequence[Rule] = STANDARD_RULES, failed_at: datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): every row is in exactly one of the two.

    Rejected rows carry the reason and the time of rejection.
    """
    tagged = tag_rejects(df, rules)
    stamp = F.current_timestamp() if failed_at is None else F.lit(failed_at)
    valid = tagged.filter(F.col(REASON).isNull()).drop(REASON)
    rejected = tagged.filter(F.col(REASON).isNotNull()).withColumn("failed_at", stamp)
    return valid, rejected


def first_by_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str] = ("event_timestamp", "event_id")) -> DataFrame:
    """The earliest row of every key; copies are dropped before the shuffle.

    Rows equal in all order columns are told apart by a hash of their contents, so a
    task that is run again picks the same one.
    """
    ordering = [F.col(c).asc_nulls_last() for c in order if c in df.columns]
    return top_per_group(df, as_list(key), [*ordering, F.xxhash64(*df.columns)], 1)


def drop_duplicate_events(
    df: DataFrame, key: str = "event_id", order: Sequence[str] = ("event_timestamp",), keep_null_keys: bool = True
) -> DataFrame:
    """One row per event id, the earliest.

    Rows without an id cannot be told to be copies and are all kept; pass
    keep_null_keys=False after validation, where there are none, to read the input once.
    """
    named = first_by_key(df.filter(F.col(key).isNotNull()), key, order)
    return named.unionByName(df.filter(F.col(key).isNull())) if keep_null_keys else named


def failed_payments(payments: DataFrame) -> DataFrame:
    """Payments whose status is FAILED."""
    return payments.filter(F.col("payment_status") == "FAILED")


def route_by_type(df: DataFrame, mapping: Mapping[str, str] = TOPIC_OF, col: str = "event_type") -> DataFrame:
    """Adds the topic of each event, NULL for an unknown type."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return df.withColumn("topic", F.try_element_at(F.create_map(*pairs), F.col(col)))


def for_hour(df: DataFrame, at: datetime, grain: str = "hour") -> DataFrame:
    """Rows of one partition directory; the filter reaches the file listing."""
    parts = ["year", "month", "day", "hour"]
    for name in parts[: parts.index(grain) + 1]:
        df = df.filter(F.col(name).cast("int") == getattr(at, name))
    return df


def project(df: DataFrame, spec: Mapping[str, Column | str]) -> DataFrame:
    """Output name to source column or expression: subset, rename, constant, cast."""
    return df.select(*[(F.col(src) if isinstance(src, str) else src).alias(name) for name, src in spec.items()])


def optional(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column, or a NULL of the given type where the table lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def alert_rows(failed: DataFrame, rule: str, details: Column | None = None, keep_key: bool = False) -> DataFrame:
    """Alert table rows for the given payments."""
    amount = optional(failed, "amount", "double")
    customer, order = optional(failed, "customer_id"), optional(failed, "order_id")
    key = alert_key(optional(failed, "event_id"), customer, order, amount)
    details = alert_details(amount, optional(failed, "payment_method")) if details is None else details
    columns = {
        "alert_id": alert_id(key),
        "event_timestamp": F.col("event_timestamp"),
        "customer_id": default_fill(customer.cast("string"), ANONYMOUS),
        "order_id": default_fill(order.cast("string"), NO_ORDER),
        "risk_score": risk_score(amount, key),
        "rule_violated": F.lit(rule),
        "details": details,
    }
    assert list(columns) == ALERT_COLUMNS
    return project(failed, columns | ({"event_id": key} if keep_key else {}))


def failed_payment_alerts(payments: DataFrame, rule: str = RAPID_RULE, keep_key: bool = False) -> DataFrame:
    """One alert per failed payment."""
    return alert_rows(failed_payments(payments), rule, keep_key=keep_key)
