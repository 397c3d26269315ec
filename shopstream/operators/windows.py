"""Order-dependent operators over one customer's events.

A window partitioned by customer alone would put a customer with a third of all rows in
one task. These operators cut each customer's time line into slices, work per (customer,
slice), and then join the slices up over a small summary: its rows per customer are
bounded by the number of slices or sessions, not by the number of events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstream.functions.money import ratio
from shopstream.operators.skew import micros, time_slice
from shopstream.operators.validation import alert_rows, failed_payments

DAY = 86_400


def running_revenue(revenue: DataFrame, by: str = "period") -> DataFrame:
    """Cumulative revenue over per-period rows.

    The window has no partitions, but its input has one row per period.
    """
    so_far = Window.orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum(F.round(F.col("revenue") * 100).cast("long")).over(so_far)
    return revenue.withColumn("running_revenue", total / 100)


def period_change(revenue: DataFrame, n: int = 1, by: str = "period") -> DataFrame:
    """Revenue against the nth period before, as difference and as share."""
    before = F.lag("revenue", n).over(Window.orderBy(by))
    previous = revenue.withColumn("previous_revenue", before)
    whole = F.round(F.col("revenue") * 100).cast("long") - F.round(F.col("previous_revenue") * 100).cast("long")
    return previous.withColumn("change", whole / 100).withColumn("change_rate", ratio(F.col("change"), F.col("previous_revenue")))


def consecutive_failures(payments: DataFrame, k: int, slice_seconds: int = DAY) -> DataFrame:
    """Runs of at least k failed payments of a customer without a success between them.

    Inside a slice a run is the failures after the same number of successes. Runs that
    touch neither edge of their slice are complete. The others, at most two per customer
    and slice, are chained: a success before a run starts a new chain.
    """
    failed = F.col("payment_status") == "FAILED"
    rows = payments.select(
        "customer_id",
        "event_timestamp",
        "event_id",
        failed.alias("_failed"),
        time_slice("event_timestamp", slice_seconds).alias("_slice"),
    ).filter(F.col("_failed").isNotNull() & F.col("customer_id").isNotNull())
    in_slice = Window.partitionBy("customer_id", "_slice")
    successes = F.sum(F.when(F.col("_failed"), 0).otherwise(1)).over(
        in_slice.orderBy("event_timestamp", "event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    failed_at = F.when(F.col("_failed"), F.col("event_timestamp"))
    runs = (
        rows.withColumn("_run", successes)
        .groupBy("customer_id", "_slice", "_run")
        .agg(
            F.count_if("_failed").alias("failures"),
            F.min(failed_at).alias("first_failed_at"),
            F.max(failed_at).alias("last_failed_at"),
        )
        .withColumn("_last_run", F.max("_run").over(in_slice))
    )
    inner = (F.col("_run") > 0) & (F.col("_run") < F.col("_last_run"))
    result = ["customer_id", "first_failed_at", "last_failed_at", "failures"]
    whole = runs.filter(inner).select(*result)

    along = Window.partitionBy("customer_id").orderBy("_slice", "_run")
    chain = F.sum((F.col("_run") > 0).cast("int")).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    chained = (
        runs.filter(~inner)
        .withColumn("_chain", chain)
        .groupBy("customer_id", "_chain")
        .agg(
            F.min("first_failed_at").alias("first_failed_at"),
            F.max("last_failed_at").alias("last_failed_at"),
            F.sum("failures").alias("failures"),
        )
        .select(*result)
    )
    return whole.unionByName(chained).filter(F.col("failures") >= k)


def rapid_failures(payments: DataFrame, k: int, seconds: int) -> DataFrame:
    """Failed payments that are at least the customer's kth failure within the interval.

    Slices are as long as the interval and each failure is also shown to the next slice,
    so the k-1 failures before it are at hand without the customer's whole history.
    """
    failed = failed_payments(payments).filter(F.col("customer_id").isNotNull())
    # _own is 0 in a row's own slice and 1 where it is shown to the next.
    both = F.explode(F.array(F.lit(0), F.lit(1)))
    shown = failed.withColumn("_own", both).withColumn("_slice", time_slice("event_timestamp", seconds) + F.col("_own"))
    along = Window.partitionBy("customer_id", "_slice").orderBy("event_timestamp", "event_id")
    now = micros("event_timestamp")
    earlier = F.lag(now, k - 1).over(along) if k > 1 else now
    marked = shown.withColumn("_earlier", earlier)
    # Failures at one instant count for each other: the last of them sees the most.
    same = Window.partitionBy("customer_id", "_slice").orderBy(now).rangeBetween(0, 0)
    marked = marked.withColumn("_span", now - F.max("_earlier").over(same))
    hits = marked.filter((F.col("_own") == 0) & (F.col("_span") <= seconds * 1_000_000))
    return hits.select(*payments.columns)


def rapid_failure_alerts(
    payments: DataFrame, k: int = 3, seconds: int = 600, rule: str = "RAPID_CONSECUTIVE_FAILURES"
) -> DataFrame:
    """Alert rows for rapid failures."""
    details = F.lit(f"{k} or more failed payments within {seconds} seconds")
    return alert_rows(rapid_failures(payments, k, seconds), rule, details)


def _local_sessions(events: DataFrame, gap: int, slice_seconds: int, ts: str, order: list[str]) -> DataFrame:
    sliced = events.withColumn("_slice", time_slice(ts, slice_seconds))
    along = Window.partitionBy("customer_id", "_slice").orderBy(*order)
    idle = micros(ts) - F.lag(micros(ts)).over(along)
    starts = sliced.withColumn("_starts", (idle.isNull() | (idle > gap * 1_000_000)).cast("int"))
    return starts.withColumn("_local", F.sum("_starts").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def _number_sessions(local: DataFrame, gap: int, ts: str) -> DataFrame:
    pieces = local.groupBy("customer_id", "_slice", "_local").agg(
        F.min(ts).alias("_start"), F.max(ts).alias("_end"), F.count("*").alias("_n")
    )
    along = Window.partitionBy("customer_id").orderBy("_slice", "_local")
    idle = micros("_start") - F.lag(micros("_end")).over(along)
    starts = pieces.withColumn("_starts", (idle.isNull() | (idle > gap * 1_000_000)).cast("int"))
    return starts.withColumn(
        "session_no", F.sum("_starts").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )


def assign_sessions(
    events: DataFrame, gap: int = 1800, slice_seconds: int = DAY, ts: str = "event_timestamp", tie: str = "event_id"
) -> DataFrame:
    """Every event with its customer's session number; a pause of more than `gap` seconds ends a session.

    Events without a customer are kept and have no session.
    """
    # The filter is the one the join below would add, so both its sides read one shuffle.
    known = events.filter(F.col("customer_id").isNotNull())
    local = _local_sessions(known, gap, slice_seconds, ts, [ts, tie])
    numbered = _number_sessions(local, gap, ts)
    # Within a slice session numbers rise with local ones, so one offset per slice is enough.
    offsets = numbered.groupBy(F.col("customer_id").alias("_c"), F.col("_slice").alias("_s")).agg(
        F.min(F.col("session_no") - F.col("_local")).alias("_offset")
    )
    same = (F.col("customer_id") == F.col("_c")) & (F.col("_slice") == F.col("_s"))
    number = (F.col("_local") + F.col("_offset")).cast("long").alias("session_no")
    assigned = local.join(offsets, same, "left").select(*events.columns, number)
    unknown = events.filter(F.col("customer_id").isNull()).withColumn("session_no", F.lit(None).cast("long"))
    return assigned.unionByName(unknown)


def gap_sessions(events: DataFrame, gap: int = 1800, slice_seconds: int = DAY, ts: str = "event_timestamp") -> DataFrame:
    """One row per inactivity-gap session of a known customer."""
    known = events.filter(F.col("customer_id").isNotNull())
    numbered = _number_sessions(_local_sessions(known, gap, slice_seconds, ts, [ts]), gap, ts)
    return numbered.groupBy("customer_id", "session_no").agg(
        F.min("_start").alias("session_start"), F.max("_end").alias("session_end"), F.sum("_n").alias("events")
    )
