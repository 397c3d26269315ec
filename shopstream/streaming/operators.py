"""Streaming operators. Event time is `event_timestamp` as TIMESTAMP."""

from __future__ import annotations

import threading
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues
from pyspark.storagelevel import StorageLevel

from shopstream.functions.events import time_partitions
from shopstream.operators import aggregates as agg
from shopstream.operators.joins import enrich_orders, enrich_views
from shopstream.operators.validation import STANDARD_RULES, Rule, failed_payment_alerts, failed_payments, split_valid
from shopstream.sources.sinks import insert_if_absent

TS = "event_timestamp"
# Directories of the alert tables, in batch and stream alike.
ALERT_PARTITIONS = ("year", "month", "day")


def watermarked(events: DataFrame, delay: str | None) -> DataFrame:
    """The stream with a watermark; None for one that already has its own."""
    return events if delay is None else events.withWatermark(TS, delay)


def stream_rejects(events: DataFrame, rules: Sequence[Rule] = STANDARD_RULES) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) branches of a stream."""
    return split_valid(events, rules)


def stream_enrich(events: DataFrame, dim: DataFrame) -> DataFrame:
    """Orders with their customer, or product views with their product."""
    return enrich_orders(events, dim) if "customer_id" in dim.columns else enrich_views(events, dim)


def stream_dedupe(events: DataFrame, delay: str | None = "10 minutes") -> DataFrame:
    """One row per event id among those that arrive within the delay; for validated events."""
    return watermarked(events, delay).dropDuplicatesWithinWatermark(["event_id"])


def stream_revenue(events: DataFrame, size: str = "1 hour", delay: str | None = "10 minutes", by: Sequence[str] = ()) -> DataFrame:
    """Revenue, orders and order value per tumbling window."""
    return agg.revenue_by_window(watermarked(events, delay), size, by)


def stream_abandonment_kpi(events: DataFrame, days: int = 2) -> DataFrame:
    """Cart events, checkout events and the percentage in excess for each day that a batch changes,
    from events of both topics; each event counts once. For update mode.

    The state is a count per day and the ids of the days that are still open: a day closes once
    one that lies `days` later has come, and what comes later still is dropped.
    """
    # the watermark lies on days, so that all events of an open day are taken
    day = events.withColumn("day", F.date_trunc("day", TS)).withWatermark("day", f"{days} days")
    once = day.dropDuplicates(["event_id", "day"])
    return agg.cart_abandonment_rates(once, F.col("topic") == "cart-events", F.col("topic") == "checkout-events", "day")


def stream_active_users(events: DataFrame, size: str = "1 hour", delay: str | None = "10 minutes") -> DataFrame:
    """Sketches of the customers and sessions active per window, which `aggregates.merged_users`
    turns into counts of days, weeks or months."""
    return agg.user_sketches(watermarked(events, delay), size)


def stream_sliding_failures(
    payments: DataFrame, size: str = "10 minutes", slide: str = "5 minutes", delay: str | None = "10 minutes"
) -> DataFrame:
    """Failed payments per customer in overlapping windows."""
    window = F.window(TS, size, slide).alias("_w")
    counted = failed_payments(watermarked(payments, delay)).groupBy(window, "customer_id").agg(F.count("*").alias("failures"))
    return counted.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "customer_id", "failures"
    )


def stream_sessions(events: DataFrame, gap: str = "30 minutes", delay: str | None = "10 minutes") -> DataFrame:
    """Customer sessions ended by a pause."""
    window = F.session_window(TS, gap).alias("_w")
    counted = watermarked(events, delay).groupBy("customer_id", window).agg(F.max(TS).alias("session_end"), F.count("*").alias("events"))
    return counted.select("customer_id", F.col("_w.start").alias("session_start"), "session_end", "events")


def stream_abandonment(
    carts: DataFrame, checkouts: DataFrame, within: int = 3600, delay: str | None = "10 minutes", bucket: int = 60
) -> DataFrame:
    """Cart events whose customer starts no checkout in the next `within` seconds.

    Checkouts are first reduced to the earliest and latest per customer and bucket. A cart
    sees a checkout in time exactly if some bucket ends no earlier than the cart and begins
    within the interval, as long as a bucket is no longer than the interval. So a cart
    meets at most `within / bucket + 2` rows, however many checkouts the customer starts.
    """
    bucket = min(bucket, within)
    span = F.window(TS, f"{bucket} seconds").alias("_w")
    reduced = (
        watermarked(checkouts.filter(F.col("customer_id").isNotNull()), delay)
        .groupBy(F.col("customer_id").alias("_customer"), span)
        .agg(F.min(TS).alias("_first"), F.max(TS).alias("_last"))
        .select("_customer", "_first", "_last", F.window_time("_w").alias("_bucket_end"))
    )
    limit = F.expr(f"INTERVAL {within} SECONDS")
    slack = F.expr(f"INTERVAL {within + bucket} SECONDS")
    in_time = (
        (F.col("customer_id") == F.col("_customer"))
        & (F.col("_last") >= F.col(TS))
        & (F.col("_first") <= F.col(TS) + limit)
        # Implied by the two above; lets Spark drop state that can no longer match.
        & (F.col("_bucket_end") >= F.col(TS))
        & (F.col("_bucket_end") <= F.col(TS) + slack)
    )
    joined = watermarked(carts, delay).join(reduced, in_time, "left_outer")
    return joined.filter(F.col("_customer").isNull()).select(*carts.columns)


STREAK_OUTPUT = "customer_id long, first_failed_at long, reached_at long, failures long"
#: What the state store of the streaks must be; set before the query starts.
STREAK_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Partitions of a query's state where the cluster has few cores.
STATE_PARTITIONS = 8

#: Rows of a waiting entry of the streaks, unless more share a millisecond.
STREAK_ROWS = 1000


class Streaks(StatefulProcessor):
    """Runs of failed payments of a customer, in order of event time.

    What a batch brings for a customer waits in a map as one entry, or several of consecutive rows,
    by the millisecond of its first row. One timer for the earliest of them wakes the customer once
    the watermark has passed it; then all that is due is taken at once. So the calls to the state
    grow with the customers that a batch touches, not with their rows; entries that are not due are
    not read, and a customer without new or due rows is not touched.
    """

    def __init__(self, k: int):
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "ms long", "rows array<struct<at long, id string, failed boolean>>")
        self.run = handle.getValueState("run", "first long, length long")

    def _keep(self, rows: list[tuple]) -> None:
        """Rows in order of time, kept until they are due."""
        start = 0
        while start < len(rows):
            end = min(start + STREAK_ROWS, len(rows))
            while end < len(rows) and rows[end][0] // 1000 == rows[end - 1][0] // 1000:
                end += 1
            ms, found = rows[start][0] // 1000, rows[start:end]
            if self.waiting.containsKey((ms,)):
                found = [*(tuple(r) for r in self.waiting.getValue((ms,))[0]), *found]
            self.waiting.updateValue((ms,), (found,))
            start = end
        self.handle.registerTimer(rows[0][0] // 1000 + 1)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        came: list[tuple] = []
        for pdf in rows:
            came.extend(zip(pdf["at"].tolist(), pdf["id"].tolist(), pdf["failed"].astype(bool).tolist(), strict=True))
        if came:
            self._keep(sorted(came, key=lambda r: r[0]))
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        begun = [ms for (ms,) in self.waiting.keys() if ms < passed]
        due: list[tuple] = []
        later: list[tuple] = []
        for ms in begun:
            for r in self.waiting.getValue((ms,))[0]:
                (due if r[0] // 1000 < passed else later).append((r[0], r[1], r[2]))
            self.waiting.removeKey((ms,))
        if later:
            self._keep(sorted(later, key=lambda r: r[0]))
        if not due:  # taken by an earlier timer
            return
        first, length = self.run.get() if self.run.exists() else (0, 0)
        before, reached = (first, length), []
        for at, _, failed in sorted((r[0], r[1] or "", r[2]) for r in due):
            first, length = (first if length else at, length + 1) if failed else (0, 0)
            if length == self.k:
                reached.append((first, at))
        if length and (first, length) != before:
            self.run.update((first, length))
        elif not length and before[1]:
            self.run.clear()
        if reached:
            yield pd.DataFrame([(key[0], *r, self.k) for r in reached], columns=["customer_id", "first_failed_at", "reached_at", "failures"])

    def close(self) -> None:
        pass


def stream_failure_streaks(payments: DataFrame, k: int = 3, delay: str | None = "10 minutes") -> DataFrame:
    """One row when a customer's run of failed payments reaches length k.

    Rows come in any order, so they wait in the state until the watermark has passed them and are
    then taken in order of time. Times are microseconds throughout, so the session's zone has no
    say. The session must use the RocksDB state store (`STREAK_STORE`) when the query starts.
    """
    marked = watermarked(payments, delay).filter(F.col("payment_status").isNotNull() & F.col("customer_id").isNotNull())
    rows = marked.select(
        F.col("customer_id"),
        F.col(TS),
        F.unix_micros(TS).alias("at"),
        F.col("event_id").cast("string").alias("id"),
        (F.col("payment_status") == "FAILED").alias("failed"),
    )
    output = STREAK_OUTPUT.replace("customer_id long", f"customer_id {payments.schema['customer_id'].dataType.simpleString()}")
    found = rows.groupBy("customer_id").transformWithStateInPandas(Streaks(k), output, "Append", "EventTime")
    return found.withColumns({c: F.timestamp_micros(c) for c in ("first_failed_at", "reached_at")})


def stream_alerts(payments: DataFrame, target: str, checkpoint: str, archive: str | None = None, **trigger) -> StreamingQuery:
    """Writes an alert for every failed payment, once, to the alert table and the archive, both
    by day of the payment; a batch reads only the days it falls in. What reaches the table reaches
    the archive, also where a run ends between the two. Read both with `read_committed`."""

    def write(batch: DataFrame, _id: int) -> None:
        alerts = failed_payment_alerts(batch, keep_key=True)
        daily = alerts.withColumns(time_partitions(F.col(TS), "day"))
        insert_if_absent(daily, target, "event_id", partition_by=ALERT_PARTITIONS, also=[] if archive is None else [archive])

    return (
        payments.writeStream.queryName("alerts")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


class LateRows(StreamingQueryListener):
    """Counts the rows that queries dropped because they came after the watermark, over the whole
    life of each run; the progress that a query keeps itself goes back a hundred batches.

    Add it with `spark.streams.addListener` before the queries start. For windowed sums Spark counts
    partially summed rows, so the count is a lower bound there.
    """

    def __init__(self) -> None:
        self._dropped: Counter[str] = Counter()
        self._ended: defaultdict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._dropped[str(event.progress.runId)] += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def of(self, query: StreamingQuery, wait: float = 60) -> int:
        """The rows dropped by a run so far; of one that has ended, all: its last progress is
        waited for."""
        run = str(query.runId)
        if not query.isActive and not self._ended[run].wait(wait):
            raise TimeoutError("the end of the query was not reported; was the listener added before it started?")
        return self._dropped[run]


LATE_MARKS = "batch long, newest timestamp"


def stream_late_rows(events: DataFrame, path: str, marks: str, checkpoint: str, delay: str = "10 minutes", **trigger) -> StreamingQuery:
    """Writes the rows that come later than a watermark with this delay, each with its lateness
    behind that watermark in seconds, to a directory for each batch.

    The watermark of a batch is the newest time of all batches before it, less the delay, as Spark
    has it. The newest time up to each batch is written to `marks`, so a batch that runs again
    sees the same.
    """
    columns = events.columns

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            known = session.read.schema(LATE_MARKS).option("recursiveFileLookup", "true")
            before = known.parquet(f"{marks}/{batch_id - 1:012d}").first()["newest"] if batch_id else None
            newest = kept.agg(F.max(TS).alias("newest")).first()["newest"]
            if before is not None:
                behind = F.lit(before) - F.expr(f"INTERVAL {delay}")
                seconds = (F.unix_micros(behind) - F.unix_micros(TS)) / 1_000_000
                late = kept.filter(F.col(TS) < behind).select(*columns, seconds.alias("late_seconds"))
                late.write.mode("overwrite").parquet(f"{path}/batch={batch_id:012d}")
            both = [t for t in (before, newest) if t is not None]
            mark = session.createDataFrame([(batch_id, max(both) if both else None)], LATE_MARKS)
            mark.coalesce(1).write.mode("overwrite").parquet(f"{marks}/{batch_id:012d}")
        finally:
            kept.unpersist()

    writer = events.writeStream.queryName("late_rows").foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def late_summary(late: DataFrame, grain: str = "hour") -> DataFrame:
    """Late rows, and their mean and largest lateness, per period of their event time."""
    seconds = F.col("late_seconds")
    grouped = late.groupBy(F.date_trunc(grain, TS).alias("period")).agg(F.count("*").alias("rows"), F.sum(F.round(seconds * 1000).cast("long")).alias("_ms"), F.max(seconds).alias("most_seconds"))
    return grouped.select("period", "rows", F.round(F.col("_ms") / F.col("rows") / 1000, 3).alias("mean_seconds"), "most_seconds")
