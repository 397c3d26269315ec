"""The continuous pipeline: one independent query per output."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shopstream.functions.events import time_partitions
from shopstream.operators.validation import REASON, tag_rejects
from shopstream.plans.medallion import LAKE_RULES, Lake, add_unique_events, present, typed
from shopstream.sources.readers import stream_events
from shopstream.sources.schemas import EVENT_SCHEMA
from shopstream.sources.sinks import JSON_TIMES, write_multi, write_partitioned
from shopstream.streaming import operators as so


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    return root.rstrip("/")


def start_sink(
    df: DataFrame, path: str, checkpoint: str, name: str, fmt: str = "parquet", partition_by: tuple[str, ...] = (), **trigger
) -> StreamingQuery:
    """Appends a stream to files, each row once also after a restart."""
    writer = df.writeStream.queryName(name).format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    if fmt == "json":
        writer = writer.options(**JSON_TIMES)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.outputMode("append").trigger(**trigger).start()


def by_time(df: DataFrame, ts: str = "event_timestamp") -> tuple[DataFrame, tuple[str, ...]]:
    parts = time_partitions(F.col(ts))
    return df.withColumns(parts), tuple(parts)


#: State of the queries: keys lie in files on the executors' disks, and what is kept of them in memory
#: is bounded for an executor, however many queries and partitions it holds. A commit writes the
#: changes alone, and the four stores of a join partition are one.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": so.STREAK_STORE,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}
PARTITIONS = "spark.sql.shuffle.partitions"


def state_settings(spark: SparkSession) -> dict[str, str]:
    """What queries with state are started with. What the session sets itself holds, but for the partitions
    of a store: each is committed in every batch, with rows or without, so there are at most two
    for a core. A checkpoint keeps the store and the partitions that it began with."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) not in (None, so.STREAK_STORE):
        store = {}
    else:
        store = {name: value for name, value in STATE.items() if spark.conf.get(name, None) is None}
    partitions = min(int(spark.conf.get(PARTITIONS)), max(so.STATE_PARTITIONS, 2 * spark.sparkContext.defaultParallelism))
    return {**store, PARTITIONS: str(partitions)}


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for queries that start inside; a query keeps those of its start."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# State of the checked events.
ACCEPTED, REJECTED = "accepted", "rejected"
# The queries without state of their own, which keep the session's settings.
STATELESS = ("checked", "rejects", "unique_events")


def checked_schema() -> T.StructType:
    """The columns of the checked events."""
    extra = [T.StructField(n, T.StringType()) for n in ("topic", REASON)]
    stamp = T.StructField("failed_at", T.TimestampType())
    return T.StructType([*EVENT_SCHEMA.fields, *extra, stamp, T.StructField("state", T.StringType())])


def checked_events(spark: SparkSession, lake: Lake) -> DataFrame:
    """What the pipeline has parsed and judged so far, as a table."""
    return spark.read.schema(checked_schema()).parquet(lake.live("checked-events"))


def pipeline_starters(
    spark: SparkSession, lake: Lake, root: str, delay: str, max_files: int | None, trigger: dict
) -> dict[str, Callable[[], StreamingQuery]]:
    """Name of each query and what starts it.

    The first, `checked`, lists and parses the raw text, once for all: every line goes to one
    table with its state and topic. The others read their rows of that table, by filters that
    reach the files, and its log of files spares them a listing. (Directories by topic would spare
    more, but a stream that starts before the first file does not learn of them.) Outputs lie
    below `live/`, apart from those of the batch run; the alert log and the table of unique events
    are shared.
    """
    source = lake.live("checked-events")

    def checked() -> StreamingQuery:
        tagged = tag_rejects(stream_events(spark, lake.bronze(), max_files), LAKE_RULES)
        rows = tagged.withColumns({"failed_at": F.current_timestamp(), "state": F.when(F.col(REASON).isNull(), ACCEPTED).otherwise(REJECTED)})
        return start_sink(rows, source, f"{root}/checked", "checked", **trigger)

    def read(state: str, topic: str | None = None) -> DataFrame:
        table = spark.readStream.schema(checked_schema()).parquet(source)
        rows = table.filter(F.col("state") == state)
        return rows.filter(F.col("topic") == topic) if topic else rows

    def clean(topic: str) -> DataFrame:
        return so.stream_dedupe(typed(read(ACCEPTED, topic).drop("state", REASON, "failed_at")), delay)

    def sink(df: DataFrame, name: str, path: str, fmt: str = "parquet", ts: str | None = None) -> StreamingQuery:
        df, parts = by_time(df, ts) if ts else (df, ())
        return start_sink(df, path, f"{root}/{name}", name, fmt, parts, **trigger)

    def enriched(events: DataFrame, name: str, table: str, master: str) -> StreamingQuery:
        """Each batch is joined to the master table as it is then, and is a directory of its own,
        which a batch that runs again replaces."""

        def write(batch: DataFrame, batch_id: int) -> None:
            dim = batch.sparkSession.read.parquet(lake.master(master))
            path = f"{lake.live(table)}/batch={batch_id:012d}"
            write_multi(so.stream_enrich(batch, dim), [lambda df: write_partitioned(df, path, grain=lake.grain, mode="overwrite")])

        writer = events.writeStream.queryName(name).foreachBatch(write).option("checkpointLocation", f"{root}/{name}")
        return writer.trigger(**trigger).start()

    def abandonment() -> StreamingQuery:
        lost = so.stream_abandonment(clean("cart-events"), clean("checkout-events"), delay=None)
        return sink(lost, "abandonment", lake.live("abandoned_carts"))

    def abandonment_kpi() -> StreamingQuery:
        """The percentage per day, brought up to date for the days that a batch changes; what was
        counted before is in the query's state."""

        def write(batch: DataFrame, _id: int) -> None:
            rows = batch.withColumn("day", F.to_date("day")).repartition("day")
            target = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            target.partitionBy("day").parquet(lake.live("cart_abandonment"))

        events = typed(read(ACCEPTED).filter(F.col("topic").isin("cart-events", "checkout-events")))
        writer = so.stream_abandonment_kpi(events).writeStream.queryName("abandonment_kpi").foreachBatch(write).outputMode("update")
        return writer.option("checkpointLocation", f"{root}/abandonment_kpi").trigger(**trigger).start()

    def unique_events() -> StreamingQuery:
        """Events that the table of unique events lacks."""
        events = typed(read(ACCEPTED).drop("state", REASON, "failed_at"))
        writer = events.writeStream.queryName("unique_events").foreachBatch(lambda batch, _id: add_unique_events(batch, lake))
        return writer.option("checkpointLocation", f"{root}/unique_events").trigger(**trigger).start()

    return {
        "checked": checked,
        "rejects": lambda: sink(read(REJECTED).drop("state"), "rejects", lake.live("dead-letter-events"), "json", "failed_at"),
        "orders": lambda: enriched(clean("order-events"), "orders", "enriched-orders", "customers"),
        "views": lambda: enriched(clean("product-view-events"), "views", "customer-events", "products"),
        "revenue": lambda: sink(so.stream_revenue(clean("order-events"), delay=None), "revenue", lake.live("revenue_per_hour")),
        "abandonment": abandonment,
        "abandonment_kpi": abandonment_kpi,
        "unique_events": unique_events,
        "alerts": lambda: so.stream_alerts(
            clean("payment-events"), lake.live("fraud_alarms"), f"{root}/alerts", lake.gold("fraud_alerts_log"), **trigger
        ),
    }


def run_pipeline(
    spark: SparkSession,
    lake: Lake,
    interval: str = "5 seconds",
    once: bool = False,
    delay: str = "10 minutes",
    max_files: int | None = 1000,
    checkpoints: str | None = None,
) -> dict[str, StreamingQuery | Exception]:
    """Starts every query; one that fails is reported and does not stop the others.

    With once=True all queries work off what is there and have ended on return, the parsing one
    before the others. Calling it again with the same checkpoints continues where each query
    stopped. One pipeline and one batch run may share a lake, in either order.
    """
    root = checkpoints or f"{checkpoint_root(spark)}/shopstream"
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    if present(lambda: spark.read.parquet(lake.live("checked-events"))) is None:
        # the directory that the other queries wait on; with partitions, so that no file is made
        empty = spark.createDataFrame([], checked_schema())
        empty.write.mode("ignore").partitionBy("state", "topic").parquet(lake.live("checked-events"))
    result: dict[str, StreamingQuery | Exception] = {}

    def end(name: str) -> None:
        query = result[name]
        if isinstance(query, StreamingQuery):
            try:
                query.awaitTermination()
            except PySparkException as error:
                result[name] = error

    state = state_settings(spark)
    for name, start in pipeline_starters(spark, lake, root, delay, max_files, trigger).items():
        try:
            with settings(spark, {} if name in STATELESS else state):
                result[name] = start()
        except PySparkException as error:
            result[name] = error
        if once and name == "checked":
            end(name)
    if once:
        for name in result:
            end(name)
    return result
