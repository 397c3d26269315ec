"""Streaming operators on the events table, replayed as a stream.

Each stream is worked off completely and written as files to the folder the cluster
names for checkpoints; the query returns those files. In append mode a window is written
only once the watermark has passed its end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import tables as t
from registry.lake import folder
from registry.queries import query
from shopstream.operators import aggregates as agg
from shopstream.operators import validation as val
from shopstream.sources import commits
from shopstream.sources.commits import read_committed
from shopstream.streaming import operators as so
from shopstream.streaming.pipeline import start_sink

RAW = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def replay(spark: SparkSession, sf: str) -> DataFrame:
    raw = spark.readStream.schema(RAW).option("pathGlobFilter", "events.parquet").parquet(sf)
    return t.event_columns(raw).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for queries started inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def state_for_cores(spark: SparkSession):
    """At most two state partitions per core for queries started inside; a state store costs time even if empty."""
    name = "spark.sql.shuffle.partitions"
    return setting(spark, name, str(min(int(spark.conf.get(name)), 2 * spark.sparkContext.defaultParallelism)))


def finished(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """Runs the stream to its end and reads what it wrote."""
    df, root = make(), folder(spark)
    with state_for_cores(spark):
        replayed = start_sink(df, f"{root}/out", f"{root}/checkpoint", "replay", availableNow=True)
    replayed.awaitTermination()
    return without_zone(spark.read.schema(df.schema).parquet(f"{root}/out"))


def without_zone(df: DataFrame) -> DataFrame:
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def kinds(df: DataFrame, *types: str) -> DataFrame:
    return df.filter(F.col("event_type").isin(*types))


RULES = (val.in_range(), val.known_type(known=("product_view", "add_to_cart", "payment_completed", "payment_failed")))


def priced(df: DataFrame) -> DataFrame:
    """Amounts lowered by five, so that some are negative."""
    columns = ["event_id", "event_timestamp", "customer_id", "event_type"]
    return df.select(*columns, (F.col("amount") - 5).alias("amount"))


@query
def stream_valid(spark, sf):
    return finished(spark, lambda: so.stream_rejects(priced(replay(spark, sf)), RULES)[0])


@query
def stream_rejects(spark, sf):
    return finished(spark, lambda: so.stream_rejects(priced(replay(spark, sf)), RULES)[1].drop("failed_at"))


@query
def stream_enrich(spark, sf):
    def make():
        paid = kinds(replay(spark, sf), "payment_completed").select("event_id", "customer_id", "amount")
        return so.stream_enrich(paid, t.customers(spark, sf))

    return finished(spark, make)


@query
def stream_dedupe(spark, sf):
    def make():
        raw = replay(spark, sf)
        twice = raw.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
        return so.stream_dedupe(twice).select("event_id", "event_timestamp", "customer_id")

    return finished(spark, make)


@query
def stream_revenue(spark, sf):
    def make():
        return so.stream_revenue(kinds(replay(spark, sf), "payment_completed").withColumnRenamed("amount", "total_amount"))

    return finished(spark, make)


@query
def stream_sliding_failures(spark, sf):
    return finished(spark, lambda: so.stream_sliding_failures(replay(spark, sf), "12 hours", "6 hours"))


@query
def stream_sessions(spark, sf):
    return finished(spark, lambda: so.stream_sessions(replay(spark, sf), "6 hours"))


@query
def stream_abandonment(spark, sf):
    def make():
        carts = kinds(replay(spark, sf), "add_to_cart").select("event_id", "customer_id", "event_timestamp")
        return so.stream_abandonment(carts, kinds(replay(spark, sf), "checkout_started"), 86_400, bucket=3600)

    return finished(spark, make)


@query
def stream_failure_streaks(spark, sf):
    with setting(spark, "spark.sql.streaming.stateStore.providerClass", so.STREAK_STORE):
        return finished(spark, lambda: so.stream_failure_streaks(replay(spark, sf), 3))


@query
def stream_active_users(spark, sf):
    """Hourly sketches from a stream, merged to days, beside the exact counts of the same hours;
    an estimate must lie within three standard deviations."""
    hours = finished(spark, lambda: so.stream_active_users(replay(spark, sf)))
    merged = agg.merged_users(hours).select(F.col("period").alias("day"), F.col("customers").alias("_estimate"))
    seen = t.events(spark, sf).withColumn("window_start", F.date_trunc("hour", "event_timestamp")).join(hours.select("window_start"), "window_start", "left_semi")
    exact = seen.groupBy(F.date_trunc("day", "window_start").alias("day")).agg(F.count_distinct("customer_id").alias("customers"))
    allowed = F.greatest(F.lit(1.0), 3 * 1.04 / 2 ** (agg.SKETCH_LG_K / 2) * F.col("customers"))
    judged = exact.join(merged, "day").select("day", "customers", (F.abs(F.col("_estimate") - F.col("customers")) <= allowed).alias("within"))
    return without_zone(judged)


@query
def late_rows(spark, sf):
    """The events in four batches, every tenth of them a batch late: what a stream of hourly
    windows drops is in the side table, with how late it came."""
    root = folder(spark)
    events = t.events(spark, sf).select("event_id", F.col("event_timestamp").cast("timestamp").alias("event_timestamp"))
    bounds = [F.lit(datetime(2024, 1, d)).cast("timestamp") for d in (1, 8, 15, 22)]
    batch = sum((F.col("event_timestamp") >= b).cast("int") for b in bounds) + (F.col("event_id") % 10 == 0).cast("int")
    for n in range(1, 6):
        events.filter(batch == n).coalesce(1).write.parquet(f"{root}/in/{n}")
    schema = "event_id long, event_timestamp timestamp"
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
    so.stream_late_rows(reader.parquet(f"{root}/in"), f"{root}/late", f"{root}/marks", f"{root}/checkpoint", "12 hours").awaitTermination()
    late = spark.read.option("basePath", f"{root}/late").parquet(f"{root}/late/batch=*")
    return without_zone(late.select("event_id", "event_timestamp", "late_seconds"))


@contextmanager
def dying(point: str) -> Iterator[None]:
    """The first insert that reaches the point fails there."""
    before, reached = commits.reached, []

    def die(at: str) -> None:
        if at == point and not reached:
            reached.append(at)
            raise RuntimeError(f"lost at {at}")

    commits.reached = die
    try:
        yield
    finally:
        commits.reached = before


@query
def recovery(spark, sf):
    """Alerts go to two tables; the stream dies after the first of them, and is started again."""
    root = folder(spark)

    def start():
        return so.stream_alerts(replay(spark, sf), f"{root}/alerts", f"{root}/checkpoint", f"{root}/archive")

    with dying("first target"):
        query = start()
        try:
            query.awaitTermination()
        except StreamingQueryException:
            pass
    if read_committed(spark, f"{root}/alerts") is None or read_committed(spark, f"{root}/archive") is not None:
        raise AssertionError("the stream did not die between its targets")
    start().awaitTermination()
    tables = [read_committed(spark, f"{root}/{name}").select(F.lit(name).alias("table_name"), "event_id") for name in ("alerts", "archive")]
    return tables[0].unionAll(tables[1])


@query
def stream_alerts(spark, sf):
    root = folder(spark)
    so.stream_alerts(replay(spark, sf), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    written = without_zone(read_committed(spark, f"{root}/out"))
    return written.withColumn("risk_score", F.col("risk_score").cast("double")).drop("event_id", "year", "month", "day")
