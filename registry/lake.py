"""Sources and sinks: the test tables written to the lake and read back.

Files go to the folder the cluster names for checkpoints.
"""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import tables as t
from registry.queries import flat_alerts, query
from shopstream.functions import events as fe
from shopstream.operators import aggregates as agg
from shopstream.operators import validation as val
from shopstream.plans import master, medallion, reports
from shopstream.sources import readers, sinks
from shopstream.sources.commits import compact, read_committed

TOPICS = ["product-view-events", "cart-events", "checkout-events", "payment-events"]


def folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster names for checkpoints; a local one only where none
    is named and Spark runs inside one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="shopstream-")
    return f"{root.rstrip('/')}/run-{uuid.uuid4().hex}"


def write_bronze(spark: SparkSession, sf: str, root: str) -> None:
    """Events as JSON lines in one directory per topic; every line on product 7 is cut short."""
    rows = val.route_by_type(t.events(spark, sf)).select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00Z'").alias("event_timestamp"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("product_id").cast("string").alias("product_id"),
        "amount",
        "payment_method",
        "payment_status",
        "topic",
    )
    line = F.to_json(F.struct(*[c for c in rows.columns if c != "topic"]))
    lines = rows.select("topic", F.when(F.col("product_id") == "7", F.substring(line, 1, 30)).otherwise(line).alias("value"))
    for topic in TOPICS:
        lines.filter(F.col("topic") == topic).select("value").write.text(f"{root}/{topic}")


def parsed(events: DataFrame) -> DataFrame:
    return events.select("event_id", "customer_id", "amount", "payment_method", "topic", F.col("_corrupt").isNull().alias("fits"))


@query
def read_events(spark, sf):
    root = folder(spark)
    write_bronze(spark, sf, root)
    return parsed(readers.read_events(spark, root))


@query
def stream_events(spark, sf):
    root = folder(spark)
    write_bronze(spark, sf, f"{root}/in")
    df = parsed(readers.stream_events(spark, f"{root}/in", max_files=3))
    writer = df.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{root}/out")


@query
def valid_events(spark, sf):
    """Raw lines to valid and typed events, by way of the written table of checked events."""
    root = folder(spark)
    lake = medallion.Lake(root)
    write_bronze(spark, sf, lake.bronze())
    valid, _ = medallion.check_events(spark, lake)
    stamp = t.utc(F.col("event_timestamp"))
    return medallion.typed(valid).select("event_id", stamp.alias("event_timestamp"), "customer_id", "amount", "topic")


@query
def for_hour(spark, sf):
    path = folder(spark)
    sinks.write_partitioned(t.events(spark, sf).select("event_id", "event_timestamp", "amount"), path, grain="day")
    day = val.for_hour(spark.read.parquet(path), datetime(2024, 1, 10), "day")
    return day.select("event_id", "event_timestamp", "amount")


@query
def write_partitioned(spark, sf):
    path = folder(spark)
    rows = t.events(spark, sf).select("event_id", "event_timestamp", "event_type")
    sinks.write_partitioned(rows, path, grain="day", by=["event_type"])
    written = spark.read.parquet(path)
    parts = [F.col(c).cast("long").alias(c) for c in ("year", "month", "day")]
    return written.groupBy("event_type", *parts).agg(F.count("*").alias("events"))


@query
def read_lake_table(spark, sf):
    path = folder(spark)
    t.of_type(spark, sf, "add_to_cart").select("event_id", "product_id").write.parquet(f"{path}/carts")
    t.payments(spark, sf).select("payment_method", "event_id").write.parquet(f"{path}/deep/payments")
    return readers.read_lake_table(spark, path).select("event_id", "product_id", "payment_method")


@query
def read_master_csv(spark, sf):
    path = folder(spark)
    t.table(spark, sf, "part").write.option("header", "true").csv(path)
    schema = T.StructType([T.StructField("p_retailprice", T.DoubleType()), T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType())])
    return readers.read_master_csv(spark, path, schema)


@query
def write_report(spark, sf):
    path = folder(spark)
    for rows in (t.orders(spark, sf), t.products(spark, sf)):
        sinks.write_report(rows, path)
    return spark.read.parquet(path)


@query
def export_json_sample(spark, sf):
    path = folder(spark)
    sinks.export_json_sample(t.customers(spark, sf), path, "customer_id", 200)
    return spark.read.schema("customer_id long, loyalty_tier string, city string, state_code string, country string").json(path)


@query
def write_rejects(spark, sf):
    path = folder(spark)
    _, rejected = val.split_valid(t.dirty(spark, sf))
    sinks.write_rejects(rejected, path)
    schema = T.StructType([f for f in rejected.schema.fields if f.name != "failed_at"])
    return spark.read.schema(schema).json(path).select(*schema.names)


@query
def insert_if_absent(spark, sf):
    """Alerts of even customers first, then all: the first insert of an alert stays."""
    path = folder(spark)
    alerts = val.failed_payment_alerts(t.payments(spark, sf), keep_key=True).select("event_id", "event_timestamp", "customer_id")
    first = alerts.filter(F.col("customer_id").cast("long") % 2 == 0).withColumn("batch", F.lit("first"))
    for rows in (first, alerts.withColumn("batch", F.lit("second")), first):
        sinks.insert_if_absent(rows, path, "event_id")
    return read_committed(spark, path)


@query
def insert_two_writers(spark, sf):
    """Two writers at once, each with payments that the other has as well, four batches each; a
    compaction in between."""
    path = folder(spark)
    payments = t.payments(spark, sf).select("event_id", "event_timestamp", "customer_id")

    def write(writer: int) -> None:
        for batch in range(4):
            mine = payments.filter((F.col("event_id") % 3 != writer) & (F.col("event_id") % 4 == (batch + writer) % 4))
            sinks.insert_if_absent(mine.withColumns(fe.time_partitions(F.col("event_timestamp"), "month")), path, "event_id", partition_by=["year", "month"])

    for again in range(2):
        with ThreadPoolExecutor(2) as pool:
            list(pool.map(write, range(2)))
        while not again and not compact(spark, path):
            pass
    return read_committed(spark, path).select("event_id", "event_timestamp", "customer_id")


@query
def write_multi(spark, sf):
    path = folder(spark)
    alerts = flat_alerts(spark, sf)
    sinks.write_multi(alerts, [lambda df: sinks.write_report(df, f"{path}/a"), lambda df: df.write.json(f"{path}/b")])
    back = spark.read.schema(alerts.select("alert_id", "risk_score").schema).json(f"{path}/b")
    return spark.read.parquet(f"{path}/a").select("alert_id", "risk_score").unionByName(back)


@query
def read_first_available(spark, sf):
    path = folder(spark)
    spark.range(0).write.parquet(f"{path}/empty")
    sources = [lambda s: s.read.parquet(f"{path}/absent"), lambda s: s.read.parquet(f"{path}/empty"), lambda s: t.orders(s, sf)]
    return readers.read_first_available(spark, sources)


@query
def load_master(spark, sf):
    """Raw files made from the test tables, then the product table built from them."""
    root = folder(spark)
    part, items = t.table(spark, sf, "part"), t.items(spark, sf)
    size = F.col("p_size").cast("double")
    raw = {
        "customers": t.customers(spark, sf).select(
            "customer_id", F.col("customer_id").alias("customer_unique_id"), F.col("city").alias("customer_city"), F.col("state_code").alias("customer_state")
        ),
        "products": part.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_category_name"),
            *[size.alias(f"product_{c}") for c in ("weight_g", "length_cm", "height_cm", "width_cm")],
        ),
        "sellers": t.sellers(spark, sf).select("seller_id", F.col("seller_name").alias("seller_city"), F.col("state").alias("seller_state")),
        "translation": part.select(F.col("p_type").alias("product_category_name"), F.lower("p_type").alias("product_category_name_english")).distinct(),
        "items": items.select((F.col("product_id") + 100).alias("product_id"), F.col("line_total").alias("price")),
    }
    for name, df in raw.items():
        df.write.option("header", "true").csv(f"{root}/raw/{master.FILES[name]}")
    paths = master.load_master(spark, f"{root}/raw", f"{root}/master")
    return spark.read.parquet(paths["products"]).select("product_id", "category", "brand", "unit_price", "currency", "product_weight_g")


@query
def uuid_format(spark, sf):
    """Ids made from a hash; every type but one keeps its dashes."""
    digest = F.md5(F.col("event_id").cast("string"))
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    written = F.when(F.col("event_type") == "add_to_cart", digest).otherwise(F.concat_ws("-", *parts))
    rows = t.events(spark, sf).select(written.alias("event_id"), "event_type")
    return val.tag_rejects(rows, [val.uuid_format()])


# Whole lakes: raw lines of orders, carts, checkouts and payments, master tables, and the runs over them.

CUT = "1996-01-01"


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as events, with ids that no other event has."""
    return t.orders(spark, sf).select(
        F.concat(F.lit("o"), "event_id").alias("event_id"),
        F.lit("order_completed").alias("event_type"),
        "event_timestamp",
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("order_id").cast("string").alias("order_id"),
        "total_amount",
    )


def write_lines(rows: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    """Events as JSON lines, every line twice."""
    stamped = rows.withColumn("event_timestamp", F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00Z'"))
    line = F.to_json(F.struct(*[c for c in stamped.columns if c not in by])).alias("value")
    lines = stamped.select(line, *by).withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
    (lines.repartition(*by) if by else lines).write.mode("append").partitionBy(*by).text(path)


def write_masters(spark: SparkSession, sf: str, lake: medallion.Lake, even_only: bool = False) -> None:
    people = t.customers(spark, sf).withColumn("customer_id", F.col("customer_id").cast("string"))
    people = people.filter(F.col("customer_id").cast("long") % 2 == 0) if even_only else people
    sinks.write_report(people, lake.master("customers"))
    products = t.products(spark, sf).withColumn("product_id", F.col("product_id").cast("string"))
    sinks.write_report(products, lake.master("products"))


def monthly(spark: SparkSession) -> medallion.Lake:
    """A lake for orders of seven years, a few a day: enriched tables by month."""
    return medallion.Lake(folder(spark), "month")


def write_lake(spark: SparkSession, sf: str, lake: medallion.Lake) -> None:
    """Orders before the cut, and payments, as raw lines; customers with even numbers only."""
    early = raw_orders(spark, sf).filter(F.col("event_timestamp") < CUT)
    write_lines(early, lake.bronze("order-events"))
    paid = t.payments(spark, sf).select(
        F.col("event_id").cast("string").alias("event_id"), "event_type", "event_timestamp", "customer_id", "amount", "payment_method", "payment_status"
    )
    write_lines(paid.withColumn("customer_id", F.col("customer_id").cast("string")), lake.bronze("payment-events"))
    for kind, topic in (("add_to_cart", "cart-events"), ("checkout_started", "checkout-events"), ("product_view", "product-view-events")):
        rows = t.of_type(spark, sf, kind).select(
            F.col("event_id").cast("string").alias("event_id"), "event_type", "event_timestamp", F.col("customer_id").cast("string").alias("customer_id"), F.col("product_id").cast("string").alias("product_id")
        )
        write_lines(rows, lake.bronze(topic))
    write_masters(spark, sf, lake, even_only=True)


def worked_off(spark: SparkSession, lake: medallion.Lake) -> None:
    """One run of the pipeline over what is there; a query that fails fails this one."""
    from shopstream.streaming.pipeline import run_pipeline

    for name, query in run_pipeline(spark, lake, once=True, checkpoints=f"{lake.root}/checkpoints").items():
        if isinstance(query, Exception):
            raise RuntimeError(f"pipeline query {name} failed") from query


@query
def run_pipeline(spark, sf):
    """Every raw line comes twice, and the customers are replaced between two runs of the pipeline."""
    lake = monthly(spark)
    write_lake(spark, sf, lake)
    worked_off(spark, lake)
    write_masters(spark, sf, lake)
    write_lines(raw_orders(spark, sf).filter(F.col("event_timestamp") >= CUT), lake.bronze("order-events"))
    worked_off(spark, lake)
    orders = spark.read.parquet(lake.live("enriched-orders"))
    return orders.select("event_id", "customer_id", "total_amount", "loyalty_tier")


@query
def lake_batch_and_stream(spark, sf):
    """Batch and pipeline over one lake by turns: revenue per hour and alerts, each once."""
    lake = monthly(spark)
    write_lake(spark, sf, lake)
    medallion.run_batch(spark, lake)
    worked_off(spark, lake)
    write_lines(raw_orders(spark, sf).filter(F.col("event_timestamp") >= CUT), lake.bronze("order-events"))
    worked_off(spark, lake)
    medallion.run_batch(spark, lake)
    hours = reports.lake_revenue(spark, lake)
    start = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("name")
    alerts = read_committed(spark, lake.gold("fraud_alerts_log"))
    rows = hours.select(F.lit("revenue").alias("kind"), start, F.col("revenue").alias("value"))
    return rows.unionAll(alerts.select(F.lit("alert"), "event_id", F.lit(1.0)))


@query
def dashboard(spark, sf):
    """Panels of a lake that only the pipeline has written to."""
    lake = monthly(spark)
    write_lake(spark, sf, lake)
    worked_off(spark, lake)
    panels = reports.dashboard(spark, lake)
    carts, alerts = panels["cart_abandonment"], panels["alert_count"]
    names = ("total_carts_initiated", "total_checkouts_completed", "cart_abandonment_percentage")
    values = F.explode(F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n).cast("double") for n in names])))
    return carts.select(values.alias("name", "value")).unionAll(alerts.select(F.lit("alerts"), F.col("total").cast("double")))


@query
def enriched_payments(spark, sf):
    """The silver table of payments, from raw lines that all come twice."""
    lake = monthly(spark)
    write_lake(spark, sf, lake)
    medallion.to_silver(spark, lake)
    return spark.read.parquet(lake.silver("enriched-payments")).select("event_id", "customer_id", "payment_method", "loyalty_tier")


@query
def rolled_up_revenue(spark, sf):
    """Revenue per month from the hourly rows of the orders, as kept in a table."""
    path = folder(spark)
    sinks.write_report(agg.revenue_by_window(t.orders(spark, sf)), path)
    months = agg.rolled_up_revenue(spark.read.parquet(path), "month")
    return months.withColumn("period", F.date_format("period", "yyyy-MM"))


@query
def views_trend(spark, sf):
    """Product views per day."""
    days = agg.views_trend(t.of_type(spark, sf, "product_view"), "1 day")
    return days.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


HOURS = [datetime(2024, 1, 10, h) for h in (5, 6, 7)]


@query
def run_hour(spark, sf):
    """Three hours one by one, one of them twice."""
    lake = medallion.Lake(folder(spark))
    write_masters(spark, sf, lake)
    for kind, topic in (("add_to_cart", "cart-events"), ("product_view", "product-view-events")):
        rows = t.of_type(spark, sf, kind).select(
            F.col("event_id").cast("string").alias("event_id"), "event_type", "event_timestamp", F.col("customer_id").cast("string").alias("customer_id"), F.col("product_id").cast("string").alias("product_id")
        )
        rows = rows.withColumns(fe.time_partitions(F.col("event_timestamp")))
        write_lines(rows, lake.bronze(topic), ("year", "month", "day", "hour"))
    for at in (*HOURS, HOURS[0]):
        medallion.run_hour(spark, lake, at, ["cart-events", "product-view-events"])
    events = spark.read.parquet(f"{lake.root}/hourly/events")
    return events.select("event_id", "topic", "customer_id", t.utc(F.col("event_timestamp")).alias("event_timestamp"))


@query
def read_latest_write(spark, sf):
    """Two writes of several files each; the later one alone is read."""
    path = folder(spark)
    rows = t.of_type(spark, sf, "add_to_cart").select("event_id", "product_id")
    rows.repartition(3).write.parquet(f"{path}/a")
    rows.filter(F.col("product_id") % 2 == 0).repartition(4).write.parquet(f"{path}/b")
    return readers.read_lake_table(spark, path, latest_only=True).select("event_id", "product_id")
