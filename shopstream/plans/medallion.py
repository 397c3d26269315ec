"""The batch way through the lake: raw events, valid and enriched events, measures and alerts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.functions.events import normalize_event_time, time_partitions
from shopstream.operators import aggregates as agg
from shopstream.operators.joins import enrich_orders, enrich_payments, enrich_views
from shopstream.operators.validation import (
    REASON,
    STANDARD_RULES,
    drop_duplicate_events,
    failed_payment_alerts,
    iso_timestamp,
    parses_as_schema,
    tag_rejects,
)
from shopstream.sources.readers import read_events
from shopstream.sources.schemas import CORRUPT
from shopstream.sources.sinks import insert_if_absent, write_partitioned, write_report

# Malformed lines are told apart before their (then empty) fields are judged.
LAKE_RULES = (parses_as_schema(), *STANDARD_RULES, iso_timestamp())


@dataclass(frozen=True)
class Lake:
    """Directories of one lake. The grain is that of the directories of the enriched tables: with
    few events an hour, coarser ones spare thousands of small files."""

    root: str
    grain: str = "hour"

    @property
    def event_grain(self) -> str:
        """The grain of the event tables: a day, or coarser where the enriched tables are."""
        return "day" if self.grain == "hour" else self.grain

    def bronze(self, topic: str = "") -> str:
        return f"{self.root}/bronze/{topic}".rstrip("/")

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    def live(self, table: str) -> str:
        """What the running pipeline writes; the batch run never touches it."""
        return f"{self.root}/live/{table}"

    @property
    def unique_events(self) -> str:
        """Valid events, each once, of batch run and pipeline together."""
        return f"{self.root}/unique-events"

    def master(self, table: str) -> str:
        return f"{self.root}/master/{table}.parquet"

    @property
    def rejects(self) -> str:
        return f"{self.root}/dead-letter-events"


def typed(valid: DataFrame) -> DataFrame:
    """Valid events with the event time as TIMESTAMP."""
    return valid.drop(CORRUPT).withColumn("event_timestamp", normalize_event_time(F.col("event_timestamp")))


def of_topic(events: DataFrame, topic: str) -> DataFrame:
    return events.filter(F.col("topic") == topic)


def check_events(spark: SparkSession, lake: Lake) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) raw events, read back from one written table.

    The JSON text is parsed in a single pass, whose result goes to two directories; the
    steps after it read columns, and only their own directory.
    """
    tagged = tag_rejects(read_events(spark, lake.bronze()), LAKE_RULES)
    checked = tagged.withColumns({"failed_at": F.current_timestamp(), "accepted": F.col(REASON).isNull()})
    checked.write.mode("overwrite").partitionBy("accepted").parquet(lake.silver("checked-events"))
    table = spark.read.parquet(lake.silver("checked-events"))
    accepted = F.col("accepted").cast("boolean")
    valid = table.filter(accepted).drop("accepted", REASON, "failed_at")
    return valid, table.filter(~accepted).drop("accepted")


def to_silver(spark: SparkSession, lake: Lake) -> None:
    """Validates, deduplicates and enriches all raw events."""
    valid, rejected = check_events(spark, lake)
    write_partitioned(rejected, lake.rejects, "failed_at", "hour", "json", "overwrite")
    unique = drop_duplicate_events(typed(valid), keep_null_keys=False)
    write_partitioned(unique, lake.silver("events"), grain=lake.event_grain, mode="overwrite", by=["topic"])
    events = spark.read.parquet(lake.silver("events"))
    add_unique_events(events.drop("year", "month", "day"), lake, placed=True)
    customers, products = spark.read.parquet(lake.master("customers")), spark.read.parquet(lake.master("products"))
    events = events.drop("year", "month", "day")
    orders = enrich_orders(of_topic(events, "order-events"), customers)
    write_partitioned(orders, lake.silver("enriched-orders"), grain=lake.grain, mode="overwrite")
    views = enrich_views(of_topic(events, "product-view-events"), products)
    write_partitioned(views, lake.silver("customer-events"), grain=lake.grain, mode="overwrite")
    payments = enrich_payments(of_topic(events, "payment-events"), customers)
    write_partitioned(payments, lake.silver("enriched-payments"), grain=lake.grain, mode="overwrite")
    reviews = enrich_views(of_topic(events, "review-events"), products)
    write_partitioned(reviews, lake.silver("enriched-reviews"), grain=lake.grain, mode="overwrite")


def add_unique_events(events: DataFrame, lake: Lake, placed: bool = False) -> None:
    """Adds the events that the table of unique events lacks. Only the days that they fall in are
    asked. Copies of an event carry its time, so they lie in one day. `placed` as for
    `insert_if_absent`."""
    parts = time_partitions(F.col("event_timestamp"), lake.event_grain)
    insert_if_absent(events.withColumns(parts), lake.unique_events, "event_id", partition_by=["topic", *parts], placed=placed)


def to_gold(spark: SparkSession, lake: Lake) -> None:
    """Measures and alerts from the valid events."""
    events = spark.read.parquet(lake.silver("events"))
    orders = spark.read.parquet(lake.silver("enriched-orders"))
    write_report(agg.revenue_kpi(orders), lake.gold("revenue_total"))
    write_report(agg.revenue_by_window(orders, "1 hour"), lake.gold("revenue_per_hour"))
    abandonment = agg.cart_abandonment(of_topic(events, "cart-events"), of_topic(events, "checkout-events"))
    write_report(abandonment, lake.gold("cart_abandonment"))
    alerts = failed_payment_alerts(of_topic(events, "payment-events"), keep_key=True)
    daily = alerts.withColumns(time_partitions(F.col("event_timestamp"), "day"))
    insert_if_absent(daily, lake.gold("fraud_alerts_log"), "event_id", partition_by=["year", "month", "day"])


def run_batch(spark: SparkSession, lake: Lake) -> None:
    """One full run."""
    to_silver(spark, lake)
    to_gold(spark, lake)


def named_in(master: DataFrame, key: str, events: DataFrame) -> DataFrame:
    """The rows of a master table that some event names. For few events beside a large table: what
    is sent to join them then grows with the events."""
    return master.join(events.select(key).distinct(), key, "left_semi")


#: Topics that the hourly run carries into silver.
HOURLY_TOPICS = ("order-events", "product-view-events", "cart-events", "checkout-events", "payment-events", "review-events")


def run_hour(spark: SparkSession, lake: Lake, at: datetime, topics: Sequence[str] = HOURLY_TOPICS) -> None:
    """One hour of the raw events into the hourly tables: `events`, `enriched-orders`, `views`,
    `payments`, `reviews`, `revenue` and `cart_abandonment` below `hourly/`, and new alerts.

    Only the hour's directories are listed and read, and only those are replaced, so running an
    hour again changes nothing and the run does not grow with history. The hours, run one by one in any
    order, make the same tables as all at once, as far as copies of an event lie in one hour.
    """
    raw = read_events(spark, lake.bronze(), topics, at).drop("year", "month", "day", "hour")
    tagged = tag_rejects(raw, LAKE_RULES)
    hour = at.strftime("year=%Y/month=%m/day=%d/hour=%H")

    def replace(df: DataFrame, table: str, by: Sequence[str] = ()) -> DataFrame:
        """Writes the hour's directory of a table and reads it back."""
        path = f"{lake.root}/hourly/{table}/{hour}"
        df.write.mode("overwrite").partitionBy(*by).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    checked = replace(tagged.withColumn("accepted", F.col(REASON).isNull()), "checked-events", ["accepted"])
    valid = checked.filter(F.col("accepted")).drop("accepted", REASON)
    events = replace(drop_duplicate_events(typed(valid), keep_null_keys=False), "events", ["topic"])
    customers, products = spark.read.parquet(lake.master("customers")), spark.read.parquet(lake.master("products"))

    def enriched(enrich: Callable[[DataFrame, DataFrame], DataFrame], topic: str, master: DataFrame, key: str, table: str) -> DataFrame:
        rows = of_topic(events, topic)
        return replace(enrich(rows, named_in(master, key, rows)), table)

    orders = enriched(enrich_orders, "order-events", customers, "customer_id", "enriched-orders")
    enriched(enrich_views, "product-view-events", products, "product_id", "views")
    enriched(enrich_payments, "payment-events", customers, "customer_id", "payments")
    enriched(enrich_views, "review-events", products, "product_id", "reviews")
    replace(agg.revenue_by_window(orders, "1 hour"), "revenue")
    replace(agg.cart_abandonment(of_topic(events, "cart-events"), of_topic(events, "checkout-events"), at), "cart_abandonment")
    alerts = failed_payment_alerts(of_topic(events, "payment-events"), keep_key=True)
    daily = alerts.withColumns(time_partitions(F.col("event_timestamp"), "day"))
    insert_if_absent(daily, lake.gold("fraud_alerts_log"), "event_id", partition_by=["year", "month", "day"])


def present(reader: Callable[[], DataFrame]) -> DataFrame | None:
    """The table, or None where nothing has written it yet."""
    try:
        return reader()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def either(spark: SparkSession, first: str, second: str, key: str) -> DataFrame:
    """The rows of two tables, of which one may not be there; of a key in both, the first's."""
    tables = [t for t in (present(lambda p=p: spark.read.parquet(p)) for p in (first, second)) if t is not None]
    if not tables:
        raise FileNotFoundError(f"neither {first} nor {second} is written yet")
    if len(tables) == 1:
        return tables[0]
    one, two = tables
    columns = [c for c in one.columns if c in two.columns]
    return one.select(*columns).unionByName(two.select(*columns).join(one.select(key), key, "left_anti"))
