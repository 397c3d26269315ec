"""Historical reports and the tables behind the dashboard panels."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.operators import aggregates as agg
from shopstream.operators import sets, topk
from shopstream.plans.medallion import Lake, either, of_topic, present
from shopstream.sources.commits import read_committed
from shopstream.sources.schemas import ALERT_COLUMNS
from shopstream.sources.sinks import write_report

COUNTED_TOPICS = ("order-events", "payment-events", "cart-events", "product-view-events")
REVENUE_WEIGHT = 15


def lake_volume(events: DataFrame, revenue: DataFrame) -> DataFrame:
    """Events of the counted topics, plus 15 for every revenue row."""
    counted = events.filter(F.col("topic").isin(*COUNTED_TOPICS))
    return agg.stream_volume([counted, (revenue, REVENUE_WEIGHT)])


def executive_reports(customers: DataFrame, products: DataFrame, volume: DataFrame | int) -> dict[str, DataFrame]:
    """Category and loyalty reports with the stream volume worked in."""
    return {
        "category_metrics": agg.fuse_category_volume(agg.category_summary(products), volume),
        "loyalty_demographics": agg.fuse_loyalty_volume(agg.loyalty_demographics(customers), volume),
    }


def run_reports(spark: SparkSession, lake: Lake) -> None:
    """Writes the historical reports."""
    volume = lake_volume(lake_events(spark, lake), lake_revenue(spark, lake))
    customers, products = spark.read.parquet(lake.master("customers")), spark.read.parquet(lake.master("products"))
    for name, report in executive_reports(customers, products, volume).items():
        write_report(report, lake.gold(f"executive_dashboard/{name}"))


def lake_events(spark: SparkSession, lake: Lake, since: date | None = None) -> DataFrame:
    """Valid events, each once, of the batch run and of the running pipeline: both add to one table
    what it lacks, so nothing is compared here. With a date, only days from it on; other
    directories are not read."""
    events = read_committed(spark, lake.unique_events)
    if events is None:
        raise FileNotFoundError(f"no events in {lake.root}")
    if since is not None:
        # from the first day of the directory's month or year on, where it holds more than a day
        parts = [(c, v) for c, v in (("year", since.year), ("month", since.month), ("day", since.day)) if c in events.columns]
        folder = F.lit(False)
        for k, (c, v) in reversed(list(enumerate(parts))):
            number = F.col(c).cast("int")
            folder = (number > v) | ((number == v) & (folder if k + 1 < len(parts) else F.lit(True)))
        events = events.filter(folder & (F.col("event_timestamp") >= F.lit(since).cast("timestamp")))
    return events.drop("year", "month", "day")


def lake_revenue(spark: SparkSession, lake: Lake) -> DataFrame:
    """Revenue per hour of the batch run, and of the pipeline where the batch has none."""
    return either(spark, lake.gold("revenue_per_hour"), lake.live("revenue_per_hour"), "window_start")


def lake_alerts(spark: SparkSession, lake: Lake) -> DataFrame:
    """The alert log that batch run and pipeline share; without one, no alerts."""
    alerts = read_committed(spark, lake.gold("fraud_alerts_log"))
    if alerts is None:
        kinds = {"risk_score": "decimal(5,2)", "event_timestamp": "timestamp"}
        return spark.createDataFrame([], ", ".join(f"{c} {kinds.get(c, 'string')}" for c in [*ALERT_COLUMNS, "event_id"]))
    return alerts.drop("year", "month", "day")


def dashboard(
    spark: SparkSession,
    lake: Lake,
    base_revenue: float = 0.0,
    base_orders: int = 0,
    payment_baseline: DataFrame | None = None,
    payment_aliases: Mapping[str, str] | None = None,
    since: date | None = None,
) -> dict[str, DataFrame]:
    """One DataFrame per panel; nothing runs until a panel is shown.

    Panels show what the batch run, the running pipeline or both have written; with `since`, the
    event panels read only days from that one on.
    """
    events = lake_events(spark, lake, since)
    hourly = lake_revenue(spark, lake)
    alerts = lake_alerts(spark, lake)
    total = present(lambda: spark.read.parquet(lake.gold("revenue_total")))
    if total is None:
        total = agg.revenue_kpi(of_topic(events, "order-events"))
    payments = of_topic(events, "payment-events")

    def report(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        written = present(lambda: spark.read.parquet(lake.gold(f"executive_dashboard/{name}")))
        return make() if written is None else written

    categories = report("category_metrics", lambda: agg.category_summary(spark.read.parquet(lake.master("products"))))
    segments = report("loyalty_demographics", lambda: agg.loyalty_demographics(spark.read.parquet(lake.master("customers"))))
    return {
        "latest_kpi": topk.latest_row(hourly),
        "revenue_trend": topk.kpi_trend(hourly),
        "revenue_by_day": agg.rolled_up_revenue(hourly),
        "revenue_by_month": agg.rolled_up_revenue(hourly, "month"),
        "product_views": agg.views_trend(of_topic(events, "product-view-events")),
        "average_order_value": agg.average_order_value(total, base_revenue, base_orders),
        "active_users": agg.active_users(events),
        "cart_abandonment": agg.cart_abandonment(of_topic(events, "cart-events"), of_topic(events, "checkout-events")),
        "payment_methods": agg.payment_method_counts(payments, payment_baseline, payment_aliases),
        "activity_feed": sets.activity_feed([events]),
        "alert_count": agg.alert_count(alerts),
        "latest_alerts": topk.latest_alerts(alerts),
        "top_categories": topk.top_categories(categories),
        "top_segments": topk.top_segments(segments),
    }
