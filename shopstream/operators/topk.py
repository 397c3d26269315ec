"""Ranked reports and top-k feeds; ties are always broken by the key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.operators.skew import as_list, lookup, top_per_group
from shopstream.sources.schemas import ALERT_COLUMNS


def ranking(by: str, keys: str | Sequence[str], ascending: bool = False):
    first = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return [first, *[F.col(k).asc_nulls_first() for k in as_list(keys)]]


def rank_report(df: DataFrame, by: str, keys: str | Sequence[str]) -> DataFrame:
    """The report in descending order of a measure."""
    return df.orderBy(*ranking(by, keys))


def top_categories(summary: DataFrame, n: int = 10) -> DataFrame:
    """Categories with the most products."""
    return summary.orderBy(*ranking("product_count", "category")).limit(n)


def top_segments(summary: DataFrame, n: int = 12) -> DataFrame:
    """Tier and state groups with the most customers."""
    return summary.orderBy(*ranking("total_customers", ["loyalty_tier", "state_code"])).limit(n)


def latest_alerts(alerts: DataFrame, n: int = 100) -> DataFrame:
    """The newest n alerts."""
    return alerts.select(*ALERT_COLUMNS).orderBy(F.col("event_timestamp").desc(), F.col("alert_id")).limit(n)


def latest_row(kpis: DataFrame, by: str = "window_end") -> DataFrame:
    """The last KPI row."""
    return kpis.orderBy(F.col(by).desc_nulls_last()).limit(1)


def kpi_trend(kpis: DataFrame, n: int = 30, by: str = "window_end") -> DataFrame:
    """The last n KPI rows, oldest first."""
    return kpis.orderBy(F.col(by).desc_nulls_last()).limit(n).orderBy(F.col(by).asc_nulls_first())


def head_by_key(df: DataFrame, n: int, key: str | Sequence[str]) -> DataFrame:
    """The first n rows by key."""
    return df.orderBy(*as_list(key)).limit(n)


def latest_events(
    df: DataFrame, n: int, per: Sequence[str] = ("topic",), order: Sequence[str] = ("event_timestamp", "event_id")
) -> DataFrame:
    """The newest n events, of each group (few, such as topics) or overall when `per` is empty."""
    newest = [F.col(c).desc_nulls_last() for c in order]
    return top_per_group(df, list(per), newest, n, few_groups=True) if per else df.orderBy(*newest).limit(n)


def units_sold(order_items: DataFrame) -> DataFrame:
    """Units per product."""
    return order_items.groupBy("product_id").agg(F.sum("quantity").cast("long").alias("units"))


def top_products(order_items: DataFrame, n: int = 20) -> DataFrame:
    """Best sellers by units."""
    return units_sold(order_items).orderBy(*ranking("units", "product_id")).limit(n)


def slow_movers(order_items: DataFrame, products: DataFrame, n: int = 20) -> DataFrame:
    """Worst sellers by units; a product never sold has zero."""
    sold = lookup(products.select("product_id"), units_sold(order_items), "product_id")
    counted = sold.withColumn("units", F.coalesce("units", F.lit(0).cast("long")))
    return counted.orderBy(*ranking("units", "product_id", ascending=True)).limit(n)


def trending_products(views: DataFrame, window: str = "1 day", n: int = 5) -> DataFrame:
    """The n most viewed products of every time window."""
    counted = views.groupBy(F.window("event_timestamp", window).alias("_w"), "product_id").agg(F.count("*").alias("views"))
    flat = counted.select(F.col("_w.start").alias("window_start"), "product_id", "views")
    return top_per_group(flat, "window_start", ranking("views", "product_id"), n)
