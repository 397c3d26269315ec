"""One query per operator, on the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import tables as t
from shopstream.functions import alerts as fa
from shopstream.functions import events as fe
from shopstream.functions import hashing as fh
from shopstream.functions import money as fm
from shopstream.functions import text as ft
from shopstream.operators import aggregates as agg
from shopstream.operators import joins, sets, topk, windows
from shopstream.operators import validation as val

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def as_of() -> Column:
    return F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")


def flat_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts with the score as a double."""
    found = val.failed_payment_alerts(t.payments(spark, sf))
    return found.withColumn("risk_score", F.col("risk_score").cast("double"))


def volume(spark: SparkSession, sf: str) -> DataFrame:
    daily = agg.revenue_by_period(t.orders(spark, sf), "day")
    return agg.stream_volume([t.events(spark, sf), t.orders(spark, sf), (daily, 15)])


def brands(spark: SparkSession, sf: str) -> DataFrame:
    """Products with the brand as category: more categories than the fused report changes."""
    return t.products(spark, sf).withColumn("category", F.col("brand"))


# Projections, filters, validation


@query
def required(spark, sf):
    return val.tag_rejects(t.dirty(spark, sf), [val.required(["event_id", "event_timestamp"])])


@query
def in_range(spark, sf):
    return val.tag_rejects(t.dirty(spark, sf), [val.in_range()])


@query
def non_finite_amounts(spark, sf):
    """Some amounts are infinite or not a number: they are rejected, and count as nothing in sums."""
    k = F.col("event_id") % 5
    value = F.when(k == 0, F.lit(float("inf"))).when(k == 1, F.lit(float("nan"))).when(k == 2, F.lit(float("-inf"))).otherwise(F.col("amount"))
    rows = val.tag_rejects(t.events(spark, sf).select("event_id", value.alias("amount")), [val.in_range()])
    return rows.groupBy(k.alias("k"), "dlq_reason").agg(F.count("*").alias("n"), F.coalesce(F.sum(fm.cents("amount")), F.lit(0)).cast("long").alias("cents"))


@query
def whole_decimals(spark, sf):
    """Quantities written as 2.0 are 2; halves do not fit."""
    half = F.when(F.col("event_id") % 7 == 0, ".5").otherwise(".0")
    line = F.concat(F.lit('{"event_id":"'), F.col("event_id"), F.lit('","quantity":'), F.col("quantity"), half, F.lit("}"))
    parsed = fe.parse_payload(t.events(spark, sf).select(line.alias("value")))
    return parsed.select("event_id", "quantity", F.col("_corrupt").alias("line"))


@query
def tag_rejects(spark, sf):
    return val.tag_rejects(t.dirty(spark, sf))


@query
def split_valid(spark, sf):
    return val.split_valid(t.dirty(spark, sf))[0]


@query
def split_rejected(spark, sf):
    return val.split_valid(t.dirty(spark, sf))[1].drop("failed_at")


@query
def known_type(spark, sf):
    return val.tag_rejects(t.dirty(spark, sf), [val.known_type(known=("view", "click", "purchase"))])


@query
def exists_in(spark, sf):
    return val.tag_rejects(t.dirty(spark, sf), [val.exists_in(t.customers(spark, sf), "customer_id")])


@query
def drop_duplicate_events(spark, sf):
    return val.drop_duplicate_events(t.dirty(spark, sf))


@query
def failed_payments(spark, sf):
    return val.failed_payments(t.events(spark, sf)).select("event_id", "customer_id", "amount", "payment_method")


@query
def route_by_type(spark, sf):
    return val.route_by_type(t.events(spark, sf)).select("event_id", "event_type", "topic")


@query
def project(spark, sf):
    spec = {"id": "event_id", "amount_cents": fm.cents("amount"), "currency": F.lit("BRL"), "device": "device"}
    return val.project(t.events(spark, sf), spec)


@query
def failed_payment_alerts(spark, sf):
    return flat_alerts(spark, sf)


# Joins


@query
def enrich_orders(spark, sf):
    return joins.enrich_orders(t.orders(spark, sf), t.customers(spark, sf))


@query
def enrich_views(spark, sf):
    views = t.of_type(spark, sf, "product_view").select(
        "event_id", "event_timestamp", "customer_id", "product_id", F.col("device").alias("category")
    )
    return joins.enrich_views(views, t.products(spark, sf))


@query
def translate_category(spark, sf):
    part = t.table(spark, sf, "part")
    raw = part.select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name"))
    english = F.when(F.col("p_type") != "ECONOMY", F.lower("p_type"))
    pairs = part.select(F.col("p_type").alias("product_category_name"), english.alias("product_category_name_english"))
    return joins.translate_category(raw, pairs.distinct())


@query
def attach_prices(spark, sf):
    sold = t.items(spark, sf).select((F.col("product_id") + 100).alias("product_id"), F.col("line_total").alias("price"))
    return joins.attach_prices(t.products(spark, sf).select("product_id", "category"), sold)


@query
def build_inventory(spark, sf):
    return joins.build_inventory(t.products(spark, sf))


@query
def enrich_payments(spark, sf):
    paid = t.payments(spark, sf).select("event_id", "customer_id", "amount", "payment_status")
    return joins.enrich_payments(paid, t.customers(spark, sf))


@query
def enrich_order_items(spark, sf):
    return joins.enrich_order_items(t.items(spark, sf), t.products(spark, sf), t.sellers(spark, sf))


@query
def enrich_inventory(spark, sf):
    return joins.enrich_inventory(t.inventory(spark, sf), t.warehouses(spark, sf))


@query
def abandoned_carts(spark, sf):
    carts = t.of_type(spark, sf, "add_to_cart").select("event_id", "customer_id", "event_timestamp", "product_id")
    return joins.abandoned_carts(carts, t.of_type(spark, sf, "checkout_started"), 86_400)


@query
def orphans(spark, sf):
    return joins.orphans(t.orders(spark, sf), t.customers(spark, sf), "customer_id")


@query
def orders_with_master(spark, sf):
    return joins.orphans(t.orders(spark, sf), t.customers(spark, sf), "customer_id", known=True)


# Aggregations


@query
def revenue_kpi(spark, sf):
    return agg.revenue_kpi(t.orders(spark, sf), as_of())


@query
def cart_abandonment(spark, sf):
    carts, checkouts = t.of_type(spark, sf, "add_to_cart", "product_view"), t.of_type(spark, sf, "checkout_started")
    return agg.cart_abandonment(carts, checkouts, as_of())


@query
def category_summary(spark, sf):
    return agg.category_summary(t.products(spark, sf))


@query
def loyalty_demographics(spark, sf):
    return agg.loyalty_demographics(t.customers(spark, sf))


@query
def payment_method_counts(spark, sf):
    base = [("Credit Card", 720), ("Boleto (Bank Invoice)", 160), ("Pix / Instant", 90), ("Voucher", 30)]
    aliases = {"Boleto": "Boleto (Bank Invoice)", "Pix": "Pix / Instant"}
    baseline = spark.createDataFrame(base, "payment_method string, payments long")
    return agg.payment_method_counts(t.payments(spark, sf), baseline, aliases)


@query
def alert_count(spark, sf):
    return agg.alert_count(flat_alerts(spark, sf))


@query
def mean_price(spark, sf):
    return joins.mean_price(t.items(spark, sf).withColumnRenamed("line_total", "price"))


@query
def stream_volume(spark, sf):
    return volume(spark, sf)


@query
def fuse_category_volume(spark, sf):
    return agg.fuse_category_volume(agg.category_summary(brands(spark, sf)), volume(spark, sf))


@query
def fuse_loyalty_volume(spark, sf):
    return agg.fuse_loyalty_volume(agg.loyalty_demographics(t.customers(spark, sf)), volume(spark, sf))


@query
def average_order_value(spark, sf):
    return agg.average_order_value(agg.revenue_kpi(t.orders(spark, sf)), 142850.50, 1842)


@query
def revenue_by_day(spark, sf):
    return agg.revenue_by_period(t.orders(spark, sf), "day")


@query
def revenue_by_week(spark, sf):
    return agg.revenue_by_period(t.orders(spark, sf), "week")


@query
def revenue_by_month(spark, sf):
    return agg.revenue_by_period(t.orders(spark, sf), "month")


@query
def revenue_by_window(spark, sf):
    paid = t.of_type(spark, sf, "payment_completed").withColumnRenamed("amount", "total_amount")
    return agg.revenue_by_window(paid, "1 hour")


@query
def revenue_by_window_and_tier(spark, sf):
    """Validate, deduplicate, enrich, aggregate: the whole way from raw events to a report."""
    valid, _ = val.split_valid(t.dirty(spark, sf))
    unique = val.drop_duplicate_events(valid, keep_null_keys=False)
    enriched = joins.enrich_orders(unique.withColumnRenamed("amount", "total_amount"), t.customers(spark, sf))
    return agg.revenue_by_window(enriched, "1 hour", ["loyalty_tier"])


@query
def customer_lifetime_value(spark, sf):
    return agg.customer_lifetime_value(t.orders(spark, sf))


@query
def conversion_rate(spark, sf):
    sessions = agg.session_stats(t.session_events(spark, sf))
    return agg.conversion_rate(t.of_type(spark, sf, "payment_completed"), sessions)


@query
def payment_success_rate(spark, sf):
    return agg.payment_success_rate(t.payments(spark, sf))


@query
def payment_success_by_method(spark, sf):
    return agg.payment_success_rate(t.payments(spark, sf), ["payment_method"])


@query
def average_basket_size(spark, sf):
    return agg.average_basket_size(t.items(spark, sf))


@query
def active_users(spark, sf):
    return agg.active_users(t.session_events(spark, sf), "1 hour")


@query
def new_vs_returning(spark, sf):
    return agg.new_vs_returning(t.orders(spark, sf), "month")


STEPS = ["product_view", "add_to_cart", "checkout_started", "payment_completed"]


@query
def conversion_funnel(spark, sf):
    return agg.conversion_funnel(t.events(spark, sf), STEPS)


@query
def conversion_funnel_strict(spark, sf):
    return agg.conversion_funnel(t.events(spark, sf), STEPS, strict=True)


@query
def product_conversion(spark, sf):
    return agg.product_conversion(t.of_type(spark, sf, "product_view"), t.items(spark, sf))


@query
def session_stats(spark, sf):
    return agg.session_stats(t.session_events(spark, sf))


@query
def session_histogram(spark, sf):
    return agg.session_histogram(agg.session_stats(t.session_events(spark, sf)), 60)


@query
def inventory_status(spark, sf):
    return agg.inventory_status(t.inventory(spark, sf), 1200)


@query
def share_by_device(spark, sf):
    return agg.share_by(t.events(spark, sf), "device")


@query
def share_by_state(spark, sf):
    enriched = joins.enrich_orders(t.orders(spark, sf), t.customers(spark, sf))
    return agg.share_by(enriched, "state_code")


@query
def sales_heatmap(spark, sf):
    paid = t.of_type(spark, sf, "payment_completed").withColumnRenamed("amount", "total_amount")
    return agg.sales_heatmap(paid)


@query
def sales_by_month_of_year(spark, sf):
    return agg.sales_heatmap(t.orders(spark, sf), ["month"])


@query
def reject_summary(spark, sf):
    return agg.reject_summary(val.split_valid(t.dirty(spark, sf))[1], ["dlq_reason", "event_type"])


@query
def event_throughput(spark, sf):
    return agg.event_throughput(val.route_by_type(t.events(spark, sf)), "1 hour")


@query
def failure_trend(spark, sf):
    return agg.failure_trend(t.payments(spark, sf), "1 day")


@query
def high_risk(spark, sf):
    return agg.high_risk(flat_alerts(spark, sf), "customer_id", 2)


@query
def alerts_by_region(spark, sf):
    return agg.alerts_by_region(flat_alerts(spark, sf), t.customers(spark, sf))


@query
def revenue_by_category(spark, sf):
    return agg.revenue_by(t.items(spark, sf), t.products(spark, sf), "product_id", "category")


@query
def revenue_by_country(spark, sf):
    return agg.revenue_by(t.orders(spark, sf), t.customers(spark, sf), "customer_id", "country", "total_amount")


@query
def availability_rollup(spark, sf):
    return agg.availability_rollup(t.inventory(spark, sf), t.warehouses(spark, sf))


@query
def availability_by_region(spark, sf):
    return agg.availability_rollup(t.inventory(spark, sf), t.warehouses(spark, sf), "region")


@query
def alert_timeline(spark, sf):
    return agg.alert_timeline(flat_alerts(spark, sf), "1 day")


@query
def revenue_distribution(spark, sf):
    return agg.revenue_distribution(t.orders(spark, sf), 10_000)


# Windows


@query
def report_position(spark, sf):
    """Position of each category in the ranked report, counted from 0."""
    return agg.with_position(agg.category_summary(brands(spark, sf)), "product_count", "category").select("category", "position")


@query
def latest_row(spark, sf):
    return topk.latest_row(agg.revenue_by_window(t.orders(spark, sf), "1 day"))


@query
def running_revenue(spark, sf):
    return windows.running_revenue(agg.revenue_by_period(t.orders(spark, sf), "month"))


@query
def consecutive_failures(spark, sf):
    return windows.consecutive_failures(t.payments(spark, sf), 3)


@query
def rapid_failure_alerts(spark, sf):
    found = windows.rapid_failure_alerts(t.payments(spark, sf), 2, 43_200)
    return found.withColumn("risk_score", F.col("risk_score").cast("double"))


@query
def rapid_failures_at_one_instant(spark, sf):
    """Times are cut to the day, so that many failures of a customer fall together."""
    day = F.date_trunc("day", "event_timestamp").cast("timestamp_ntz")
    daily = t.payments(spark, sf).withColumn("event_timestamp", day)
    return windows.rapid_failures(daily, 2, 43_200).select("event_id", "customer_id", "event_timestamp")


@query
def assign_sessions(spark, sf):
    clicks = t.events(spark, sf).select("event_id", "customer_id", "event_timestamp")
    return windows.assign_sessions(clicks, 21_600)


@query
def gap_sessions(spark, sf):
    return windows.gap_sessions(t.events(spark, sf), 21_600)


@query
def first_by_key(spark, sf):
    return val.first_by_key(t.events(spark, sf), "customer_id")


@query
def period_change(spark, sf):
    return windows.period_change(agg.revenue_by_period(t.orders(spark, sf), "month"))


# Top-k


@query
def latest_events(spark, sf):
    return topk.latest_events(val.route_by_type(t.events(spark, sf)), 50)


@query
def latest_events_overall(spark, sf):
    return topk.latest_events(t.events(spark, sf), 50, per=())


@query
def rank_report(spark, sf):
    sold = topk.units_sold(t.items(spark, sf))
    return topk.rank_report(sold, "units", "product_id")


@query
def top_categories(spark, sf):
    return topk.top_categories(agg.category_summary(brands(spark, sf)))


@query
def top_segments(spark, sf):
    return topk.top_segments(agg.loyalty_demographics(t.customers(spark, sf)))


@query
def latest_alerts(spark, sf):
    return topk.latest_alerts(flat_alerts(spark, sf))


@query
def kpi_trend(spark, sf):
    return topk.kpi_trend(agg.revenue_by_window(t.orders(spark, sf), "1 day"))


@query
def head_by_key(spark, sf):
    return topk.head_by_key(t.customers(spark, sf), 100, "customer_id")


@query
def top_products(spark, sf):
    return topk.top_products(t.items(spark, sf))


@query
def slow_movers(spark, sf):
    shifted = t.items(spark, sf).withColumn("product_id", F.col("product_id") + 10)
    return topk.slow_movers(shifted, t.products(spark, sf))


@query
def trending_products(spark, sf):
    return topk.trending_products(t.of_type(spark, sf, "product_view"))


# Set operations


@query
def concat_tables(spark, sf):
    shared = ["event_id", "customer_id", "event_timestamp"]
    carts = t.of_type(spark, sf, "add_to_cart").select(*shared, "product_id")
    paid = t.payments(spark, sf).select(*shared, "payment_method")
    return sets.concat_tables([carts, paid, carts])


@query
def activity_feed(spark, sf):
    return sets.activity_feed([t.events(spark, sf), t.orders(spark, sf).withColumn("source", F.lit("web"))])


@query
def feed_rows(spark, sf):
    dirty = t.dirty(spark, sf).withColumn("unit_price", F.col("quantity").cast("double"))
    return sets.feed_rows(dirty)


# Scalar functions


@query
def risk_score(spark, sf):
    paid = t.payments(spark, sf).select(F.col("event_id").cast("string").alias("event_id"), F.col("amount").alias("amount"))
    ordered = t.orders(spark, sf).select(F.concat(F.lit("o"), "event_id").alias("event_id"), F.col("total_amount").alias("amount"))
    score = fa.risk_score(F.col("amount"), F.col("event_id")).cast("double")
    return paid.unionByName(ordered).select("event_id", score.alias("risk_score"))


@query
def alert_id(spark, sf):
    return t.events(spark, sf).select(
        "event_id", fa.alert_id(F.col("event_id")).alias("alert_id"), fa.alert_id(F.col("event_id"), 32).alias("long_alert_id")
    )


@query
def alert_details(spark, sf):
    details = fa.alert_details(F.col("amount"), F.col("payment_method"))
    return t.payments(spark, sf).select("event_id", details.alias("details"))


@query
def default_fill(spark, sf):
    return t.dirty(spark, sf).select(
        "event_timestamp",
        ft.default_fill(F.col("event_id").cast("string"), "N/A").alias("event_id"),
        ft.default_fill(F.col("amount"), 49.99).alias("amount"),
    )


@query
def brand_name(spark, sf):
    part = t.table(spark, sf, "part")
    return part.select("p_partkey", ft.brand_name(F.col("p_type")).alias("brand"))


@query
def merchant_name(spark, sf):
    return t.table(spark, sf, "supplier").select("s_suppkey", ft.merchant_name(F.col("s_name")).alias("seller_name"))


@query
def line_value(spark, sf):
    value = fm.line_value(F.col("l_extendedprice"), F.col("l_quantity"))
    return t.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", value.alias("line_value"))


@query
def money(spark, sf):
    price = F.col("l_extendedprice")
    return t.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", fm.money(price, 1).alias("one_decimal"), fm.money(price, 0).alias("whole"), fm.cents(price).alias("cents")
    )


@query
def normalize_event_time(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    zone = F.when(F.col("event_id") % 3 == 0, "+00:00Z").when(F.col("event_id") % 3 == 1, "Z").otherwise("+00:00")
    written = F.when(F.col("event_type") == "error", "not-a-date").otherwise(F.concat(text, zone))
    parsed = t.utc(fe.normalize_event_time(written))
    return t.table(spark, sf, "events").select("event_id", parsed.alias("event_timestamp"))


@query
def explode_items(spark, sf):
    return fe.explode_items(item_orders(spark, sf))


@query
def items_total(spark, sf):
    return item_orders(spark, sf).select("order_id", "line", fe.items_total(F.col("items")).alias("total"))


def item_orders(spark, sf):
    """Each line item as an order of two lines; the seventh line has none and the sixth no array."""
    one = F.struct(F.col("l_partkey").alias("product_id"), F.col("l_linenumber").alias("quantity"), F.col("l_extendedprice").alias("price"))
    two = F.struct(F.col("l_suppkey").alias("product_id"), F.lit(1).alias("quantity"), F.col("l_quantity").alias("price"))
    both = F.array(one, two)
    items = F.when(F.col("l_linenumber") == 7, F.slice(both, 1, 0)).when(F.col("l_linenumber") != 6, both)
    rows = t.table(spark, sf, "lineitem")
    return rows.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), items.alias("items"))


@query
def payload_round_trip(spark, sf):
    rows = t.events(spark, sf).select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.col("customer_id").cast("string").alias("customer_id"),
        "amount",
        "quantity",
        "payment_method",
    )
    parsed = fe.parse_payload(fe.to_payload(rows))
    return parsed.select(*rows.columns, F.col("_corrupt").isNull().alias("fits"))


@query
def time_partitions(spark, sf):
    parts = fe.time_partitions(F.col("ts"))
    return t.table(spark, sf, "events").select("event_id", *[c.alias(n) for n, c in parts.items()])


@query
def payment_event_type(spark, sf):
    kind = fe.payment_event_type(F.col("payment_status"))
    return t.events(spark, sf).select("event_id", "payment_status", kind.alias("event_type"))


@query
def event_header(spark, sf):
    return fe.event_header(t.orders(spark, sf), "order_completed")


@query
def upgrade_event(spark, sf):
    old = t.events(spark, sf).select("event_id", F.when(F.col("quantity") > 2, "1.1").alias("event_version"))
    return fe.upgrade_event(old)


TIERS, TIER_WEIGHTS = ["Bronze", "Silver", "Gold", "Platinum"], [0.5, 0.3, 0.15, 0.05]


@query
def weighted_label(spark, sf):
    key = F.concat(F.col("c_custkey"), F.lit(":tier"))
    tier = fh.weighted_label(key, TIERS, TIER_WEIGHTS)
    year = fh.hash_integer(F.concat(F.col("c_custkey"), F.lit(":year")), 2022, 2026)
    return t.table(spark, sf, "customer").select("c_custkey", tier.alias("loyalty_tier"), year.alias("signup_year"))


@query
def hash_uniform(spark, sf):
    return t.table(spark, sf, "supplier").select("s_suppkey", fh.hash_uniform(F.col("s_suppkey"), 3.5, 5.0).alias("rating"))
