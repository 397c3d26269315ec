"""Business measures.

Totals are sums of whole cents, so they do not depend on the order of partial sums.
Every grouping combines inside the map tasks before it shuffles; measures that need a
master table are summed per key first and joined afterwards, so a best-selling product
reaches the join as one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstream.functions.money import cents, exact_mean, from_cents, money, ratio, rounded_mean
from shopstream.operators.skew import as_list, lookup
from shopstream.operators.topk import ranking
from shopstream.operators.windows import gap_sessions

# Size of the sketches of active users: two to this power.
SKETCH_LG_K = 12


def _order_measures() -> list[Column]:
    return [F.sum(cents("total_amount")).alias("_cents"), F.count("*").alias("orders")]


def _revenue_columns() -> list[Column]:
    return [
        from_cents(F.coalesce(F.col("_cents"), F.lit(0).cast("long"))).alias("revenue"),
        F.col("orders"),
        rounded_mean(F.coalesce(F.col("_cents"), F.lit(0).cast("long")), F.col("orders")).alias("average_order_value"),
    ]


def revenue_kpi(orders: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """Revenue, orders and order value of the whole input; no row for an empty one."""
    stamp = F.current_timestamp() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    revenue, n, mean = _revenue_columns()
    return (
        orders.agg(*_order_measures())
        .filter(F.col("orders") > 0)
        .select(
            stamp.alias("window_end"),
            F.lit("revenue_window_1h").alias("metric_type"),
            revenue.alias("total_revenue_brl"),
            n.alias("total_orders"),
            mean.alias("average_order_value"),
        )
    )


def _excess_rate() -> Column:
    """Carts in excess of checkouts in percent, to a tenth, rounded half up in whole numbers."""
    excess = F.greatest(F.col("_c") - F.col("_k"), F.lit(0))
    tenths = F.floor(F.try_divide(excess * 2000 + F.col("_c"), F.col("_c") * 2).cast("decimal(20,6)"))
    return F.coalesce(tenths.cast("long") / 10, F.lit(0.0)).alias("cart_abandonment_percentage")


def _carts_and_checkouts(carts: DataFrame, checkouts: DataFrame, *by: str) -> DataFrame:
    marked = carts.select(*by, F.lit(True).alias("_cart")).unionAll(checkouts.select(*by, F.lit(False).alias("_cart")))
    return marked.groupBy(*by).agg(F.count_if("_cart").alias("_c"), F.count_if(~F.col("_cart")).alias("_k"))


def cart_abandonment(carts: DataFrame, checkouts: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """Cart events, checkout events and the percentage in excess; always one row."""
    stamp = F.current_timestamp() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    return _carts_and_checkouts(carts, checkouts).select(
        stamp.alias("window_timestamp"),
        F.col("_c").alias("total_carts_initiated"),
        F.col("_k").alias("total_checkouts_completed"),
        _excess_rate(),
    )


def cart_abandonment_rates(events: DataFrame, cart: Column, checkout: Column, by: str) -> DataFrame:
    """The same for each value of a column, from events of both kinds in one table."""
    counted = events.groupBy(by).agg(F.count_if(cart).alias("_c"), F.count_if(checkout).alias("_k"))
    return counted.select(by, F.col("_c").alias("total_carts_initiated"), F.col("_k").alias("total_checkouts_completed"), _excess_rate())


def cart_abandonment_by(carts: DataFrame, checkouts: DataFrame, by: str) -> DataFrame:
    """The same for each value of a column."""
    return _carts_and_checkouts(carts, checkouts, by).select(
        by, F.col("_c").alias("total_carts_initiated"), F.col("_k").alias("total_checkouts_completed"), _excess_rate()
    )


def category_summary(products: DataFrame) -> DataFrame:
    """Products and mean price per category, largest first."""
    grouped = products.groupBy("category").agg(
        F.count("product_id").alias("product_count"), F.sum(cents("unit_price")).alias("_cents"), F.count("unit_price").alias("_n")
    )
    mean = rounded_mean(F.col("_cents"), F.col("_n")).alias("avg_unit_price")
    return grouped.select("category", "product_count", mean).orderBy(*ranking("product_count", "category"))


def loyalty_demographics(customers: DataFrame) -> DataFrame:
    """Customers per tier and state, largest first."""
    keys = ["loyalty_tier", "state_code"]
    grouped = customers.groupBy(*keys).agg(F.count("customer_id").alias("total_customers"))
    return grouped.orderBy(*ranking("total_customers", keys))


def payment_method_counts(
    payments: DataFrame, baseline: DataFrame | None = None, aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """Payments per method, with methods renamed by `aliases` and `baseline` counts added."""
    method = F.col("payment_method")
    if aliases:
        pairs = [F.lit(x) for pair in aliases.items() for x in pair]
        method = F.coalesce(F.try_element_at(F.create_map(*pairs), method), method)
    named = payments.select(method.alias("payment_method")).filter(F.col("payment_method").isNotNull())
    counted = named.groupBy("payment_method").agg(F.count("*").alias("payments"))
    if baseline is None:
        return counted
    base = baseline.select("payment_method", F.col("payments").cast("long"))
    return counted.unionByName(base).groupBy("payment_method").agg(F.sum("payments").alias("payments"))


def alert_count(alerts: DataFrame) -> DataFrame:
    """Number of alerts."""
    return alerts.agg(F.count("*").alias("total"))


def stream_volume(sources: Sequence[DataFrame | tuple[DataFrame, int]]) -> DataFrame:
    """Rows of all sources together, each counted with its weight."""
    rows = None
    for source in sources:
        df, weight = source if isinstance(source, tuple) else (source, 1)
        weighed = df.select(F.lit(weight).cast("long").alias("_weight"))
        rows = weighed if rows is None else rows.unionAll(weighed)
    return rows.agg(F.coalesce(F.sum("_weight"), F.lit(0).cast("long")).alias("stream_events"))


def _volume(n_events: DataFrame | int) -> Column:
    return F.lit(n_events).cast("long") if isinstance(n_events, int) else n_events.scalar()


def with_position(summary: DataFrame, by: str, *keys: str) -> DataFrame:
    """A report with the position of each row in its ranking, counted from 0. The window has no
    partitions, but a report has one row per group."""
    return summary.withColumn("position", F.row_number().over(Window.orderBy(*ranking(by, list(keys)))).cast("long") - 1)


def _shift_top(
    summary: DataFrame, by: str, keys: Sequence[str], top: int, n_events: DataFrame | int, shifts: Mapping[str, Column]
) -> DataFrame:
    """Replaces columns of the top rows by expressions over their position `_i` and the volume `_n`."""
    head = summary.orderBy(*ranking(by, keys)).limit(top)
    placed = head.withColumn("_i", F.row_number().over(Window.orderBy(*ranking(by, keys))).cast("long") - 1)
    placed = placed.withColumn("_n", _volume(n_events))
    shifted = placed.select(*[F.col(k).alias(f"_{k}") for k in keys], *[e.alias(f"_new_{c}") for c, e in shifts.items()], "_i")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    # The broadcast side has at most `top` rows.
    joined = summary.join(F.broadcast(shifted), same, "left")
    new = {c: F.when(F.col("_i").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in shifts}
    return joined.withColumns(new).select(*summary.columns).orderBy(*ranking(by, keys))


def fuse_category_volume(summary: DataFrame, n_events: DataFrame | int, top: int = 12) -> DataFrame:
    """Adds the stream volume to the counts and prices of the leading categories."""
    i, n = F.col("_i"), F.col("_n")
    count = F.col("product_count") + F.floor((n * (15 - F.least(i, F.lit(10)))) / F.lit(10).cast("decimal(2,0)")).cast("long")
    step = F.pmod(n, (i + 1) * 7).cast("decimal(18,0)") * F.lit("0.45").cast("decimal(3,2)")
    price = F.col("avg_unit_price").cast("decimal(18,2)") + step - F.lit("1.25").cast("decimal(3,2)")
    shifts = {
        "product_count": F.when(n > 0, count).otherwise(F.col("product_count")),
        "avg_unit_price": F.when(n > 0, money(price)).otherwise(F.col("avg_unit_price")),
    }
    return _shift_top(summary, "product_count", ["category"], top, n_events, shifts)


def fuse_loyalty_volume(summary: DataFrame, n_events: DataFrame | int, top: int = 15) -> DataFrame:
    """Adds the stream volume to the leading groups, 1.8-fold at even and 0.9-fold at odd positions."""
    i, n = F.col("_i"), F.col("_n")
    tenths = F.when(i % 2 == 0, n * 18).otherwise(n * 9)
    count = F.col("total_customers") + F.floor(tenths / F.lit(10).cast("decimal(2,0)")).cast("long")
    keys = ["loyalty_tier", "state_code"]
    return _shift_top(summary, "total_customers", keys, top, n_events, {"total_customers": count})


def average_order_value(
    kpi: DataFrame, base_revenue: float = 0.0, base_orders: int = 0, revenue: str = "total_revenue_brl", orders: str = "total_orders"
) -> DataFrame:
    """Revenue per order of a KPI row, optionally on top of baselines."""
    total = cents(F.col(revenue)) + round(base_revenue * 100)
    n = F.greatest(F.col(orders) + base_orders, F.lit(1))
    return kpi.select(rounded_mean(total, n).alias("average_order_value"))


def _period(df: DataFrame, grain: str) -> Column:
    """Start of the calendar period, in the type of the event time."""
    return F.date_trunc(grain, "event_timestamp").cast(df.schema["event_timestamp"].dataType).alias("period")


def revenue_by_period(orders: DataFrame, grain: str = "day") -> DataFrame:
    """Revenue, orders and order value per day, week, month or other calendar period."""
    grouped = orders.groupBy(_period(orders, grain)).agg(*_order_measures())
    return grouped.select("period", *_revenue_columns())


def revenue_by_window(orders: DataFrame, size: str = "1 hour", by: Sequence[str] = ()) -> DataFrame:
    """Revenue, orders, order value and orders per minute per event-time window."""
    grouped = orders.groupBy(F.window("event_timestamp", size).alias("_w"), *by).agg(*_order_measures())
    minutes = (F.unix_timestamp(F.col("_w.end")) - F.unix_timestamp(F.col("_w.start"))) / 60
    return grouped.select(
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        *by,
        *_revenue_columns(),
        (F.col("orders") / minutes).alias("orders_per_minute"),
    )


def rolled_up_revenue(hourly: DataFrame, grain: str = "day") -> DataFrame:
    """Revenue and orders per day, week or month from revenue kept by shorter windows, newest first:
    reads the kept rows, not the orders."""
    grouped = hourly.groupBy(F.date_trunc(grain, "window_start").alias("period")).agg(F.sum(cents("revenue")).alias("_cents"), F.sum("orders").alias("orders"))
    return grouped.select("period", from_cents(F.col("_cents")).alias("revenue"), "orders").orderBy(F.desc("period"))


def views_trend(views: DataFrame, window: str = "1 hour") -> DataFrame:
    """Product views per window, oldest first."""
    grouped = views.groupBy(F.window("event_timestamp", window).alias("_w")).agg(F.count("*").alias("views"))
    return grouped.select(F.col("_w.start").alias("window_start"), "views").orderBy("window_start")


def customer_lifetime_value(orders: DataFrame) -> DataFrame:
    """Total revenue per customer."""
    grouped = orders.groupBy("customer_id").agg(*_order_measures())
    return grouped.select("customer_id", from_cents(F.col("_cents")).alias("lifetime_value"), "orders")


def conversion_rate(orders: DataFrame, sessions: DataFrame) -> DataFrame:
    """Orders per session."""
    n_orders = orders.agg(F.count("*")).scalar()
    counted = sessions.agg(F.count("*").alias("sessions")).withColumn("orders", n_orders)
    return counted.withColumn("conversion_rate", ratio(F.col("orders"), F.col("sessions")))


def payment_success_rate(payments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Successful payments per attempt, overall or per group."""
    grouped = payments.groupBy(*by).agg(
        F.count_if(F.col("payment_status") == "SUCCESS").alias("successes"), F.count("payment_status").alias("attempts")
    )
    return grouped.withColumn("success_rate", ratio(F.col("successes"), F.col("attempts")))


def average_basket_size(order_items: DataFrame) -> DataFrame:
    """Mean number of units per order."""
    per_order = order_items.groupBy("order_id").agg(F.sum("quantity").cast("long").alias("units"))
    totals = per_order.agg(F.sum("units").alias("_units"), F.count("*").alias("orders"))
    return totals.select("orders", ratio(F.col("_units"), F.col("orders")).alias("average_basket_size"))


def active_users(events: DataFrame, window: str = "1 hour", approximate: bool = False) -> DataFrame:
    """Distinct customers and sessions per window; streams need the approximate form."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    measures = [distinct(F.col("customer_id")).alias("customers")]
    if "session_id" in events.columns:
        measures.append(distinct(F.col("session_id")).alias("sessions"))
    grouped = events.groupBy(F.window("event_timestamp", window).alias("_w")).agg(*measures)
    return grouped.select(F.col("_w.start").alias("window_start"), *[c for c in grouped.columns if c != "_w"])


def user_sketches(events: DataFrame, window: str = "1 hour", lg_k: int = SKETCH_LG_K) -> DataFrame:
    """HyperLogLog sketches of the customers and sessions of each window, in batch and on streams.
    Sketches of several windows, tables or runs merge without counting anyone twice."""
    names = {"customers": "customer_id"} | ({"sessions": "session_id"} if "session_id" in events.columns else {})
    measures = [F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(n) for n, c in names.items()]
    grouped = events.groupBy(F.window("event_timestamp", window).alias("_w")).agg(*measures)
    return grouped.select(F.col("_w.start").alias("window_start"), *names)


def merged_users(sketches: DataFrame, grain: str = "day") -> DataFrame:
    """About how many customers and sessions were active per day, week or month, from sketches of
    shorter windows. The relative error of a count is 1.04 / sqrt(2 ** lg_k) at one standard
    deviation: 1.6 % with 2 ** 12."""
    names = [c for c in ("customers", "sessions") if c in sketches.columns]
    merged = [F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in names]
    return sketches.groupBy(F.date_trunc(grain, "window_start").alias("period")).agg(*merged)


def new_vs_returning(orders: DataFrame, grain: str = "month") -> DataFrame:
    """Customers per period whose first order falls in it, and the others."""
    seen = orders.filter(F.col("customer_id").isNotNull()).select("customer_id", _period(orders, grain))
    # One row per customer and period: a customer's window is as long as the calendar, not the order log.
    first = F.min("period").over(Window.partitionBy("customer_id"))
    new = F.count_if(F.col("_first") == F.col("period"))
    grouped = seen.distinct().withColumn("_first", first).groupBy("period").agg(new.alias("new_customers"), F.count("*").alias("_all"))
    return grouped.select("period", "new_customers", (F.col("_all") - F.col("new_customers")).alias("returning_customers"))


def conversion_funnel(events: DataFrame, steps: Sequence[str], actor: str = "customer_id", strict: bool = False) -> DataFrame:
    """Distinct actors per step, with the rate from the step before and from the first.

    The strict form counts an actor for a step only if the first occurrences of all steps
    up to it are in order of time.
    """
    wanted = events.filter(F.col("event_type").isin(*steps) & F.col(actor).isNotNull())
    firsts = wanted.groupBy(actor).agg(
        *[F.min(F.when(F.col("event_type") == s, F.col("event_timestamp"))).alias(f"_t{i}") for i, s in enumerate(steps)]
    )
    reached = []
    for i in range(len(steps)):
        test = F.col(f"_t{i}").isNotNull()
        if strict and i:
            test = reached[-1] & test & (F.col(f"_t{i}") >= F.col(f"_t{i - 1}"))
        reached.append(test)
    totals = firsts.agg(*[F.count_if(r).alias(f"_n{i}") for i, r in enumerate(reached)])
    rows = [
        F.struct(
            F.lit(i + 1).cast("long").alias("step_no"),
            F.lit(s).alias("step"),
            F.col(f"_n{i}").alias("actors"),
            ratio(F.col(f"_n{i}"), F.col(f"_n{max(i - 1, 0)}")).alias("rate_from_previous"),
            ratio(F.col(f"_n{i}"), F.col("_n0")).alias("rate_from_first"),
        )
        for i, s in enumerate(steps)
    ]
    return totals.select(F.inline(F.array(*rows)))


def product_conversion(views: DataFrame, order_items: DataFrame) -> DataFrame:
    """Views, orders and orders per view of every product that has either."""
    viewed = views.groupBy("product_id").agg(F.count("*").alias("views"))
    ordered = order_items.groupBy("product_id").agg(F.count("*").alias("orders"))
    zero = F.lit(0).cast("long")
    both = viewed.join(ordered, "product_id", "full_outer")
    filled = both.select("product_id", F.coalesce("views", zero).alias("views"), F.coalesce("orders", zero).alias("orders"))
    return filled.withColumn("conversion", ratio(F.col("orders"), F.col("views")))


def session_stats(events: DataFrame, gap: int = 1800) -> DataFrame:
    """Start, end, duration and events of every session.

    Events that carry a session id are grouped by it, the others by pauses of more than `gap` seconds.
    """
    columns = ["customer_id", "session_id", "session_start", "session_end", "events"]
    rest = events
    parts = []
    if "session_id" in events.columns:
        own = events.filter(F.col("session_id").isNotNull())
        # Grouped with the customer first: the many events then need no minimum of a text column.
        by_customer = own.groupBy("session_id", "customer_id").agg(
            F.min("event_timestamp").alias("_start"), F.max("event_timestamp").alias("_end"), F.count("*").alias("_n")
        )
        parts.append(
            by_customer.groupBy("session_id")
            .agg(
                F.min("customer_id").alias("customer_id"),
                F.min("_start").alias("session_start"),
                F.max("_end").alias("session_end"),
                F.sum("_n").alias("events"),
            )
            .select(*columns)
        )
        rest = events.filter(F.col("session_id").isNull())
    parts.append(gap_sessions(rest, gap).withColumn("session_id", F.lit(None).cast("string")).select(*columns))
    sessions = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    length = F.unix_micros(F.col("session_end").cast("timestamp")) - F.unix_micros(F.col("session_start").cast("timestamp"))
    return sessions.withColumn("duration_seconds", length / 1_000_000)


def session_histogram(sessions: DataFrame, width: int = 60) -> DataFrame:
    """Sessions per duration bucket of `width` seconds."""
    bucket = F.floor(F.col("duration_seconds") / width) * width
    return sessions.groupBy(bucket.alias("bucket_start")).agg(F.count("*").alias("sessions"))


def inventory_status(inventory: DataFrame, threshold: int = 20) -> DataFrame:
    """Units on hand less reserved per product, and whether to restock."""
    free = F.sum(F.col("quantity") - F.col("reserved_quantity")).cast("long")
    return inventory.groupBy("product_id").agg(free.alias("available")).withColumn("restock", F.col("available") < threshold)


def share_by(events: DataFrame, col: str) -> DataFrame:
    """Events per value and their percentage of all events."""
    counted = events.groupBy(col).agg(F.count("*").alias("events"))
    total = counted.agg(F.sum("events")).scalar()
    return counted.withColumn("share_percent", ratio(F.col("events") * 100, total))


# Calendar parts a heatmap can have; weekdays run from 1 (Sunday) to 7.
CALENDAR_PARTS = {"dow": F.dayofweek, "hour": F.hour, "month": F.month, "day": F.dayofmonth}


def sales_heatmap(orders: DataFrame, parts: Sequence[str] = ("dow", "hour")) -> DataFrame:
    """Revenue and orders by calendar parts."""
    keys = [CALENDAR_PARTS[p](F.col("event_timestamp")).cast("long").alias(p) for p in parts]
    grouped = orders.groupBy(*keys).agg(*_order_measures())
    return grouped.select(*parts, from_cents(F.col("_cents")).alias("revenue"), "orders")


def reject_summary(rejected: DataFrame, by: Sequence[str] = ("dlq_reason",)) -> DataFrame:
    """Rejects per reason."""
    return rejected.groupBy(*by).agg(F.count("*").alias("rejects"))


def event_throughput(events: DataFrame, window: str = "1 hour") -> DataFrame:
    """Events per topic and window."""
    grouped = events.groupBy(F.window("event_timestamp", window).alias("_w"), "topic").agg(F.count("*").alias("events"))
    return grouped.select(F.col("_w.start").alias("window_start"), "topic", "events")


def failure_trend(payments: DataFrame, window: str = "1 day") -> DataFrame:
    """Failed payments, attempts and failure rate per window."""
    grouped = payments.groupBy(F.window("event_timestamp", window).alias("_w")).agg(
        F.count_if(F.col("payment_status") == "FAILED").alias("failures"), F.count("payment_status").alias("attempts")
    )
    rate = ratio(F.col("failures"), F.col("attempts")).alias("failure_rate")
    return grouped.select(F.col("_w.start").alias("window_start"), "failures", "attempts", rate)


def _score_measures() -> list[Column]:
    return [F.count("*").alias("alerts"), F.max("risk_score").cast("double").alias("max_score"), F.sum(cents("risk_score")).alias("_cents")]


def high_risk(alerts: DataFrame, key: str = "customer_id", min_alerts: int = 2) -> DataFrame:
    """Customers or orders with several alerts: how many, highest and mean score."""
    grouped = alerts.groupBy(key).agg(*_score_measures()).filter(F.col("alerts") >= min_alerts)
    return grouped.select(key, "alerts", "max_score", exact_mean(F.col("_cents"), F.col("alerts")).alias("mean_score"))


def alerts_by_region(alerts: DataFrame, customers: DataFrame, region: str = "state_code") -> DataFrame:
    """Alerts per customer region; unknown customers are counted under NULL."""
    per_customer = alerts.groupBy("customer_id").agg(F.count("*").alias("_n"))
    dim = customers.select(F.col("customer_id").cast("string"), region)
    joined = lookup(per_customer.withColumn("customer_id", F.col("customer_id").cast("string")), dim, "customer_id")
    return joined.groupBy(region).agg(F.sum("_n").alias("alerts"))


def revenue_by(facts: DataFrame, dim: DataFrame, key: str, dim_col: str, amount: str = "line_total") -> DataFrame:
    """Revenue per attribute of a master table, such as category or country."""
    per_key = facts.groupBy(key).agg(F.sum(cents(amount)).alias("_cents"))
    grouped = lookup(per_key, dim.select(key, dim_col), key).groupBy(dim_col).agg(F.sum("_cents").alias("_cents"))
    return grouped.select(dim_col, from_cents(F.col("_cents")).alias("revenue"))


def availability_rollup(inventory: DataFrame, warehouses: DataFrame, by: str | Sequence[str] = ("warehouse_id", "region")) -> DataFrame:
    """Units per warehouse, or per region, against capacity."""
    units = inventory.groupBy("warehouse_id").agg(F.sum("quantity").cast("long").alias("_units"))
    dim = warehouses.select("warehouse_id", "region", "capacity_units")
    grouped = lookup(units, dim, "warehouse_id").groupBy(*as_list(by))
    summed = grouped.agg(F.sum("_units").alias("units"), F.sum("capacity_units").cast("long").alias("capacity_units"))
    return summed.withColumn("utilization", ratio(F.col("units"), F.col("capacity_units")))


def alert_timeline(alerts: DataFrame, window: str = "1 day") -> DataFrame:
    """Alerts and mean score per window."""
    grouped = alerts.groupBy(F.window("event_timestamp", window).alias("_w")).agg(*_score_measures())
    mean = exact_mean(F.col("_cents"), F.col("alerts")).alias("mean_score")
    return grouped.select(F.col("_w.start").alias("window_start"), "alerts", mean)


def revenue_distribution(orders: DataFrame, width: int = 1000) -> DataFrame:
    """Orders and revenue per order-value bucket."""
    bucket = F.floor(cents("total_amount") / (width * 100)) * width
    grouped = orders.groupBy(bucket.alias("bucket_start")).agg(*_order_measures())
    return grouped.select("bucket_start", "orders", from_cents(F.col("_cents")).alias("revenue"))
