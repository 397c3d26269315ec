"""The same questions in SQL, over the same tables."""

from __future__ import annotations

from registry.tables import with_tables

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"
HEADER_REASON = "Missing required UUID or ISO timestamp"
RANGE_REASON = "Negative transaction monetary value or zero quantity"


def cents(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) * 100 AS BIGINT)"


def total(x: str) -> str:
    return f"CAST(sum({cents(x)}) AS BIGINT)"


def half_up(c: str, n: str) -> str:
    """c cents shared among n, to the cent, halves up."""
    return f"CAST((2 * ({c}) + ({n})) // (2 * ({n})) AS DOUBLE) / 100"


def measures(x: str = "total_amount") -> str:
    return f"{total(x)} / 100.0::DOUBLE AS revenue, count(*) AS orders, {half_up(total(x), 'count(*)')} AS average_order_value"


def draw(key: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 7) AS BIGINT)"


def amount_text(x: str) -> str:
    return f"regexp_replace(CAST(CAST({x} AS DECIMAL(38,2)) AS VARCHAR), '(\\.\\d)0$', '\\1')"


def score(amount: str, key: str) -> str:
    """In eight-thousandths: 78 + amount / 80 + jitter, between 75 and 99.9, halves up."""
    raw = f"(624000 + {cents(amount)} + 80 * (210 + {draw(key)} % 1071) + 40) // 80"
    return f"CAST(least(9990, greatest(7500, coalesce({raw}, 7500))) AS DOUBLE) / 100"


MISSING = "(event_id IS NULL OR event_timestamp IS NULL)"
BAD_RANGE = "(coalesce(amount, 0) < 0 OR coalesce(quantity, 1) <= 0)"
REASON = f"CASE WHEN {MISSING} THEN '{HEADER_REASON}' WHEN {BAD_RANGE} THEN '{RANGE_REASON}' END"

ALERTS = f"""alerts AS (
    SELECT 'ALT-' || upper(substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS alert_id, event_timestamp,
           CAST(customer_id AS VARCHAR) AS customer_id, 'N/A' AS order_id, {score('amount', 'event_id')} AS risk_score,
           'RAPID_FAILED_PAYMENT_ATTEMPTS_DETECTED' AS rule_violated,
           'Failed attempt of BRL ' || {amount_text('amount')} || ' via ' || payment_method AS details
    FROM fx_payments WHERE payment_status = 'FAILED')"""

SUMMARY = f"""summary AS (
    SELECT brand AS category, count(*) AS product_count, {half_up(total('unit_price'), 'count(*)')} AS avg_unit_price
    FROM fx_products GROUP BY brand)"""

VOLUME = """volume AS (
    SELECT CAST((SELECT count(*) FROM fx_events) + (SELECT count(*) FROM fx_orders)
                + 15 * (SELECT count(DISTINCT date_trunc('day', event_timestamp)) FROM fx_orders) AS BIGINT) AS n)"""

LOYALTY = """loyalty AS (
    SELECT loyalty_tier, state_code, count(*) AS total_customers FROM fx_customers GROUP BY ALL)"""


def periods(grain: str) -> str:
    return f"""periods AS (SELECT date_trunc('{grain}', event_timestamp)::TIMESTAMP AS period, {measures()}
        FROM fx_orders GROUP BY 1)"""


def windows(interval: str, minutes: int, source: str = "fx_orders", x: str = "total_amount", by: str = "") -> str:
    keys = f", {by}" if by else ""
    return f"""SELECT time_bucket(INTERVAL '{interval}', event_timestamp) AS window_start,
        time_bucket(INTERVAL '{interval}', event_timestamp) + INTERVAL '{interval}' AS window_end{keys},
        {measures(x)}, count(*) / {minutes}.0::DOUBLE AS orders_per_minute
        FROM {source} GROUP BY 1, 2{', ' + by if by else ''}"""


def sessions(source: str, seconds: int) -> str:
    return f"""marked AS (
        SELECT *, CASE WHEN event_timestamp - lag(event_timestamp) OVER w <= INTERVAL '{seconds} seconds'
                       THEN 0 ELSE 1 END AS starts
        FROM {source} WINDOW w AS (PARTITION BY customer_id ORDER BY event_timestamp, event_id)),
      numbered AS (
        SELECT *, CAST(sum(starts) OVER (PARTITION BY customer_id ORDER BY event_timestamp, event_id
                                         ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no FROM marked)"""


ALL_SESSIONS = f"""own AS (SELECT * FROM fx_sessions WHERE session_id IS NULL), {sessions('own', 1800)},
    found AS (
        SELECT min(customer_id) AS customer_id, session_id, min(event_timestamp) AS session_start,
               max(event_timestamp) AS session_end, count(*) AS events
        FROM fx_sessions WHERE session_id IS NOT NULL GROUP BY session_id
        UNION ALL
        SELECT customer_id, NULL, min(event_timestamp), max(event_timestamp), count(*)
        FROM numbered GROUP BY customer_id, session_no),
    stats AS (SELECT *, CAST(epoch_us(session_end) - epoch_us(session_start) AS DOUBLE) / 1000000 AS duration_seconds FROM found)"""

# The first occurrence of each step by customer.
FIRSTS = """firsts AS (
    SELECT customer_id, min(event_timestamp) FILTER (event_type = 'product_view') AS t0,
           min(event_timestamp) FILTER (event_type = 'add_to_cart') AS t1,
           min(event_timestamp) FILTER (event_type = 'checkout_started') AS t2,
           min(event_timestamp) FILTER (event_type = 'payment_completed') AS t3
    FROM fx_events GROUP BY customer_id)"""


def funnel(tests: list[str]) -> str:
    steps = ["product_view", "add_to_cart", "checkout_started", "payment_completed"]
    counts = ", ".join(f"count(*) FILTER ({test}) AS n{i}" for i, test in enumerate(tests))
    rows = " UNION ALL ".join(
        f"""SELECT CAST({i + 1} AS BIGINT) AS step_no, '{s}' AS step, n{i} AS actors,
            CAST(n{i} AS DOUBLE) / n{max(i - 1, 0)} AS rate_from_previous, CAST(n{i} AS DOUBLE) / n0 AS rate_from_first FROM counts"""
        for i, s in enumerate(steps)
    )
    return f"WITH {FIRSTS}, counts AS (SELECT {counts} FROM firsts) {rows}"


SQL = {
    "required": f"SELECT *, CASE WHEN {MISSING} THEN '{HEADER_REASON}' END AS dlq_reason FROM fx_dirty",
    "in_range": f"SELECT *, CASE WHEN {BAD_RANGE} THEN '{RANGE_REASON}' END AS dlq_reason FROM fx_dirty",
    "tag_rejects": f"SELECT *, {REASON} AS dlq_reason FROM fx_dirty",
    "split_valid": f"SELECT * FROM fx_dirty WHERE NOT {MISSING} AND NOT {BAD_RANGE}",
    "split_rejected": f"SELECT *, {REASON} AS dlq_reason FROM fx_dirty WHERE {MISSING} OR {BAD_RANGE}",
    "known_type": """SELECT *, CASE WHEN event_type NOT IN ('view', 'click', 'purchase') THEN 'Unknown event type' END
        AS dlq_reason FROM fx_dirty""",
    "exists_in": """SELECT d.*, CASE WHEN d.customer_id NOT IN (SELECT customer_id FROM fx_customers)
        THEN 'Unknown customer_id' END AS dlq_reason FROM fx_dirty d""",
    "drop_duplicate_events": """
        SELECT * FROM fx_dirty WHERE event_id IS NULL
        UNION ALL SELECT DISTINCT ON (event_id) * FROM fx_dirty WHERE event_id IS NOT NULL""",
    "failed_payments": "SELECT event_id, customer_id, amount, payment_method FROM fx_events WHERE payment_status = 'FAILED'",
    "route_by_type": """
        SELECT event_id, event_type, CASE event_type WHEN 'product_view' THEN 'product-view-events'
            WHEN 'add_to_cart' THEN 'cart-events' WHEN 'checkout_started' THEN 'checkout-events'
            ELSE 'payment-events' END AS topic FROM fx_events""",
    "project": f"SELECT event_id AS id, {cents('amount')} AS amount_cents, 'BRL' AS currency, device FROM fx_events",
    "failed_payment_alerts": f"WITH {ALERTS} SELECT * FROM alerts",
    "enrich_orders": """
        SELECT o.*, coalesce(loyalty_tier, 'Standard') AS loyalty_tier, city, state_code
        FROM fx_orders o LEFT JOIN fx_customers USING (customer_id)""",
    "enrich_views": """
        SELECT event_id, event_timestamp, customer_id, product_id, device AS category, p.category AS category_master,
               brand, unit_price
        FROM fx_events LEFT JOIN fx_products p USING (product_id) WHERE event_type = 'product_view'""",
    "translate_category": """
        SELECT p_partkey AS product_id, p_type AS product_category_name,
               CASE WHEN p_type = 'ECONOMY' THEN 'General_Merchandise' ELSE lower(p_type) END AS category FROM part""",
    "attach_prices": f"""
        WITH prices AS (SELECT product_id + 100 AS product_id, {half_up(total('line_total'), 'count(*)')} AS price
                        FROM fx_items GROUP BY 1)
        SELECT product_id, category, coalesce(price, 49.99::DOUBLE) AS unit_price
        FROM fx_products LEFT JOIN prices USING (product_id)""",
    "build_inventory": f"""
        WITH lines AS (SELECT 'INV-' || product_id || '-' || w AS inventory_id, product_id, CAST(w AS INTEGER) AS warehouse_id
                       FROM fx_products CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS w) x)
        SELECT *, 10 + {draw("inventory_id || ':quantity'")} % 490 AS quantity,
               {draw("inventory_id || ':reserved'")} % 5 AS reserved_quantity FROM lines""",
    "enrich_payments": """
        SELECT event_id, customer_id, amount, payment_status, coalesce(loyalty_tier, 'Standard') AS loyalty_tier
        FROM fx_payments LEFT JOIN fx_customers USING (customer_id)""",
    "enrich_order_items": """
        SELECT i.*, category, brand, seller_name, state AS seller_state
        FROM fx_items i LEFT JOIN fx_products USING (product_id) LEFT JOIN fx_sellers USING (seller_id)""",
    "enrich_inventory": """
        SELECT i.*, city, region FROM fx_inventory i LEFT JOIN fx_warehouses USING (warehouse_id)""",
    "abandoned_carts": """
        SELECT event_id, customer_id, event_timestamp, product_id FROM fx_events c
        WHERE event_type = 'add_to_cart' AND NOT EXISTS (
            SELECT 1 FROM fx_events k WHERE k.event_type = 'checkout_started' AND k.customer_id = c.customer_id
              AND k.event_timestamp BETWEEN c.event_timestamp AND c.event_timestamp + INTERVAL '86400 seconds')""",
    "orphans": "SELECT * FROM fx_orders WHERE customer_id NOT IN (SELECT customer_id FROM fx_customers)",
    "orders_with_master": "SELECT * FROM fx_orders WHERE customer_id IN (SELECT customer_id FROM fx_customers)",
    "revenue_kpi": f"""
        SELECT {AS_OF} AS window_end, 'revenue_window_1h' AS metric_type, {total('total_amount')} / 100.0::DOUBLE AS total_revenue_brl,
               count(*) AS total_orders, {half_up(total('total_amount'), 'count(*)')} AS average_order_value
        FROM fx_orders HAVING count(*) > 0""",
    "cart_abandonment": f"""
        WITH n AS (SELECT count(*) FILTER (event_type IN ('add_to_cart', 'product_view')) AS c,
                          count(*) FILTER (event_type = 'checkout_started') AS k FROM fx_events)
        SELECT {AS_OF} AS window_timestamp, c AS total_carts_initiated, k AS total_checkouts_completed,
               CASE WHEN c = 0 THEN 0.0::DOUBLE
                    ELSE CAST((2000 * greatest(c - k, 0) + c) // (2 * c) AS DOUBLE) / 10 END AS cart_abandonment_percentage
        FROM n""",
    "category_summary": f"""
        SELECT category, count(product_id) AS product_count, {half_up(total('unit_price'), 'count(*)')} AS avg_unit_price
        FROM fx_products GROUP BY category""",
    "loyalty_demographics": f"WITH {LOYALTY} SELECT * FROM loyalty",
    "payment_method_counts": """
        WITH counted AS (
            SELECT CASE payment_method WHEN 'Boleto' THEN 'Boleto (Bank Invoice)' WHEN 'Pix' THEN 'Pix / Instant'
                   ELSE payment_method END AS payment_method, 1 AS n FROM fx_payments
            UNION ALL SELECT * FROM (VALUES ('Credit Card', 720), ('Boleto (Bank Invoice)', 160),
                                            ('Pix / Instant', 90), ('Voucher', 30)) b)
        SELECT payment_method, CAST(sum(n) AS BIGINT) AS payments FROM counted GROUP BY 1""",
    "alert_count": "SELECT count(*) AS total FROM fx_payments WHERE payment_status = 'FAILED'",
    "mean_price": f"""
        SELECT product_id, {half_up(total('line_total'), 'count(*)')} AS unit_price FROM fx_items GROUP BY 1""",
    "stream_volume": f"WITH {VOLUME} SELECT n AS stream_events FROM volume",
    "fuse_category_volume": f"""
        WITH {SUMMARY}, {VOLUME},
             placed AS (SELECT *, row_number() OVER (ORDER BY product_count DESC, category) - 1 AS i FROM summary)
        SELECT category,
               CASE WHEN i < 12 THEN product_count + n * (15 - least(i, 10)) // 10 ELSE product_count END AS product_count,
               CASE WHEN i < 12 THEN CAST({cents('avg_unit_price')} + (n % (7 * (i + 1))) * 45 - 125 AS DOUBLE) / 100
                    ELSE avg_unit_price END AS avg_unit_price
        FROM placed, volume""",
    "fuse_loyalty_volume": f"""
        WITH {LOYALTY}, {VOLUME},
             placed AS (SELECT *, row_number() OVER (ORDER BY total_customers DESC, loyalty_tier, state_code) - 1 AS i
                        FROM loyalty)
        SELECT loyalty_tier, state_code,
               total_customers + CASE WHEN i >= 15 THEN 0 WHEN i % 2 = 0 THEN n * 18 // 10 ELSE n * 9 // 10 END AS total_customers
        FROM placed, volume""",
    "average_order_value": f"""
        SELECT {half_up(total('total_amount') + ' + 14285050', 'count(*) + 1842')} AS average_order_value FROM fx_orders""",
    "revenue_by_day": f"WITH {periods('day')} SELECT * FROM periods",
    "revenue_by_week": f"WITH {periods('week')} SELECT * FROM periods",
    "revenue_by_month": f"WITH {periods('month')} SELECT * FROM periods",
    "revenue_by_window": f"""
        WITH paid AS (SELECT * FROM fx_events WHERE event_type = 'payment_completed') {windows('1 hour', 60, 'paid', 'amount')}""",
    "revenue_by_window_and_tier": f"""
        WITH clean AS (SELECT DISTINCT * FROM fx_dirty WHERE NOT {MISSING} AND NOT {BAD_RANGE}),
             enriched AS (SELECT c.*, coalesce(f.loyalty_tier, 'Standard') AS loyalty_tier
                          FROM clean c LEFT JOIN fx_customers f USING (customer_id))
        {windows('1 hour', 60, 'enriched', 'coalesce(amount, 0)', 'loyalty_tier')}""",
    "customer_lifetime_value": f"""
        SELECT customer_id, {total('total_amount')} / 100.0::DOUBLE AS lifetime_value, count(*) AS orders
        FROM fx_orders GROUP BY 1""",
    "conversion_rate": f"""
        WITH {ALL_SESSIONS}, n AS (SELECT (SELECT count(*) FROM stats) AS sessions,
            (SELECT count(*) FROM fx_sessions WHERE event_type = 'payment_completed') AS orders)
        SELECT *, CAST(orders AS DOUBLE) / sessions AS conversion_rate FROM n""",
    "payment_success_rate": """
        SELECT count(*) FILTER (payment_status = 'SUCCESS') AS successes, count(*) AS attempts,
               CAST(count(*) FILTER (payment_status = 'SUCCESS') AS DOUBLE) / count(*) AS success_rate FROM fx_payments""",
    "payment_success_by_method": """
        SELECT payment_method, count(*) FILTER (payment_status = 'SUCCESS') AS successes, count(*) AS attempts,
               CAST(count(*) FILTER (payment_status = 'SUCCESS') AS DOUBLE) / count(*) AS success_rate
        FROM fx_payments GROUP BY 1""",
    "average_basket_size": """
        SELECT count(DISTINCT order_id) AS orders,
               CAST(sum(CAST(quantity AS BIGINT)) AS DOUBLE) / count(DISTINCT order_id) AS average_basket_size FROM fx_items""",
    "active_users": """
        SELECT time_bucket(INTERVAL '1 hour', event_timestamp) AS window_start, count(DISTINCT customer_id) AS customers,
               count(DISTINCT session_id) AS sessions FROM fx_sessions GROUP BY 1""",
    "new_vs_returning": """
        WITH firsts AS (SELECT customer_id, min(date_trunc('month', event_timestamp)) AS f FROM fx_orders GROUP BY 1)
        SELECT date_trunc('month', event_timestamp)::TIMESTAMP AS period,
               count(DISTINCT o.customer_id) FILTER (f = date_trunc('month', event_timestamp)) AS new_customers,
               count(DISTINCT o.customer_id) FILTER (f < date_trunc('month', event_timestamp)) AS returning_customers
        FROM fx_orders o JOIN firsts USING (customer_id) GROUP BY 1""",
    "conversion_funnel": funnel([f"t{i} IS NOT NULL" for i in range(4)]),
    "conversion_funnel_strict": funnel(["t0 IS NOT NULL", "t0 <= t1", "t0 <= t1 AND t1 <= t2", "t0 <= t1 AND t1 <= t2 AND t2 <= t3"]),
    "product_conversion": """
        WITH v AS (SELECT product_id, count(*) AS views FROM fx_events WHERE event_type = 'product_view' GROUP BY 1),
             o AS (SELECT product_id, count(*) AS orders FROM fx_items GROUP BY 1),
             b AS (SELECT product_id, coalesce(views, 0) AS views, coalesce(orders, 0) AS orders
                   FROM v FULL JOIN o USING (product_id))
        SELECT *, CASE WHEN views > 0 THEN CAST(orders AS DOUBLE) / views END AS conversion FROM b""",
    "session_stats": f"WITH {ALL_SESSIONS} SELECT * FROM stats",
    "session_histogram": f"""
        WITH {ALL_SESSIONS} SELECT CAST(floor(duration_seconds / 60) AS BIGINT) * 60 AS bucket_start, count(*) AS sessions
        FROM stats GROUP BY 1""",
    "inventory_status": """
        SELECT product_id, CAST(sum(quantity - reserved_quantity) AS BIGINT) AS available,
               sum(quantity - reserved_quantity) < 1200 AS restock FROM fx_inventory GROUP BY 1""",
    "share_by_device": """
        SELECT device, count(*) AS events, CAST(count(*) * 100 AS DOUBLE) / (SELECT count(*) FROM fx_events) AS share_percent
        FROM fx_events GROUP BY 1""",
    "share_by_state": """
        SELECT state_code, count(*) AS events, CAST(count(*) * 100 AS DOUBLE) / (SELECT count(*) FROM fx_orders) AS share_percent
        FROM fx_orders LEFT JOIN fx_customers USING (customer_id) GROUP BY 1""",
    "sales_heatmap": f"""
        SELECT dayofweek(event_timestamp) + 1 AS dow, hour(event_timestamp) AS hour,
               {total('amount')} / 100.0::DOUBLE AS revenue, count(*) AS orders
        FROM fx_events WHERE event_type = 'payment_completed' GROUP BY 1, 2""",
    "sales_by_month_of_year": f"""
        SELECT month(event_timestamp) AS month, {total('total_amount')} / 100.0::DOUBLE AS revenue, count(*) AS orders
        FROM fx_orders GROUP BY 1""",
    "reject_summary": f"""
        SELECT {REASON} AS dlq_reason, event_type, count(*) AS rejects FROM fx_dirty
        WHERE {MISSING} OR {BAD_RANGE} GROUP BY 1, 2""",
    "event_throughput": """
        SELECT time_bucket(INTERVAL '1 hour', event_timestamp) AS window_start,
               CASE event_type WHEN 'product_view' THEN 'product-view-events' WHEN 'add_to_cart' THEN 'cart-events'
                    WHEN 'checkout_started' THEN 'checkout-events' ELSE 'payment-events' END AS topic,
               count(*) AS events FROM fx_events GROUP BY 1, 2""",
    "failure_trend": """
        SELECT time_bucket(INTERVAL '1 day', event_timestamp) AS window_start,
               count(*) FILTER (payment_status = 'FAILED') AS failures, count(*) AS attempts,
               CAST(count(*) FILTER (payment_status = 'FAILED') AS DOUBLE) / count(*) AS failure_rate
        FROM fx_payments GROUP BY 1""",
    "high_risk": f"""
        WITH {ALERTS} SELECT customer_id, count(*) AS alerts, max(risk_score) AS max_score,
               CAST({total('risk_score')} AS DOUBLE) / (count(*) * 100) AS mean_score
        FROM alerts GROUP BY 1 HAVING count(*) >= 2""",
    "alerts_by_region": f"""
        WITH {ALERTS} SELECT state_code, count(*) AS alerts FROM alerts a
        LEFT JOIN fx_customers c ON a.customer_id = CAST(c.customer_id AS VARCHAR) GROUP BY 1""",
    "revenue_by_category": f"""
        SELECT category, {total('line_total')} / 100.0::DOUBLE AS revenue
        FROM fx_items LEFT JOIN fx_products USING (product_id) GROUP BY 1""",
    "revenue_by_country": f"""
        SELECT country, {total('total_amount')} / 100.0::DOUBLE AS revenue
        FROM fx_orders LEFT JOIN fx_customers USING (customer_id) GROUP BY 1""",
    "availability_rollup": """
        SELECT warehouse_id, region, CAST(sum(quantity) AS BIGINT) AS units, CAST(max(capacity_units) AS BIGINT) AS capacity_units,
               CAST(sum(quantity) AS DOUBLE) / max(capacity_units) AS utilization
        FROM fx_inventory JOIN fx_warehouses USING (warehouse_id) GROUP BY 1, 2""",
    "availability_by_region": """
        WITH per AS (SELECT warehouse_id, sum(quantity) AS u FROM fx_inventory GROUP BY 1)
        SELECT region, CAST(sum(u) AS BIGINT) AS units, CAST(sum(capacity_units) AS BIGINT) AS capacity_units,
               CAST(sum(u) AS DOUBLE) / sum(capacity_units) AS utilization
        FROM per JOIN fx_warehouses USING (warehouse_id) GROUP BY 1""",
    "alert_timeline": f"""
        WITH {ALERTS} SELECT time_bucket(INTERVAL '1 day', event_timestamp) AS window_start, count(*) AS alerts,
               CAST({total('risk_score')} AS DOUBLE) / (count(*) * 100) AS mean_score FROM alerts GROUP BY 1""",
    "revenue_distribution": f"""
        SELECT CAST({cents('total_amount')} // 1000000 * 10000 AS BIGINT) AS bucket_start, count(*) AS orders,
               {total('total_amount')} / 100.0::DOUBLE AS revenue FROM fx_orders GROUP BY 1""",
    "report_position": f"""
        WITH {SUMMARY} SELECT category, row_number() OVER (ORDER BY product_count DESC, category) - 1 AS position FROM summary""",
    "latest_row": f"SELECT * FROM ({windows('1 day', 1440)}) w ORDER BY window_end DESC LIMIT 1",
    "running_revenue": f"""
        WITH {periods('month')} SELECT *, CAST(sum(CAST(round(revenue * 100) AS BIGINT)) OVER (ORDER BY period
            ROWS UNBOUNDED PRECEDING) AS BIGINT) / 100.0::DOUBLE AS running_revenue FROM periods""",
    "consecutive_failures": """
        WITH p AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY event_timestamp, event_id)
                        - row_number() OVER (PARTITION BY customer_id, payment_status ORDER BY event_timestamp, event_id) AS island
                   FROM fx_payments)
        SELECT customer_id, min(event_timestamp) AS first_failed_at, max(event_timestamp) AS last_failed_at, count(*) AS failures
        FROM p WHERE payment_status = 'FAILED' GROUP BY customer_id, island HAVING count(*) >= 3""",
    "rapid_failure_alerts": f"""
        WITH f AS (SELECT *, count(*) OVER (PARTITION BY customer_id ORDER BY event_timestamp
                        RANGE BETWEEN INTERVAL '43200 seconds' PRECEDING AND CURRENT ROW) AS n
                   FROM fx_payments WHERE payment_status = 'FAILED')
        SELECT 'ALT-' || upper(substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS alert_id, event_timestamp,
               CAST(customer_id AS VARCHAR) AS customer_id, 'N/A' AS order_id, {score('amount', 'event_id')} AS risk_score,
               'RAPID_CONSECUTIVE_FAILURES' AS rule_violated, '2 or more failed payments within 43200 seconds' AS details
        FROM f WHERE n >= 2""",
    "rapid_failures_at_one_instant": """
        WITH f AS (SELECT event_id, customer_id, date_trunc('day', event_timestamp)::TIMESTAMP AS event_timestamp
                   FROM fx_payments WHERE payment_status = 'FAILED')
        SELECT * FROM f QUALIFY count(*) OVER (PARTITION BY customer_id ORDER BY event_timestamp
            RANGE BETWEEN INTERVAL '43200 seconds' PRECEDING AND CURRENT ROW) >= 2""",
    "non_finite_amounts": f"""
        SELECT event_id % 5 AS k, CASE WHEN event_id % 5 < 3 THEN 'Negative transaction monetary value or zero quantity' END AS dlq_reason,
               count(*) AS n, CAST(sum(CASE WHEN event_id % 5 < 3 THEN 0 ELSE floor(amount * 100 + 0.5) END) AS BIGINT) AS cents
        FROM fx_events GROUP BY 1, 2""",
    "whole_decimals": """
        SELECT CASE WHEN event_id % 7 <> 0 THEN CAST(event_id AS VARCHAR) END AS event_id,
               CASE WHEN event_id % 7 <> 0 THEN CAST(quantity AS INTEGER) END AS quantity,
               CASE WHEN event_id % 7 = 0 THEN '{"event_id":"' || event_id || '","quantity":' || quantity || '.5}' END AS line
        FROM fx_events""",
    "run_pipeline": """
        SELECT 'o' || event_id AS event_id, CAST(o.customer_id AS VARCHAR) AS customer_id, total_amount, coalesce(loyalty_tier, 'Standard') AS loyalty_tier
        FROM fx_orders o LEFT JOIN fx_customers c
        ON o.customer_id = c.customer_id AND (c.customer_id % 2 = 0 OR o.event_timestamp >= '1996-01-01')""",
    "lake_batch_and_stream": f"""
        SELECT 'revenue' AS kind, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS name, revenue AS value FROM ({windows('1 hour', 60)}) w
        UNION ALL SELECT 'alert', CAST(event_id AS VARCHAR), 1.0::DOUBLE FROM fx_payments WHERE payment_status = 'FAILED'""",
    "dashboard": """
        WITH n AS (SELECT count(*) FILTER (event_type = 'add_to_cart') AS c, count(*) FILTER (event_type = 'checkout_started') AS k,
                          count(*) FILTER (payment_status = 'FAILED') AS f FROM fx_events)
        SELECT 'total_carts_initiated' AS name, c::DOUBLE AS value FROM n UNION ALL SELECT 'total_checkouts_completed', k FROM n
        UNION ALL SELECT 'cart_abandonment_percentage', floor((greatest(c - k, 0) * 2000 + c) / (2.0 * c))::DOUBLE / 10 FROM n
        UNION ALL SELECT 'alerts', f FROM n""",
    "enriched_payments": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(p.customer_id AS VARCHAR) AS customer_id, payment_method, coalesce(loyalty_tier, 'Standard') AS loyalty_tier
        FROM fx_payments p LEFT JOIN fx_customers c ON p.customer_id = c.customer_id AND c.customer_id % 2 = 0""",
    "rolled_up_revenue": f"""
        SELECT strftime(event_timestamp, '%Y-%m') AS period, CAST(sum({cents('total_amount')}) AS DOUBLE) / 100 AS revenue, count(*) AS orders
        FROM fx_orders GROUP BY 1""",
    "views_trend": """
        SELECT strftime(event_timestamp, '%Y-%m-%d') AS window_start, count(*) AS views FROM fx_events
        WHERE event_type = 'product_view' GROUP BY 1""",
    "run_hour": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CASE event_type WHEN 'add_to_cart' THEN 'cart-events' ELSE 'product-view-events' END AS topic,
               CAST(customer_id AS VARCHAR) AS customer_id, event_timestamp FROM fx_events
        WHERE event_type IN ('add_to_cart', 'product_view') AND event_timestamp >= '2024-01-10 05:00:00' AND event_timestamp < '2024-01-10 08:00:00'""",
    "read_latest_write": "SELECT event_id, product_id FROM fx_events WHERE event_type = 'add_to_cart' AND product_id % 2 = 0",
    "assign_sessions": f"""
        WITH {sessions('fx_events', 21600)} SELECT event_id, customer_id, event_timestamp, session_no FROM numbered""",
    "gap_sessions": f"""
        WITH {sessions('fx_events', 21600)} SELECT customer_id, session_no, min(event_timestamp) AS session_start,
               max(event_timestamp) AS session_end, count(*) AS events FROM numbered GROUP BY 1, 2""",
    "first_by_key": """
        SELECT * FROM fx_events QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY event_timestamp, event_id) = 1""",
    "period_change": f"""
        WITH {periods('month')}, p AS (SELECT *, lag(revenue) OVER (ORDER BY period) AS previous_revenue FROM periods),
             c AS (SELECT *, CAST(CAST(round(revenue * 100) AS BIGINT) - CAST(round(previous_revenue * 100) AS BIGINT) AS DOUBLE)
                          / 100 AS change FROM p)
        SELECT *, change / previous_revenue AS change_rate FROM c""",
    "latest_events": """
        WITH e AS (SELECT *, CASE event_type WHEN 'product_view' THEN 'product-view-events' WHEN 'add_to_cart' THEN 'cart-events'
                    WHEN 'checkout_started' THEN 'checkout-events' ELSE 'payment-events' END AS topic FROM fx_events)
        SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY topic ORDER BY event_timestamp DESC, event_id DESC) <= 50""",
    "latest_events_overall": "SELECT * FROM fx_events ORDER BY event_timestamp DESC, event_id DESC LIMIT 50",
    "rank_report": "SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units FROM fx_items GROUP BY 1 ORDER BY 2 DESC, 1",
    "top_categories": f"WITH {SUMMARY} SELECT * FROM summary ORDER BY product_count DESC, category LIMIT 10",
    "top_segments": f"WITH {LOYALTY} SELECT * FROM loyalty ORDER BY total_customers DESC, loyalty_tier, state_code LIMIT 12",
    "latest_alerts": f"WITH {ALERTS} SELECT * FROM alerts ORDER BY event_timestamp DESC, alert_id LIMIT 100",
    "kpi_trend": f"SELECT * FROM ({windows('1 day', 1440)}) w ORDER BY window_end DESC LIMIT 30",
    "head_by_key": "SELECT * FROM fx_customers ORDER BY customer_id LIMIT 100",
    "top_products": """
        SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units FROM fx_items GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "slow_movers": """
        WITH sold AS (SELECT product_id + 10 AS product_id, CAST(sum(quantity) AS BIGINT) AS u FROM fx_items GROUP BY 1)
        SELECT product_id, coalesce(u, 0) AS units FROM fx_products LEFT JOIN sold USING (product_id) ORDER BY 2, 1 LIMIT 20""",
    "trending_products": """
        SELECT time_bucket(INTERVAL '1 day', event_timestamp) AS window_start, product_id, count(*) AS views
        FROM fx_events WHERE event_type = 'product_view' GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY 1, time_bucket(INTERVAL '1 day', event_timestamp)
                                   ORDER BY count(*) DESC, product_id) <= 5""",
    "concat_tables": """
        WITH c AS (SELECT event_id, customer_id, event_timestamp, product_id, NULL AS payment_method
                   FROM fx_events WHERE event_type = 'add_to_cart')
        SELECT * FROM c UNION ALL SELECT * FROM c UNION ALL
        SELECT event_id, customer_id, event_timestamp, NULL, payment_method FROM fx_payments""",
    "activity_feed": f"""
        WITH e AS (
            SELECT CAST(event_id AS VARCHAR) AS event_id, event_timestamp, event_type, customer_id, '-' AS order_id,
                   amount, '-' AS source FROM fx_events
            UNION ALL SELECT event_id, event_timestamp, '-', customer_id, CAST(order_id AS VARCHAR), total_amount, 'web' FROM fx_orders)
        SELECT CAST(event_timestamp AS VARCHAR) AS event_timestamp, event_type, CAST(customer_id AS VARCHAR) AS customer_id,
               order_id, {amount_text('amount')} AS amount, source
        FROM e ORDER BY e.event_timestamp DESC, event_id LIMIT 25""",
    "feed_rows": f"""
        SELECT CAST(event_timestamp AS VARCHAR) AS event_timestamp, event_type, CAST(customer_id AS VARCHAR) AS customer_id,
               '-' AS order_id, {amount_text('coalesce(amount, quantity)')} AS amount, '-' AS source FROM fx_dirty""",
    "risk_score": f"""
        SELECT CAST(event_id AS VARCHAR) AS event_id, {score('amount', 'event_id')} AS risk_score FROM fx_payments
        UNION ALL SELECT 'o' || event_id, {score('total_amount', "'o' || event_id")} FROM fx_orders""",
    "alert_id": """
        SELECT event_id, 'ALT-' || upper(substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS alert_id,
               'ALT-' || upper(md5(CAST(event_id AS VARCHAR))) AS long_alert_id FROM fx_events""",
    "alert_details": f"""
        SELECT event_id, 'Failed attempt of BRL ' || {amount_text('amount')} || ' via ' || payment_method AS details FROM fx_payments""",
    "default_fill": """
        SELECT event_timestamp, coalesce(CAST(event_id AS VARCHAR), 'N/A') AS event_id,
               coalesce(amount, 49.99::DOUBLE) AS amount FROM fx_dirty""",
    "brand_name": "SELECT p_partkey, 'Olist_Certified_' || upper(left(p_type, 4)) AS brand FROM part",
    "merchant_name": "SELECT s_suppkey, 'Partner_Merchant_' || left(s_name, 6) AS seller_name FROM supplier",
    "line_value": f"""
        SELECT l_orderkey, l_partkey, l_quantity, CAST({cents('l_extendedprice')} * CAST(l_quantity AS BIGINT) AS DOUBLE) / 100
               AS line_value FROM lineitem""",
    "money": f"""
        SELECT l_orderkey, l_partkey, CAST(({cents('l_extendedprice')} + 5) // 10 AS DOUBLE) / 10 AS one_decimal,
               CAST(({cents('l_extendedprice')} + 50) // 100 AS DOUBLE) AS whole, {cents('l_extendedprice')} AS cents FROM lineitem""",
    "normalize_event_time": "SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS event_timestamp FROM events",
    "explode_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product_id, l_linenumber AS quantity,
               l_extendedprice AS price FROM lineitem WHERE l_linenumber < 6
        UNION ALL SELECT l_orderkey, l_linenumber, l_suppkey, 1, l_quantity FROM lineitem WHERE l_linenumber < 6
        UNION ALL SELECT l_orderkey, l_linenumber, NULL, NULL, NULL FROM lineitem WHERE l_linenumber >= 6""",
    "items_total": f"""
        SELECT l_orderkey AS order_id, l_linenumber AS line,
               CASE WHEN l_linenumber = 7 THEN 0.0::DOUBLE
                    WHEN l_linenumber < 6 THEN CAST({cents('l_extendedprice')} * l_linenumber + {cents('l_quantity')} AS DOUBLE) / 100
               END AS total FROM lineitem""",
    "payload_round_trip": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(customer_id AS VARCHAR) AS customer_id, amount, quantity,
               payment_method, true AS fits FROM fx_events""",
    "time_partitions": """
        SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
               strftime(ts, '%H') AS hour FROM events""",
    "payment_event_type": """
        SELECT event_id, payment_status, CASE WHEN payment_status = 'SUCCESS' THEN 'payment_completed'
               ELSE 'payment_failed' END AS event_type FROM fx_events""",
    "event_header": """
        SELECT *, '1.0' AS event_version, 'order_completed' AS event_type, 'event-generator' AS producer, 'web' AS source
        FROM fx_orders""",
    "upgrade_event": """
        SELECT event_id, CASE WHEN quantity > 2 THEN '1.1' ELSE '1.0' END AS event_version, CAST(NULL AS VARCHAR) AS device,
               CAST(NULL AS VARCHAR) AS campaign FROM fx_events""",
    "weighted_label": f"""
        WITH d AS (SELECT c_custkey, CAST({draw("c_custkey || ':tier'")} AS DOUBLE) / 268435456 AS u,
                          2022 + {draw("c_custkey || ':year'")} % 4 AS signup_year FROM customer)
        SELECT c_custkey, CASE WHEN u < 0.5 THEN 'Bronze' WHEN u < 0.8 THEN 'Silver' WHEN u < 0.95 THEN 'Gold'
               ELSE 'Platinum' END AS loyalty_tier, signup_year FROM d""",
    "hash_uniform": f"""
        SELECT s_suppkey, 3.5::DOUBLE + CAST({draw('s_suppkey')} AS DOUBLE) / 268435456 * 1.5::DOUBLE AS rating FROM supplier""",
}

CLOSED = "(SELECT max(event_timestamp) - INTERVAL '10 minutes' FROM {})"
PRICED = "priced AS (SELECT event_id, event_timestamp, customer_id, event_type, amount - 5 AS amount FROM fx_events)"

STREAMS = {
    "stream_valid": f"WITH {PRICED} SELECT * FROM priced WHERE amount >= 0 AND event_type <> 'checkout_started'",
    "stream_rejects": f"""
        WITH {PRICED} SELECT *, CASE WHEN amount < 0 THEN '{RANGE_REASON}' ELSE 'Unknown event type' END AS dlq_reason
        FROM priced WHERE amount < 0 OR event_type = 'checkout_started'""",
    "stream_enrich": """
        SELECT event_id, customer_id, amount, coalesce(loyalty_tier, 'Standard') AS loyalty_tier, city, state_code
        FROM fx_events LEFT JOIN fx_customers USING (customer_id) WHERE event_type = 'payment_completed'""",
    "stream_dedupe": "SELECT event_id, event_timestamp, customer_id FROM fx_events",
    "stream_revenue": f"""
        WITH paid AS (SELECT * FROM fx_events WHERE event_type = 'payment_completed'), w AS ({windows('1 hour', 60, 'paid', 'amount')})
        SELECT * FROM w WHERE window_end <= {CLOSED.format('paid')}""",
    "stream_sliding_failures": f"""
        WITH w AS (
            SELECT time_bucket(INTERVAL '6 hours', event_timestamp) - o * INTERVAL '6 hours' AS window_start, customer_id, count(*) AS failures
            FROM fx_events CROSS JOIN (SELECT unnest([0, 1]) AS o) x WHERE payment_status = 'FAILED' GROUP BY 1, 2)
        SELECT window_start, window_start + INTERVAL '12 hours' AS window_end, customer_id, failures FROM w
        WHERE window_start + INTERVAL '12 hours' <= {CLOSED.format("fx_events WHERE payment_status = 'FAILED'")}""",
    "stream_sessions": f"""
        WITH {sessions('fx_events', 21600)}, s AS (
            SELECT customer_id, min(event_timestamp) AS session_start, max(event_timestamp) AS session_end, count(*) AS events
            FROM numbered GROUP BY customer_id, session_no)
        SELECT * FROM s WHERE session_end + INTERVAL '6 hours' <= {CLOSED.format('fx_events')}""",
    # A cart is given up once the watermark has passed every bucket it could still meet.
    "stream_abandonment": f"""
        WITH lost AS ({SQL['abandoned_carts']})
        SELECT event_id, customer_id, event_timestamp FROM lost
        WHERE event_timestamp + INTERVAL '90000 seconds' < least({CLOSED.format("fx_events WHERE event_type = 'add_to_cart'")},
                                                                {CLOSED.format("fx_events WHERE event_type = 'checkout_started'")})""",
    "stream_failure_streaks": f"""
        WITH p AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY event_timestamp, event_id)
                        - row_number() OVER (PARTITION BY customer_id, payment_status ORDER BY event_timestamp, event_id) AS island
                   FROM fx_payments),
             r AS (SELECT customer_id, min(event_timestamp) OVER w AS first_failed_at, event_timestamp AS reached_at,
                          row_number() OVER (w ORDER BY event_timestamp, event_id) AS failures
                   FROM p WHERE payment_status = 'FAILED' WINDOW w AS (PARTITION BY customer_id, island))
        SELECT * FROM r WHERE failures = 3 AND reached_at < {CLOSED.format('fx_payments')}""",
    "stream_alerts": f"WITH {ALERTS} SELECT * FROM alerts",
    "stream_active_users": f"""
        SELECT date_trunc('day', event_timestamp) AS day, count(DISTINCT customer_id) AS customers, true AS within FROM fx_events
        WHERE time_bucket(INTERVAL '1 hour', event_timestamp) + INTERVAL '1 hour' <= {CLOSED.format('fx_events')} GROUP BY 1""",
    "late_rows": """
        WITH b AS (
            SELECT event_id, event_timestamp, 1 + (event_timestamp >= '2024-01-08')::INT + (event_timestamp >= '2024-01-15')::INT
                   + (event_timestamp >= '2024-01-22')::INT + (event_id % 10 = 0)::INT AS batch FROM fx_events),
        m AS (SELECT batch, max(event_timestamp) AS newest FROM b GROUP BY batch),
        w AS (SELECT b.batch, max(m.newest) - INTERVAL '12 hours' AS mark FROM (SELECT DISTINCT batch FROM b) b JOIN m ON m.batch < b.batch GROUP BY b.batch)
        SELECT event_id, event_timestamp, (epoch_us(mark) - epoch_us(event_timestamp)) / 1000000.0::DOUBLE AS late_seconds
        FROM b JOIN w USING (batch) WHERE event_timestamp < mark""",
    "recovery": """
        SELECT table_name, CAST(event_id AS VARCHAR) AS event_id FROM fx_payments, (SELECT unnest(['alerts', 'archive']) AS table_name) n
        WHERE payment_status = 'FAILED'""",
}

TOPIC = """CASE event_type WHEN 'product_view' THEN 'product-view-events' WHEN 'add_to_cart' THEN 'cart-events'
    WHEN 'checkout_started' THEN 'checkout-events' ELSE 'payment-events' END"""
RAW_LINES = f"""
    SELECT CASE WHEN product_id <> 7 THEN CAST(event_id AS VARCHAR) END AS event_id,
           CASE WHEN product_id <> 7 THEN CAST(customer_id AS VARCHAR) END AS customer_id,
           CASE WHEN product_id <> 7 THEN amount END AS amount,
           CASE WHEN product_id <> 7 THEN payment_method END AS payment_method,
           {TOPIC} AS topic, product_id <> 7 AS fits FROM fx_events"""

LAKE = {
    "read_events": RAW_LINES,
    "stream_events": RAW_LINES,
    "valid_events": f"""
        SELECT CAST(event_id AS VARCHAR) AS event_id, event_timestamp, CAST(customer_id AS VARCHAR) AS customer_id, amount,
               {TOPIC} AS topic FROM fx_events WHERE product_id <> 7""",
    "for_hour": "SELECT event_id, event_timestamp, amount FROM fx_events WHERE CAST(event_timestamp AS DATE) = DATE '2024-01-10'",
    "write_partitioned": """
        SELECT event_type, year(event_timestamp) AS year, month(event_timestamp) AS month, day(event_timestamp) AS day,
               count(*) AS events FROM fx_events GROUP BY ALL""",
    "read_lake_table": """
        SELECT event_id, product_id, NULL AS payment_method FROM fx_events WHERE event_type = 'add_to_cart'
        UNION ALL SELECT event_id, NULL, payment_method FROM fx_payments""",
    "read_master_csv": "SELECT p_retailprice, p_partkey, p_name FROM part",
    "write_report": "SELECT * FROM fx_products",
    "export_json_sample": "SELECT * FROM fx_customers ORDER BY customer_id LIMIT 200",
    "write_rejects": SQL["split_rejected"],
    "insert_two_writers": "SELECT event_id, event_timestamp, customer_id FROM fx_payments",
    "insert_if_absent": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, event_timestamp, CAST(customer_id AS VARCHAR) AS customer_id,
               CASE WHEN customer_id % 2 = 0 THEN 'first' ELSE 'second' END AS batch
        FROM fx_payments WHERE payment_status = 'FAILED'""",
    "write_multi": f"WITH {ALERTS} SELECT alert_id, risk_score FROM alerts UNION ALL SELECT alert_id, risk_score FROM alerts",
    "read_first_available": "SELECT * FROM fx_orders",
    "load_master": f"""
        WITH prices AS (SELECT product_id + 100 AS product_id, {half_up(total('line_total'), 'count(*)')} AS price
                        FROM fx_items GROUP BY 1)
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, lower(p_type) AS category,
               'Olist_Certified_' || upper(left(p_type, 4)) AS brand, coalesce(price, 49.99::DOUBLE) AS unit_price,
               'BRL' AS currency, CAST(p_size AS DOUBLE) AS product_weight_g
        FROM part LEFT JOIN prices ON p_partkey = product_id""",
    "uuid_format": """
        SELECT CASE WHEN event_type = 'add_to_cart' THEN d
                    ELSE concat_ws('-', substr(d, 1, 8), substr(d, 9, 4), substr(d, 13, 4), substr(d, 17, 4), substr(d, 21, 12))
               END AS event_id, event_type, CASE WHEN event_type = 'add_to_cart' THEN 'Invalid UUID' END AS dlq_reason
        FROM (SELECT md5(CAST(event_id AS VARCHAR)) AS d, event_type FROM fx_events) x""",
}


def statements() -> dict[str, str]:
    return {name: with_tables(body) for name, body in (SQL | STREAMS | LAKE).items()}
