"""The test tables seen as retail tables, once as DataFrames and once as SQL."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.plans.master import build_warehouses
from shopstream.sources.schemas import WAREHOUSES

METHODS = ["Credit Card", "Boleto", "Pix", "Debit Card", "Voucher"]
DEVICES = ["mobile", "desktop", "tablet"]
EVENT_TYPES = {"signup": "checkout_started", "view": "product_view", "click": "add_to_cart", "purchase": "payment_completed"}


@cache
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table; its files are listed and their schema read once per session."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def utc(ts: Column) -> Column:
    """An instant as wall-clock time in UTC, whatever the session's zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth customer is left out so that left joins miss."""
    people = table(spark, sf, "customer").filter(F.col("c_custkey") % 10 != 0)
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    placed = people.join(nation, people.c_nationkey == nation.n_nationkey, "left")
    placed = placed.join(region, nation.n_regionkey == region.r_regionkey, "left")
    return placed.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("loyalty_tier"),
        F.col("c_name").alias("city"),
        F.col("n_name").alias("state_code"),
        F.col("r_name").alias("country"),
    )


def products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("unit_price"),
    )


def sellers(spark: SparkSession, sf: str) -> DataFrame:
    supplier, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left").select(
        F.col("s_suppkey").alias("seller_id"), F.col("s_name").alias("seller_name"), F.col("n_name").alias("state")
    )


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("event_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderdate").alias("event_timestamp"),
    )


def items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("line_total"),
    )


def _number() -> Column:
    return F.regexp_extract("props", "[0-9]+", 0).cast("int")


def event_columns(raw: DataFrame) -> DataFrame:
    k = _number()
    kind = F.col("event_type")
    named = F.lit("payment_failed")
    for old, new in EVENT_TYPES.items():
        named = F.when(kind == old, new).otherwise(named)
    return raw.select(
        "event_id",
        F.col("ts").alias("event_timestamp"),
        F.col("user_id").alias("customer_id"),
        F.col("value").alias("amount"),
        named.alias("event_type"),
        k.alias("product_id"),
        (k % 4 + 1).alias("quantity"),
        F.element_at(F.array(*[F.lit(m) for m in METHODS]), k % 5 + 1).alias("payment_method"),
        F.element_at(F.array(*[F.lit(d) for d in DEVICES]), k % 3 + 1).alias("device"),
        F.when(kind == "purchase", "SUCCESS").when(kind == "error", "FAILED").alias("payment_status"),
    )


def events(spark: SparkSession, sf: str) -> DataFrame:
    return event_columns(table(spark, sf, "events"))


def of_type(spark: SparkSession, sf: str, *types: str) -> DataFrame:
    return events(spark, sf).filter(F.col("event_type").isin(*types))


def payments(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).filter(F.col("payment_status").isNotNull())


def session_events(spark: SparkSession, sf: str) -> DataFrame:
    """Clickstream in which events on even product numbers carry a session id."""
    own = F.concat_ws("-", F.lit("S"), F.col("customer_id"), F.col("product_id") % 10)
    return events(spark, sf).withColumn("session_id", F.when(F.col("product_id") % 2 == 0, own))


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Missing ids, negative amounts, zero quantities, orphan customers, duplicates."""
    raw = table(spark, sf, "events")
    both = raw.unionAll(raw.filter(F.col("event_id") % 13 == 0))
    k = _number()
    return both.select(
        F.when(k % 17 != 0, F.col("event_id")).alias("event_id"),
        F.col("ts").alias("event_timestamp"),
        F.when(k % 11 == 0, -F.col("user_id") - 1).otherwise(F.col("user_id")).alias("customer_id"),
        F.when(k % 19 != 0, F.col("value") - 5).alias("amount"),
        (k % 6).alias("quantity"),
        "event_type",
    )


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    stocked = F.explode(F.sequence(F.lit(1), F.lit(5))).alias("warehouse_id")
    lines = table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), stocked)
    return lines.select(
        "product_id",
        "warehouse_id",
        ((F.col("product_id") * 31 + F.col("warehouse_id") * 17) % 490 + 10).alias("quantity"),
        ((F.col("product_id") + F.col("warehouse_id")) % 5).alias("reserved_quantity"),
    )


def warehouses(spark: SparkSession, sf: str) -> DataFrame:
    return build_warehouses(spark)


_METHOD_CASE = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(METHODS))
_DEVICE_CASE = " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(DEVICES))
_TYPE_CASE = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in EVENT_TYPES.items())
_K = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k"

SQL = {
    "fx_customers": """
        SELECT c_custkey AS customer_id, c_mktsegment AS loyalty_tier, c_name AS city,
               n_name AS state_code, r_name AS country
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey WHERE c_custkey % 10 <> 0""",
    "fx_products": "SELECT p_partkey AS product_id, p_type AS category, p_brand AS brand, p_retailprice AS unit_price FROM part",
    "fx_sellers": """
        SELECT s_suppkey AS seller_id, s_name AS seller_name, n_name AS state
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "fx_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS event_id, o_orderkey AS order_id, o_custkey AS customer_id,
               o_totalprice AS total_amount, o_orderdate AS event_timestamp FROM orders""",
    "fx_items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,
               l_quantity AS quantity, l_extendedprice AS line_total FROM lineitem""",
    "fx_events": f"""
        SELECT event_id, ts AS event_timestamp, user_id AS customer_id, value AS amount,
               CASE event_type {_TYPE_CASE} ELSE 'payment_failed' END AS event_type,
               k AS product_id, k % 4 + 1 AS quantity,
               CASE k % 5 {_METHOD_CASE} END AS payment_method, CASE k % 3 {_DEVICE_CASE} END AS device,
               CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' END AS payment_status
        FROM (SELECT *, {_K} FROM events) e""",
    "fx_payments": "SELECT * FROM fx_events WHERE payment_status IS NOT NULL",
    "fx_sessions": """
        SELECT *, CASE WHEN product_id % 2 = 0 THEN concat('S-', customer_id, '-', product_id % 10) END AS session_id
        FROM fx_events""",
    "fx_dirty": f"""
        SELECT CASE WHEN k % 17 = 0 THEN NULL ELSE event_id END AS event_id, ts AS event_timestamp,
               CASE WHEN k % 11 = 0 THEN -user_id - 1 ELSE user_id END AS customer_id,
               CASE WHEN k % 19 = 0 THEN NULL ELSE value - 5 END AS amount, k % 6 AS quantity, event_type
        FROM (SELECT *, {_K} FROM events
              UNION ALL SELECT *, {_K} FROM events WHERE event_id % 13 = 0) e""",
    "fx_inventory": """
        SELECT p_partkey AS product_id, w AS warehouse_id, (p_partkey * 31 + w * 17) % 490 + 10 AS quantity,
               (p_partkey + w) % 5 AS reserved_quantity
        FROM part CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5])::INTEGER AS w) x""",
    "fx_warehouses": "SELECT * FROM (VALUES "
    + ", ".join(str(w) for w in WAREHOUSES)
    + ") AS w(warehouse_id, warehouse_name, city, region, capacity_units)",
}

NEEDS = {"fx_payments": ["fx_events"], "fx_sessions": ["fx_events"]}


def with_tables(body: str) -> str:
    """The statement with the views it names in front of it."""
    used = [name for name in SQL if name in body]
    used += [n for u in list(used) for n in NEEDS.get(u, ()) if n not in used]
    ordered = [name for name in SQL if name in used]
    if not ordered:
        return body
    views = ", ".join(f"{name} AS ({SQL[name].strip()})" for name in ordered)
    text = body.strip()
    return f"WITH {views}, {text[5:]}" if text[:5].upper() == "WITH " else f"WITH {views} {text}"
