"""Enrichment against master tables, integrity checks and cart abandonment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstream.functions.events import explode_items
from shopstream.functions.hashing import hash_integer
from shopstream.functions.money import cents, rounded_mean
from shopstream.functions.text import DEFAULT_UNIT_PRICE, GENERAL_CATEGORY, STANDARD_TIER, default_fill
from shopstream.operators.skew import lookup, micros, time_slice


def _suffixed(fact: DataFrame, dim: DataFrame, key: str, suffix: str) -> DataFrame:
    clash = {c: c + suffix for c in dim.columns if c != key and c in fact.columns}
    return dim.withColumnsRenamed(clash)


def enrich_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Adds tier, city and state; an unknown customer gets the standard tier."""
    dim = customers.select(*[c for c in ("customer_id", "loyalty_tier", "city", "state_code") if c in customers.columns])
    joined = lookup(orders, dim, "customer_id")
    return joined.withColumn("loyalty_tier", default_fill(F.col("loyalty_tier"), STANDARD_TIER))


def enrich_views(views: DataFrame, products: DataFrame, suffix: str = "_master") -> DataFrame:
    """Adds category, brand and unit price; a column the views already have gets the suffix."""
    dim = products.select("product_id", "category", "brand", "unit_price")
    return lookup(views, _suffixed(views, dim, "product_id", suffix), "product_id")


def translate_category(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Adds the English category name; untranslated ones become general merchandise."""
    dim = translation.select("product_category_name", F.col("product_category_name_english").alias("category"))
    joined = lookup(products, dim, "product_category_name")
    return joined.withColumn("category", default_fill(F.col("category"), GENERAL_CATEGORY))


def mean_price(items: DataFrame) -> DataFrame:
    """Mean item price per product."""
    total = items.groupBy("product_id").agg(F.sum(cents("price")).alias("_cents"), F.count("price").alias("_n"))
    return total.select("product_id", rounded_mean(F.col("_cents"), F.col("_n")).alias("unit_price"))


def attach_prices(products: DataFrame, items: DataFrame) -> DataFrame:
    """Adds each product's mean selling price; one never sold gets the default price."""
    joined = lookup(products, mean_price(items), "product_id")
    return joined.withColumn("unit_price", default_fill(F.col("unit_price"), DEFAULT_UNIT_PRICE))


def build_inventory(products: DataFrame, warehouses: Sequence[int] = (1, 2, 3, 4, 5)) -> DataFrame:
    """Stock lines for every product in every warehouse."""
    lines = products.select("product_id").withColumn("warehouse_id", F.explode(F.array(*[F.lit(w) for w in warehouses])))
    inventory_id = F.concat_ws("-", F.lit("INV"), F.col("product_id"), F.col("warehouse_id"))
    return lines.select(
        inventory_id.alias("inventory_id"),
        "product_id",
        "warehouse_id",
        hash_integer(F.concat(inventory_id, F.lit(":quantity")), 10, 500).alias("quantity"),
        hash_integer(F.concat(inventory_id, F.lit(":reserved")), 0, 5).alias("reserved_quantity"),
    )


def enrich_payments(payments: DataFrame, customers: DataFrame) -> DataFrame:
    """Adds the customer's tier to payments."""
    joined = lookup(payments, customers.select("customer_id", "loyalty_tier"), "customer_id")
    return joined.withColumn("loyalty_tier", default_fill(F.col("loyalty_tier"), STANDARD_TIER))


def enrich_order_items(
    orders: DataFrame, products: DataFrame, sellers: DataFrame, product_sellers: DataFrame | None = None
) -> DataFrame:
    """One row per order line with its product and seller.

    `product_sellers` says which seller offers a product (product_id, seller_id); leave
    it out where the lines carry a seller_id themselves.
    """
    lines = explode_items(orders) if "items" in orders.columns else orders
    if product_sellers is not None:
        lines = lookup(lines, product_sellers.select("product_id", "seller_id"), "product_id")
    catalogue = products.select("product_id", "category", "brand")
    with_product = lookup(lines, _suffixed(lines, catalogue, "product_id", "_master"), "product_id")
    partners = sellers.select("seller_id", "seller_name", F.col("state").alias("seller_state"))
    return lookup(with_product, partners, "seller_id")


def enrich_inventory(updates: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Adds the warehouse's city and region to stock changes."""
    return lookup(updates, warehouses.select("warehouse_id", "city", "region"), "warehouse_id")


def abandoned_carts(carts: DataFrame, checkouts: DataFrame, within: int, key: str = "customer_id") -> DataFrame:
    """Cart events whose customer starts no checkout in the next `within` seconds.

    Carts and checkouts of a customer are merged in time order, newest first, and each
    cart sees the nearest later checkout: no cart is paired with every checkout. Time
    is cut into slices of `within` seconds and a checkout is also shown to the slice
    before its own, so a busy customer is spread over many tasks. Carts without a customer
    can meet no checkout and go round the window.
    """
    cart_rows = carts.filter(F.col(key).isNotNull()).withColumns({"_slice": time_slice("event_timestamp", within), "_checkout": F.lit(None).cast("long")})
    shown = F.explode(F.array(F.col("_slice"), F.col("_slice") - 1))
    checkout_rows = (
        checkouts.filter(F.col(key).isNotNull())
        .select(key, "event_timestamp", time_slice("event_timestamp", within).alias("_slice"))
        .withColumns({"_slice": shown, "_checkout": micros("event_timestamp")})
    )
    # At one instant a checkout comes before a cart, so that the cart sees it.
    newest_first = (
        Window.partitionBy(key, "_slice")
        .orderBy(F.col("event_timestamp").desc(), F.col("_checkout").desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    merged = cart_rows.unionByName(checkout_rows, allowMissingColumns=True)
    gap = F.min("_checkout").over(newest_first) - micros("event_timestamp")
    seen = merged.withColumn("_gap", gap).filter(F.col("_checkout").isNull())
    missed = seen.filter(F.col("_gap").isNull() | (F.col("_gap") > within * 1_000_000))
    return missed.select(*carts.columns).unionByName(carts.filter(F.col(key).isNull()))


def orphans(fact: DataFrame, dim: DataFrame, key: str, known: bool = False) -> DataFrame:
    """Rows whose key has no master row, or with known=True those that have one."""
    keys = dim.select(key).filter(F.col(key).isNotNull()).distinct()
    return lookup(fact, keys, key, "left_semi" if known else "left_anti")
