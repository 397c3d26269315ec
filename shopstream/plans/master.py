"""Master tables from raw files."""

from __future__ import annotations

from collections.abc import Mapping
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.functions.hashing import hash_integer, hash_uniform, weighted_label
from shopstream.functions.text import brand_name, merchant_name
from shopstream.operators.joins import attach_prices, build_inventory, translate_category
from shopstream.operators.validation import project
from shopstream.sources import schemas as s
from shopstream.sources.readers import read_master_csv
from shopstream.sources.sinks import export_json_sample, insert_if_absent, write_report

# Tiers with their shares, signup years, ratings and country of the master data.
TIERS, TIER_SHARES = ("Bronze", "Silver", "Gold", "Platinum"), (0.5, 0.3, 0.15, 0.05)
FIRST_YEAR, LAST_YEAR = 2022, 2025
RATING_LOW, RATING_HIGH = 3.5, 5.0
COUNTRY, CURRENCY = "Brazil", "BRL"
STOCK_TAKEN_AT = "2026-07-30T22:00:00Z"

# Raw file of each input; load_master takes other names.
FILES = {
    "customers": "customers.csv",
    "products": "products.csv",
    "sellers": "sellers.csv",
    "translation": "category_translation.csv",
    "items": "order_items.csv",
}
MASTER_KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "sellers": "seller_id",
    "warehouses": "warehouse_id",
    "inventory": "inventory_id",
}


def build_customers(raw: DataFrame) -> DataFrame:
    """Customers with tier and signup year drawn from the customer id."""

    def salted(name: str):
        return F.concat(F.col("customer_id"), F.lit(":" + name))

    return project(
        raw,
        {
            "customer_id": "customer_id",
            "customer_unique_id": "customer_unique_id",
            "city": "customer_city",
            "state_code": "customer_state",
            "loyalty_tier": weighted_label(salted("tier"), TIERS, TIER_SHARES),
            "country": F.lit(COUNTRY),
            "signup_year": hash_integer(salted("year"), FIRST_YEAR, LAST_YEAR + 1).cast("int"),
        },
    )


def build_products(raw: DataFrame, translation: DataFrame, items: DataFrame) -> DataFrame:
    """Products with English category, brand and mean selling price."""
    priced = attach_prices(translate_category(raw, translation), items)
    sizes = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
    return project(
        priced,
        {
            "product_id": "product_id",
            "category": "category",
            "brand": brand_name(F.col("category")),
            "unit_price": "unit_price",
            "currency": F.lit(CURRENCY),
        }
        | {c: c for c in sizes},
    )


def build_sellers(raw: DataFrame) -> DataFrame:
    """Sellers with a display name and a rating drawn from the seller id."""
    return project(
        raw,
        {
            "seller_id": "seller_id",
            "city": "seller_city",
            "state": "seller_state",
            "seller_name": merchant_name(F.col("seller_id")),
            "country": F.lit(COUNTRY),
            "rating": F.round(hash_uniform(F.col("seller_id"), RATING_LOW, RATING_HIGH), 1),
        },
    )


def build_warehouses(spark: SparkSession) -> DataFrame:
    """The five warehouses."""
    names = s.WAREHOUSE_SCHEMA.names
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in s.WAREHOUSES]
    return spark.range(1).select(F.inline(F.array(*rows)))


def build_stock(products: DataFrame) -> DataFrame:
    """Inventory with the time of the stock count."""
    counted_at = F.to_timestamp(F.lit(STOCK_TAKEN_AT))
    return build_inventory(products, [w[0] for w in s.WAREHOUSES]).withColumn("last_updated", counted_at)


def load_master(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    files: Mapping[str, str] = MappingProxyType(FILES),
    sample_rows: int | None = None,
) -> dict[str, str]:
    """Writes all master tables as Parquet, on request with a JSON sample each; returns their paths."""
    schema = {
        "customers": s.RAW_CUSTOMERS,
        "products": s.RAW_PRODUCTS,
        "sellers": s.RAW_SELLERS,
        "translation": s.RAW_TRANSLATION,
        "items": s.RAW_ITEMS,
    }
    raw = {name: read_master_csv(spark, f"{raw_dir}/{file}", schema[name]) for name, file in files.items()}
    paths = {name: f"{out_dir}/{name}.parquet" for name in MASTER_KEYS}
    write_report(build_customers(raw["customers"]), paths["customers"])
    write_report(build_products(raw["products"], raw["translation"], raw["items"]), paths["products"])
    write_report(build_sellers(raw["sellers"]), paths["sellers"])
    write_report(build_warehouses(spark), paths["warehouses"])
    write_report(build_stock(spark.read.parquet(paths["products"])), paths["inventory"])
    if sample_rows is not None:
        for name, key in MASTER_KEYS.items():
            export_json_sample(spark.read.parquet(paths[name]), f"{out_dir}/{name}.json", key, sample_rows)
    return paths


def seed_tables(spark: SparkSession, master: dict[str, str], target_dir: str) -> None:
    """Inserts the master rows the serving tables do not have yet."""
    for name, key in MASTER_KEYS.items():
        insert_if_absent(spark.read.parquet(master[name]), f"{target_dir}/{name}", key, order=())
