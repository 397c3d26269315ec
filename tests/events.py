"""Hand-made events and lakes."""

from __future__ import annotations

import json
import uuid
from pathlib import Path

from shopstream.plans.master import build_warehouses


def event(topic_type: str, **fields) -> dict:
    base = {
        "event_id": str(uuid.uuid4()),
        "event_version": "1.0",
        "event_type": topic_type,
        "event_timestamp": "2026-08-01T14:22:10+00:00Z",
        "producer": "event-generator",
        "source": "web",
    }
    return base | fields


def write_lines(path: Path, lines: list) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines), encoding="utf-8")


def bronze_file(root: Path, topic: str, name: str = "part-0", hour: str = "14") -> Path:
    return root / "bronze" / topic / "year=2026" / "month=08" / "day=01" / f"hour={hour}" / f"{name}.jsonl"


def write_master(spark, root: Path) -> None:
    customers = spark.createDataFrame(
        [("c1", "u1", "sao paulo", "SP", "Gold"), ("c2", "u2", "rio", "RJ", "Silver")],
        "customer_id string, customer_unique_id string, city string, state_code string, loyalty_tier string",
    )
    products = spark.createDataFrame(
        [("p1", "toys", "b1", 10.0), ("p2", "books", "b2", 20.5)],
        "product_id string, category string, brand string, unit_price double",
    )
    customers.write.mode("overwrite").parquet(f"{root}/master/customers.parquet")
    products.write.mode("overwrite").parquet(f"{root}/master/products.parquet")
    build_warehouses(spark).write.mode("overwrite").parquet(f"{root}/master/warehouses.parquet")


def write_lake(spark, root: Path) -> None:
    """Two hours of events with copies, malformed lines and rule breakers."""
    write_master(spark, root)
    copied = event("order_completed", customer_id="c1", order_id="o1", total_amount=100.0, event_timestamp="2026-08-01T14:00:01Z")
    write_lines(
        bronze_file(root, "order-events"),
        [
            copied,
            copied,
            event("order_completed", customer_id="c9", order_id="o2", total_amount=50.5, event_timestamp="2026-08-01T14:30:00Z"),
            event("order_completed", customer_id="c2", order_id="o3", total_amount=1.0, event_id=""),
            "{bad",
            "",
            "[1]",
        ],
    )
    write_lines(
        bronze_file(root, "order-events", hour="15"),
        [event("order_completed", customer_id="c2", order_id="o4", total_amount=30.25, event_timestamp="2026-08-01T15:10:00Z")],
    )
    write_lines(
        bronze_file(root, "product-view-events"),
        [
            event("product_view", customer_id="c1", session_id="S1", product_id="p1", category="games", device="mobile"),
            event("product_view", customer_id="c1", session_id="S1", product_id="p9", category="games", device="mobile"),
        ],
    )
    write_lines(
        bronze_file(root, "cart-events"),
        [
            event("add_to_cart", customer_id="c1", product_id="p1", quantity=1, unit_price=10.0, cart_value=10.0, event_timestamp=f"2026-08-01T14:{m:02d}:00Z")
            for m in (0, 5, 10, 15)
        ]
        + [event("add_to_cart", customer_id="c2", product_id="p1", quantity=0, unit_price=10.0)],
    )
    write_lines(
        bronze_file(root, "checkout-events"),
        [event("checkout_started", customer_id="c1", order_id="o1", total_amount=100.0, event_timestamp="2026-08-01T14:12:00Z")],
    )
    write_lines(
        bronze_file(root, "payment-events"),
        [
            event("payment_failed", customer_id="c1", order_id="o1", payment_status="FAILED", payment_method="Pix", amount=800.0),
            event("payment_failed", customer_id="c1", order_id="o1", payment_status="FAILED", payment_method="Pix", amount=-0.01),
            event("payment_failed", customer_id="c1", order_id="o1", payment_status="FAILED", payment_method="Pix", amount="abc"),
            event("payment_completed", customer_id="c2", order_id="o3", payment_status="SUCCESS", payment_method="Boleto", amount=5.0),
        ],
    )
