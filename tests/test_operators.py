"""Edge cases of joins, aggregates and windows, and brute force on small inputs."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopstream.operators import aggregates as agg
from shopstream.operators import joins, sets, skew, topk, windows

T0 = datetime(2026, 8, 1)
QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def test_unknown_customer_is_standard(spark):
    orders = spark.createDataFrame([("o1", "c1"), ("o2", "c9"), ("o3", None)], "order_id string, customer_id string")
    customers = spark.createDataFrame([("c1", "Gold", "x", "SP")], "customer_id string, loyalty_tier string, city string, state_code string")
    rows = {r["order_id"]: (r["loyalty_tier"], r["city"], r["state_code"]) for r in joins.enrich_orders(orders, customers).collect()}
    assert rows == {"o1": ("Gold", "x", "SP"), "o2": ("Standard", None, None), "o3": ("Standard", None, None)}


def test_clashing_master_column_gets_the_suffix(spark):
    views = spark.createDataFrame([("p1", "games"), ("p9", "games")], "product_id string, category string")
    products = spark.createDataFrame([("p1", "toys", "b", 1.0)], "product_id string, category string, brand string, unit_price double")
    joined = joins.enrich_views(views, products)
    assert joined.columns == ["product_id", "category", "category_master", "brand", "unit_price"]
    assert {(r["product_id"], r["category"], r["category_master"]) for r in joined.collect()} == {("p1", "games", "toys"), ("p9", "games", None)}


def test_untranslated_and_unsold_products(spark):
    products = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None)], "product_id string, product_category_name string")
    english = spark.createDataFrame([("x", "toys")], "product_category_name string, product_category_name_english string")
    items = spark.createDataFrame([("a", 1.0), ("a", 2.01)], "product_id string, price double")
    got = {r["product_id"]: (r["category"], r["unit_price"]) for r in joins.attach_prices(joins.translate_category(products, english), items).collect()}
    assert got == {"a": ("toys", 1.51), "b": ("General_Merchandise", 49.99), "c": ("General_Merchandise", 49.99)}


@pytest.mark.parametrize("carts,checkouts,expected", [(0, 0, 0.0), (0, 3, 0.0), (4, 1, 75.0), (1, 4, 0.0), (3, 1, 66.7), (8, 7, 12.5), (1600, 1598, 0.1)])
def test_abandonment_rate(spark, carts, checkouts, expected):
    row = agg.cart_abandonment(spark.range(carts), spark.range(checkouts)).first()
    assert (row["total_carts_initiated"], row["total_checkouts_completed"], row["cart_abandonment_percentage"]) == (carts, checkouts, expected)


def test_no_orders_no_kpi(spark):
    empty = spark.createDataFrame([], "total_amount double")
    assert agg.revenue_kpi(empty).count() == 0
    one = agg.revenue_kpi(spark.createDataFrame([(0.1,), (0.2,), (None,)], "total_amount double")).first()
    assert (one["total_revenue_brl"], one["total_orders"], one["average_order_value"]) == (0.3, 3, 0.1)


def test_fusion_changes_only_the_top(spark):
    rows = [(None if i == 3 else f"c{i:02d}", 100 - i, 10.0) for i in range(14)]
    summary = spark.createDataFrame(rows, "category string, product_count long, avg_unit_price double")
    volume = spark.createDataFrame([(101,)], "n long")
    n = 101
    got = {r["category"]: (r["product_count"], r["avg_unit_price"]) for r in agg.fuse_category_volume(summary, volume).collect()}
    for i, (name, count, price) in enumerate(rows):
        if i < 12:
            expected = (count + int(n * (15 - min(i, 10)) / 10), round(price + (n % ((i + 1) * 7)) * 0.45 - 1.25, 2))
        else:
            expected = (count, price)
        assert got[name] == pytest.approx(expected), name
    assert {tuple(r) for r in agg.fuse_category_volume(summary, 0).collect()} == set(rows)


def test_ties_are_ordered_by_key(spark):
    customers = spark.createDataFrame([("1", "b", "y"), ("2", "a", "z"), ("3", "a", "y")], "customer_id string, loyalty_tier string, state_code string")
    rows = [(r[0], r[1]) for r in topk.top_segments(agg.loyalty_demographics(customers)).collect()]
    assert rows == [("a", "y"), ("a", "z"), ("b", "y")]
    stock = spark.createDataFrame([("b", 1), ("a", 1)], "product_id string, quantity int")
    assert [r[0] for r in topk.top_products(stock).collect()] == ["a", "b"]


def test_union_keeps_copies_and_fills_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3, 1)], "z int, x int")
    assert sorted(map(tuple, sets.concat_tables([a, b, a]).select("x", "y", "z").collect()), key=str) == [(1, 2, None), (1, 2, None), (1, None, 3)]


def test_many_rows_per_group_take_the_two_step_way(spark):
    df = spark.range(9000).select((F.col("id") % 2).alias("g"), "id").repartition(6)
    kept = skew.top_per_group(df, "g", [F.col("id").desc()], 1500)
    assert kept.groupBy("g").count().collect()[0]["count"] == 1500
    assert kept.agg(F.min("id")).first()[0] == 9000 - 3000


def brute_sessions(rows, gap):
    found, last, number = {}, {}, {}
    for c, s, i in sorted(rows):
        if c not in last or s - last[c] > gap:
            number[c] = number.get(c, 0) + 1
        last[c] = s
        found[i] = number[c]
    return found


times = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 300)), min_size=1, max_size=40, unique=True)


@QUICK
@given(times)
def test_sessions_joined_across_slices(spark, rows):
    rows = [(c, s, i) for i, (c, s) in enumerate(rows)]
    df = spark.createDataFrame([(c, at(s), i) for c, s, i in rows], "customer_id string, event_timestamp timestamp, event_id int")
    expected = brute_sessions(rows, 20)
    for length in (7, 60, 10_000):
        assert {r["event_id"]: r["session_no"] for r in windows.assign_sessions(df, 20, length).collect()} == expected
        sessions = windows.gap_sessions(df, 20, length).collect()
        assert sum(r["events"] for r in sessions) == len(rows)
        assert len(sessions) == len({(c, expected[i]) for c, _, i in rows})


payments = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 200), st.booleans()), min_size=1, max_size=40, unique_by=lambda r: r[:2])


def payment_frame(spark, rows):
    data = [(c, at(s), f"{i:04d}", "FAILED" if f else "SUCCESS", 1.0) for i, (c, s, f) in enumerate(rows)]
    return spark.createDataFrame(data, "customer_id string, event_timestamp timestamp, event_id string, payment_status string, amount double")


@QUICK
@given(payments)
def test_streaks_joined_across_slices(spark, rows):
    expected = []
    for customer in ("a", "b"):
        run = []
        for _, s, failed in sorted(r for r in rows if r[0] == customer) + [(customer, 0, False)]:
            if failed:
                run.append(s)
                continue
            if len(run) >= 2:
                expected.append((customer, at(run[0]), at(run[-1]), len(run)))
            run = []
    for length in (9, 50, 10_000):
        got = windows.consecutive_failures(payment_frame(spark, rows), 2, length).collect()
        assert sorted(map(tuple, got)) == sorted(expected)


@QUICK
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 60), st.booleans()), min_size=1, max_size=40))
def test_rapid_failures(spark, rows):
    failed = [(c, s) for c, s, f in rows if f]
    expected = sorted((c, at(s)) for c, s in failed if sum(d == c and s - 15 <= u <= s for d, u in failed) >= 3)
    got = windows.rapid_failures(payment_frame(spark, rows), 3, 15).collect()
    assert sorted((r["customer_id"], r["event_timestamp"]) for r in got) == expected


@QUICK
@given(times, times)
def test_abandoned_carts(spark, carts, checkouts):
    schema = "customer_id string, event_timestamp timestamp"
    left = spark.createDataFrame([(c, at(s)) for c, s in carts] + [(None, at(5))], schema)
    right = spark.createDataFrame([(c, at(s)) for c, s in checkouts] + [(None, at(6))], schema)
    expected = [(c, at(s)) for c, s in carts if not any(c == d and s <= u <= s + 30 for d, u in checkouts)] + [(None, at(5))]
    got = [tuple(r) for r in joins.abandoned_carts(left, right, 30).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


@QUICK
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5)), min_size=1, max_size=20))
def test_parts_make_the_whole(spark, rows):
    df = spark.createDataFrame(rows, "product_id string, quantity int")
    total = agg.share_by(df, "product_id").agg(F.sum("events"), F.sum("share_percent")).first()
    assert total[0] == len(rows) and total[1] == pytest.approx(100)
