import hashlib
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopstream.functions import alerts, events, hashing, money, text
from shopstream.operators.sets import FEED_COLUMNS, feed_rows
from shopstream.operators.validation import failed_payment_alerts, route_by_type


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(column.alias("x")).first()["x"]


def scores(spark, amounts):
    df = spark.createDataFrame([(f"e{i}", a) for i, a in enumerate(amounts)], "id string, a double")
    return [float(r[0]) for r in df.select(alerts.risk_score(F.col("a"), F.col("id"))).collect()]


def test_score_ranges(spark):
    zero, mid, high, none, nan, huge, negative = scores(spark, [0.0, 800.0, 2000.0, None, math.nan, math.inf, -1e9])
    assert 80.10 <= zero <= 90.80
    assert 90.10 <= mid <= 99.90
    assert (high, none, nan, huge, negative) == (99.90, 75.0, 75.0, 99.90, 75.0)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True)), min_size=1, max_size=30))
def test_score_stays_in_bounds(spark, amounts):
    assert all(75.0 <= s <= 99.9 for s in scores(spark, amounts))


def test_alert_row_defaults(spark):
    df = spark.createDataFrame([("FAILED", "t", None)], "payment_status string, event_timestamp string, amount double")
    row = failed_payment_alerts(df).first()
    digest = hashlib.md5(b"None_None_None").hexdigest()[:8].upper()
    assert (row["alert_id"], row["customer_id"], row["order_id"]) == (f"ALT-{digest}", "ANONYMOUS", "N/A")
    assert float(row["risk_score"]) == 75.0
    assert row["details"] == "Failed attempt of BRL 0 via None"


def test_alert_id_matches_md5(spark):
    assert one(spark, alerts.alert_id(F.col("a")), a=("string", "abc")) == "ALT-" + hashlib.md5(b"abc").hexdigest()[:8].upper()


def test_rounding_is_half_up_on_the_decimal_value(spark):
    assert one(spark, money.money(F.col("a")), a=("double", 2.675)) == 2.68
    assert one(spark, money.rounded_mean(F.col("a"), F.col("n")), a=("long", 5), n=("long", 2)) == 0.03
    assert one(spark, money.rounded_mean(F.col("a"), F.col("n")), a=("long", 5), n=("long", 0)) is None
    assert one(spark, money.line_value(F.col("p"), F.col("q")), p=("double", 19.99), q=("int", 3)) == 59.97


def test_money_text(spark):
    shown = [one(spark, money.money_text(F.col("a")), a=("double", v)) for v in (100.0, 6.55, 6.5, 12345678.0, None)]
    assert shown == ["100.0", "6.55", "6.5", "12345678.0", None]


def test_feed_prefers_amount_and_fills_gaps(spark):
    schema = "event_timestamp string, event_type string, customer_id string, amount double, total_amount double, cart_value double"
    rows = [
        ("t", "x", "c", 1.0, 2.0, 3.0),
        ("t", "x", "", None, 2.0, 3.0),
        ("t", None, "nan", math.nan, None, 3.0),
        (None, "x", None, None, None, None),
    ]
    feed = feed_rows(spark.createDataFrame(rows, schema))
    assert feed.columns == list(FEED_COLUMNS)
    got = [tuple(r) for r in feed.collect()]
    assert [r[4] for r in got] == ["1.0", "2.0", "3.0", "-"]
    assert all(v is not None for r in got for v in r)
    assert got[1][2] == "-" and got[2][2] == "-" and got[3][3] == "-" and got[0][5] == "-"


def test_items(spark):
    schema = "order_id string, items array<struct<product_id string, quantity int, price double>>"
    df = spark.createDataFrame([("two", [("a", 2, 1.5), ("b", 1, 0.1)]), ("none", []), ("null", None)], schema)
    lines = [(r["order_id"], r["product_id"]) for r in events.explode_items(df).collect()]
    assert lines == [("two", "a"), ("two", "b"), ("none", None), ("null", None)]
    assert [r[0] for r in df.select(events.items_total(F.col("items"))).collect()] == [3.1, 0.0, None]


def test_labels_follow_weights(spark):
    label = hashing.weighted_label(F.col("id").cast("string"), ["A", "B", "C"], [0.5, 0.3, 0.2])
    shares = {r[0]: r[1] / 20000 for r in spark.range(20000).groupBy(label.alias("l")).count().collect()}
    assert abs(shares["A"] - 0.5) < 0.02 and abs(shares["B"] - 0.3) < 0.02 and abs(shares["C"] - 0.2) < 0.02


def test_text_parts(spark):
    assert one(spark, text.brand_name(F.col("c")), c=("string", "toys")) == "Olist_Certified_TOYS"
    assert one(spark, text.merchant_name(F.col("c")), c=("string", "abcdefgh")) == "Partner_Merchant_abcdef"
    assert one(spark, events.payment_event_type(F.col("c")), c=("string", None)) == "payment_failed"


def test_unknown_type_has_no_topic(spark):
    df = spark.createDataFrame([("remove_from_cart",), ("x",), (None,)], "event_type string")
    assert [r["topic"] for r in route_by_type(df).collect()] == ["cart-events", None, None]


def test_payload_round_trip_keeps_items(spark):
    row = [("a", "order_completed", [("p", 1, 2.5)])]
    schema = "event_id string, event_type string, items array<struct<product_id string, quantity int, price double>>"
    df = spark.createDataFrame(row, schema)
    back = events.parse_payload(events.to_payload(df))
    assert back.select("event_id", "event_type", "items").collect() == df.collect()


def test_directories_and_times_by_cheap_means(spark):
    texts = ["2024-01-02T03:04:05.123456+00:00Z", "2024-01-02T03:04:05-03:00Z", "2024-01-02T03:04:05+0200Z", "2024-01-02T03:04:05+00:00Z\n"]
    texts += ["0099-05-06T01:02:03Z", "+12024-01-01T00:00:00+00:00Z", "-0005-01-01", "2024-12-31T23:59:59.999999-11:00", "+00:00Z", "Z", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "s string")
    slow = F.try_to_timestamp(F.regexp_replace("s", r"([+-]\d{2}:?\d{2})Z$", "$1"))
    ts = events.normalize_event_time(F.col("s"))
    assert rows.filter(ts.eqNullSafe(slow)).count() == len(texts)
    stamped = rows.select(slow.alias("ts")).localCheckpoint()
    same = [events.time_partitions(F.col("ts"))[c].eqNullSafe(F.date_format("ts", f)) for c, f in events.PARTITION_FORMATS.items()]
    assert stamped.filter(same[0] & same[1] & same[2] & same[3]).count() == len(texts)
    # a date is formatted for odd years only
    plan = stamped.select(*[v.alias(c) for c, v in events.time_partitions(F.col("ts")).items()])._jdf.queryExecution().analyzed().toString()
    assert plan.count("date_format(") == 1
