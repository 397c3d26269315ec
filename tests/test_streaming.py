"""Streams against their batch twins, late rows, restarts and the running pipeline."""

import json
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopstream.operators import aggregates as agg
from shopstream.operators.windows import consecutive_failures
from shopstream.plans.medallion import LAKE_RULES, Lake, run_batch, typed
from shopstream.plans.reports import dashboard, lake_events, lake_revenue
from shopstream.sources.commits import read_committed
from shopstream.sources.readers import stream_events
from shopstream.streaming import operators as so
from shopstream.streaming.pipeline import PARTITIONS, checkpoint_root, run_pipeline, settings, start_sink, state_settings
from tests.events import bronze_file, event, write_lake, write_lines

T0 = datetime(2026, 8, 1)
SCHEMA = "event_id string, event_timestamp timestamp, customer_id string, payment_status string, total_amount double, amount double, payment_method string"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def rows(*spec):
    """(seconds, customer, status) or (seconds, customer, status, id)."""
    return [(r[3] if len(r) > 3 else f"e{r[0]}-{r[1]}", at(r[0]), r[1], r[2], 1.5, 10.0, "Pix") for r in spec]


class Feed:
    """A directory of Parquet files replayed as a stream, one file per batch."""

    def __init__(self, spark, path):
        self.spark, self.path, self.n = spark, str(path), 0

    def add(self, data):
        df = self.spark.createDataFrame(data, SCHEMA).coalesce(1)
        df.write.mode("append").parquet(f"{self.path}/in/{self.n:03d}")
        self.n += 1
        return self

    def stream(self):
        reader = self.spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
        return reader.parquet(f"{self.path}/in")

    def batch(self):
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{self.path}/in")

    def run(self, df, name="out"):
        query = start_sink(df, f"{self.path}/{name}", f"{self.path}/checkpoint-{name}", name, availableNow=True)
        query.awaitTermination()
        return query

    def result(self, name="out"):
        return self.spark.read.parquet(f"{self.path}/{name}")


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_revenue_equals_batch_for_closed_windows(feed):
    feed.add(rows(*[(s, "a", "SUCCESS") for s in range(0, 7200, 300)])).add(rows((10_000, "a", "SUCCESS"), (20_000, "a", "SUCCESS")))
    feed.run(so.stream_revenue(feed.stream()))
    closed = at(20_000 - 600)
    expected = agg.revenue_by_window(feed.batch()).filter(F.col("window_end") <= F.lit(closed))
    assert sorted(map(tuple, feed.result().collect())) == sorted(map(tuple, expected.collect()))
    assert feed.result().count() == 3


def test_late_row_is_dropped_and_counted(feed):
    # A window is written one batch after the watermark passes it; a row is late from then on.
    for data in ((0, "a"), (20_000, "a"), (20_001, "a"), (10, "b"), (40_000, "a")):
        feed.add(rows((*data, "SUCCESS")))
    drops = so.LateRows()
    feed.spark.streams.addListener(drops)
    try:
        query = feed.run(so.stream_revenue(feed.stream()))
        assert drops.of(query) == 1
    finally:
        feed.spark.streams.removeListener(drops)
    assert feed.result().filter(F.col("window_start") == F.lit(at(0))).first()["orders"] == 1


def test_restart_neither_loses_nor_repeats(feed):
    feed.add(rows((0, "a", "SUCCESS", "x"), (5, "a", "SUCCESS", "y")))
    feed.run(so.stream_dedupe(feed.stream()))
    assert feed.result().count() == 2
    feed.run(so.stream_dedupe(feed.stream()))
    assert feed.result().count() == 2
    feed.add(rows((6, "a", "SUCCESS", "y"), (7, "a", "SUCCESS", "z")))
    feed.run(so.stream_dedupe(feed.stream()))
    assert sorted(r["event_id"] for r in feed.result().collect()) == ["x", "y", "z"]


def test_sliding_failures(feed):
    feed.add(rows((10, "a", "FAILED"), (310, "a", "FAILED"), (320, "a", "SUCCESS"), (330, "b", "FAILED"), (9000, "z", "FAILED")))
    feed.run(so.stream_sliding_failures(feed.stream()))
    got = {(r["window_start"], r["customer_id"]): r["failures"] for r in feed.result().collect()}
    assert got == {(at(-300), "a"): 1, (at(0), "a"): 2, (at(300), "a"): 1, (at(0), "b"): 1, (at(300), "b"): 1}


def test_sessions(feed):
    feed.add(rows((0, "a", None), (1000, "a", None), (2800, "a", None), (4601, "a", None))).add(rows((500, "b", None), (30_000, "b", None)))
    feed.run(so.stream_sessions(feed.stream()))
    got = {(r["customer_id"], r["session_start"], r["session_end"], r["events"]) for r in feed.result().collect()}
    # A pause of exactly the gap does not end a session, as in the batch form.
    assert got == {("a", at(0), at(2800), 3), ("a", at(4601), at(4601), 1), ("b", at(500), at(500), 1)}
    batch = agg.session_stats(feed.batch(), 1800).filter(F.col("session_end") < F.lit(at(20_000)))
    assert {(r["customer_id"], r["session_start"], r["session_end"], r["events"]) for r in batch.collect()} == got


def test_drops_are_counted_past_a_hundred_batches(feed, tmp_path):
    """The progress that a query keeps forgets the first batches; the listener does not."""
    late = [(0, "a"), (20_000, "a"), (20_001, "a"), (10, "b"), (11, "c")]
    everything = late + [(20_002 + n, "a") for n in range(102)]
    (tmp_path / "lines").mkdir()
    for n, (seconds, who) in enumerate(everything):
        file = tmp_path / "lines" / f"{n:04d}.json"
        file.write_text(json.dumps({"event_id": f"e{seconds}-{who}", "event_timestamp": at(seconds).isoformat()}))
        os.utime(file, (1_700_000_000 + n,) * 2)
    spark = feed.spark
    drops = so.LateRows()
    spark.streams.addListener(drops)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        stream = spark.readStream.schema("event_id string, event_timestamp timestamp").option("maxFilesPerTrigger", 1).json(f"{tmp_path}/lines")
        query = feed.run(so.stream_dedupe(stream))
        dropped = drops.of(query)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.streams.removeListener(drops)
    recent = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert (dropped, recent) == (2, 0) and query.lastProgress.batchId > 100


def test_late_rows_are_kept_aside(feed, tmp_path):
    for data in ((0, "a"), (20_000, "a"), (10, "b"), (19_500, "c"), (40_000, "a")):
        feed.add(rows((*data, "SUCCESS")))
    for _ in range(2):  # a restart adds nothing
        query = so.stream_late_rows(feed.stream(), f"{tmp_path}/late", f"{tmp_path}/marks", f"{tmp_path}/c")
        query.awaitTermination()
    late = feed.spark.read.parquet(f"{tmp_path}/late/batch=*")
    assert [(r["customer_id"], r["late_seconds"]) for r in late.collect()] == [("b", 19_390.0)]
    summary = so.late_summary(late).first()
    assert (summary["period"], summary["rows"], summary["mean_seconds"], summary["most_seconds"]) == (at(0), 1, 19_390.0, 19_390.0)


def test_sketches_of_windows_merge(feed):
    feed.add(rows(*[(s * 3, f"c{s % 700}", None) for s in range(4000)], (90_000, "z", None)))
    feed.run(so.stream_active_users(feed.stream()))
    hours = feed.result()
    assert hours.count() == 4
    exact = feed.batch().filter(F.col("event_timestamp") < F.lit(at(86_400))).select("customer_id").distinct().count()
    merged = agg.merged_users(hours.unionByName(hours)).first()["customers"]
    assert exact == 700 and abs(merged - exact) <= 0.05 * exact
    batch = agg.merged_users(agg.user_sketches(feed.batch())).filter(F.col("period") == F.lit(at(0))).first()["customers"]
    assert batch == merged


def test_kpi_counts_each_event_once_and_keeps_its_days(feed, tmp_path):
    """Days come out again when they change; a repeated event and a closed day change nothing."""

    def batch(*spec):
        feed.add([(i, at(s), "c", None, None, None, topic) for i, s, topic in spec])

    day = 86_400
    batch(("a", 0, "cart-events"), ("b", 5, "cart-events"), ("k", 9, "checkout-events"), ("a", 0, "cart-events"))
    batch(("a", 0, "cart-events"), ("c", 50, "cart-events"), ("d", day, "cart-events"))
    batch(("x", 5 * day, "cart-events"),)
    batch(("y", 5 * day + 1, "cart-events"),)  # a day is closed for what comes one batch after that
    batch(("z", 5 * day + 2, "cart-events"), ("late", 7, "cart-events"))
    events = feed.stream().withColumnRenamed("payment_method", "topic")
    seen = []

    def write(rows, _id):
        seen.append(sorted((r["day"], r["total_carts_initiated"], r["total_checkouts_completed"], r["cart_abandonment_percentage"]) for r in rows.collect()))

    writer = so.stream_abandonment_kpi(events).writeStream.foreachBatch(write).outputMode("update")
    query = writer.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    found = [s for s in seen if s]
    assert found[0] == [(at(0), 2, 1, 50.0)]
    assert found[1] == [(at(0), 3, 1, 66.7), (at(day), 1, 0, 100.0)]
    assert found[2] == [(at(5 * day), 1, 0, 100.0)]
    assert found[3:] == [[(at(5 * day), 2, 0, 100.0)], [(at(5 * day), 3, 0, 100.0)]]


def test_abandonment(feed, spark, tmp_path):
    other = Feed(spark, tmp_path / "k")
    feed.add(rows((0, "a", None), (100, "b", None), (200, "c", None), (3000, "a", None))).add(rows((50_000, "z", None)))
    other.add(rows((0, "a", None), (3701, "b", None), (150, "c", None), (3800, "c", None), (6600, "a", None))).add(rows((50_000, "y", None)))
    feed.run(so.stream_abandonment(feed.stream(), other.stream()))
    got = {(r["customer_id"], r["event_timestamp"]) for r in feed.result().collect()}
    # b's checkout is one second too late; c has one before and one exactly at the limit.
    assert got == {("b", at(100))}


@pytest.fixture
def streak_store(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, so.STREAK_STORE)
    yield
    spark.conf.unset(name)


def test_streaks_write_only_what_came_or_fell_due(feed, streak_store):
    """A thousand customers wait; batches of one row touch one of them."""
    feed.add(rows(*[(s / 2, f"c{s}", "FAILED") for s in range(1000)]))
    for n in range(3):
        feed.add(rows((500 + n, "c5", "FAILED")))
    feed.add(rows((9000, "z", "SUCCESS")))
    query = feed.run(so.stream_failure_streaks(feed.stream(), 3))
    updated = [p.stateOperators[0].numRowsUpdated for p in query.recentProgress if p.stateOperators]
    assert updated[0] >= 1000 and all(u <= 10 for u in updated[1:4]), updated
    got = sorted((r["customer_id"], r["first_failed_at"], r["reached_at"]) for r in feed.result().collect())
    assert got == [("c5", at(2.5), at(501))]


def test_streaks_touch_a_customer_once_a_batch(feed, streak_store):
    """Many rows of a customer in one batch are one entry of the state, not one for each millisecond;
    those that the watermark has not passed yet stay."""
    # the newest row is at 3600, so all before 3000 fall due
    edge = [("b", 2999.999), ("c", 3000.0), ("d", 3000.001)]
    feed.add(rows(*[(s, "a", "FAILED") for s in range(500)], *[(s, c, "FAILED") for c, s in edge], (3600, "z", "SUCCESS")))
    query = feed.run(so.stream_failure_streaks(feed.stream(), 1))
    updated = [p.stateOperators[0].numRowsUpdated for p in query.recentProgress if p.stateOperators]
    assert max(updated) <= 50, updated
    got = sorted((r["customer_id"], r["reached_at"]) for r in feed.result().collect())
    assert got == [("a", at(0)), ("b", at(2999.999))]


def test_streaks_across_batches_and_out_of_order(feed, streak_store):
    feed.add(rows((10, "a", "FAILED"), (30, "a", "FAILED"), (5, "b", "FAILED")))
    feed.add(rows((20, "a", "FAILED"), (15, "b", "SUCCESS"), (40, "a", "FAILED")))
    feed.add(rows((25, "b", "FAILED"), (2000, "z", "SUCCESS")))
    feed.add(rows((1500, "a", "SUCCESS"), (1510, "a", "FAILED"), (1520, "a", "FAILED"), (1530, "a", "FAILED"), (9000, "z", "SUCCESS")))
    feed.run(so.stream_failure_streaks(feed.stream(), 3))
    got = sorted((r["customer_id"], r["first_failed_at"], r["reached_at"]) for r in feed.result().collect())
    assert got == [("a", at(10), at(30)), ("a", at(1510), at(1530))]
    batch = consecutive_failures(feed.batch(), 3).collect()
    assert sorted((r["customer_id"], r["first_failed_at"]) for r in batch) == [g[:2] for g in got]


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/Sao_Paulo"])
def test_streaks_do_not_depend_on_the_zone(spark, feed, zone, streak_store):
    before = spark.conf.get("spark.sql.session.timeZone")
    feed.add(rows((10, "a", "FAILED"), (30, "a", "FAILED"), (31, "b", "SUCCESS"))).add(rows((20, "a", "FAILED"), (25, "a", "SUCCESS"), (2000, "z", "SUCCESS")))
    feed.add(rows((9000, "z", "SUCCESS")))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        feed.run(so.stream_failure_streaks(feed.stream(), 2))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    got = [(r["customer_id"], r["first_failed_at"], r["reached_at"]) for r in feed.result().collect()]
    assert got == [("a", at(10), at(20))]


def test_alerts_are_written_once(feed, tmp_path):
    feed.add(rows((0, "a", "FAILED", "p1"), (1, "a", "SUCCESS", "p2"))).add(rows((2, "a", "FAILED", "p1"), (3, "b", "FAILED", "p3")))
    for n in range(2):
        # A new checkpoint makes the second run see every row again.
        so.stream_alerts(feed.stream(), f"{tmp_path}/alerts", f"{tmp_path}/c{n}", f"{tmp_path}/archive").awaitTermination()
    for name in ("alerts", "archive"):
        assert sorted(r["event_id"] for r in read_committed(feed.spark, f"{tmp_path}/{name}").collect()) == ["p1", "p3"]


def test_malformed_lines_on_a_stream(spark, tmp_path):
    write_lake(spark, tmp_path)
    lake = Lake(str(tmp_path))
    valid, rejected = so.stream_rejects(stream_events(spark, lake.bronze(), max_files=2), LAKE_RULES)
    for name, df in (("valid", typed(valid)), ("rejected", rejected)):
        start_sink(df, f"{tmp_path}/{name}", f"{tmp_path}/c-{name}", name, availableNow=True).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/valid").count() == 13
    assert spark.read.parquet(f"{tmp_path}/rejected").count() == 6


def test_pipeline_runs_and_continues(spark, tmp_path):
    write_lake(spark, tmp_path)
    lake, checkpoints = Lake(str(tmp_path)), f"{tmp_path}/checkpoints"

    def run():
        result = run_pipeline(spark, lake, once=True, checkpoints=checkpoints)
        assert all(isinstance(q, StreamingQuery) and not q.isActive for q in result.values()), result
        return result

    run()
    assert spark.read.json(lake.live("dead-letter-events")).count() == 6
    assert spark.read.parquet(lake.live("enriched-orders")).count() == 3
    assert spark.read.parquet(lake.live("customer-events")).count() == 2
    assert read_committed(spark, lake.live("fraud_alarms")).count() == 1
    kpi = spark.read.parquet(lake.live("cart_abandonment")).collect()
    assert [(r["total_carts_initiated"], r["cart_abandonment_percentage"]) for r in kpi] == [(4, 75.0)]
    # a stream-only lake has a dashboard, and no panel sorts or compares events
    for name, panel in dashboard(spark, lake).items():
        assert "Window" not in panel._jdf.queryExecution().executedPlan().toString(), name
    panels = {name: panel.collect() for name, panel in dashboard(spark, lake).items()}
    assert panels["alert_count"][0]["total"] == 1 and len(panels["activity_feed"]) == 12
    assert panels["cart_abandonment"][0]["cart_abandonment_percentage"] == 75.0
    late = event("order_completed", customer_id="c1", order_id="o9", total_amount=9.0, event_timestamp="2026-08-01T20:00:00Z")
    write_lines(bronze_file(tmp_path, "order-events", "part-1"), [late])
    # the master table may be replaced between two runs
    people = spark.createDataFrame([("c1", "u1", "sao paulo", "SP", "Platinum")], "customer_id string, customer_unique_id string, city string, state_code string, loyalty_tier string")
    people.write.mode("overwrite").parquet(lake.master("customers"))
    again = run()
    # the percentage is kept in state: the second run reads what is new, and none of it is a cart
    assert sum(p.numInputRows for p in again["abandonment_kpi"].recentProgress) == 0
    orders = spark.read.parquet(lake.live("enriched-orders"))
    assert orders.count() == 4
    assert {r["order_id"]: r["loyalty_tier"] for r in orders.collect()}["o9"] == "Platinum"
    hourly = spark.read.parquet(lake.live("revenue_per_hour"))
    assert {(r["window_start"].hour, r["revenue"]) for r in hourly.collect()} == {(14, 150.5), (15, 30.25)}


def test_state_lies_on_disk_in_few_partitions(spark, tmp_path):
    write_lake(spark, tmp_path)
    with settings(spark, {PARTITIONS: "40"}):
        result = run_pipeline(spark, Lake(str(tmp_path)), once=True, checkpoints=f"{tmp_path}/c")
        assert spark.conf.get(PARTITIONS) == "40" and spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) is None
    operators = [op for query in result.values() for progress in query.recentProgress for op in progress.stateOperators]
    assert operators and all("rocksdbPutCount" in op.customMetrics for op in operators)
    assert {op.numShufflePartitions for op in operators} == {2 * spark.sparkContext.defaultParallelism}


def test_a_checkpoint_keeps_the_state_it_began_with(spark, tmp_path):
    write_lake(spark, tmp_path)
    lake = Lake(str(tmp_path))
    before = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"}
    with settings(spark, before):
        assert state_settings(spark) == {PARTITIONS: spark.conf.get(PARTITIONS)}
        run_pipeline(spark, lake, once=True, checkpoints=f"{tmp_path}/c")
    late = event("order_completed", customer_id="c1", order_id="o9", total_amount=9.0, event_timestamp="2026-08-01T20:00:00Z")
    write_lines(bronze_file(tmp_path, "order-events", "part-1"), [late, late])
    result = run_pipeline(spark, lake, once=True, checkpoints=f"{tmp_path}/c")
    assert not any(isinstance(q, Exception) for q in result.values()), result
    assert spark.read.parquet(lake.live("enriched-orders")).count() == 4
    assert not any("rocksdbPutCount" in op.customMetrics for q in result.values() for p in q.recentProgress for op in p.stateOperators)


def test_failing_query_leaves_the_others(spark, tmp_path):
    write_lake(spark, tmp_path)
    lake = Lake(f"{tmp_path}")
    # The views query has no product table to join.
    (tmp_path / "master" / "products.parquet").rename(tmp_path / "master" / "elsewhere")
    result = run_pipeline(spark, lake, once=True, checkpoints=f"{tmp_path}/c")
    assert [n for n, q in result.items() if isinstance(q, Exception)] == ["views"]
    assert spark.read.parquet(lake.live("enriched-orders")).count() == 3


@pytest.mark.parametrize("first", ["batch", "stream"])
def test_batch_and_stream_share_a_lake(spark, tmp_path, first):
    write_lake(spark, tmp_path)
    lake = Lake(str(tmp_path))
    runs = {"batch": lambda: run_batch(spark, lake), "stream": lambda: run_pipeline(spark, lake, once=True, checkpoints=f"{tmp_path}/c")}
    order = ["batch", "stream"] if first == "batch" else ["stream", "batch"]
    for name in [*order, *order]:
        runs[name]()
    assert spark.read.parquet(lake.gold("revenue_per_hour")).count() == 2
    assert spark.read.parquet(lake.silver("enriched-orders")).count() == 3
    assert spark.read.parquet(lake.live("enriched-orders")).count() == 3
    assert read_committed(spark, lake.gold("fraud_alerts_log")).count() == 1
    assert lake_events(spark, lake).count() == 12
    assert lake_events(spark, lake, date(2026, 8, 2)).count() == 0
    assert lake_revenue(spark, lake).count() == 2
    assert not any(isinstance(q, Exception) for q in runs["stream"]().values())


def test_a_cart_delivered_twice_is_lost_once(spark, tmp_path):
    write_lake(spark, tmp_path)
    lake = Lake(str(tmp_path))
    lost = event("add_to_cart", customer_id="c7", product_id="p1", quantity=1, event_timestamp="2026-08-01T14:20:00Z")
    write_lines(bronze_file(tmp_path, "cart-events", "twice"), [lost, lost])
    run_pipeline(spark, lake, once=True, checkpoints=f"{tmp_path}/c")
    late = {"event_timestamp": "2026-08-02T14:20:00Z"}
    for n in (1, 2):  # the watermark moves on, and then the windows are written
        write_lines(bronze_file(tmp_path, "cart-events", f"late{n}"), [event("add_to_cart", customer_id=f"z{n}", product_id="p1", quantity=1, **late)])
        write_lines(bronze_file(tmp_path, "checkout-events", f"late{n}"), [event("checkout_started", customer_id=f"y{n}", **late)])
        run_pipeline(spark, lake, once=True, checkpoints=f"{tmp_path}/c")
    carts = spark.read.parquet(lake.live("abandoned_carts"))
    assert carts.filter("customer_id = 'c7'").count() == 1


def test_interval_mode_keeps_running(spark, tmp_path):
    write_lake(spark, tmp_path)
    result = run_pipeline(spark, Lake(str(tmp_path)), "1 second", checkpoints=f"{tmp_path}/c")
    try:
        assert all(q.isActive for q in result.values())
        result["checked"].processAllAvailable()
        result["orders"].processAllAvailable()
        assert spark.read.parquet(Lake(str(tmp_path)).live("enriched-orders")).count() == 3
    finally:
        for query in result.values():
            query.stop()


def test_checkpoint_folder_comes_from_the_session(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
