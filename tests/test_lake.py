"""Sources, sinks and the batch plans on a small lake."""

import json
import os
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from registry import lake as registry_lake
from shopstream.functions.events import parse_payload
from shopstream.operators.validation import MISSING_FIELD, OUT_OF_RANGE, for_hour, in_range, tag_rejects
from shopstream.plans import master, medallion, reports
from shopstream.sources import commits, readers, sinks
from shopstream.sources.commits import CommitLog, compact, read_committed
from shopstream.sources.schemas import RAW_CUSTOMERS, WAREHOUSES
from shopstream.streaming.pipeline import start_sink
from tests.events import bronze_file, event, write_lake, write_lines


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    write_lake(spark, root)
    built = medallion.Lake(str(root))
    medallion.run_batch(spark, built)
    return built


def test_scan_loses_nothing(spark, lake):
    events = readers.read_events(spark, lake.bronze())
    assert events.count() == 19
    counts = {r["topic"]: r["count"] for r in events.groupBy("topic").count().collect()}
    assert counts == {"order-events": 7, "product-view-events": 2, "cart-events": 5, "checkout-events": 1, "payment-events": 4}
    corrupt = {r[0] for r in events.filter("_corrupt is not null").select("_corrupt").collect()}
    assert len(corrupt) == 3 and {"[1]", "{bad"} < corrupt


def test_topic_scan_prunes_hours(spark, lake):
    events = readers.read_events(spark, lake.bronze(), ["order-events", "cart-events"])
    hour = for_hour(events, datetime(2026, 8, 1, 15))
    assert hour.count() == 1
    plan = hour._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_rejects_are_stripped_and_logged(spark, lake):
    rejected = spark.read.json(lake.rejects)
    found = sorted(r["dlq_reason"] for r in rejected.collect())
    assert found == sorted(["Invalid JSON or schema mismatch"] * 3 + [MISSING_FIELD] + [OUT_OF_RANGE] * 2)
    assert "failed_at" in rejected.columns
    assert spark.read.parquet(lake.silver("events")).count() == 19 - 6 - 1


def test_enriched_and_gold_tables(spark, lake):
    orders = readers.read_lake_table(spark, lake.silver("enriched-orders"))
    assert {(r["order_id"], r["loyalty_tier"]) for r in orders.collect()} == {("o1", "Gold"), ("o2", "Standard"), ("o4", "Silver")}
    views = readers.read_lake_table(spark, lake.silver("customer-events"))
    assert {(r["product_id"], r["category"], r["category_master"]) for r in views.collect()} == {("p1", "games", "toys"), ("p9", "games", None)}
    hourly = spark.read.parquet(lake.gold("revenue_per_hour")).orderBy("window_start").collect()
    assert [(r["window_start"].hour, r["revenue"], r["orders"]) for r in hourly] == [(14, 150.5, 2), (15, 30.25, 1)]
    assert spark.read.parquet(lake.gold("revenue_total")).first()["total_revenue_brl"] == 180.75
    assert spark.read.parquet(lake.gold("cart_abandonment")).first()["cart_abandonment_percentage"] == 75.0
    alerts = read_committed(spark, lake.gold("fraud_alerts_log")).collect()
    assert len(alerts) == 1 and 90.10 <= float(alerts[0]["risk_score"]) <= 99.90


def test_second_run_adds_nothing(spark, tmp_path):
    write_lake(spark, tmp_path)
    lake = medallion.Lake(str(tmp_path))
    for _ in range(2):
        medallion.run_batch(spark, lake)
    assert read_committed(spark, lake.gold("fraud_alerts_log")).count() == 1
    assert spark.read.parquet(lake.gold("revenue_total")).first()["total_orders"] == 3


def test_reports_and_dashboard(spark, lake):
    reports.run_reports(spark, lake)
    # Eleven counted events and two revenue rows.
    volume = reports.lake_volume(spark.read.parquet(lake.silver("events")), spark.read.parquet(lake.gold("revenue_per_hour")))
    assert volume.first()[0] == 3 + 2 + 4 + 2 + 2 * 15
    panels = reports.dashboard(spark, lake, base_revenue=100.0, base_orders=1)
    rows = {name: panel.collect() for name, panel in panels.items()}
    assert rows["latest_kpi"][0]["window_start"].hour == 15
    assert [(r["revenue"], r["orders"]) for r in rows["revenue_by_day"]] == [(180.75, 3)] == [(r["revenue"], r["orders"]) for r in rows["revenue_by_month"]]
    assert [(r["window_start"].hour, r["views"]) for r in rows["product_views"]] == [(14, 2)]
    paid = spark.read.parquet(lake.silver("enriched-payments"))
    assert sorted((r["customer_id"], r["loyalty_tier"]) for r in paid.collect()) == [("c1", "Gold"), ("c2", "Silver")]
    assert rows["alert_count"][0]["total"] == 1 and len(rows["latest_alerts"]) == 1
    assert rows["average_order_value"][0][0] == 70.19
    assert {r["category"] for r in rows["top_categories"]} == {"toys", "books"}
    assert len(rows["activity_feed"]) == 12
    times = [r["event_timestamp"] for r in rows["activity_feed"]]
    assert times == sorted(times, reverse=True)


def test_hour_filter_reaches_the_listing(spark, lake):
    orders = spark.read.parquet(lake.silver("enriched-orders"))
    hour = for_hour(orders, datetime(2026, 8, 1, 14))
    assert hour.count() == 2
    scan = hour._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan


def test_lake_table_joins_by_name_and_skips_unreadable(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "x int, y string").coalesce(1).write.parquet(f"{tmp_path}/t/one")
    spark.createDataFrame([(2.5, 2)], "z double, x int").coalesce(1).write.parquet(f"{tmp_path}/t/deep/two")
    (tmp_path / "t" / "broken.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        readers.read_lake_table(spark, f"{tmp_path}/t").count()
    table = readers.read_lake_table(spark, f"{tmp_path}/t", skip_unreadable=True)
    assert sorted(table.select("x", "y", "z").collect()) == [(1, "a", None), (2, None, 2.5)]
    assert [Path(r["path"]).name for r in readers.files_without_rows(spark, f"{tmp_path}/t").collect()] == ["broken.parquet"]


def test_a_damaged_file_stops_the_measures(spark, tmp_path):
    write_lake(spark, tmp_path)
    lake = medallion.Lake(str(tmp_path))
    medallion.to_silver(spark, lake)
    file = next(Path(lake.silver("enriched-orders")).rglob("*.parquet"))
    file.write_bytes(b"PAR1 damaged PAR1")
    (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception):
        medallion.to_gold(spark, lake)


def test_a_slow_write_is_read_whole(spark, tmp_path):
    spark.range(50).repartition(2).write.parquet(f"{tmp_path}/t/old")
    spark.range(90).withColumn("g", F.col("id") % 2).repartition(3).write.partitionBy("g").parquet(f"{tmp_path}/t/new")
    files = sorted(Path(tmp_path, "t", "new").rglob("*.parquet"))
    assert len(files) == 6
    now = files[0].stat().st_mtime
    for n, file in enumerate(files):  # closed one and a half minutes apart, and before the old write's
        os.utime(file, (now + 1000 - 90 * n,) * 2)
    assert readers.read_lake_table(spark, f"{tmp_path}/t", latest_only=True).count() == 90


def test_the_last_batch_of_a_stream(spark, tmp_path):
    for n in range(12):  # past a compaction of the stream's log
        spark.range(n + 1).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    rows = spark.readStream.schema("id long").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    start_sink(rows.repartition(2), f"{tmp_path}/out", f"{tmp_path}/c", "last", availableNow=True).awaitTermination()
    last = readers.read_lake_table(spark, f"{tmp_path}/out", latest_only=True)
    with_batch = spark.read.parquet(f"{tmp_path}/out")
    assert with_batch.count() == 78 and len(last.inputFiles()) <= 2 and last.count() == max(r["id"] for r in last.collect()) + 1


def test_latest_write_only(spark, tmp_path):
    for i in (10, 20):
        spark.range(i).repartition(4).write.parquet(f"{tmp_path}/t/p{i}")
    for file in Path(tmp_path, "t", "p10").glob("*.parquet"):
        os.utime(file, (2_000_000_000, 2_000_000_000))
    assert readers.read_lake_table(spark, f"{tmp_path}/t", latest_only=True).count() == 10
    assert readers.read_lake_table(spark, f"{tmp_path}/t").count() == 30


def test_a_schema_keeps_partition_columns(spark, tmp_path):
    spark.range(10).withColumn("g", F.col("id") % 2).write.partitionBy("g").parquet(f"{tmp_path}/t")
    table = readers.read_lake_table(spark, f"{tmp_path}/t", schema="id long, g int").filter("g = 1")
    assert table.count() == 5
    assert "PartitionFilters: [isnotnull(g" in table._jdf.queryExecution().executedPlan().toString()


def test_master_files(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    with pytest.raises(FileNotFoundError, match="customers.csv"):
        readers.read_master_csv(spark, f"{raw}/customers.csv", RAW_CUSTOMERS)
    (raw / "customers.csv").write_text('customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\nc1,u1,1,"sao, paulo",SP\nc2,u2,2,rio,RJ\n')
    (raw / "products.csv").write_text(
        "product_id,product_category_name,product_name_lenght,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
        "p1,brinquedos,1,200,10,20,30\np2,livros,1,x,10,20,30\np3,,1,,,,\n"
    )
    (raw / "sellers.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\nabcdefgh,1,rio,RJ\n")
    (raw / "category_translation.csv").write_text("product_category_name,product_category_name_english\nbrinquedos,toys\n")
    (raw / "order_items.csv").write_text("order_id,product_id,price\no1,p1,10.00\no2,p1,10.05\n")
    paths = master.load_master(spark, str(raw), f"{tmp_path}/master", sample_rows=1000)
    tables = {name: spark.read.parquet(path) for name, path in paths.items()}
    customers = {r["customer_id"]: r for r in tables["customers"].collect()}
    assert customers["c1"]["city"] == "sao, paulo" and customers["c1"]["country"] == "Brazil"
    assert customers["c2"]["loyalty_tier"] in master.TIERS and 2022 <= customers["c2"]["signup_year"] <= 2025
    products = {r["product_id"]: (r["category"], r["brand"], r["unit_price"], r["product_weight_g"]) for r in tables["products"].collect()}
    assert products["p1"] == ("toys", "Olist_Certified_TOYS", 10.03, 200.0)
    assert products["p2"] == ("General_Merchandise", "Olist_Certified_GENE", 49.99, None)
    seller = tables["sellers"].first()
    assert seller["seller_name"] == "Partner_Merchant_abcdef" and 3.5 <= seller["rating"] <= 5.0
    assert [tuple(r) for r in tables["warehouses"].orderBy("warehouse_id").collect()] == WAREHOUSES
    stock = tables["inventory"].collect()
    assert len(stock) == 15 and {r["inventory_id"] for r in stock} == {f"INV-p{i}-{w}" for i in (1, 2, 3) for w in range(1, 6)}
    assert all(10 <= r["quantity"] < 500 and 0 <= r["reserved_quantity"] < 5 for r in stock)
    assert spark.read.json(f"{tmp_path}/master/customers.json").count() == 2

    for _ in range(2):
        master.seed_tables(spark, paths, f"{tmp_path}/serving")
    assert read_committed(spark, f"{tmp_path}/serving/inventory").count() == 15
    assert read_committed(spark, f"{tmp_path}/serving/customers").count() == 2


def test_json_sample_is_the_first_by_key(spark, tmp_path):
    sinks.export_json_sample(spark.range(100).repartition(7), f"{tmp_path}/s", "id", 5)
    assert sorted(r["id"] for r in spark.read.json(f"{tmp_path}/s").collect()) == [0, 1, 2, 3, 4]


def test_first_insert_wins(spark, tmp_path):
    target = f"{tmp_path}/alerts"
    schema = "alert_id string, event_timestamp int, event_id string, tag string"
    sinks.insert_if_absent(spark.createDataFrame([("A", 2, "e2", "late"), ("A", 1, "e1", "first")], schema), target, "alert_id")
    sinks.insert_if_absent(spark.createDataFrame([("A", 0, "e0", "again"), ("B", 1, "e3", "new")], schema), target, "alert_id")
    assert sorted((r["alert_id"], r["tag"]) for r in read_committed(spark, target).collect()) == [("A", "first"), ("B", "new")]


def test_null_keys_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([(None, 1), ("a", 2)], "event_id string, event_timestamp int")
    with pytest.raises(Exception, match="NULL in key column event_id"):
        sinks.insert_if_absent(rows, f"{tmp_path}/t", "event_id")


def test_insert_reads_only_the_days_it_touches(spark, tmp_path):
    days = spark.createDataFrame([(f"e{d}{n}", d, f"2026-08-{d:02d}") for d in range(1, 9) for n in range(3)], "event_id string, event_timestamp int, day string")
    days = days.withColumns({"year": F.lit("2026"), "month": F.lit("08"), "day": F.col("event_timestamp").cast("string")})
    by = ["year", "month", "day"]
    sinks.insert_if_absent(days, f"{tmp_path}/t", "event_id", partition_by=by)
    again = days.filter("day IN ('2', '3')").unionByName(days.limit(1).withColumns({"event_id": F.lit("new"), "day": F.lit("3")}))
    sinks.insert_if_absent(again, f"{tmp_path}/t", "event_id", partition_by=by)
    assert read_committed(spark, f"{tmp_path}/t").count() == 25
    log = CommitLog(spark, f"{tmp_path}/t")
    known = log.read(log.writes(log.last()), by, [("2026", "08", "3")])
    scan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan and known.count() == 4
    # the second commit holds one row of day 3, and none of day 5
    assert len(log.read(log.writes(log.last()), by, [("2026", "08", "5")]).inputFiles()) == len(log.read(log.writes(1), by, [("2026", "08", "5")]).inputFiles())


def test_all_products_have_stock_and_all_rows_are_seeded(spark, tmp_path):
    stock = master.build_stock(spark.range(6000).select(F.col("id").cast("string").alias("product_id")))
    assert stock.count() == stock.select("inventory_id").distinct().count() == 30_000
    paths = {}
    for name, key in master.MASTER_KEYS.items():
        paths[name] = f"{tmp_path}/m/{name}"
        spark.range(12_000).select(F.col("id").cast("string").alias(key)).write.parquet(paths[name])
    master.seed_tables(spark, paths, f"{tmp_path}/serving")
    assert all(read_committed(spark, f"{tmp_path}/serving/{name}").count() == 12_000 for name in paths)


def test_hours_one_by_one_make_the_same_tables(spark, tmp_path):
    write_lake(spark, tmp_path)
    lake = medallion.Lake(str(tmp_path))
    medallion.run_batch(spark, lake)
    for hour in (15, 14, 14):
        medallion.run_hour(spark, lake, datetime(2026, 8, 1, hour))
    ids = [r["event_id"] for r in spark.read.parquet(f"{tmp_path}/hourly/events").collect()]
    assert sorted(ids) == sorted(r["event_id"] for r in spark.read.parquet(lake.silver("events")).collect())
    for table, other in (("enriched-orders", lake.silver("enriched-orders")), ("views", lake.silver("customer-events")), ("payments", lake.silver("enriched-payments")), ("revenue", lake.gold("revenue_per_hour"))):
        one, two = spark.read.parquet(f"{tmp_path}/hourly/{table}"), spark.read.parquet(other)
        columns = sorted(set(one.columns) & set(two.columns) - {"year", "month", "day", "hour"})
        assert sorted(map(str, one.select(columns).collect())) == sorted(map(str, two.select(columns).collect()))
    assert read_committed(spark, lake.gold("fraud_alerts_log")).count() == 1
    lost = spark.read.parquet(f"{tmp_path}/hourly/cart_abandonment").collect()
    assert sorted((r["hour"], r["total_carts_initiated"], r["cart_abandonment_percentage"]) for r in lost) == [(14, 4, 75.0), (15, 0, 0.0)]
    for at, files in ((datetime(2026, 8, 1, 15), 1), (datetime(2026, 8, 1, 16), 0)):
        seen = readers.read_events(spark, lake.bronze(), ["order-events", "search-events"], at)
        assert len(seen.inputFiles()) == files and seen.count() == files


def test_an_hour_joins_only_the_master_rows_it_names(spark, tmp_path, monkeypatch):
    write_lake(spark, tmp_path)
    lake, joined = medallion.Lake(str(tmp_path)), {}
    for name in ("enrich_orders", "enrich_views", "enrich_payments"):

        def seen(events, master, name=name, enrich=getattr(medallion, name)):
            joined.setdefault(name, []).append(master.count())
            return enrich(events, master)

        monkeypatch.setattr(medallion, name, seen)
    medallion.run_hour(spark, lake, datetime(2026, 8, 1, 3))
    # the hour has no events
    assert joined == {"enrich_orders": [0], "enrich_views": [0, 0], "enrich_payments": [0]}


def test_hourly_query_runs_beside_all_other_hours(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(registry_lake, "folder", lambda spark: str(tmp_path))
    found = {r["event_id"] for r in registry_lake.run_hour(spark, sf).collect()}
    events = spark.read.parquet(f"{sf}/events.parquet")
    bronze = spark.read.text(medallion.Lake(str(tmp_path)).bronze("cart-events"))
    held = bronze.select(F.get_json_object("value", "$.event_id").alias("id")).distinct().count()
    assert held == registry_lake.t.of_type(spark, sf, "add_to_cart").select("event_id").distinct().count() > 0
    assert 0 < len(found) < events.count()


def test_numbers_that_do_not_fit(spark):
    lines = ['{"event_id":"a","quantity":2.0}', '{"event_id":"b","quantity":2.5}', '{"event_id":"c","total_amount":Infinity}', '{"event_id":"d","total_amount":1e999}', '{"event_id":"e","items":[{"product_id":"p","quantity":3.0,"price":1.5}]}', '{"event_id":"f","items":[{"quantity":0.5}]}']
    parsed = parse_payload(spark.createDataFrame([(x,) for x in lines], "value string"))
    rows = {json.loads(line)["event_id"] if "Infinity" not in line else "c": r for line, r in zip(lines, parsed.collect(), strict=True)}
    assert rows["a"]["quantity"] == 2 and rows["a"]["_corrupt"] is None
    assert rows["e"]["items"][0]["quantity"] == 3
    assert all(rows[k]["_corrupt"] is not None for k in "bcf")
    rejected = tag_rejects(spark.createDataFrame([(float("inf"),), (float("nan"),), (1.0,)], "amount double"), [in_range()])
    assert [r["dlq_reason"] for r in rejected.collect()] == [OUT_OF_RANGE, OUT_OF_RANGE, None]


def test_several_sinks_compute_once(spark, tmp_path):
    counter = spark.sparkContext.accumulator(0)

    def seen(x):
        counter.add(1)
        return x

    df = spark.range(10).select(F.udf(seen, "long")("id").alias("id"))
    sinks.write_multi(df, [lambda d: sinks.write_report(d, f"{tmp_path}/a"), lambda d: sinks.write_report(d, f"{tmp_path}/b")])
    assert spark.read.parquet(f"{tmp_path}/a").count() == spark.read.parquet(f"{tmp_path}/b").count() == 10
    assert counter.value == 10


def test_partitioned_write_appends(spark, tmp_path):
    df = spark.createDataFrame([(1, datetime(2026, 8, 1, 5)), (2, datetime(2026, 8, 1, 6))], "id int, event_timestamp timestamp")
    for _ in range(2):
        sinks.write_partitioned(df, f"{tmp_path}/t", fmt="json")
    assert Path(tmp_path, "t", "year=2026", "month=08", "day=01", "hour=05").is_dir()
    assert spark.read.json(f"{tmp_path}/t").count() == 4
    file = next(Path(tmp_path, "t").rglob("*.json"))
    assert set(json.loads(file.read_text().splitlines()[0])) == {"id", "event_timestamp"}


def test_first_available_source(spark, tmp_path):
    spark.range(0).write.parquet(f"{tmp_path}/empty")
    spark.range(3).write.parquet(f"{tmp_path}/full")
    read = [lambda s, n=n: s.read.parquet(f"{tmp_path}/{n}") for n in ("absent", "empty", "full")]
    assert readers.read_first_available(spark, read).count() == 3
    assert readers.read_first_available(spark, read[:2]).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.read_first_available(spark, read[:1])


def test_topic_from_flat_and_partitioned_paths(spark, tmp_path):
    write_lines(bronze_file(tmp_path, "cart-events"), [event("add_to_cart")])
    write_lines(tmp_path / "bronze" / "search-events" / "a.jsonl", [event("search")])
    got = {(r["event_type"], r["topic"]) for r in readers.read_events(spark, f"{tmp_path}/bronze").collect()}
    assert got == {("add_to_cart", "cart-events"), ("search", "search-events")}


class Raced(CommitLog):
    """Another writer commits just before this one's first attempt."""

    other = None

    def put(self, number, write, replaces=False):
        if Raced.other:
            run, Raced.other = Raced.other, None
            run()
        return super().put(number, write, replaces)


KEYED = "event_id string, event_timestamp int, tag string, day string"


def keyed(spark, tag, *ids):
    return spark.createDataFrame([(i, 1, tag, f"d{i[-1]}") for i in ids], KEYED)


@pytest.mark.parametrize("by", [(), ("day",)])
@pytest.mark.parametrize("theirs", [("a1", "b2"), ("x3", "y4"), ("a1",)])
def test_a_writer_that_loses_the_number_looks_again(spark, tmp_path, monkeypatch, by, theirs):
    target = f"{tmp_path}/t"
    sinks.insert_if_absent(keyed(spark, "first", "z1"), target, "event_id", partition_by=by)
    Raced.other = lambda: sinks.insert_if_absent(keyed(spark, "theirs", *theirs), target, "event_id", partition_by=by)
    monkeypatch.setattr(sinks, "CommitLog", Raced)
    sinks.insert_if_absent(keyed(spark, "mine", "z1", "a1", "c2"), target, "event_id", partition_by=by)
    found = {r["event_id"]: r["tag"] for r in read_committed(spark, target).collect()}
    assert found == {"z1": "first", "a1": "mine", "c2": "mine"} | dict.fromkeys(theirs, "theirs")
    assert read_committed(spark, target).count() == len(found) and CommitLog(spark, target).last() == 3


def test_snapshots_and_compaction(spark, tmp_path):
    target, one = f"{tmp_path}/t", spark.range(1).selectExpr("'k' AS event_id", "'m' AS month")
    log = CommitLog(spark, target)
    folder = log.stage(one, ["month"])
    schema = json.dumps(one.schema.jsonValue())
    for n in range(1, 46):
        assert log.put(n, commits.Write(folder, schema, ["month"], [["m"]], []))
    assert not log.put(45, commits.Write(folder, schema, ["month"], None, []))
    assert log.last() == 45 and len(log.writes(45)) == 45 and len(log.writes(45, 40)) == 5 and len(log.writes(39)) == 39
    assert compact(spark, target)
    # one folder, however often it is named
    assert len(log.writes(46)) == 1 and read_committed(spark, target).count() == 1
    sinks.insert_if_absent(spark.createDataFrame([("k", "m"), ("l", "n")], "event_id string, month string"), target, "event_id", partition_by=["month"])
    assert read_committed(spark, target).count() == 2


@pytest.mark.parametrize("point", ["staged", "first target", "next target"])
def test_a_batch_that_dies_between_two_targets(spark, tmp_path, monkeypatch, point):
    one, two = f"{tmp_path}/one", f"{tmp_path}/two"
    sinks.insert_if_absent(keyed(spark, "two's own", "a1"), two, "event_id", partition_by=["day"])
    died = []

    def die(at):
        if at == point and not died:
            died.append(at)
            raise RuntimeError(at)

    monkeypatch.setattr(commits, "reached", die)
    with pytest.raises(RuntimeError):
        sinks.insert_if_absent(keyed(spark, "batch", "a1", "b2"), one, "event_id", partition_by=["day"], also=[two])
    # what comes next need not be the same batch
    rows = keyed(spark, "batch", "a1", "b2") if point == "staged" else keyed(spark, "later", "c3")
    sinks.insert_if_absent(rows, one, "event_id", partition_by=["day"], also=[two])
    tags = [{r["event_id"]: r["tag"] for r in read_committed(spark, p).collect()} for p in (one, two)]
    later = {} if point == "staged" else {"c3": "later"}
    assert tags == [{"a1": "batch", "b2": "batch"} | later, {"a1": "two's own", "b2": "batch"} | later]


def test_micro_batches_write_few_files(spark, tmp_path):
    """Without adaptive execution: a directory is a file, a large one a few."""
    hours = F.expr("timestamp'2026-08-01' + make_interval(0, 0, 0, 0, id % 6)")
    spark.range(0, 6000, 1, 8).select("id", hours.alias("event_timestamp")).write.parquet(f"{tmp_path}/in")
    # queries with state have no adaptive execution
    stream = spark.readStream.schema("id long, event_timestamp timestamp").parquet(f"{tmp_path}/in").dropDuplicates(["id"])
    adaptive = []

    def write(batch, _id):
        adaptive.append(batch.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        sinks.write_partitioned(batch, f"{tmp_path}/out")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert len(list(Path(tmp_path, "out").rglob("*.parquet"))) == 6 and spark.read.parquet(f"{tmp_path}/out").count() == 6000
    assert adaptive == ["false"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = sinks.spread_by_folder(spark.range(4000).withColumn("g", F.lit("one")), ["g"], rows=1000)
        sizes = [r[0] for r in spread.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 4000 and max(sizes) <= 3000


def test_topics_by_the_directory_above(spark, tmp_path):
    for folder in ("a-events", "a-events/year=2026/month=08", "deep/b-events", "x=1/c-events"):
        Path(tmp_path, folder).mkdir(parents=True, exist_ok=True)
        Path(tmp_path, folder, "part=0.json").write_text('{"event_id": "e"}\n')
    events = readers.read_events(spark, str(tmp_path))
    assert sorted(r["topic"] for r in events.select("topic").collect()) == ["a-events", "a-events", "b-events", "c-events"]
    # the pattern is looked for only where a directory names a column
    topic = events.selectExpr("topic")._jdf.queryExecution().optimizedPlan().toString()
    assert topic.count("regexp_extract") == topic.count("ELSE") == 1


def test_unique_events_of_a_written_table_go_out_as_they_lie(spark, tmp_path, monkeypatch):
    """The batch run's events were compared and brought together already; the second run finds them all."""
    write_lake(spark, tmp_path)
    lake = medallion.Lake(str(tmp_path))
    calls = []
    for name in ("first_by_key", "gathered"):
        plain = getattr(sinks, name)
        monkeypatch.setattr(sinks, name, lambda *a, _f=plain, _n=name: calls.append(_n) or _f(*a))
    medallion.to_silver(spark, lake)
    assert calls.count("first_by_key") == 0 and calls.count("gathered") == 6  # rejects, events and the enriched tables
    want = sorted(r["event_id"] for r in spark.read.parquet(lake.silver("events")).select("event_id").collect())
    medallion.to_silver(spark, lake)
    assert sorted(r["event_id"] for r in read_committed(spark, lake.unique_events).select("event_id").collect()) == want
    assert CommitLog(spark, lake.unique_events).last() == 1
    rows = spark.createDataFrame([(None, "d")], "event_id string, day string")
    with pytest.raises(Exception, match="NULL in key column"):
        sinks.insert_if_absent(rows, f"{tmp_path}/t", "event_id", partition_by=["day"], placed=True)


def test_rows_of_a_micro_batch_are_moved_once(spark):
    rows = spark.range(4000).withColumn("g", (F.col("id") % 3).cast("string"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sinks.spread_by_folder(rows, ["g"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_alerts_reach_the_archive_as_they_lie(spark, tmp_path, monkeypatch):
    dealt = []
    gathered = sinks.gathered
    monkeypatch.setattr(sinks, "gathered", lambda df, folders: dealt.append(1) or gathered(df, folders))
    rows = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "2")], "event_id string, day string")
    target, archive = f"{tmp_path}/target", f"{tmp_path}/archive"
    sinks.insert_if_absent(rows, target, "event_id", partition_by=["day"], also=[archive])
    # the rows of a batch are brought together once, for the first target
    assert len(dealt) == 1
    # with an earlier commit on the same day, what is left of the write is brought together anew
    sinks.insert_if_absent(spark.createDataFrame([("d", "2")], rows.schema), archive, "event_id", partition_by=["day"])
    more = spark.createDataFrame([("b", "2"), ("d", "2"), ("e", "2"), ("e", "2")], rows.schema)
    sinks.insert_if_absent(more, target, "event_id", partition_by=["day"], also=[archive])
    assert sorted(tuple(r) for r in read_committed(spark, target).collect()) == [("a", "1"), ("b", "2"), ("c", "2"), ("d", "2"), ("e", "2")]
    assert sorted(tuple(r) for r in read_committed(spark, archive).collect()) == [("a", "1"), ("b", "2"), ("c", "2"), ("d", "2"), ("e", "2")]
