"""What Spark makes of the queries: pruned scans, bounded windows, no per-row Python, split hot keys."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from registry import lake  # noqa: F401  (adds its queries)
from registry.queries import QUERIES
from shopstream.functions.events import parse_payload
from shopstream.operators import aggregates as agg
from shopstream.operators import joins, skew, windows
from shopstream.operators import validation as val
from shopstream.plans import medallion

STREAMS = {n for n in QUERIES if n.startswith("stream_") and n != "stream_volume"}
# Windows without partitions see one row per period, or the few rows of a limit.
SINGLE_TASK_WINDOWS = {"fuse_category_volume", "fuse_loyalty_volume", "report_position", "running_revenue", "period_change"}


def plan(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_batch_plans(spark, sf, name):
    text = physical(QUERIES[name](spark, sf))
    for slow in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas", "ObjectHashAggregate"):
        assert slow not in text
    # A window without partition columns begins with its ordering or its frame.
    begins = re.findall(r"windowspecdefinition\(([^,]+),", text)
    whole = any(" ASC" in b or " DESC" in b or b.startswith("specifiedwindowframe") for b in begins)
    assert not whole or name in SINGLE_TASK_WINDOWS


def test_scans_read_only_what_is_needed(spark, sf):
    assert "ReadSchema: struct<o_totalprice:double>" in plan(QUERIES["revenue_kpi"](spark, sf))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan(QUERIES["average_basket_size"](spark, sf))


def test_filter_reaches_the_file(spark, tmp_path):
    spark.createDataFrame([("a", "FAILED", 1.0)], "event_id string, payment_status string, amount double").write.parquet(f"{tmp_path}/p")
    text = plan(val.failed_payments(spark.read.parquet(f"{tmp_path}/p")))
    assert "EqualTo(payment_status,FAILED)" in text


@pytest.mark.parametrize("name", ["top_categories", "top_segments", "latest_alerts", "latest_row", "top_products", "activity_feed", "head_by_key", "latest_events_overall"])
def test_top_k_keeps_k_rows_per_task(spark, sf, name):
    assert "TakeOrderedAndProject" in physical(QUERIES[name](spark, sf))


def test_small_master_table_is_broadcast_and_large_one_is_not(spark, sf):
    assert "BroadcastHashJoin" in physical(QUERIES["enrich_views"](spark, sf))
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "100"}):
        text = physical(QUERIES["enrich_views"](spark, sf))
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_groups_are_trimmed_before_the_shuffle(spark, sf):
    for name in ("latest_events", "first_by_key", "drop_duplicate_events", "trending_products"):
        text = physical(QUERIES[name](spark, sf))
        assert re.search(r"WindowGroupLimit .*Partial", text), name


def test_hot_key_is_split(spark):
    """A third of the facts are identical copies of one key, a third have no key."""
    n = 90_000
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    tag = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    facts = spark.range(0, n, 1, 8).select(key.alias("customer_id"), tag.alias("event_id"))
    people = [F.col("id").cast("string").alias("customer_id"), F.lit("Gold").alias("loyalty_tier"), F.lit("x").alias("city"), F.lit("SP").alias("state_code")]
    customers = spark.range(0, n, 1, 4).select(*people).unionByName(spark.range(1).select(F.lit("hot").alias("customer_id"), *people[1:]))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    with settings(spark, **small):
        joined = joins.enrich_orders(facts, customers)
        rows = {(r["loyalty_tier"], r["city"]): r["count"] for r in joined.groupBy("loyalty_tier", "city").count().collect()}
        assert rows == {("Gold", "x"): 2 * n // 3, ("Standard", None): n // 3}
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in physical(joined)


def test_salted_join_is_whole(spark):
    facts = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit("b")).alias("k"), "id")
    dim = spark.createDataFrame([("hot", 1), ("c", 2)], "k string, v int")
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        joined = skew.lookup(facts, dim, "k", salts=4)
        assert joined.columns == ["k", "id", "v"]
        assert joined.count() == 1000 and joined.filter("v = 1").count() == 334
        assert skew.lookup(facts, dim, "k", "left_anti", salts=4).count() == 666
        assert skew.lookup(facts, dim, "k", "left_semi", salts=4).count() == 334
    with pytest.raises(ValueError):
        skew.lookup(facts, dim, "k", "full")


def hot_customer(spark, n):
    """One customer with most events, a minute apart."""
    ts = F.timestamp_micros(F.lit(1_780_000_000_000_000) + F.col("id") * 60_000_000)
    who = F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).otherwise(F.lit("hot"))
    return spark.range(0, n, 1, 8).select(F.col("id").alias("event_id"), ts.alias("event_timestamp"), who.alias("customer_id"))


def test_hot_customer_is_spread_over_time_slices(spark):
    events = hot_customer(spark, 20_000)
    assigned = windows.assign_sessions(events, 90)
    assert re.search(r"hashpartitioning\(customer_id#\d+, _slice#\d+", physical(assigned))
    # A pause of two minutes, where another customer's event lies, ends a session of the hot one.
    assert assigned.filter("customer_id = 'hot'").agg(F.max("session_no")).first()[0] == 2000
    paid = events.withColumn("payment_status", F.when(F.col("event_id") % 7 == 0, "SUCCESS").otherwise("FAILED"))
    text = physical(windows.consecutive_failures(paid, 3))
    assert re.search(r"hashpartitioning\(customer_id#\d+, _slice#\d+", text)
    text = physical(windows.rapid_failures(paid.withColumn("amount", F.lit(1.0)), 3, 600))
    assert re.search(r"hashpartitioning\(customer_id#\d+, _slice#\d+", text)


def test_products_meet_their_master_row_once(spark, sf):
    """Sums come before the join: the join sees one row per product."""
    text = plan(QUERIES["revenue_by_category"](spark, sf))
    tree = text.split("\n\n")[0]
    lines = [line for line in tree.splitlines() if "HashAggregate" in line or "Join" in line]
    assert "HashAggregate" in lines[-1] and any("Join" in line for line in lines)
    assert max(i for i, x in enumerate(lines) if "Join" in x) < max(i for i, x in enumerate(lines) if "HashAggregate" in x)


def test_few_groups_and_large_limits_are_trimmed_in_parts(spark, sf):
    df = spark.range(10).withColumn("g", F.lit(1))
    assert "SPARK_PARTITION_ID" in physical(skew.top_per_group(df, "g", [F.col("id")], 5000))
    assert "SPARK_PARTITION_ID" in physical(QUERIES["latest_events"](spark, sf))
    assert "SPARK_PARTITION_ID" not in physical(skew.top_per_group(df, "g", [F.col("id")], 5))


def test_share_needs_no_single_task(spark, sf):
    assert "SinglePartition" not in physical(agg.share_by(spark.read.parquet(f"{sf}/events.parquet"), "event_type")).split("Subquery")[0]


def test_a_line_is_parsed_once(spark, sf, tmp_path):
    """Whatever fields and filters come after; a stream's plan is that of its source in batch."""
    read = QUERIES["read_events"](spark, sf)
    frames = [QUERIES["payload_round_trip"](spark, sf), read, read.filter("amount > 1 AND fits")]
    tagged = val.tag_rejects(parse_payload(spark.createDataFrame([("{}",)], "value string").withColumn("topic", F.lit("t"))), medallion.LAKE_RULES)
    frames += [tagged, tagged.filter(F.col(val.REASON).isNull()), tagged.filter("quantity > 1 AND amount > 2").select("event_id")]
    for frame in frames:
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
