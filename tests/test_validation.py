from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopstream.functions.events import normalize_event_time, parse_payload, upgrade_event
from shopstream.operators import validation as v

SCHEMA = "event_id string, event_timestamp string, amount double, quantity int"


def reasons(spark, rows, rules=v.STANDARD_RULES, schema=SCHEMA):
    return [r[v.REASON] for r in v.tag_rejects(spark.createDataFrame(rows, schema), rules).collect()]


def test_first_broken_rule_gives_the_reason(spark):
    rows = [
        (None, "t", 1.0, 1),
        ("", "t", 1.0, 1),
        ("a", None, 1.0, 1),
        ("a", "t", -0.01, 1),
        ("a", "t", 1.0, 0),
        ("a", "t", None, None),
        (None, "t", -1.0, 0),
        ("a", "t", 0.0, 1),
    ]
    missing, bad = v.MISSING_FIELD, v.OUT_OF_RANGE
    assert reasons(spark, rows) == [missing, missing, missing, bad, bad, None, missing, None]


def test_absent_columns(spark):
    df = spark.createDataFrame([("a",)], "event_id string")
    assert v.tag_rejects(df).first()[v.REASON] == v.MISSING_FIELD
    assert v.tag_rejects(df, [v.in_range()]).first()[v.REASON] is None
    assert v.tag_rejects(df, []).first()[v.REASON] is None


def test_format_rules(spark):
    rows = [
        ("9f1c6f0e-6a8e-4d6c-9a55-0b0d2a4f7c11", "2026-08-01T14:22:10+00:00Z", "search"),
        ("not-a-uuid", "2026-08-01T14:22:10Z", "search"),
        ("9f1c6f0e-6a8e-4d6c-9a55-0b0d2a4f7c11", "not-a-date", "search"),
        ("9f1c6f0e-6a8e-4d6c-9a55-0b0d2a4f7c11", "2026-08-01T14:22:10Z", "wishlist"),
        (None, "2026-08-01T14:22:10Z", None),
    ]
    rules = [v.uuid_format(), v.iso_timestamp(), v.known_type()]
    found = reasons(spark, rows, rules, "event_id string, event_timestamp string, event_type string")
    assert found == [None, "Invalid UUID", "Invalid timestamp", "Unknown event type", "Invalid UUID"]


def test_event_time_with_stray_zone_letter(spark):
    rows = [("2026-08-01T14:22:10+00:00Z",), ("2026-08-01T14:22:10Z",), ("2026-08-01T16:22:10+02:00Z",), ("not-a-date",)]
    times = [r[0] for r in spark.createDataFrame(rows, "s string").select(normalize_event_time(F.col("s"))).collect()]
    assert times == [datetime(2026, 8, 1, 14, 22, 10)] * 3 + [None]


def test_lines_that_do_not_fit_keep_their_text(spark):
    lines = ['{"event_id":"a","amount":"abc"}', "{bad", "[1]", '{"event_id":"b","amount":1}', '{"event_id":"c","campaign":"x"}']
    parsed = parse_payload(spark.createDataFrame([(x,) for x in lines], "value string"))
    kept = [(r["event_id"], r["_corrupt"]) for r in parsed.collect()]
    assert [c for _, c in kept] == [lines[0], lines[1], lines[2], None, None]
    assert [i for i, c in kept if c is None] == ["b", "c"]
    rejected = v.tag_rejects(parsed, [v.parses_as_schema()])
    assert rejected.filter(F.col(v.REASON).isNotNull()).count() == 3


def test_exists_in_ignores_null_master_keys_and_repeats(spark):
    dim = spark.createDataFrame([("c1",), ("c1",), (None,)], "customer_id string")
    df = spark.createDataFrame([("c1",), ("c2",), (None,)], "customer_id string")
    tagged = {r["customer_id"]: r[v.REASON] for r in v.tag_rejects(df, [v.exists_in(dim, "customer_id")]).collect()}
    assert tagged == {"c1": None, "c2": "Unknown customer_id", None: "Unknown customer_id"}


def test_duplicates_keep_the_earliest_and_rows_without_id(spark):
    rows = [("a", 2, "late"), ("a", 1, "early"), ("b", 1, "only"), (None, 1, "x"), (None, 1, "x")]
    df = spark.createDataFrame(rows, "event_id string, event_timestamp int, tag string")
    kept = sorted((r["event_id"] or "", r["tag"]) for r in v.drop_duplicate_events(df).collect())
    assert kept == [("", "x"), ("", "x"), ("a", "early"), ("b", "only")]
    assert v.drop_duplicate_events(df, keep_null_keys=False).count() == 2


def test_upgrade_adds_fields_of_newer_versions(spark):
    df = spark.createDataFrame([("a", "1.0"), ("b", None)], "event_id string, event_version string")
    up = upgrade_event(df)
    assert up.columns == ["event_id", "event_version", "device", "campaign"]
    assert [r["event_version"] for r in up.collect()] == ["1.0", "1.0"]
    with_device = df.withColumn("device", F.lit("mobile"))
    assert upgrade_event(with_device, "1.1").first()["device"] == "mobile"
    with pytest.raises(ValueError):
        upgrade_event(df, "9.9")


field = st.one_of(st.none(), st.sampled_from(["", " ", "a", "b", "2026-08-01"]))
row = st.tuples(field, field, st.one_of(st.none(), st.floats(-5, 5)), st.one_of(st.none(), st.integers(-2, 2)))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=15))
def test_split_is_whole_and_disjoint(spark, rows):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA + ", n int")
    valid, rejected = v.split_valid(df, failed_at=datetime(2026, 1, 1))
    left, right = [r["n"] for r in valid.collect()], [r["n"] for r in rejected.collect()]
    assert sorted(left + right) == list(range(len(rows)))
