"""Expressions and projections over event records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.functions.money import cents, from_cents
from shopstream.sources.schemas import CORRUPT, EVENT_FIELDS, EVENT_SCHEMA, VERSION_FIELDS

# Partition directory names and their formats.
PARTITION_FORMATS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}


def _loose(kind: T.DataType) -> T.DataType:
    """The type with every whole number as a double."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _loose(f.dataType), f.nullable) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_loose(kind.elementType), kind.containsNull)
    return T.DoubleType() if isinstance(kind, T.IntegerType) else kind


_LOOSE = _loose(EVENT_SCHEMA)


def normalize_event_time(text: Column) -> Column:
    """ISO-8601 text to TIMESTAMP, tolerating a Z after an offset; bad text gives NULL."""
    # the pattern costs more than reading the time; most texts do without
    utc = F.endswith(text, F.lit("+00:00Z"))
    without = F.when(utc, F.substring(text, F.lit(1), F.length(text) - 1)).when(~F.contains(text, F.lit("Z")), text)
    return F.try_to_timestamp(without.otherwise(F.regexp_replace(text, r"([+-]\d{2}:?\d{2})Z$", "$1")))


def payment_event_type(status: Column) -> Column:
    """payment_completed for SUCCESS, payment_failed for anything else."""
    return F.when(status == "SUCCESS", F.lit("payment_completed")).otherwise(F.lit("payment_failed"))


def time_partitions(ts: Column, grain: str = "hour") -> dict[str, Column]:
    """Directory columns from year down to the grain, zero-padded text."""
    names = list(PARTITION_FORMATS)
    if grain not in names:
        raise ValueError(f"grain must be one of {names}")
    at = ts.cast("timestamp")
    # numbers padded with zeros cost a fraction of a date format; a year of more than four digits has its own text
    year = F.when(F.year(at).between(1000, 9999), F.year(at).cast("string")).otherwise(F.date_format(at, "yyyy"))
    rest = {n: F.lpad(of(at).cast("string"), 2, "0") for n, of in (("month", F.month), ("day", F.day), ("hour", F.hour))}
    return {n: year if n == "year" else rest[n] for n in names[: names.index(grain) + 1]}


def explode_items(orders: DataFrame, items: str = "items") -> DataFrame:
    """One row per order line; an order without lines keeps one row of NULLs."""
    line = F.explode_outer(items).alias("item")
    return orders.select(*[c for c in orders.columns if c != items], line).select(
        *[c for c in orders.columns if c != items],
        F.col("item.product_id").alias("product_id"),
        F.col("item.quantity").alias("quantity"),
        F.col("item.price").alias("price"),
    )


def items_total(items: Column) -> Column:
    """Sum of price times quantity over an array of lines: 0 if empty, NULL if NULL."""
    return from_cents(
        F.aggregate(
            items,
            F.lit(0).cast("long"),
            lambda total, i: total + F.coalesce(cents(i["price"] * i["quantity"]), F.lit(0).cast("long")),
        )
    )


def parse_payload(lines: DataFrame, text: str = "value") -> DataFrame:
    """A column of JSON lines replaced by the fields of the superset event schema; lines that do
    not fit keep their text in the corrupt field.

    Whole-number fields are read as any number: 2.0 is 2, and 2.5 or a number that is not finite
    does not fit. A line is parsed once, whichever fields and filters come after: the struct
    leaves a generator, into which the optimizer copies no filter or projection.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "allowNonNumericNumbers": "false"}
    kept = [c for c in lines.columns if c != text]
    read = lines.select(*kept, F.col(text).alias("_text"), F.explode(F.array(F.from_json(text, _LOOSE, options))).alias("_read"))

    def whole(value: Column) -> Column:
        return value.isNull() | ((value == F.floor(value)) & (F.abs(value) < 2**31))

    items = F.coalesce(F.col("_read.items"), F.array().cast(_LOOSE["items"].dataType))
    fits = F.forall(items, lambda i: whole(i["quantity"]))
    for field in EVENT_SCHEMA.fields:
        if field.dataType == T.IntegerType():
            fits = fits & whole(F.col("_read")[field.name])
    judged = read.withColumn("_fits", fits)
    columns = []
    for field in EVENT_SCHEMA.fields:
        value = F.col("_read")[field.name]
        if field.name == CORRUPT:
            value = F.coalesce(value, F.when(~F.col("_fits"), F.col("_text")))
        else:
            value = F.when(F.col("_fits"), value.cast(field.dataType))
        columns.append(value.alias(field.name))
    return judged.select(*columns, *kept)


def to_payload(df: DataFrame, name: str = "value") -> DataFrame:
    """Each row as one JSON line in a single text column; NULL fields are left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))


def event_header(
    df: DataFrame, event_type: str, version: str = "1.0", source: str = "web", producer: str = "event-generator"
) -> DataFrame:
    """Adds the header constants every topic shares."""
    return df.withColumns(
        {
            "event_version": F.lit(version),
            "event_type": F.lit(event_type),
            "producer": F.lit(producer),
            "source": F.lit(source),
        }
    )


def upgrade_event(df: DataFrame, version: str = "2.0") -> DataFrame:
    """Any event version as the given one: fields it lacks are added as NULL."""
    known = list(VERSION_FIELDS)
    if version not in known:
        raise ValueError(f"version must be one of {known}")
    types = {f.name: f.dataType for f in EVENT_FIELDS.fields}
    wanted = [f for v in known[: known.index(version) + 1] for f in VERSION_FIELDS[v]]
    added = {f: F.lit(None).cast(types.get(f, T.StringType())) for f in wanted if f not in df.columns}
    added["event_version"] = (
        F.coalesce(F.col("event_version"), F.lit(known[0])) if "event_version" in df.columns else F.lit(known[0])
    )
    return df.withColumns(added)
