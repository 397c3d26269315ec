"""Joins and per-key picks that hold up when one key owns a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Least number of groups a streaming key is spread over; batch joins are split by adaptive execution.
STREAM_SALTS = 8
# Above this many rows per key Spark no longer trims groups before the shuffle.
MAP_SIDE_LIMIT = 1000
# Parts a group is first trimmed in where there are few groups or many rows are kept.
SPREAD = 64


def as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the optimizer's size estimate is within the session's broadcast limit."""
    session = df.sparkSession._jsparkSession
    limit = session.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= int(limit)


def lookup(
    fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left", salts: int | None = None
) -> DataFrame:
    """Join a large table to a master table on equal keys.

    In batch the optimizer broadcasts a master table whose size is within the session's
    limit, so the facts do not move, and joins a larger one by shuffle. There adaptive
    execution measures the shuffled data: it still broadcasts a master table that turns
    out small, and it cuts the partition of a hot key (identical copies and NULL keys
    included) by the tasks that wrote it, giving each piece the master rows it needs.

    Streams have no adaptive execution, so where the master table is too large to be sent
    to every task, the facts of a key are spread over `salts` groups by the input partition
    they come from, and every master row is repeated once per group. There are as many
    groups as a quarter of the shuffle partitions. The spread does not look at row
    contents, and a task that is run again repeats it exactly.
    """
    if how not in ("left", "left_anti", "left_semi"):
        raise ValueError(f"unsupported join type {how}")
    keys = as_list(on)
    added = [c for c in dim.columns if c not in keys] if how == "left" else []
    if salts is None:
        partitions = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salts = max(STREAM_SALTS, partitions // 4) if fact.isStreaming and not fits_broadcast(dim) else 1
    if salts == 1:
        joined = fact.join(dim, keys, how)
    else:
        salted = fact.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = salted.join(copies, [*keys, "_salt"], how)
    return joined.select(*fact.columns, *added)


def top_per_group(
    df: DataFrame, by: str | Sequence[str], order: Sequence[Column], n: int, few_groups: bool = False
) -> DataFrame:
    """The first n rows of every group in the given order.

    For small n Spark trims each group inside the map tasks, so at most n rows per group
    and task are shuffled. With few groups those rows still meet in few tasks, and for
    larger n nothing is trimmed; in both cases every group is first trimmed in parts, by
    input partition, and only what is left of the parts is brought together.
    """
    by = as_list(by)

    def pick(rows: DataFrame, keys: list[str]) -> DataFrame:
        ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        return ranked.filter(F.col("_rank") <= n).drop("_rank")

    if few_groups or n > MAP_SIDE_LIMIT:
        df = pick(df.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(SPREAD))), [*by, "_part"]).drop("_part")
    return pick(df, by)


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp"))


def time_slice(ts: Column | str, seconds: int) -> Column:
    """Number of the fixed-length slice of time the row falls in.

    Windows per key are computed per (key, slice) and joined up afterwards, so no task
    ever has to hold the whole history of one key.
    """
    return F.floor(micros(ts) / F.lit(seconds * 1_000_000))
