"""Writes into the lake."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from shopstream.functions.events import time_partitions
from shopstream.operators.skew import as_list
from shopstream.operators.validation import first_by_key
from shopstream.sources import commits
from shopstream.sources.commits import CommitLog, Write

# Rows of a file where adaptive execution does not measure them.
FILE_ROWS = 1_000_000

# Spark's own JSON formats stop at milliseconds.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_partitioned(
    df: DataFrame,
    path: str,
    ts: str = "event_timestamp",
    grain: str = "hour",
    fmt: str = "parquet",
    mode: str = "append",
    by: Sequence[str] = (),
) -> None:
    """Appends into year/month/day[/hour] directories taken from a timestamp column.

    Columns in `by` become directories above these.

    Rows are brought together by directory first, so that a directory gets few files; a
    directory with very many rows is split into several tasks. Adaptive execution sees to both;
    where it is off, as in micro-batches, `spread_by_folder` does.
    """
    parts = time_partitions(F.col(ts), grain)
    folders = [*by, *parts]
    placed = df.withColumns(parts)
    writer = gathered(placed, folders).write.partitionBy(*folders).mode(mode).format(fmt)
    (writer.options(**JSON_TIMES) if fmt == "json" else writer).save(path)


def gathered(placed: DataFrame, folders: Sequence[str]) -> DataFrame:
    """The rows of a directory brought together in as few tasks as their size allows."""
    if not folders:
        return placed
    adaptive = placed.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    return placed.hint("rebalance", *folders) if adaptive else spread_by_folder(placed, folders)


def spread_by_folder(placed: DataFrame, folders: Sequence[str], rows: int = FILE_ROWS) -> DataFrame:
    """The rows dealt to tasks by directory; one with more than so many rows, to several, by a hash
    of the row and, for rows that are equal, by the task they come from."""
    # one row for each directory of the batch
    named = [F.col(c).alias(f"_folder{k}") for k, c in enumerate(folders)]
    counted = placed.groupBy(*named).agg(F.ceil(F.count("*") / rows).alias("_n"))
    same = [F.col(c).eqNullSafe(F.col(f"_folder{k}")) for k, c in enumerate(folders)]
    pieces = placed.join(F.broadcast(counted), same, "left").select(*placed.columns, "_n")
    salt = F.pmod(F.xxhash64(*placed.columns, F.spark_partition_id()), F.col("_n"))
    return pieces.withColumn("_salt", salt).repartition(*folders, "_salt").drop("_salt", "_n")


def write_report(df: DataFrame, path: str) -> None:
    """Replaces a report."""
    df.write.mode("overwrite").parquet(path)


def export_json_sample(df: DataFrame, path: str, key: str | Sequence[str], n: int) -> None:
    """The first n rows by key as JSON lines."""
    df.orderBy(*as_list(key)).limit(n).write.mode("overwrite").options(**JSON_TIMES).json(path)


def write_rejects(rejected: DataFrame, path: str, ts: str = "failed_at") -> None:
    """Rejected rows as JSON lines, in directories by the time of rejection."""
    write_partitioned(rejected, path, ts, "hour", "json")


def insert_if_absent(
    new: DataFrame,
    target: str,
    key: str | Sequence[str],
    order: Sequence[str] = ("event_timestamp", "event_id"),
    partition_by: Sequence[str] = (),
    also: Sequence[str] = (),
    placed: bool = False,
) -> None:
    """Appends the rows whose key the target does not have; the first row of a key wins.

    Any number of writers may insert at once: rows count from their commit on, and a writer that
    finds another's commit before its own drops the keys that this one brought. Read the
    target with `read_committed`. The target is only asked which of the new keys it has, so its
    side of the join is one column and, for a small batch, is not shuffled. With `partition_by`,
    all rows of a key must belong to one partition, and only commits with the partitions that
    the new rows fall in are read. Running the same batch again adds nothing. A NULL key is an
    error: nothing tells its rows apart.

    What is committed goes on to the targets in `also`, where a key may be there already. The
    commit is the marker for all of them: if a run ends between two targets, the next insert first
    brings the others up to date.

    `placed` says that the rows are a written table that has each key once, in directories by
    `partition_by`: it is read again instead of kept, and keys are not compared within it. Rows that
    meet no earlier commit then go out as they lie.
    """
    keys = as_list(key)
    spark = new.sparkSession
    _forward(spark, target, keys, order, partition_by, also)
    checked = new.withColumns({k: F.when(F.col(k).isNull(), F.raise_error(F.lit(f"NULL in key column {k}"))).otherwise(F.col(k)) for k in keys})
    rows = checked if placed else first_by_key(checked, keys, order)
    _insert(spark, rows.select(*new.columns), target, keys, partition_by, also, placed=placed)
    commits.reached("first target")
    _forward(spark, target, keys, order, partition_by, also)


def _insert(
    spark: SparkSession,
    rows: DataFrame,
    target: str,
    keys: list[str],
    partition_by: Sequence[str],
    also: Sequence[str] = (),
    source: str | None = None,
    placed: bool = False,
) -> None:
    """Commits the rows of keys that the target lacks; rows have each key once."""
    log = CommitLog(spark, target)
    unique = rows if placed else rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # one row for each partition that the batch touches
        touched = [list(r) for r in unique.select(*partition_by).distinct().collect()] if partition_by else None
        at = log.last()
        fresh, added = unique, log.writes(at)
        while True:
            known = log.read(added, partition_by, touched)
            if known is not None:
                taken = known.select(*keys).join(fresh.select(*keys), keys, "left_semi").distinct()
                fresh = fresh.join(taken, keys, "left_anti").select(*rows.columns)
                placed = False
            folder = log.stage(fresh if placed else gathered(fresh, partition_by), partition_by)
            write = Write(folder, json.dumps(rows.schema.jsonValue()), list(partition_by), touched, list(also), source)
            # as written, so that a loser's next round does not compute them again
            fresh = log.read([write])
            if source is None and fresh.isEmpty():
                return
            commits.reached("staged")
            while not log.put(at + 1, write):
                at, before = log.last(), at
                added = log.writes(at, before)
                known = log.read(added, partition_by, touched)
                if known is not None and not known.select(*keys).join(fresh.select(*keys), keys, "left_semi").isEmpty():
                    break  # some keys are taken by now
            else:
                return
    finally:
        if unique.is_cached:
            unique.unpersist()


def _forward(spark: SparkSession, target: str, keys: list[str], order: Sequence[str], partition_by: Sequence[str], also: Sequence[str]) -> None:
    """Brings the commits of a target to those of the other targets that lack them."""
    if not also:
        return
    log = CommitLog(spark, target)
    writes = log.writes(log.last())
    for other in also:
        there = CommitLog(spark, other)
        done = {w.source for w in there.writes(there.last())}
        for write in writes:
            if other in write.also and write.folder not in done:
                # a write lies in directories already, with each key once
                _insert(spark, log.read([write]), other, keys, partition_by, source=write.folder, placed=list(partition_by) == write.partition_by)
                commits.reached("next target")


def write_multi(df: DataFrame, targets: Sequence[Callable[[DataFrame], None]]) -> None:
    """One computed batch written to several sinks."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for write in targets:
            write(kept)
    finally:
        kept.unpersist()
