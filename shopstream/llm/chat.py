"""Chat formatting: logged snapshots of a conversation collapse to the longest one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _turns(rows: DataFrame) -> DataFrame:
    return rows.filter("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def prefixes(turns: DataFrame) -> DataFrame:
    """The hash of every turn prefix: conv_id, k (turns in it), h1 and h2.

    A prefix is the set of its (place, role, text), so its hash rolls on as two sums of hashes,
    with different seeds, over the turns so far; only hashes are shuffled, no text.
    """
    said = turns.select("conv_id", "turn", F.xxhash64("role", "text").alias("x"), F.hash("text", "role").alias("y"))
    said = said.distinct()
    order = Window.partitionBy("conv_id").orderBy("turn", "x", "y")
    placed = said.withColumn("k", F.row_number().over(order))
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    one, two = F.xxhash64("k", "x", "y"), F.xxhash64("y", F.lit(17), "k", "x")
    return placed.select(
        "conv_id",
        "k",
        F.sum(one.cast("decimal(20,0)")).over(running).alias("h1"),
        F.sum(two.cast("decimal(20,0)")).over(running).alias("h2"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """The conversations that are no prefix of a longer one, one of each set of equal ones:
    conv_id (the smallest), n_turns, n_copies."""
    own = prefixes(turns)
    n = F.max("k").over(Window.partitionBy("conv_id"))
    marked = own.withColumn("n", n)
    # equal conversations and shared beginnings are one row each from the map side on
    whole = marked.filter("k = n").groupBy("k", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    shorter = marked.filter("k < n").select("k", "h1", "h2").distinct()
    kept = whole.join(shorter, ["k", "h1", "h2"], "left_anti")
    return kept.select("conv_id", F.col("k").cast("long").alias("n_turns"), "n_copies")


def render(rows: DataFrame) -> DataFrame:
    """One row for each maximal conversation: conv_id, n_turns, n_copies and text, each turn as
    ``<|role|>``, a line feed, its text and a line feed.

    Turns are in order of turn; rows that are repeated whole count once, and different rows with
    one turn number all count, in order of a hash of them. A null role is ``unknown``, a null
    text empty, a null turn comes first; rows without a conversation are left out. An empty table
    gives no rows, and other columns are not read.
    """
    turns = _turns(rows)
    kept = maximal(turns)
    order = ["turn", F.xxhash64("role", "text").alias("x"), F.hash("text", "role").alias("y")]
    said = turns.select("conv_id", *order, F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n")).alias("said"))
    said = said.join(kept, "conv_id")
    parts = F.sort_array(F.collect_set(F.struct("turn", "x", "y", "said")))
    text = F.array_join(F.transform(parts, lambda p: p["said"]), "")
    return said.groupBy("conv_id", "n_turns", "n_copies").agg(text.alias("text"))


SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(concat('<|', role, '|>', chr(10), text, chr(10)) ORDER BY turn) AS said FROM t GROUP BY conv_id),
u AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies, said FROM c GROUP BY said)
SELECT conv_id, len(said)::BIGINT AS n_turns, n_copies, array_to_string(said, '') AS text FROM u
WHERE NOT EXISTS (SELECT 1 FROM u AS longer WHERE len(longer.said) > len(u.said) AND longer.said[1:len(u.said)] = u.said)
"""
