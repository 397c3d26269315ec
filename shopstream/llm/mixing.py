"""Mixing sources to target weights by entropy balancing.

Rates of documents, at most `MOST` copies, are to differ least (in relative entropy) from one copy
each while every source gets its target of words. The convex dual has one number a source: the rate of a
document of s words is exp(tilt * s), cut at the most copies. Newton iterations, as Spark
aggregations over all sources at once, solve for the tilts, and rates are rounded into whole copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.llm import common

#: Weights of the sources in their order, repeating; the most copies of a document, and so the most
#: that a target is of its source.
WEIGHTS, MOST = (5, 2, 1), 3

#: How near the words of the rates come to a target (relative), and the most iterations.
NEAR, ITERATIONS = 1e-9, 100

#: Pieces into which documents of one source and size are dealt to be numbered.
PIECES = 256


def _sizes(column: pa.Array) -> np.ndarray:
    """The words of each text: bytes that are no white space after one that is, or at the start."""
    data, offsets = common.utf8(column)
    inside = common.SPACED.is_word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = inside[firsts]
    before = np.concatenate([[0], np.cumsum(begins)])
    return before[offsets[1:]] - before[offsets[:-1]]


def measured(docs: DataFrame, text: str, source: str) -> DataFrame:
    """The documents with (source key, size) in place of the text. A key is the source after a
    sign, so that NULL has one too, which sorts last."""
    key = F.coalesce(F.concat(F.lit("0"), F.col(source).cast("string")), F.lit("1")).alias("_source")
    kept = [c for c in docs.columns if c not in (text, "_source", "_size")]
    rows = docs.select(*kept, key, common.whole_text(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches, "_text"):
            sizes = pa.array(_sizes(common.text_of(batch, "_text")), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], sizes], names=[*kept, "_source", "_size"])

    schema = T.StructType([*[rows.schema[c] for c in [*kept, "_source"]], T.StructField("_size", T.LongType())])
    return rows.mapInArrow(run, schema)


def targets(sources: DataFrame) -> DataFrame:
    """(_source, total) with the target of each source.

    Shares of all words by weight; what goes beyond the most that a source can give is shared
    again by weight among the others, until none is above. A round is one aggregation over the
    rows of the sources; each but the last finds further sources that give their most.
    """
    # one row for each source, in their order; documents never come here
    place = F.row_number().over(Window.orderBy("_source")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    most = F.col("total") * MOST
    rows = common.written(sources.withColumns({"weight": weight, "most": most}))
    share, full = 0.0, F.lit(False)
    while True:
        free = ~full
        found = rows.agg(
            F.sum("total").alias("all"),
            F.sum(F.when(full, F.col("most")).otherwise(0)).alias("given"),
            F.sum(F.when(free, F.col("weight"))).alias("weight"),
            F.count(F.when(full, 1)).alias("n"),
        ).first()
        if not found["all"] or not found["weight"]:
            return rows.withColumn("target", F.col("most").cast("double"))
        share, weights = float(found["all"] - found["given"]), found["weight"]
        amount = F.lit(share) * F.col("weight") / F.lit(weights)
        # a source that gave its most in an earlier round does so in all later ones, as shares only rise
        now = F.col("most") <= amount
        if rows.filter(now & free).isEmpty():
            return rows.withColumn("target", F.when(full, F.col("most").cast("double")).otherwise(amount))
        full = now


def rate(tilt: Column, size: Column) -> Column:
    """Copies of a document: exp(tilt * size), at most `MOST`."""
    return F.exp(F.least(tilt * size, F.lit(float(np.log(MOST)))))


def tilts(groups: DataFrame, wanted: DataFrame) -> DataFrame:
    """(_source, tilt): the minimum of the convex dual, for all sources at once.

    ``groups`` has one row for each source and size, with its number of documents. Each iteration
    is an aggregation of those into words and slope by source, then a Newton step on the logarithm
    of the words; a step out of the bracket that holds the root, or one that does not halve it in
    a while, is its middle. The driver sees only how many sources are still open.
    """
    log_most = float(np.log(MOST))
    at = wanted.filter((F.col("target") > 0) & (F.col("total") > 0))
    least = groups.filter("_size > 0").groupBy("_source").agg(F.min("_size").alias("_least"))
    at = at.join(least, "_source").select("_source", "target", "total", "most", "_least")
    down = F.least(F.log(F.col("target") / F.col("total")), F.lit(0.0)) / F.col("_least")
    state = at.select(
        "_source", "target", (F.col("target") >= F.col("most")).alias("done"),
        F.when(F.col("target") >= F.col("most"), F.lit(log_most) / F.col("_least")).otherwise(0.0).alias("tilt"),
        down.alias("low"),
        F.when(F.col("target") > F.col("total"), F.lit(log_most) / F.col("_least")).otherwise(0.0).alias("high"),
    )
    state = common.written(state)
    for step in range(ITERATIONS):
        placed = groups.filter("_size > 0").join(state.filter(~F.col("done")).select("_source", "tilt"), "_source")
        words = F.col("n") * F.col("_size") * rate(F.col("tilt"), F.col("_size"))
        free = F.col("tilt") * F.col("_size") < log_most
        sums = placed.groupBy("_source").agg(F.sum(words).alias("words"), F.sum(F.when(free, words * F.col("_size")).otherwise(0.0)).alias("slope"))
        now = state.join(sums, "_source", "left")
        above = F.col("words") > F.col("target")
        low, high = F.when(above, F.col("low")).otherwise(F.col("tilt")), F.when(above, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") + F.log(F.col("target") / F.col("words")) * F.col("words") / F.col("slope")
        # where all sizes between lie far apart, the middle by ratio gets there sooner
        middle = F.when(low > 0, F.sqrt(low * high)).when(high < 0, -F.sqrt(low * high)).otherwise((low + high) / 2)
        inside = F.coalesce((newton > low) & (newton < high), F.lit(False)) & F.lit(step % 8 != 7)
        near = F.abs(F.col("words") - F.col("target")) <= NEAR * F.col("target")
        done = F.col("done") | near | (low >= high)
        moved = now.select(
            "_source", "target", done.alias("done"),
            F.when(done, F.col("tilt")).when(inside, newton).otherwise(middle).alias("tilt"),
            F.when(F.col("done"), F.col("low")).otherwise(low).alias("low"),
            F.when(F.col("done"), F.col("high")).otherwise(high).alias("high"),
        )
        state = common.written(moved)
        if state.filter(~F.col("done")).isEmpty():
            break
    return state.select("_source", "tilt")


def rounded(groups: DataFrame) -> DataFrame:
    """(_source, _size, copies, extra): all documents of the size get so many copies, and `extra`
    of them one more.

    From the largest size down, what rounding leaves is carried on to the next size, so that a
    source ends within about its smallest document of its target. First every document keeps to the
    whole numbers beside its rate; only what cannot be placed so goes beyond them, within 0 and the
    most copies. A task holds the distinct sizes of a source, never its documents.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_size", ascending=False, ignore_index=True)
        size, n, rates = rows["_size"].to_numpy(), rows["n"].to_numpy(), rows["rate"].to_numpy()
        low, high = n * np.floor(rates).astype(np.int64), n * np.ceil(rates).astype(np.int64)
        taken, carry = np.zeros(len(rows), np.int64), float(rows["target"].iloc[0] - (n * size * rates).sum())
        for k in range(len(rows)):
            carry += n[k] * rates[k] * size[k]
            taken[k] = min(max(round(carry / size[k]), low[k]), high[k])
            carry -= int(taken[k]) * int(size[k])
        for k in range(len(rows)):
            more = min(max(round(carry / size[k]), -taken[k]), MOST * n[k] - taken[k])
            taken[k] += more
            carry -= int(more) * int(size[k])
        return pd.DataFrame({"_source": rows["_source"], "_size": size, "n": n, "copies": taken // n, "extra": taken % n})

    return groups.groupBy("_source").applyInPandas(run, "_source string, _size long, n long, copies long, extra long")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents with size (words), source_size (words of all its source), target (words that
    the mix wants of its source), taken (words it takes of the document) and copies, in place of the
    text. Columns named like a result are replaced.

    Sources stand in the order of their code points, NULL last, and weigh 5, 2, 1 and so on; their
    targets together are the words of all documents, none above three times its source. A NULL or
    empty text has no words and is never taken. Which documents of equal source and size get the
    extra copy is decided by a hash of their id, so runs agree; repeated rows are documents of their
    own and may get different copies. An empty table gives an empty one. If no document has words,
    all targets are 0.
    """
    named = ("size", "source_size", "target", "taken", "copies")
    kept = [c for c in docs.columns if c not in (text, *named)]
    renamed = docs.select(*[F.col(c).alias(f"c{k}") for k, c in enumerate(kept)], F.col(source).alias("_from"), F.col(text).alias("_body"))
    rows = common.written(measured(renamed, "_body", "_from").drop("_from"))
    groups = common.written(rows.groupBy("_source", "_size").agg(F.count("*").alias("n")))
    wanted = common.written(targets(groups.groupBy("_source").agg(F.sum(F.col("n") * F.col("_size")).alias("total"))))
    tilted = tilts(groups, wanted)
    rated = groups.filter("_size > 0").join(wanted.select("_source", "target"), "_source").join(tilted, "_source")
    counted = rounded(rated.withColumn("rate", rate(F.col("tilt"), F.col("_size"))))
    counted = groups.join(counted.drop("n"), ["_source", "_size"], "left").join(wanted, "_source")
    counted = counted.select("_source", "_size", F.col("total").alias("source_size"), "target", F.coalesce("copies", F.lit(0)).alias("copies"), F.coalesce("extra", F.lit(0)).alias("extra"))

    # numbers within a source and size: pieces by hash, where each begins, and the place within one
    order = F.xxhash64(F.col(f"c{kept.index(key)}"))
    dealt = rows.withColumns({"_order": order, "_piece": F.pmod(F.shiftrightunsigned(order, 8), F.lit(PIECES))})
    pieces = dealt.groupBy("_source", "_size", "_piece").agg(F.count("*").alias("m"))
    before = F.coalesce(F.sum("m").over(Window.partitionBy("_source", "_size").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = pieces.withColumn("_before", before).join(counted, ["_source", "_size"]).drop("m")
    number = F.row_number().over(Window.partitionBy("_source", "_size", "_piece").orderBy("_order", f"c{kept.index(key)}")) + F.col("_before")
    joined = dealt.join(placed, ["_source", "_size", "_piece"])
    copies = (F.col("copies") + F.when(number <= F.col("extra"), 1).otherwise(0)).alias("copies")
    columns = [F.col(f"c{k}").alias(c) for k, c in enumerate(kept)]
    final = joined.select(*columns, F.col("_size").alias("size"), "source_size", "target", copies)
    return final.withColumn("taken", F.col("copies") * F.col("size"))
