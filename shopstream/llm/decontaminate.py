"""Benchmark decontamination by winnowed fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.llm import common

#: Words of a window; a k-gram is 7 words and the smallest of 7 neighbouring k-gram hashes is a
#: fingerprint, so every shared span of 7 + 7 - 1 = 13 words shares at least one.
WINDOW, GRAM = 13, 7

#: Benchmark words whose fingerprints one broadcast holds (about 100 bytes a word).
BLOCK_WORDS = 1_000_000

#: Stands for an item without an id.
NO_ID = np.iinfo(np.int64).min

HITS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def winnow(hashes: np.ndarray, span: int) -> np.ndarray:
    """Which hashes are the smallest of some ``span`` neighbours; all of those that tie are."""
    n = len(hashes)
    if n < span:
        return np.zeros(n, bool)
    least = hashes[: n - span + 1].copy()
    for j in range(1, span):
        np.minimum(least, hashes[j : n - span + 1 + j], out=least)
    chosen = np.zeros(n, bool)
    for j in range(span):
        chosen[j : n - span + 1 + j] |= hashes[j : n - span + 1 + j] == least
    return chosen


class Lookup:
    """A set of 64-bit numbers; most of what is absent is told by one bit of a table."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.shift = np.uint64(64 - max(12, int(len(self.values) * 32).bit_length()))
        self.bits = np.zeros(1 << (64 - int(self.shift)), bool)
        self.bits[self.values >> self.shift] = True

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places in x of what is in the set, and the places in the set."""
        at = np.flatnonzero(self.bits[x >> self.shift])
        if not len(at) or not len(self.values):
            return at[:0], at[:0]
        to = np.minimum(np.searchsorted(self.values, x[at]), len(self.values) - 1)
        same = self.values[to] == x[at]
        return at[same], to[same]


class Block:
    """The windows of some benchmark items: their hashes, the items of each, and fingerprints.

    A window is 13 words, or all words of a shorter item. Windows of 13 words are found through
    fingerprints; for a shorter length every run of that many words is its own fingerprint.
    """

    def __init__(self, items: list[tuple[int | None, str | None]]):
        texts = pa.array([t or "" for _, t in items], pa.large_string())
        hashes, offsets = common.words(*common.utf8(texts), common.ALNUM)
        fingerprints, windows = [], {}
        for (item, _), a, b in zip(items, offsets[:-1], offsets[1:], strict=True):
            n = int(min(b - a, WINDOW))
            if not n:
                continue
            own = hashes[a:b]
            windows.setdefault(n, []).append((NO_ID if item is None else item, common.grams(own, n)))
            if n == WINDOW:
                pieces = common.grams(own, GRAM)
                fingerprints.append(pieces[winnow(pieces, WINDOW - GRAM + 1)])
        self.fingerprints = Lookup(np.concatenate([np.zeros(0, np.uint64), *fingerprints]))
        self.windows, self.owners = {}, {}
        for n, made in windows.items():
            every = np.concatenate([w for _, w in made])
            self.windows[n] = Lookup(every)
            place = np.searchsorted(self.windows[n].values, every)
            item = np.concatenate([np.full(len(w), i, np.int64) for i, w in made])
            order = np.lexsort((item, place))
            place, item = place[order], item[order]
            fresh = np.ones(len(place), bool)
            fresh[1:] = (place[1:] != place[:-1]) | (item[1:] != item[:-1])
            ends = np.searchsorted(place[fresh], np.arange(len(self.windows[n].values) + 1))
            self.owners[n] = (ends, item[fresh])

    def items(self, n: int, places: np.ndarray) -> set[int]:
        """The ids of the items that have one of these windows."""
        ends, item = self.owners[n]
        return set().union(*(item[ends[p] : ends[p + 1]].tolist() for p in np.unique(places))) - {NO_ID}

    def hits(self, hashes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, first words, places of the windows) of all occurrences in these rows."""
        for n, known in self.windows.items():
            if n == WINDOW:
                pieces = common.grams(hashes, GRAM)
                chosen = np.flatnonzero(winnow(pieces, WINDOW - GRAM + 1))
                met, _ = self.fingerprints.find(pieces[chosen])
                # a shared fingerprint is extended to every window of 13 words around it
                starts = np.unique((chosen[met][:, None] - np.arange(WINDOW - GRAM + 1)).ravel())
                starts = starts[(starts >= 0) & (starts + n <= len(hashes))]
                spans = np.full(len(starts), n, np.uint64)
                for j, factor in enumerate(common.draws(n, 37) | np.uint64(1)):
                    spans += hashes[starts + j] * factor
                at, place = known.find(common.mix(spans))
                first = starts[at]
            else:
                first, place = known.find(common.grams(hashes, n))
            row = np.searchsorted(offsets, first, "right") - 1
            inside = first + n <= offsets[row + 1]  # not across the end of a text
            yield n, first[inside], place[inside]


def blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple]]:
    """The benchmark in parts of about ``block_words`` words, one at a time on the driver."""
    rows = common.written(benchmark.select(F.col("item_id").cast("long").alias("item_id"), common.whole_text().alias("text")))
    size = rows.agg(F.sum(F.length("text") / 5)).first()[0] or 0
    parts = int(size // block_words) + 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        yield [tuple(r) for r in rows.filter(part == k).collect()]


NEW = ("n_words", "hit_spans", "hit_items")


def find_benchmark(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS, names: tuple[str, str, str] = NEW) -> DataFrame:
    """The rows of ``docs`` with ``n_words``, ``hit_spans`` (the word ranges that lie in some
    benchmark window, end exclusive) and ``hit_items`` (ids of the items with such a window), or
    with other names for these.

    Test fingerprints go to the tasks in parts of a bounded size, one for most benchmarks; the
    training texts are read once for each part and never shuffled, so a passage that many texts
    share, or a very long text, costs no more than its words. Words and windows are compared by
    64-bit hashes. Null or empty texts have no words. Items without words have no window, items
    without an id mark words but are not listed, repeated items count once. Rows of ``docs`` are
    returned each, repeated ones too; their other columns stay, except that columns named like
    the three new ones are replaced.
    """
    found = docs.drop(*names)
    kinds = (T.LongType(), HITS, T.ArrayType(T.LongType()))
    schema = T.StructType([*found.schema.fields, *map(T.StructField, names, kinds)])
    for k, items in enumerate(blocks(benchmark, block_words)):
        block = docs.sparkSession.sparkContext.broadcast(Block(items))
        found = (common.written(found) if k else found).mapInArrow(_marker(block, names, k == 0), schema)
    return found


def _marker(block, names: tuple[str, str, str], first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = block.value
        for batch in common.steps(batches):
            hashes, offsets = common.words(*common.utf8(common.text_of(batch)), common.ALNUM)
            rows = batch.num_rows
            spans: dict[int, list] = {}
            items: dict[int, set] = {}
            if not first:
                for row, value in enumerate(batch.column(names[1]).to_pylist()):
                    spans[row] = [(v["start"], v["end"]) for v in value]
                for row, value in enumerate(batch.column(names[2]).to_pylist()):
                    items[row] = set(value)
            for n, starts, places in known.hits(hashes, offsets):
                row = np.searchsorted(offsets, starts, "right") - 1
                order = np.argsort(row, kind="stable")
                starts, places, row = starts[order], places[order], row[order]
                found, cuts = np.unique(row, return_index=True)
                for r, a, b in zip(found.tolist(), cuts, [*cuts[1:], len(row)], strict=False):
                    at = starts[a:b] - offsets[r]
                    spans.setdefault(r, []).extend((x, x + n) for x in at.tolist())
                    items.setdefault(r, set()).update(known.items(n, places[a:b]))
            kept = [x for x in batch.schema.names if x not in names]
            kind = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            joined = [[{"start": a, "end": b} for a, b in union(spans.get(r, []))] for r in range(rows)]
            listed = [sorted(items.get(r, ())) for r in range(rows)]
            columns = [*map(batch.column, kept), pa.array(np.diff(offsets), pa.int64()), pa.array(joined, pa.list_(kind)), pa.array(listed, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *names])

    return run


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same words as few ranges in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def n_hit(spans: str) -> Column:
    """The number of words in the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def is_contaminated(hit: Column, words: Column) -> Column:
    """At least one word in twenty lies in a benchmark window."""
    return (hit > 0) & (20 * hit >= words)


def judge(found: DataFrame) -> DataFrame:
    """The rows of ``find_benchmark`` with the number of hit words, of items, a digest of the
    items and whether a text is contaminated."""
    names = F.concat_ws(",", F.array_sort(F.transform("hit_items", lambda x: x.cast("string"))))
    return (
        found.withColumn("n_hit", n_hit("hit_spans"))
        .withColumn("n_items", F.size("hit_items").cast("long"))
        .withColumn("items_sha256", F.sha2(names, 256))
        .withColumn("contaminated", is_contaminated(F.col("n_hit"), F.col("n_words")))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the same columns."""
    found = find_benchmark(docs, benchmark, names=("__words", "__spans", "__items"))
    return found.filter(~is_contaminated(n_hit("__spans"), F.col("__words"))).select(*[F.col(f"`{c}`") for c in docs.columns])
