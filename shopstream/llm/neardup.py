"""MinHash near-duplicates with tensored banding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.llm import common, graph

#: Two collections of SIDE half keys, each of WIDE minhashes; every pair of half keys, one from
#: each collection, is a table. 2 * 12 * 4 = 96 minhashes make 144 tables of 8 minhashes, which
#: would take 1152 one by one. A pair of similarity s meets in some table with probability
#: (1 - (1 - s**4)**12)**2: 0.9997 at 0.85, 0.04 at 0.3.
SIDE, WIDE = 12, 4
HASHES = 2 * SIDE * WIDE

#: Similarity of whole sets, in hundredths, words of a shingle.
PERCENT, WORDS = 85, 3

#: Minhashes by which two members of a hot table are compared before their sets are: the 96 and
#: as many more. At 0.85 the share of equal ones has a deviation of 0.0186; four are allowed.
MORE = 272
MARGIN = 0.0745

#: Rows of one side of a comparison inside a table, and on which side of it a row is.
TILE = 512
LEFT, RIGHT, BOTH = 0, 1, 2

_A = (common.draws(HASHES + MORE, 101) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (common.draws(HASHES + MORE, 202) >> np.uint64(32)).astype(np.uint32)


def shingles(hashes: np.ndarray, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; with fewer words, of the whole text."""
    if not len(hashes):
        return hashes
    return np.unique(common.grams(hashes, min(words, len(hashes))))


def minhashes(own: np.ndarray, first: int = 0, last: int = HASHES) -> np.ndarray:
    """The smallest value of each hash function over a set."""
    x = (own >> np.uint64(32)).astype(np.uint32)
    a, b = _A[first:last], _B[first:last]
    least = np.full(last - first, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 512):
        np.minimum(least, (x[at : at + 512, None] * a + b).min(axis=0), out=least)
    return least


def half_keys(least: np.ndarray) -> np.ndarray:
    """A 64-bit key for each half: WIDE minhashes and the place of the half."""
    parts = least.reshape(-1, 2 * SIDE, WIDE).astype(np.uint64)
    out = np.arange(2 * SIDE, dtype=np.uint64)[None, :] + np.uint64(1)
    for j, factor in enumerate(common.draws(WIDE, 303) | np.uint64(1)):
        out = common.mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j] * factor)
    return out.view(np.int64)


_SKETCH = "n long, d1 long, d2 long, halves array<long>"


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with size, digest and half keys of the shingle set of each text."""
    for batch in common.steps(batches, "row.text"):
        hashes, offsets = common.words(*common.utf8(common.text_of(batch, "row.text")), common.SPACED)
        rows = batch.num_rows
        n, digests, least = np.zeros(rows, np.int64), np.zeros((2, rows), np.uint64), np.zeros((rows, HASHES), np.uint32)
        for r in range(rows):
            own = shingles(hashes[offsets[r] : offsets[r + 1]])
            if len(own):
                n[r], least[r] = len(own), minhashes(own)
                digests[0, r], digests[1, r] = own.sum(), common.mix(own).sum()
        ends = np.concatenate([[0], np.cumsum(np.where(n > 0, 2 * SIDE, 0))]).astype(np.int32)
        halves = pa.ListArray.from_arrays(pa.array(ends), pa.array(half_keys(least)[n > 0].ravel()))
        columns = [batch.column("row"), pa.array(n), *(pa.array(d.view(np.int64)) for d in digests), halves]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "n", "d1", "d2", "halves"])


_SETS = "c long, n long, halves array<long>, items binary, least binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingle hashes of each text as bytes, and its minhashes."""
    for batch in common.steps(batches):
        hashes, offsets = common.words(*common.utf8(common.text_of(batch)), common.SPACED)
        own = [shingles(hashes[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        made = [minhashes(o, 0, HASHES + MORE).tobytes() for o in own]
        columns = [*map(batch.column, ("c", "n", "halves")), pa.array([o.tobytes() for o in own], pa.binary()), pa.array(made, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["c", "n", "halves", "items", "least"])


def _similar(left: np.ndarray, right: np.ndarray) -> bool:
    """Whether two whole sets, sorted, are similar enough."""
    both = np.concatenate([left, right])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= PERCENT * (len(both) - shared)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose whole sets are similar enough."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        held, left = None, None
        ours, theirs = batch.column(2), batch.column(3)
        for r in range(batch.num_rows):
            one = ours[r].as_buffer()
            if held is None or not one.equals(held):  # rows of one set often come together
                held, left = one, np.frombuffer(one, np.uint64)
            keep[r] = _similar(left, np.frombuffer(theirs[r].as_buffer(), np.uint64))
        out = batch.filter(pa.array(keep)).select(["a", "b"])
        if out.num_rows:
            yield out


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among candidate pairs (a, b)."""
    items = sets.select("c", "items")
    both = pairs.join(items.withColumnsRenamed({"c": "b", "items": "theirs"}), "b")
    both = both.join(items.withColumnsRenamed({"c": "a", "items": "ours"}), "a")
    return both.select("a", "b", "ours", "theirs").mapInArrow(_linked, "a long, b long")


def _tables(halves: DataFrame) -> DataFrame:
    """The tables (t) that a class (c) may share with another: pairs of half keys, one from each
    collection, of which both also occur elsewhere."""
    each = halves.select("c", F.posexplode("halves").alias("place", "key"))
    often = each.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    shared = each.join(often, "key").select("c", "key", (F.col("place") < SIDE).alias("first"))
    sides = shared.groupBy("c").agg(
        F.collect_list(F.when(F.col("first"), F.col("key"))).alias("x"),
        F.collect_list(F.when(~F.col("first"), F.col("key"))).alias("y"),
    )
    x = sides.select("c", F.explode("x").alias("x"), "y")
    return x.select("c", F.explode("y").alias("y"), "x").select("c", F.xxhash64("x", "y").alias("t"))


def _tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components among the rows of two tiles. Candidates are of different
    components, alike by their minhashes, and meet in this half key first; their whole sets
    decide, until the two components are joined. Rows come sorted by group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        group = np.stack([batch.column(k).to_numpy() for k in range(3)])
        cuts = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
        if held and batch.num_rows and any(held[-1].column(k)[0].as_py() != group[k, 0] for k in range(3)):
            yield from _compare(held)
            held = []
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if held and a:
                yield from _compare(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield from _compare(held)


def _compare(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(held).combine_chunks()
    if rows.num_rows < 2:
        return
    place = rows["place"][0].as_py()
    c, comp, side, n = (rows[name].to_numpy() for name in ("c", "comp", "side", "n"))
    if comp.min() == comp.max():
        return
    least = np.frombuffer(b"".join(rows["least"].to_pylist()), np.uint32).reshape(len(c), -1)
    halves = half_keys(np.ascontiguousarray(least[:, :HASHES]))
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["items"].chunk(0)]
    # a tile with itself comes once, and is both sides
    alone = side.min() == BOTH
    one, two = np.flatnonzero(side != RIGHT), np.flatnonzero(side != LEFT)
    need = PERCENT / 100 - MARGIN
    # components that links of this group have joined so far
    root = {x: x for x in np.unique(comp).tolist()}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    found = []
    for r in one:
        other = two[(comp[two] != comp[r]) & ((c[two] > c[r]) if alone else True)]
        small, large = np.minimum(n[other], n[r]), np.maximum(n[other], n[r])
        other = other[100 * small >= PERCENT * large]
        if len(other):
            other = other[(least[other] == least[r]).mean(axis=1) >= need]
        if len(other):
            same = halves[other] == halves[r]
            other = other[(same[:, :SIDE].argmax(axis=1) == place) & same[:, SIDE:].any(axis=1)]
        for k in other.tolist():
            x, y = find(int(comp[r])), find(int(comp[k]))
            if x != y and _similar(sets[r], sets[k]):
                root[max(x, y)] = min(x, y)
                found.append((int(c[r]), int(c[k])))
    if found:
        a, b = zip(*found, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _cells(each: DataFrame) -> DataFrame:
    """The rows (key, band, comp) of half keys that hold several components, dealt to cells (key,
    band, owner): a component with a whole tile of rows owns its cell, small ones share one
    (owner -1)."""
    counts = each.groupBy("key", "band", "comp").agg(F.count("*").alias("m"), F.min("n").alias("short"), F.max("n").alias("long"))
    mixed = counts.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
    owner = F.when(F.col("m") >= TILE, F.col("comp")).otherwise(-1).alias("owner")
    return counts.join(mixed.select("key"), "key").select("key", "band", "comp", owner, "m", "short", "long")


def _meetings(each: DataFrame) -> DataFrame:
    """Which rows of ``each`` (key, place, band, c, comp, n) are compared: c, comp, place, the
    group (pair, i, j) and the side of it.

    Cells of a half key are paired only where they hold different components and sizes that
    allow a link; bands, of which a link joins equal or neighbouring ones, keep that a join on
    equal values. A cell is cut into tiles of about TILE rows, and each pair of tiles of two paired
    cells is a group. So a group of copies that is one component meets the outsiders alone: its
    rows are sent once for each tile of theirs.
    """
    owners = common.written(_cells(each))
    cells = owners.groupBy("key", "band", "owner").agg(
        F.ceil(F.sum("m") / TILE).cast("int").alias("tiles"),
        F.min("comp").alias("low"),
        F.max("comp").alias("high"),
        F.min("short").alias("short"),
        F.max("long").alias("long"),
    )
    left = cells.select("key", *[F.col(x).alias(f"{x}1") for x in cells.columns[1:]])
    right = cells.select("key", *[F.col(x).alias(f"{x}2") for x in cells.columns[1:]])
    near = left.withColumn("band2", F.explode(F.array("band1", F.col("band1") + 1)))
    pairs = near.join(right.hint("merge"), ["key", "band2"]).filter(
        "(band1 < band2 OR owner1 <= owner2) AND least(low1, low2) <> greatest(high1, high2)"
        f" AND 100 * long1 >= {PERCENT} * short2 AND 100 * long2 >= {PERCENT} * short1"
    )
    pairs = pairs.withColumn("same", F.expr("band1 = band2 AND owner1 = owner2"))
    pairs = common.written(pairs.withColumn("pair", F.monotonically_increasing_id()))
    member = each.join(owners.select("key", "band", "comp", "owner").hint("merge"), ["key", "band", "comp"])
    firsts = pairs.selectExpr("key", "band1 AS band", "owner1 AS owner", "pair", "same", "true AS first", "tiles1 AS own", "tiles2 AS others")
    seconds = pairs.selectExpr("key", "band2 AS band", "owner2 AS owner", "pair", "same", "false AS first", "tiles2 AS own", "tiles1 AS others")
    sent = member.join(firsts.unionAll(seconds).hint("merge"), ["key", "band", "owner"])
    sent = sent.withColumn("tile", F.pmod(F.xxhash64("c"), F.col("own")).cast("int"))
    sent = sent.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    # a cell with itself: as the first the own tile and later ones, as the second earlier ones
    sent = sent.filter("NOT same OR (first AND other >= tile) OR (NOT first AND other < tile)")
    return sent.select(
        "c",
        "comp",
        "place",
        "pair",
        F.when(F.col("first"), F.col("tile")).otherwise(F.col("other")).alias("i"),
        F.when(F.col("first"), F.col("other")).otherwise(F.col("tile")).alias("j"),
        F.when(F.expr("same AND tile = other"), BOTH).when(F.col("first"), LEFT).otherwise(RIGHT).alias("side"),
    )


def _others(tables: DataFrame, part: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between different components in tables that hold more than a star, enough to join
    what any candidate pair joins. Small rows decide which tiles of a half key are compared
    (``_meetings``); then the sets go there, each pair of tiles is one small group, and at most
    a forest of links leaves it."""
    named = tables.join(part.withColumnRenamed("node", "c"), "c", "left")
    seen = named.select("t", "c", F.coalesce("component", "c").alias("comp"))
    mixed = seen.groupBy("t").agg(F.count("*").alias("m"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    mixed = mixed.filter("m > 2 AND low <> high").select("t")
    open_ = common.written(seen.join(mixed, "t").select("c", "comp").distinct())
    # a little wider than the sizes that a link may join, so that rounding loses none
    band = F.floor(F.log("n") / float(np.log(100 / PERCENT) * 1.001)).cast("int").alias("band")
    each = open_.join(sets.select("c", "n", "halves"), "c")
    each = each.select("c", "comp", "n", band, F.posexplode(F.slice("halves", 1, SIDE)).alias("place", "key"))
    dealt = _meetings(each).join(sets.select("c", "n", "least", "items").hint("merge"), "c")
    dealt = dealt.select("pair", "i", "j", "place", "side", "c", "comp", "n", "least", "items")
    sorted_ = dealt.repartition("pair", "i", "j").sortWithinPartitions("pair", "i", "j")
    return sorted_.mapInArrow(_tile, "a long, b long")


def sketched(docs: DataFrame, *columns: str) -> DataFrame:
    """One row for each document, numbered (uid), with the given columns (row) and the sketch of
    its set, as a written table: the numbers stay."""
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    rows = docs.select(row)
    kind = rows.schema["row"].dataType
    schema = T.StructType([T.StructField("row", kind), *T.StructType.fromDDL(_SKETCH).fields])
    return common.written(rows.mapInArrow(_sketch, schema).withColumn("uid", F.monotonically_increasing_id()))


def near_duplicates(rows: DataFrame) -> DataFrame:
    """The class of each row of ``sketched``: uid, doc_id, n, and the smallest (doc_id, uid) that
    links reach (``first``).

    Rows with equal sets are one class from the start, so copies cost nothing more. Classes that
    share a table of the tensored banding are candidates; links are confirmed on whole sets. In
    each table every class is first compared with the smallest one. What that leaves in different
    components but in one table is compared in tiles, by minhashes and then by whole sets, until
    the components are joined, if the tiles hold different ones. So no candidate pair that could join two components is passed
    over, while a large group of near copies gives stars and forests, not all its pairs.

    Texts without words are linked with nothing. Null ids count as larger than all others.
    """
    rows = rows.withColumn("doc_id", F.col("row.doc_id").cast("long"))
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("uid"))
    digest = ["d1", "d2", "n"]
    full = rows.filter("n > 0")
    classes = full.groupBy(*digest).agg(F.min("uid").alias("c"), F.min(key).alias("first"))
    classes = common.written(classes)
    halves = full.select(F.col("uid").alias("c"), "halves").join(classes.select("c"), "c")
    tables = common.written(_tables(halves))
    hubs = tables.groupBy("t").agg(F.min("c").alias("a"), F.count("*").alias("m")).filter("m > 1").select("t", "a")
    stars = tables.join(hubs, "t").filter("c <> a").select("a", F.col("c").alias("b")).distinct()
    stars = common.written(stars)
    met = stars.select(F.col("a").alias("c")).unionAll(stars.select(F.col("b").alias("c"))).distinct()
    texts = full.select(F.col("uid").alias("c"), "n", "halves", F.col("row.text").cast("string").alias("text"))
    # the same plan at every size: met grows with the documents
    sets = common.written(texts.join(met.hint("merge"), "c").mapInArrow(_sets, _SETS))
    links = common.written(confirm(stars, sets))
    part = graph.components(links)
    more = common.written(_others(tables, part, sets))
    if not more.isEmpty():
        part = graph.components(links.unionAll(more))
    of_class = classes.join(part.withColumnRenamed("node", "c"), "c", "left").withColumn("component", F.coalesce("component", "c"))
    least = of_class.groupBy("component").agg(F.min("first").alias("first"))
    of_class = of_class.drop("first").join(least, "component").select(*digest, "first")
    out = rows.select("uid", "doc_id", *digest).join(of_class, digest, "left")
    return out.select("uid", "doc_id", "n", F.coalesce("first", key).alias("first"))


def dedup(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id (the smallest id its links
    reach) and kept (whether that is its own id; false for a null id). Repeated rows are one
    class, an empty table gives no rows, other columns are not read."""
    found = near_duplicates(sketched(docs, "doc_id", "text"))
    own = F.col("first")["doc_id"]
    kept = F.coalesce(F.col("doc_id") == own, F.lit(False))
    return found.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), kept.alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id, with the same
    columns; of repeated rows with that id, one."""
    rows = sketched(docs, *docs.columns)
    kept = near_duplicates(rows).filter(F.col("first")["uid"] == F.col("uid")).select("uid")
    return rows.join(kept, "uid", "left_semi").select("row.*")
