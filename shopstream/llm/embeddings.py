"""Near-duplicate vectors by PCA-ordered comparison of tiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.llm import common, graph

#: Cosine of a link; rows of a tile; leading dimensions by which whole tiles are compared; tiles
#: that one tile is compared with in a task; where a comparison of two tiles may stop.
COSINE, TILE, LEAD, BAND = 0.93, 2048, 8, 8
STOPS = (8, 16, 32)

#: Bins of the first coordinate, by which rows that may be alike come into the same tiles.
BINS = 1 << 14


def valid(vector: str = "vector") -> Column:
    """Whether a vector can be compared: not null, not zero, all components finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a list column, of length one, filled with zeros up to ``width``."""
    return _unit(_filled(column, width))


def _filled(column: pa.Array, width: int) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    out = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares of large components stay finite
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _packed(rows: np.ndarray) -> bytes:
    """The components in four bytes each where that loses nothing, else in eight."""
    with np.errstate(over="ignore"):
        short = rows.astype(np.float32)
    return (short if (short == rows).all() else rows).tobytes()


def _unpacked(data: pa.Buffer, n: int, width: int) -> np.ndarray:
    kind = np.float32 if data.size == 4 * n * width else np.float64
    return np.frombuffer(data, kind).reshape(n, width).astype(np.float64)


def basis(classes: DataFrame, width: int) -> np.ndarray:
    """The principal axes of all unit vectors, widest first. Tasks send sums of products, which
    are added up in Spark; the driver gets one matrix."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            unit = _rows(batch.column(0), width)
            total += unit.T @ unit
        cells = [pa.array(np.arange(width * width)), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(cells, names=["cell", "x"])

    cells = classes.select("vector").mapInArrow(sums, "cell long, x double").groupBy("cell").agg(F.sum("x").alias("x")).collect()
    matrix = np.zeros(width * width)
    for r in cells:
        matrix[r["cell"]] = r["x"]
    return np.linalg.eigh(matrix.reshape(width, width))[1][:, ::-1].copy()


def _placed(classes: DataFrame, axes, width: int) -> DataFrame:
    """The classes with their bin of the first coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("vector")
            first = _rows(batch.column(at), width) @ axes.value[:, 0]
            bins = np.clip(((first + 1) / 2 * BINS).astype(np.int32), 0, BINS - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bins)], names=[*batch.schema.names, "bin"])

    return classes.mapInArrow(run, T.StructType([*classes.schema.fields, T.StructField("bin", T.IntegerType())]))


def _dealt(placed: DataFrame, tile: int) -> DataFrame:
    """The classes with a tile: neighbouring bins of a group together, about ``tile`` rows, and
    the rows of a full bin split by a hash."""
    bins = placed.groupBy("group", "bin").agg(F.count("*").alias("n"))
    # one row for each bin of a group: at most BINS
    before = F.sum("n").over(_by_bin()) - F.col("n")
    bins = bins.select("group", "bin", F.floor(before / tile).alias("t"), F.ceil(F.col("n") / tile).alias("parts"))
    dealt = placed.join(bins, ["group", "bin"])
    split = F.pmod(F.xxhash64("c"), F.col("parts"))
    return dealt.withColumn("tile", F.xxhash64("group", "t", split)).drop("bin", "t", "parts")


def _by_bin():
    return Window.partitionBy("group").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)


def _tiles(dealt: DataFrame, axes, width: int) -> DataFrame:
    """One row for each tile: its classes and what bounds their products with others. Bounds are
    the smallest and largest leading coordinates and the largest norm of the rest."""

    def gather(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        vectors = _filled(rows["vector"].chunk(0), width)
        turned = _unit(vectors) @ axes.value
        lead, rest = turned[:, :LEAD], np.sqrt(np.maximum(0, 1 - (turned[:, :LEAD] ** 2).sum(axis=1)))
        kind = pa.list_(pa.float64())
        return pa.table(
            {
                "group": rows["group"][:1],
                "tile": rows["tile"][:1],
                "low": pa.array([lead.min(axis=0)], kind),
                "high": pa.array([lead.max(axis=0)], kind),
                "rest": pa.array([rest.max()]),
                "ids": pa.array([rows["c"].to_numpy().tobytes()], pa.binary()),
                "copies": pa.array([rows["m"].to_numpy().tobytes()], pa.binary()),
                "vectors": pa.array([_packed(vectors)], pa.binary()),
            }
        )

    schema = "group string, tile long, low array<double>, high array<double>, rest double, ids binary, copies binary, vectors binary"
    return dealt.select("group", "tile", "c", "m", "vector").groupBy("group", "tile").applyInArrow(gather, schema)


def _pairs(tiles: DataFrame, cosine: float, lead: int) -> DataFrame:
    """The pairs of tiles of a group in which the bounds allow a link, those of a tile in bands."""
    stats = tiles.select("group", "tile", "low", "high", "rest")
    left = stats.select("group", *[F.col(c).alias(f"l_{c}") for c in ("tile", "low", "high", "rest")])
    right = stats.select("group", *[F.col(c).alias(f"r_{c}") for c in ("tile", "low", "high", "rest")])
    bound = F.col("l_rest") * F.col("r_rest")
    for k in range(lead):
        edges = [F.col(f"l_{a}")[k] * F.col(f"r_{b}")[k] for a in ("low", "high") for b in ("low", "high")]
        bound = bound + F.greatest(*edges)
    both = left.join(right, "group").filter((F.col("l_tile") <= F.col("r_tile")) & (bound >= cosine - 1e-9))
    # the rows of a window are the tiles of one label
    place = F.row_number().over(Window.partitionBy("l_tile").orderBy("r_tile"))
    return both.select(F.col("l_tile").alias("one"), F.col("r_tile").alias("two"), F.floor((place - 1) / BAND).alias("band"))


def links(x: np.ndarray, y: np.ndarray, axes: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of x, rows of y, and whether each two link. Products are summed from the widest axis
    on; what the norms of the rest cannot bring up to ``cosine`` is left out, rows and columns
    that are out with everything are dropped, and it ends early when none are left. Those that
    are left are decided by the whole product."""
    rows, columns = np.arange(len(x)), np.arange(len(y))
    turned_x, turned_y = x @ axes, y @ axes
    sum_ = np.zeros((len(x), len(y)))
    done = 0
    for stop in (s for s in STOPS if s < x.shape[1]):
        sum_ += turned_x[rows, done:stop] @ turned_y[columns, done:stop].T
        rest_x = np.sqrt((turned_x[rows, stop:] ** 2).sum(axis=1))
        rest_y = np.sqrt((turned_y[columns, stop:] ** 2).sum(axis=1))
        able = sum_ + rest_x[:, None] * rest_y[None, :] >= cosine - 1e-9
        keep_rows, keep_columns = able.any(axis=1), able.any(axis=0)
        rows, columns, done = rows[keep_rows], columns[keep_columns], stop
        sum_ = sum_[np.ix_(keep_rows, keep_columns)]
        if not len(rows):
            break
    return rows, columns, x[rows] @ y[columns].T >= cosine


def _forest(a: np.ndarray, b: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most one edge for each node that joins the same nodes as all links do."""
    names = np.concatenate([a, b])
    label_a, label_b = a.copy(), b.copy()
    top = np.iinfo(np.int64).max
    while True:
        new_a = np.minimum(label_a, np.where(linked, label_b[None, :], top).min(axis=1))
        new_b = np.minimum(label_b, np.where(linked, new_a[:, None], top).min(axis=0))
        if (new_a == label_a).all() and (new_b == label_b).all():
            return names, np.concatenate([label_a, label_b])
        label_a, label_b = new_a, new_b


def _two_tiles(one: tuple, two: tuple, axes: np.ndarray, cosine: float) -> pa.Table:
    """What two tiles (number, classes, their copies, unit vectors) give to ``_compared``."""
    (tile, a, ma, x), (other_tile, b, mb, y) = one, two
    rows, columns, linked = links(x, y, axes, cosine)
    own = tile == other_tile
    if own:
        linked = linked & (a[rows][:, None] != b[columns][None, :])
    out = [(a[rows], np.full(len(rows), -1), linked @ mb[columns])]
    if not own:
        out.append((b[columns], np.full(len(columns), -1), linked.T @ ma[rows]))
    nodes, roots = _forest(a[rows], b[columns], linked) if linked.any() else (a[:0], a[:0])
    keep = nodes != roots
    out.append((nodes[keep], roots[keep], np.zeros(keep.sum(), np.int64)))
    c, other, n = (np.concatenate(v).astype(np.int64) for v in zip(*out, strict=True))
    some = (n > 0) | (other >= 0)
    return pa.table({"c": c[some], "other": other[some], "n": n[some]})


def _compared(tiles: DataFrame, pairs: DataFrame, axes, cosine: float, width: int) -> DataFrame:
    """For each pair of tiles the weighted number of links of each class (n), and edges (other)
    that join what is linked: never more rows than the tiles have, however many links."""

    def tile_of(rows: pa.Table, which: str, k: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        ids, copies = (np.frombuffer(rows[f"{which}_{name}"][k].as_buffer(), np.int64) for name in ("ids", "copies"))
        vectors = _unpacked(rows[f"{which}_vectors"][k].as_buffer(), len(ids), width)
        return rows[f"{which}_tile"][k].as_py(), ids, copies, _unit(vectors)

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table({name: pa.array([], pa.int64()) for name in ("c", "other", "n")})
        one = tile_of(left, "one", 0)
        return pa.concat_tables([none, *(_two_tiles(one, tile_of(right, "two", k), axes.value, cosine) for k in range(right.num_rows))])

    def side(of: DataFrame, which: str) -> DataFrame:
        own = of.withColumn("tile", F.col(which)).join(tiles.select("tile", "ids", "copies", "vectors"), "tile")
        own = own.select(*[F.col(c).alias(f"{which}_{c}") for c in ("one", "band", "tile", "ids", "copies", "vectors")])
        return own.groupBy(f"{which}_one", f"{which}_band")

    both = side(pairs.select("one", "band").distinct(), "one").cogroup(side(pairs, "two"))
    return both.applyInArrow(compare, "c long, other long, n long")


def near_vectors(rows: DataFrame, cosine: float = COSINE, tile: int = TILE) -> DataFrame:
    """One row for each vector: vec_id, n_links (other vectors of the same label with a cosine of
    at least ``cosine``), component_id (the smallest vec_id that links reach) and kept (whether
    that is its own).

    Equal vectors of a label are one class and cost nothing more. The classes of a label lie in
    tiles along the widest axis; pairs of tiles whose bounds allow a link are compared, a tile with
    at most eight others in a task, so a label that holds most rows is many small groups. A pair of tiles gives
    counts and a forest, not its links. Rows with a null label, and vectors that are null, empty,
    zero or hold null or non-finite components, are linked with nothing; so are vectors of
    different lengths. Null ids count as larger than others; other columns are not read.
    """
    found = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    found = common.written(found.withColumn("uid", F.monotonically_increasing_id()))
    key = F.struct(F.col("vec_id").isNull().alias("none"), "vec_id", "uid")
    usable = found.filter(F.col("label").isNotNull() & valid())
    group = F.concat_ws(":", F.size("vector").cast("string"), "label")
    classes = usable.groupBy(group.alias("group"), "vector").agg(F.min("uid").alias("c"), F.min(key).alias("first"), F.count("*").alias("m"))
    classes = common.written(classes)
    width = classes.agg(F.max(F.size("vector"))).first()[0]
    out = found.withColumn("first", key)
    if width is None:
        return _named(out.withColumn("n_links", F.lit(0).cast("long")))
    axes = found.sparkSession.sparkContext.broadcast(basis(classes, width))
    dealt = _dealt(_placed(classes.select("group", "c", "m", "vector"), axes, width), tile)
    tiles = common.written(_tiles(dealt, axes, width))
    pairs = common.written(_pairs(tiles, cosine, min(LEAD, width)))
    compared = common.written(_compared(tiles, pairs, axes, cosine, width))
    counts = compared.filter("other < 0").groupBy("c").agg(F.sum("n").alias("n"))
    part = graph.components(compared.filter("other >= 0").select(F.col("c").alias("a"), F.col("other").alias("b")))
    named = classes.select("group", "vector", "c", "first", "m").join(counts, "c", "left")
    named = named.join(part.withColumnRenamed("node", "c"), "c", "left").withColumn("component", F.coalesce("component", "c"))
    least = named.groupBy("component").agg(F.min("first").alias("smallest"))
    of_class = named.join(least, "component").select(
        "group", "vector", F.col("smallest").alias("first"), (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links")
    )
    linked = usable.select("uid", "vec_id", group.alias("group"), "vector").join(of_class, ["group", "vector"])
    alone = out.filter(~(F.col("label").isNotNull() & valid())).withColumn("n_links", F.lit(0).cast("long"))
    columns = ["uid", "vec_id", "first", "n_links"]
    return _named(linked.select(*columns).unionAll(alone.select(*columns)))


def _named(rows: DataFrame) -> DataFrame:
    own = F.col("first")["vec_id"]
    kept = F.coalesce(F.col("vec_id") == own, F.lit(False))
    return rows.select("vec_id", "n_links", own.alias("component_id"), kept.alias("kept"))
