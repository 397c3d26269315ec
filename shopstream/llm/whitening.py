"""Whitened vectors by a bidiagonal qd solver.

Blockwise QR reduces the centred rows to one small triangle, Householder reflections make it
bidiagonal, dqds sweeps find its singular values, and twisted factorisations their directions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Whole numbers are taken of 64ths, moved up by a million; directions that are returned.
SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32

#: Entries of this size and more have no whole number that sums exactly; they count as not finite.
LARGEST = float(1 << 40)

#: Rows that one factorisation takes at a time; groups of a round that merges triangles.
BLOCK, ROUNDS = 2048, (64, 8)

EPS = float(np.finfo(float).eps)


@dataclass
class Whitening:
    """What was fitted: rows, sums of the whole numbers, unit directions as columns, their
    eigenvalues in falling order, the trace of the covariance, and the error of the result."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0


def usable(vector: str) -> Column:
    """Whether all entries are there and finite."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce((F.abs(x) < LARGEST) & ~F.isnan(x), F.lit(False))), F.lit(False))


def whole(column: pa.Array, width: int) -> np.ndarray:
    """The entries as whole numbers, a row for each vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * flat).astype(np.int64).reshape(-1, width) + SHIFT


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact: in Python's own whole numbers where 64 bits do not hold it."""
    if n * int(np.abs(x).max(initial=0)) + max((abs(int(s)) for s in sums), default=0) < 1 << 62:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """The distances from the mean, rounded once."""
    return deviations(x, n, sums).astype(np.float64) / n


def squares(away: np.ndarray) -> list[int | None]:
    """The sums of squares, exact; None where a row's does not fit into 64 bits."""
    if away.dtype != object and len(away) and int(np.abs(away).max()) ** 2 * away.shape[1] < 1 << 62:
        return (away * away).sum(axis=1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in away]
    return [v if v < 1 << 63 else None for v in exact]


# The fit list: sums and the triangle.


def _summed(rows: DataFrame, cells, count: int) -> list:
    """Adds up ``count`` numbers a task, by place."""
    out = [0] * count
    for r in rows.mapInArrow(cells, "cell long, x decimal(38,0)").groupBy("cell").agg(F.sum("x").alias("x")).collect():
        out[r["cell"]] = int(r["x"])
    return out


def sums_of(rows: DataFrame, width: int) -> np.ndarray:
    """The sum of each dimension. A task sends one number a dimension."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for batch in batches:
            x = whole(batch.column(0), width)
            high, low = x >> 24, x & 0xFFFFFF  # no block overflows
            total = [t + (int(h) << 24) + int(s) for t, h, s in zip(total, high.sum(axis=0), low.sum(axis=0), strict=True)]
        numbers = pa.array([str(t) for t in total]).cast(pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), numbers], names=["cell", "x"])

    return np.array(_summed(rows, cells, width), object)


def merge(triangle: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The triangle of both together: its product with itself is the sum of theirs."""
    return np.linalg.qr(np.vstack([triangle, rows]), mode="r")


def _triangles(kept: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kept.tobytes()], pa.binary())], names=["r"])


def triangle_of(rows: DataFrame, n: int, sums: np.ndarray, width: int) -> np.ndarray:
    """The triangle R of a QR factorisation of all centred rows. Tasks factorise their rows block
    by block, and rounds of fewer and fewer tasks merge what those return."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros((0, width))
        for batch in batches:
            x = whole(batch.column(0), width)
            for first in range(0, len(x), BLOCK):
                kept = merge(kept, centred(x[first : first + BLOCK], n, sums))
        yield _triangles(kept)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros((0, width))
        for batch in batches:
            for buffer in batch.column(0).to_pylist():
                kept = merge(kept, np.frombuffer(buffer).reshape(-1, width))
        yield _triangles(kept)

    parts = rows.mapInArrow(reduce, "r binary")
    for groups in ROUNDS:
        slot = F.pmod(F.spark_partition_id(), F.lit(groups)).alias("slot")
        parts = parts.select("r", slot).repartition(groups, "slot").select("r").mapInArrow(again, "r binary")
    kept = np.zeros((width, width))
    for row in parts.collect():  # one small triangle for each task of the last round
        kept = merge(kept, np.frombuffer(row["r"]).reshape(-1, width))
    return kept


# The bidiagonal problem, of the size of one vector.


def bidiagonal(triangle: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, upper diagonal, V): the triangle is U B V' with orthogonal U and V."""
    a, width = triangle.copy(), len(triangle)
    turned = np.eye(width)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        """The unit vector of the reflection that leaves x only its first entry."""
        size = np.abs(x).max(initial=0.0)
        if size == 0 or not np.abs(x[1:]).any():
            return None
        v = x / size
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        return v / np.linalg.norm(v)

    for k in range(width):
        v = reflector(a[k:, k].copy())
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k + 1 < width:
            v = reflector(a[k, k + 1 :].copy())
            if v is not None:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
                turned[:, k + 1 :] -= 2 * np.outer(turned[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), turned


def sweep(q: list[float], e: list[float], tau: float) -> tuple[list[float], list[float], float, float] | None:
    """One dqds transform by a shift: the new arrays, the smallest pivot, and a bound below the
    smallest eigenvalue that is left. None if the shift was above it."""
    n = len(q)
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - tau
    least, inverse = d, 0.0
    for k in range(n - 1):
        if d < 0:
            return None
        inverse += 1 / d if d else float("inf")
        new_q[k] = d + e[k]
        if new_q[k] == 0:
            t = 0.0 if q[k + 1] == 0 else float("inf")
            if t:  # a zero row: what is below starts anew
                new_e[k], d = 0.0, q[k + 1] - tau
                least = min(least, d)
                continue
        else:
            t = q[k + 1] / new_q[k]
        new_e[k] = e[k] * t
        d = d * t - tau
        least = min(least, d)
    if d < 0:
        return None
    inverse += 1 / d if d else float("inf")
    new_q[n - 1] = d
    return new_q, new_e, least, 1 / inverse if inverse else 0.0


def qd_values(q: list[float], e: list[float]) -> list[float]:
    """The eigenvalues of B'B from the squares of B's diagonals, by dqds: shifts stay below the
    smallest eigenvalue, so all numbers stay positive and small values keep their digits."""
    found: list[float] = []
    blocks = [(list(q), list(e), 0.0)]
    while blocks:
        q, e, shifted = blocks.pop()
        bound = guess = 0.0
        for _ in range(100 * (len(q) + 1)):
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= EPS * EPS * (shifted + min(q[k], q[k + 1])) or e[k] == 0), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], shifted))
                q, e = q[cut + 1 :], e[cut + 1 :]
                bound = guess = 0.0
            if len(q) == 1:
                break
            turned = len(q) > 2 and q[0] < q[-1] / 4
            if turned:  # the small end goes down, where it leaves first
                q, e = _reversed(q, e)
            done = sweep(q, e, guess) if guess > bound else None
            tau = guess
            while done is None:
                tau, bound = bound, bound / 4 if bound > 1e-300 else 0.0
                done = sweep(q, e, tau)
                if done is None and tau == 0:
                    raise ArithmeticError("a transform without a shift failed")
            q, e, least, bound = done
            shifted += tau
            bound *= 1 - 4 * EPS * len(q)
            guess = least * 0.98 if least == q[-1] else 0.0
        else:
            raise ArithmeticError("the sweeps did not settle")
        found.append(shifted + q[0])
    return sorted(found, reverse=True)


def _reversed(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The arrays of the same matrix from its other end."""
    return q[::-1], e[::-1]


def twisted(d: np.ndarray, low: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The factorisations of L D L' - value from the top and from the bottom: the multipliers of
    both, and the pivots that remain where they meet."""
    n = len(d)
    tiny = np.finfo(float).tiny
    down, up, s, p = np.zeros(n - 1), np.zeros(n - 1), np.zeros(n), np.zeros(n)
    s[0] = -value
    for k in range(n - 1):
        pivot = d[k] + s[k]
        pivot = pivot if abs(pivot) > tiny else tiny
        down[k] = d[k] * low[k] / pivot
        s[k + 1] = down[k] * low[k] * s[k] - value
    p[-1] = d[-1] - value
    for k in range(n - 2, -1, -1):
        pivot = d[k] * low[k] ** 2 + p[k + 1]
        pivot = pivot if abs(pivot) > tiny else tiny
        t = d[k] / pivot
        up[k] = low[k] * t
        p[k] = p[k + 1] * t - value
    return down, up, s + p + value


def twisted_vector(d: np.ndarray, low: np.ndarray, value: float, taken: list[np.ndarray]) -> np.ndarray:
    """The unit eigenvector of L D L' at a value, from the twist with the smallest pivot. Vectors of
    neighbouring values are taken out of it; where nothing is left, the next twist is tried."""
    down, up, meet = twisted(d, low, value)
    n = len(d)
    best = np.zeros(n)
    for twist in np.argsort(np.abs(meet), kind="stable"):
        z = np.zeros(n)
        z[twist] = 1.0
        for k in range(twist - 1, -1, -1):
            z[k] = -down[k] * z[k + 1]
        for k in range(twist, n - 1):
            z[k + 1] = -up[k] * z[k]
        size = np.abs(z).max()
        z = z / size / np.linalg.norm(z / size)
        left = z
        for _ in range(2):
            for other in taken:
                left = left - (other @ left) * other
        if np.linalg.norm(left) > 0.1 or not taken:
            return left / np.linalg.norm(left)
        if np.linalg.norm(left) > np.linalg.norm(best):
            best = left
    return best / np.linalg.norm(best)


def directions(triangle: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The first right singular vectors of the triangle, as columns, and the squares of their
    singular values, in falling order; as many as the triangle has rank."""
    size = np.abs(triangle).max(initial=0.0)
    width = len(triangle)
    if size == 0:
        return np.zeros((width, 0)), np.zeros(0)
    diagonal, upper, turned = bidiagonal(triangle / size)
    squares_, sides = diagonal**2, upper**2
    values = np.array(qd_values(squares_.tolist(), sides.tolist()))
    values = values[values > (8 * width * EPS) ** 2 * values[0]][:wanted]
    # blocks that a zero separates have their own vectors
    cuts = [0, *(k + 1 for k in range(width - 1) if abs(upper[k]) <= EPS * EPS * (abs(diagonal[k]) + abs(diagonal[k + 1]))), width]
    found, near = [], []
    for value in values:
        near = [(v, z) for v, z in near if v - value <= 1e-3 * v]
        best = None
        for first, last in zip(cuts, cuts[1:], strict=False):
            z = _block_vector(diagonal[first:last], upper[first : last - 1], value, [x[first:last] for _, x in near if np.abs(x[first:last]).any()])
            if z is None:
                continue
            whole_z = np.zeros(width)
            whole_z[first:last] = z
            b = diagonal * whole_z + np.append(upper * whole_z[1:], 0)
            miss = np.linalg.norm(diagonal * b + np.append(0, upper * b[:-1]) - value * whole_z)
            overlap = max((abs(x @ whole_z) for _, x in near), default=0.0)
            if best is None or miss + overlap < best[0]:
                best = (miss + overlap, whole_z)
        near.append((value, best[1]))
        found.append(turned @ best[1])
    return np.array(found).reshape(-1, width).T, values * size * size


def _block_vector(diagonal: np.ndarray, upper: np.ndarray, value: float, taken: list[np.ndarray]) -> np.ndarray | None:
    if len(diagonal) == 1:
        return None if taken else np.ones(1)
    if not diagonal[:-1].all():
        # no L D L' from this end: the smallest change that gives one is below rounding
        diagonal = np.where(diagonal == 0, EPS * EPS * max(np.abs(diagonal).max(), np.abs(upper).max()), diagonal)
    return twisted_vector(diagonal**2, upper / diagonal[:-1], value, taken)


# The operator.


def _projected(x: np.ndarray, fit: Whitening) -> np.ndarray:
    return centred(x, fit.n, fit.sums) @ fit.directions / np.sqrt(fit.values)


def identity_error(rows: DataFrame, fit: Whitening, width: int) -> float:
    """How far the covariance of the whitened rows is from the identity, over all rows."""
    count = len(fit.values)
    shared = rows.sparkSession.sparkContext.broadcast(fit)  # of the size of a few vectors

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums = np.zeros((count, count)), np.zeros(count)
        for batch in batches:
            y = _projected(whole(batch.column(0), width), shared.value)
            products += y.T @ y
            sums += y.sum(axis=0)
        values = np.concatenate([products.ravel(), sums])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["cell", "x"])

    total = np.zeros(count * count + count)
    for r in rows.mapInArrow(cells, "cell long, x double").groupBy("cell").agg(F.sum("x").alias("x")).collect():
        total[r["cell"]] = r["x"]
    # the rows are centred before, so what is left of their mean is rounding alone
    mean = total[count * count :] / fit.n
    covariance = total[: count * count].reshape(count, count) / fit.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(count)).max(initial=0.0))


def usual_width(vectors: DataFrame, vector: str) -> tuple[int, int]:
    """(length, rows) of the usable vectors of the most frequent length; of equals, the longest."""
    sizes = vectors.filter(usable(vector)).groupBy(F.size(vector).alias("width")).agg(F.count("*").alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("width")).first()
    return (first["width"], first["n"]) if first else (0, 0)


def kept_rows(vectors: DataFrame, width: int, vector: str) -> DataFrame:
    return vectors.filter(usable(vector) & (F.size(vector) == width))


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable vectors; None where there is none, or none with entries."""
    width, n = usual_width(vectors, vector)
    if not width:
        return None
    rows = kept_rows(vectors, width, vector).select(vector)
    sums = sums_of(rows, width)
    triangle = triangle_of(rows, n, sums, width)
    found, values = directions(triangle, components)
    fitted = Whitening(n, sums, found, values / n, float((triangle**2).sum()) / n)
    fitted.identity_error = identity_error(rows, fitted, width)
    return fitted


def whiten(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """All columns of the usable rows but the vector, and n, deviation (the exact sum of squares of
    n * x - S; NULL beyond 64 bits), whitened (an array, widest direction first), explained (the
    share of each direction) and identity_error.

    Rows whose vector is NULL, or has an entry that is NULL, not finite or of 2 ** 40 and more, are
    left out, and so are vectors of another length than the most frequent (of equals, the longest)
    and those without entries. Repeated rows all count. Directions beyond the rank are left
    out, so a table of equal vectors, or of one, has empty arrays. An empty table gives an empty one.
    Columns named like a result are replaced.
    """
    out = ["n", "deviation", "whitened", "explained", "identity_error"]
    kept = [c for c in vectors.columns if c not in (vector, *out)]
    schema = T.StructType(
        [vectors.schema[c] for c in kept]
        + T.StructType.fromDDL("n long, deviation long, whitened array<double>, explained array<double>, identity_error double").fields
    )
    fitted = fit(vectors, vector, components)
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema)
    width = len(fitted.sums)
    shared = vectors.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        count = len(fitted.values)
        share = (fitted.values / fitted.trace if fitted.trace else fitted.values).tolist()
        for batch in batches:
            rows = batch.num_rows
            x = whole(batch.column(batch.num_columns - 1), width)
            offsets = pa.array(np.arange(rows + 1) * count, pa.int32())
            columns = [
                *batch.columns[:-1],
                pa.array([fitted.n] * rows, pa.int64()),
                pa.array(squares(deviations(x, fitted.n, fitted.sums)), pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(_projected(x, fitted).ravel())),
                pa.ListArray.from_arrays(offsets, pa.array(share * rows, pa.float64())),
                pa.array([fitted.identity_error] * rows, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kept_rows(vectors, width, vector).select(*kept, vector).mapInArrow(run, schema)


def by_component(whitened: DataFrame, key: str = "vec_id") -> DataFrame:
    """One row for each vector and direction."""
    parts = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "part")
    rows = whitened.select(key, "n", "deviation", "identity_error", parts)
    component = (F.col("place") + 1).cast("int").alias("component")
    return rows.select(key, component, "n", "deviation", F.col("part.whitened").alias("whitened"), F.col("part.explained").alias("explained"), "identity_error")
