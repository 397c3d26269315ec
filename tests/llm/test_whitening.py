import math

import numpy as np
import pytest

from shopstream.llm import whitening as w
from shopstream.llm.queries import QUERIES
from tests.llm import tables

NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, n long, whitened string")


def whole(rows):
    good = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    return [i for i, _ in good], [[math.floor(64 * x) + 1_000_000 for x in v] for _, v in good]


def check(df, rows, rank):
    """The contract's definitions in plain Python and numpy's symmetric solver."""
    ids, x = whole(rows)
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    exact = sorted((i, sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))) for i, v in zip(ids, x, strict=True))
    found = df.collect()
    assert sorted({(r["vec_id"], r["deviation"]) for r in found}) == sorted(set(exact))
    assert {r["component"] for r in found} == set(range(1, rank + 1)) and {r["n"] for r in found} == {n}
    away = np.array([[n * a - s for a, s in zip(v, sums, strict=True)] for v in x], float) / n
    values = np.linalg.eigvalsh(away.T @ away / n)[::-1]
    explained = {r["component"]: r["explained"] for r in found}
    for k in range(rank):
        assert explained[k + 1] == pytest.approx(values[k] / values.sum(), rel=1e-9)
    columns = np.zeros((n, rank))
    seen = {}
    for r in sorted(found, key=lambda r: (r["component"], r["vec_id"])):
        place = seen.setdefault((r["component"], "next"), 0)
        columns[place, r["component"] - 1] = r["whitened"]
        seen[(r["component"], "next")] = place + 1
    error = np.abs(columns.T @ columns / n - np.eye(rank)).max()
    assert error < 1e-9 and found[0]["identity_error"] < 1e-9
    # the covariance with the data gives the directions back: V z = e z, up to the sign
    ordered = away[np.argsort(ids, kind="stable")]
    for k in range(rank):
        z = ordered.T @ columns[:, k] / n / math.sqrt(values[k])
        assert np.linalg.norm(z) == pytest.approx(1, abs=1e-9)
        assert np.allclose(away.T @ (away @ z) / n, values[k] * z, atol=1e-9 * values[0])


def test_query_follows_the_definitions(spark, sf):
    rows = [(r["vec_id"], None if r["embedding"] is None else list(r["embedding"])) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(QUERIES["op11_whitening"](spark, sf), rows, 32)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=5).tolist()) for k in range(40)] + [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [NAN] * 5), (103, [INF] + [0.0] * 4)]
    rows += [(1, rows[1][1]), (2, [0.0] * 5)]
    check(w.by_component(w.whiten(frame(spark, rows))), rows, 5)
    assert w.whiten(frame(spark, rows + [(104, []), (105, [1.0])])).count() == 42


def test_too_few_rows_and_equal_rows(spark):
    assert w.whiten(frame(spark, [])).count() == 0
    assert w.whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    for rows in ([(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5):
        found = w.whiten(frame(spark, rows)).collect()
        assert [(r["deviation"], r["whitened"]) for r in found] == [(0, [])] * len(rows)
    check(w.by_component(w.whiten(frame(spark, [(1, [0.0, 1.0, 5.0]), (2, [1.0, 1.0, 5.0]), (3, [0.0, 3.0, 5.0])]))), [(1, [0.0, 1.0, 5.0]), (2, [1.0, 1.0, 5.0]), (3, [0.0, 3.0, 5.0])], 2)


def test_numbers_beyond_64_bits():
    x = np.array([[1 << 40, -(1 << 40)], [0, 5]])
    sums = np.array([int(c) for c in x.sum(axis=0)], object)
    away = w.deviations(x, 1 << 30, sums)
    assert [int(v) for v in away[0]] == [(1 << 70) - (1 << 40), -(1 << 70) + (1 << 40) - 5]
    assert w.squares(away)[0] is None and w.squares(w.deviations(x[1:], 2, sums))[0] is None
    assert w.squares(np.array([[3, 4]])) == [25]


@pytest.mark.parametrize("seed", range(40))
def test_solver_equals_the_dense_one(seed):
    """Small whole numbers: repeated values, zero rows and rank loss come up often."""
    rng = np.random.default_rng(seed)
    width, n = int(rng.integers(1, 12)), int(rng.integers(1, 30))
    rows = rng.integers(-2, 3, size=(n, width)).astype(float)
    rows -= rows.mean(axis=0)
    z, values = w.directions(w.merge(np.zeros((width, width)), rows), 32)
    dense = np.linalg.svd(rows, compute_uv=False) ** 2
    assert len(values) == np.linalg.matrix_rank(rows)
    assert np.allclose(values, dense[: len(values)], rtol=1e-11, atol=0)
    assert np.abs(z.T @ z - np.eye(len(values))).max(initial=0) < 1e-10
    assert np.abs(rows.T @ (rows @ z) - z * values).max(initial=0) < 1e-10 * max(1, values.max(initial=0))


def test_small_values_keep_their_digits():
    """A graded bidiagonal matrix: dqds has small values right relative to themselves."""
    q, e = [4.0 ** -k for k in range(30)], [4.0 ** -(k + 2) for k in range(29)]
    found = w.qd_values(q, e)
    product = 1.0
    for v in found:
        product *= v
    assert product == pytest.approx(math.prod(q), rel=1e-11)
    assert sum(found) == pytest.approx(sum(q) + sum(e), rel=1e-13)
    assert sum(1 / v for v in found[::-1]) > 1 / q[-1]
