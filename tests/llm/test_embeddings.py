import numpy as np
import pyarrow as pa
import pytest

from shopstream.llm import embeddings as em
from shopstream.llm.queries import QUERIES
from tests.llm import tables

NAN, INF = float("nan"), float("inf")


def usable(vector):
    return bool(vector) and all(x is not None and np.isfinite(x) for x in vector) and any(vector)


def brute(rows, cosine=0.93):
    n = len(rows)
    root = list(range(n))
    links = [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    units = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if usable(v) else None for _, v, _ in rows]
    for a in range(n):
        for b in range(a):
            if units[a] is None or units[b] is None or rows[a][2] is None or rows[a][2] != rows[b][2] or len(units[a]) != len(units[b]):
                continue
            if units[a] @ units[b] >= cosine:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    groups = {}
    for k in range(n):
        groups.setdefault(find(k), []).append(rows[k][0])
    for k, (i, _, _) in enumerate(rows):
        ids = [x for x in groups[find(k)] if x is not None]
        first = min(ids) if ids else None
        yield i, links[k], first, i is not None and i == first


def frame(spark, rows):
    return spark.createDataFrame([(*r, 3, 4) for r in rows], "vec_id long, embedding array<double>, label int, c long, tile long")


def same(df, rows):
    assert tables.plain(df.select("vec_id", "n_links", "component_id", "kept")) == sorted(brute(rows), key=repr)


def test_query_matches_brute_force(spark, sf):
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    same(QUERIES["op9_embeddings"](spark, sf), rows)


def clustered(n, seed, width=24):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, width))
    out = []
    for k in range(n):
        vector = centres[draw.integers(12)] + draw.normal(size=width) * draw.choice([0.05, 0.25, 0.4])
        out.append((k, (vector * draw.uniform(0.1, 9)).tolist(), int(draw.integers(3))))
    return out


def test_many_tiles(spark):
    rows = clustered(220, 4) + [(1000 + k, [1.0] + [0.0] * 23, 1) for k in range(30)]
    same(em.near_vectors(frame(spark, rows), tile=24), rows)


def test_odd_vectors(spark):
    rows = [
        (1, None, 1),
        (2, [], 1),
        (3, [0.0, 0.0], 1),
        (4, [1.0, None], 1),
        (5, [NAN, 1.0], 1),
        (6, [INF, 1.0], 1),
        (7, [1.0, 0.0], None),
        (8, [1.0, 0.0], 1),
        (8, [1.0, 0.0], 1),
        (9, [5.0, -0.0], 1),
        (None, [2.0, 0.1], 1),
        (10, [1.0, 0.0], 2),
        (11, [1.0, 0.0, 0.0], 1),
        (None, [0.0, 1.0], 1),
        (12, [1e200, 1e200], 4),
        (13, [1e-200, 1e-200], 4),
    ]
    found = {r["vec_id"]: r for r in em.near_vectors(frame(spark, rows)).collect()}
    assert found[8]["n_links"] == 3 and found[9]["component_id"] == 8 and not found[9]["kept"]
    assert all(found[k]["n_links"] == 0 and found[k]["kept"] for k in (1, 2, 3, 4, 5, 6, 7, 10, 11))
    assert found[12]["n_links"] == found[13]["n_links"] == 1
    same(em.near_vectors(frame(spark, rows[:-2])), rows[:-2])
    only_bad = rows[:7]
    same(em.near_vectors(frame(spark, only_bad)), only_bad)
    assert em.near_vectors(frame(spark, rows).filter("false")).count() == 0


@pytest.mark.parametrize("cosine", [0.5, 0.93])
def test_bounds_lose_no_link(cosine):
    draw = np.random.default_rng(8)
    x, y = (draw.normal(size=(n, 40)) + 2 * draw.normal(size=(1, 40)) for n in (60, 70))
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    y[:9] = x[:9]
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    rows, columns, linked = em.links(x, y, axes, cosine)
    found = {(rows[a], columns[b]) for a, b in zip(*np.nonzero(linked), strict=True)}
    assert found == set(zip(*np.nonzero(x @ y.T >= cosine), strict=True)) and found


def test_tiles_keep_every_component():
    short = np.array([[0.5, -3.0], [np.float32(0.1), 1e-30]])
    for rows, size in ((short.astype(np.float32).astype(np.float64), 4), (np.array([[0.1, 1.0]]), 8), (np.array([[1e300, 1.0]]), 8)):
        data = em._packed(rows)
        assert len(data) == size * rows.size
        assert (em._unpacked(pa.py_buffer(data), *rows.shape) == rows).all()
