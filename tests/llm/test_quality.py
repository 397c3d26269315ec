import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopstream.llm import quality
from shopstream.llm.queries import QUERIES
from tests.llm import tables


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"  # enough labels to learn from
    rows = {r["doc_id"]: r for r in QUERIES["op4_quality"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(rows) == docs.count()
    assert all(r["held_out"] == held(i) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for i, r in rows.items())
    known = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    judged = [(rows[i]["predicted"], q) for i, q in known.items() if rows[i]["held_out"]]
    assert len(judged) > 50
    assert np.mean([p == q for p, q in judged]) > 0.95
    bad = [p for p, q in judged if q == 0]
    assert np.mean(bad) < 0.3


def test_sample_is_bounded_and_not_held_out(spark):
    docs = tables.documents(spark, [(k, f"text {k}") for k in range(200)] + [(300, "x" * 9000), (None, "y"), (5, "again")])
    labels = [(k, k % 2, 0) for k in range(200)] + [(300, 1, 0), (6, 1, 0), (None, 1, 0), (9, None, 0), (11, 2, 0), (7, 1, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = quality.sample(docs, labels, rows=30).collect()
    assert not [r for r in found if held(r["doc_id"]) or r["doc_id"] in (6, 300)]
    assert {k: sum(r["label"] == k for r in found) for k in (0, 1)} == {0: 30, 1: 30}


@pytest.fixture(scope="module")
def net():
    draw = np.random.default_rng(3)
    good = ["".join(draw.choice(list("abcdefgh "), 80)) for _ in range(120)]
    bad = ["".join(draw.choice(list("ABCDEFGH!"), 80)) for _ in range(120)]
    labels = np.array([1.0] * 120 + [0.0] * 120, np.float32)
    return quality.train([t.encode() for t in good + bad], labels, np.ones(240, np.float32), epochs=6)


def scores(net, texts):
    import pyarrow as pa

    from shopstream.llm import common

    return quality.score(net, *common.utf8(pa.array(texts, pa.large_string())))


def test_scores_cover_whole_texts(net):
    clean, dirty = "abc def gh " * 2000, "ABC!DEF!GH" * 4
    alone, both, empty = scores(net, [clean, clean + dirty, ""])
    assert alone > 0.5 > both and 0 <= empty <= 1
    assert scores(net, [clean, "", clean + dirty, clean])[2] == pytest.approx(both, abs=1e-5)  # neighbours do not matter
    assert np.isfinite(scores(net, ["x", "\x00", "é" * 7, "a" * 31, "a" * 32, "a" * 33, "a" * 100_000])).all()


def test_chunks_cover_every_byte():
    for n in (0, 1, 15, 16, 17, 31, 32, 33, 47, 48, 49, 100):
        data = np.arange(1, n + 1, dtype=np.uint8)
        made, shares, offsets = quality.chunks(data, np.array([0, n, n]))
        assert len(made) == offsets[-1] and offsets[2] - offsets[1] == 1
        assert set(range(1, n + 1)) == set(made[: offsets[1]].ravel().tolist()) - {0}
        assert shares.shape == (len(made), len(quality.LAGS) + 1)


def test_repeats_show_in_the_shares():
    data = np.frombuffer(b"abcdefg " * 20, np.uint8)
    _, shares, _ = quality.chunks(data, np.array([0, len(data)]))
    assert shares[2:-2, 8 - quality.LAGS[0]].min() == 1 and shares[2:-2, -1].min() == 1


def test_odd_documents(spark, net):
    docs = tables.documents(spark, tables.odd())
    found = quality.scored(docs, net)
    assert found.columns == [c for c in docs.columns if c != "score"] + ["score"]
    rows = found.collect()
    assert len(rows) == len(tables.odd()) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1  # null scores as empty
    assert quality.scored(tables.empty(spark, tables.DOCS), net).count() == 0
    nothing = tables.empty(spark, "doc_id long, quality int, toxic int")
    assert quality.learn(docs, nothing) is None
    assert {r["score"] for r in quality.scored(docs, None).collect()} == {0.5}
    kept = quality.good_documents(docs, nothing)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_labels_and_ids_are_no_inputs(spark, net):
    docs = tables.documents(spark, tables.odd())
    other = docs.withColumn("doc_id", F.lit(77).cast("long")).withColumn("lang", F.lit("zz")).withColumn("source", F.lit("q"))
    one, two = (sorted(r["score"] for r in quality.scored(d, net).collect()) for d in (docs, other))
    assert one == two


def plain_score(net, text):
    """One text, chunk by chunk and filter by filter, in plain loops."""
    chunk, stride = quality.CHUNK, quality.STRIDE
    best = [-np.inf] * net.filters.shape[1]
    start = 0
    while True:
        shares = []
        for lag in quality.LAGS:
            halves = []
            for a in (start, start + stride):
                same = [i for i in range(a, a + stride) if lag <= i < len(text) and text[i] and text[i] == text[i - lag]]
                halves.append(len(same) / stride)
            shares.append(sum(halves) / 2)
        x = []
        for i in range(start, start + chunk):
            x.extend(net.bytes_[text[i] if i < len(text) else 0])
        x += [*shares, max(shares)]
        for f in range(len(best)):
            best[f] = max(best[f], float(np.dot(np.array(x, np.float64), net.filters[:, f])))
        start += stride
        if start + chunk - stride >= len(text):
            break
    z = net.out_bias + sum(float(net.out[f]) * np.tanh(best[f] + float(net.bias[f])) for f in range(len(best)))
    return 1 / (1 + np.exp(-z))


def test_scores_equal_plain_loops_whatever_stands_beside():
    rng = np.random.default_rng(3)
    width = quality.CHUNK * quality.WIDTH + len(quality.LAGS) + 1
    net = quality.Network(
        rng.normal(size=(256, quality.WIDTH)).astype(np.float32), rng.normal(0, 0.3, (width, quality.FILTERS)).astype(np.float32),
        rng.normal(size=quality.FILTERS).astype(np.float32), rng.normal(size=quality.FILTERS).astype(np.float32), 0.1,
    )
    net.bytes_[0] = 0
    texts = [b"", b"a", b"ab" * 40, b"x" * 33, b"x" * 48, b"x" * 47, "é日本 words and words and words".encode() * 5, bytes(rng.integers(97, 100, 200).astype(np.uint8)), b"", b"abc" * 9]

    def scored(rows):
        return quality.score(net, np.frombuffer(b"".join(rows), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in rows])]).astype(np.int64))

    together = scored(texts)
    for text, found in zip(texts, together, strict=True):
        assert found == pytest.approx(plain_score(net, text), abs=1e-4), text[:9]
        assert found == pytest.approx(scored([text])[0], abs=3e-6)
