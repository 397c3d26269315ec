import random
import re

import pytest

from shopstream.llm import graph, neardup
from shopstream.llm.queries import QUERIES
from tests.llm import tables

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def shingles(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(w) < 3:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[k : k + 3]) for k in range(len(w) - 2))


def brute(docs):
    """doc_id, n_shingles, component_id and kept from all pairs."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    root[find(a)] = find(b)
    groups = {}
    for k, (i, _) in enumerate(docs):
        groups.setdefault(find(k), []).append(i)
    for k, (i, _) in enumerate(docs):
        ids = [x for x in groups[find(k)] if x is not None]
        first = min(ids) if ids else None
        yield i, len(sets[k]), first, i is not None and i == first


def test_query_matches_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert tables.plain(QUERIES["op7_near_duplicates"](spark, sf)) == sorted(brute(docs), key=repr)


@pytest.fixture(scope="module")
def family():
    """Copies of one text with a growing number of changed words: a chain, a star and strays."""
    draw = random.Random(5)
    base = [f"w{draw.randrange(400)}" for _ in range(120)]
    rows = []
    for k in range(160):
        words = list(base)
        for _ in range(k % 9):
            words[draw.randrange(len(words))] = f"n{draw.randrange(10**6)}"
        rows.append((1000 - k, " ".join(words)))
    return rows


def test_large_family_in_tiles(spark, family, monkeypatch):
    monkeypatch.setattr(neardup, "TILE", 24)
    rows = tables.odd(family)
    docs = tables.documents(spark, rows).repartition(4)
    want = sorted(brute(rows), key=repr)
    assert tables.plain(neardup.dedup(docs)) == want
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns
    found = sorted(r["doc_id"] or -1 for r in kept.collect())
    # one of each group with words, each of the texts without, and the group that has no id
    firsts = sorted({r[2] for r in want if r[1] and r[2] is not None} | {i for i, n, *_ in want if not n and i is not None})
    assert [x for x in found if x >= 0] == firsts
    # the null id with words is near the prose of document 4; the one without words stays
    assert found.count(-1) == sum(1 for i, n, c, _ in want if i is None and (not n or c is None))


def meetings(spark, rows):
    """What ``_meetings`` sends of rows (key, c, comp, n), and the pairs of different components
    that meet, each as often as it does."""
    import numpy as np

    wide = np.log(100 / neardup.PERCENT) * 1.001
    full = [(key, 0, int(np.log(n) // wide), c, comp, n) for key, c, comp, n in rows]
    sent = neardup._meetings(spark.createDataFrame(full, "key long, place int, band int, c long, comp long, n long")).collect()
    comp = {c: x for _, c, x, _ in rows}
    groups, met = {}, []
    for r in sent:
        groups.setdefault((r["pair"], r["i"], r["j"]), []).append((r["c"], r["side"]))
    for group in groups.values():
        assert len({side == neardup.BOTH for _, side in group}) == 1
        for a, x in group:
            for b, y in group:
                if comp[a] != comp[b] and ((x, y) == (neardup.LEFT, neardup.RIGHT) or (x == neardup.BOTH and a < b)):
                    met.append((min(a, b), max(a, b)))
    return sent, sorted(met)


def test_every_pair_that_a_link_may_join_meets_once(spark, monkeypatch):
    monkeypatch.setattr(neardup, "TILE", 5)
    draw = random.Random(3)
    rows = [(k % 2, k, draw.choice([0, 0, 0, 1, 1, 2, 3 + k]), draw.choice([85, 100, 101, 117, 118, 700])) for k in range(120)]
    _, met = meetings(spark, rows)
    assert len(met) == len(set(met))
    want = set()
    for key, a, x, n in rows:
        for other, b, y, m in rows:
            if key == other and a < b and x != y and 100 * min(n, m) >= 85 * max(n, m):
                want.add((a, b))
    assert want <= set(met)


def test_one_component_is_sent_to_outsiders_alone(spark, monkeypatch):
    monkeypatch.setattr(neardup, "TILE", 5)
    inside = [(7, c, 0, 100) for c in range(400)]
    assert meetings(spark, inside) == ([], [])
    sent, met = meetings(spark, [*inside, (7, 1000, 1000, 101), (7, 1001, 1000, 300)])
    assert met == [(c, 1000) for c in range(400)]
    # its rows once, the outsider once for each of 80 tiles
    assert len(sent) == 400 + 80


def test_empty_table(spark):
    assert neardup.dedup(tables.empty(spark, tables.DOCS)).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 90), (100, 95), (7, 7), (200, 200), (95, 100), (300, 5)]
    found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 0 for k in range(41)} | {300: 0, 90: 90, 95: 90, 100: 90}
    assert found == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_minhash_shares_estimate_similarity():
    import numpy as np

    from shopstream.llm import common

    a = common.draws(1000, 1)
    b = np.concatenate([a[:900], common.draws(100, 2)])
    x, y = (neardup.minhashes(np.sort(s), 0, neardup.HASHES + neardup.MORE) for s in (a, b))
    assert abs((x == y).mean() - 900 / 1100) < 0.08
