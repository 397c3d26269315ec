import math
import re

import pytest

from shopstream.llm import mixing
from shopstream.llm.queries import QUERIES
from tests.llm import tables

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_targets(totals):
    """Rounds of sharing, by the contract's words."""
    order = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    given, left = dict.fromkeys(order, 0.0), float(sum(totals.values()))
    open_ = set(order)
    while open_ and left > 1e-9 * max(1, sum(totals.values())):
        whole = sum(weight[s] for s in open_)
        for s in open_:
            given[s] += left * weight[s] / whole
        left = 0.0
        for s in list(open_):
            if given[s] >= 3 * totals[s]:
                left += given[s] - 3 * totals[s]
                given[s] = 3.0 * totals[s]
                open_.remove(s)
    return given


def check(df, rows, near):
    """Every document once with its size, targets by hand, and words taken near them."""
    found = [r.asDict() for r in df.collect()]
    sizes = [(i, len(WORD.findall(t or "")), s) for i, t, s in rows]
    totals = {}
    for _, n, s in sizes:
        totals[s] = totals.get(s, 0) + n
    wanted = plain_targets(totals)
    assert sorted(((r["doc_id"], r["size"], r["source_size"]) for r in found), key=repr) == sorted(((i, n, totals[s]) for i, n, s in sizes), key=repr)
    taken = {}
    place = {(i, n, totals[s]): s for i, n, s in sizes}
    for r in found:
        s = place[(r["doc_id"], r["size"], r["source_size"])]
        assert r["target"] == pytest.approx(wanted[s], rel=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[s] = taken.get(s, 0) + r["taken"]
    for s, words in taken.items():
        assert abs(words - wanted[s]) <= near(s), (s, words, wanted[s])
    return found


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    sizes = {}
    for _, t, s in rows:
        sizes.setdefault(s, []).append(len(WORD.findall(t or "")))
    wanted = plain_targets({s: sum(v) for s, v in sizes.items()})
    first = check(QUERIES["op13_mixing"](spark, sf), rows, lambda s: max(0.01 * wanted[s], min(n for n in sizes[s] if n)))
    again = [r.asDict() for r in QUERIES["op13_mixing"](spark, sf).collect()]
    assert sorted(map(repr, first)) == sorted(map(repr, again))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 1.5, "x", 2) for i, t, s in rows], "doc_id long, text string, source string, taken double, _size string, n int")


def test_odd_rows(spark):
    rows = [(i, t, ("b", "a", None, "é")[k % 4]) for k, (i, t) in enumerate(tables.odd())]
    rows += [(k, "word " * (1 + k % 7), "b") for k in range(100, 160)] + [(k, "word " * (1 + k % 5), None) for k in range(200, 260)]
    rows += [(300, "", "empty"), (301, None, "empty")]
    found = check(mixing.mix(frame(spark, rows)), rows, lambda s: 40_000 if s == "é" or s is None or s == "b" or s == "a" else 0)
    assert {"n", "_size"} <= set(found[0]) and "text" not in found[0]


def test_small_documents_reach_the_target_within_one(spark):
    rows = [(k, "w " * (1 + k % 50), "abc"[k % 3]) for k in range(900)]
    check(mixing.mix(frame(spark, rows)), rows, lambda s: 1)


def test_a_source_that_gives_its_most(spark):
    rows = [(0, "only two", "a")] + [(k, "w " * (1 + k % 9), "b") for k in range(1, 300)] + [(k, "w " * 3, "c") for k in range(300, 600)]
    found = check(mixing.mix(frame(spark, rows)), rows, lambda s: 3)
    assert [r["taken"] for r in found if r["doc_id"] == 0] == [6]


def test_equal_copies_differ_by_one_copy(spark):
    """A third of the rows are one text, with ids and without."""
    rows = [(k if k % 2 else None, "same size here", "a") for k in range(300)] + [(k, "w " * 30, "b") for k in range(300, 330)]
    found = check(mixing.mix(frame(spark, rows)), rows, lambda s: 30)
    copies = {r["copies"] for r in found if r["size"] == 3}
    assert max(copies) - min(copies) <= 1


def test_empty_and_wordless_tables(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    found = mixing.mix(frame(spark, [(1, "", "a"), (2, None, None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in found] == [(0, 0.0, 0)] * 2


def test_rates_are_the_minimum_of_the_dual(spark):
    """For each source the words of exp(tilt * size), cut at three, are the target."""
    rows = [("a", 1, 50), ("a", 40, 3), ("a", 900, 1), ("b", 2, 10), ("b", 5000, 2), ("c", 7, 1)]
    groups = spark.createDataFrame(rows, "_source string, _size long, n long")
    total = {s: sum(z * n for t, z, n in rows if t == s) for s in "abc"}
    wanted = spark.createDataFrame([(s, total[s], 3 * total[s], total[s] * f) for s, f in (("a", 0.2), ("b", 2.9), ("c", 3.0))], "_source string, total long, most long, target double")
    tilts = {r["_source"]: r["tilt"] for r in mixing.tilts(groups, wanted).collect()}
    for s, f in (("a", 0.2), ("b", 2.9), ("c", 3.0)):
        words = sum(z * n * min(3, math.exp(min(5, tilts[s] * z))) for t, z, n in rows if t == s)
        assert words == pytest.approx(total[s] * f, rel=1e-8)
