import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from shopstream.llm import audit, common
from shopstream.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import connect, difference
from tests.llm import tables

WORD = re.compile("[^\x20\x09-\x0d]+")
LABELS = "doc_id long, quality int, toxic int, n long, part string"


def plain_measures(text):
    words = WORD.findall(text)
    return len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall("[#$%&*|]", text))


def brute(docs, labels):
    texts = [(i, t or "", s or "") for i, t, s in docs]
    out = Counter()
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    fails = []
    for i, text, part in texts:
        n, different, upper, points, symbols = plain_measures(text)
        copy = i is not None and any(j is not None and j < i and u == text for j, u, _ in texts)
        fails.append({c for c, f in zip("ABCDE", (n < 50, 100 * different < 65 * n, 100 * upper > 5 * points, symbols > 0, copy), strict=True) if f})
    for part in {p for _, _, p in texts}:
        mine = [(i, f) for (i, _, p), f in zip(texts, fails, strict=True) if p == part]
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order):
                before = [(i, f) for i, f in mine if not f & set(order[:step])]
                gone = [i for i, f in before if letter in f]
                out[(part, "".join(order), step + 1)] = [
                    len(before) - len(gone), len(gone), sum(letter in f for _, f in mine) - len(gone), sum(f == {letter} for _, f in mine),
                    sum(i in good for i in gone), sum(i in toxic for i in gone),
                ]
        for letter in "ABCDE":
            keys = [(part, "".join(o), o.index(letter) + 1) for o in permutations("ABCDE")]
            total = sum(out[k][1] for k in keys)
            for k in keys:
                out[k].append(total)
    return sorted((*k, *v) for k, v in out.items())


def rows_of(df):
    return sorted(tuple(r) for r in df.select("part", "filter_order", "step", *audit.COUNTS).collect())


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "k") for i, t, s in rows], "doc_id long, text string, source string, n long, mask string")


def test_query_matches_sql(spark, sf):
    assert difference(QUERIES["op12_filter_audit"](spark, sf), connect(sf), ORACLE_SQL["op12_filter_audit"]) is None


def test_odd_rows_match_brute_force(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(i, t, ("a", "b", None, "")[k % 4]) for k, (i, t) in enumerate(tables.odd([(20, long), (21, long), (None, long), (22, long + " A#"), (19, long), (19, long), (23, "A B " * 40)]))]
    labels = [(20, 1, 0), (20, 0, 1), (21, 1, 1), (4, None, 1), (None, 1, 1), (999, 1, 1)]
    marks = spark.createDataFrame([(*r, 5, "p") for r in labels], LABELS)
    assert rows_of(audit.audit(docs_frame(spark, rows), marks)) == brute(rows, labels)


def test_empty_tables(spark):
    none = tables.empty(spark, LABELS)
    assert audit.audit(docs_frame(spark, []), none).count() == 0
    assert rows_of(audit.audit(docs_frame(spark, [(1, "x", None)]), none)) == brute([(1, "x", None)], [])


def test_a_hot_text_stays_few_rows(spark):
    rows = [(k, "the same text" if k % 3 else f"text {k}", "s") for k in range(600)]
    seen = audit.failures(docs_frame(spark, rows), tables.empty(spark, LABELS)).collect()
    assert sum(r["n"] for r in seen) == 600 and sum(r["n"] for r in seen if r["mask"] & 16) == 399


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab A#é日\U0001f469\t\n\x0b\xa0 ", max_size=40), min_size=1, max_size=6))
def test_one_pass_counts_as_patterns_do(texts):
    data, offsets = common.utf8(pa.array(texts))
    found = audit.measures(data, offsets)
    rows = list(zip(*(found[c].tolist() for c in ("words", "distinct", "capitals", "points", "symbols")), strict=True))
    assert rows == [plain_measures(t) for t in texts]


def test_equal_hashes_are_told_apart(monkeypatch):
    """Words are compared by their bytes, whatever the hash says."""
    monkeypatch.setattr(audit, "span_hashes", lambda pieces, starts, lengths: np.zeros(len(starts), np.uint64))
    text = " ".join(["one", "two", "one", "longer-than-eight", "longer-than-eighT", "longer-than-eight", "t"])
    data, offsets = common.utf8(pa.array([text, "", "one"]))
    assert audit.measures(data, offsets)["distinct"].tolist() == [5, 0, 1]


def test_sql_of_empty_tables():
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    assert con.execute(ORACLE_SQL["op12_filter_audit"]).fetchall() == []
