import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shopstream.llm import pii
from shopstream.llm.queries import QUERIES
from tests.llm import tables

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        total = 0
        for k, d in enumerate(reversed(digits)):
            x = int(d) * (1 + k % 2)
            total += x - 9 if x > 9 else x
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [
        (kind, m.start(), m.end()) for kind, rule in RULES.items() for m in re.finditer(rule, text or "") if passes(kind, m.group())
    ]


def named(spans):
    return [(pii.KINDS[k], a, b) for k, a, b in spans]


def base(text):
    return named(pii.patterns(text, [m.span() for m in pii._NUMBERS.finditer(text)]))


PIECES = ["a.b@c.de", "@", "x@y", "1.2.3.4", "255.256.1.1", "1.2.3.4.5.6.7.8", "+1 (132) 555-1352", "+", "4111 1111 1111 1111", "4111111111111112", "6625883203433323", " ", "-", ".", "12", "é", "a", "\n", "(", ")", "007.0.0.1", "%", "_"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_patterns_match_the_rules(text):
    assert base(text) == brute(text)


def test_query_matches_the_rules(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op6_pii"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(w[0] == k for w in want) for k in pii.KINDS]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r["spans"].split(","))
        assert r["spans"] or not want


TEXTS = [
    "Call +1 (132) 555-1352 today. The office at (132) 555-1352 is open. Or 132-555-1352.",
    "Mail jo.day@mail3.example.com now; write to JO.DAY@MAIL3 later.",
    "Server 45.116.239.51 answers on port 80, and so does 45.116.239.51.",
    "Paid with 4111 1111 1111 1111 and again 4111111111111111.",
]


def field(spark):
    rows = [(k, TEXTS[k % 4].replace("132", f"{130 + k % 60}") + f" In {1900 + k} there were {10000000 + 7919 * k} of them.") for k in range(200)]
    return pii.learn(tables.documents(spark, rows)), rows


def test_field_keeps_labels_consistent(spark):
    learned, _ = field(spark)
    assert learned is not None
    first, spans = pii.private(TEXTS[0], learned)
    assert set(first) <= set(spans)
    added = [TEXTS[0][a:b] for k, a, b in spans if (k, a, b) not in first]
    assert all("555" in x for x in added) and added
    # the same digits without a phone number before them stay what they are
    assert pii.private("The office has 1325551352 stamps.", learned) == ([], [])
    clean = "It was 1984 and 12345678 birds, 3.14 of them red."
    assert pii.private(clean, learned) == ([], [])


def test_messages_pass_along_skip_edges():
    found = pii.Mentions([(0, 5), (10, 15), (500, 505)], [0, 0, 0], [4, -1, -1], [("111111111",), ("2",), ("111111111",)])
    unary = np.zeros((pii.FEATURES + 1, pii.LABELS))
    unary[-1, 0] = 0.5
    pair = np.stack([np.zeros((5, 5)), 4 * np.eye(5)])
    p = pii.beliefs(pii.Field(unary, pair), found)
    assert p[0].argmax() == 4 and p[1].argmax() == 0 and p[2].argmax() == 4
    left, right, kind = pii.edges(found)
    assert (left.tolist(), right.tolist(), kind.tolist()) == ([0, 1, 0], [1, 2, 2], [0, 0, 1])


def test_evidence_reaches_the_end_of_a_long_chain(spark):
    """All of 200 repeats of a number are added, wherever they stand."""
    learned, _ = field(spark)
    text = "Call +1 (132) 555-1352 now. " + "Or the number (132) 555-1352 again. " * 200
    first, spans = pii.private(text, learned)
    assert len(first) == 1 and len(spans) == 201
    assert [text[a:b] for _, a, b in spans[1:]] == ["132) 555-1352"] * 200


def test_exact_on_a_tree():
    """On a chain the messages give the exact marginals."""
    draw = np.random.default_rng(1)
    unary = draw.normal(size=(pii.FEATURES + 1, pii.LABELS))
    pair = draw.normal(size=(2, 5, 5))
    pair = pair + pair.transpose(0, 2, 1)
    found = pii.Mentions([(k, k + 1) for k in range(4)], [3, 5, 9, 17], [-1] * 4, [(str(k),) for k in range(4)])
    own = pii._bits(found.features) @ unary
    total = np.zeros((4, 5))
    for labels in np.ndindex(5, 5, 5, 5):
        weight = np.exp(sum(own[k, y] for k, y in enumerate(labels)) + sum(pair[0][labels[k], labels[k + 1]] for k in range(3)))
        for k, y in enumerate(labels):
            total[k, y] += weight
    assert np.allclose(pii.beliefs(pii.Field(unary, pair), found), total / total.sum(axis=1, keepdims=True), atol=1e-6)


def test_odd_documents_and_masks(spark):
    rows = tables.odd([(30, "a@b.cd 1.2.3.4 x"), (31, "+1 (132) 555-1352"), (32, "1.2.3.4@h.io")])
    docs = tables.documents(spark, rows)
    found = pii.find_private(docs, pii.learn(docs))
    assert found.count() == len(rows)
    made = pii.mask(docs)
    assert made.columns == docs.columns
    texts = {r["doc_id"]: r for r in made.collect() if r["doc_id"] is not None}
    assert texts[30]["text"] == "<EMAIL> <IP> x" and texts[30]["n_chars"] == len("<EMAIL> <IP> x")
    assert texts[31]["text"] == "<PHONE>" and texts[32]["text"] == "<EMAIL>"
    assert texts[1]["text"] is None and texts[4]["text"] == tables.PROSE
    assert pii.mask(tables.empty(spark, tables.DOCS)).count() == 0
    assert pii.learn(tables.documents(spark, [(1, "none"), (None, None)])) is None


def test_long_runs_take_time_in_proportion():
    import time

    for text in ("1" * 300_000, "1." * 150_000, "+1(" * 100_000, "a@" * 150_000, "a" * 300_000 + "@", "1 " * 150_000, "@" * 300_000):
        start = time.perf_counter()
        numbers = [m.span() for m in pii._NUMBERS.finditer(text)]
        pii.mentions(text, numbers, pii.patterns(text, numbers))
        assert time.perf_counter() - start < 6, text[:5]


def test_long_mentions_are_whole():
    name = "n" * 500
    text = f"write to {name}@host or {name}@host.example now"
    base = pii.patterns(text, [])
    assert [text[a:b] for _, a, b in base] == [f"{name}@host.example"]
    spans = pii.mentions(text, [], base).spans
    assert [text[a:b] for a, b in spans] == [f"{name}@host", f"{name}@host.example"]


def test_field_learns_from_rare_matches(spark):
    """One document in three hundred has a match, and the sample is far smaller."""
    rows = [(k, "nothing to see in 1234567 here") for k in range(300)] + [(1000, "mail a.b@host.example or call +1 202 555 0100, again 202 555 0100")]
    assert pii.learn(tables.documents(spark, rows), 10) is not None
    assert pii.learn(tables.documents(spark, rows[:300]), 10) is None
    assert pii.learn(tables.empty(spark, tables.DOCS)) is None
    assert pii.find_private(tables.empty(spark, tables.DOCS), None).count() == 0
