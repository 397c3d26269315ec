import hashlib
import re

from shopstream.llm import decontaminate as dc
from shopstream.llm.queries import QUERIES
from tests.llm import tables

WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                owners = windows.get(tuple(w[k : k + n]))
                if owners:
                    hit.update(range(k, k + n))
                    found |= owners
        found.discard(None)
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        yield doc_id, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)


def pairs(spark, sf, name, key):
    return [(r[key], r["text"]) for r in spark.read.parquet(f"{sf}/{name}.parquet").collect()]


def result(found):
    return tables.plain(dc.judge(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"))


def test_query_matches_brute_force(spark, sf):
    want = sorted(brute(pairs(spark, sf, "documents", "doc_id"), pairs(spark, sf, "benchmark", "item_id")), key=repr)
    assert tables.plain(QUERIES["op8_decontamination"](spark, sf)) == want
    assert any(row[-1] for row in want)


LONG = "a b c d e f g h i j k l m n o p q r s t"
ITEMS = [(1, LONG), (2, "short item here"), (2, "short item here"), (3, None), (4, ""), (None, "one two three four"), (5, LONG + " u v w"), (12, "!!!"), (6, "single")]


def cases():
    return [
        (20, "x " * 5 + LONG.upper() + " y" * 300),
        (21, "A-b.c/d e f g h i j k l"),
        (22, "a b c d e f g h i j k l m"),
        (23, "Short, item! HERE and SHORT item here."),
        (24, "one two three four " * 3),
        (25, "single " * 50),
        (26, LONG + " " + LONG),
        (27, "a b c d e f g h i j k l"),
    ]


def test_odd_documents_and_blocks(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = tables.odd(cases())
    docs = tables.documents(spark, rows).repartition(2)
    want = sorted(brute(rows, ITEMS), key=repr)
    assert result(dc.find_benchmark(docs, items)) == want
    assert result(dc.find_benchmark(docs, items, block_words=4)) == want  # several parts
    kept = dc.decontaminate(docs, items)
    assert kept.columns == docs.columns
    bad = {r[0] for r in want if r[-1]}
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(i or -1 for i, _ in rows if i not in bad)


def test_empty_tables(spark):
    none = tables.empty(spark, "item_id long, text string")
    docs = tables.documents(spark, tables.odd())
    assert all(r["n_hit"] == 0 for r in dc.judge(dc.find_benchmark(docs, none)).collect())
    assert dc.find_benchmark(tables.empty(spark, tables.DOCS), none).count() == 0
