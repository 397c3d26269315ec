import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shopstream.llm import packing
from shopstream.llm.queries import QUERIES, vocabulary
from tests.llm import tables


def ids_of(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    return [*t.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, docs, size=2048):
    """Every id of every document lies in one piece; sequences have no gaps and little padding."""
    left = {}
    for doc_id, text in docs:
        left.setdefault(doc_id, []).append(ids_of(text))
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(left) == set(pieces)
    for doc_id, whole in left.items():
        made = sorted(pieces[doc_id], key=lambda r: (r["doc_tokens"], r["start"]))
        assert sum(r["length"] for r in made) == sum(map(len, whole))
        for ids in whole if len(whole) == 1 else []:
            at = 0
            for r in made:
                assert (r["start"], r["doc_tokens"]) == (at, len(ids))
                data = np.array(ids[at : at + r["length"]], "<u4").tobytes()
                assert r["ids_crc32"] == zlib.crc32(data)
                at += r["length"]
            assert at == len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    assert padding == 0


def test_query_round_trip(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op10_packing"](spark, sf).collect(), docs)


def test_odd_documents(spark):
    from pyspark.sql import functions as F

    docs = tables.documents(spark, tables.odd()).repartition(3)
    rows = packing.pack(docs, vocabulary(), size=64, pool=4).withColumn("ids_crc32", F.crc32("ids")).collect()
    check(rows, tables.odd(), 64)


def test_empty_table_and_bad_size(spark):
    docs = tables.empty(spark, tables.DOCS)
    assert packing.pack(docs, vocabulary()).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, vocabulary(), size=100)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 4), max_size=8), st.integers(0, 60))
def test_best_fill_is_the_best(counts, room):
    sums = {0}
    for length, n in counts.items():
        sums |= {s + k * length for s in sums for k in range(1, n + 1)}
    taken = packing.best_fill(counts, room)
    assert all(taken[x] <= counts[x] for x in taken)
    assert sum(x * n for x, n in taken.items()) == max(s for s in sums if s <= room)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aBé'sS .,!*3٣ß日\n\t́ ΣİſΩ|&<>_-\x1c\x85"), max_size=24), max_size=4))
def test_words_give_the_ids_of_the_text(texts):
    words = packing.tokenizer(vocabulary())
    ids, offsets = words.encode(texts)
    for k, text in enumerate(texts):
        assert list(ids[offsets[k] : offsets[k + 1]]) == words.encoder.encode(text, add_special_tokens=False).ids


def test_every_character_before_every_mark():
    """Ids equal the tokenizer's for each letter and digit there is, before each mark."""
    words = packing.tokenizer(vocabulary())
    cut = [c for c in map(chr, range(0x110000)) if c.isalnum() and words.parts_from_marks(c)]
    assert len(cut) > 100_000 and not words.parts_from_marks("\u0130") and not words.parts_from_marks("\u0958")
    plain = [e.ids for e in words.encoder.encode_batch(["a" + c for c in cut], add_special_tokens=False)]
    for mark in words.MARKS:
        tail = words.encoder.encode(mark, add_special_tokens=False).ids
        whole = words.encoder.encode_batch([f"a{c}{mark}" for c in cut], add_special_tokens=False)
        wrong = [c for c, ids, e in zip(cut, plain, whole, strict=True) if e.ids != ids + tail]
        assert not wrong, (mark, wrong[:5])
    for c in ("\u0130", "\u0958", "\u095f", "\u09dc", "\u0a33"):
        assert words.ids_of(f"x{c}.") == words.encoder.encode(f"x{c}.", add_special_tokens=False).ids


def test_forgetting_words_changes_nothing(spark, sf, monkeypatch):
    monkeypatch.setattr(packing.WordTokenizer, "KEEP", 50)
    words = packing.WordTokenizer(vocabulary())
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").limit(40).collect()]
    for at in range(0, 40, 10):
        ids, offsets = words.encode(texts[at : at + 10])
        for k in range(10):
            assert list(ids[offsets[k] : offsets[k + 1]]) == words.encoder.encode(texts[at + k], add_special_tokens=False).ids
