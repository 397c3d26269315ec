"""How text filters act on one another, part by part and in every order.

A byte transducer counts what the filters need in one pass over the UTF-8 of the texts: two tables
say, for the state (between words or in one) and the class of a byte, what it gives out and which
state comes next. Spans of words go into a hash table that compares their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.llm import common

#: The filters, by letter: a document fails A with too few words, B with too few distinct ones, C
#: with too many capitals, D with a symbol, E as a copy of one with a smaller id.
FILTERS = "ABCDE"
FEWEST_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT, SYMBOLS = 50, 65, 5, b"#$%&*|"

# Classes of bytes, states, and what a step gives out.
SPACE, CAPITAL, SYMBOL, OTHER, LATER = range(5)
BETWEEN, INSIDE = range(2)
WORD, UPPER, MARK, POINT, END = 1, 2, 4, 8, 16


def _classes() -> np.ndarray:
    """The class of each byte; LATER bytes continue a code point."""
    out = np.full(256, OTHER, np.uint8)
    out[[0x20, *range(0x09, 0x0E)]] = SPACE
    out[65:91] = CAPITAL
    out[list(SYMBOLS)] = SYMBOL
    out[0x80:0xC0] = LATER
    return out


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(what comes out, the next state), by state and class."""
    out, following = np.zeros((2, 5), np.uint8), np.zeros((2, 5), np.uint8)
    for state in (BETWEEN, INSIDE):
        for kind in range(5):
            given = 0 if kind == LATER else POINT
            given |= {CAPITAL: UPPER, SYMBOL: MARK}.get(kind, 0)
            if kind == SPACE:
                given |= END if state == INSIDE else 0
            else:
                given |= WORD if state == BETWEEN else 0
            out[state, kind], following[state, kind] = given, BETWEEN if kind == SPACE else INSIDE
    return out, following


CLASS = _classes()
OUT, NEXT = _tables()


def transduce(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """What the pass gives out at each byte; every row begins between words.

    The next state depends on the class alone, in both states (see NEXT), so the states of all
    bytes are looked up at once: that of a byte is where the byte before it leads.
    """
    kinds = CLASS[data]
    states = np.empty(len(data), np.uint8)
    states[1:] = NEXT[BETWEEN][kinds[:-1]]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    states[firsts] = BETWEEN
    return OUT[states, kinds]


def _pieces(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", buffer=padded, strides=(1,))


_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def _piece(pieces: np.ndarray, starts: np.ndarray, lengths: np.ndarray, k: int) -> np.ndarray:
    """The kth eight bytes of each span, with zeros after its end."""
    left = np.clip(lengths - 8 * k, 0, 8)
    return pieces[np.minimum(starts + 8 * k, len(pieces) - 1)] & _MASKS[left]


def span_hashes(pieces: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    hashes = common.mix(lengths.astype(np.uint64))
    active, k = np.arange(len(starts)), 0
    while len(active):
        hashes[active] = common.mix(hashes[active] ^ _piece(pieces, starts[active], lengths[active], k))
        k += 1
        active = active[lengths[active] > 8 * k]
    return hashes


def same_spans(pieces: np.ndarray, starts: np.ndarray, lengths: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether the spans of each pair hold the same bytes."""
    same = lengths[one] == lengths[two]
    active, k = np.flatnonzero(same), 0
    while len(active):
        a, b = one[active], two[active]
        equal = _piece(pieces, starts[a], lengths[a], k) == _piece(pieces, starts[b], lengths[b], k)
        same[active[~equal]] = False
        k += 1
        active = active[equal]
        active = active[lengths[one[active]] > 8 * k]
    return same


def distinct(pieces: np.ndarray, starts: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many different spans each row has; ``counts`` says how many spans it has in all.

    Every row has a region of one open-addressed table, at least twice its spans long. All spans
    step at once: they look at their place, claim it if it is free, are done where it holds the same
    bytes, and go to the next place where it holds others.
    """
    sizes = np.where(counts > 0, 1 << np.ceil(np.log2(np.maximum(2 * counts, 2))).astype(np.int64), 0)
    bases = np.cumsum(sizes) - sizes
    base, mask = np.repeat(bases, counts), np.repeat(sizes - 1, counts)
    hashes = span_hashes(pieces, starts, lengths)
    place = (hashes & mask.astype(np.uint64)).astype(np.int64)
    held = np.full(int(sizes.sum()), -1, np.int64)
    new = np.zeros(len(starts), bool)
    active = np.arange(len(starts))
    while len(active):
        at = base[active] + place[active]
        free = held[at] < 0
        held[at[free]] = active[free]  # of several, one stays
        holder = held[at]
        mine = holder == active
        new[active[mine]] = True
        done = mine | (hashes[holder] == hashes[active])
        check = np.flatnonzero(done & ~mine)
        done[check] = same_spans(pieces, starts, lengths, active[check], holder[check])
        active = active[~done]
        place[active] = (place[active] + 1) & mask[active]
    before = np.concatenate([[0], np.cumsum(new)])
    ends = np.cumsum(counts)
    return before[ends] - before[ends - counts]


def measures(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Words, distinct words, capitals, code points and symbols of each row."""
    given = transduce(data, offsets)

    def count(what: int) -> np.ndarray:
        before = np.concatenate([[0], np.cumsum(given & what > 0)])
        return before[offsets[1:]] - before[offsets[:-1]]

    words = count(WORD)
    starts = np.flatnonzero(given & WORD)
    # a word ends at the white space after it, or where its row ends
    stops = np.append(np.flatnonzero(given & END), offsets[1:][(offsets[1:] > offsets[:-1])])
    stops = np.sort(stops, kind="stable")
    lengths = stops[np.searchsorted(stops, starts, "right")] - starts if len(starts) else starts
    return {
        "words": words,
        "distinct": distinct(_pieces(data), starts, lengths, words),
        "capitals": count(UPPER),
        "points": count(POINT),
        "symbols": count(MARK),
    }


def failed(found: dict[str, np.ndarray]) -> np.ndarray:
    """Which of A to D each row fails, as bits."""
    tests = (
        found["words"] < FEWEST_WORDS,
        100 * found["distinct"] < DISTINCT_PERCENT * found["words"],
        100 * found["capitals"] > CAPITALS_PERCENT * found["points"],
        found["symbols"] > 0,
    )
    return sum(test.astype(np.int32) << bit for bit, test in enumerate(tests))


def judged(docs: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """(id, part, digest, mask) of each document; the text goes no further."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches, "_text"):
            data, offsets = common.utf8(common.text_of(batch, "_text"))
            masks = pa.array(failed(measures(data, offsets)), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], masks], names=["id", "part", "digest", "mask"])

    whole = common.whole_text(text)
    rows = docs.select(
        F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(whole, 256)).alias("digest"), whole.alias("_text")
    )
    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL("part string, digest binary, mask int").fields])
    return rows.mapInArrow(run, schema)


def failures(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, mask, good, toxic, n): how many documents of a part fail which filters (bits from A
    on), with the marks of the labels.

    Copies are counted together before they are shuffled, so a text that a third of the documents
    share is a few rows. A text is a copy where the same text stands under a smaller id anywhere;
    rows without an id are no copies and make none.
    """
    seen = judged(docs, key, text, part).groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    marks = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_id"))
    marks = marks.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    # rows without an id meet nothing, and are spread by their text
    place = F.coalesce(F.col("id"), F.xxhash64("digest", "part"))
    marked = seen.withColumn("_place", place).join(marks, (F.col("_place") == F.col("_id")) & F.col("id").isNotNull(), "left")
    no = F.lit(False)
    marked = marked.select("id", "part", "digest", "mask", "n", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
    groups = marked.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("id").alias("least"), F.min_by("n", F.struct(F.col("id").isNull(), "id")).alias("n_least"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
    )
    # one row for each part and pair of marks of a text
    first = F.min("least").over(Window.partitionBy("digest"))
    originals = F.col("unnamed") + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    split = groups.withColumn("first", first).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("mask"), originals.alias("n")),
            F.struct(F.col("mask").bitwiseOR(16).alias("mask"), (F.col("n") - originals).alias("n")),
        )).alias("_x"),
    )
    return split.select("part", "good", "toxic", "_x.mask", "_x.n").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _steps() -> dict[str, np.ndarray]:
    """For every order and step, which masks count as what: rows of ones over the 32 masks."""
    masks = np.arange(32)
    out = {name: np.zeros((len(ORDERS) * 5, 32), np.int64) for name in ("kept", "removed", "redundant", "unique_fails")}
    for k, order in enumerate(ORDERS):
        through = np.ones(32, bool)
        for step, letter in enumerate(order):
            row, bit = 5 * k + step, 1 << FILTERS.index(letter)
            fails = masks & bit > 0
            out["removed"][row], out["redundant"][row] = through & fails, ~through & fails
            out["unique_fails"][row] = masks == bit
            through = through & ~fails
            out["kept"][row] = through
    return out


STEPS = _steps()
LETTERS = np.array([[order[step] for step in range(5)] for order in ORDERS]).ravel()


def orders(counted: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, from the result of `failures`."""

    def vector(extra: str | None) -> list:
        n = F.col("n") if extra is None else F.when(F.col(extra), F.col("n")).otherwise(0)
        return [F.coalesce(F.sum(F.when(F.col("mask") == m, n)), F.lit(0)) for m in range(32)]

    names = {"all": None, "good": "good", "toxic": "toxic"}
    parts = counted.groupBy("part").agg(*[F.array(*vector(extra)).alias(f"_{name}") for name, extra in names.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, part in enumerate(batch.column(0).to_pylist()):
                whole, good, toxic = (np.array(batch.column(c)[place].as_py(), np.int64) for c in (1, 2, 3))
                found = {name: rows @ whole for name, rows in STEPS.items()}
                found["good_lost"], found["toxic_lost"] = STEPS["removed"] @ good, STEPS["removed"] @ toxic
                total = {letter: found["removed"][LETTERS == letter].sum() for letter in FILTERS}
                found["shapley"] = np.array([total[letter] for letter in LETTERS])
                columns = [pa.array([part] * len(LETTERS)), pa.array(np.repeat(ORDERS, 5)), pa.array(np.tile(np.arange(1, 6, dtype=np.int32), len(ORDERS)))]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(found[c]) for c in COUNTS]], names=["part", "filter_order", "step", *COUNTS])

    return parts.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """For each part (NULL as the empty text), order of the five filters and step: the documents
    kept after it and removed by it, those that fail its filter but were removed before
    (redundant) or fail it alone (unique_fails), the removed ones that labels mark as good or
    toxic, and the documents its filter removes in all 120 orders together (shapley).

    A NULL text is empty: it fails A, and E beside another empty one. Texts are read whole.
    Repeated rows of the smallest id of a text are no copies of each other. Of several labels of a
    document one mark is enough; labels without an id mark nothing. An empty table has no
    parts and gives no rows, empty labels mark nothing. Other columns are not read.
    """
    return orders(failures(docs, labels, key, text, part))


#: The same in SQL.
SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
counted AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts),
firsts AS (SELECT text, min(doc_id) AS first FROM texts GROUP BY text),
marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
judged AS (
    SELECT c.part, coalesce(m.good, false) AS good, coalesce(m.toxic, false) AS toxic,
           (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
           + 4 * (100 * length(regexp_replace(c.text, '[^A-Z]', '', 'g')) > 5 * length(c.text))::INT
           + 8 * regexp_matches(c.text, '[#$%&*|]')::INT + 16 * coalesce(c.doc_id > f.first, false)::INT AS mask
    FROM counted c JOIN firsts f ON c.text = f.text LEFT JOIN marks m ON c.doc_id = m.doc_id),
masks AS (SELECT part, mask, good, toxic, count(*) AS n FROM judged GROUP BY ALL),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS l(letter, bit)),
places AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
    SELECT filter_order, step::INT AS step, bits[step] AS bit, list_sum(list_slice(bits, 1, step - 1))::INT AS earlier
    FROM places, range(1, 6) AS r(step)),
found AS (
    SELECT part, filter_order, step, bit,
           sum(CASE WHEN mask & (coalesce(earlier, 0) | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
           sum(CASE WHEN mask & coalesce(earlier, 0) = 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS removed,
           sum(CASE WHEN mask & coalesce(earlier, 0) > 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
           sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
           sum(CASE WHEN mask & coalesce(earlier, 0) = 0 AND mask & bit > 0 AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
           sum(CASE WHEN mask & coalesce(earlier, 0) = 0 AND mask & bit > 0 AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
    FROM masks, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley
FROM found"""
