"""Personal data by patterns and a skip-chain conditional random field."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.llm import common

KINDS = ("email", "ip", "card", "phone")
#: Labels of a mention: none, or one of the kinds.
LABELS = 1 + len(KINDS)

#: Documents the field learns from, and the probability from which it adds a span.
SAMPLE_ROWS, SURE = 4000, 0.95

#: A message that changes by less is settled.
STILL = 1e-6

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match from the middle of digits would be one from their start: only that is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Everything the last three can match lies in one run of these characters.
_NUMBERS = re.compile(r"[0-9+][0-9+ ().\-]*")
_DIGITS = re.compile(r"[0-9]+")
_AROUND = re.compile(r"[^\s<>(),;:\"']+")

Span = tuple[int, int, int]  # kind, start, end

SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
)
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches from the signs outwards: a name never holds the sign itself."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def patterns(text: str, numbers: list[tuple[int, int]]) -> list[Span]:
    """The matches of the patterns that pass, by kind and start."""
    out: list[Span] = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    found: list[list[Span]] = [[], [], []]
    for a, b in numbers:
        run = text[a:b]
        if run.count(".") >= 3:
            for m in _IP.finditer(run):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                    found[0].append((1, a + m.start(), a + m.end()))
        if b - a >= 13:
            for m in _CARD.finditer(run):
                digits = m.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found[1].append((2, a + m.start(), a + m.end()))
        if "+" in run:
            for m in _PHONE.finditer(run):
                if 9 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15:
                    found[2].append((3, a + m.start(), a + m.end()))
    return [*out, *found[0], *found[1], *found[2]]


@dataclass
class Mentions:
    """What may be personal data in one text: places, feature sets, fixed labels (-1: open), and
    what tells that two mentions are the same or much alike."""

    spans: list[tuple[int, int]]
    features: list[int]
    labels: list[int]
    keys: list[tuple[str, ...]]


def _features(text: str, a: int, b: int) -> int:
    """Shape and neighbourhood of a mention, one bit each."""
    own = text[a:b]
    runs = _DIGITS.findall(own)
    digits = sum(map(len, runs))
    before = text[max(0, a - 1) : a]
    after = text[b : b + 1]
    flags = [
        "@" in own,
        "." in own.rpartition("@")[2] if "@" in own else False,
        own.startswith("+"),
        "(" in own,
        "-" in own,
        " " in own,
        own.count(".") == 3,
        own.count(".") not in (0, 3),
        digits < 7,
        7 <= digits <= 8,
        9 <= digits <= 12,
        digits in (13, 14, 15),
        16 <= digits <= 19,
        digits > 19,
        13 <= digits <= 19 and luhn("".join(runs)),
        len(runs) == 1,
        len(runs) == 4,
        any(len(r) > 3 for r in runs),
        bool(before) and not before.isspace(),
        bool(after) and not after.isspace() and after not in ".,;:!?",
    ]
    return sum(1 << k for k, flag in enumerate(flags) if flag)


FEATURES = 20


def _keys(own: str) -> tuple[str, ...]:
    """Equal keys join mentions: an address without case and edge marks; a number by all of its
    digits and by its last nine."""
    if "@" in own:
        return (own.strip(".-_%+").lower(),)
    digits = "".join(_DIGITS.findall(own))
    return (digits, digits[-9:]) if len(digits) > 9 else (digits,)


def mentions(text: str, numbers: list[tuple[int, int]], base: list[Span]) -> Mentions:
    """The pattern matches, and open mentions beside them: runs of numbers with seven digits or
    more, and words around an @ sign, that no match touches."""
    fixed = sorted((a, b, k) for k, a, b in base)
    taken = [(a, b) for a, b, _ in fixed]
    rest = []
    for a, b in numbers:
        own = text[a:b].rstrip(" (+.-")
        if sum(map(len, _DIGITS.findall(own))) >= 7:
            rest.append((a, a + len(own)))
    if "@" in text:
        at = text.find("@")
        while at >= 0:
            left = at
            while left > 0 and text[left - 1] in _LOCAL:
                left -= 1
            # the word around the sign ends at white space or a mark, so no character is read twice
            right = _AROUND.match(text, left).end()
            own = text[left:right].rstrip(".-!?*#%&$")
            if left < at and left + len(own) > at + 1:
                rest.append((left, left + len(own)))
            at = text.find("@", right)
    rest.sort()
    open_, k = [], 0
    for a, b in rest:
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if not (k < len(taken) and taken[k][0] < b) and (not open_ or open_[-1][1] <= a):
            open_.append((a, b))
    found = sorted([(a, b, 1 + kind) for a, b, kind in fixed] + [(a, b, -1) for a, b in open_])
    return Mentions(
        [(a, b) for a, b, _ in found],
        [_features(text, a, b) for a, b, _ in found],
        [label for _, _, label in found],
        [_keys(text[a:b]) for a, b, _ in found],
    )


def edges(found: Mentions) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in the text (kind 0), and each mention with the last one before it that has
    the same key (kind 1: as many edges as mentions, however often one repeats)."""
    left, right, kind = list(range(len(found.spans) - 1)), list(range(1, len(found.spans))), [0] * max(0, len(found.spans) - 1)
    last: dict[str, int] = {}
    for k, keys in enumerate(found.keys):
        for key in keys:
            if key in last:
                left.append(last[key])
                right.append(k)
                kind.append(1)
            last[key] = k
    return np.array(left, np.int64), np.array(right, np.int64), np.array(kind, np.int64)


@dataclass
class Field:
    """Weights of the features for each label, and how labels of joined mentions agree, for
    neighbours and for skip edges."""

    unary: np.ndarray  # FEATURES + 1 x LABELS
    pair: np.ndarray  # 2 x LABELS x LABELS


def _bits(features: list[int]) -> np.ndarray:
    x = (np.array(features, np.int64)[:, None] >> np.arange(FEATURES)) & 1
    return np.concatenate([x, np.ones((len(x), 1), np.int64)], axis=1).astype(np.float64)


def _outgoing(source: np.ndarray, n: int) -> np.ndarray:
    """The messages that leave each mention, one row each, filled up with -1."""
    order = np.argsort(source, kind="stable")
    counts = np.bincount(source, minlength=n)
    out = np.full((n, counts.max(initial=0)), -1, np.int64)
    out[source[order], np.arange(len(order)) - np.repeat(np.cumsum(counts) - counts, counts)] = order
    return out


def beliefs(field: Field, found: Mentions) -> np.ndarray:
    """The label probabilities of every mention, by loopy sum-product message passing.

    Messages pass until none changes by more than ``STILL``. A round computes only those whose
    input changed, so evidence that runs along a chain costs its length. Loops may never settle:
    the rounds are bounded by some for each mention of the key that repeats most."""
    n = len(found.spans)
    own = _bits(found.features) @ field.unary
    for k, label in enumerate(found.labels):
        if label >= 0:
            own[k] = -30.0
            own[k, label] = 0.0
    left, right, kind = edges(found)
    source, target = np.concatenate([left, right]), np.concatenate([right, left])
    both = np.concatenate([kind, kind])
    m = len(left)
    reverse = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
    messages = np.zeros((2 * m, LABELS))
    leaving = _outgoing(source, n)
    longest = max(Counter(key for keys in found.keys for key in keys).values(), default=0)
    total, live = own.copy(), np.arange(2 * m)
    for _ in range(100 + 10 * longest):
        if not len(live):
            break
        sent = (total[source[live]] - messages[reverse[live]])[:, :, None] + field.pair[both[live]]
        top = sent.max(axis=1, keepdims=True)
        new = np.log(np.exp(sent - top).sum(axis=1)) + top[:, 0]
        new -= new.max(axis=1, keepdims=True)
        change = new - messages[live]
        if m > n:
            change *= 0.5
        messages[live] += change
        np.add.at(total, target[live], change)
        moved = live[np.abs(change).max(axis=1) > STILL]
        live = np.unique(np.concatenate([moved, leaving[target[moved]].ravel()]))
        live = live[live >= 0]
    total = own
    np.add.at(total, target, messages)
    p = np.exp(total - total.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def private(text: str, field: Field | None) -> tuple[list[Span], list[Span]]:
    """The spans of the patterns, and those with the added ones, both by kind and start."""
    numbers = [m.span() for m in _NUMBERS.finditer(text)]
    if not numbers and "@" not in text:
        return [], []
    base = patterns(text, numbers)
    if field is None or not base:  # nothing to agree with
        return base, base
    found = mentions(text, numbers, base)
    if -1 not in found.labels:
        return base, base
    p = beliefs(field, found)
    label = p.argmax(axis=1)
    added = [
        (int(label[k]) - 1, *found.spans[k])
        for k, fixed in enumerate(found.labels)
        if fixed < 0 and label[k] and p[k, label[k]] >= SURE
    ]
    return base, sorted([*base, *added])


def learn(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Field | None:
    """The field from at most ``rows`` documents: those with the smallest hashes of their ids, half of
    them among all documents and half among those in which a pattern matches.

    Mentions that the patterns match are labelled with their kind and the others with none, but
    for those that are joined to a match. The weights are those of a softmax regression on the
    features; how much joined mentions agree is counted. None where no document with an id has a
    match, as in an empty table.
    """
    texts = docs.filter("doc_id IS NOT NULL").select("doc_id", common.whole_text().alias("text"))
    matched = texts.mapInArrow(_matched, T.StructType([T.StructField("doc_id", texts.schema["doc_id"].dataType), T.StructField("matched", T.BooleanType())]))
    matched = matched.groupBy("doc_id").agg(F.max("matched").alias("matched"))

    def smallest(of: DataFrame) -> DataFrame:
        return of.orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id").limit(rows // 2)

    ids = F.broadcast(smallest(matched.filter("matched")).unionByName(smallest(matched)).distinct())
    own = texts.join(ids, "doc_id", "left_semi")
    counted = own.select("text").mapInArrow(_count, "what int, a long, b int, n long")
    # at most as many rows as the sample has mentions and edges, and far fewer kinds of them
    found = counted.groupBy("what", "a", "b").agg(F.sum("n").alias("n")).collect()
    seen = [(r["a"], r["b"], r["n"]) for r in found if r["what"] == 2]
    if not any(label for _, label, _ in seen):
        return None
    seen.sort()
    x, y = _bits([a for a, _, _ in seen]), np.array([b for _, b, _ in seen])
    weight = np.array([n for _, _, n in seen], np.float64)
    unary = np.zeros((FEATURES + 1, LABELS))
    target = np.eye(LABELS)[y]
    weight = np.sqrt(weight) / np.sqrt(weight).sum()
    for step in range(600):
        z = x @ unary
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        unary -= 2.0 * (x.T @ ((p - target) * weight[:, None]) + 1e-3 * unary)
    # neighbours: a part of the smoothed log odds of their labels
    joint = np.eye(LABELS) + 0.2
    same = other = 1.0
    for r in found:
        if r["what"] == 0:
            joint[r["a"], r["b"]] += r["n"]
            joint[r["b"], r["a"]] += r["n"]
        elif r["what"] == 1 and r["a"] and r["b"]:
            same += r["n"] * (r["a"] == r["b"])
            other += r["n"] * (r["a"] != r["b"])
    joint /= joint.sum()
    side = joint.sum(axis=1)
    near = 0.25 * np.clip(np.log(joint / np.outer(side, side)), -3, 3)
    # skip edges: how often matched mentions that they join are of one kind
    agree = np.clip(1 + np.log(same / other), 2, 5)
    pair = np.stack([near, agree * np.diag([0.5, 1, 1, 1, 1])])
    return Field(unary, pair)


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether a pattern matches, for each document."""
    for batch in common.steps(batches):
        found = []
        for text in common.text_of(batch).to_pylist():
            numbers = [m.span() for m in _NUMBERS.finditer(text)]
            found.append(bool(numbers or "@" in text) and bool(patterns(text, numbers)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.bool_())], names=["doc_id", "matched"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.steps(batches):
        counts: dict[tuple, int] = {}
        for text in common.text_of(batch).to_pylist():
            numbers = [m.span() for m in _NUMBERS.finditer(text)]
            found = mentions(text, numbers, patterns(text, numbers))
            left, right, kind = edges(found)
            joined = [(a, b) for a, b, k in zip(left.tolist(), right.tolist(), kind.tolist(), strict=True) if k]
            # an open mention that is like a matched one is neither: it is what the field decides
            unsure = {x for a, b in joined for x, y in ((a, b), (b, a)) if found.labels[x] < 0 < found.labels[y]}
            labels = [max(0, x) for x in found.labels]
            rows = [(2, f, labels[k]) for k, f in enumerate(found.features) if k not in unsure]
            rows += [(int(k), labels[a], labels[b]) for a, b, k in zip(left, right, kind, strict=True) if not {a, b} & unsure]
            for row in rows:
                counts[row] = counts.get(row, 0) + 1
        if counts:
            what, a, b = zip(*counts, strict=True)
            columns = [pa.array(what, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int32()), pa.array(counts.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["what", "a", "b", "n"])


def find_private(docs: DataFrame, field: Field | None) -> DataFrame:
    """The rows of ``docs`` with ``base`` (the matches of the patterns) and ``spans`` (these and
    the ones the field adds), kind, start and end in code points, by kind and start; columns of
    these names are replaced. Null and empty texts have none. Rows are judged each, whole and on
    their own: nothing is shuffled."""
    kept = docs.drop("base", "spans", "__text")
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches, "__text"):
            found = [private(text, shared.value) for text in common.text_of(batch, "__text").to_pylist()]
            names = [n for n in batch.schema.names if n != "__text"]
            made = [pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in f[i]] for f in found], _SPANS) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *made], names=[*names, "base", "spans"])

    schema = T.StructType([*kept.schema.fields, T.StructField("base", SPANS), T.StructField("spans", SPANS)])
    return kept.withColumn("__text", common.whole_text()).mapInArrow(run, schema)


def written_out(spans: str) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def count(kind: str) -> Column:
    """The number of pattern matches of a kind."""
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def masked(text: str, spans: list[Span]) -> str:
    """The text with <KIND> in place of each span; of spans that overlap, one mark for all."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"<{KINDS[kind].upper()}>"]
        end = max(end, b)
    return "".join(out) + text[end:]


def mask(docs: DataFrame) -> DataFrame:
    """All documents with the same columns and personal data replaced by its kind in ``text``;
    ``n_chars`` follows where the text changed. Null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches):
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            texts = columns["text"].to_pylist()
            changed = {}
            for k, text in enumerate(texts):
                spans = private(text, shared.value)[1] if text else []
                if spans:
                    changed[k] = masked(text, spans)
            if changed:
                columns["text"] = pa.array([changed.get(k, text) for k, text in enumerate(texts)], columns["text"].type)
                if "n_chars" in columns:
                    counts = columns["n_chars"].to_pylist()
                    lengths = [len(changed[k]) if k in changed else n for k, n in enumerate(counts)]
                    columns["n_chars"] = pa.array(lengths, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(run, docs.schema)
