"""Packing token sequences by minimum bin slack."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.llm import common

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)


class Places(dict):
    """Numbers words in the order they are first asked for; ``new`` lists the latest ones."""

    def __init__(self):
        super().__init__({"": 0})
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        place = self[word] = len(self)
        return place


class WordTokenizer:
    """Token ids of whole texts, each distinct word encoded once.

    The vocabulary drops white space and no token, normalisation or rule reaches across a space
    or line feed, so a text's ids are those of its words, one after the other. Nor does a rule
    reach from a letter or digit to a mark of ``MARKS`` after it, so a word without its last
    marks and the marks are encoded apart; what is then ASCII letters needs the merges alone.
    What counts is the last character as the tokenizer normalises it: some letters become a letter
    and a combining sign, and signs and marks are one piece.
    """

    #: Words and ids kept, of the words first met: frequent words come early.
    KEEP, KEEP_IDS = 500_000, 3_000_000
    MARKS = ",.;:!?*%$&#|"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.model = self.encoder.model
        self.place, self.marks = Places(), {"": []}
        self.ends_word: dict[str, bool] = {}
        self.flat, self.ends = np.zeros(0, np.uint32), np.zeros(2, np.int64)

    def parts_from_marks(self, last: str) -> bool:
        """Whether a word that ends in this character and marks after it are encoded apart."""
        known = self.ends_word.get(last)
        if known is None:
            form = self.encoder.normalizer.normalize_str(last) if self.encoder.normalizer else last
            known = self.ends_word[last] = last.isalnum() and form[-1:].isalnum()
        return known

    def ids_of(self, word: str) -> list[int]:
        head = word.rstrip(self.MARKS)
        if head and not self.parts_from_marks(head[-1]):
            return self.encoder.encode(word, add_special_tokens=False).ids
        tail = word[len(head) :]
        last = self.marks.get(tail)
        if last is None:
            last = self.encoder.encode(tail, add_special_tokens=False).ids
            if len(self.marks) < 10_000:
                self.marks[tail] = last
        if head.isascii() and head.isalpha():
            return [t.id for t in self.model.tokenize(head.lower())] + last
        return self.encoder.encode(head, add_special_tokens=False).ids + last

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the offsets of the texts."""
        split = [text.replace("\n", " ").split(" ") for text in texts]
        per_row = np.fromiter(map(len, split), np.int64, len(split))
        words = np.fromiter(map(self.place.__getitem__, chain.from_iterable(split)), np.int64, int(per_row.sum()))
        new, self.place.new = self.place.new, []
        flat, ends = self.flat, self.ends
        if new:
            made = [self.ids_of(w) for w in new]
            counts = np.fromiter(map(len, made), np.int64, len(made))
            flat = np.concatenate([flat, np.fromiter(chain.from_iterable(made), np.uint32, int(counts.sum()))])
            ends = np.concatenate([ends, ends[-1] + np.cumsum(counts)])
            if len(self.place) <= self.KEEP and len(flat) <= self.KEEP_IDS:
                self.flat, self.ends = flat, ends
            else:
                for w in new:
                    del self.place[w]
        starts = ends[words]
        counts = ends[words + 1] - starts
        stops = np.cumsum(counts)
        out = flat[np.repeat(starts - (stops - counts), counts) + np.arange(stops[-1] if len(stops) else 0)]
        return out, np.concatenate([[0], stops[np.cumsum(per_row) - 1]]).astype(np.int64)


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """Of a multiset of lengths (length -> count), the part whose sum comes closest to ``room``
    without passing it. Sums are bits of one integer; the counts are traced back through the
    sums that were possible before each length came in."""
    mask, goal = (1 << (room + 1)) - 1, 1 << room
    possible, before = 1, []
    for length in sorted((x for x in counts if x <= room and counts[x]), reverse=True):
        before.append((length, possible))
        grown, left = possible, min(counts[length], room // length)
        span = 1
        while left:  # 1, 2, 4, ... copies at a time, and the rest
            take = min(span, left)
            grown |= (grown << (take * length)) & mask
            left -= take
            span *= 2
        possible = grown
        if possible & goal:
            break
    target, taken = possible.bit_length() - 1, {}
    for length, earlier in reversed(before):
        used = 0
        while not (earlier >> target) & 1:
            target -= length
            used += 1
        if used:
            taken[length] = used
    return taken


class Packer:
    """Fills sequences of ``size`` tokens from whole documents, in one task.

    Full windows of a document are sequences of their own; what remains of each document waits
    in a pool, which is bounded. Bins that fill exactly are closed first. Where the pool is full, or
    no more rows come, a bin that no part of the pool fills is closed by cutting the next
    remainder; what is left over in the end goes out in sequences whose lengths are powers of two,
    without padding.
    """

    def __init__(self, size: int, pool: int, first_id: int):
        self.size, self.most, self.next = size, pool, first_id
        self.pool: dict[int, list[tuple]] = {}
        self.waiting, self.out = 0, []

    def put(self, doc_id, ids: np.ndarray) -> None:
        n = len(ids)
        full = n - n % self.size
        for start in range(0, full, self.size):
            self.close([(doc_id, start, ids[start : start + self.size], n)])
        if full < n:
            self.hold((doc_id, full, ids[full:].copy(), n))
        if self.waiting >= self.most:
            self.drain(self.most // 4)

    def hold(self, piece: tuple) -> None:
        self.pool.setdefault(len(piece[2]), []).append(piece)
        self.waiting += 1

    def take(self, length: int) -> tuple:
        pieces = self.pool[length]
        piece = pieces.pop()
        if not pieces:
            del self.pool[length]
        self.waiting -= 1
        return piece

    def close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc_id, start, ids, n in pieces:
            self.out.append((doc_id, start, len(ids), ids.astype("<u4").tobytes(), n, self.next, at))
            at += len(ids)
        self.next += 1

    def drain(self, keep: int) -> None:
        """Closes bins until at most ``keep`` remainders wait; 0 empties the pool."""
        while self.waiting > keep:
            largest = max(self.pool)
            bin_, room = [self.take(largest)], self.size - largest
            for length, count in best_fill({x: len(p) for x, p in self.pool.items()}, room).items():
                bin_ += [self.take(length) for _ in range(count)]
                room -= length * count
            if room and self.waiting:  # no part of the pool fills it: cut one that is too long
                doc_id, start, ids, n = self.take(min(x for x in self.pool if x > room))
                bin_.append((doc_id, start, ids[:room], n))
                self.hold((doc_id, start + room, ids[room:], n))
                room = 0
            if room:
                self.split(bin_)
            else:
                self.close(bin_)

    def split(self, pieces: list[tuple]) -> None:
        total = sum(len(p[2]) for p in pieces)
        for bit in reversed(range(total.bit_length())):
            if total >> bit & 1:
                room, part = 1 << bit, []
                while room:
                    doc_id, start, ids, n = pieces.pop(0)
                    part.append((doc_id, start, ids[:room], n))
                    if len(ids) > room:
                        pieces.insert(0, (doc_id, start + room, ids[room:], n))
                    room -= len(part[-1][2])
                self.close(part)

    def flush(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.out) >= least and self.out:
            columns = list(zip(*self.out, strict=True))
            self.out = []
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=PIECES.fieldNames())


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One for each worker process and file."""
    if path not in _tokenizers:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def pack(docs: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 1, pool: int = 1024) -> DataFrame:
    """Cuts every document (its token ids and ``end_id``) into pieces and packs these into
    sequences of ``size`` tokens by minimum bin slack.

    One row per piece, with its ids as little-endian 32-bit numbers. Each task packs its own
    rows as they come, holding at most ``pool`` remainders, so there is no shuffle and no group;
    the number of a sequence starts with the number of its partition, so a task that runs again
    gives the same rows. A null or empty text is the one token ``end_id``; repeated rows, null
    ids included, are packed each; an empty table gives no rows; other columns are not read.
    ``size`` must be a power of two of at least 2.
    """
    if size < 2 or size & (size - 1):
        raise ValueError("size must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = tokenizer(vocabulary)
        packer = Packer(size, pool, TaskContext.get().partitionId() << 40)
        for batch in common.steps(batches):
            keys = batch.column(0).to_pylist()
            ids, offsets = words.encode(common.text_of(batch).to_pylist())
            for row, key in enumerate(keys):
                own = ids[offsets[row] : offsets[row + 1]]
                packer.put(key, np.append(own, np.uint32(end_id)))
            yield from packer.flush(2000)
        packer.drain(0)
        yield from packer.flush(1)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("text"))
    return rows.mapInArrow(run, PIECES)
