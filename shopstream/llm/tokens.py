"""Token counts by a linear longest-match automaton."""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm import common


def pieces_of(path: str) -> list[bytes]:
    """The byte strings of a vocabulary file with a base64 piece and its rank on each line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class Automaton:
    """A trie of the vocabulary with failure links.

    From a node whose text cannot go on with the next byte, the longest-match pieces of that
    text are popped up to the point where what remains is again a node: ``link`` is that node
    and ``popped`` the number of pieces, both known beforehand. A text is read once from left to
    right, in time linear in its bytes, and no piece is ever built. A byte that no piece begins
    with counts as one piece.
    """

    def __init__(self, pieces: list[bytes]):
        self.next: list[dict[int, int]] = [{}]
        ends = set()
        for piece in [*(bytes([b]) for b in range(256)), *pieces]:
            node = 0
            for byte in piece:
                to = self.next[node].get(byte)
                if to is None:
                    to = self.next[node][byte] = len(self.next)
                    self.next.append({})
                node = to
            ends.add(node)
        ends.discard(0)
        self.link, self.popped = [0] * len(self.next), [0] * len(self.next)
        queue = deque([0])
        while queue:
            node = queue.popleft()
            for byte, to in self.next[node].items():
                queue.append(to)
                if to in ends:
                    self.popped[to] = 1  # the whole text is a piece; go on from the start
                    continue
                z, n = self.link[node], self.popped[node]
                while byte not in self.next[z]:
                    n += self.popped[z]
                    z = self.link[z]
                self.link[to], self.popped[to] = self.next[z][byte], n

    def count(self, text: bytes) -> int:
        """The number of pieces that greedy longest matching cuts the text into."""
        step, link, popped = self.next, self.link, self.popped
        node = n = 0
        for byte in text:
            to = step[node].get(byte)
            while to is None:
                n += popped[node]
                node = link[node]
                to = step[node].get(byte)
            node = to
        while node:
            n += popped[node]
            node = link[node]
        return n


class Counts(dict):
    """Piece counts of words, each worked out once; the words first met are kept."""

    KEEP = 300_000

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(b" " + word)
        if len(self) < self.KEEP and len(word) < 64:
            self[word] = n
        return n


_counts: dict[str, Counts] = {}


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_words and n_tokens of every document.

    A word is a run of anything but ASCII white space; with a space before it, it is cut greedily
    into the longest pieces of the vocabulary, which holds the spaces that begin words. Null and
    empty texts have no words; repeated rows are counted each; other columns are not read.
    Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _counts:
            _counts[vocabulary] = Counts(Automaton(pieces_of(vocabulary)))
        known = _counts[vocabulary].__getitem__
        for batch in common.steps(batches):
            data, offsets = common.utf8(common.text_of(batch))
            whole = data.tobytes()
            words = [whole[a:b].split() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            columns = [batch.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array([sum(map(known, w)) for w in words], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_tokens long")
