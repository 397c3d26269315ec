"""Shared pieces: tables in the shared folder, Arrow batches, vectorised word hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one step inside a task works on; a longer single text is one step.
STEP_BYTES = 2 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a fresh local one only where
    that is unset and Spark runs inside one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def written(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """The rows as a table in the shared folder: lineage ends here, a lost executor costs nothing,
    and what was numbered or drawn stays as it is."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column without nulls, and the offsets of its rows."""
    wide = isinstance(column, pa.LargeStringArray | pa.LargeBinaryArray)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if column.buffers()[2] is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(column.buffers()[2], np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut by rows so that each piece has about ``limit`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(text_of(batch, text))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last
    pa.default_memory_pool().release_unused()  # the worker lives on


def text_of(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """A text column, or a text in a column of rows (row.text), empty where it is null."""
    outer, _, inner = name.partition(".")
    column = batch.column(batch.schema.get_field_index(outer))
    column = column.field(inner) if inner else column
    return column.fill_null("") if column.null_count else column


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draws(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE = draws(256, 11)
_STEP = int(draws(1, 23)[0]) | 1


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Alphabet:
    """Which bytes make words, and as which byte they count."""

    def __init__(self, is_word: np.ndarray, fold: np.ndarray):
        self.is_word, self.fold = is_word, fold


def _fold() -> np.ndarray:
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    return fold


def _spaced() -> Alphabet:
    is_word = np.ones(256, bool)
    is_word[[0x20, *range(0x09, 0x0E)]] = False
    return Alphabet(is_word, _fold())


def _alnum() -> Alphabet:
    is_word = np.zeros(256, bool)
    is_word[48:58] = is_word[65:91] = is_word[97:123] = is_word[128:] = True
    return Alphabet(is_word, _fold())


#: Runs of anything but ASCII white space; runs of ASCII letters and digits and of what is not
#: ASCII. Both with A-Z in lower case. In UTF-8 the bytes of other characters are 0x80 and up.
SPACED, ALNUM = _spaced(), _alnum()


def words(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word of all rows, and the offsets of the rows in that list."""
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    inside = alphabet.is_word[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[firsts] = inside[firsts]
    starts = np.flatnonzero(opens)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    letters = alphabet.fold[data[inside]]
    # the place of each word among the letters: letters before its start
    places = (np.cumsum(inside, dtype=np.int64))[starts] - 1
    lengths = np.diff(places, append=len(letters))
    within = np.arange(len(letters), dtype=np.int64) - np.repeat(places, lengths)
    values = _BYTE[letters] * _powers(int(lengths.max()))[within]
    hashes = mix(np.add.reduceat(values, places) + lengths.astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each k consecutive words, across row ends too: the caller leaves those out."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j, factor in enumerate(draws(k, 37) | np.uint64(1)):
        out += hashes[j : j + n] * factor
    return mix(out)
