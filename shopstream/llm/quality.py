"""Quality scores by a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.llm import common

#: Bytes of a chunk and from one chunk to the next: each byte lies in two chunks.
CHUNK, STRIDE = 32, 16
#: Numbers that stand for a byte; filters; distances at which a chunk is compared with the bytes
#: before, one input each: the share of its bytes that repeat the byte so far back, and one more
#: for the largest share.
WIDTH, FILTERS, LAGS = 4, 24, range(2, 26)
#: Labelled rows to learn from, for each label, and the longest text among them.
SAMPLE_ROWS, SAMPLE_BYTES = 1500, 8192
#: Scores from which a text counts as good.
GOOD = 0.3


@dataclass
class Network:
    """Byte vectors, filters over chunks, and the weights of the filters' maxima."""

    bytes_: np.ndarray  # 256 x WIDTH
    filters: np.ndarray  # (CHUNK * WIDTH + lags + 1) x FILTERS
    bias: np.ndarray
    out: np.ndarray
    out_bias: float


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of every chunk of all rows, the shares of repeated bytes, and the offsets of
    the rows in both. A chunk begins every 16 bytes; bytes past the end of a text are zeros and
    an empty text is one chunk of zeros."""
    sizes = np.diff(offsets)
    counts = np.maximum(1, -(-np.maximum(sizes - (CHUNK - STRIDE), 1) // STRIDE))
    ends = np.cumsum(counts)
    # each row at a place of its own, a whole number of strides, with room for the last chunk
    rows = (ends - counts + np.arange(len(sizes))) * STRIDE
    padded = np.zeros(int(ends[-1] + len(sizes)) * STRIDE + CHUNK, np.uint8)
    places = np.arange(len(data)) + np.repeat(rows - offsets[:-1], sizes)
    padded[places] = data
    first = np.repeat(rows - (ends - counts) * STRIDE, counts) + np.arange(ends[-1]) * STRIDE
    view = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STRIDE]
    blocks = len(padded) // STRIDE
    shares = np.empty((blocks, len(LAGS)), np.float32)
    # bytes before each one in its own row, which alone it is compared with
    before = np.zeros(blocks * STRIDE, np.uint8)
    before[places] = np.minimum(np.arange(len(data)) - np.repeat(offsets[:-1] - offsets[0], sizes), 255)
    before[padded[: blocks * STRIDE] == 0] = 0
    for k, lag in enumerate(LAGS):
        same = np.zeros(blocks * STRIDE, bool)
        same[lag:] = (padded[lag : blocks * STRIDE] == padded[: blocks * STRIDE - lag]) & (before[lag:] >= lag)
        shares[:, k] = np.add.reduceat(same.view(np.uint8), np.arange(0, blocks * STRIDE, STRIDE)) / np.float32(STRIDE)
    at = first // STRIDE
    both = (shares[at] + shares[np.minimum(at + 1, blocks - 1)]) / 2
    both = np.concatenate([both, both.max(axis=1, keepdims=True)], axis=1)
    return view[at], both, np.concatenate([[0], ends])


def inputs(net: Network, bytes_: np.ndarray, shares: np.ndarray) -> np.ndarray:
    return np.concatenate([net.bytes_[bytes_].reshape(len(bytes_), -1), shares], axis=1)


def pooled(net: Network, bytes_: np.ndarray, shares: np.ndarray, offsets: np.ndarray, step: int = 16384) -> np.ndarray:
    """The largest response of every filter over the chunks of each row."""
    out = np.empty((len(offsets) - 1, net.filters.shape[1]), np.float32)
    responses = np.empty((len(bytes_), net.filters.shape[1]), np.float32)
    for a in range(0, len(bytes_), step):
        responses[a : a + step] = inputs(net, bytes_[a : a + step], shares[a : a + step]) @ net.filters
    np.maximum.reduceat(responses, offsets[:-1], axis=0, out=out)
    return out


def score(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The probability of the label 1 for each row, to six digits: products in single precision
    differ after them by what else is in the batch."""
    hidden = np.tanh(pooled(net, *chunks(data, offsets)) + net.bias)
    return np.round(1 / (1 + np.exp(-np.clip((hidden @ net.out + net.out_bias).astype(np.float64), -30, 30))), 6)


def train(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, epochs: int = 14, seed: int = 7) -> Network:
    """Adam on the weighted log loss; the maximum passes its gradient to the chunk it came from."""
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.5, (256, WIDTH)).astype(np.float32),
        rng.normal(0, 0.15, (CHUNK * WIDTH + len(LAGS) + 1, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.3, FILTERS).astype(np.float32),
        0.0,
    )
    net.bytes_[0] = 0
    moments: dict[str, list] = {}
    t = 0
    size = 64
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 0.0005
        order = rng.permutation(len(texts))
        for a in range(0, len(order), size):
            rows = order[a : a + size]
            lengths = np.array([len(texts[r]) for r in rows])
            data = np.frombuffer(b"".join(texts[r] for r in rows), np.uint8)
            made, shares, offsets = chunks(data, np.concatenate([[0], np.cumsum(lengths)]))
            x = inputs(net, made, shares)
            responses = x @ net.filters
            peak = np.maximum.reduceat(responses, offsets[:-1], axis=0)
            hidden = np.tanh(peak + net.bias)
            p = 1 / (1 + np.exp(-(hidden @ net.out + net.out_bias)))
            delta = ((p - labels[rows]) * weights[rows] / weights[rows].sum()).astype(np.float32)
            grown = delta[:, None] * net.out * (1 - hidden**2)
            # the chunk with the maximum, for each row and filter
            best = np.empty((len(rows), FILTERS), np.int64)
            for k in range(len(rows)):
                best[k] = responses[offsets[k] : offsets[k + 1]].argmax(0) + offsets[k]
            picked = x[best]  # rows x filters x inputs
            gradients = {
                "filters": np.einsum("rfi,rf->if", picked, grown),
                "bias": grown.sum(0),
                "out": hidden.T @ delta,
                "out_bias": delta.sum(),
            }
            back = (grown[:, :, None] * net.filters.T[None, :, : CHUNK * WIDTH]).reshape(-1, WIDTH)
            into = np.zeros_like(net.bytes_)
            np.add.at(into, made[best].reshape(-1), back)
            into[0] = 0
            gradients["bytes_"] = into
            t += 1
            for name, g in gradients.items():
                m, v = moments.setdefault(name, [np.zeros_like(g), np.zeros_like(g)])
                m = 0.9 * m + 0.1 * g
                v = 0.999 * v + 0.001 * g * g
                moments[name] = [m, v]
                change = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
                value = getattr(net, name)
                setattr(net, name, value - (change.astype(np.float32) if isinstance(value, np.ndarray) else float(change)))
    return net


def held_out() -> Column:
    """Whether a document is kept from learning: the checksum of its id is divisible by five."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, longest: int = SAMPLE_BYTES) -> DataFrame:
    """At most ``rows`` labelled documents of each label, none of them held out, those with the
    smallest hashes of their ids, with the number of documents that have the label. Texts of
    more than ``longest`` bytes are not learned from. A document with several labels has their
    majority, and is left out where they tie; so is one whose label or id is null."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    share = F.avg(F.col("quality").cast("double"))
    known = known.groupBy("doc_id").agg(share.alias("share")).filter("share <> 0.5")
    known = known.select("doc_id", (F.col("share") > 0.5).cast("int").alias("label"))
    totals = known.groupBy("label").agg(F.count("*").alias("total"))
    drawn = F.xxhash64(F.col("doc_id").cast("string"))
    # twice as many ids as wanted: some texts are too long. Both limits bound what is broadcast
    picked = [known.filter(F.col("label") == k).orderBy(drawn, "doc_id").limit(2 * rows) for k in (0, 1)]
    ids = F.broadcast(picked[0].unionAll(picked[1]))
    own = docs.select("doc_id", common.whole_text().alias("text")).filter(F.octet_length("text") <= longest)
    found = own.join(ids, "doc_id")
    best = [found.filter(F.col("label") == k).orderBy(drawn, "doc_id", "text").limit(rows) for k in (0, 1)]
    return best[0].unionAll(best[1]).join(F.broadcast(totals), "label")


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Network | None:
    """A network from a bounded sample, or None where there is nothing to learn from. The labels
    weigh as much as they do in the whole table."""
    found = sample(docs, labels, rows).select("text", "label", "total").collect()
    labels_ = np.array([r["label"] for r in found], np.float32)
    if not found or labels_.min() == labels_.max():
        return None
    counts = {k: int((labels_ == k).sum()) for k in (0, 1)}
    weights = np.array([r["total"] / counts[r["label"]] for r in found], np.float32)
    return train([r["text"].encode() for r in found], labels_, weights / weights.mean())


def scored(docs: DataFrame, net: Network | None, keep: Column | None = None) -> DataFrame:
    """The rows of ``docs`` with a column ``score`` in place of any of that name, for the whole
    text of each: 0 to 1, higher where label 1 is likelier. Null texts score as empty ones, and
    all score 0.5 without a network. Nothing is shuffled; a task holds a few MB of text at a
    time, or one text."""
    model = docs.sparkSession.sparkContext.broadcast(net)
    kept = docs.drop("score", "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches, "__text", 512 << 10):
            own = model.value
            data, offsets = common.utf8(common.text_of(batch, "__text"))
            values = np.full(batch.num_rows, 0.5) if own is None else score(own, data, offsets)
            names = [n for n in batch.schema.names if n != "__text"]
            columns = [*(batch.column(n) for n in names), pa.array(values, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "score"])

    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])
    return kept.withColumn("__text", common.whole_text()).mapInArrow(run, schema)


def good_documents(docs: DataFrame, labels: DataFrame, least: float = GOOD) -> DataFrame:
    """The documents that score at least ``least``, with the same columns."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches, limit=512 << 10):
            if model.value is not None:
                batch = batch.filter(pa.array(score(model.value, *common.utf8(common.text_of(batch))) >= least))
            yield batch

    return docs.mapInArrow(run, docs.schema)
