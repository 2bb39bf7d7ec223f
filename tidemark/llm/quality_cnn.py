"""Quality classifier: a convolutional network on bytes, trained and applied with numpy.

A document is a row of overlapping chunks of `CHUNK` bytes, one every `BLOCK` bytes, from its first
byte to its last. A chunk's inputs are the learned embedding of each of its bytes and, as
a second group of channels, how many bytes of each half equal the byte some lag before them, for lags
up to `LAGS`, and the largest of these shares. Learned filters with a rectifier respond to each chunk, the maximum over all
chunks is taken per filter, and a logistic unit combines the maxima into one probability.

The weights are fitted on the driver on at most `TRAIN_ROWS` labelled rows of at most
`TRAIN_BYTES` bytes each, half of each label, chosen by a hash of the id; scoring runs on the
executors over every byte of every text, with memory that doesn't depend on a text's length.

Defined results: a null or empty text is one chunk of zeros and gets that chunk's score. With
labels of one kind, or none, every score is the share of label 1 (one half without labels).
Repeated rows get repeated scores, an empty table an empty result. Other columns than id and
text, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunk_encoder import giving_back, text_slices

BLOCK = 8
CHUNK = 2 * BLOCK
LAGS = 24
DIMS = 6
# Inputs of a block.
WIDTH = BLOCK * DIMS + LAGS + 1
FILTERS = 24
TRAIN_ROWS = 2400
TRAIN_BYTES = 16_384
STEPS = 2000
SAMPLES = 32
SEED = 20
# Blocks whose inputs are held at once: about 60 MB.
SLAB = 1 << 16


@dataclass
class Network:
    embedding: np.ndarray  # 256 x DIMS
    filters: np.ndarray  # 2 halves x WIDTH x FILTERS
    offset: np.ndarray  # FILTERS
    weights: np.ndarray  # FILTERS
    bias: float

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(pooled @ self.weights + self.bias, -30, 30)))


@dataclass
class Prior:
    """What is said without anything to learn from."""

    share: float


def _layout(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """First block of each text, its number of chunks, and all blocks.

    Behind each text follow zeros over at least the longest lag and one chunk.
    """
    chunks = np.maximum(1, -(-(sizes - BLOCK) // BLOCK))
    blocks = chunks + 1 + -(-LAGS // BLOCK)
    ends = np.cumsum(blocks)
    return ends - blocks, chunks, int(blocks.sum())


def _buffer(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([memoryview(t).nbytes for t in texts], dtype=np.int64)
    first, chunks, blocks = _layout(sizes)
    # LAGS zeros in front, so that every byte has bytes before it.
    data = np.zeros(LAGS + blocks * BLOCK, dtype=np.uint8)
    for text, at, n in zip(texts, first.tolist(), sizes.tolist(), strict=True):
        data[LAGS + at * BLOCK : LAGS + at * BLOCK + n] = np.frombuffer(text, dtype=np.uint8)
    return data, first, chunks


def _inputs(data: np.ndarray, a: int, b: int, embedding: np.ndarray) -> np.ndarray:
    """Inputs of the blocks a .. b: embedded bytes, the share of equal bytes per lag, and its maximum."""
    own = data[LAGS + a * BLOCK : LAGS + b * BLOCK]
    out = np.empty((b - a, WIDTH), dtype=np.float32)
    out[:, : BLOCK * DIMS] = embedding[own].reshape(b - a, -1)
    real = own != 0
    for lag in range(1, LAGS + 1):
        equal = (own == data[LAGS + a * BLOCK - lag : LAGS + b * BLOCK - lag]) & real
        out[:, BLOCK * DIMS + lag - 1] = np.bitwise_count(np.packbits(equal))
    shares = out[:, BLOCK * DIMS : -1]
    shares /= BLOCK
    out[:, -1] = shares.max(axis=1)
    return out


def _responses(inputs: np.ndarray, net: Network) -> np.ndarray:
    """Of the chunks that begin at each block but the last."""
    return (inputs @ net.filters[0])[:-1] + (inputs @ net.filters[1])[1:] + net.offset


def pool(texts: list[bytes], net: Network) -> np.ndarray:
    """Largest response of every filter over all chunks of each text."""
    data, first, chunks = _buffer(texts)
    pooled = np.zeros((len(texts), FILTERS), dtype=np.float32)
    last = first + chunks
    blocks = (len(data) - LAGS) // BLOCK
    for a in range(0, blocks - 1, SLAB):
        b = min(a + SLAB, blocks - 1)
        responses = _responses(_inputs(data, a, b + 1, net.embedding), net)
        # Texts with chunks among a .. b.
        own = np.arange(np.searchsorted(last, a, "right"), np.searchsorted(first, b, "left"))
        edges = np.stack([np.maximum(first[own], a) - a, np.minimum(last[own], b) - a], axis=1)
        # Every other segment lies between the chunks of two texts.
        padded = np.concatenate([responses, responses[-1:]])
        highest = np.maximum.reduceat(padded, edges.ravel(), axis=0)[::2] if len(own) else padded[:0]
        pooled[own] = np.maximum(pooled[own], highest)
    return pooled


def fit(texts: list[bytes], labels: np.ndarray, prior: float, steps: int = STEPS) -> Network:
    """Adam on the cross entropy; the gradient of a maximum goes to the chunk that made it.

    Every step takes as many rows of each label, so the bias is moved to the `prior` share of 1.
    """
    rng = np.random.default_rng(SEED)
    net = Network(
        rng.normal(0, 0.5, (256, DIMS)).astype(np.float32),
        rng.normal(0, 0.1, (2, WIDTH, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.3, FILTERS).astype(np.float32),
        0.0,
    )
    parts = [net.embedding, net.filters, net.offset, net.weights, np.zeros(1, np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    net.embedding, net.filters, net.offset, net.weights, bias = parts
    # The rows of each label in turn, in a new order each time round.
    own = [np.nonzero(labels == label)[0] for label in (0, 1)]
    rounds = [-(-steps * SAMPLES // 2 // len(rows)) for rows in own]
    order = [np.concatenate([rng.permutation(rows) for _ in range(n)]) for rows, n in zip(own, rounds, strict=True)]
    for step in range(1, steps + 1):
        rate = 0.01 * (1 - step / steps) + 0.0005
        at = (step - 1) * SAMPLES // 2
        chosen = np.concatenate([rows[at : at + SAMPLES // 2] for rows in order])
        net.bias = float(bias[0])
        gradients = _gradients([texts[i] for i in chosen], labels[chosen], net)
        for p, g, (m, v) in zip(parts, gradients, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.bias = float(bias[0] + np.log(prior / (1 - prior)))
    return net


def _gradients(texts: list[bytes], labels: np.ndarray, net: Network) -> list[np.ndarray]:
    data, first, chunks = _buffer(texts)
    inputs = _inputs(data, 0, (len(data) - LAGS) // BLOCK, net.embedding)
    responses = _responses(inputs, net)
    best = np.stack([a + responses[a : a + n].argmax(axis=0) for a, n in zip(first, chunks, strict=True)])
    pooled = np.maximum(np.take_along_axis(responses, best, axis=0), 0)
    error = (net.probability(pooled) - labels).astype(np.float32) / len(texts)
    back = error[:, None] * net.weights * (pooled > 0)
    flat = best.ravel()
    halves = [inputs[flat], inputs[flat + 1]]
    shape = (*best.shape, -1)
    d_filters = np.stack([np.einsum("df,dfi->if", back, h.reshape(shape)) for h in halves])
    d_embedding = np.zeros_like(net.embedding)
    own = data[LAGS:].reshape(-1, BLOCK)
    for half in (0, 1):
        weights = net.filters[half, : BLOCK * DIMS].T.reshape(FILTERS, BLOCK, DIMS)
        spread = back[:, :, None, None] * weights
        np.add.at(d_embedding, own[flat + half].ravel(), spread.reshape(-1, DIMS))
    decay = 1e-4
    return [
        d_embedding + decay * net.embedding,
        d_filters + decay * net.filters,
        back.sum(axis=0),
        pooled.T @ error + decay * net.weights,
        np.array([error.sum()], np.float32),
    ]


def is_held_out(doc_id: Column) -> Column:
    """A fifth of the ids, by their checksum; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = TRAIN_ROWS,
    max_bytes: int = TRAIN_BYTES,
) -> Network | Prior:
    """Fit on the labelled rows that aren't held out; `rows * max_bytes` bytes at most are collected."""
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    marked = marked.where(F.col("label").isin(0, 1) & ~is_held_out(F.col("id")))
    counts = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return Prior(counts.get(1, 0) / total if total else 0.5)
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = own.where(F.octet_length("text") <= max_bytes)
    # The ids are chosen before their texts are read, so that few texts are moved.
    chosen = [
        marked.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(rows // 2).distinct()
        for label in (0, 1)
    ]
    read = own.join(F.broadcast(chosen[0].unionByName(chosen[1])), "id").orderBy(F.xxhash64("id"), "id", "text")
    sample = [(r["text"].encode(), r["label"]) for r in read.limit(rows).collect()]
    known = np.array([label for _, label in sample], dtype=np.float32)
    if len(set(known.tolist())) < 2:
        return Prior(counts[1] / total)
    return fit([text for text, _ in sample], known, counts[1] / total)


def _scores(texts: pa.Array, model: Network | Prior) -> np.ndarray:
    if isinstance(model, Prior):
        return np.full(len(texts), model.share)
    parts = [np.zeros(0)]
    for _, some in text_slices(texts):
        data = [t.as_buffer() for t in some]
        parts.append(model.probability(pool(data, model).astype(np.float64)))
    return np.concatenate(parts)


def score(docs: DataFrame, model: Network | Prior, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """[id, score] of every row: probability of label 1."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            scores = _scores(rows.column(1), model)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(scores, pa.float64())], names=["id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(apply, "id long, score double")


def keep_good(docs: DataFrame, model: Network | Prior, least: float, text_col: str = "text") -> DataFrame:
    """The rows of `docs` with a score of at least `least`, all columns unchanged."""
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            # Rows go back slice by slice: they lie whole in the worker's memory and in that of the JVM.
            for first, texts in text_slices(rows.column(place)):
                yield rows.slice(first, len(texts)).filter(pa.array(_scores(texts, model) >= least))

    return docs.mapInArrow(giving_back(keep), docs.schema)
