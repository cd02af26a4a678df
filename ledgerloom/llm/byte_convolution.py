"""Quality classifier: a byte-level convolutional network in numpy.

A text is its UTF-8 bytes. Filters of ``TAPS`` bytes slide over it two bytes at a time; each sees the bytes and
whether the text repeats itself there (the same four bytes at one of ``LAGS`` before). Responses
below zero are cut, averaged over overlapping chunks of ``2 * BLOCK`` steps, and the highest
average over all chunks of the whole document - the max pool - goes with the other filters' into one
logistic unit. Long documents are read in pieces that overlap by half a chunk, so memory is bounded
and every byte counts.

The network is fitted on the driver, on at most ``TRAIN_ROWS`` labelled texts of at most ``TRAIN_BYTES`` bytes each
(those with the lowest digest of their id, so the sample does not depend on partitions), with fixed seeds.

NULL and empty texts have no response of any filter; their score is that of the logistic unit alone. Without labels,
or with only one label, the fitted network gives that label's share (0.5 without any). A score depends on the text alone: rows may
repeat, ids may be NULL or tie, and extra columns don't matter. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, read, seeded_hash

TAPS = 6
FILTERS = 16
BLOCK = 16
LAGS = range(2, 25)
TRAIN_ROWS = 3000
TRAIN_BYTES = 60_000
EPOCHS = 10
BATCH = 32
THRESHOLD = 0.3
#: Steps of a long text that are worked on at a time.
PIECE = 4096 * BLOCK


@dataclass
class Network:
    taps: np.ndarray  # TAPS x 256 x FILTERS
    repeat: np.ndarray  # FILTERS: response to a repeat
    offset: np.ndarray
    weight: np.ndarray  # of each filter's maximum in the logistic unit
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.taps, self.repeat, self.offset, self.weight, self.bias]


def repeats(data: np.ndarray) -> np.ndarray:
    """Whether the four bytes from each position stood at one of the lags before it."""
    n = len(data) - 3
    four = data[:n].astype(np.uint32)
    for k in (1, 2, 3):
        four |= data[k : n + k].astype(np.uint32) << np.uint32(8 * k)
    found = np.zeros(n, bool)
    for lag in LAGS:
        if lag < n:
            found[lag:] |= four[lag:] == four[:-lag]
    return found


def responses(net: Network, data: np.ndarray) -> np.ndarray:
    """Filter responses, one row per step, of bytes padded by ``padded``."""
    steps = (len(data) - TAPS) // 2 + 1
    out = net.offset + np.outer(repeats(data)[: 2 * steps : 2], net.repeat).astype(np.float32)
    for k in range(TAPS):
        out += net.taps[k].take(data[k : k + 2 * steps : 2], axis=0)
    return np.maximum(out, 0, out=out)


def chunk_means(rows: np.ndarray) -> np.ndarray:
    """Averages over overlapping chunks of two blocks; a short text is one chunk."""
    starts = np.arange(0, len(rows), BLOCK)
    blocks = np.add.reduceat(rows, starts, axis=0)
    if len(blocks) == 1:
        return blocks / (2 * BLOCK)
    return (blocks[:-1] + blocks[1:]) / (2 * BLOCK)


def padded(text: str | None) -> np.ndarray:
    """The text's bytes, with zeros up to a length that steps of two cover to the last byte."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return np.frombuffer(raw + bytes(max(0, TAPS + 2 - len(raw)) or len(raw) % 2), np.uint8)


def pooled(net: Network, text: str | None) -> np.ndarray:
    """The highest chunk average of each filter."""
    if not text:
        return np.zeros(FILTERS, np.float32)
    data, best = padded(text), np.zeros(FILTERS, np.float32)
    # Pieces overlap by one block of steps and, for the repeats, by the largest lag.
    for at in range(0, len(data), 2 * PIECE):
        low = max(0, at - 2 * BLOCK - 2 * BLOCK)
        piece = data[low : at + 2 * PIECE + TAPS]
        if len(piece) >= TAPS:
            best = np.maximum(best, chunk_means(responses(net, piece)).max(axis=0))
    return best


def probability(net: Network, text: str | None) -> float:
    return float(1 / (1 + np.exp(-(pooled(net, text) @ net.weight + net.bias[0]))))


def gradients(net: Network, data: np.ndarray, label: int, sums: list[np.ndarray]) -> float:
    """Add one text's gradients of the log loss to ``sums``; returns the loss."""
    rows = responses(net, data)
    means = chunk_means(rows)
    at = means.argmax(axis=0)
    top = means[at, np.arange(FILTERS)]
    p = 1 / (1 + np.exp(-(top @ net.weight + net.bias[0])))
    error = p - label
    sums[3] += error * top
    sums[4] += error
    # Steps of each filter's best chunk, where its response is above zero.
    steps = at[:, None] * BLOCK + np.arange(2 * BLOCK)
    inside = steps < len(rows)
    steps = np.minimum(steps, len(rows) - 1)
    kernels = np.arange(FILTERS)[:, None]
    pull = np.where(inside & (rows[steps, kernels] > 0), (error * net.weight / (2 * BLOCK))[:, None], 0)
    sums[2] += pull.sum(axis=1)
    sums[1] += (pull * repeats(data)[2 * steps]).sum(axis=1)
    for k in range(TAPS):
        np.add.at(sums[0][k], (data[2 * steps + k], np.broadcast_to(kernels, steps.shape)), pull)
    return float(-np.log(max(p if label else 1 - p, 1e-9)))


def fit(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Adam on the log loss, in seeded random order."""
    draw = np.random.default_rng(seed)
    net = Network(
        draw.normal(0, 0.3, (TAPS, 256, FILTERS)).astype(np.float32),
        draw.normal(0, 0.3, FILTERS).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        draw.normal(0, 0.5, FILTERS).astype(np.float32),
        np.zeros(1, np.float32),
    )
    share = float(np.mean(labels)) if labels else 0.5
    if not labels or share in (0, 1):
        net.weight[:] = 0
        net.bias[:] = 0 if not labels else 6 * (1 if share else -1)
        return net
    net.bias[:] = np.log(share / (1 - share))
    data = [padded(t) for t in texts]
    first, second = ([np.zeros_like(p, dtype=np.float32) for p in net.parameters()] for _ in range(2))
    step = 0
    for epoch in range(epochs):
        rate = 0.02 * 0.5 ** (epoch / 3)
        order = draw.permutation(len(data))
        for begin in range(0, len(order), BATCH):
            sums = [np.zeros_like(p, dtype=np.float32) for p in net.parameters()]
            chosen = order[begin : begin + BATCH]
            for i in chosen:
                gradients(net, data[i], labels[i], sums)
            step += 1
            for p, g, m, v in zip(net.parameters(), sums, first, second, strict=True):
                g /= len(chosen)
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def training_sample(
    df: DataFrame, labels: DataFrame, row_id: str, text: str, label: str, rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES
) -> tuple[list[str], list[int]]:
    """The texts of the ``rows`` labels whose id has the lowest digest, without NULL, empty and longer texts."""
    usable = labels.where(F.col(label).isNotNull())
    drawn = usable.select(row_id, F.col(label).cast("int").alias("_label"), seeded_hash("sample", row_id).alias("_digest"))
    drawn = drawn.orderBy("_digest", "_label").limit(rows)
    texts = df.where((F.octet_length(text) > 0) & (F.octet_length(text) <= most_bytes)).select(row_id, F.col(text).alias("_text"))
    # The sample is bounded; rows that share an id must not lift that bound.
    found = texts.join(drawn, row_id).orderBy("_digest", "_label", "_text").limit(rows).select("_text", "_label").collect()
    return [r[0] for r in found], [r[1] for r in found]


def quality_score(text: Column, net: Network) -> Column:
    """The probability of label 1 for a text column."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([probability(net, t.as_py()) for t in texts], pa.float64())

    return scored(text)


def op4_byte_convolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    # Rows without an id are not held out; they have no label either.
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out)
    net = fit(*training_sample(bounded(documents), labels, "doc_id", "text", "quality"))
    scored = documents.select("doc_id", held_out.alias("held_out"), quality_score(F.col("text"), net).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int"))
