"""Quality: a byte-level convolutional network in numpy.

Learned filters run over all bytes of a document, cut into chunks that overlap by the
filters' width less one, so that every window lies in one chunk. Each filter's activation
is max-pooled per chunk; the mean, maximum and minimum over the chunks of a document feed a
small dense layer that gives one probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.samples import labelled_sample

WIDTH = 6
FILTERS = 16
HIDDEN = 16
CHUNK = 256
MAX_ROWS = 4000
MAX_BYTES = 24_000_000
# Bytes of one text that are in memory as activations at a time; a multiple of CHUNK.
SPAN = 1 << 16


@dataclass
class ByteNetwork:
    """Filters (WIDTH x 256 x FILTERS), their biases and the dense layers."""

    kernel: np.ndarray
    bias: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: float

    def __post_init__(self):
        self._pairs = None

    def __getstate__(self):
        return {**self.__dict__, "_pairs": None}

    def pairs(self) -> np.ndarray:
        """Filter responses to each pair of bytes: half as many lookups as single bytes."""
        if self._pairs is None:
            k = self.kernel.astype(np.float32)
            self._pairs = np.stack(
                [(k[j][:, None, :] + k[j + 1][None, :, :]).reshape(65536, -1) for j in range(0, WIDTH, 2)]
            )
        return self._pairs

    def pooled(self, data: bytes) -> np.ndarray:
        """Max-pooled activations of each chunk of a text, at least one chunk."""
        raw = np.frombuffer(data, np.uint8)
        if len(raw) < WIDTH:
            raw = np.concatenate([raw, np.zeros(WIDTH - len(raw), np.uint8)])
        tables, out = self.pairs(), []
        for low in range(0, len(raw) - WIDTH + 1, SPAN):
            part = raw[low : low + SPAN + WIDTH - 1]
            pair = part[:-1].astype(np.int32) << 8 | part[1:]
            n = len(part) - WIDTH + 1
            act = tables[0].take(pair[:n], axis=0)
            for j in range(1, WIDTH // 2):
                act += tables[j].take(pair[2 * j : 2 * j + n], axis=0)
            out.append(np.maximum.reduceat(act, np.arange(0, n, CHUNK), axis=0))
        return np.maximum(np.concatenate(out) + self.bias.astype(np.float32), 0)

    def probability(self, data: bytes) -> float:
        chunks = self.pooled(data)
        joined = np.concatenate([chunks.mean(axis=0), chunks.max(axis=0), chunks.min(axis=0)])
        hidden = np.maximum(joined @ self.inner + self.inner_bias, 0)
        return float(1 / (1 + np.exp(-np.clip(hidden @ self.outer + self.outer_bias, -50, 50))))


def held_out() -> Column:
    """Rows that no label is learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = MAX_ROWS,
    max_bytes: int = MAX_BYTES,
    epochs: int = 6,
    seed: int = 3,
) -> ByteNetwork:
    """Fit on at most ``max_rows`` labelled texts of at most ``max_bytes`` in all, whole ones.

    Held-out rows are never read. Without labels of both kinds every text scores alike.
    """
    sample = labelled_sample(docs, labels, "quality", max_rows, ~held_out())
    sized = sample.select("doc_id", F.octet_length("text").alias("size")).orderBy("doc_id").collect()
    order = np.random.default_rng(seed).permutation(len(sized))
    total, chosen = 0, []
    for i in order:
        if total + sized[i]["size"] <= max_bytes:
            total += sized[i]["size"]
            chosen.append((sized[i]["doc_id"],))
    spark = docs.sparkSession
    picked = F.broadcast(spark.createDataFrame(chosen, "doc_id long"))
    rows = sample.join(picked, "doc_id").orderBy("doc_id").collect() if chosen else []
    return train([r["text"].encode() for r in rows], np.array([r["label"] for r in rows], float), epochs, seed)


def train(texts: list[bytes], label: np.ndarray, epochs: int, seed: int) -> ByteNetwork:
    """Adam, one document at a time in batches of 16; a pooled maximum passes its slope to its window."""
    draw = np.random.default_rng(seed)
    net = ByteNetwork(
        draw.normal(0, 0.3, (WIDTH, 256, FILTERS)),
        np.zeros(FILTERS),
        draw.normal(0, (2 / (3 * FILTERS)) ** 0.5, (3 * FILTERS, HIDDEN)),
        np.zeros(HIDDEN),
        draw.normal(0, (2 / HIDDEN) ** 0.5, HIDDEN),
        0.0,
    )
    if not len(label) or label.min() == label.max():
        return net
    share = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    names = ("kernel", "bias", "inner", "inner_bias", "outer", "outer_bias")
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    step = 0
    for _ in range(epochs):
        order = draw.permutation(len(texts))
        for low in range(0, len(order), 16):
            slope = {n: np.zeros_like(getattr(net, n)) for n in names}
            batch = order[low : low + 16]
            kernel32 = net.kernel.astype(np.float32)
            for i in batch:
                _backward(net, kernel32, texts[i], label[i], share[i] / len(batch), slope)
            step += 1
            for n in names:
                first[n] = 0.9 * first[n] + 0.1 * slope[n]
                second[n] = 0.999 * second[n] + 0.001 * slope[n] ** 2
                move = 0.004 * first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                setattr(net, n, getattr(net, n) - move)
    net._pairs = None
    return net


def _backward(net: ByteNetwork, kernel32: np.ndarray, data: bytes, label: float, share: float, slope: dict) -> None:
    raw = np.frombuffer(data, np.uint8)
    if len(raw) < WIDTH:
        raw = np.concatenate([raw, np.zeros(WIDTH - len(raw), np.uint8)])
    n = len(raw) - WIDTH + 1
    act = kernel32[0].take(raw[:n], axis=0)
    for j in range(1, WIDTH):
        act += kernel32[j].take(raw[j : j + n], axis=0)
    starts = range(0, n, CHUNK)
    at = np.stack([low + act[low : low + CHUNK].argmax(axis=0) for low in starts])
    chunks = np.maximum(act[at, np.arange(FILTERS)] + net.bias, 0)
    top, low = chunks.argmax(axis=0), chunks.argmin(axis=0)
    every = np.arange(FILTERS)
    joined = np.concatenate([chunks.mean(axis=0), chunks[top, every], chunks[low, every]])
    before = joined @ net.inner + net.inner_bias
    hidden = np.maximum(before, 0)
    p = 1 / (1 + np.exp(-np.clip(hidden @ net.outer + net.outer_bias, -50, 50)))
    error = (p - label) * share
    slope["outer"] += error * hidden
    slope["outer_bias"] += error
    back = error * net.outer * (before > 0)
    slope["inner"] += np.outer(joined, back)
    slope["inner_bias"] += back
    down = net.inner @ back
    per_chunk = np.repeat(down[None, :FILTERS] / len(chunks), len(chunks), axis=0)
    per_chunk[top, every] += down[FILTERS : 2 * FILTERS]
    per_chunk[low, every] += down[2 * FILTERS :]
    per_chunk *= chunks > 0
    slope["bias"] += per_chunk.sum(axis=0)
    where, which = np.nonzero(per_chunk)
    for j in range(WIDTH):
        np.add.at(slope["kernel"][j], (raw[at[where, which] + j], which), per_chunk[where, which])


def score(docs: DataFrame, model: ByteNetwork) -> DataFrame:
    """doc_id, held_out, score and predicted for every document, whole texts.

    A null text counts as empty and still gets a score; a null doc_id is kept and is not
    held out; repeated rows score alike; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size

    def run(batches):
        net = shared.value
        for batch in batches:
            scores = [net.probability((t or "").encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "score"],
            )

    rows = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    kind = dict(docs.dtypes)["doc_id"]
    scored = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
