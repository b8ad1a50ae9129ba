"""Quality classifier: a byte-level convolutional network in numpy.

A document is cut into overlapping chunks of bytes that cover all of it. In each chunk learned
filters run over the embedded bytes and are max-pooled over the chunk; beside the byte itself, a
position's input says whether it equals the byte 1, 2, ... ``LAGS`` places before, whose windowed
means are max-pooled the same way (so a repeated word shows, whatever the word). A document's vector
is the maximum and the mean over its chunks; a small dense layer turns it into one probability.

Training: minibatch Adam on a bounded sample of labelled documents (``labelled.SAMPLE_ROWS`` of each
class, ``labelled.SAMPLE_BYTES`` of text); scoring covers every byte of every document.

Cases: null and empty texts are one chunk of padding and get a score like any other; without any
labelled row every score is the prior 0.5; repeated rows stay rows; extra columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import ready, slices, text_buffer
from flowguard.llm.labelled import held_out, sample_texts

CHUNK, STEP = 256, 192
WIDTH, STRIDE, EMBED, FILTERS = 6, 2, 6, 12
LAGS, LAG_WINDOW = 32, 64
HIDDEN = 8
PAD = 256
DIMS = 2 * (FILTERS + 3)


@dataclass
class Net:
    """embed (257, E), conv (WIDTH, E, FILTERS), bias, dense (DIMS, HIDDEN), b1, out, b2."""

    embed: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    b1: np.ndarray
    out: np.ndarray
    b2: np.ndarray

    def tables(self) -> np.ndarray:
        """Filter responses to each byte at each place of the window: (WIDTH, 257, FILTERS)."""
        return np.einsum("be,kef->kbf", self.embed, self.conv).astype(np.float32)


def fresh(seed: int = 0) -> Net:
    r = np.random.default_rng(seed)
    return Net(
        r.normal(size=(257, EMBED)) * 0.5, r.normal(size=(WIDTH, EMBED, FILTERS)) * (1 / np.sqrt(WIDTH * EMBED)), np.zeros(FILTERS),
        r.normal(size=(DIMS, HIDDEN)) / np.sqrt(DIMS), np.zeros(HIDDEN), r.normal(size=HIDDEN) / np.sqrt(HIDDEN), np.zeros(1),
    )


def chunk_rows(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin of each chunk and n+1 chunk offsets of the documents; every byte is in some chunk."""
    size = np.diff(off)
    many = np.maximum(1, -(-(size - (CHUNK - STEP)) // STEP))
    first = np.concatenate([[0], np.cumsum(many)])
    doc = np.repeat(np.arange(len(size)), many)
    return off[doc] + (np.arange(first[-1]) - first[doc]) * STEP, first


def chunk_part(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """(chunks, CHUNK) byte numbers, PAD beyond the document."""
    at = begin[:, None] + np.arange(CHUNK)[None, :]
    padded = data if len(data) else np.zeros(1, np.uint8)
    return np.where(at < end[:, None], padded[np.minimum(at, len(padded) - 1)], PAD).astype(np.int16)


def lag_features(x: np.ndarray) -> np.ndarray:
    """(chunks, 3): greatest and mean rate, over windows and lags, of bytes that equal the byte
    before by that lag, and the greatest rate over lags of two and more of the whole chunk."""
    seen = (x != PAD).astype(np.uint8)
    best = np.zeros(len(x), np.float32)
    whole = np.zeros(len(x), np.float32)
    total = np.zeros(len(x), np.float32)
    windows = CHUNK // LAG_WINDOW
    length = np.maximum(seen.sum(1, dtype=np.float32), 1)
    for lag in range(2, LAGS + 1):
        same = np.zeros(x.shape, np.uint8)
        same[:, lag:] = (x[:, lag:] == x[:, :-lag]) & (seen[:, lag:] == 1)
        rate = same.reshape(len(x), windows, LAG_WINDOW).sum(2, dtype=np.float32) / LAG_WINDOW
        np.maximum(best, rate.max(1), out=best)
        all_ = rate.sum(1) * LAG_WINDOW / length
        np.maximum(whole, all_, out=whole)
        total += all_
    return np.stack([best, total / (LAGS - 1), whole], 1)


def pooled(x: np.ndarray, tables: np.ndarray, bias: np.ndarray, places: bool = False):
    """Max-pooled filter responses (chunks, FILTERS) and, if asked, where the maximum was."""
    n = (CHUNK - WIDTH) // STRIDE + 1
    out = np.zeros((len(x), FILTERS), np.float32)
    where = np.zeros((len(x), FILTERS), np.int64)
    for at in range(0, len(x), 256):
        part = x[at : at + 256]
        h = tables[0][part[:, 0 : n * STRIDE : STRIDE]]
        for k in range(1, WIDTH):
            h += tables[k][part[:, k : k + n * STRIDE : STRIDE]]
        if places:
            arg = h.argmax(1)
            where[at : at + 256] = arg
            out[at : at + 256] = np.take_along_axis(h, arg[:, None, :], 1)[:, 0]
        else:
            out[at : at + 256] = h.max(1)
    return np.maximum(out + bias.astype(np.float32), 0), where


def document_vectors(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Maximum and mean over a document's chunks."""
    top = np.maximum.reduceat(h, first[:-1], axis=0)
    mean = np.add.reduceat(h, first[:-1], axis=0) / np.diff(first)[:, None]
    return np.concatenate([top, mean], 1)


def head(net: Net, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    z = np.tanh(v @ net.dense + net.b1)
    return 1 / (1 + np.exp(-np.clip(z @ net.out + net.b2[0], -30, 30))), z


def scores(net: Net, data: np.ndarray, off: np.ndarray, tables: np.ndarray) -> np.ndarray:
    begin, first = chunk_rows(data, off)
    h = np.zeros((len(begin), FILTERS + 3), np.float32)
    doc_end = np.repeat(off[1:], np.diff(first))
    for at in range(0, len(begin), 2048):
        x = chunk_part(data, begin[at : at + 2048], doc_end[at : at + 2048])
        h[at : at + 2048, :FILTERS], _ = pooled(x, tables, net.bias)
        h[at : at + 2048, FILTERS:] = lag_features(x)
    return head(net, document_vectors(h, first).astype(np.float64))[0]


def gradients(net: Net, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> tuple[float, Net]:
    """Mean cross-entropy of a batch of documents (chunks x, offsets first) and its gradient."""
    conv, where = pooled(x, net.tables(), net.bias, True)
    h = np.concatenate([conv, lag_features(x)], 1).astype(np.float64)
    v = document_vectors(h, first)
    p, z = head(net, v)
    n = len(y)
    loss = -np.mean(y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12))
    d = (p - y) / n
    g_out, g_b2 = z.T @ d, np.array([d.sum()])
    dz = d[:, None] * net.out[None, :] * (1 - z * z)
    g_dense, g_b1 = v.T @ dz, dz.sum(0)
    dv = dz @ net.dense.T
    doc = np.repeat(np.arange(n), np.diff(first))
    wide = h.shape[1]
    top = v[:, :wide][doc] == h  # chunks that reach the document's maximum share its gradient
    ties = np.add.reduceat(top, first[:-1], axis=0, dtype=np.float64)
    dh = dv[:, :wide][doc] * top / ties[doc] + dv[:, wide:][doc] / np.diff(first)[doc][:, None]
    dc = dh[:, :FILTERS] * (conv > 0)
    g_table = np.zeros((WIDTH, 257, FILTERS))
    rows, f = np.arange(len(x))[:, None], np.broadcast_to(np.arange(FILTERS), dc.shape)
    for k in range(WIDTH):
        np.add.at(g_table[k], (x[rows, where * STRIDE + k], f), dc)
    g_embed = np.einsum("kbf,kef->be", g_table, net.conv)
    g_conv = np.einsum("be,kbf->kef", net.embed, g_table)
    return loss, Net(g_embed, g_conv, dc.sum(0), g_dense, g_b1, g_out, g_b2)


NAMES = ("embed", "conv", "bias", "dense", "b1", "out", "b2")


def train(texts: list[str], y: list[int], steps: int = 500, batch: int = 48, rate: float = 0.01, seed: int = 0) -> Net:
    """Adam over minibatches, each with as many documents of either class as the sample's order
    brings; deterministic."""
    net = fresh(seed)
    if not texts:
        net.out[:], net.b2[:] = 0, 0
        return net
    data, off = text_buffer(pa.array(texts, pa.large_string()))
    begin, first = chunk_rows(data, off)
    y = np.array(y, float)
    rng = np.random.default_rng(seed)
    mean = {k: 0.0 for k in NAMES}
    square = {k: 0.0 for k in NAMES}
    order: np.ndarray = np.zeros(0, int)
    for step in range(1, steps + 1):
        if len(order) < min(batch, len(y)):
            order = rng.permutation(len(y))
        pick, order = order[:batch], order[batch:]
        many = np.diff(first)[pick]
        at = np.concatenate([np.arange(first[i], first[i + 1]) for i in pick])
        x = chunk_part(data, begin[at], np.repeat(off[1:][pick], many))
        _, g = gradients(net, x, np.concatenate([[0], np.cumsum(many)]), y[pick])
        pace = rate * min(1, step / 20) * (1 - 0.9 * step / steps)
        for k in NAMES:
            d = getattr(g, k)
            mean[k] = 0.9 * mean[k] + 0.1 * d
            square[k] = 0.999 * square[k] + 0.001 * d * d
            getattr(net, k)[...] -= pace * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return net


def score_documents(docs: DataFrame, net: Net) -> DataFrame:
    """``doc_id, score`` per row, from the whole text."""
    spark = docs.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(net)  # a few thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value.tables()
        for batch in batches:
            for part in slices(batch, "text"):
                data, off = text_buffer(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(scores(shared.value, data, off, tables))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted``: learned from ``labels.quality`` of rows that aren't
    held out."""
    sample = sample_texts(docs, labels, "quality")
    net = train([t for t, _ in sample], [y for _, y in sample])
    return score_documents(docs, net).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
