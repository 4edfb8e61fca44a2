"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks that cover all its bytes. Learned filters over runs of bytes slide over each
chunk; the largest response of each filter in a chunk is kept. Means and maxima of these over the chunks of a document
go into one logistic unit. Training uses a bounded sample of labelled rows, of each some chunks drawn by a hash; scoring
reads every chunk of every text.

Defined results: a null or empty text is one empty chunk and gets the score of that. Scores don't depend on other rows,
so repeated rows have equal scores. A document with several labels has the largest. Without labels, or with one class
only, every score is the share of good labels (0.5 without any). Empty tables give empty results. Columns beside doc_id
and text (and doc_id and the label) are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.tables import held_out, labelled_sample
from tidemill.llm.text import U64, mix, pieces, text_buffer

#: Labelled rows of each class learned from (expected), and chunks of each.
SAMPLE_ROWS, SAMPLE_CHUNKS = 1200, 8
CHUNK, STRIDE = 512, 448
FILTERS, WIDTH = 24, 6
EPOCHS, BATCH, RATE, DECAY = 14, 48, 0.01, 1e-4
THRESHOLD = 0.3
_PAD = 256


@dataclass
class Network:
    """filters: (place, byte, filter), with an all-zero row for what is beyond the text."""

    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray  # of means, then of maxima
    offset: float

    def responses(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter in each chunk, and where. chunks: (n, CHUNK) byte numbers."""
        wide = chunks.shape[1] - WIDTH + 1
        total = self.filters[0][chunks[:, :wide]]
        for k in range(1, WIDTH):
            total += self.filters[k][chunks[:, k : k + wide]]
        at = total.argmax(axis=1)
        top = np.take_along_axis(total, at[:, None, :], axis=1)[:, 0, :]
        return np.maximum(top + self.bias, 0), at

    def pooled(self, top: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Means and maxima over the chunks of each document; `owner` is sorted and leaves none out."""
        first = np.searchsorted(owner, np.arange(rows))
        count = np.bincount(owner, minlength=rows)[:, None]
        return np.add.reduceat(top, first, axis=0) / count, np.maximum.reduceat(top, first, axis=0)

    def score(self, mean: np.ndarray, most: np.ndarray) -> np.ndarray:
        logit = mean @ self.weights[:FILTERS] + most @ self.weights[FILTERS:] + self.offset
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def cut(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and first byte of every chunk; an empty text has one."""
    size = np.diff(offsets)
    count = 1 + np.maximum(0, -(-(size - CHUNK) // STRIDE))
    owner = np.repeat(np.arange(len(size)), count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return owner, offsets[owner] + place * STRIDE


def take(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Byte numbers of chunks, padded beyond the end of each one's text."""
    at = starts[:, None] + np.arange(CHUNK)[None, :]
    inside = at < ends[:, None]
    # The number of what is beyond a text doesn't fit a byte.
    return np.where(inside, raw[np.minimum(at, max(0, len(raw) - 1))].astype(np.int16) if len(raw) else 0, _PAD).astype(np.int16)


def _training_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "text"):
        raw, offsets = text_buffer(piece.column("text"))
        owner, starts = cut(raw, offsets)
        rank = mix(starts.astype(U64) - offsets[owner].astype(U64) + U64(17))
        order = np.lexsort((rank, owner))
        place = np.arange(len(order)) - np.searchsorted(owner, owner[order])
        chosen = order[place < SAMPLE_CHUNKS]
        label = piece.column("label").to_numpy()
        number = piece.column("doc_id").to_numpy()
        data = [raw[s : min(s + CHUNK, e)].tobytes() for s, e in zip(starts[chosen].tolist(), offsets[owner[chosen] + 1].tolist())]
        yield pa.record_batch(
            [pa.array(number[owner[chosen]]), pa.array(label[owner[chosen]]), pa.array(data, pa.binary())],
            names=["doc_id", "label", "data"],
        )


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Network:
    """Learn from labels of rows that are not held out; the driver gets at most rows * classes * chunks * 512 bytes."""
    sample = labelled_sample(labels.select("doc_id", column), column, sample_rows)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(sample, "doc_id")
    rows = texts.select("doc_id", "label", "text").mapInArrow(_training_chunks, "doc_id bigint, label int, data binary").collect()
    rows.sort(key=lambda r: (r.doc_id, r.label, bytes(r.data)))
    ids = {d: i for i, d in enumerate(dict.fromkeys(r.doc_id for r in rows))}
    owner = np.array([ids[r.doc_id] for r in rows], np.int64)
    label = np.zeros(len(ids))
    label[owner] = [r.label for r in rows]
    data = np.full((len(rows), CHUNK), _PAD, np.int16)
    for i, r in enumerate(rows):
        data[i, : len(r.data)] = np.frombuffer(r.data, np.uint8)
    return _train(data, owner, label)


def _train(data: np.ndarray, owner: np.ndarray, label: np.ndarray) -> Network:
    random = np.random.default_rng(5)
    filters = np.zeros((WIDTH, 257, FILTERS), np.float32)
    filters[:, :256] = random.normal(0, 0.25, (WIDTH, 256, FILTERS))
    net = Network(filters, np.zeros(FILTERS, np.float32), random.normal(0, 0.1, 2 * FILTERS), 0.0)
    documents = len(label)
    if not documents or label.min() == label.max():
        share = label.mean() if documents else 0.5
        net.weights[:] = 0
        net.offset = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        return net
    first = np.searchsorted(owner, np.arange(documents + 1))
    # Both classes weigh the same in the sample; the threshold is set on that scale.
    weight = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in (net.filters, net.bias, net.weights)]
    spare, step = [0.0, 0.0], 0
    for epoch in range(EPOCHS):
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        order = random.permutation(documents)
        for begin in range(0, documents, BATCH):
            chosen = order[begin : begin + BATCH]
            at = np.concatenate([np.arange(first[d], first[d + 1]) for d in chosen])
            local = np.repeat(np.arange(len(chosen)), first[chosen + 1] - first[chosen])
            top, where = net.responses(data[at])
            mean, most = net.pooled(top, local, len(chosen))
            score = net.score(mean, most)
            slope = (score - label[chosen]) * weight[chosen] / len(chosen)
            step += 1
            g_weights = np.r_[mean.T @ slope, most.T @ slope] + DECAY * net.weights
            count = np.bincount(local)[:, None]
            g_top = (slope[:, None] * net.weights[:FILTERS] / count)[local]
            g_top += (slope[:, None] * net.weights[FILTERS:])[local] * (top == most[local])
            g_top = (g_top * (top > 0)).astype(np.float32)
            g_filters = np.zeros_like(net.filters)
            column = np.broadcast_to(np.arange(FILTERS), where.shape)
            for k in range(WIDTH):
                byte = np.take_along_axis(data[at], where + k, axis=1)
                np.add.at(g_filters[k], (byte, column), g_top)
            g_filters[:, _PAD] = 0
            for x, g, (m, v) in zip((net.filters, net.bias, net.weights), (g_filters, g_top.sum(axis=0), g_weights), moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            g = float(slope.sum())
            spare = [0.9 * spare[0] + 0.1 * g, 0.999 * spare[1] + 0.001 * g * g]
            net.offset -= rate * (spare[0] / (1 - 0.9**step)) / (np.sqrt(spare[1] / (1 - 0.999**step)) + 1e-8)
    return net


def score(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for piece in pieces(batches, "text"):
            raw, offsets = text_buffer(piece.column("text"))
            owner, starts = cut(raw, offsets)
            ends = offsets[owner + 1]
            top = np.empty((len(owner), FILTERS), np.float32)
            for a in range(0, len(owner), 64):
                top[a : a + 64] = net.responses(take(raw, starts[a : a + 64], ends[a : a + 64]))[0]
            mean, most = net.pooled(top, owner, piece.num_rows)
            yield pa.record_batch([piece.column("doc_id"), pa.array(net.score(mean, most))], schema=schema)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    scored = score(docs, fit(docs, labels, **options))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
