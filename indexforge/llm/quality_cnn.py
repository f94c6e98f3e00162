"""Quality classifier: a byte-level convolutional network in numpy.

A text is its UTF-8 bytes; a byte whose 6-gram also occurs within the ``LAG`` bytes before it is a
symbol of its own, so loops of repeated words are visible to the filters.  The symbols are cut into
overlapping chunks that cover the whole document.  Learned filters of ``WIDTH`` symbols
run over every chunk; each is max-pooled over its chunk, and the largest and mean pooled values over the
chunks are combined into one probability.

Training (numpy, Adam, on the driver) uses a bounded sample of labelled rows; scoring runs inside
Spark tasks over all documents with the fixed weights (about 170 kB), a few chunks at a time, so memory
is bounded by the longest text and nothing is shuffled.

Defined results: a null text counts as empty; an empty text is one chunk of padding and has a score
like any other; repeated rows are scored alike; without labels of both kinds the score is the
share of label 1 (0.5 with no label at all).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexforge.llm.fit_sample import labelled_sample, small_batches

CHUNK, STRIDE, WIDTH, FILTERS, LAG = 512, 448, 6, 16, 24
PAD = 512


def symbols(text: str) -> np.ndarray:
    """Bytes 0-255, or 256-511 where the 6-gram that ends there was seen in the last LAG bytes."""
    b = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    s = b.astype(np.int16)
    if len(b) < 7:
        return s
    code = np.zeros(len(b) - 5, np.uint64)
    for k in range(6):
        code = (code << np.uint64(8)) | b[k:len(b) - 5 + k]
    seen = np.zeros(len(code), bool)
    for lag in range(1, min(LAG, len(code) - 1) + 1):
        seen[lag:] |= code[lag:] == code[:-lag]
    s[5:][seen] += 256
    return s


def chunks(text: str) -> np.ndarray:
    """(n, CHUNK) symbols: chunks of CHUNK at every STRIDE, padded at the end."""
    s = symbols(text)
    n = max(1, -(-(len(s) - (CHUNK - STRIDE)) // STRIDE))
    out = np.full((n - 1) * STRIDE + CHUNK, PAD, np.int16)
    out[:len(s)] = s
    return np.lib.stride_tricks.sliding_window_view(out, CHUNK)[::STRIDE]


class ByteConv:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.table = r.normal(0, 0.15, (WIDTH, PAD + 1, FILTERS)).astype(np.float32)
        self.table[:, PAD] = 0
        self.bias = np.zeros(FILTERS, np.float32)
        self.top = r.normal(0, 0.3, 2 * FILTERS).astype(np.float32)
        self.offset = np.zeros(1, np.float32)

    def parts(self):
        return [self.table, self.bias, self.top, self.offset]

    def pooled(self, x: np.ndarray, where: bool = False):
        """(n, FILTERS) of the filters' largest values in each chunk, and their positions."""
        peak = np.empty((len(x), FILTERS), np.float32)
        at = np.empty((len(x), FILTERS), np.int64) if where else None
        for i in range(0, len(x), 32):
            part = x[i:i + 32]
            m = CHUNK - WIDTH + 1
            z = self.table[0].take(part[:, :m], axis=0)
            for j in range(1, WIDTH):
                z += self.table[j].take(part[:, j:m + j], axis=0)
            if where:
                at[i:i + 32] = z.argmax(axis=1)
            peak[i:i + 32] = z.max(axis=1)
        return peak + self.bias, at

    def logits(self, peak: np.ndarray, starts: np.ndarray, counts: np.ndarray):
        h = np.maximum(peak, 0)
        feats = np.hstack([np.maximum.reduceat(h, starts), np.add.reduceat(h, starts) / counts[:, None]])
        return feats @ self.top + self.offset[0], feats, h

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out, group, size = [], [], 0
        for t in [*texts, None]:
            if size > 512 or len(out) + len(group) == len(texts):  # a bounded number of chunks at once
                if group:
                    out += list(self._scores(group))
                group, size = [], 0
            if len(out) + len(group) < len(texts):
                group.append(chunks(t))
                size += len(group[-1])
        return np.array(out)

    def _scores(self, group: list[np.ndarray]) -> np.ndarray:
        counts = np.array([len(g) for g in group])
        starts = np.concatenate([[0], counts.cumsum()[:-1]])
        peak = np.vstack([self.pooled(g)[0] for g in group]) if len(group) == 1 else self.pooled(np.vstack(group))[0]
        z = self.logits(peak, starts, counts)[0].astype(np.float64)
        # rounded, so that the documents scored alongside leave no trace in the last bits
        return np.round(1 / (1 + np.exp(-np.clip(z, -30, 30))), 4)


def _pieces(groups: list[np.ndarray], at_once: int) -> Iterator[np.ndarray]:
    """The groups' chunks in order, about ``at_once`` at a time."""
    held, size = [], 0
    for g in groups:
        for k in range(0, len(g), at_once):
            held.append(g[k:k + at_once])
            size += len(held[-1])
            if size >= at_once:
                yield np.vstack(held)
                held, size = [], 0
    if held:
        yield np.vstack(held)


def fit(sample: list[tuple[str, int]], epochs: int = 6, batch: int = 48, rate: float = 0.01,
        at_once: int = 1024, seed: int = 7) -> ByteConv:
    """Weights by Adam on the log loss, from all chunks of every text.

    Chunks are passed ``at_once`` at a time: a first pass pools them and, per text, finds the chunks that
    reach each filter's largest value; a second adds up the gradients.  So a batch with very long texts holds
    no more than their symbols and pooled values.
    """
    net, r = ByteConv(seed), np.random.default_rng(seed)
    y = np.array([v for _, v in sample], np.float32)
    if not len(sample) or y.min() == y.max():
        net.top[:] = 0
        net.offset[0] = 0 if not len(sample) else (3 if y[0] else -3)
        return net
    net.offset[0] = np.log(y.mean() / (1 - y.mean()))
    data = [chunks(t) for t, _ in sample]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parts()]
    step, steps = 0, epochs * -(-len(data) // batch)
    for _ in range(epochs):
        order = r.permutation(len(data))
        for i in range(0, len(order), batch):
            own = [data[k] for k in order[i:i + batch]]
            counts = np.array([len(g) for g in own])
            starts = np.concatenate([[0], counts.cumsum()[:-1]])
            pieces = list(_pieces(own, at_once))
            pooled = [net.pooled(x, where=True) for x in pieces]
            peak = np.vstack([p for p, _ in pooled])
            z, feats, h = net.logits(peak, starts, counts)
            dz = (1 / (1 + np.exp(-z)) - y[order[i:i + batch]]) / len(own)
            doc = np.repeat(np.arange(len(own)), counts)
            # the largest value's share goes to the chunks that reach it
            first = h == feats[doc, :FILTERS]
            first = first / np.add.reduceat(first, starts)[doc]
            dh = dz[doc, None] * (first * net.top[:FILTERS] + net.top[FILTERS:] / counts[doc, None])
            dh = np.where(peak > 0, dh, 0).astype(np.float32)
            dt, done = np.zeros((WIDTH, PAD + 1, FILTERS)), 0
            for x, (_, at) in zip(pieces, pooled, strict=True):
                part = dh[done:done + len(x)].ravel()
                for j in range(WIDTH):
                    dt[j] += np.bincount(
                        (x[np.arange(len(x))[:, None], at + j].astype(np.int64) * FILTERS + np.arange(FILTERS)).ravel(),
                        part, minlength=(PAD + 1) * FILTERS).reshape(PAD + 1, FILTERS)
                done += len(x)
            dt[:, PAD] = 0
            grads = [dt, dh.sum(axis=0), feats.T @ dz + 1e-4 * net.top, np.array([dz.sum()])]
            step += 1
            lr = rate * (1 - step / (steps + 1))
            for p, g, (m, v) in zip(net.parts(), grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= lr * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    return net


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", *, folds: int = 5, held_out: int = 0,
          key: str = "doc_id", text: str = "text", max_rows: int = 4000) -> ByteConv:
    return fit(labelled_sample(docs, labels, label, folds=folds, held_out=held_out, key=key, text=text,
                               max_rows=max_rows))


def score_quality(docs: DataFrame, net: ByteConv, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for every row of ``docs``, whole texts."""
    small_batches(docs.sparkSession)
    weights = [p.copy() for p in net.parts()]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ByteConv()
        own.table, own.bias, own.top, own.offset = weights
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(own.scores(b.column(1).to_pylist()), pa.float64())], names=["key", "score"])

    d = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = d.schema["key"].dataType.simpleString()
    return d.mapInArrow(score, f"key {kind}, score double").withColumnRenamed("key", key)


def filter_quality(docs: DataFrame, net: ByteConv, text: str = "text", least: float = 0.3) -> DataFrame:
    """``docs`` without the rows scored under ``least``; all columns as they were."""
    small_batches(docs.sparkSession)
    weights, at, names = [p.copy() for p in net.parts()], docs.columns.index(text), docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ByteConv()
        own.table, own.bias, own.top, own.offset = weights
        for b in batches:
            good = own.scores(b.column(at).to_pylist()) >= least
            yield b.filter(pa.array(good)).rename_columns(names)

    return docs.mapInArrow(keep, docs.schema)
