"""Quality classifier: a byte-level convolutional network in numpy.

FILTERS learned filters of WIDTH bytes run over the UTF-8 bytes of a text in chunks of CHUNK bytes, every STRIDE
bytes, so the chunks overlap and cover the whole text. Rectified filter outputs are max-pooled in every chunk; a
text's features are the means of its chunks' maxima and of the chunks' fill, combined into one probability by one
hidden layer and a logistic one. Without the fill a short text would look like one that repeats itself.

A filter is one table of FILTERS values for each byte at each place. For scoring, tables of neighbouring places are
added up in advance into one for byte pairs. Training is Adam on a bounded sample: per class MAX_ROWS labelled texts
with the smallest hash of their id, WINDOWS windows of CHUNK characters each, cut to CHUNK bytes and spread over the
text; a part of them is cut short at random while training. The probability is then calibrated to
the classes' shares among the labels.

Null and empty texts are scored as one chunk of zero bytes. Repeated rows are scored alike, each; only the columns
doc_id, text and quality are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payx.llm.common import small_batches, spread_windows
from payx.llm.kernels import utf8_batches

FILTERS, WIDTH, CHUNK, STRIDE, HIDDEN = 12, 6, 256, 224, 16
MAX_ROWS, WINDOWS, EPOCHS, BATCH, SEED = 800, 5, 10, 32, 7


class Net:
    """Filter tables (WIDTH, 256, FILTERS) with their biases, and the two layers over them."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.p = [rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), rng.normal(0, 0.3, (FILTERS + 1, HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32), rng.normal(0, 0.3, HIDDEN).astype(np.float32), np.zeros(1, np.float32)]
        self.slope, self.shift = 1.0, 0.0

    def pairs(self) -> list[np.ndarray]:
        """One table for each pair of neighbouring places, by the two bytes."""
        t = self.p[0]
        return [(t[j][:, None, :] + t[j + 1][None, :, :]).reshape(65536, FILTERS) for j in range(0, WIDTH, 2)]

    def features(self, data: np.ndarray, off: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """A row of features for every text of a batch."""
        n = len(off) - 1
        gap = CHUNK + WIDTH  # zero bytes between texts, so that no filter sees two and an empty one has a chunk
        size = np.diff(off)
        begin = off[:-1] + np.arange(n) * gap
        padded = np.zeros(int(off[-1]) + n * gap + WIDTH, np.int32)
        padded[np.arange(int(off[-1])) + np.repeat(np.arange(n) * gap, size)] = data
        two = padded[:-1] * 256 + padded[1:]
        chunks = 1 + np.maximum(-(-(size - CHUNK) // STRIDE), 0)
        owner = np.repeat(np.arange(n), chunks)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        lo = begin[owner] + place * STRIDE
        hi = np.maximum(np.minimum(lo + CHUNK, begin[owner] + size[owner]), lo + 1)
        out = np.zeros((n, FILTERS))
        edges = np.empty(2 * len(lo), np.int64)
        a = 0
        while a < len(lo):  # some chunks at a time, for memory
            b = min(len(lo), a + 1024)
            base, top = int(lo[a]), int(hi[b - 1])
            act = tables[0][two[base:top]]
            for j, t in enumerate(tables[1:], 1):
                act += t[two[base + 2 * j : top + 2 * j]]
            act = np.concatenate([act, act[-1:]])
            edges[0 : 2 * (b - a) : 2], edges[1 : 2 * (b - a) : 2] = lo[a:b] - base, hi[a:b] - base
            best = np.maximum(np.maximum.reduceat(act, edges[: 2 * (b - a)], axis=0)[::2] + self.p[1], 0)
            np.add.at(out, owner[a:b], best)
            a = b
        fill = np.bincount(owner, (hi - lo) / CHUNK, minlength=n)
        return np.concatenate([out, fill[:, None]], 1) / chunks[:, None]

    def logit(self, features: np.ndarray) -> np.ndarray:
        w, b, last, bias = (x.astype(float) for x in self.p[2:])
        return np.maximum(features @ w + b, 0) @ last + bias[0]

    def score(self, features: np.ndarray) -> np.ndarray:
        z = self.slope * self.logit(features) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(windows: list[list[bytes]], labels: np.ndarray, share: float, seed: int = SEED) -> Net:
    """A net from documents given as windows; share is the share of label 1 that scores are to expect."""
    net, rng = Net(seed), np.random.default_rng(seed)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in net.p]
    weight = np.where(labels == 1, 0.5 / max((labels == 1).mean(), 1e-9), 0.5 / max((labels == 0).mean(), 1e-9)).astype(np.float32)
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(windows))
        rate = 0.02 * (1 - epoch / EPOCHS) + 0.001
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            short = rng.random(len(pick)) < 0.3
            batch = [[w[: rng.integers(8, CHUNK)] for w in windows[i][:1]] if cut else windows[i] for i, cut in zip(pick, short, strict=True)]
            own = np.concatenate([np.full(len(b), k) for k, b in enumerate(batch)])
            x = np.zeros((len(own), CHUNK + WIDTH - 1), np.uint8)
            size = np.array([max(len(w), 1) for b in batch for w in b])
            for r, w in enumerate(w for b in batch for w in b):
                x[r, : len(w)] = np.frombuffer(w, np.uint8)
            parts = np.bincount(own).astype(np.float32)
            act = net.p[0][0][x[:, :CHUNK]]
            for j in range(1, WIDTH):
                act += net.p[0][j][x[:, j : j + CHUNK]]
            act[np.arange(CHUNK)[None, :] >= size[:, None]] = -1e9  # filters begin within the chunk
            arg = act.argmax(1)
            top = np.take_along_axis(act, arg[:, None, :], 1)[:, 0] + net.p[1]
            feature = np.zeros((len(batch), FILTERS + 1), np.float32)
            np.add.at(feature, own, np.concatenate([np.maximum(top, 0), (size / CHUNK)[:, None]], 1).astype(np.float32))
            feature /= parts[:, None]
            inner = np.maximum(feature @ net.p[2] + net.p[3], 0)
            p = 1 / (1 + np.exp(-np.clip(inner @ net.p[4] + net.p[5], -30, 30)))
            dz = (p - labels[pick]) * weight[pick] / len(pick)
            d_inner = dz[:, None] * net.p[4] * (inner > 0)
            d_feature = (d_inner @ net.p[2].T)[:, :FILTERS] / parts[:, None]
            back = d_feature[own] * (top > 0)
            grad = [np.zeros_like(net.p[0]), back.sum(0), feature.T @ d_inner + 1e-4 * net.p[2], d_inner.sum(0), inner.T @ dz, dz.sum(keepdims=True)]
            rows = np.arange(len(own))[:, None]
            cols = np.arange(FILTERS)[None, :]
            for j in range(WIDTH):
                np.add.at(grad[0][j], (x[rows, arg + j], np.broadcast_to(cols, arg.shape)), back)
            step += 1
            for q, g, (m, v) in zip(net.p, grad, state, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return calibrate(net, windows, labels, share)


def calibrate(net: Net, windows: list[list[bytes]], labels: np.ndarray, share: float) -> Net:
    """Fit slope and shift of the logit (Newton steps) with classes weighed as share says."""
    data = [b"".join(w) for w in windows]
    off = np.concatenate([[0], np.cumsum([len(x) for x in data])])
    x = net.logit(net.features(np.frombuffer(b"".join(data), np.uint8), off, net.pairs()))
    one = labels == 1
    weight = np.where(one, share / max(one.sum(), 1), (1 - share) / max((~one).sum(), 1))
    a = np.array([1.0, 0.0])
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(design @ a, -30, 30)))
        g = design.T @ (weight * (p - labels)) + [1e-4 * (a[0] - 1), 1e-4 * a[1]]
        h = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-4 * np.eye(2)
        a = a - np.clip(np.linalg.solve(h, g), -2, 2)
    net.slope, net.shift = max(float(a[0]), 1e-3), float(a[1])
    return net


def learn(rows: DataFrame, max_rows: int = MAX_ROWS) -> Net | float | None:
    """A net from rows (doc_id, text, quality); only those with quality 0 or 1 count.

    Where only one label is known, that label as the share of 1 that is known; None without any. Rows of each label go
    by the hash of their id, ties by the id and then by the windows drawn; equal rows count once.
    """
    small_batches(rows)
    rows = rows.where("quality in (0, 1)")
    size = {r[0]: r[1] for r in rows.groupBy("quality").count().collect()}
    if len(size) < 2:
        return float(next(iter(size))) if size else None
    order = lambda *more: Window.partitionBy("quality").orderBy("h", "doc_id", *more)
    known = rows.select("quality", F.xxhash64("doc_id").alias("h"), "doc_id", "text")
    # The last id that is wanted is found from the ids alone; as a plain bound on the id's hash it also holds where the
    # texts are read, before they are joined with labels.
    ids = known.select("quality", "h", "doc_id").withColumn("r", F.row_number().over(order())).where(F.col("r") <= max_rows)
    top = {r[0]: r[1] for r in ids.groupBy("quality").agg(F.max("h")).collect()}
    near = known.where(F.xxhash64("doc_id") <= max(top.values())).where(F.coalesce(*[F.when(F.col("quality") == q, F.col("h") <= h) for q, h in top.items()]))
    drawn = near.select("quality", "h", "doc_id", spread_windows(F.col("text"), WINDOWS, CHUNK).alias("w")).dropDuplicates(["quality", "h", "doc_id", "w"])
    drawn = drawn.withColumn("r", F.row_number().over(order("w"))).where(F.col("r") <= max_rows).select("quality", "h", "w").collect()
    got = sorted(drawn, key=lambda r: (r["h"], r["quality"], r["w"]))
    windows = [[w.encode()[:CHUNK] for w in r["w"]] or [b""] for r in got]
    return train(windows, np.array([r["quality"] for r in got], np.float32), size[1] / sum(size.values()))


def score(text: Column, net: Net | float | None) -> Column:
    """Probability that a text has label 1: a net's, or the known share for all; 0.5 where nothing is known.

    Null and empty texts are scored like any other. Texts of any length are scored whole, in bounded memory.
    """
    if not isinstance(net, Net):
        return F.lit(0.5 if net is None else float(net))

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tables = net.pairs()
        for part in parts:
            out = np.ones(len(part))
            for first, data, off in utf8_batches(pa.Array.from_pandas(part, type=pa.large_string())):
                out[first : first + len(off) - 1] = net.score(net.features(data, off, tables))
            yield pd.Series(out)

    return run(text)
