"""Quality classifier: a factorisation machine on hashed words, structure statistics and metadata.

A text's features are its hashed words (each occurrence weighs 1/n) and the quantile bin of each
structure statistic and of its size. Every feature has a weight and a short factor vector; all
pairwise interactions are scored in linear time by the identity
sum over pairs of <v_i, v_j> x_i x_j = 1/2 (|sum of v_i x_i|^2 - sum of |v_i|^2 x_i^2).

Fitted by Adagrad on a bounded sample of labelled rows; scoring is one narrow pass.

Results: null and empty texts are scored from their statistics alone; texts are read whole;
repeated rows get equal scores; no labelled rows at all gives every text the score 0; rows of one
class only give every text 0 or 1; further columns are kept, and columns that bear the name of a
result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, batches, word_hashes, words
from .labelled import class_counts, sample

BITS, FACTORS, BINS = 16, 8, 16


def _mask(*ranges) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, z in ranges:
        out[a : z + 1] = True
    return out


CLASSES = [_mask((0x30, 0x39)), _mask((0x41, 0x5A)), _mask((0x0A, 0x0A)), _mask((0x80, 0xFF)),
           _mask((0x2E, 0x2E)), _mask((0x2C, 0x2C)), _mask((0x21, 0x2B), (0x2F, 0x2F), (0x3C, 0x40), (0x5B, 0x60)),
           _mask((0x7C, 0x7C)), _mask((0x3A, 0x3B)), _mask((0x2D, 0x2D))]
N_STATS = len(CLASSES) + 7


def text_features(buf: np.ndarray, off: np.ndarray):
    """Hashed words with their row offsets, and the statistics of each row."""
    starts, ends, rows = words(buf, off)
    h = word_hashes(buf, starts, ends)
    n, size = np.diff(rows), np.diff(off)
    per = lambda x, at: np.diff(np.r_[0, np.cumsum(x)][at])
    stats = [per(c[buf], off) / np.maximum(size, 1) for c in CLASSES]
    row = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((h, row))
    first = np.r_[True, (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])][: len(h)]
    distinct = np.bincount(row[order][first], minlength=len(n))
    runs = np.diff(np.r_[np.flatnonzero(first), len(h)])
    top = np.zeros(len(n))
    np.maximum.at(top, row[order][first], runs)
    again = np.r_[False, (h[1:] == h[:-1]) & (row[1:] == row[:-1])][: len(h)]
    lines = per(buf == 0x0A, off) + 1
    stats += [np.log1p(size), np.log1p(n), per(ends - starts, rows) / np.maximum(n, 1), distinct / np.maximum(n, 1),
              top / np.maximum(n, 1), per(again, rows) / np.maximum(n, 1), n / lines]
    return (h >> np.uint64(64 - BITS)).astype(np.int32), rows, np.array(stats).T.reshape(len(n), N_STATS)


@dataclass
class Machine:
    edges: np.ndarray       # bin bounds of each statistic
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def rows(self, f: np.ndarray, offsets: np.ndarray, stats: np.ndarray):
        """Features, their values and their row: words, then a bin for each statistic."""
        n = np.diff(offsets)
        row = np.repeat(np.arange(len(n)), n)
        x = 1.0 / np.maximum(n, 1)[row]
        bins = np.stack([np.searchsorted(self.edges[i], stats[:, i], "right") for i in range(N_STATS)], 1)
        bins += (1 << BITS) + np.arange(N_STATS) * BINS
        return (np.r_[f, bins.ravel()], np.r_[x, np.full(bins.size, 0.5)],
                np.r_[row, np.repeat(np.arange(len(n)), N_STATS)])

    def margin(self, f, offsets, stats) -> np.ndarray:
        f, x, row = self.rows(f, offsets, stats)
        n = len(offsets) - 1
        z = self.bias + np.bincount(row, self.linear[f] * x, n)
        for k in range(FACTORS):
            vx = self.factors[k][f] * x
            z += 0.5 * (np.bincount(row, vx, n) ** 2 - np.bincount(row, vx * vx, n))
        return z


def fit(texts: list[tuple[int, np.ndarray, np.ndarray]], epochs: int, seed: int = 7) -> Machine:
    """Adagrad on (label, words, statistics) rows."""
    rng = np.random.default_rng(seed)
    stats = np.array([s for *_, s in texts])
    edges = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T
    size = (1 << BITS) + N_STATS * BINS
    m = Machine(edges, 0.0, np.zeros(size), rng.normal(0, 0.05, (FACTORS, size)))
    label = np.array([y for y, *_ in texts], float)
    step_w, step_v, step_b = np.full(size, 1e-6), np.full((FACTORS, size), 1e-6), 1e-6
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // 64)):
            own = [texts[i] for i in part]
            offsets = np.r_[0, np.cumsum([len(f) for _, f, _ in own])]
            f, x, row = m.rows(np.concatenate([f for _, f, _ in own]), offsets, stats[part])
            names, f = np.unique(f, return_inverse=True)
            v, n = m.factors[:, names], len(part)
            vx = v[:, f] * x
            total = np.stack([np.bincount(row, c, n) for c in vx])
            z = m.bias + np.bincount(row, m.linear[names][f] * x, n)
            z += 0.5 * sum(t * t - np.bincount(row, c * c, n) for t, c in zip(total, vx))
            e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[part]) / n
            ex = e[row] * x
            gw = np.bincount(f, ex, len(names)) + 1e-6 * m.linear[names]
            step_w[names] += gw * gw
            m.linear[names] -= 0.1 * gw / np.sqrt(step_w[names])
            for k in range(FACTORS):
                g = np.bincount(f, ex * (total[k][row] - vx[k]), len(names)) + 1e-5 * v[k]
                step_v[k, names] += g * g
                m.factors[k, names] -= 0.03 * g / np.sqrt(step_v[k, names])
            step_b += e.sum() ** 2
            m.bias -= 0.1 * e.sum() / np.sqrt(step_b)
    m.linear, m.factors = m.linear.astype(np.float32), m.factors.astype(np.float32)
    return m


def train(docs: DataFrame, labels: DataFrame, column: str, wanted: Column, rows_per_class: int = 3000,
          epochs: int = 6) -> Machine | float:
    """Fit on at most rows_per_class labelled rows of each class, a documented bound. One class only: its label."""
    counts = class_counts(labels, column, wanted)
    zero, one = counts.get(0, 0), counts.get(1, 0)
    if not zero or not one:
        return 1.0 if one else 0.0
    rows = sample(docs, labels, column, wanted, rows_per_class, [0, 1])

    def read(tables):
        for t in tables:
            label, out = t.column("_label").to_pylist(), []
            for at, buf, off in batches(t.column("text")):
                f, ends, stats = text_features(buf, off)
                out += [(label[at + i], f[ends[i] : ends[i + 1]].tobytes(), stats[i].tobytes()) for i in range(len(off) - 1)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), *(
                pa.array([r[i] for r in out], pa.binary()) for i in (1, 2))], ["y", "f", "s"])

    got = sorted((r.y, bytes(r.f), bytes(r.s)) for r in rows.mapInArrow(read, "y int, f binary, s binary").collect())
    m = fit([(y, np.frombuffer(f, np.int32), np.frombuffer(s)) for y, f, s in got], epochs)
    taken = [min(zero, rows_per_class), min(one, rows_per_class)]
    m.bias += 0.5 * (np.log(one / zero) - np.log(taken[1] / taken[0]))
    return m


def score(docs: DataFrame, model: Machine | float, threshold: float = 0.5) -> DataFrame:
    """Rows of docs with score (0 to 1) and predicted."""
    bound_batches(docs.sparkSession)
    rest = [f.name for f in docs.schema.fields if f.name not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(tables):
        m = shared.value
        for t in tables:
            if not t.num_rows:
                continue
            s = np.full(t.num_rows, m if isinstance(m, float) else 0.0)
            if not isinstance(m, float):
                for at, buf, off in batches(t.column("text")):
                    s[at : at + len(off) - 1] = 1 / (1 + np.exp(-np.clip(m.margin(*text_features(buf, off)), -700, 700)))
            cols = [t.column(c) for c in rest] + [pa.array(s), pa.array((s >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, [*rest, "score", "predicted"])

    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    return docs.select(*rest).mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame, wanted: Column | None = None, **options) -> DataFrame:
    """Score every text of docs; learn from labels.quality where `wanted` holds (all of them by default)."""
    return score(docs, train(docs, labels, "quality", F.lit(True) if wanted is None else wanted, **options))
