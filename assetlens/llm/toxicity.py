"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct n-grams of a text, hashed with a level of how densely they stand. A first pass over a bounded sample of
labelled rows counts in how many texts of each class a feature stands; the log-count ratio r
of those counts scales the feature, and logistic regression is fitted on the scaled features
with the largest evidence. Scoring is one narrow pass: no shuffle, one small weight table.

Results: null and empty texts are scored by the intercept alone; texts are read whole; repeated
rows get equal scores; no labelled rows at all gives every text the score 0; rows of one class
only give every text the share of that class; further columns are kept, and columns that bear the
name of a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, BYTE_VALUES, LOWER, batches, pack, prefix_hash, span_hash, unpack
from .labelled import class_counts, sample

BITS, LEVELS, SHIFT, RATE_CHARS = 19, 4, 104_729, 1000


@dataclass
class Linear:
    weights: np.ndarray     # by feature; 0 where it is not used
    intercept: float
    orders: tuple[int, ...]


def at_level(h: np.ndarray, level) -> np.ndarray:
    """The feature of an n-gram at a level of how densely it stands."""
    return (h + level * SHIFT) & ((1 << BITS) - 1)


def features(buf: np.ndarray, off: np.ndarray, orders: tuple[int, ...], used: np.ndarray | None = None):
    """(row, feature) of each row's distinct hashed n-grams with their level, sorted by row.

    The level tells once, twice, four and eight times or more, and no more than the n-gram's rate
    in a text of that length bears out. `used` keeps only some features.
    """
    low = LOWER[buf]
    chars = np.flatnonzero((low & 0xC0) != 0x80)
    p = prefix_hash(BYTE_VALUES[low])
    edge = np.r_[chars, len(buf)]
    size = np.diff(np.searchsorted(chars, off))
    row = np.repeat(np.arange(len(off) - 1), size)
    grams = None if used is None else np.logical_or.reduce([used[at_level(np.arange(1 << BITS), i)] for i in range(LEVELS)])
    found = []
    for n in orders:
        if len(chars) < n:
            continue
        h = span_hash(p, edge[: len(edge) - n], edge[n:]) >> np.uint64(64 - BITS)
        same = row[: len(chars) - n + 1] == row[n - 1 :]
        h = h.astype(np.int64)
        keep = same if grams is None else same & grams[h]
        at = np.flatnonzero(keep)
        found.append((row[at] << BITS) | h[at])
    key, times = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.int64),) * 2
    row, h = key >> BITS, key & ((1 << BITS) - 1)
    rate = np.log2(times * RATE_CHARS / np.maximum(size[row], 1)) + 1
    f = at_level(h, np.clip(np.minimum(np.log2(times), rate), 0, LEVELS - 1).astype(np.int64))
    if used is not None:
        row, f = row[used[f]], f[used[f]]
    return row, f


def class_sums(rows: DataFrame, orders: tuple[int, ...]) -> np.ndarray:
    """Texts of each class (0, 1) that hold each feature; summed by Spark in blocks, 2 * 2**BITS numbers in all."""
    blocks = 16

    def count(tables):
        total = np.zeros((2, 1 << BITS), np.int64)
        for t in tables:
            label = t.column("_label").to_numpy()
            for at, buf, off in batches(t.column("text")):
                row, f = features(buf, off, orders)
                np.add.at(total, (label[at + row], f), 1)
        for b, part in enumerate(np.split(total, blocks, axis=1)):
            yield pa.RecordBatch.from_arrays([pa.array([b]), pa.array([pack(part)], pa.binary())], ["_b", "blob"])

    def add(key, table):
        total = sum(unpack(x.as_buffer(), np.int64)[0] for x in table["blob"])
        return pa.table({"_b": pa.array([key[0].as_py()]), "blob": pa.array([pack(total)], pa.binary())})

    sums = rows.mapInArrow(count, "_b long, blob binary").groupBy("_b").applyInArrow(add, "_b long, blob binary")
    out = np.zeros((2, 1 << BITS))
    for r in sums.collect():
        w = (1 << BITS) // blocks
        out[:, r._b * w : (r._b + 1) * w] = unpack(r.blob, np.int64)[0].reshape(2, w)
    return out


def fit_logistic(rows: list[tuple[int, np.ndarray]], scale: np.ndarray, rounds: int, ridge: float):
    """Weights of the scaled binary features, by Adam on the full sample."""
    label = np.array([y for y, _ in rows], float)
    size = np.array([len(f) for _, f in rows])
    at = np.repeat(np.arange(len(rows)), size)
    f = np.concatenate([f for _, f in rows]).astype(np.int64)
    names, f = np.unique(f, return_inverse=True)
    x = scale[names][f]
    w, b = np.full(len(names), 0.1), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = np.bincount(at, w[f] * x, len(rows)) + b
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) / len(rows)
        g, gb = np.bincount(f, e[at] * x, len(names)) + ridge * w, e.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        w -= 0.03 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        b -= 0.03 * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-9)
    return names, w * scale[names], b


def train(docs: DataFrame, labels: DataFrame, column: str, wanted: Column, rows_per_class: int = 4000,
          orders: tuple[int, ...] = (3, 4, 5), strongest: int = 1 << 11, rounds: int = 200, ridge: float = 3e-3) -> Linear:
    """Fit on at most rows_per_class labelled rows of each class, a documented bound, and their `strongest` features."""
    counts = class_counts(labels, column, wanted)
    zero, one = counts.get(0, 0), counts.get(1, 0)
    if not zero or not one:
        return Linear(np.zeros(1 << BITS, np.float32), 40.0 if one else -800.0, orders)
    rows = sample(docs, labels, column, wanted, rows_per_class, [0, 1])
    sums = class_sums(rows, orders)
    n = np.array([max(1, min(zero, rows_per_class)), max(1, min(one, rows_per_class))], float)
    rate = (sums + 0.5) / (n[:, None] + 1)
    ratio = np.log(rate[1] / rate[0])
    # Evidence of a feature: its ratio against the spread that so few texts leave.
    evidence = np.abs(ratio) / np.sqrt(1 / (sums[0] + 0.5) + 1 / (sums[1] + 0.5))
    used = np.zeros(1 << BITS, bool)
    used[np.argsort(-evidence, kind="stable")[:strongest]] = True
    used &= sums.sum(0) >= 3

    def present(tables):
        for t in tables:
            label, out = t.column("_label").to_pylist(), []
            for at, buf, off in batches(t.column("text")):
                row, f = features(buf, off, orders, used)
                ends = np.searchsorted(row, np.arange(len(off)))
                out += [(label[at + i], f[ends[i] : ends[i + 1]].astype(np.int32).tobytes()) for i in range(len(off) - 1)]
            yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in out], pa.int32()),
                                              pa.array([x for _, x in out], pa.binary())], ["y", "f"])

    got = sorted(((r.y, bytes(r.f)) for r in rows.mapInArrow(present, "y int, f binary").collect()))
    names, w, b = fit_logistic([(y, np.frombuffer(f, np.int32)) for y, f in got], ratio, rounds, ridge)
    # The sample holds the classes in other shares than the labels.
    b += np.log(one / zero) - np.log(n[1] / n[0])
    weights = np.zeros(1 << BITS, np.float32)
    weights[names] = w
    return Linear(weights, float(b), orders)


def score(docs: DataFrame, model: Linear, threshold: float = 0.5) -> DataFrame:
    """Rows of docs with score (0 to 1) and predicted."""
    bound_batches(docs.sparkSession)
    rest = [f.name for f in docs.schema.fields if f.name not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(tables):
        m = shared.value
        used = m.weights != 0
        for t in tables:
            if not t.num_rows:
                continue
            z = np.full(t.num_rows, m.intercept)
            for at, buf, off in batches(t.column("text")):
                row, f = features(buf, off, m.orders, used)
                z[at : at + len(off) - 1] += np.bincount(row, m.weights[f], len(off) - 1)
            s = np.where(z < -700, 0.0, 1 / (1 + np.exp(-np.clip(z, -700, 700))))
            cols = [t.column(c) for c in rest] + [pa.array(s), pa.array((s >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, [*rest, "score", "predicted"])

    from pyspark.sql import types as T
    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    return docs.select(*rest).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, wanted: Column | None = None, **options) -> DataFrame:
    """Score every text of docs; learn from labels.toxic where `wanted` holds (all of them by default)."""
    return score(docs, train(docs, labels, "toxic", F.lit(True) if wanted is None else wanted, **options))
