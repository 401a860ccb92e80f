"""Mixing sources to target weights: soft domain membership and fitted document rates.

A naive Bayes classifier learns the domains of a labelled table on a bounded sample and gives
every document its domain posteriors. Nonnegative rates r of the documents are then fitted so
that the expected tokens of each domain, sum of r * tokens * posterior, match target shares of
all tokens, and stay near 1 otherwise:

    1/2 sum over domains of (expected / total - target)^2 / weight
        + ridge / 2 * sum of (tokens / total) * (r - 1)^2

where the weight of a domain is its share of the tokens: the step of a domain is scaled by the inverse of
that share, and the ridge holds back a rare domain no more than a common one. The rates are found by
distributed projected gradient with momentum: every rate takes the step of the domains' gradients by its
posteriors and the ridge, and is projected on zero and above. All rates start at 1 and take the same
steps, so a rate follows from its document's posteriors and the list of steps; a pass over the documents
needs that list and returns a few numbers a domain, and no state is kept with the documents. The scaled
curvature is at most 1 + ridge, so the step 1 / (1 + ridge) never overshoots; momentum starts again when
it points against a step, and the steps end when their length vanishes.

expected and target tell, by domain, the shares of all tokens that the rates give and that were wanted;
they differ where no nonnegative rates reach the target. A document may get rate 0.

Results: null and empty texts have no tokens, the posteriors of the prior alone, and a rate like
any other; repeated rows each get the same rate; without labelled rows all rates are 1; domains that
no labelled row has are left out of the targets, which are scaled to a sum of 1; further columns
are kept, and columns that bear the name of a result are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, batches, concat, cut_lineage, pack, unpack, word_hashes, words
from .labelled import class_counts, sample

BITS, SMOOTH = 17, 50
#: Domain of a labelled row: 2 * quality + toxic; the shares that the expected tokens should have.
TARGETS = {0: 0.04, 1: 0.01, 2: 0.90, 3: 0.05}


def hashed_words(buf, off):
    starts, ends, rows = words(buf, off)
    return (word_hashes(buf, starts, ends) >> np.uint64(64 - BITS)).astype(np.int64), rows


def fit_domains(docs: DataFrame, labels: DataFrame, rows_per_class: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Domains, log prior and log word rates, from at most rows_per_class labelled rows of each domain."""
    labels = labels.where("quality is not null and toxic is not null").select(
        "doc_id", (2 * F.col("quality") + F.col("toxic")).cast("int").alias("domain"))
    counts = class_counts(labels, "domain", F.lit(True))
    domains = sorted(d for d in counts if counts[d])
    if not domains:
        return [], np.zeros(0), np.zeros((0, 1 << BITS))
    rows = sample(docs, labels, "domain", F.lit(True), rows_per_class, domains)
    index = {d: i for i, d in enumerate(domains)}

    def count(tables):
        total = np.zeros((len(index), 1 << BITS), np.int64)
        for t in tables:
            label = np.array([index[x] for x in t.column("_label").to_pylist()], np.int64)
            for at, buf, off in batches(t.column("text")):
                f, rows = hashed_words(buf, off)
                np.add.at(total, (np.repeat(label[at : at + len(off) - 1], np.diff(rows)), f), 1)
        for i, part in enumerate(total):
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([pack(part)], pa.binary())], ["d", "blob"])

    def add(key, table):
        total = sum(unpack(x.as_buffer(), np.int64)[0] for x in table["blob"])
        return pa.table({"d": pa.array([key[0].as_py()]), "blob": pa.array([pack(total)], pa.binary())})

    got = rows.mapInArrow(count, "d long, blob binary").groupBy("d").applyInArrow(add, "d long, blob binary").collect()
    sums = np.zeros((len(domains), 1 << BITS))
    for r in got:
        sums[r.d] = unpack(r.blob, np.int64)[0]
    # Smoothed towards the shares of all words; a word that no labelled text holds says nothing.
    known = sums.sum(0) > 0
    share = np.where(known, sums.sum(0), 1) / max(sums.sum(), 1)
    rate = np.where(known, np.log(sums + SMOOTH * share) - np.log(sums.sum(1, keepdims=True) + SMOOTH), 0.0)
    prior = np.array([counts[d] for d in domains], float)
    return domains, np.log(prior / prior.sum()), rate - rate.mean(0)


def rows_of(docs: DataFrame) -> list[T.StructField]:
    return [f for f in docs.schema.fields if f.name not in ("n_tokens", "posterior", "rate", "expected", "target")]


def posteriors(docs: DataFrame, prior: np.ndarray, rate: np.ndarray, keep: list[T.StructField], after=None) -> DataFrame:
    """The kept columns with n_tokens and posterior; word evidence counts by the square root of the length.

    after(posteriors) adds the rate in the same pass.
    """
    shared = docs.sparkSession.sparkContext.broadcast((prior, rate.astype(np.float32)))

    def run(tables):
        prior, rate = shared.value
        for t in tables:
            if not t.num_rows:
                continue
            n, post = [], []
            for _, buf, off in batches(t.column("text")):
                f, rows = hashed_words(buf, off)
                size = np.diff(rows)
                row = np.repeat(np.arange(len(size)), size)
                z = np.stack([np.bincount(row, r[f], len(size)) for r in rate], 1)
                z = prior + z / np.sqrt(np.maximum(size, 1))[:, None]
                z = np.exp(z - z.max(1, keepdims=True))
                post.append(z / z.sum(1, keepdims=True))
                n.append(size)
            post = np.concatenate(post)
            flat, k = post.reshape(-1), len(prior)
            cols = [*(t.column(f.name) for f in keep), pa.array(concat(n, np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, k, dtype=np.int32)), pa.array(flat))]
            names = [*(f.name for f in keep), "n_tokens", "posterior"]
            if after is not None:
                cols, names = [*cols, pa.array(after(post))], [*names, "rate"]
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = T.StructType([*keep, T.StructField("n_tokens", T.LongType()), T.StructField(
        "posterior", T.ArrayType(T.DoubleType())), *([T.StructField("rate", T.DoubleType())] if after is not None else [])])
    return docs.select("text", *(f.name for f in keep if f.name != "text")).mapInArrow(run, schema)


@dataclass(frozen=True)
class Steps:
    """Projected steps from rate 1: the domains' gradients of each, and the momentum that followed it."""

    ridge: float
    gradients: tuple[tuple[float, ...], ...] = ()
    momentum: tuple[float, ...] = ()

    def then(self, gradient: np.ndarray) -> Steps:
        return Steps(self.ridge, (*self.gradients, tuple(map(float, gradient))), self.momentum)

    def pushed(self, momentum: float) -> Steps:
        return Steps(self.ridge, self.gradients, (*self.momentum, momentum))


def walked(post: np.ndarray, steps: Steps) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rates after the last step, those before it, and the point from which it was taken."""
    now = before = at = np.ones(len(post))
    for i, gradient in enumerate(steps.gradients):
        if i:
            at = now + steps.momentum[i - 1] * (now - before)
        before = now
        now = np.maximum(0, at - (post @ np.array(gradient) + steps.ridge * (at - 1)) / (1 + steps.ridge))
    return now, before, at


def rates(post: np.ndarray, steps: Steps) -> np.ndarray:
    """Rate of each row, from its posteriors and the steps that all rates take."""
    return walked(post, steps)[0]


def fit_rates(rows: DataFrame, target: np.ndarray, ridge: float, close: float) -> tuple[Steps, np.ndarray]:
    """Steps of the rates, and the shares of the tokens that they give, over (n_tokens, posterior) rows."""
    k = len(target)

    def sums(steps: Steps):
        """Shares by the rates, their change by the last step, its squared length, and how the momentum lies to it."""
        size = 3 + 2 * k

        def run(tables):
            total = np.zeros(size)
            for t in tables:
                if t.num_rows:
                    n = t.column("n_tokens").to_numpy().astype(float)
                    p = t.column("posterior").flatten().to_numpy().reshape(-1, k)
                    now, before, at = walked(p, steps)
                    total += np.concatenate([[n.sum()], (n * now) @ p, (n * (now - before)) @ p,
                                             [n @ (now - at) ** 2, n @ ((at - now) * (now - before))]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["i", "x"])
        got = rows.select("n_tokens", "posterior").mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x")).collect()
        out = np.array([v for _, v in sorted((r[0], r[1]) for r in got)]) if got else np.zeros(size)
        if not out[0]:
            return None
        out = out[1:] / out[0]
        return out[:k], out[k : 2 * k], out[2 * k], out[2 * k + 1]

    steps = Steps(ridge)
    if (first := sums(steps)) is None:
        return steps, np.zeros(k)
    given = first[0]
    weight, point, pace = np.maximum(given, 1e-9), given, 1.0
    while True:
        steps = steps.then((point - target) / weight)
        given, change, length, against = sums(steps)
        # At a target out of reach the shares never match, but the steps vanish at the best rates.
        if math.sqrt(length) * (1 + ridge) < close / 10:
            return steps, given
        following = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        momentum, pace = (0.0, 1.0) if against > 0 else ((pace - 1) / following, following)
        steps, point = steps.pushed(momentum), given + momentum * change


def mix_to_targets(docs: DataFrame, labels: DataFrame, targets: dict[int, float] | None = None, rows_per_class: int = 2000,
                   ridge: float = 1e-3, close: float = 1e-4) -> DataFrame:
    """Rows of docs with n_tokens, posterior (by domain, ascending), rate, and the expected and target shares by domain."""
    bound_batches(docs.sparkSession)
    domains, prior, word_rate = fit_domains(docs, labels, rows_per_class)
    keep = rows_of(docs)
    fixed = lambda x: F.array(*map(F.lit, map(float, x)))
    if not domains:
        out = posteriors(docs, np.zeros(1), np.zeros((1, 1 << BITS)), keep, lambda p: np.ones(len(p)))
        return out.withColumns({"expected": fixed([1]), "target": fixed([1])})
    wanted = np.array([(TARGETS if targets is None else targets).get(d, 0.0) for d in domains])
    wanted = wanted / wanted.sum() if wanted.sum() else np.full(len(domains), 1 / len(domains))
    rows = cut_lineage(posteriors(docs, prior, word_rate, []), docs.sparkSession)
    steps, expected = fit_rates(rows, wanted, ridge, close)
    out = posteriors(docs, prior, word_rate, keep, lambda p: rates(p, steps))
    return out.withColumns({"expected": fixed(expected), "target": fixed(wanted)})
