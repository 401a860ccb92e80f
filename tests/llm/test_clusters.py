"""Ns-bounds against plain Lloyd rounds in Python integers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetlens.llm import ns_bounds as nb


def lloyd(vectors, k, rounds, dims):
    rows = [(i, [int(v) * 256 if abs(v) > 2**52 else math.floor(256 * v) for v in x], x) for i, x in vectors
            if x is not None and len(x) == dims and all(v is not None and math.isfinite(v) for v in x)]
    rank = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[2]))
    cent = [list(r[1]) for r in rank[:k]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(cent))
    for _ in range(rounds):
        own = [near(x)[1] for _, x, _ in rows]
        for j in range(len(cent)):
            part = [r[1] for r, o in zip(rows, own) if o == j]
            if part:
                cent[j] = [sum(c) // len(part) for c in zip(*part)]
    out = [(i, *near(x)) for i, x, _ in rows]
    return sorted((i if i is not None else -1, j, min(d, 2**63 - 1), ",".join(map(str, cent[j]))) for i, d, j in out)


def vectors(big):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(6, 5))
    rows = [(i, [float(v) for v in base[i % 6] + 0.1 * rng.normal(size=5)]) for i in range(160)]
    rows += [(900 + i, rows[3][1]) for i in range(60)] + [(5, rows[5][1]), (None, rows[9][1]), (1, None), (2, [1.0] * 4)]
    rows += [(3, [1.0, None, 0.0, 0.0, 0.0]), (4, [math.nan] * 5), (6, [math.inf] + [0.0] * 4), (7, [0.0] * 5), (8, [-1 / 512] * 5)]
    return rows + [(2000 + i, [big * (i + 1), -big, 0.5, 0.0, 1.0]) for i in range(4) if big]


@pytest.mark.parametrize("big", [0, 3000.0, 3e5, 1e30, 1e300])
def test_against_lloyd(spark, big):
    data = vectors(big)
    df = spark.createDataFrame([(i, x, 3) for i, x in data], "vec_id long, embedding array<double>, cluster int").repartition(3)
    got = nb.ns_cluster(df, k=9, rounds=4, dims=5).collect()
    want = lloyd(data, 9, 4, 5)
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance, r.centroid) for r in got) == want
    whole = min(sum(w[2] for w in want), 2**63 - 1)
    assert {r.inertia for r in got} == {whole}
    for r in got:
        assert r.cluster_inertia == min(sum(w[2] for w in want if w[1] == r.cluster), 2**63 - 1)


def test_few_and_none(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted((r.vec_id, r.distance) for r in nb.ns_cluster(df, k=40, dims=2).collect()) == [(1, 0), (2, 0)]
    none = nb.ns_cluster(df, dims=64)
    assert none.columns == ["vec_id", "embedding", "cluster", "distance", "cluster_inertia", "inertia", "centroid"] and not none.count()


def test_total_displacement_skips_more_than_summed_moves():
    """A centroid that comes back has moved by nothing, so its bound is as tight as when it was evaluated."""
    rng = np.random.default_rng(3)
    centres = np.floor(rng.normal(size=(8, 6)) * 900)
    x = np.floor(np.repeat(centres, 60, 0) + rng.normal(size=(480, 6)) * 40)
    away = centres + np.floor(rng.normal(size=centres.shape) * 300)
    dist, at = np.empty((480, 8)), np.empty((480, 8), np.uint16)
    own, _, n = nb.reassigned(x, None, dist, at, [centres])
    assert n == 480 * 8
    kept = dist.copy()
    back, _, n = nb.reassigned(x, own, dist, at, [centres, away, centres])
    assert n == 480 and np.array_equal(own, back)
    # Summed moves would have loosened every bound by twice the way there.
    way = 2 * np.sqrt(((away - centres) ** 2).sum(1))
    assert (kept - way <= (kept[np.arange(480), own] + way[own])[:, None]).sum() > 480 * 3


def test_limbs():
    values = [0, -1, 2**27, -(2**90) - 5, 2**63]
    digits = nb.limbs(values)
    assert [sum(d[i] << nb.LIMB * j for j, d in enumerate(digits)) for i in range(len(values))] == values
    assert all(abs(v) <= nb.INT_SAFE for d in digits for v in d) and nb.limbs([3, -4]) == [[3, -4]]


def test_usable(spark):
    df = spark.createDataFrame([(None,), ([1.0],), ([1.0, None],), ([1.0, 2.0],)], "embedding array<float>")
    assert [r[0] for r in df.select(F.coalesce(nb.usable("embedding", 2), F.lit(False))).collect()] == [False, False, False, True]
