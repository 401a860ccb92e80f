"""Fitted rates reach rare targets, and tell what they give."""

import numpy as np
import pytest

import corpus_pipeline
from assetlens.llm import mixing


@pytest.mark.parametrize("share,want", [(0.001, 0.05), (0.004, 0.05), (0.5, 0.02)])
def test_rare_domain(spark, share, want):
    rows = spark.createDataFrame([(int(1e6 * share), [1.0, 0.0]), (int(1e6 * (1 - share)), [0.0, 1.0])], "n_tokens long, posterior array<double>")
    force, expected = mixing.fit_rates(rows, np.array([want, 1 - want]), 1e-3, 1e-4)
    assert np.abs(expected - [want, 1 - want]).max() < 1e-3
    assert np.allclose(mixing.rates(np.eye(2), force) * [share, 1 - share], expected)


def test_overlap_and_out_of_reach(spark):
    p = [[0.6, 0.4], [0.3, 0.7], [0.5, 0.5]]
    rows = spark.createDataFrame([(100, x) for x in p], "n_tokens long, posterior array<double>")
    force, expected = mixing.fit_rates(rows, np.array([0.35, 0.65]), 1e-3, 1e-4)
    assert np.abs(expected - [0.35, 0.65]).max() < 2e-3 and mixing.rates(np.array(p), force).min() >= 0
    _, expected = mixing.fit_rates(rows, np.array([0.95, 0.05]), 1e-3, 1e-4)  # no rates give more than 0.6 to 0.4
    assert 0.55 < expected[0] / expected.sum() <= 0.6 + 1e-9


def test_totals_are_told_and_rate_0_is_kept(spark, tmp_path):
    docs = spark.createDataFrame([(i, ("spam " if i % 3 == 0 else "good ") * 20) for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0), int(i % 7 == 0)) for i in range(30)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    out = mixing.mix_to_targets(docs, labels.where("toxic = 0"), {0: 0.0, 2: 1.0}).collect()
    total = sum(r.n_tokens for r in out)
    got = np.array([np.array(r.posterior) * r.rate * r.n_tokens for r in out]).sum(0) / total
    assert np.allclose(got, out[0].expected) and list(out[0].target) == [0.0, 1.0]
    kept = corpus_pipeline.mix(spark, docs, str(tmp_path)).collect()
    assert len(kept) == 30 and min(r.rate for r in kept) >= 0


def plain_rates(n, p, target, ridge):
    """The same least squares by many plain projected steps on one matrix."""
    m = n / n.sum()
    weight, r = m @ p, np.ones(len(n))
    for _ in range(200_000):
        step = (p @ ((m * r) @ p / weight - target / weight) + ridge * (r - 1)) / (1 + ridge)
        new = np.maximum(0, r - step)
        if np.abs(new - r).max() < 1e-12:
            return new
        r = new
    return r


@pytest.mark.parametrize("seed", [1, 2])
def test_rates_against_a_dense_solver(spark, seed):
    rng = np.random.default_rng(seed)
    p = rng.dirichlet([0.4, 0.4, 0.2], 60)
    n, target = rng.integers(0, 500, 60), np.array([0.1, 0.85, 0.05])
    rows = spark.createDataFrame([(int(a), [float(v) for v in x]) for a, x in zip(n, p)], "n_tokens long, posterior array<double>")
    steps, expected = mixing.fit_rates(rows, target, 1e-3, 1e-6)
    want = plain_rates(n.astype(float), p, target, 1e-3)
    got = mixing.rates(p, steps)
    assert np.abs(got - want)[n > 0].max() < 1e-3 and (want == 0).any()
    assert np.allclose(expected, (n / n.sum() * want) @ p, atol=1e-6)
