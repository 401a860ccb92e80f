"""A dense region of near but different vectors: blocks stay bounded and the links stay the same."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetlens.llm import embeddings


@pytest.fixture(scope="module")
def dense(spark):
    rng = np.random.default_rng(4)
    x = np.r_[rng.normal(size=(1, 8)) + 0.05 * rng.normal(size=(150, 8)), rng.normal(size=(150, 8))].astype(np.float32)
    return spark.createDataFrame([(i, [float(v) for v in r], 0) for i, r in enumerate(x)], "vec_id long, embedding array<float>, label int")


def test_dense_region(dense, monkeypatch):
    whole = {r.vec_id: r for r in embeddings.embedding_dedup(dense).collect()}
    seen, deal = [], embeddings.dealt_blocks

    def spy(placed, part_rows):
        out = deal(placed, part_rows)
        seen.extend(out.groupBy(*embeddings.BLOCK, "look").agg(F.count("*").alias("n")).collect())
        return out
    monkeypatch.setattr(embeddings, "dealt_blocks", spy)
    parts = {r.vec_id: r for r in embeddings.embedding_dedup(dense, part_rows=16).collect()}
    assert max(r.n for r in seen) <= 32 and len({r.part for r in seen}) > 1 < len({r.ask_part for r in seen})
    assert parts == whole and sum(r.n_links for r in whole.values()) > 150 * 100
