"""Histogram sort: near-equal shards, gapless slots, whole groups where the tolerance allows it."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetlens.llm import histogram_sort as hs


def rows():
    rng = random.Random(5)
    out = [(i, "".join(rng.choice("abcdé ") for _ in range(rng.randrange(400)))) for i in range(1500)]
    out += [(7, "the same row " * 20)] * 300 + [(None, None)] * 200 + [(i, "one text " * 9) for i in range(5000, 5600)]
    return [(*r, i % 3) for i, r in enumerate(out + [(9999, "long " * 1000), (9998, "")])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), "doc_id long, text string, shard int").repartition(6)


@pytest.mark.parametrize("part_bytes", [1 << 30, 4000])
def test_shards(docs, part_bytes):
    got = hs.histogram_shards(docs, shards=24, part_bytes=part_bytes).collect()
    size = lambda t: 8 + len((t or "").encode())
    assert Counter((r.doc_id, r.text, r["size"]) for r in got) == Counter((i, t, size(t)) for i, t, _ in rows())
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert sorted(by) == list(range(24))
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    total = {s: sum(r["size"] for r in rs) for s, rs in by.items()}
    mean = sum(total.values()) / 24
    # A shard is off by the tolerance at either end, or by half of a row there.
    assert max(abs(x - mean) for x in total.values()) <= 2 * max(0.005 * mean, 5008 / 2)
    # Equal texts stand together: a text is in as many neighbouring shards as it needs.
    for text in {r.text for r in got}:
        own = sorted({r.shard for r in got if (r.text or "") == (text or "")})
        assert own == list(range(own[0], own[-1] + 1))


def test_few_rows_and_none(spark):
    few = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id long, text string")
    got = hs.histogram_shards(few, shards=24).collect()
    assert len(got) == 3 and {0 <= r.shard < 24 for r in got} == {True}
    assert len({(r.shard, r.slot) for r in got}) == 3
    empty = hs.histogram_shards(few.where("false"), shards=24)
    assert empty.columns == ["doc_id", "text", "size", "law", "shard", "slot", "grown_shard"] and not empty.count()


def test_keys_keep_their_order():
    rng = np.random.default_rng(2)
    k = [rng.integers(-2, 2, 300) * 2**62 + rng.integers(-2, 2, 300) for _ in range(3)]
    ints = [hs.number(t) for t in zip(*k)]
    whole = hs.comparable(*k)
    assert np.array_equal(np.argsort(np.array(ints, object), kind="stable"), np.argsort(whole, kind="stable"))
    assert [hs.parts_of(i) for i in ints] == [tuple(int(v) for v in t) for t in zip(*k)]
    cuts = sorted(ints[:9])
    assert hs.Splits(cuts).where(*k).tolist() == [sum(c <= i for c in cuts) for i in ints]


def test_registered(spark, tmp_path):
    from assetlens.llm.queries import QUERIES
    spark.createDataFrame([(1, "é", "en"), (2, None, "de")], "doc_id long, text string, lang string").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in QUERIES["op11_histogram_shards"](spark, str(tmp_path)).collect()}
    import zlib
    assert (got[1]["size"], got[1].text_crc32, got[2]["size"], got[2].text_crc32) == (10, zlib.crc32("é".encode()), 8, 0)
