"""Folds over drifting lines, band chains, wrapped rows and continuation groups, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from assetlens.operators import folds as L


def plain_groups(values, tolerance):
    out, group, total, n = [], 0, 0.0, 0
    for v in values:
        if not n or abs(v - total / n) > tolerance:
            group, total, n = group + 1, 0.0, 0
        total, n = total + v, n + 1
        out.append(group)
    return out


@pytest.fixture(scope="module")
def words():
    rng = random.Random(1)
    rows = [(d, i, (i // 6) * 7 + (i % 6) * d * 0.5 + rng.choice([0, 0.25]), 10.0 + rng.choice([0, 2, 4])) for d in range(4) for i in range(120)]
    return rows + [(None, i, 2.5 * i, 10.0) for i in range(9)]


@pytest.mark.parametrize("chunk", [None, 50])
def test_running_mean(spark, words, chunk):
    df = spark.createDataFrame(words, "doc int, i int, top double, height double").repartition(5)
    got = L.running_mean_groups(df, ["doc"], F.col("top") + F.col("height") / 2, 3.0, "line", ["top", "i"], chunk).collect()
    for d in (0, 1, 2, 3, None):
        own = sorted((w for w in words if w[0] == d), key=lambda w: (w[2], w[1]))
        want = dict(zip([w[1] for w in own], plain_groups([w[2] + w[3] / 2 for w in own], 3.0)))
        assert {r.i: r.line for r in got if r.doc == d} == want


def plain_bands(bands, share=0.72):
    kept = []
    for b in sorted(bands, key=lambda b: (b[1], -b[3])):
        for i, k in enumerate(kept):
            over = max(0.0, min(b[2], k[2]) - max(b[1], k[1])) / max(1.0, min(b[2] - b[1], k[2] - k[1]))
            if over >= share:
                if b[3] > k[3]:
                    kept[i] = b
                break
        else:
            kept.append(b)
    return kept


def test_band_chains(spark):
    rng = random.Random(2)
    bands = []
    for p in range(30):
        tops = rng.sample(range(400), 25)
        bands += [(p, float(t), float(t + rng.choice([0, 1, 24, 40, 90])), float(w)) for t, w in zip(tops, rng.sample(range(240, 900), 25))]
    df = spark.createDataFrame([(*b, 0.0, b[3]) for b in bands], "page int, y0 double, y1 double, w double, x0 double, x1 double")
    got = sorted((r.page, r.y0, r.y1, r.w) for r in L.distinct_bands(df, ["page"]).collect())
    assert got == sorted(k for p in range(30) for k in plain_bands([b for b in bands if b[0] == p]))
    # A chain: the second takes the first's place, the third meets only the second.
    chain = spark.createDataFrame([(1, 0.0, 30.0, 0.0, 300.0), (1, 8.0, 38.0, 0.0, 400.0), (1, 16.0, 46.0, 0.0, 350.0)], "page int, y0 double, y1 double, x0 double, x1 double")
    assert [(r.y0, r.x1) for r in L.distinct_bands(chain, ["page"]).collect()] == [(8.0, 400.0)]


def test_band_candidates(spark):
    rows = [(1, 300.0, 30.0, "Pipeline-Row x", None, None), (2, 200.0, 30.0, "pipeline-row", None, None), (3, 300.0, 10.0, "pipeline-row", None, None),
            (4, 300.0, 30.0, "other", None, True), (5, 300.0, 30.0, None, "asset card", None), (6, 300.0, 321.0, "asset-row", None, True)]
    df = spark.createDataFrame(rows, "id int, width double, height double, class_name string, parent_class string, in_row boolean")
    df = df.withColumns({"node_key": F.lit(""), "role": F.lit(None).cast("string")})
    assert sorted(r.id for r in L.band_candidates(df, r"(?i)\b(pipeline|asset)[-_ ]?(row|card)\b").collect()) == [1, 4, 5]


def rows_of(spark, fragments):
    df = spark.createDataFrame([(1, float(f[0]), *f[1:]) for f in fragments], "doc int, y double, asset string, indication string, code string")
    out = sorted(L.visual_rows(df, ["doc"]).collect(), key=lambda r: r.ordinal)
    return [(r.y0, r.y1, r.asset, r.indication, r.code) for r in out]


def test_visual_rows(spark):
    # whole, plus sign, wrapped indication; then a run of parts; then a code alone beside a run of one asset
    assert rows_of(spark, [(10, "A +", "x", ""), (24, "B", "", "K-1"), (30, "", "more", ""), (50, "", "q", ""), (58, "C", "", ""), (66, "", "r", "")]) == [
        (10, 30, "A + B", "x more", "K-1"), (50, 66, "C", "q r", "")]
    # a plus sign too far away, an indication with a code is no wrap, a part alone is unresolved
    assert rows_of(spark, [(10, "A +", "x", ""), (30, "B", "y", ""), (38, "", "z", "K-2"), (60, "D", "", "")]) == [
        (10, 10, "A +", "x", ""), (30, 30, "B", "y", "K-2")]
    # one code near two rows of one asset, two codes near another
    assert rows_of(spark, [(10, "A one", "x", ""), (18, "A two", "y", ""), (26, "", "", "K-3"), (60, "B", "z", ""), (64, "", "", "K-4"), (67, "", "", "K-5")]) == [
        (10, 10, "A one", "x", "K-3"), (18, 18, "A two", "y", "K-3"), (60, 60, "B", "z", "")]
    # a footer behind three rows is cut, a gap before that is not
    assert rows_of(spark, [(10, "A", "x", None), (90, "B", "y", ""), (100, "C", "z", ""), (200, "D", "w", "")]) == [
        (10, 10, "A", "x", ""), (90, 90, "B", "y", ""), (100, 100, "C", "z", "")]
    assert rows_of(spark, [(10, "", "", "K-6"), (20, None, None, None)]) == []


def test_continuation_groups(spark):
    rows = spark.createDataFrame([
        (1, 1, 100.0, "Lung cancer", "Phase 1", "A"), (1, 2, 120.0, "lung-cancer", "phase 1", "B"), (1, 3, 160.0, "Lung cancer", "Phase 1", "C"),
        (2, 4, 100.0, "x", "p", "A"), (2, 5, 110.0, "x", "p", "A"), (3, 6, 100.0, "x", "p", ""), (3, 7, 110.0, "x", "p", None),
        (4, 8, 100.0, "x", "p", "A"), (4, 9, 110.0, "x", "p", "B")], "page int, row_id int, y double, indication string, phase string, code string")
    anchors = spark.createDataFrame([(1, 110.0, "N"), (1, 140.0, "M"), (2, 105.0, "a"), (3, 130.0, "Z"), (3, 141.0, "Y"), (4, 60.0, "F")],
                                    "page int, y double, code string")
    got = {r.row_id: (r.code, r.repaired) for r in L.continuation_repairs(rows, anchors, ["page"]).collect()}
    # 1: one anchor inside, the next 20 away. 2: already its code. 3: runner-up only 11 farther. 4: 40 away.
    assert got == {1: ("N", True), 2: ("N", True), 3: ("C", False), 4: ("A", False), 5: ("A", False), 6: ("", False), 7: (None, False),
                   8: ("A", False), 9: ("B", False)}
