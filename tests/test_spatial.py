"""Grid joins against all pairs, header rows found in the page, status by region."""

import random

import pytest
from pyspark.sql import functions as F

from assetlens.operators import spatial as S


@pytest.fixture(scope="module")
def page(spark):
    rng = random.Random(3)
    points = [(p, i, rng.uniform(-50, 600), rng.choice([rng.uniform(-50, 600), 48.0, 0.0])) for p in (1, 2) for i in range(300)]
    rects = [(p, i, x, y, x + rng.choice([0, 5, 60, 500]), y + rng.choice([0, 7, 90])) for p in (1, 2) for i in range(40) for x, y in [(rng.uniform(-60, 500), rng.choice([rng.uniform(-60, 500), 48.0]))]]
    return (points, rects, spark.createDataFrame(points, "page int, id int, cx double, cy double"),
            spark.createDataFrame(rects, "page int, rect int, rx0 double, ry0 double, rx1 double, ry1 double"))


@pytest.mark.parametrize("cell, margin", [(48.0, 0.0), (7.0, 1.0), (1000.0, 1.0)])
def test_contained(page, cell, margin):
    points, rects, p, r = page
    got = sorted((x.page, x.id, x.rect) for x in S.contained(p, r, ["page"], cell, margin).collect())
    assert got == sorted((a[0], a[1], b[1]) for a in points for b in rects if a[0] == b[0] and b[2] - margin <= a[2] <= b[4] + margin and b[3] - margin <= a[3] <= b[5] + margin)


def test_ranges_and_neighbours(page):
    points, rects, p, r = page
    got = sorted((x.page, x.id, x.rect) for x in S.in_ranges(p, r, ["page"], F.col("cy"), "ry0", "ry1", 32.0).collect())
    assert got == sorted((a[0], a[1], b[1]) for a in points for b in rects if a[0] == b[0] and b[3] <= a[3] <= b[5])
    got = sorted((x.page, x.id, x.rect) for x in S.near_pairs(p, r, ["page"], "cy", "ry0", 35.0).collect())
    assert got == sorted((a[0], a[1], b[1]) for a in points for b in rects if a[0] == b[0] and abs(a[3] - b[3]) <= 35)


def test_header_row(spark):
    nodes = spark.createDataFrame([
        (1, 10.0, 10.0, "Phase 1"), (1, 30.0, 60.0, "phase 1"), (1, 200.0, 30.0, "Phase 2"),   # two headings and a copy
        (1, 10.0, 200.0, "Phase 1"), (1, 200.0, 205.0, "Phase 2"), (1, 300.0, 210.0, "Filed"),  # the header
        (1, 10.0, 400.0, "Phase 3"), (1, 100.0, 400.0, "Phase 3"), (1, 200.0, 400.0, "Phase 3"), (1, 300.0, 400.0, "Phase 3"),  # one phase
        (2, 10.0, 10.0, "Phase 1 " + "x" * 60), (2, 20.0, 10.0, "Phase 2"), (3, 5.0, 5.0, None)], "page int, cx double, cy double, text string")
    got = sorted((r.page, r.cx, r.phase) for r in S.header_row(nodes, ["page"]).collect())
    assert got == [(1, 10.0, "Phase 1"), (1, 200.0, "Phase 2"), (1, 300.0, "Filed / Registration")]


def test_region_status(spark):
    df = spark.createDataFrame([(100.0, 10.0), (500.0, 10.0), (900.0, 10.0), (900.0, 90.0)], "cx double, cy double")
    got = [r[0] for r in df.select(S.region_status(F.col("cx"), F.col("cy"), F.lit(1000.0), F.lit(50.0))).collect()]
    assert got == ["Phase 2", "Phase 3", "Approved", "Reg Review"]


def test_cells(spark):
    spans = spark.createDataFrame([
        (1, 10.0, 10.0, 20.0, 20.0, "Asset", False), (1, 30.0, 11.0, 40.0, 21.0, "two", False), (1, 10.0, 30.0, 20.0, 40.0, "wrapped", False),
        (1, 12.0, 50.0, 20.0, 60.0, "lung", True), (1, 25.0, 49.0, 35.0, 59.0, "cancer", True), (1, 300.0, 10.0, 310.0, 20.0, "alone", False),
        (1, 500.0, 10.0, 510.0, 20.0, "Updates since", False), (1, 500.0, 30.0, 510.0, 40.0, "May", True)],
        "page int, x0 double, y0 double, x1 double, y1 double, text string, italic boolean")
    rects = spark.createDataFrame([(1, 1, 0.0, 0.0, 100.0, 70.0), (1, 2, 290.0, 0.0, 320.0, 70.0), (1, 3, 490.0, 0.0, 520.0, 70.0)],
                                  "page int, rect_id int, x0 double, y0 double, x1 double, y1 double")
    pages = spark.createDataFrame([(1, 1000.0, 50.0)], "page int, width double, approved_y double")
    got = S.cell_programmes(spans, rects, pages, ["page"], F.col("italic")).collect()
    assert [(r.rect_id, r.asset, r.indication, r.status) for r in got] == [(1, "Asset two wrapped", "lung cancer", "Phase 2")]
