"""Pages are read once, charts are joined once, and rows of a small file are dealt to several tasks."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from assetlens.operators import phase_table as P
from assetlens.operators import spatial as S
from test_phase_table import BY, HEAD, frame


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def leaves(df):
    return df._jdf.queryExecution().optimizedPlan().collectLeaves().size()


def pages(seed):
    rng = random.Random(seed)
    texts = ["Phase", "1", "Phase 3", "Registration", "New", "Molecular", "Entity", "Dekavil2", "asthma", "", None]
    return {p: HEAD + [(rng.choice(texts), rng.choice([40, 140, 240, 332, 340, 414, 420]), 50 + rng.randrange(320) / 4) for _ in range(60)] for p in range(4)}


def test_programme_rows_read_the_words_once(spark):  # F9
    assert leaves(P.programme_rows(frame(spark, pages(1)), BY)) == 1


def test_cells_of_arrays_are_cells_of_words(spark):  # F16
    w = frame(spark, pages(2)).localCheckpoint()
    cells = P.page_cells(P.page_bodies(w, BY), BY)
    assert leaves(cells) == 1
    want = P.phase_cells(P.body_words(w, P.table_pages(w, BY), BY), BY)
    assert sorted(map(tuple, cells.collect())) == sorted(map(tuple, want.collect())) != []


def test_table_pages_read_the_words_once(spark):  # F22
    w = frame(spark, {1: HEAD, None: HEAD})
    got = P.table_pages(w, BY)
    assert leaves(got) == 1 and {(r.page, r.status) for r in got.collect()} == {(1, "table"), (None, "no header")}


def test_spans_meet_their_rectangle_once(spark):  # F10
    spans = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 10.0, "drug", False), (1, 20.0, 0.0, 30.0, 10.0, "asthma", True)], "page int, x0 double, y0 double, x1 double, y1 double, text string, italic boolean")
    rects = spark.createDataFrame([(1, 7, 0.0, 0.0, 40.0, 20.0)], "page int, rect_id int, x0 double, y0 double, x1 double, y1 double")
    got = S.cell_programmes(spans, rects, spark.createDataFrame([(1, 400.0, 200.0)], "page int, width double, approved_y double"), ["page"], F.col("italic"))
    assert plan(got).count("explode(sequence") == 2
    assert [tuple(r) for r in got.collect()] == [(1, 7, "drug", "asthma", "Phase 2")]


@pytest.mark.parametrize("name", ["S03_record_fields", "S17_spl_sections"])
def test_rows_of_one_file_are_dealt(spark, name):  # F17, F24
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 8
