"""Joins whose pairs, shuffles or broadcasts grew faster than the tables."""

import random

from pyspark.sql import functions as F

import __spark_entry__ as entry
from assetlens.operators import evidence as E
from assetlens.operators import spatial as S
from assetlens.plans.registry import by_document


def test_orders_with_long_keys_keep_their_own_labels(spark, tmp_path):  # F1
    keys = [7, 99999, 123456, 1234560, 1234561, 12345601]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(k, p, 1) for i, k in enumerate(keys) for p in range(i + 1)] + [(7, 0, 1), (55, 1, 1)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.product_id: r.labels for r in entry.queries()["JN06_application_labels"](spark, str(tmp_path)).collect()}
    assert got == {k: i + 1 for i, k in enumerate(keys)}


def test_application_labels_are_those_of_all_pairs(spark):  # F1
    """Ids come again or are null, lists are null, empty or hold a number twice; every group of a label that has a hit counts."""
    rng = random.Random(5)
    apps = lambda: rng.choice([None, [], [None], *[[rng.choice("abcdefgh") for _ in range(rng.choice([1, 1, 1, 2, 3]))] for _ in range(9)]])
    products = [(rng.choice([None, *range(12)]), apps()) for _ in range(30)]
    groups = [(rng.choice([None, *(f"l{i}" for i in range(25))]), apps(), rng.randrange(3)) for _ in range(40)]
    got = E.application_labels(spark.createDataFrame(products, "product_id int, apps array<string>"),
                               spark.createDataFrame(groups, "label_id string, apps array<string>, n int"))
    assert got.columns == ["label_id", "product_id", "apps", "n"]
    hits = {(p, g) for p, a in products for g, b, _ in groups if g is not None and {x for x in a or [] if x} & {x for x in b or [] if x}}
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr((g, p, b, n)) for p, g in hits for h, b, n in groups if g == h) != []
    assert any(sum(p == q for q, _ in products) > 1 for p, _ in hits) and any(sum(g == h for h, _, _ in groups) > 1 for _, g in hits)


def test_words_are_not_shuffled_to_meet_their_rectangles(spark, tmp_path):  # F3
    spark.createDataFrame([(1, " ".join(["drug", "asthma"] * 25)), (2, "a"), (None, "b c"), (3, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = entry.queries()["G28_rect_containment"](spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ENSURE_REQUIREMENTS" not in plan and "Union" not in plan
    got = {(r.doc_id, r.rect_id): (r.asset.count("drug"), r.indication.count("asthma")) for r in df.collect()}
    assert got == {(1, 0): (10, 9), (1, 2): (5, 4)}  # the last word of a line stands beyond its edge


def test_rows_in_a_cell_may_come_from_one_dealt_table(spark):  # F3
    """Points, rectangles and what they are joined with share one exchange, which Spark makes once."""
    d = by_document(spark.createDataFrame([(i, "a b c d e f") for i in range(40)], "doc_id long, text string")).select("doc_id", F.posexplode(F.split("text", " ")).alias("pos", "text"))
    rects = d.filter("pos < 3").groupBy("doc_id").agg(F.min("pos").cast("double").alias("rx0"), F.max("pos").cast("double").alias("rx1"), F.lit(0.0).alias("ry0"), F.lit(9.0).alias("ry1"))
    hits = S.contained(d.withColumns({"cx": F.col("pos").cast("double"), "cy": F.lit(5.0)}), rects, ["doc_id"]).groupBy("doc_id").agg(F.count("*").alias("n"))
    assert [r.n for r in rects.join(hits, "doc_id").collect()] == [3] * 40


def test_null_keys_and_missing_rectangles_hold_nothing(spark):  # F3
    points = spark.createDataFrame([(1, "a", 5.0, 5.0), (1, "b", 50.0, 5.0), (1, "a", 5.0, 5.0), (2, "c", 5.0, 5.0), (None, "d", 5.0, 5.0), (1, "e", None, 5.0)], "page int, id string, cx double, cy double")
    rects = spark.createDataFrame([(1, 7, 0.0, 0.0, 60.0, 60.0), (1, 8, 0.0, 0.0, 10.0, 10.0), (1, 8, 0.0, 0.0, 10.0, 10.0), (None, 9, 0.0, 0.0, 9.0, 9.0), (1, 10, None, 0.0, 9.0, 9.0)],
                                  "page int, rect int, rx0 double, ry0 double, rx1 double, ry1 double")
    got = S.contained(points, rects, ["page"])
    assert got.columns == ["page", "id", "cx", "cy", "rect", "rx0", "ry0", "rx1", "ry1"]
    assert sorted((r.id, r.rect) for r in got.collect()) == [("a", 7)] * 2 + [("a", 8)] * 4 + [("b", 7)]


def test_no_side_of_grid_rows_is_broadcast(spark, tmp_path):  # F4
    spark.createDataFrame([(i, f"drug {i} x", f"Brand#{i}") for i in range(8)], "p_partkey long, p_name string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    df = entry.queries()["G25_grid_rows"](spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "ENSURE_REQUIREMENTS" not in plan
    assert {(r.doc_id, r.asset, r.indication) for r in df.collect()} <= {(i, f"drug {i} x", f"Brand#{i}") for i in range(8)} and df.count() > 4
