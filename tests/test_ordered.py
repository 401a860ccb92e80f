"""Chunked scans give the same result as one window per key, also for one hot key."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from assetlens.operators.layout import active_anchor, merged_intervals
from assetlens.operators.ordered import Ordered


def frame(spark):
    rng = random.Random(7)
    rows = [(0 if i % 3 else rng.randrange(6), rng.randrange(4000), i, rng.choice([None, 1.0, 2.0, 3.0])) for i in range(3000)]
    return spark.createDataFrame(rows, "k int, t int, id int, v double").repartition(4).persist()


def test_scans_match_plain_windows(spark):
    df = frame(spark)
    o = Ordered(df, ["k"], ["t", "id"], rows_per_chunk=200)
    assert o.split
    got = (o.carry_forward(F.col("v"), "last_v").previous(F.col("id"), "prev_id").ordinal("n").running_max_before(F.col("v"), "top")
           .islands(F.col("v") == 3, "island").frame())
    w = Window.partitionBy("k").orderBy("t", "id")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("*", F.last("v", True).over(upto).alias("last_v"), F.lag("id").over(w).alias("prev_id"), F.row_number().over(w).cast("long").alias("n"),
                     F.max("v").over(before).alias("top"), F.sum(F.when(F.col("v") == 3, 1).otherwise(0)).over(upto).alias("island"))
    key = lambda d: sorted(map(tuple, d.select("id", "last_v", "prev_id", "n", "top", "island").collect()), key=lambda r: r[0])
    assert key(got) == key(want)
    assert o.df.groupBy("_chunk").count().agg(F.max("count")).first()[0] < 1500


def test_carry_with_null_keys(spark):
    rows = [(None if i % 2 else i % 3, i, None if i % 7 else float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, t int, v double").persist()
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    want = sorted(map(tuple, df.select("t", F.last("v", True).over(w)).collect()))
    for rows_per_chunk in (20, 70, 1000):
        got = Ordered(df, ["k"], ["t"], rows_per_chunk=rows_per_chunk).carry_forward(F.col("v"), "c").frame()
        assert sorted(map(tuple, got.select("t", "c").collect())) == want


def test_global_ordinal(spark):
    got = Ordered(frame(spark), [], ["t", "id"], rows_per_chunk=100).ordinal("n").frame().orderBy("t", "id").select("n").collect()
    assert [r[0] for r in got] == list(range(1, 3001))


def test_as_of_and_intervals(spark):
    rng = random.Random(3)
    anchors = sorted({float(rng.randrange(4000)) for _ in range(200)})
    probes = [(0, i, rng.random() * 4000) for i in range(400)]
    a = spark.createDataFrame([(0, y, f"c{y}") for y in anchors], "k int, y double, code string")
    p = spark.createDataFrame(probes, "k int, probe_id bigint, y double")

    def one(y):
        prev = [c for c in anchors if c <= y + 4 and y - c <= 140]
        nxt = [c for c in anchors if y < c <= y + 18]
        b, f = (max(prev) if prev else None), (min(nxt) if nxt else None)
        if b is not None and y - b <= 35:
            return b
        if f is not None and (b is None or f - y + 18 < y - b):
            return f
        return b if b is not None else f
    got = {r["probe_id"]: r["anchor_y"] for r in active_anchor(p, a, ["k"], rows_per_chunk=50).collect()}
    assert got == {i: one(y) for _, i, y in probes}

    spans = [(0, i, s, s + rng.randrange(1, 30)) for i, s in enumerate(rng.randrange(20000) for _ in range(500))]
    merged, reach = [], None
    for _, _, s, e in sorted(spans, key=lambda r: (r[2], r[1])):
        if reach is None or s - reach > 9:
            merged.append([s, e])
            reach = e
        else:
            reach = max(reach, e)
            merged[-1][1] = max(merged[-1][1], e)
    df = spark.createDataFrame(spans, "k int, id int, s int, e int")
    out = merged_intervals(df, ["k"], "s", "e", "id", 9.0, rows_per_chunk=40).select("s", "e").collect()
    assert sorted(map(list, out)) == sorted(merged)
