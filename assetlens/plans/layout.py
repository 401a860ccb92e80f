"""Queries for page geometry, over words laid out from documents and over event streams."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from ..operators import folds as L
from ..operators import headers as H
from ..operators import layout as G
from ..operators import phase_table as P
from ..operators import spatial as S
from . import bindings as B
from .registry import by_document, pick, query, table

W = f"WITH {B.LAYOUT_SQL}"
cnt = lambda: F.count("*").alias("n")
HEADS = lambda: F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(l).alias("label")) for x, l in ((100, "Preclinical"), (250, "Phase 1"), (400, "Phase 2"), (550, "Phase 3"))])
HEAD_SQL = "[{x: 100.0, l: 'Preclinical'}, {x: 250.0, l: 'Phase 1'}, {x: 400.0, l: 'Phase 2'}, {x: 550.0, l: 'Phase 3'}]"


@query("S12_layout_words", W + " SELECT doc_id, count(*) AS n, sum(x1)::DOUBLE AS sum_x1, max(y1)::DOUBLE AS bottom FROM layout_word_v GROUP BY 1")
def s12(spark, d):
    return B.layout_words(spark, d).groupBy("doc_id").agg(cnt(), F.sum("x1").alias("sum_x1"), F.max("y1").alias("bottom"))


@query("S11_dedupe_nodes", W + """ SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS t, round_even((x0 + 0.3) / 4, 0) AS a, round_even(floor(y0 / 24) * 24 / 4, 0) AS b, round_even(greatest(x1 - x0, 0) / 6, 0) AS c
 FROM layout_word_v WHERE x1 > x0 AND trim(regexp_replace(text, '\\s+', ' ', 'g')) <> '') GROUP BY 1""")
def s11(spark, d):
    w = B.layout_words(spark, d).select("doc_id", F.col("pos").alias("node_id"), "text", (F.col("x0") + 0.3).alias("x"), (F.floor(F.col("y0") / 24) * 24).alias("y"),
                                        (F.col("x1") - F.col("x0")).alias("width"), F.lit(10.0).alias("height"))
    return G.dedupe_nodes(w).groupBy("doc_id").agg(cnt())


@query("G01_line_groups", W + " SELECT doc_id, pos // 20 + 1 AS line, count(*) AS n FROM layout_word_v GROUP BY 1, 2")
def g01(spark, d):
    return G.line_groups(B.layout_words(spark, d)).groupBy("doc_id", "line").agg(cnt())


@query("G02_reading_text", W + " SELECT doc_id, pos // 20 + 1 AS line, string_agg(text, ' ' ORDER BY pos) AS line_text FROM layout_word_v GROUP BY 1, 2")
def g02(spark, d):
    return G.reading_text(G.line_groups(B.layout_words(spark, d)), ["doc_id", "line"])


@query("G03_header_rows", W + """, k AS (SELECT doc_id, CASE WHEN regexp_matches(lower(text), '^the$') THEN 'a' WHEN regexp_matches(lower(text), '^of$') THEN 'b' END AS label, x0, (y0 + y1) / 2 AS cy FROM layout_word_v),
c AS (SELECT * FROM k WHERE label IS NOT NULL), o AS (SELECT p.doc_id, p.cy AS top, q.label, q.x0 FROM (SELECT DISTINCT doc_id, cy FROM c) p JOIN c q ON p.doc_id = q.doc_id AND q.cy >= p.cy AND q.cy <= p.cy + 12),
g AS (SELECT doc_id, top, min(x0) FILTER (label = 'a') AS x_a, min(x0) FILTER (label = 'b') AS x_b FROM o GROUP BY 1, 2)
SELECT doc_id, min(top)::DOUBLE AS header_y, arg_min(x_a, top)::DOUBLE AS x_a, arg_min(x_b, top)::DOUBLE AS x_b FROM g WHERE x_a IS NOT NULL AND x_b IS NOT NULL GROUP BY 1""")
def g03(spark, d):
    return G.header_rows(B.layout_words(spark, d), {"a": "^the$", "b": "^of$"}).drop("page_no")


@query("G04_column_assignment", W + """ SELECT doc_id, CASE WHEN x0 + 4 >= 450 THEN 2 WHEN x0 + 4 >= 240 THEN 1 ELSE 0 END AS by_start, CASE WHEN x0 >= 500 THEN 2 WHEN x0 >= 300 THEN 1 ELSE 0 END AS by_mid, count(*) AS n FROM layout_word_v GROUP BY ALL""")
def g04(spark, d):
    arr = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    x = F.col("x0")
    w = B.layout_words(spark, d).select("doc_id", G.column_by_start(x, arr(40, 240, 450)).alias("by_start"), G.column_by_midpoint(x, arr(200, 400, 600)).alias("by_mid"))
    return w.groupBy("doc_id", "by_start", "by_mid").agg(cnt())


def _anchors(spark, d):
    """Lines whose first word has four characters or fewer, as anchors."""
    w = B.layout_words(spark, d)
    return w.filter((F.col("pos") % 20 == 0) & (F.length("text") <= 4)).select("doc_id", "page_no", G.center_y().alias("y"), F.concat_ws("-", F.lit("C"), "pos").alias("code"))


ANCHOR_SQL = W + ", a AS (SELECT doc_id, (y0 + y1) / 2 AS y, 'C-' || pos AS code FROM layout_word_v WHERE pos % 20 = 0 AND length(text) <= 4)"


@query("G05_row_anchors", ANCHOR_SQL + """, b AS (SELECT doc_id, y FROM a UNION ALL SELECT doc_id, y + 2 FROM a) SELECT doc_id, y::DOUBLE AS y FROM (SELECT doc_id, y, y - lag(y) OVER (PARTITION BY doc_id ORDER BY y) AS g FROM b) WHERE g IS NULL OR g >= 2.5""")
def g05(spark, d):
    a = _anchors(spark, d).select("doc_id", "y")
    return G.separated(a.unionByName(a.withColumn("y", F.col("y") + 2)), ["doc_id"], "y", 2.5)


@query("G06_row_bands", ANCHOR_SQL + """, b AS (SELECT doc_id, y, coalesce((y + lag(y) OVER w) / 2, y - 1e9) AS top, coalesce((y + lead(y) OVER w) / 2, y + 1e9) AS bottom, row_number() OVER w AS band FROM a WINDOW w AS (PARTITION BY doc_id ORDER BY y))
SELECT b.doc_id, band::INT AS band, count(*) AS n, min(pos)::INT AS first_pos FROM b JOIN layout_word_v v ON v.doc_id = b.doc_id AND (v.y0 + v.y1) / 2 >= top AND (v.y0 + v.y1) / 2 < bottom GROUP BY 1, 2""")
def g06(spark, d):
    bands = G.row_bands(_anchors(spark, d), G.PAGE, "y")
    return G.assign_bands(B.layout_words(spark, d), bands, G.PAGE, G.center_y()).groupBy("doc_id", "band").agg(cnt(), F.min("pos").alias("first_pos"))


@query("G07_band_columns", ANCHOR_SQL + """, b AS (SELECT doc_id, y, coalesce((y + lag(y) OVER w) / 2, y - 1e9) AS top, coalesce((y + lead(y) OVER w) / 2, y + 1e9) AS bottom, row_number() OVER w AS band FROM a WINDOW w AS (PARTITION BY doc_id ORDER BY y)),
j AS (SELECT b.doc_id, band::INT AS band, v.* EXCLUDE (doc_id) FROM b JOIN layout_word_v v ON v.doc_id = b.doc_id AND (v.y0 + v.y1) / 2 >= top AND (v.y0 + v.y1) / 2 < bottom)
SELECT doc_id, band, coalesce(string_agg(text, ' ' ORDER BY pos) FILTER (x0 + 4 < 240), '') AS asset, coalesce(string_agg(text, ' ' ORDER BY pos) FILTER (x0 + 4 >= 240 AND x0 + 4 < 450), '') AS indication,
  coalesce(string_agg(text, ' ' ORDER BY pos) FILTER (x0 + 4 >= 450), '') AS phase FROM j GROUP BY 1, 2""")
def g07(spark, d):
    bands = G.row_bands(_anchors(spark, d), G.PAGE, "y")
    starts = F.array(F.lit(40.0), F.lit(240.0), F.lit(450.0))
    return G.band_rows(B.layout_words(spark, d), bands, starts, ["asset", "indication", "phase"]).drop("page_no")


@query("G08_active_anchor", """WITH e AS (SELECT user_id, event_id, event_type, epoch_us(ts) / 60000000.0 AS y FROM events), p AS (SELECT * FROM e WHERE event_type = 'purchase'), a AS (SELECT user_id, y, 'E' || event_id AS code FROM e WHERE event_type = 'signup'),
b AS (SELECT p.event_id, max(a.y) AS cy, arg_max(code, a.y) AS code FROM p JOIN a ON p.user_id = a.user_id AND a.y <= p.y + 4 AND p.y - a.y <= 140 GROUP BY 1),
f AS (SELECT p.event_id, min(a.y) AS cy, arg_min(code, a.y) AS code FROM p JOIN a ON p.user_id = a.user_id AND a.y > p.y AND a.y <= p.y + 18 GROUP BY 1)
SELECT p.event_id AS probe_id, CASE WHEN b.cy IS NOT NULL AND p.y - b.cy <= 35 THEN b.code WHEN f.cy IS NOT NULL AND (b.cy IS NULL OR f.cy - p.y + 18 < p.y - b.cy) THEN f.code ELSE coalesce(b.code, f.code, '') END AS code
FROM p LEFT JOIN b USING (event_id) LEFT JOIN f USING (event_id)""")
def g08(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", (F.unix_micros(F.col("ts").cast("timestamp")) / 60000000.0).alias("y"))
    probes = e.filter("event_type = 'purchase'").select("user_id", "y", F.col("event_id").alias("probe_id"))
    anchors = e.filter("event_type = 'signup'").select("user_id", "y", F.concat(F.lit("E"), "event_id").alias("code"))
    return G.active_anchor(probes, anchors, ["user_id"]).select("probe_id", "code")


LINES_SQL = W + ", ln AS (SELECT doc_id, 1 AS page_no, pos // 20 AS line, min(y0)::DOUBLE AS y, string_agg(text, ' ' ORDER BY pos) AS line_text FROM layout_word_v GROUP BY ALL)"


def _lines(spark, d):
    w = B.layout_words(spark, d).withColumn("line", F.floor(F.col("pos") / 20))
    y = w.groupBy("doc_id", "page_no", "line").agg(F.min("y0").alias("y"))
    return G.reading_text(w, ["doc_id", "page_no", "line"]).join(y, ["doc_id", "page_no", "line"])


@query("G09_between_anchors", LINES_SQL + """, m AS (SELECT *, line % 3 = 0 AS is_anchor, sum((line % 3 = 0)::INT) OVER (PARTITION BY doc_id ORDER BY y) AS g FROM ln),
h AS (SELECT doc_id, g, min(y) FILTER (is_anchor) AS anchor_y, coalesce(arg_min(regexp_extract(line_text, '\\b(th[a-z]+)', 1), y) FILTER (NOT is_anchor AND regexp_extract(line_text, '\\b(th[a-z]+)', 1) <> ''), '') AS attribute FROM m GROUP BY 1, 2)
SELECT doc_id, anchor_y, attribute FROM h""")
def g09(spark, d):
    return G.between_anchors(_lines(spark, d), F.col("line") % 3 == 0, ["doc_id"], "y", r"\b(th[a-z]+)").select("doc_id", "anchor_y", "attribute")


@query("G10_carry_over_pages", LINES_SQL + """ SELECT doc_id, line, coalesce(last_value(CASE WHEN line % 7 = 2 THEN substr(line_text, 1, 5) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line // 30, y ROWS UNBOUNDED PRECEDING), '-') AS code FROM ln""")
def g10(spark, d):
    rows = _lines(spark, d).withColumn("page_no", F.floor(F.col("line") / 30)).withColumn("code", F.when(F.col("line") % 7 == 2, F.substring("line_text", 1, 5)))
    return G.carry_over_pages(rows, "code").select("doc_id", "line", F.coalesce("code", F.lit("-")).alias("code"))


@query("G11_nearest_anchor", ANCHOR_SQL + """, p AS (SELECT doc_id, pos, (y0 + y1) / 2 + 5 AS y FROM layout_word_v WHERE pos % 20 = 7), r AS (SELECT p.doc_id, pos, code, abs(a.y - p.y) AS dd, row_number() OVER (PARTITION BY p.doc_id, pos ORDER BY abs(a.y - p.y), code) AS k FROM p JOIN a USING (doc_id))
SELECT p.doc_id, p.pos AS probe_id, a1.dd::DOUBLE AS d1, a2.dd::DOUBLE AS d2, CASE WHEN a1.dd <= 35 AND (a2.dd IS NULL OR a2.dd - a1.dd >= 12) THEN a1.code END AS code
FROM p LEFT JOIN (SELECT * FROM r WHERE k = 1) a1 ON p.doc_id = a1.doc_id AND p.pos = a1.pos LEFT JOIN (SELECT * FROM r WHERE k = 2) a2 ON p.doc_id = a2.doc_id AND p.pos = a2.pos""")
def g11(spark, d):
    probes = B.layout_words(spark, d).filter("pos % 20 = 7").select("doc_id", "page_no", F.col("pos").alias("probe_id"), (G.center_y() + 5).alias("y"))
    return G.nearest_two(probes, _anchors(spark, d), G.PAGE).drop("page_no")


@query("G12_boundary_overlap", LINES_SQL + """, t AS (SELECT doc_id, y, line, list_distinct(string_split(line_text, ' ')) AS a, lag(list_distinct(string_split(line_text, ' '))) OVER (PARTITION BY doc_id ORDER BY y) AS b FROM ln)
SELECT doc_id, line, round(len(list_intersect(a, b)) / least(len(a), len(b)), 6) AS overlap FROM t WHERE b IS NOT NULL AND round(len(list_intersect(a, b)) / least(len(a), len(b)), 6) >= 0.35""")
def g12(spark, d):
    rows = _lines(spark, d).withColumn("tokens", F.split("line_text", " ")).withColumn("code", F.col("line"))
    return G.boundary_overlap(rows, ["doc_id"], 30.0, 0.35).select("doc_id", "line", "overlap")


@query("G13_merged_anchors", ANCHOR_SQL + """ SELECT doc_id, (y + CASE WHEN length(code) % 2 = 0 THEN 3 ELSE 0 END)::DOUBLE AS y, CASE WHEN length(code) % 2 = 0 THEN code || 'L' ELSE code || 'LONG' END AS code FROM a""")
def g13(spark, d):
    a = _anchors(spark, d)
    even = F.length("code") % 2 == 0
    first = a.withColumn("code", F.when(even, F.col("code")).otherwise(F.concat("code", F.lit("LONG"))))
    second = a.withColumn("y", F.col("y") + 3).withColumn("code", F.when(even, F.concat("code", F.lit("L"))).otherwise(F.col("code")))
    return G.merged_anchors(first, second, G.PAGE).drop("page_no")


@query("G14_bar_stage", W + f""", b AS (SELECT doc_id, pos // 20 AS line, max(x1) AS x FROM layout_word_v GROUP BY 1, 2), h AS (SELECT unnest({HEAD_SQL}) AS h)
SELECT doc_id, line, arg_min(h.l, (abs(h.x - b.x), h.l)) AS nearest, coalesce(arg_max(h.l, h.x) FILTER (h.x <= b.x + 2), '') AS reached FROM b, h GROUP BY doc_id, line""")
def g14(spark, d):
    b = B.layout_words(spark, d).groupBy("doc_id", F.floor(F.col("pos") / 20).alias("line")).agg(F.max("x1").alias("x"))
    return b.select("doc_id", "line", G.nearest_label(F.col("x"), HEADS()).alias("nearest"), G.last_reached(F.col("x"), HEADS()).alias("reached"))


@query("G15_learned_labels", """WITH k AS (SELECT p_size, min(p_type) AS l FROM part WHERE p_partkey % 40 = 0 GROUP BY 1 HAVING count(DISTINCT p_type) = 1)
SELECT p_partkey, CASE WHEN p_partkey % 40 = 0 THEN p_type ELSE coalesce(l, '') END AS label FROM part LEFT JOIN k USING (p_size)""")
def g15(spark, d):
    bars = table(spark, d, "part").select("p_partkey", "p_size", F.when(F.col("p_partkey") % 40 == 0, F.col("p_type")).alias("label"))
    return G.learned_labels(bars, "p_size", "label").select("p_partkey", "label")


@query("G16_nearest_color", """WITH c AS (SELECT label, arg_min(embedding[1:3], vec_id)::DOUBLE[] AS color FROM embeddings GROUP BY 1),
j AS (SELECT vec_id, c.label, sqrt(list_sum(list_transform(range(1, 4), lambda i: (embedding[i]::DOUBLE - color[i]) * (embedding[i]::DOUBLE - color[i])))) AS dd FROM embeddings, c)
SELECT vec_id, CASE WHEN min(dd) <= 0.08 THEN arg_min(label, (dd, label)) END AS label FROM j GROUP BY 1""")
def g16(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "label", F.transform(F.slice("embedding", 1, 3), lambda x: x.cast("double")).alias("c"))
    legend = e.groupBy("label").agg(F.min_by("c", "vec_id").alias("color"))
    one = legend.agg(F.collect_list(F.struct("color", "label")).alias("legend"))  # one entry per label of the legend
    return e.drop("label").crossJoin(F.broadcast(one)).select("vec_id", G.nearest_color(F.col("c"), F.col("legend")).alias("label"))


@query("G17_section_headers", """WITH h AS (SELECT p_type AS doc_id, 'Phase ' || (1 + p_size % 4) AS phase, (p_partkey * 7 % 500)::DOUBLE AS x0, (p_size % 20)::DOUBLE AS y0 FROM part),
t AS (SELECT *, min(y0) OVER (PARTITION BY doc_id) AS top FROM h), k AS (SELECT DISTINCT doc_id, x0 FROM t WHERE y0 - top <= 14)
SELECT doc_id, x0 FROM (SELECT doc_id, x0, x0 - lag(x0) OVER (PARTITION BY doc_id ORDER BY x0) AS g FROM k) WHERE g IS NULL OR g >= 18""")
def g17(spark, d):
    w = table(spark, d, "part").select(F.col("p_type").alias("doc_id"), F.lit(1).alias("page_no"), F.concat(F.lit("Phase "), 1 + F.col("p_size") % 4).alias("text"),
                                       (F.col("p_partkey") * 7 % 500).cast("double").alias("x0"), (F.col("p_size") % 20).cast("double").alias("y0"))
    return G.section_headers(w).select("doc_id", "x0").distinct()


@query("G18_clusters", W + """, g AS (SELECT doc_id, x1, CASE WHEN x1 - lag(x1) OVER w <= 4 THEN 0 ELSE 1 END AS fresh FROM (SELECT doc_id, x1 FROM layout_word_v WHERE length(text) > 9) WINDOW w AS (PARTITION BY doc_id ORDER BY x1)),
s AS (SELECT doc_id, x1, sum(fresh) OVER (PARTITION BY doc_id ORDER BY x1) AS c FROM g) SELECT doc_id, round(avg(x1), 6)::DOUBLE AS center, count(*) AS n FROM s GROUP BY doc_id, c HAVING count(*) >= 3""")
def g18(spark, d):
    return G.clusters(B.layout_words(spark, d).filter(F.length("text") > 9).select("doc_id", "x1"), ["doc_id"], "x1", 4.0).drop("cluster")


@query("G19_merged_intervals", """WITH i AS (SELECT user_id, event_id, epoch_us(ts) / 60000000.0 AS s, epoch_us(ts) / 60000000.0 + value AS e FROM events),
g AS (SELECT *, CASE WHEN s - max(e) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 9 THEN 0 ELSE 1 END AS fresh FROM i),
k AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY s, event_id) AS segment FROM g) SELECT user_id, segment::BIGINT AS segment, count(*) AS n, round(max(e) - min(s), 4) AS span FROM k GROUP BY 1, 2""")
def g19(spark, d):
    y = F.unix_micros(F.col("ts").cast("timestamp")) / 60000000.0
    i = table(spark, d, "events").select("user_id", "event_id", y.alias("s"), (y + F.col("value")).alias("e"))
    return G.merged_intervals(i, ["user_id"], "s", "e", "event_id", 9.0).select("user_id", "segment", "n", F.round(F.col("e") - F.col("s"), 4).alias("span"))


@query("G20_widest_gap", W + """, g AS (SELECT doc_id, pos // 20 AS line, lead(x0) OVER w AS nx, lead(x0) OVER w - x1 AS gap, min(x0) OVER (PARTITION BY doc_id, pos // 20) AS lft FROM layout_word_v WINDOW w AS (PARTITION BY doc_id, pos // 20 ORDER BY x0))
SELECT doc_id, line, max(gap)::DOUBLE AS gap, arg_max(nx, (gap, -nx))::DOUBLE AS split_at FROM g WHERE gap >= 14 AND nx - lft >= 55 GROUP BY 1, 2""")
def g20(spark, d):
    return G.widest_gap(B.layout_words(spark, d).withColumn("line", F.floor(F.col("pos") / 20)), ["doc_id", "line"], "x0", "x1")


@query("G21_joined_fragments", """SELECT p_partkey AS doc_id, p_name || ' + ' || p_type AS text, p_brand AS code FROM part UNION ALL SELECT p_partkey, 'tail', p_brand FROM part""")
def g21(spark, d):
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("doc_id"), F.posexplode(F.array(
        F.struct(F.concat("p_name", F.lit(" + ")).alias("text"), F.lit("").alias("code")), F.struct(F.col("p_type").alias("text"), F.col("p_brand").alias("code")),
        F.struct(F.lit("tail").alias("text"), F.lit("").alias("code")))).alias("y", "r")).select("doc_id", "y", "r.*")
    return G.joined_fragments(rows, ["doc_id"]).select("doc_id", "text", "code")


@query("G22_declared_choice", """WITH v AS (SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1), t AS (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN coalesce(n, 0) ELSE -1 END = coalesce(n, 0) AS use_visual FROM supplier LEFT JOIN v ON l_suppkey = s_suppkey)
SELECT l_suppkey AS doc_id, CASE WHEN use_visual THEN 'visual' ELSE 'anchor' END AS variant, count(*) AS n FROM lineitem JOIN t ON l_suppkey = s_suppkey WHERE (use_visual AND l_returnflag = 'A') OR (NOT use_visual AND l_returnflag = 'R') GROUP BY 1, 2""")
def g22(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("doc_id"), F.lit(1).alias("page_no"), "l_returnflag")
    visual = li.filter("l_returnflag = 'A'")
    n = visual.groupBy("doc_id").agg(cnt())
    declared = table(spark, d, "supplier").select(F.col("s_suppkey").alias("doc_id")).join(n, "doc_id", "left").select(
        "doc_id", F.lit(1).alias("page_no"), F.when(F.col("doc_id") % 2 == 0, F.coalesce("n", F.lit(0))).otherwise(-1).alias("declared"))
    return G.declared_choice(declared, li.filter("l_returnflag = 'R'"), visual).groupBy("doc_id", "variant").agg(cnt())


@query("G23_distinct_bands", "SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(0, 1 + (len(string_split(text, ' ')) - 1) // 20)) AS line FROM documents) GROUP BY 1")
def g23(spark, d):
    w = B.layout_words(spark, d).groupBy("doc_id", "page_no", F.floor(F.col("pos") / 20).alias("line")).agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    twice = w.unionByName(w.withColumn("x1", F.col("x1") + 40).withColumn("y0", F.col("y0") + 1))
    return G.distinct_bands(twice).groupBy("doc_id").agg(cnt())


@query("G24_fallback_bands", W + " SELECT doc_id, pos // 20 AS line, count(*) AS n, (min(y0) - 6)::DOUBLE AS top, (min(y0) + 16)::DOUBLE AS bottom FROM layout_word_v GROUP BY 1, 2 HAVING count(*) >= 2")
def g24(spark, d):
    w = B.layout_words(spark, d).select("doc_id", F.col("pos").alias("node_id"), F.col("y0").alias("y"), F.lit(10.0).alias("height"), (F.col("y0") + 5).alias("cy"))
    return G.fallback_bands(w, 11.0).select("doc_id", (F.col("band") - 1).alias("line"), "n", "top", "bottom")


@query("G25_layout_programmes", "SELECT p_partkey AS doc_id, p_name AS asset, p_brand AS indication, CASE WHEN p_partkey % 2 = 0 THEN 'Phase 3' ELSE ['Phase 1', 'Phase 2'][1 + p_size % 2] END AS phase FROM part")
def g25(spark, d):
    k = F.col("p_partkey")
    node = lambda t, x, mark: F.struct(t.alias("text"), x.cast("double").alias("x"), F.lit(mark).alias("mark"))
    n = table(spark, d, "part").select(k.alias("doc_id"), F.posexplode(F.array(
        node(F.col("p_name"), F.lit(40), False), node(F.col("p_brand"), F.lit(140), False), node(F.lit("x"), F.lit(145), False),
        node(F.when(k % 2 == 0, "Phase 3").otherwise("*"), F.when(F.col("p_size") % 2 == 0, 300).otherwise(500), True))).alias("node_id", "n")).select("doc_id", "node_id", "n.*")
    n = n.withColumn("y", F.lit(100.0)).withColumn("cx", F.col("x") + 5).withColumn("cy", F.lit(105.0))
    bands = table(spark, d, "part").select(k.alias("doc_id"), F.lit(1).alias("band"), F.lit(90.0).alias("top"), F.lit(120.0).alias("bottom"))
    heads = table(spark, d, "part").select(k.alias("doc_id"), F.explode(F.array(F.struct(F.lit(310.0).alias("cx"), F.lit("Phase 1").alias("phase")), F.struct(F.lit(480.0).alias("cx"), F.lit("Phase 2").alias("phase")))).alias("h")).select("doc_id", "h.*")
    return G.layout_programmes(n, bands, heads).drop("band")


@query("G26_stage_rows", "SELECT p_partkey AS doc_id, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_type END AS indication, ['Phase 1', 'Phase 2'][1 + p_size % 2] AS stage FROM part")
def g26(spark, d):
    k = F.col("p_partkey")
    p = table(spark, d, "part")
    assets = p.select(k.alias("doc_id"), k.alias("probe_id"), F.lit(100.0).alias("y"))
    nodes = p.select(k.alias("doc_id"), F.when(k % 3 == 0, 90.0).otherwise(130.0).alias("y"), F.col("p_type").alias("text")).unionByName(p.select(k.alias("doc_id"), F.lit(141.0).alias("y"), F.lit("far").alias("text")).filter("doc_id % 3 <> 0"))
    bars = p.select(k.alias("doc_id"), F.lit(110.0).alias("y"), F.lit(50.0).alias("x"), F.when(F.col("p_size") % 2 == 0, 250.0).otherwise(349.0).alias("width"))
    return G.stage_rows(assets, nodes, bars, HEADS()).select("doc_id", "indication", "stage")


@query("G27_band_programmes", "SELECT p_partkey AS doc_id, p_name || ' ' || p_brand AS asset, i AS indication, 'Phase 2' AS phase FROM (SELECT *, unnest(['x', p_type]) AS i FROM part) UNION ALL SELECT p_partkey, 'second', 'y', 'Phase 1' FROM part")
def g27(spark, d):
    k, p = F.col("p_partkey"), table(spark, d, "part")
    at = lambda rows: p.select(k.alias("doc_id"), F.explode(F.array(*[F.struct(F.lit(float(y)).alias("y"), *[v.alias(c) for c, v in cols.items()]) for y, cols in rows])).alias("r")).select("doc_id", "r.*")
    assets = G.merged_asset_lines(at([(100, {"text": F.col("p_name")}), (110, {"text": F.col("p_brand")}), (200, {"text": F.lit("second")})]), ["doc_id"])
    bars = at([(104, {"x": F.lit(50.0), "width": F.lit(360.0)}), (108, {"x": F.lit(50.0), "width": F.lit(100.0)}), (201, {"x": F.lit(50.0), "width": F.lit(210.0)})])
    inds = at([(99, {"text": F.lit("x")}), (120, {"text": F.col("p_type")}), (205, {"text": F.lit("y")})])
    return G.band_programmes(assets, bars, inds, ["doc_id"], HEADS()).select("doc_id", "asset", "indication", "phase")


@query("G28_rect_containment", W + """, r AS (SELECT doc_id, pos // 20 AS rect_id, min(x0) AS a, max(x0) AS b, min(y0) AS c, max(y1) AS d FROM layout_word_v WHERE pos // 20 % 2 = 0 GROUP BY 1, 2)
SELECT v.doc_id, rect_id, coalesce(string_agg(text, ' ' ORDER BY pos) FILTER (length(text) <= 5), '') AS asset, coalesce(string_agg(text, ' ' ORDER BY pos) FILTER (length(text) > 5), '') AS indication
FROM layout_word_v v JOIN r ON v.doc_id = r.doc_id AND (x0 + x1) / 2 BETWEEN a AND b AND (y0 + y1) / 2 BETWEEN c AND d GROUP BY 1, 2""")
def g28(spark, d):
    w = B.layout_words(spark, d)
    r = w.withColumn("rect_id", F.floor(F.col("pos") / 20)).filter("rect_id % 2 = 0").groupBy(*G.PAGE, "rect_id").agg(F.min("x0").alias("x0"), F.max("x0").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    return G.rect_rows(w, r, F.length("text") > 5).drop("page_no")


@query("G29_appendix_pages", "SELECT doc_id FROM documents WHERE NOT regexp_matches(text, '(?i)the and|of the|discontinued')")
def g29(spark, d):
    return table(spark, d, "documents").filter(~F.col("text").rlike("(?i)the and|of the|discontinued")).select("doc_id")


@query("G30_bullet_entries", W + """, c AS (SELECT *, CASE WHEN x0 + 4 >= 340 THEN 1 ELSE 0 END AS col FROM layout_word_v), e AS (SELECT *, sum((length(text) <= 2)::INT) OVER (PARTITION BY doc_id, col ORDER BY y0, x0 ROWS UNBOUNDED PRECEDING) AS entry FROM c)
SELECT doc_id, col, entry::BIGINT AS entry, string_agg(text, ' ' ORDER BY pos) AS line_text FROM e WHERE entry > 0 AND length(text) > 2 GROUP BY 1, 2, 3""")
def g30(spark, d):
    return G.bullet_entries(B.layout_words(spark, d), F.length("text") <= 2, F.array(F.lit(40.0), F.lit(340.0))).drop("page_no")


@query("G31_code_anchors", W + """, v AS (SELECT doc_id, pos, CASE WHEN length(text) = 3 THEN 'AB-' || text || doc_id ELSE text END AS text FROM layout_word_v),
l AS (SELECT doc_id, pos // 20 AS line, string_agg(text, ' ' ORDER BY pos) AS code FROM v WHERE pos % 20 IN (0, 1) GROUP BY 1, 2)
SELECT doc_id, (25 + 12 * line)::DOUBLE AS y, code FROM l WHERE length(trim(regexp_replace(code, '\\s+', ' ', 'g'))) <= 70 AND regexp_matches(code, '[A-Za-z]') AND regexp_matches(code, '[0-9]') AND NOT starts_with(code, '*')""")
def g31(spark, d):
    w = B.layout_words(spark, d)
    w = w.withColumn("text", F.when(F.length("text") == 3, F.concat(F.lit("AB-"), "text", F.col("doc_id").cast("string"))).otherwise(F.col("text")))
    return G.code_anchors(w, 20.0, 95.0).drop("page_no")


# ---- folds over drifting and overlapping input ------------------------------------------------


def _drifting(spark, d):
    """Lines that sink to the right, by another slope in each document, with words of three heights."""
    w = B.layout_words(spark, d)
    y = 20.0 + 12.0 * F.floor(F.col("pos") / 20) + (F.col("pos") % 20) * (F.col("doc_id") % 3) * 0.375
    return w.withColumn("y0", y).withColumn("y1", y + 10 + F.col("pos") % 3)


def _fold_sql(rows, tolerance):
    """The fold as one list reduction a page: the state is (sum, count, starts of the groups)."""
    return f"""rows_v AS ({rows}), l AS (SELECT doc_id, list(CAST(v AS DOUBLE) ORDER BY o) AS m FROM rows_v GROUP BY doc_id),
f AS (SELECT doc_id, m, list_reduce([{{s: v, n: 1, i: 1, starts: [1]}} FOR v IN m], lambda a, x: CASE WHEN abs(x.s - a.s / a.n) <= {tolerance}
  THEN {{s: a.s + x.s, n: a.n + 1, i: a.i + 1, starts: a.starts}} ELSE {{s: x.s, n: 1, i: a.i + 1, starts: list_append(a.starts, a.i + 1)}} END).starts AS starts FROM l),
g AS (SELECT doc_id, unnest(range(1, len(starts) + 1)) AS line, unnest(starts) AS a, unnest(list_append(starts[2:], len(m) + 1)) AS b, m FROM f)"""


DRIFT = """SELECT doc_id, pos, y0, x0, y0 + (10 + pos % 3) / 2 AS cy FROM (SELECT * EXCLUDE (y0, y1), 20.0::DOUBLE + 12.0 * (pos // 20) + (pos % 20) * (doc_id % 3) * 0.375 AS y0 FROM layout_word_v)"""


@query("G01_drifting_lines", W + ", " + _fold_sql(f"SELECT doc_id, cy AS v, (y0, x0, pos) AS o FROM ({DRIFT})", 3.0) + """ SELECT doc_id, line::INT AS line, b - a AS n, round(list_avg(m[a:b - 1]), 6) AS center FROM g""")
def g01_drifting(spark, d):
    lines = G.line_groups(_drifting(spark, d).withColumn("cy", G.center_y()))
    return lines.groupBy("doc_id", "line").agg(cnt(), F.round(F.avg("cy"), 6).alias("center"))


@query("G18_running_centres", W + ", " + _fold_sql("SELECT doc_id, x1 AS v, (x1, pos) AS o FROM layout_word_v", 24.0) + " SELECT doc_id, round(list_avg(m[a:b - 1]), 6) AS center, b - a AS n FROM g WHERE b - a >= 3")
def g18_running(spark, d):
    return L.running_clusters(B.layout_words(spark, d).select("doc_id", "x1"), ["doc_id"], "x1").drop("cluster")


@query("G24_drifting_bands", W + ", " + _fold_sql(f"SELECT doc_id, cy AS v, (cy, pos) AS o FROM ({DRIFT})", 15.0) + " SELECT doc_id, line::INT - 1 AS line, b - a AS n, round(list_avg(m[a:b - 1]), 6) AS center FROM g WHERE b - a >= 2")
def g24_drifting(spark, d):
    w = _drifting(spark, d).withColumn("cy", G.center_y())
    d = L.running_mean_groups(w, ["doc_id"], "cy", 15.0, "band", ["cy", "pos"])
    return d.groupBy("doc_id", (F.col("band") - 1).alias("line")).agg(cnt(), F.round(F.avg("cy"), 6).alias("center")).filter("n >= 2")


#: Three bands a part in a chain: the second overlaps the first, the third only the second; a flat one is below the floor.
@query("G23_band_chains", """WITH RECURSIVE b AS (SELECT p_partkey AS doc_id, i, CAST(100 + 8 * i + p_size % 5 * i AS DOUBLE) AS y0, CAST(130 + 8 * i + p_size % 5 * i AS DOUBLE) AS y1, CAST(300 + (p_partkey * (i + 1)) % 7 * 10 AS DOUBLE) AS w FROM part, (SELECT unnest(range(6)) AS i)),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY y0, -w, i) AS k FROM b),
s AS (SELECT doc_id, k, [{i: i, y0: y0, y1: y1, w: w}] AS kept FROM o WHERE k = 1 UNION ALL
 SELECT doc_id, k, CASE WHEN hit IS NULL THEN list_append(kept, x) WHEN x.w > kept[hit].w THEN list_concat(list_append(kept[1:hit - 1], x), kept[hit + 1:]) ELSE kept END FROM (
 SELECT s.doc_id, o.k, s.kept, {i: o.i, y0: o.y0, y1: o.y1, w: o.w} AS x, list_position([greatest(0, least(o.y1, e.y1) - greatest(o.y0, e.y0)) / greatest(1.0, least(o.y1 - o.y0, e.y1 - e.y0)) >= 0.72 FOR e IN s.kept], true) AS hit
 FROM s JOIN o ON o.doc_id = s.doc_id AND o.k = s.k + 1))
SELECT doc_id, CAST(e.i AS INTEGER) AS i, e.y0 AS y0, e.y1 - e.y0 AS height FROM (SELECT doc_id, unnest(kept) AS e FROM s WHERE k = 6)""")
def g23_chains(spark, d):
    k, i = F.col("p_partkey"), F.col("i")
    b = table(spark, d, "part").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(5))))
    top = (100 + 8 * i + F.col("p_size") % 5 * i).cast("double")
    b = b.select(k.alias("doc_id"), F.lit(1).alias("page_no"), i.cast("int").alias("i"), F.lit(0.0).alias("x0"),
                 (300 + (k * (i + 1)) % 7 * 10).cast("double").alias("x1"), top.alias("y0"), (top + 30).alias("y1"))
    return G.distinct_bands(b).select("doc_id", "i", "y0", (F.col("y1") - F.col("y0")).alias("height"))


def _fragments(spark, d):
    """Line items of an order as lines of a phase column: whole, with a plus, parts alone and codes alone."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    n, w = F.col("l_partkey"), Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    y = F.sum(pick("l_suppkey", [8.0, 9.0, 14.0, 8.5, 61.0])).over(w)
    name, item = F.concat(F.lit("drug"), n % 3), F.concat(F.lit("for "), n % 4)
    asset = F.when(n % 7 == 0, F.concat(name, F.lit(" +"))).when((n % 7).isin(1, 2, 3), name).otherwise("")
    return li.select(F.col("l_orderkey").alias("doc_id"), y.alias("y"), asset.alias("asset"), F.when((n % 7).isin(0, 1, 2, 4, 5), item).otherwise("").alias("indication"),
                     F.when((n % 7 == 6) | (n % 11 == 0), F.concat(F.lit("AB-10"), n % 2)).otherwise("").alias("code"))


@query("G21_visual_rows", """WITH RECURSIVE x0 AS (SELECT l_orderkey AS doc_id, l_linenumber, l_partkey AS n, l_suppkey,
  sum([8.0, 9.0, 14.0, 8.5, 61.0][1 + l_suppkey % 5]::DOUBLE) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING) AS y FROM lineitem),
x1 AS (SELECT doc_id, y, CASE WHEN n % 7 = 0 THEN 'drug' || n % 3 || ' +' WHEN n % 7 < 4 THEN 'drug' || n % 3 ELSE '' END AS a, CASE WHEN n % 7 IN (0, 1, 2, 4, 5) THEN 'for ' || n % 4 ELSE '' END AS d,
  CASE WHEN n % 7 = 6 OR n % 11 = 0 THEN 'AB-10' || n % 2 ELSE '' END AS c FROM x0),
x2 AS (SELECT *, row_number() OVER w AS k, y - lag(y) OVER w AS gap FROM x1 WHERE a <> '' OR d <> '' OR c <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY y, a, d, c)),
x AS (SELECT x2.*, a <> '' AND d <> '' AS whole FROM x2 LEFT JOIN (SELECT doc_id, min(k) AS k0 FROM x2 WHERE gap > 60 AND k > 3 GROUP BY 1) USING (doc_id) WHERE k0 IS NULL OR k < k0),
s AS (SELECT doc_id, 0::BIGINT AS k, '' AS mode, 0.0::DOUBLE AS y0, 0.0::DOUBLE AS y1, '' AS a, '' AS d, '' AS c, 0 AS shut, 0 AS bad, 0.0::DOUBLE AS p0, 0.0::DOUBLE AS p1, '' AS pa, '' AS pd, '' AS pc FROM x WHERE k = 1
 UNION ALL SELECT doc_id, k, CASE WHEN plus THEN 'tail' WHEN tail THEN 'shut' WHEN run THEN 'run' WHEN whole THEN CASE WHEN xa LIKE '%+' THEN 'plus' ELSE 'tail' END WHEN xa = '' AND xd = '' THEN '' ELSE 'run' END,
   CASE WHEN j THEN y0 ELSE y END, y, CASE WHEN tail AND NOT plus THEN a WHEN j THEN trim(a || ' ' || xa) ELSE xa END, CASE WHEN j THEN trim(d || ' ' || xd) ELSE xd END,
   CASE WHEN tail AND NOT plus THEN c WHEN j THEN CASE WHEN c <> '' THEN c ELSE xc END ELSE xc END, CASE WHEN NOT j AND mode <> '' AND a <> '' AND d <> '' THEN 1 ELSE 0 END, CASE WHEN NOT j AND mode <> '' AND (a = '' OR d = '') THEN 1 ELSE 0 END, y0, y1, a, d, c
  FROM (SELECT *, plus OR tail OR run AS j FROM (SELECT s.*  EXCLUDE (k, shut, bad, p0, p1, pa, pd, pc), x.k, x.y, x.a AS xa, x.d AS xd, x.c AS xc, whole,
    s.mode = 'plus' AND x.y - s.y1 <= 14.5 AND (x.a <> '' OR x.d <> '') AS plus, s.mode IN ('plus', 'tail') AND x.y - s.y1 <= 9 AND x.a = '' AND x.d <> '' AND x.c = '' AS tail,
    s.mode = 'run' AND NOT whole AND x.y - s.y1 <= 8.5 AS run FROM s JOIN x ON x.doc_id = s.doc_id AND x.k = s.k + 1))),
z AS (SELECT doc_id, k, p0 AS y0, p1 AS y1, pa AS a, pd AS d, pc AS c FROM s WHERE shut = 1 UNION ALL
  SELECT doc_id, k + 1, y0, y1, a, d, c FROM (SELECT *, max(k) OVER (PARTITION BY doc_id) AS last FROM s) WHERE k = last AND mode <> '' AND a <> '' AND d <> ''),
t AS (SELECT *, split_part(regexp_replace(lower(a), '[^a-z0-9]+', ' ', 'g'), ' ', 1) AS root, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS ordinal FROM z),
u AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY ordinal) AS g FROM (SELECT *, CASE WHEN lag(root) OVER (PARTITION BY doc_id ORDER BY ordinal) = root THEN 0 ELSE 1 END AS fresh FROM t)),
r AS (SELECT doc_id, g, min(y0) - 8.5 AS low, max(y1) + 8.5 AS high FROM u GROUP BY 1, 2),
m AS (SELECT r.doc_id, g, min(c) AS sole FROM r JOIN x2 ON x2.doc_id = r.doc_id AND x2.c <> '' AND x2.y BETWEEN low AND high GROUP BY 1, 2 HAVING count(DISTINCT c) = 1)
SELECT doc_id, ordinal, y0, y1, a AS asset, d AS indication, CASE WHEN c <> '' THEN c ELSE coalesce(sole, '') END AS code FROM u LEFT JOIN m USING (doc_id, g)""")
def g21_rows(spark, d):
    out = L.visual_rows(_fragments(spark, d), ["doc_id"])
    return out.select("doc_id", F.col("ordinal").cast("long").alias("ordinal"), "y0", "y1", "asset", "indication", "code")


@query("G11_continuation_groups", W + """, r AS (SELECT doc_id, pos, y0::DOUBLE AS y, length(text) % 2 AS kind, 'C' || pos % 3 AS code FROM layout_word_v WHERE pos % 20 = 0),
a AS (SELECT doc_id, (y0 + 4)::DOUBLE AS y, 'A-' || pos AS code FROM layout_word_v WHERE pos % 20 = 5 AND length(text) % 5 = 0),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY y) AS grp FROM (SELECT *, CASE WHEN lag(kind) OVER w = kind AND y - lag(y) OVER w <= 24 THEN 0 ELSE 1 END AS fresh FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY y))),
s AS (SELECT doc_id, grp, min(y) AS low, max(y) AS high, count(*) AS n, count(DISTINCT code) AS codes, min(code) AS own FROM g GROUP BY 1, 2 HAVING count(*) >= 2),
p AS (SELECT s.doc_id, grp, codes, own, a.code, CASE WHEN a.y > high THEN a.y - high WHEN a.y < low THEN low - a.y ELSE 0 END AS dist, a.y FROM s JOIN a ON a.doc_id = s.doc_id AND a.y BETWEEN low - 60 AND high + 60),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, grp ORDER BY dist, y) AS i, lead(dist) OVER (PARTITION BY doc_id, grp ORDER BY dist, y) AS second FROM p),
c AS (SELECT doc_id, grp, code AS chosen FROM k WHERE i = 1 AND dist <= 35 AND dist + 12 <= coalesce(second, 999) AND NOT (codes <= 1 AND lower(code) = lower(own)))
SELECT doc_id, pos AS row_id, coalesce(chosen, code) AS code, chosen IS NOT NULL AS repaired FROM g LEFT JOIN c USING (doc_id, grp)""")
def g11_groups(spark, d):
    w = B.layout_words(spark, d)
    rows = w.filter("pos % 20 = 0").select("doc_id", F.col("pos").alias("row_id"), F.col("y0").alias("y"), (F.length("text") % 2).cast("string").alias("indication"),
                                            F.lit("Phase 1").alias("phase"), F.concat(F.lit("C"), F.col("pos") % 3).alias("code"))
    anchors = w.filter("pos % 20 = 5 and length(text) % 5 = 0").select("doc_id", (F.col("y0") + 4).alias("y"), F.concat(F.lit("A-"), "pos").alias("code"))
    return L.continuation_repairs(rows, anchors, ["doc_id"])


# ---- grid rows and chart cells ---------------------------------------------------------------------


@query("G25_grid_rows", """WITH e AS (SELECT *, 160 + p_partkey % 7 * 100 AS edge FROM part), h AS (SELECT unnest([{x: 310, p: 'Phase 1'}, {x: 480, p: 'Phase 2'}, {x: 650, p: 'Phase 3'}], recursive := true)),
n AS (SELECT p_partkey, arg_min(p, (abs(x - edge), x)) AS near, min(abs(x - edge)) AS d FROM e, h WHERE x < 650 OR p_partkey % 3 = 0 GROUP BY 1)
SELECT p_partkey AS doc_id, 1 AS band, p_name AS asset, p_brand AS indication, CASE WHEN p_partkey % 4 = 0 THEN 'Phase 1' ELSE near END AS phase,
  CASE WHEN p_partkey % 4 = 0 THEN 'SOURCE_LAYOUT_TEXT' ELSE 'SOURCE_LAYOUT_GEOMETRY' END AS evidence FROM e JOIN n USING (p_partkey) WHERE p_partkey % 4 = 0 OR d <= 180""")
def g25_grid(spark, d):
    # Parts are dealt before their nodes are made: a part is a page, and stays where it is.
    k, part = F.col("doc_id"), by_document(table(spark, d, "part").select(F.col("p_partkey").alias("doc_id"), "p_name", "p_brand"))
    node = lambda text, x, cy, width=40.0, bar=False: F.struct(text.alias("text"), F.lit(float(x)).alias("x"), F.lit(float(cy)).alias("cy"), (F.lit(width) if isinstance(width, float) else width).cast("double").alias("width"), F.lit(bar).alias("structural"))
    when = lambda cond, text: F.when(cond, text).otherwise("")
    nodes = part.select(k, F.explode(F.array(
        node(F.lit("Phase 1"), 290, 20), node(F.lit("Phase 1"), 300, 40), node(F.lit("Phase 2"), 460, 24), node(when(k % 3 == 0, "Phase 3"), 630, 30), node(F.lit("Phase 3"), 460, 300),
        node(F.col("p_name"), 40, 105), node(F.col("p_name"), 45, 106), node(F.col("p_brand"), 140, 104), node(F.lit("far"), 200, 104), node(F.lit(""), 100, 110, 60 + k % 7 * 100, True),
        node(when(k % 4 == 0, "Preclinical"), 690, 105), node(when(k % 4 == 0, "Phase 1"), 720, 105), node(F.col("p_name"), 40, 145))).alias("n")).select("doc_id", "n.*")
    nodes = nodes.withColumns({"y": F.col("cy") - 5, "cx": F.when(F.col("structural"), F.col("x")).otherwise(F.col("x") + 20)})
    bands = part.select(k, F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.lit(t).alias("top"), F.lit(t + 30).alias("bottom")) for b, t in ((1, 90.0), (2, 130.0))])).alias("b")).select("doc_id", "b.*")
    return S.grid_rows(nodes, bands, ["doc_id"])


@query("G28_cell_programmes", W + """, v AS (SELECT *, pos // 20 AS rect_id FROM layout_word_v WHERE regexp_matches(text, '^[a-z]{1,12}$')),
r AS (SELECT doc_id, rect_id, min(x0) AS a, max(x0) AS b, min(y0) AS c, max(y1) AS d FROM v WHERE rect_id % 2 = 0 GROUP BY 1, 2),
t AS (SELECT v.doc_id, r.rect_id, any_value((a + b) / 2 / (340 + 100 * (v.doc_id % 4))) AS share, any_value((c + d) / 2) AS cy, string_agg(text, ' ' ORDER BY pos) FILTER (length(text) <= 5) AS asset, string_agg(text, ' ' ORDER BY pos) FILTER (length(text) > 5) AS indication
  FROM v JOIN r ON v.doc_id = r.doc_id AND v.rect_id = r.rect_id AND (x0 + x1) / 2 BETWEEN a - 1 AND b + 1 GROUP BY 1, 2)
SELECT doc_id, rect_id, asset, indication, CASE WHEN share < 0.375 THEN 'Phase 2' WHEN share < 0.855 THEN 'Phase 3' WHEN cy < 200 THEN 'Approved' ELSE 'Reg Review' END AS status FROM t WHERE asset IS NOT NULL AND indication IS NOT NULL""")
def g28_cells(spark, d):
    w = B.layout_words(spark, d).filter(F.col("text").rlike("^[a-z]{1,12}$")).withColumn("rect_id", F.floor(F.col("pos") / 20))
    r = w.filter("rect_id % 2 = 0").groupBy("doc_id", "rect_id").agg(F.min("x0").alias("x0"), F.max("x0").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    pages = table(spark, d, "documents").select("doc_id", (340 + 100 * (F.col("doc_id") % 4)).alias("width"), F.lit(200.0).alias("approved_y"))
    return S.cell_programmes(w.drop("rect_id"), r, pages, ["doc_id"], F.length("text") > 5)


# ---- headers, pages that follow, characters -----------------------------------------------------------


def _header_words(spark, d):
    """Three pages a part: the header is printed on the first; the third has too few stage lines for every fifth part."""
    k = F.col("p_partkey")
    word = lambda t, x, y, page=1: F.struct(F.lit(page).alias("page_no"), (t if isinstance(t, Column) else F.lit(t)).alias("text"), F.lit(float(x)).alias("x0"), (F.lit(y) if not isinstance(y, Column) else y).cast("double").alias("y0"))
    slip = (k % 4) * 10
    words = [word("Development", 40, 100), word("Type", 120, 104), word("Indication", 200, 100 + k % 3), word("Region", 300, 100 + slip), word("Country", 320, 101), word("Stage", 400, 100),
             word("Phase", 390, 160), word("Indications", 30, 100), word(F.col("p_brand"), 40, 140)]
    words += [word(F.when((k % 5 == 0) & F.lit(page == 3 and y == 60), "x").otherwise("Phase " + str(1 + y % 3)), 395, y, page) for page in (2, 3) for y in (30, 60)]
    w = table(spark, d, "part").select(k.alias("doc_id"), F.posexplode(F.array(*words)).alias("pos", "w")).select("doc_id", "pos", "w.*")
    return w.withColumns({"x1": F.col("x0") + 30, "y1": F.col("y0") + 10})


@query("G03_development_header", """SELECT p_partkey AS doc_id, 1 AS page_no, greatest(105 + p_partkey % 3, CASE WHEN p_partkey % 4 = 0 THEN 105 ELSE 106 END)::DOUBLE AS header_y, 40.0::DOUBLE AS asset_x, 120.0::DOUBLE AS asset_right_x, 200.0::DOUBLE AS indication_x,
 CASE WHEN p_partkey % 4 = 0 THEN 300.0 ELSE 320.0 END::DOUBLE AS region_x, 400.0::DOUBLE AS stage_x FROM part""")
def g03_development(spark, d):
    return H.development_header(_header_words(spark, d), G.PAGE)


@query("G10_carried_headers", """SELECT p_partkey AS doc_id, page_no, CASE page_no WHEN 1 THEN greatest(105 + p_partkey % 3, CASE WHEN p_partkey % 4 = 0 THEN 105 ELSE 106 END) ELSE 0 END::DOUBLE AS header_y, page_no > 1 AS inherited, CASE WHEN p_partkey % 4 = 0 THEN 300.0 ELSE 320.0 END::DOUBLE AS region_x
FROM part, (SELECT unnest([1, 2, 3]) AS page_no) WHERE page_no < 3 OR p_partkey % 5 > 0""")
def g10_headers(spark, d):
    w = _header_words(spark, d)
    out = H.carried_headers(w, H.development_header(w, G.PAGE), ["doc_id"], "page_no")
    return out.select("doc_id", "page_no", "header_y", "inherited", "region_x")


@query("G03_column_header", """SELECT p_partkey AS doc_id, 110.0::DOUBLE + CASE WHEN p_partkey % 3 = 0 THEN 9 ELSE 0 END AS header_bottom, 40.0::DOUBLE AS x_compound, 120.0::DOUBLE AS x_mechanism, 230.0::DOUBLE AS x_indication, 300.0::DOUBLE AS x_phase, 400.0::DOUBLE AS x_submission FROM part WHERE p_partkey % 7 > 0""")
def g03_columns(spark, d):
    k = F.col("p_partkey")
    word = lambda t, x, y: F.struct((t if isinstance(t, Column) else F.lit(t)).alias("text"), F.lit(float(x)).alias("x0"), (F.lit(y) if not isinstance(y, Column) else y).cast("double").alias("y0"))
    words = [word("Phase", 60, 40), word("Compound", 40, 100), word("MECHANISM", 120, 100), word("indication", 200, 100), word("Indication", 230, 100), word("Phase", 300, F.when(k % 3 == 0, 109).otherwise(100)),
             word(F.when(k % 7 == 0, "other").otherwise("Submission"), 400, 100), word("Compound", 50, 300)]
    w = table(spark, d, "part").select(k.alias("doc_id"), F.posexplode(F.array(*words)).alias("pos", "w")).select("doc_id", "pos", "w.*")
    return H.column_header(w.withColumns({"x1": F.col("x0") + 30, "y1": F.col("y0") + 10}), ["doc_id"])


@query("G10_carried_indications", """WITH r AS (SELECT l_orderkey AS doc_id, l_linenumber AS row_id, l_partkey AS p, l_suppkey AS s, l_partkey % 2 AS code, CASE WHEN l_suppkey % 3 = 0 THEN 'for ' || l_suppkey % 4 END AS g FROM lineitem)
SELECT doc_id, row_id, p, s, code, coalesce(last_value(g IGNORE NULLS) OVER (PARTITION BY doc_id, code ORDER BY row_id, p, s ROWS UNBOUNDED PRECEDING),
  CASE WHEN min(g) OVER (PARTITION BY doc_id, code) = max(g) OVER (PARTITION BY doc_id, code) THEN min(g) OVER (PARTITION BY doc_id, code) END, '') AS indication FROM r""")
def g10_indications(spark, d):
    s = F.col("l_suppkey")
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("y"), F.col("l_linenumber").alias("n"), F.struct("l_partkey", "l_suppkey").alias("row_id"),
                                              (F.col("l_partkey") % 2).alias("code"), F.when(s % 3 == 0, F.concat(F.lit("for "), s % 4)).alias("indication"))
    return H.carried_indications(rows, ["doc_id"]).select("doc_id", F.col("n").alias("row_id"), F.col("row_id.l_partkey").alias("p"), F.col("row_id.l_suppkey").alias("s"), "code", "indication")


@query("G31_character_anchors", "SELECT p_partkey AS doc_id, 120.0::DOUBLE + 30 * (p_partkey % 4) AS y, 'PT-' || p_partkey AS code FROM part WHERE p_partkey % 6 > 0")
def g31_characters(spark, d):
    k = F.col("p_partkey")
    text = F.concat(F.lit("PT-"), k.cast("string"))
    p = table(spark, d, "part").select(k.alias("doc_id"), text.alias("text"), (115 + 30 * (k % 4)).cast("double").alias("y0"), F.when(k % 6 == 0, 60.0).otherwise(100.0).alias("asset_right_x"))
    chars = p.select("doc_id", "y0", F.posexplode(F.split("text", "")).alias("i", "ch")).select(
        "doc_id", (F.col("y0") + F.col("i") % 2).alias("y0"), (F.col("y0") + 10 - F.col("i") % 2).alias("y1"), (40.0 + 5 * F.col("i")).alias("x0"), "ch")
    above = chars.withColumns({"y0": F.lit(20.0), "y1": F.lit(30.0)})
    heads = p.select("doc_id", F.lit(100.0).alias("header_y"), F.when(F.col("doc_id") % 6 == 0, 75.0).otherwise(45.0).alias("asset_x"), "asset_right_x")
    return H.character_anchors(chars.unionByName(above), heads, ["doc_id"])


# ---- programme rows of printed tables -----------------------------------------------------------


T = f"WITH {B.PHASE_TABLE_SQL}"
AREA_SQL = "['Oncology', 'Internal Medicine', 'Vaccines'][1 + page_no % 4]"


def _no_labels_sql(x: str) -> str:
    x = B.clean_sql(f"translate({x}, chr(173) || chr(61607) || chr(9658), '')")
    return B.clean_sql(f"regexp_replace(regexp_replace({x}, '(?i)\\b(Phase\\s*[123]|Registration)\\b', '', 'g'), '(?i)\\b(New Molecular Entity|Product Enhancement)\\b', '', 'g')")


@query("G05_table_pages", f"""{T} SELECT doc_id, page_no::INT AS page_no, CASE WHEN page_no % 4 = 3 THEN 'discontinued' ELSE 'table' END AS status, CASE WHEN page_no % 4 = 3 THEN '' ELSE {AREA_SQL} END AS area,
 32.0::DOUBLE AS body_top, 537.0::DOUBLE AS stop_y FROM tw GROUP BY 1, 2, 3, 4""")
def g05_pages(spark, d):
    return P.table_pages(B.phase_table_words(spark, d), G.PAGE).select(*G.PAGE, "status", "area", "body_top", "stop_y")


@query("G05_phase_cells", f"""{T} SELECT doc_id, page_no::INT AS page_no, (40 + 24 * band0 + CASE WHEN last_slot = 15 THEN 5 ELSE 6 END)::DOUBLE AS y, CASE WHEN kind = 0 THEN 'Registration' ELSE 'Phase ' || (1 + kind % 3) END AS phase_raw,
 CASE WHEN kind = 0 THEN 'Registration' ELSE 'Phase ' || (1 + kind % 3) END || CASE WHEN last_slot < 17 THEN '' WHEN kind = 1 THEN ' Product' WHEN kind = 3 THEN ' Other' ELSE ' New' END AS line_text
 FROM tr WHERE last_slot >= 16 OR last_slot = 15 AND kind = 0""")
def g05_cells(spark, d):
    return P.page_cells(P.page_bodies(B.phase_table_words(spark, d), G.PAGE), G.PAGE)


@query("G07_programme_rows", f"""{T}, h AS (SELECT *, last_slot >= 16 OR last_slot = 15 AND kind = 0 AS has FROM tr), a AS (SELECT *, max(CASE WHEN has THEN band0 END) OVER (PARTITION BY doc_id, page_no ORDER BY band0) AS anchor FROM h),
b AS (SELECT doc_id, page_no, anchor, max(kind) FILTER (has) AS kind, max(last_slot) FILTER (has) AS last_slot, {B.clean_sql("string_agg(compound, ' ' ORDER BY band0)")} AS compound, string_agg(mechanism, ' ' ORDER BY band0) AS mechanism, string_agg(indication, ' ' ORDER BY band0) AS indication
 FROM a WHERE anchor IS NOT NULL GROUP BY 1, 2, 3),
r AS (SELECT doc_id, page_no, anchor + 1 AS band, {AREA_SQL} AS area, {_no_labels_sql("replace(regexp_replace(regexp_replace(compound, '^[►▶]+\\s*', ''), '\\s+[0-9]{1,2}$', ''), 'Dekavil2', 'Dekavil')")} AS asset,
 {_no_labels_sql('mechanism')} AS mechanism, {_no_labels_sql('indication')} AS indication, CASE WHEN kind = 0 THEN 'Filed / Registration' ELSE 'Phase ' || (1 + kind % 3) END AS phase,
 CASE WHEN kind = 1 AND last_slot >= 18 THEN 'Product Enhancement' WHEN kind IN (0, 2, 4) AND last_slot = 19 THEN 'New Molecular Entity' ELSE '' END AS submission_type, contains(compound, 'Dekavil2')::INT AS n_corrections FROM b)
SELECT doc_id, page_no::INT AS page_no, band::INT AS band, area, asset, mechanism, indication, phase, submission_type, n_corrections, CASE WHEN contains(asset, 'PF-07220060') THEN 'PF-07220060' ELSE '' END AS code,
 CASE WHEN submission_type = '' THEN 'no submission' WHEN asset = '' THEN 'no asset' WHEN indication = '' THEN 'no indication' ELSE 'row' END AS status FROM r""")
def g07_rows(spark, d):
    return P.programme_rows(B.phase_table_words(spark, d), G.PAGE).withColumn("n_corrections", F.size("corrections")).drop("corrections")
