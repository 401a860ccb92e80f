"""Joins by position on a page: rows meet in grid cells, the exact test follows in the row.

A cell holds what lies near one spot, so the pairs that are looked at grow with the rows of a page and
not with their square, and a page may be cut over tasks by its cells.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import identity as I
from ..functions import phase as P
from ..functions.text import clean, let, norm
from .folds import in_line_order, page_arrays, running_mean_groups

#: Order of phases; a band that names several has the highest.
PHASE_RANK = ["Preclinical", "Phase 1", "Phase 2", "Phase 3", "Phase 4", "Filed / Registration"]


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / size).cast("long")


def _beside(points: DataFrame, others: DataFrame, by: list[str], cell: list[str]) -> DataFrame:
    """Points with each of the others in their cell (the columns ``cell`` of a page ``by``) as ``_r``. A page's rows of both sides
    are put beside each other in one row and taken apart again, and meet in a window over the cell: where both sides are dealt by
    the page already, no row is shuffled again, and none is broadcast. No union stands in between, since after a reused exchange
    Spark may give one other partitions than it has planned with (spark.sql.unionOutputPartitioning)."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cell])
    own, held = [c for c in points.columns if c not in by], [c for c in others.columns if c not in [*by, *cell]]
    point, other = F.struct(*own), F.struct(*held)
    none = lambda df, c: F.lit(None).cast(df.select(c.alias("c")).schema["c"].dataType)
    row = lambda p, r: F.struct(*cell, p.alias("_p"), r.alias("_r"))
    pages = lambda df, c, name: df.filter(known).groupBy(*by).agg(F.collect_list(c).alias(name))
    both = pages(points, row(point, none(others, other)), "_a").join(pages(others, row(none(points, point), other), "_b").hint("merge"), by)
    both = both.select(*by, F.explode_outer(F.concat("_a", "_b")).alias("_e")).select(*by, "_e.*")
    near = F.collect_list("_r").over(Window.partitionBy(*by, *cell))
    return both.withColumn("_near", near).filter("_p is not null").select(*by, "_p.*", F.explode("_near").alias("_r"))


def in_ranges(points: DataFrame, ranges: DataFrame, by: list[str], position: Column, low: str, high: str, cell: float) -> DataFrame:
    """Points with every range (low to high, both ends included) of their key that holds their position."""
    own, held = [c for c in points.columns if c not in by], [c for c in ranges.columns if c not in by]
    p = points.withColumn("_c", _cell(position, cell))
    r = ranges.withColumn("_c", F.explode(F.sequence(_cell(F.col(low), cell), _cell(F.col(high), cell))))
    d = _beside(p, r, by, ["_c"]).select(*by, *own, *[F.col("_r")[c].alias(c) for c in held])
    return d.filter(position.between(F.col(low), F.col(high)))


def contained(points: DataFrame, rects: DataFrame, by: list[str], cell: float = 48.0, margin: float = 0.0, width: float | None = None) -> DataFrame:
    """Points (cx, cy) with every rectangle (rx0, ry0, rx1, ry1) of their key that holds them; each pair once.
    Cells are ``cell`` high and ``width`` wide, square by default."""
    span = lambda a, b, size: F.sequence(_cell(F.col(a) - margin, size), _cell(F.col(b) + margin, size))
    width = width or cell
    own, held = [c for c in points.columns if c not in by], [c for c in rects.columns if c not in by]
    r = rects.filter(f"rx0 - {margin} <= rx1 + {margin} and ry0 - {margin} <= ry1 + {margin}")
    r = r.withColumn("_cx", F.explode(span("rx0", "rx1", width))).withColumn("_cy", F.explode(span("ry0", "ry1", cell)))
    p = points.withColumn("_cx", _cell(F.col("cx"), width)).withColumn("_cy", _cell(F.col("cy"), cell))
    d = _beside(p, r, by, ["_cx", "_cy"]).select(*by, *own, *[F.col("_r")[c].alias(c) for c in held])
    inside = F.col("cx").between(F.col("rx0") - margin, F.col("rx1") + margin) & F.col("cy").between(F.col("ry0") - margin, F.col("ry1") + margin)
    return d.filter(inside)


def near_pairs(probes: DataFrame, nodes: DataFrame, by: list[str], probe_y: str, node_y: str, limit: float) -> DataFrame:
    """Probes with every node of their key at most ``limit`` above or below. Both sides grow with the pages: a small
    file may hold many rows, so neither is to be sent to the driver as a broadcast."""
    p = probes.withColumn("_b", _cell(F.col(probe_y), limit)).withColumn("_c", F.explode(F.array(F.col("_b") - 1, F.col("_b"), F.col("_b") + 1)))
    n = nodes.withColumn("_c", _cell(F.col(node_y), limit))
    return p.join(n.hint("merge"), [*by, "_c"]).filter(F.abs(F.col(node_y) - F.col(probe_y)) <= limit).drop("_b", "_c")


# ---- cells of a chart -----------------------------------------------------------------


def span_text(spans: Column, tolerance: float = 4.0) -> Column:
    """Text of sorted spans (y0, x0, text, _y) in reading order: lines by running mean of the centres, then from the left."""
    words = in_line_order(spans, tolerance, lambda w: F.struct(w["x0"].alias("x0"), w["y0"].alias("y0"), w["text"].alias("text")))
    return clean(F.array_join(F.transform(words, lambda w: w["text"]), " "))


def region_status(cx: Column, cy: Column, width: Column, approved_y: Column) -> Column:
    """Status of a chart's region: by the share of the page's width, and in the last one by the banner's height."""
    share = cx / width
    return F.when(share < 0.375, "Phase 2").when(share < 0.855, "Phase 3").when(cy < approved_y, "Approved").otherwise("Reg Review")


def cell_programmes(spans: DataFrame, rects: DataFrame, pages: DataFrame, by: list[str], style: Column) -> DataFrame:
    """(by, rect_id, asset, indication, status) of every rectangle that holds text in both styles.

    spans(x0, y0, x1, y1, text), rects(rect_id, x0, y0, x1, y1), pages(width, approved_y). Text is taken a
    point beyond the edges; cells that are headings or notes are left out. Spans meet their rectangle once, and
    its three texts are read from one sorted array."""
    s = spans.withColumns({"cx": (F.col("x0") + F.col("x1")) / 2, "cy": (F.col("y0") + F.col("y1")) / 2, "text": clean(F.col("text"))}).filter("text <> ''")
    s = s.withColumn("styled", style).select(*by, "x0", "y0", "cx", "cy", "text", "styled")
    r = rects.select(*by, "rect_id", *[F.col(c).cast("double").alias(f"r{c}") for c in ("x0", "y0", "x1", "y1")])
    d = contained(s, r, by, margin=1.0, width=240.0)
    keys = [*by, "rect_id"]
    held = F.sort_array(F.collect_list(F.struct("y0", "x0", "text", F.col("cy").cast("double").alias("_y"), "styled")))
    texts = let(held, lambda m: F.struct(span_text(m).alias("whole"), span_text(F.filter(m, lambda w: ~w["styled"])).alias("asset"),
                                         span_text(F.filter(m, lambda w: w["styled"])).alias("indication")))
    out = r.join(d.groupBy(*keys).agg(texts.alias("t")).select(*keys, "t.*"), keys).join(pages, by)
    note = let(norm(F.col("whole")), lambda n: n.isin("nme", "nilex other") | n.rlike("addition or milestone achieved|updates since"))
    status = region_status((F.col("rx0") + F.col("rx1")) / 2, (F.col("ry0") + F.col("ry1")) / 2, F.col("width"), F.col("approved_y"))
    return out.filter(~note & (F.col("asset") != "") & (F.col("indication") != "")).select(*keys, "asset", "indication", status.alias("status"))


# ---- rows of a rendered grid -------------------------------------------------------------


def header_row(nodes: DataFrame, by: list[str]) -> DataFrame:
    """(by, cx, phase): the phase headings of each page, found in the page itself.

    Headings of one phase within 24 across and 55 down of one kept before are its copies. Rows are groups of
    the rest by running mean (26); the one with most headings of at least two phases is the header, the
    upper one on ties."""
    heads = nodes.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in by])).withColumn("phase", P.explicit("text")).filter((F.col("phase") != "") & (F.length(clean(F.col("text"))) <= 60))
    pages = page_arrays(heads, by, [F.col("cy").cast("double"), F.col("cx").cast("double"), F.col("phase")], cy=F.col("cy").cast("double"), cx=F.col("cx").cast("double"), phase=F.col("phase"))
    copy = lambda k, x: (k["phase"] == x["phase"]) & (F.abs(k["cx"] - x["cx"]) <= 24.0) & (F.abs(k["cy"] - x["cy"]) <= 55.0)
    rows = F.transform("m", lambda x: F.struct(x["cy"].alias("cy"), x["cx"].alias("cx"), x["phase"].alias("phase")).cast("struct<cy:double,cx:double,phase:string>"))
    none = F.array().cast("array<struct<cy:double,cx:double,phase:string>>")
    kept = F.aggregate(rows, none, lambda s, x: F.when(F.exists(s, lambda k: copy(k, x)), s).otherwise(F.concat(s, F.array(x))))
    d = pages.select(*by, F.explode(kept).alias("h")).select(*by, "h.*")
    d = running_mean_groups(d, by, "cy", 26.0, "row", ["cy", "cx", "phase"])
    of_row = Window.partitionBy(*by, "row")
    d = d.withColumns({"n": F.count("*").over(of_row), "phases": F.size(F.collect_set("phase").over(of_row))}).filter("phases >= 2")
    best = F.max(F.struct("n", (-F.col("row")).alias("r"))).over(Window.partitionBy(*by))
    return d.withColumn("best", best["r"]).filter("row = -best").select(*by, "cx", "phase")


def grid_rows(nodes: DataFrame, bands: DataFrame, by: list[str], reach: float = 180.0, cell: float = 64.0) -> DataFrame:
    """(by, band, asset, indication, phase, evidence) of row bands that give all three.

    nodes(x, y, width, cx, cy, text, structural), bands(band, top, bottom). The phase is the highest one that
    is printed in the band, else that of the heading nearest to the right edge of the band's bars, within
    ``reach``. Asset and indication stand left of the first heading; a text that is printed twice counts once.
    Every step works on the rows of a page or a band: nodes and bands dealt by their page are not shuffled again."""
    heads = header_row(nodes, by).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("cx", "phase"))).alias("h"))
    n = nodes.withColumns({"text": clean(F.col("text")), "cy": F.col("cy").cast("double"), "x": F.col("x").cast("double"), "cx": F.col("cx").cast("double")})
    d = in_ranges(n, bands.filter("band is not null").select(*by, "band", "top", "bottom"), by, F.col("cy"), "top", "bottom", cell)
    keys = [*by, "band"]
    band = Window.partitionBy(*keys)
    rank = F.coalesce(*[F.when(F.col("own") == p, i) for i, p in enumerate(PHASE_RANK)], F.lit(-1))
    d = d.withColumn("own", P.explicit("text")).withColumn("rank", F.when((F.col("text") != "") & (F.col("own") != ""), rank))
    edge = F.max(F.when(F.col("structural") & (F.col("width") >= 18), F.col("x") + F.col("width")))
    d = d.withColumns({"printed": F.max(F.when(F.col("rank") >= 0, F.struct("rank", "own"))).over(band), "edge": edge.over(band)})
    text = d.filter((F.col("text") != "") & (F.col("own") == "")).join(heads.hint("merge"), by, "left").withColumn("first", F.get("h", F.lit(0))["cx"])
    text = text.filter((F.length("text") <= 220) & (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) <= 24))
    text = text.filter(F.col("first").isNull() | (F.col("cx") < F.col("first") - 8)).withColumn("key", norm(F.col("text"))).filter("key <> ''")
    facts = F.first(F.struct("printed", "edge", "h")).alias("facts")
    once = text.groupBy(*keys, "key").agg(F.min(F.struct("x", "y", "text", "cx")).alias("m"), facts).select(*keys, "m.*", "facts")
    can = I.is_identity_candidate("text") & (F.length("text") <= 110)
    right = once.withColumn("a", F.min(F.when(can, F.struct("x", "y", "text", "cx"))).over(band)).filter((F.col("cx") - F.col("a.cx") >= 28) & (F.length("text") <= 180))
    nearest = F.min(F.struct((F.col("cx") - F.col("a.cx")).alias("d"), (-F.length("text")).alias("l"), "x", "y", "text", F.col("a.text").alias("asset"))).alias("i")
    found = right.groupBy(*keys).agg(nearest, F.first("facts").alias("facts")).select(*keys, F.col("i.asset").alias("asset"), F.col("i.text").alias("indication"), "facts.*")
    far = F.array_min(F.transform("h", lambda h: F.struct(F.abs(h["cx"] - F.col("edge")).alias("d"), h["cx"].alias("cx"), h["phase"].alias("phase"))))
    found = found.withColumn("near", far).withColumn("phase", F.coalesce(F.col("printed.own"), F.when(F.col("near.d") <= reach, F.col("near.phase"))))
    evidence = F.when(F.col("printed").isNotNull(), "SOURCE_LAYOUT_TEXT").otherwise("SOURCE_LAYOUT_GEOMETRY")
    return found.filter("phase is not null").select(*keys, "asset", "indication", "phase", evidence.alias("evidence"))
