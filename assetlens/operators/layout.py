"""Page geometry: lines, columns, bands, anchors, bars and containment.

Inputs are words, nodes and rectangles of document pages. Windows run over one page (or
one document), whose size is bounded by the page. Streams that are not pages use the
chunked scans of ``ordered``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import identity as I
from ..functions import phase as P
from ..functions.text import clean
from .folds import distinct_bands as _distinct_bands
from .folds import running_mean_groups
from .ordered import Ordered
from .spatial import contained, in_ranges, near_pairs

PAGE = ["doc_id", "page_no"]


def center_y(y0="y0", y1="y1") -> Column:
    return (F.col(y0) + F.col(y1)) / 2


# ---- lines and text ------------------------------------------------------------


def gap_groups(df: DataFrame, by: list[str], position: Column, tie: list[str], tolerance: float, name: str) -> DataFrame:
    """Neighbours whose positions differ by at most ``tolerance`` share a group id."""
    w = Window.partitionBy(*by).orderBy("_p", *tie)
    d = df.withColumn("_p", position)
    d = d.withColumn("_new", F.when(F.col("_p") - F.lag("_p").over(w) <= tolerance, 0).otherwise(1))
    return d.withColumn(name, F.sum("_new").over(w)).drop("_p", "_new")


def line_groups(words: DataFrame, tolerance: float = 3.0) -> DataFrame:
    """Lines of a page: words from top to bottom join the last line while their centre is near its running mean."""
    return running_mean_groups(words, PAGE, center_y(), tolerance, "line", ["y0", "x0", "pos"])


def reading_text(words: DataFrame, by: list[str], line: str = "line") -> DataFrame:
    """Words of a group joined in reading order."""
    return words.groupBy(*by).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col(line), F.col("x0"), F.col("text")))), lambda w: w["text"]), " ").alias("line_text"))


def dedupe_nodes(nodes: DataFrame) -> DataFrame:
    """Visible nodes, one per quantised box and text, with centre points."""
    key = [F.bround(F.col("x") / 4), F.bround(F.col("y") / 4), F.bround(F.col("width") / 6), F.lower(clean("text", "soft"))]
    w = Window.partitionBy("doc_id", *key).orderBy("node_id")
    d = nodes.filter((F.col("width") > 0) & (F.col("height") > 0) & (clean("text", "plain") != ""))
    d = d.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")
    return d.withColumn("cx", F.col("x") + F.col("width") / 2).withColumn("cy", F.col("y") + F.col("height") / 2)


# ---- headers and columns ----------------------------------------------------------


def header_rows(words: DataFrame, labels: dict[str, str], tolerance: float = 12.0) -> DataFrame:
    """First place on each page where every label occurs within ``tolerance`` points of
    height: header_y and the x of each label. ``labels`` maps a name to a pattern."""
    kind = F.coalesce(*[F.when(F.lower("text").rlike(p), F.lit(k)) for k, p in labels.items()])
    d = words.withColumn("label", kind).filter("label is not null").withColumn("cy", center_y())
    w = Window.partitionBy(*PAGE).orderBy("cy").rangeBetween(0, int(tolerance))
    d = d.withColumn("near", F.collect_list(F.struct("label", "x0")).over(w)).withColumn("top", F.col("cy"))
    d = d.filter(F.size(F.array_distinct(F.transform("near", lambda n: n["label"]))) == len(labels))
    first = d.groupBy(*PAGE).agg(F.min(F.struct("top", "near")).alias("m"))
    x = lambda k: F.array_min(F.transform(F.filter("m.near", lambda n: n["label"] == k), lambda n: n["x0"]))
    return first.select(*PAGE, F.col("m.top").alias("header_y"), *[x(k).alias(f"x_{k}") for k in labels])


def column_by_start(x: Column, starts: Column, tolerance: float = 4.0) -> Column:
    """Index of the last column start at or left of x; 0 when x is left of all."""
    return F.greatest(F.size(F.filter(starts, lambda s: s <= x + tolerance)) - 1, F.lit(0))


def column_by_midpoint(x: Column, centers: Column) -> Column:
    """Index by the midpoints between neighbouring centres."""
    mids = F.transform(F.slice(centers, 2, F.size(centers)), lambda c, i: (c + F.get(centers, i)) / 2)
    return F.size(F.filter(mids, lambda m: m <= x))


def separated(df: DataFrame, by: list[str], position: str, distance: float) -> DataFrame:
    """Drops positions closer than ``distance`` to the one before."""
    w = Window.partitionBy(*by).orderBy(position)
    gap = F.col(position) - F.lag(position).over(w)
    return df.withColumn("_g", gap).filter((F.col("_g") >= distance) | F.col("_g").isNull()).drop("_g")


def row_bands(anchors: DataFrame, by: list[str], position: str, margin: float = 0.0) -> DataFrame:
    """Bands bounded by the midpoints to the neighbouring anchors."""
    w = Window.partitionBy(*by).orderBy(position)
    y = F.col(position)
    return (anchors.withColumn("band", F.row_number().over(w))
            .withColumn("top", F.coalesce((y + F.lag(position).over(w)) / 2, y - F.lit(1e9)) - margin)
            .withColumn("bottom", F.coalesce((y + F.lead(position).over(w)) / 2, y + F.lit(1e9)) + margin))


def assign_bands(words: DataFrame, bands: DataFrame, by: list[str], position: Column) -> DataFrame:
    """Band of every word: the last band whose top is at or above it, by one sort per page."""
    b = bands.select(*by, F.col("top").alias("_y"), F.col("band").alias("_b"))
    d = words.withColumn("_y", position).withColumn("_b", F.lit(None).cast("int"))
    both = d.unionByName(b, allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy(F.col("_y"), F.col("_b").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("band", F.last("_b", True).over(w)).filter("_b is null and band is not null")
    return out.drop("_y", "_b")


def band_rows(words: DataFrame, bands: DataFrame, starts: Column, columns: list[str]) -> DataFrame:
    """One row per band with the reading text of every column."""
    d = assign_bands(words, bands, PAGE, center_y()).withColumn("col", column_by_start(F.col("x0"), starts))
    d = reading_text(d.withColumn("line", F.bround(F.col("y0"), 1)), [*PAGE, "band", "col"])
    return d.groupBy(*PAGE, "band").agg(*[F.coalesce(F.max(F.when(F.col("col") == i, F.col("line_text"))), F.lit("")).alias(c)
                                          for i, c in enumerate(columns)])


# ---- anchors ---------------------------------------------------------------------------


def active_anchor(probes: DataFrame, anchors: DataFrame, keys: list[str], rows_per_chunk: int = 250_000) -> DataFrame:
    """As-of association. probes(keys, probe_id, y) meet anchors(keys, y, code): the last
    anchor at most 4 below and 140 above wins when within 35; a forward anchor within 18 wins
    when 18 nearer; then the preceding, then the forward one. Two chunked scans, no join."""
    p = probes.select(*keys, F.col("y"), F.col("probe_id"), F.lit(None).cast("struct<y:double,code:string>").alias("a"), F.lit(0).alias("is_anchor"))
    a = anchors.select(*keys, F.col("y").alias("cy"), F.struct(F.col("y").cast("double").alias("y"), F.col("code")).alias("a"), F.lit(1).alias("is_anchor"))
    back = p.withColumn("o", F.col("y")).unionByName(a.withColumn("o", F.col("cy") - 4.0).drop("cy"), allowMissingColumns=True)
    back = back.withColumn("t", -F.col("is_anchor")).withColumn("z", F.coalesce(F.col("a.y"), F.lit(0.0))).withColumn("pid", F.coalesce("probe_id", F.lit(-1)))
    before = Ordered(back, keys, ["o", "t", "z", "pid"], rows_per_chunk).carry_forward(F.col("a"), "before").frame().filter("is_anchor = 0")
    ahead = before.select(*keys, "y", "probe_id", "a", "is_anchor", "before").withColumn("o", -F.col("y")).unionByName(
        a.withColumn("o", -F.col("cy")).drop("cy"), allowMissingColumns=True).withColumn("t", F.col("is_anchor")).withColumn("pid", F.coalesce("probe_id", F.lit(-1)))
    both = Ordered(ahead, keys, ["o", "t", "pid"], rows_per_chunk).carry_forward(F.col("a"), "after").frame().filter("is_anchor = 0")
    y = F.col("y")
    prev = F.when(y - F.col("before.y") <= 140.0, F.col("before"))
    nxt = F.when(F.col("after.y") <= y + 18.0, F.col("after"))
    both = both.withColumn("prev", prev).withColumn("nxt", nxt)
    pick = (F.when(y - F.col("prev.y") <= 35.0, F.col("prev"))
            .when(F.col("nxt").isNotNull() & (F.col("prev").isNull() | (F.col("nxt.y") - y + 18.0 < y - F.col("prev.y"))), F.col("nxt"))
            .otherwise(F.coalesce("prev", "nxt")))
    return both.withColumn("m", pick).select(*keys, "probe_id", F.col("m.y").alias("anchor_y"), F.coalesce("m.code", F.lit("")).alias("code"))


def between_anchors(lines: DataFrame, is_anchor: Column, by: list[str], position: str, pattern: str) -> DataFrame:
    """Attribute printed between an anchor and the next one."""
    w = Window.partitionBy(*by).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    d = lines.withColumn("_a", F.when(is_anchor, F.struct(F.col(position).alias("y"), F.col("line_text").alias("t")))).withColumn("anchor", F.last("_a", True).over(w))
    d = d.filter("anchor is not null").withColumn("hit", F.when(F.col("_a").isNull(), F.regexp_extract("line_text", pattern, 1)))
    return d.groupBy(*by, F.col("anchor.y").alias("anchor_y"), F.col("anchor.t").alias("anchor_text")).agg(
        F.coalesce(F.min_by(F.nullif("hit", F.lit("")), F.when(F.col("hit") != "", F.col(position))), F.lit("")).alias("attribute"))


def merged_anchors(a: DataFrame, b: DataFrame, by: list[str], tolerance: float = 4.5) -> DataFrame:
    """Two anchor lists; anchors within the tolerance become one with the longer text."""
    d = gap_groups(a.unionByName(b), by, F.col("y"), ["code"], tolerance, "grp")
    return d.groupBy(*by, "grp").agg(F.max(F.struct(F.length("code").alias("n"), F.col("code"), "y")).alias("m")).select(
        *by, F.col("m.y").alias("y"), F.col("m.code").alias("code"))


def nearest_two(probes: DataFrame, anchors: DataFrame, by: list[str]) -> DataFrame:
    """Distances of the nearest and second nearest anchor on the page, and the nearest code
    when it is within 35 and 12 nearer than the runner-up."""
    w = Window.partitionBy(*by).orderBy("y")
    here = F.struct(F.col("y").alias("y"), F.col("code").alias("code"))
    a = anchors.select(*by, "y", "code").withColumn("here", here)
    a = a.withColumn("back2", F.array_compact(F.array("here", F.lag("here").over(w)))).withColumn("next2", F.array_compact(F.array("here", F.lead("here").over(w))))
    d = probes.select(*by, "probe_id", "y").unionByName(a.drop("code", "here"), allowMissingColumns=True)
    up = Window.partitionBy(*by).orderBy("y", F.col("probe_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*by).orderBy("y", F.col("probe_id").asc_nulls_first()).rowsBetween(0, Window.unboundedFollowing)
    d = d.withColumn("b", F.last("back2", True).over(up)).withColumn("n", F.first("next2", True).over(down)).filter("probe_id is not null")
    none = F.array().cast("array<struct<y:double,code:string>>")
    ranked = F.array_sort(F.transform(F.array_distinct(F.concat(F.coalesce("b", none), F.coalesce("n", none))),
                                      lambda c: F.struct(F.abs(c["y"] - F.col("y")).alias("d"), c["code"].alias("code"))))
    d = d.withColumn("r", ranked).withColumn("d1", F.get("r", F.lit(0))["d"]).withColumn("d2", F.get("r", F.lit(1))["d"])
    clear = (F.col("d1") <= 35) & (F.col("d2").isNull() | (F.col("d2") - F.col("d1") >= 12))
    return d.select(*by, "probe_id", "d1", "d2", F.when(clear, F.get("r", F.lit(0))["code"]).alias("code"))


def boundary_overlap(rows: DataFrame, by: list[str], distance: float = 30.0, share: float = 0.55) -> DataFrame:
    """Neighbouring rows of different codes whose indications share most tokens."""
    w = Window.partitionBy(*by).orderBy("y")
    prev = lambda c: F.lag(c).over(w)
    d = rows.withColumns({"p_y": prev("y"), "p_code": prev("code"), "p_tokens": prev("tokens")})
    a, b = F.array_distinct("tokens"), F.array_distinct("p_tokens")
    ratio = F.size(F.array_intersect(a, b)) / F.greatest(F.least(F.size(a), F.size(b)), F.lit(1))
    return d.withColumn("overlap", F.round(ratio, 6)).filter((F.col("y") - F.col("p_y") <= distance) & (F.col("code") != F.col("p_code")) & (F.col("overlap") >= share))


def code_anchors(words: DataFrame, min_x: float, max_x: float) -> DataFrame:
    """Lines quantised to 3 points in the code column that look like a code; generic-name and
    region lines are evidence, not anchors."""
    d = words.filter((F.col("x0") >= min_x) & (F.col("x0") < max_x)).withColumn("cy", center_y())
    d = d.withColumn("q", F.bround(F.col("cy") / 3) * 3)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y0", "x0", "text"))), lambda x: x["text"]), " ")
    g = d.groupBy(*PAGE, "q").agg(text.alias("code"), F.round(F.avg("cy"), 6).alias("y"))
    region = r"(?i)\((?:US|U\.S\.|EU|Japan|China|Global)\)"
    return g.filter(I.is_code_like("code") & ~F.col("code").rlike("[<>]") & ~F.col("code").rlike(region)).select(*PAGE, "y", "code")


def bullet_entries(words: DataFrame, bullet: Column, starts: Column) -> DataFrame:
    """Entries inside phase columns: a bullet opens one, the text runs to the next bullet."""
    d = words.withColumn("col", column_by_start(F.col("x0"), starts)).withColumn("_b", bullet)
    w = Window.partitionBy(*PAGE, "col").orderBy("y0", "x0", "pos").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("entry", F.sum(F.when(F.col("_b"), 1).otherwise(0)).over(w)).filter("entry > 0 and not _b")
    return reading_text(d.withColumn("line", F.col("y0")), [*PAGE, "col", "entry"])


# ---- carry-forward and islands -----------------------------------------------------------


def carry_over_pages(rows: DataFrame, value: str, reset: str | None = None) -> DataFrame:
    """Fills ``value`` from earlier rows of the document in (page, y) order; with ``reset``
    only within runs of the same reset column."""
    by = ["doc_id"] + ([reset] if reset else [])
    w = Window.partitionBy(*by).orderBy("page_no", "y").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(value, F.coalesce(value, F.last(value, True).over(w)))


def unique_value(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """The only distinct value of a group, NULL when there are several."""
    return rows.groupBy(*by).agg(F.when(F.min(value) == F.max(value), F.min(value)).alias(value))


def clusters(df: DataFrame, by: list[str], x: str, tolerance: float = 24.0, least: int = 3) -> DataFrame:
    """Gap clusters of one coordinate that hold at least ``least`` members."""
    d = gap_groups(df, by, F.col(x), [], tolerance, "cluster")
    return d.groupBy(*by, "cluster").agg(F.round(F.avg(x), 6).alias("center"), F.count("*").alias("n")).filter(F.col("n") >= least)


def merged_intervals(df: DataFrame, keys: list[str], start: str, end: str, tie: str, gap: float, rows_per_chunk: int = 250_000) -> DataFrame:
    """Intervals whose gap is at most ``gap`` merge; chunked, so one key may be very large."""
    o = Ordered(df, keys, [start, tie], rows_per_chunk).running_max_before(F.col(end), "_reach")
    o = o.islands(F.coalesce(F.col(start) - F.col("_reach") > gap, F.lit(True)), "segment")
    return o.frame().groupBy(*keys, "segment").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n"))


def widest_gap(df: DataFrame, by: list[str], start: str, end: str, least: float = 14.0, left: float = 55.0) -> DataFrame:
    """Split point at the widest gap of a line, at least ``left`` from its left edge."""
    w = Window.partitionBy(*by).orderBy(start)
    d = df.withColumn("_n", F.lead(start).over(w)).withColumn("_l", F.min(start).over(Window.partitionBy(*by)))
    d = d.withColumn("gap", F.col("_n") - F.col(end)).filter((F.col("gap") >= least) & (F.col("_n") - F.col("_l") >= left))
    return d.groupBy(*by).agg(F.max(F.struct("gap", (-F.col("_n")).alias("m"))).alias("b")).select(
        *by, F.col("b.gap").alias("gap"), (-F.col("b.m")).alias("split_at"))


def joined_fragments(rows: DataFrame, by: list[str]) -> DataFrame:
    """Fragments that end in '+' continue with the next; a code shared by no other run of
    the group is attached to the whole group."""
    w = Window.partitionBy(*by).orderBy("y")
    d = rows.withColumn("_new", F.when(F.rtrim(F.lag("text").over(w)).endswith("+"), 0).otherwise(1)).withColumn("run", F.sum("_new").over(w))
    runs = d.groupBy(*by, "run").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y", "text"))), lambda x: F.trim(x["text"])), " ").alias("text"),
                                     F.min("y").alias("y"), F.max(F.nullif("code", F.lit(""))).alias("own_code"))
    return runs.join(unique_value(rows.filter("code <> ''"), by, "code"), by, "left").withColumn("code", F.coalesce("own_code", "code", F.lit(""))).drop("own_code")


def declared_choice(declared: DataFrame, anchored: DataFrame, visual: DataFrame) -> DataFrame:
    """Per page the visual rows when their number is the declared one, else the anchored rows."""
    n = visual.groupBy(*PAGE).agg(F.count("*").alias("n"))
    use = declared.join(n, PAGE, "left").select(*PAGE, (F.coalesce("n", F.lit(0)) == F.col("declared")).alias("use_visual"))
    v = visual.join(use.filter("use_visual"), PAGE, "left_semi").withColumn("variant", F.lit("visual"))
    a = anchored.join(use.filter("use_visual"), PAGE, "left_anti").withColumn("variant", F.lit("anchor"))
    return v.unionByName(a)


# ---- bars, colours and containment ------------------------------------------------------------


def nearest_label(x: Column, headers: Column) -> Column:
    """Label of the header centre nearest to x; headers is array<struct<x, label>>."""
    return F.array_min(F.transform(headers, lambda h: F.struct(F.abs(h["x"] - x).alias("d"), h["label"].alias("label"))))["label"]


def last_reached(x: Column, headers: Column, slack: float = 2.0) -> Column:
    """Label of the last header centre the bar end reaches."""
    hit = F.filter(headers, lambda h: h["x"] <= x + slack)
    return F.coalesce(F.array_max(hit)["label"], F.lit(""))


def learned_labels(bars: DataFrame, fill: str, label: str) -> DataFrame:
    """Blank labels take the label of their fill when that fill has exactly one."""
    known = unique_value(bars.filter(F.coalesce(F.col(label), F.lit("")) != ""), [fill], label).withColumnRenamed(label, "_l")
    return bars.join(known, fill, "left").withColumn(label, F.coalesce(F.nullif(F.col(label), F.lit("")), "_l", F.lit(""))).drop("_l")


def nearest_color(fill: Column, legend: Column, limit: float = 0.08) -> Column:
    """Legend label of the nearest colour; legend is array<struct<color, label>> of one page."""
    dist = lambda a: F.sqrt(F.aggregate(F.zip_with(fill, a, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v))
    best = F.array_min(F.transform(legend, lambda e: F.struct(dist(e["color"]).alias("d"), e["label"].alias("label"))))
    return F.when(best["d"] <= limit, best["label"])


def section_headers(words: DataFrame, band: float = 14.0, distance: float = 18.0) -> DataFrame:
    """Phase headings in the top band of a page, closer duplicates removed."""
    d = words.withColumn("phase", P.explicit("text")).filter("phase <> ''")
    d = d.withColumn("_top", F.min("y0").over(Window.partitionBy(*PAGE))).filter(F.col("y0") - F.col("_top") <= band)
    return separated(d, PAGE, "x0", distance).select(*PAGE, "phase", "x0")


def distinct_bands(bands: DataFrame, share: float = 0.72) -> DataFrame:
    """Row bands of each page without their near copies."""
    return _distinct_bands(bands, PAGE, share)


def fallback_bands(nodes: DataFrame, tolerance: float = 15.0, margin: float = 6.0) -> DataFrame:
    """Bands of at least two nodes whose centres lie near the running mean of the band."""
    d = running_mean_groups(nodes, ["doc_id"], "cy", tolerance, "band", ["cy", "node_id"])
    return d.groupBy("doc_id", "band").agg(F.count("*").alias("n"), (F.min("y") - margin).alias("top"), (F.max(F.col("y") + F.col("height")) + margin).alias("bottom")).filter("n >= 2")


def contained_words(words: DataFrame, rects: DataFrame) -> DataFrame:
    """Words whose centre lies in a rectangle of the same page."""
    w = words.withColumn("cx", (F.col("x0") + F.col("x1")) / 2).withColumn("cy", center_y())
    r = rects.select(*PAGE, "rect_id", F.col("x0").alias("rx0"), F.col("x1").alias("rx1"), F.col("y0").alias("ry0"), F.col("y1").alias("ry1"))
    return contained(w, r, PAGE, width=240.0).drop("rx0", "rx1", "ry0", "ry1")


def rect_rows(words: DataFrame, rects: DataFrame, style: Column) -> DataFrame:
    """Per rectangle the plain text (asset) and the text in the indication style."""
    d = contained_words(words, rects).withColumn("_s", style)
    text = lambda cond: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("y0", "x0", "text")))), lambda x: x["text"]), " ")
    return d.groupBy(*PAGE, "rect_id").agg(text(~F.col("_s")).alias("asset"), text(F.col("_s")).alias("indication"))


def nearest_node(probes: DataFrame, nodes: DataFrame, limit: float, after: bool = False) -> DataFrame:
    """Nearest node by vertical distance per probe of the same document, smaller y on ties."""
    n = nodes.select("doc_id", F.col("y").alias("ny"), "text")
    d = near_pairs(probes.select("doc_id", "probe_id", "y"), n, ["doc_id"], "y", "ny", limit)
    if after:
        d = d.filter(F.col("ny") + 1 >= F.col("y"))
    return d.groupBy("doc_id", "probe_id").agg(F.min(F.struct(F.abs(F.col("ny") - F.col("y")).alias("d"), "ny", "text")).alias("m")).select(
        "doc_id", "probe_id", F.col("m.ny").alias("node_y"), F.col("m.text").alias("text"))


def stage_rows(assets: DataFrame, nodes: DataFrame, bars: DataFrame, headers: Column) -> DataFrame:
    """Asset lines with the nearest indication below them and the stage their bar reaches."""
    ind = nearest_node(assets, nodes, 42.0, after=True).select("doc_id", "probe_id", F.col("text").alias("indication"))
    bar = nearest_node(assets, bars.withColumn("text", (F.col("x") + F.col("width")).cast("string")), 35.0).select(
        "doc_id", "probe_id", F.col("text").cast("double").alias("right_edge"))
    d = assets.join(ind, ["doc_id", "probe_id"], "left").join(bar, ["doc_id", "probe_id"], "left")
    return d.withColumn("stage", F.when(F.col("right_edge").isNotNull(), last_reached(F.col("right_edge"), headers)).otherwise(""))


def merged_asset_lines(lines: DataFrame, by: list[str], tolerance: float = 13.0) -> DataFrame:
    """Lines of one asset label printed over several lines."""
    d = gap_groups(lines, by, F.col("y"), [], tolerance, "grp")
    return d.groupBy(*by, "grp").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y", "text"))), lambda x: x["text"]), " ").alias("text"),
                                     F.round(F.avg("y"), 6).alias("y"))


def band_programmes(assets: DataFrame, bars: DataFrame, indications: DataFrame, by: list[str], headers: Column) -> DataFrame:
    """One row per asset band and indication: phase from the widest bar of the band."""
    bands = row_bands(assets, by, "y")
    put = lambda df: assign_bands(df, bands, by, F.col("y"))
    edge = put(bars).groupBy(*by, "band").agg(F.max_by(F.col("x") + F.col("width"), "width").alias("right_edge"))
    inds = put(indications).select(*by, "band", F.col("text").alias("indication"))
    d = bands.select(*by, "band", F.col("text").alias("asset")).join(edge, [*by, "band"], "left").join(inds, [*by, "band"])
    return d.withColumn("phase", F.coalesce(last_reached(F.col("right_edge"), headers), F.lit("")))


def layout_programmes(nodes: DataFrame, bands: DataFrame, headers: DataFrame) -> DataFrame:
    """Programmes of rendered row bands: phase from explicit text, else the nearest header
    within 180; the first identity text is the asset and the nearest text at least 28 to the
    right of it the indication."""
    b = bands.select("doc_id", "band", "top", "bottom")
    d = in_ranges(nodes, b, ["doc_id"], F.col("cy"), "top", "bottom", 64.0)
    d = d.withColumn("own_phase", F.nullif(P.explicit("text"), F.lit(""))).withColumn("ident", I.is_identity_candidate("text"))
    first = d.filter("ident").groupBy("doc_id", "band").agg(F.min(F.struct("x", "y", "text")).alias("a"))
    text = d.groupBy("doc_id", "band").agg(F.max("own_phase").alias("text_phase"), F.max("x").alias("right"))
    heads = headers.groupBy("doc_id").agg(F.collect_list(F.struct(F.col("cx").alias("x"), F.col("phase").alias("label"))).alias("h"))
    mark = d.filter("mark").groupBy("doc_id", "band").agg(F.max("cx").alias("mark_x"))
    near = F.filter("h", lambda h: F.abs(h["x"] - F.col("mark_x")) <= 180)
    right = d.join(first, ["doc_id", "band"]).filter((F.col("x") - F.col("a.x") >= 28) & F.col("own_phase").isNull() & ~F.col("mark"))
    ind = right.groupBy("doc_id", "band").agg(F.min(F.struct((F.col("x") - F.col("a.x")).alias("d"), (-F.length("text")).alias("l"), "text")).alias("i"))
    out = first.join(text, ["doc_id", "band"]).join(ind, ["doc_id", "band"]).join(mark, ["doc_id", "band"], "left").join(heads, "doc_id", "left")
    out = out.withColumn("phase", F.coalesce("text_phase", nearest_label(F.col("mark_x"), near)))
    return out.filter("phase is not null").select("doc_id", "band", F.col("a.text").alias("asset"), F.col("i.text").alias("indication"), "phase")
