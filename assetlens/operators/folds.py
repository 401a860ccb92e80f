"""Order-dependent folds over a page, in the JVM: a sorted array and a state that walks along it.

A page is one stored value, so its rows may meet in one array. A stream that is not a page is first cut
where no state can cross (``rows_per_chunk``), with the chunked scans of ``ordered``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean, let, norm
from .ordered import Ordered


def page_arrays(df: DataFrame, by: list[str], order: list[Column], **fields: Column) -> DataFrame:
    """One row per page: ``m`` holds its rows sorted by ``order``, each with the named fields."""
    keys = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    row = F.struct(*keys, *[c.alias(n) for n, c in fields.items()])
    return df.groupBy(*by).agg(F.sort_array(F.collect_list(row)).alias("m"))


def running_mean_starts(rows: Column, tolerance: float) -> Column:
    """Positions (from 1) at which a group starts; a value joins while it is near the running mean of the last group.

    The state is the sum and the count of that group, so a fold can go on from where another one ended.
    """
    state = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n"), F.lit(1).alias("i"), F.array().cast("array<int>").alias("starts"))

    def step(s, x):
        near = (s["n"] > 0) & (F.abs(x["_y"] - s["sum"] / s["n"]) <= tolerance)
        return F.struct(F.when(near, s["sum"] + x["_y"]).otherwise(x["_y"]).alias("sum"), F.when(near, s["n"] + 1).otherwise(1).alias("n"),
                        (s["i"] + 1).alias("i"), F.when(near, s["starts"]).otherwise(F.concat(s["starts"], F.array(s["i"]))).alias("starts"))
    return F.aggregate(rows, state, step)["starts"]


def running_mean_lines(rows: Column, tolerance: float) -> Column:
    """Sorted rows with ``_y`` cut into their groups by running mean: an array of arrays, so that no row leaves its page."""
    return let(rows, lambda m: let(running_mean_starts(m, tolerance), lambda s: F.transform(
        s, lambda p, i: F.slice(m, p, F.coalesce(F.get(s, i + 1), F.size(m) + 1) - p))))


def in_line_order(rows: Column, tolerance: float, row) -> Column:
    """Sorted rows with ``_y`` line by line; within a line in the order of the struct ``row`` makes of each, which is returned."""
    return F.flatten(F.transform(running_mean_lines(rows, tolerance), lambda line: F.sort_array(F.transform(line, row))))


def running_mean_groups(df: DataFrame, by: list[str], position: Column | str, tolerance: float, name: str = "line",
                        order: list[str] | None = None, rows_per_chunk: int | None = None) -> DataFrame:
    """Adds ``name``, numbered from 1 in each key: rows in the order of ``order`` (the position itself if none)
    join the last group while they are within ``tolerance`` of its running mean.

    With ``rows_per_chunk`` one key may hold any share of the rows: where a position passes the largest one
    before it by more than the tolerance, a group must end, so the runs between such cuts are folded alone."""
    y = F.col(position) if isinstance(position, str) else position
    d, columns = df.withColumn("_y", y.cast("double")), df.columns
    order, keys = order or ["_y"], by
    if rows_per_chunk:
        o = Ordered(d, by, order, rows_per_chunk).running_max_before(F.col("_y"), "_top")
        d = o.islands(F.coalesce(F.col("_y") - F.col("_top") > tolerance, F.lit(True)), "_run").frame().drop("_top")
        keys = [*by, "_run"]
    # Keys and order columns are there already: the row brings the others.
    known = {**{c: F.col(c) for c in by}, **{c: F.col(f"e._o{i}") for i, c in enumerate(order) if c not in by}}
    others = [c for c in columns if c not in known]
    pages = page_arrays(d, keys, [F.col(c) for c in order], _y=F.col("_y"), _row=F.struct(*(others or [F.lit(0).alias("_none")])))
    pages = pages.withColumn("starts", running_mean_starts(F.col("m"), tolerance))
    # Slices of the page, one a group, then their rows.
    nth = F.sequence(F.lit(1), F.size("starts"))
    size = lambda g: F.coalesce(F.get(F.col("starts"), g), F.size("m") + 1) - F.get(F.col("starts"), g - 1)
    parts = F.transform(nth, lambda g: F.struct(g.alias("g"), F.slice("m", F.get(F.col("starts"), g - 1), size(g)).alias("m")))
    groups = pages.select(*keys, F.explode(parts).alias("p")).select(*keys, "p.g", "p.m")
    if rows_per_chunk:
        groups = Ordered(groups, by, ["_run", "g"], rows_per_chunk).ordinal("g2").frame().drop("g").withColumnRenamed("g2", "g")
    rows = groups.select(*by, F.col("g").cast("int").alias(name), F.explode("m").alias("e"))
    return rows.select(*[known[c].alias(c) if c in known else F.col(f"e._row.{c}") for c in columns], name)


def running_clusters(df: DataFrame, by: list[str], x: str, tolerance: float = 24.0, least: int = 3) -> DataFrame:
    """Clusters of one coordinate by running centre that hold at least ``least`` members: (by, center, n)."""
    d = running_mean_groups(df.select(*by, x), by, x, tolerance, "cluster")
    return d.groupBy(*by, "cluster").agg(F.round(F.avg(x), 6).alias("center"), F.count("*").alias("n")).filter(F.col("n") >= least)


# ---- bands ---------------------------------------------------------------------


def distinct_bands(bands: DataFrame, by: list[str], share: float = 0.72) -> DataFrame:
    """Bands from top to bottom, wider first: one that overlaps a kept band by ``share`` of the smaller (1.0 at
    least) takes the place of the first such band if it is wider, and is dropped otherwise."""
    kind = bands.select(F.struct(*bands.columns).alias("b")).schema["b"].dataType.simpleString()
    rows = bands.withColumn("_w", F.col("x1") - F.col("x0"))
    pages = page_arrays(rows, by, [F.col("y0"), -F.col("_w"), F.struct(*bands.columns)], b=F.struct(*bands.columns))
    wide = lambda b: b["x1"] - b["x0"]

    def overlaps(a, b):
        over = F.greatest(F.lit(0.0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))
        return over / F.greatest(F.lit(1.0), F.least(a["y1"] - a["y0"], b["y1"] - b["y0"])) >= share

    def step(s, x):
        # Bands that end above this one meet none that follows: only the others are looked at.
        ended = F.filter(s["active"], lambda k: k["y1"] <= x["b"]["y0"])
        active = F.filter(s["active"], lambda k: k["y1"] > x["b"]["y0"])
        at = F.array_position(F.transform(active, lambda k: overlaps(x["b"], k)), F.lit(True))
        placed = F.transform(active, lambda k, i: F.when((i + 1 == at) & (wide(x["b"]) > wide(k)), x["b"]).otherwise(k))
        return F.struct(F.when(F.size(ended) > 0, F.concat(s["done"], ended)).otherwise(s["done"]).alias("done"),
                        F.when(at > 0, placed).otherwise(F.concat(active, F.array(x["b"]))).alias("active"))
    none = F.array().cast(f"array<{kind}>")
    kept = F.aggregate("m", F.struct(none.alias("done"), none.alias("active")), step, lambda s: F.concat(s["done"], s["active"]))
    return pages.select(F.explode(kept).alias("b")).select("b.*")


def band_candidates(nodes: DataFrame, pattern: str) -> DataFrame:
    """Nodes that can be a row band: 240 wide at least, 24 to 320 high, marked or named as a row."""
    blob = F.concat_ws(" ", *[clean(F.col(c)) for c in ("class_name", "parent_class", "node_key", "role")])
    fits = (F.col("width") >= 240) & F.col("height").between(24, 320)
    return nodes.filter(fits & (F.coalesce("in_row", F.lit(False)) | blob.rlike(pattern)))


# ---- visual rows -----------------------------------------------------------------

ROW = "struct<y0:double,y1:double,asset:string,indication:string,code:string>"
SCAN = f"struct<rows:array<{ROW}>,open:{ROW},mode:string,unresolved:int>"


def scanned_rows(fragments: Column) -> Column:
    """struct(rows, open, mode, unresolved) after all fragments (y, asset, indication, code), in order.

    Modes: 'plus' and 'tail', a complete row that may still take the next line, by a trailing plus sign
    (14.5 points) or an indication alone (9); 'run', incomplete lines that follow each other within 8.5;
    '' when nothing is open. A run counts only when it holds an asset and an indication.
    """
    text = lambda a, b: F.concat_ws(" ", F.nullif(a, F.lit("")), F.nullif(b, F.lit("")))
    first = lambda a, b: F.when(a != "", a).otherwise(b)
    start = F.struct(F.array(), F.struct(F.lit(0.0), F.lit(0.0), F.lit(""), F.lit(""), F.lit("")), F.lit(""), F.lit(0)).cast(SCAN)

    def step(s, x):
        o, gap = s["open"], x["y"] - s["open"]["y1"]
        whole = (x["asset"] != "") & (x["indication"] != "")
        plus = (s["mode"] == "plus") & (gap <= 14.5) & ((x["asset"] != "") | (x["indication"] != ""))
        tail = s["mode"].isin("plus", "tail") & (gap <= 9.0) & (x["asset"] == "") & (x["indication"] != "") & (x["code"] == "")
        run = (s["mode"] == "run") & ~whole & (gap <= 8.5)
        joins = plus | tail | run
        fresh = F.struct(x["y"], x["y"], x["asset"], x["indication"], x["code"]).cast(ROW)
        joined = F.struct(o["y0"], x["y"], F.when(tail & ~plus, o["asset"]).otherwise(text(o["asset"], x["asset"])),
                          text(o["indication"], x["indication"]), F.when(tail & ~plus, o["code"]).otherwise(first(o["code"], x["code"]))).cast(ROW)
        code_only = (x["asset"] == "") & (x["indication"] == "")
        mode = (F.when(plus, "tail").when(tail, "shut").when(run, "run")
                .when(whole, F.when(F.rtrim(x["asset"]).endswith("+"), "plus").otherwise("tail")).when(code_only, "").otherwise("run"))
        return F.struct(F.when(joins, s["rows"]).otherwise(closed(s)), F.when(joins, joined).otherwise(fresh), mode,
                        F.when(joins, s["unresolved"]).otherwise(unresolved(s))).cast(SCAN)
    return F.aggregate(fragments, start, step)


def _held(s: Column) -> Column:
    return (s["open"]["asset"] != "") & (s["open"]["indication"] != "")


def closed(s: Column) -> Column:
    """The rows with the open one, if it is whole."""
    return F.when((s["mode"] != "") & _held(s), F.concat(s["rows"], F.array(s["open"]))).otherwise(s["rows"])


def unresolved(s: Column) -> Column:
    return s["unresolved"] + F.when((s["mode"] != "") & ~_held(s), 1).otherwise(0)


def asset_root(asset: Column) -> Column:
    return F.split(norm(asset), " ")[0]


def visual_rows(fragments: DataFrame, by: list[str], far: float = 60.0, reach: float = 8.5) -> DataFrame:
    """Programme rows of each phase column: (by, ordinal, y0, y1, asset, indication, code, unresolved).

    fragments(y, asset, indication, code) are its lines. Lines beyond a gap of more than ``far`` behind three
    others belong to the footer. Rows without a code take the only code printed within ``reach`` of the run of
    rows with the same first asset word; two codes there leave them blank.
    """
    d = fragments.withColumns({c: F.coalesce(clean(F.col(c)), F.lit("")) for c in ("asset", "indication", "code")})
    d = d.withColumn("y", F.col("y").cast("double")).filter("asset <> '' or indication <> '' or code <> ''")
    pages = page_arrays(d, by, [F.col("y"), F.col("asset"), F.col("indication"), F.col("code")],
                        y=F.col("y"), asset=F.col("asset"), indication=F.col("indication"), code=F.col("code"))
    gap = lambda i: F.get(F.col("m"), i)["y"] - F.get(F.col("m"), i - 1)["y"] > far
    cuts = F.filter(F.sequence(F.lit(0), F.size("m") - 1), lambda i: (i >= 3) & gap(i))
    codes = F.transform(F.filter("m", lambda x: x["code"] != ""), lambda x: F.struct(x["y"].alias("y"), x["code"].alias("code")))
    pages = pages.select(*by, codes.alias("codes"), F.slice("m", F.lit(1), F.coalesce(F.get(cuts, F.lit(0)), F.size("m"))).alias("m"))
    pages = pages.withColumn("s", scanned_rows(F.col("m")))
    rows = pages.select(*by, "codes", closed(F.col("s")).alias("rows"), unresolved(F.col("s")).alias("unresolved"))
    rows = rows.select(*by, "codes", "unresolved", F.posexplode("rows").alias("i", "r")).select(*by, "codes", "unresolved", "i", "r.*")
    w = Window.partitionBy(*by).orderBy("i")
    rows = rows.withColumn("root", asset_root(F.col("asset"))).withColumn("new", (F.col("root") == "") | (F.lag("root").over(w).isNull()) | (F.lag("root").over(w) != F.col("root")))
    rows = rows.withColumn("g", F.sum(F.col("new").cast("int")).over(w))
    run = Window.partitionBy(*by, "g")
    rows = rows.withColumns({"low": F.min("y0").over(run) - reach, "high": F.max("y1").over(run) + reach})
    near = F.filter("codes", lambda c: (c["y"] >= F.col("low")) & (c["y"] <= F.col("high")))
    names = F.array_distinct(F.filter(F.transform(near, lambda c: norm(c["code"])), lambda c: c != ""))
    only = F.when((F.size(names) == 1) & (F.col("root") != ""), F.filter(near, lambda c: norm(c["code"]) != "")[0]["code"])
    code = F.when(F.col("code") != "", F.col("code")).otherwise(F.coalesce(only, F.lit("")))
    return rows.select(*by, (F.col("i") + 1).alias("ordinal"), "y0", "y1", "asset", "indication", code.alias("code"), "unresolved")


# ---- continuation groups ----------------------------------------------------------


def continuation_repairs(rows: DataFrame, anchors: DataFrame, by: list[str], distance: float = 24.0, limit: float = 35.0,
                         margin: float = 12.0) -> DataFrame:
    """(by, row_id, code, repaired): rows(y, row_id, indication, phase, code) that follow each other within
    ``distance`` with equal indication and phase move together to the anchor nearest to their span, if it is
    within ``limit`` and ``margin`` nearer than the runner-up, and not already their only code.

    The two anchors before the span and the two from its start on decide; both come from one sorted pass."""
    w = Window.partitionBy(*by).orderBy("y", "row_id")
    d = rows.withColumns({"_i": norm(F.col("indication")), "_p": norm(F.col("phase")), "y": F.col("y").cast("double")})
    prev = lambda c: F.lag(c).over(w)
    same = (prev("_i") == F.col("_i")) & (prev("_p") == F.col("_p")) & (F.col("y") - prev("y") <= distance)
    d = d.withColumn("_new", F.when(same, 0).otherwise(1)).withColumn("_g", F.sum("_new").over(w))
    groups = d.groupBy(*by, "_g").agg(F.min("y").alias("low"), F.max("y").alias("high"), F.count("*").alias("n"),
                                      F.collect_set(F.nullif(norm(F.col("code")), F.lit(""))).alias("codes")).filter("n >= 2")
    here = F.struct(F.col("y").cast("double").alias("y"), F.col("code").cast("string").alias("code"))
    a = anchors.select(*by, F.col("y").cast("double").alias("y"), "code").withColumn("here", here)
    aw = Window.partitionBy(*by).orderBy("y", "code")
    a = a.withColumns({"back": F.array_compact(F.array("here", F.lag("here").over(aw))), "next": F.array_compact(F.array("here", F.lead("here").over(aw)))})
    both = groups.withColumn("y", F.col("low")).withColumn("t", F.lit(0)).unionByName(a.drop("here").withColumn("t", F.lit(1)), allowMissingColumns=True)
    up = Window.partitionBy(*by).orderBy("y", "t", "code").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*by).orderBy("y", "t", "code").rowsBetween(1, Window.unboundedFollowing)
    both = both.withColumns({"b": F.last("back", True).over(up), "f": F.first("next", True).over(down)}).filter("t = 0")
    none = F.array().cast("array<struct<y:double,code:string>>")
    far = lambda c: F.when(c["y"] > F.col("high"), c["y"] - F.col("high")).when(c["y"] < F.col("low"), F.col("low") - c["y"]).otherwise(0.0)
    near = F.array_sort(F.transform(F.concat(F.coalesce("b", none), F.coalesce("f", none)), lambda c: F.struct(far(c).alias("d"), c["y"].alias("y"), c["code"].alias("code"))))
    both = both.withColumn("near", near).withColumn("one", F.get("near", F.lit(0))).withColumn("two", F.coalesce(F.get("near", F.lit(1))["d"], F.lit(999.0)))
    clear = (F.col("one.d") <= limit) & (F.col("one.d") + margin <= F.col("two"))
    known = (F.size("codes") <= 1) & F.array_contains("codes", norm(F.col("one.code")))
    moved = both.filter(clear & ~known).select(*by, "_g", F.col("one.code").alias("chosen"))
    out = d.join(moved, [*by, "_g"], "left")
    return out.select(*by, "row_id", F.coalesce("chosen", "code").alias("code"), F.col("chosen").isNotNull().alias("repaired"))
