"""Pages to lines, elements, tables and programme rows.

Lines, elements and cells of one page come out of a single text value, so windows over one
page are bounded by the size of that value.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import identity as I
from ..functions import phase as P
from ..functions import rules as R
from ..functions.text import alnum, clean, let, norm, squeeze, strip_html, text_or_blank, unescape

BLOCK = "|".join(R.BLOCK_TAGS)


# ---- page columns -------------------------------------------------------------


def title(html) -> Column:
    return F.nullif(F.left(strip_html(F.regexp_extract(text_or_blank(html), r"(?i)<title[^>]*>([\s\S]*?)</title>", 1)),
                           F.lit(300)), F.lit(""))


def meta_description(html) -> Column:
    h = text_or_blank(html)
    tries = [F.nullif(F.regexp_extract(h, p, 1), F.lit("")) for n in ("name=[\"']description", "property=[\"']og:description")
             for p in (rf"(?i)<meta[^>]+{n}[\"'][^>]+content=[\"']([^\"']*)[\"'][^>]*>",
                       rf"(?i)<meta[^>]+content=[\"']([^\"']*)[\"'][^>]+{n}[\"'][^>]*>")]
    return F.nullif(F.left(F.trim(unescape(F.coalesce(*tries, F.lit("")))), F.lit(500)), F.lit(""))


def headings(html, limit: int = 100) -> Column:
    """Ordered (level, text) of h1-h4 without template text."""
    found = F.regexp_extract_all(text_or_blank(html), F.lit(r"(?i)<h([1-4])\b[^>]*>[\s\S]*?</h\1>"), 0)
    parts = F.transform(found, lambda h: F.struct(
        F.regexp_extract(h, r"(?i)^<h([1-4])", 1).cast("int").alias("level"),
        F.left(strip_html(h), F.lit(240)).alias("text")))
    good = F.filter(parts, lambda p: (p["text"] != "") & ~p["text"].contains("{{") & ~p["text"].contains("}}"))
    return F.slice(good, 1, limit)


def absolute_url(href: Column, base: Column) -> Column:
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    path = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+([^?#]*)", 1)
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, r"^(.*/)", 1))
    return (F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(scheme, href))
            .when(href.startswith("/"), F.concat(origin, href))
            .when(href.startswith("?"), F.concat(origin, path, href))
            .otherwise(F.concat(origin, folder, F.regexp_replace(href, r"^\./", ""))))


def anchors(pages: DataFrame, page: str, url: str, html: str, limit: int = 400) -> DataFrame:
    """Distinct (text, absolute url) per page in order; fragments and script links skipped."""
    found = F.regexp_extract_all(text_or_blank(html), F.lit(r"(?i)<a\b[^>]*href=[\"'][^\"']+[\"'][^>]*>[\s\S]*?</a>"), 0)
    d = pages.select(page, url, F.posexplode(found).alias("pos", "raw"))
    d = d.select(page, url, "pos",
                 F.trim(unescape(F.regexp_extract("raw", r"(?i)href=[\"']([^\"']+)[\"']", 1))).alias("href"),
                 F.left(strip_html("raw"), F.lit(240)).alias("text"))
    d = d.filter((F.col("href") != "") & ~F.col("href").rlike("^(#|javascript:|mailto:|tel:)") & (F.col("text") != "")
                 & ~F.col("text").contains("{{") & ~F.col("text").contains("}}"))
    d = d.withColumn("link", absolute_url(F.col("href"), F.col(url)))
    d = d.groupBy(page, F.lower("text").alias("_k"), "link").agg(F.min(F.struct("pos", "text")).alias("m"))
    w = Window.partitionBy(page).orderBy("m.pos")
    return (d.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= limit)
            .select(page, "position", F.col("m.text").alias("text"), "link"))


def line_array(html) -> Column:
    x = F.regexp_replace(text_or_blank(html), r"<!--[\s\S]*?-->", " ")
    for tag in ("script", "style", "noscript", "svg"):
        x = F.regexp_replace(x, rf"(?i)<{tag}\b[^>]*>[\s\S]*?</{tag}>", " ")
    x = F.regexp_replace(F.regexp_replace(x, R.WS, " "), rf"(?i)</?(?:{BLOCK})\b[^>]*>", "\n")
    x = unescape(F.regexp_replace(x, "<[^>]+>", " "))
    return F.filter(F.transform(F.split(x, "\n"), lambda v: squeeze(v)), lambda v: v != "")


def visible_lines(pages: DataFrame, page: str, html: str) -> DataFrame:
    return pages.select(page, F.posexplode(line_array(html)).alias("line_no", "text"))


def sparse_page(html) -> Column:
    """Too little visible text for a server-rendered page. The length keeps script text:
    the measure in use never removed it."""
    visible = F.length(F.trim(F.regexp_replace(text_or_blank(html), "<[^>]+>", " ")))
    return (visible < 800) | (F.size(line_array(html)) < 20)


def retrieval_route(status: Column, visible_length: Column) -> Column:
    return (F.when(status.isin(403, 408, 429), "browser").when(status != 200, "fail closed")
            .when(visible_length < 800, "browser").otherwise("direct"))


# ---- tables ------------------------------------------------------------------------


class _Cells(HTMLParser):
    """Semantic table cells. An orphan row after its table closed is ignored."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.cells, self.table, self.row, self.col = [], -1, -1, -1
        self.inside = self.row_open = False
        self.text, self.skip = None, 0
        self.pending = []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "noscript", "svg"):
            self.skip += 1
        elif tag == "table" and not self.skip:
            self.inside, self.row, self.table = True, -1, self.table + 1
        elif tag == "tr" and self.inside and not self.skip:
            self.row_open, self.col, self.pending = True, -1, []
        elif tag in ("td", "th") and self.row_open and not self.skip:
            self.text = []

    def handle_data(self, data):
        if self.text is not None and not self.skip and data.strip():
            self.text.append(" ".join(data.split()))

    def handle_endtag(self, tag):
        if tag in ("script", "style", "noscript", "svg"):
            self.skip = max(0, self.skip - 1)
        elif self.skip:
            return
        elif tag in ("td", "th") and self.text is not None:
            self.col += 1
            self.pending.append((self.col, " ".join(self.text)))
            self.text = None
        elif tag == "tr" and self.row_open:
            if self.inside and any(t for _, t in self.pending):
                self.row += 1
                self.cells += [(self.table, self.row, c, t) for c, t in self.pending]
            self.row_open = False
        elif tag == "table":
            self.inside = False


def table_cells(pages: DataFrame, page: str, html: str) -> DataFrame:
    """(page, table_no, row_no, col_no, text) by a streaming parser over page batches."""
    kind = dict(pages.dtypes)[page]

    def parse(batches):
        for b in batches:
            out = []
            for ident, text in zip(b[page], b[html]):
                p = _Cells()
                p.feed(text or "")
                out += [(ident, *c) for c in p.cells]
            yield pd.DataFrame(out, columns=[page, "table_no", "row_no", "col_no", "text"])

    return pages.select(page, html).mapInPandas(parse, f"{page} {kind}, table_no int, row_no int, col_no int, text string")


def header_field(c: Column, synonyms: dict[str, list[str]], exact: bool) -> Column:
    n = norm(c, "plain")
    out = F.when(n == "", F.lit(None).cast("string"))
    for field, words in synonyms.items():
        hit = n.isin(words) if exact else n.rlike("|".join(words))
        out = out.when(hit, F.lit(field))
    return out


def mapped_rows(cells: DataFrame, group: list[str], synonyms: dict[str, list[str]], exact: bool, search: int, useful) -> DataFrame:
    """Rows below the first useful header row of each table: one column per field plus the
    cells of the row. ``useful`` tests the array of fields a header row names."""
    heads = (cells.filter(F.col("row_no") < search).withColumn("field", header_field(F.col("text"), synonyms, exact))
             .filter("field is not null").groupBy(*group, "row_no", "field").agg(F.min("col_no").alias("col_no")))
    rows = heads.groupBy(*group, "row_no").agg(F.collect_set("field").alias("fields")).filter(useful(F.col("fields")))
    first = rows.groupBy(*group).agg(F.min("row_no").alias("header_row"))
    columns = heads.join(first, group).filter("row_no = header_row").select(*group, "header_row", "field", "col_no")
    body = cells.join(first, group).filter("row_no > header_row")
    named = body.join(columns.drop("header_row"), [*group, "col_no"], "left")
    value = lambda f: F.max(F.when(F.col("field") == f, F.trim("text")))
    return named.groupBy(*group, "row_no").agg(
        *[F.coalesce(value(f), F.lit("")).alias(f) for f in synonyms],
        F.count_distinct(F.when(F.trim("text") != "", F.col("col_no"))).alias("filled"),
        F.min(F.when(F.trim("text") != "", F.struct("col_no", F.trim("text").alias("t")))).getField("t").alias("first_text"),
        F.min(F.when(P.explicit("text") != "", F.struct("col_no", F.col("text").alias("t")))).getField("t").alias("phase_cell"))


def useful_table(fields: Column) -> Column:
    has = lambda f: F.array_contains(fields, f)
    return has("asset") & has("indication") & (has("phase") | (F.size(fields) >= 4))


def table_programmes(cells: DataFrame, group: list[str], registry: DataFrame | None = None) -> DataFrame:
    """Programme rows of semantic tables; a one-cell row sets the therapeutic area below it."""
    d = mapped_rows(cells, group, R.TABLE_HEADERS, False, 8, useful_table).filter("filled > 0")
    section = (F.col("filled") == 1) & (F.length("first_text") <= 80)
    area = F.when(section & (P.explicit("first_text") == ""), F.col("first_text"))
    w = Window.partitionBy(*group).orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_section", section).withColumn("_area", F.last(area, True).over(w)).filter("not _section")
    raw = F.when(F.col("phase") == "", F.coalesce("phase_cell", F.lit(""))).otherwise(F.col("phase"))
    d = d.withColumn("phase", P.explicit(raw)).withColumn("trial_ids", I.trial_ids("study"))
    evidence = F.when(F.col("phase") != "", "SOURCE_TEXT").otherwise("")
    if registry is not None:
        r = registry.select(F.col("nct").alias("_nct"), F.col("registry_phase").alias("_rp"))
        d = d.join(r, F.upper(F.get("trial_ids", F.lit(0))) == F.col("_nct"), "left")
        use = (F.col("phase") == "") & (F.coalesce("_rp", F.lit("")) != "")
        evidence = F.when(F.col("phase") != "", "SOURCE_TEXT").when(use, "REGISTRY_FALLBACK").otherwise("")
        d = d.withColumn("phase_evidence", evidence).withColumn("phase", F.when(use, F.col("_rp")).otherwise(F.col("phase"))).drop("_nct", "_rp")
    else:
        d = d.withColumn("phase_evidence", evidence)
    d = d.filter("asset <> '' and indication <> '' and phase <> ''")
    return d.select(*group, "row_no", "asset", "molecule", F.col("developmentCode").alias("development_code"), "brand", "indication",
                    "phase", "phase_evidence", "study",
                    F.when(F.col("therapeuticArea") != "", F.col("therapeuticArea")).otherwise(F.coalesce("_area", F.lit(""))).alias("area"))


# ---- labelled text -----------------------------------------------------------------


def label_tokens(lines: DataFrame, page: str) -> DataFrame:
    """Lines split around the labels Indication, Clinical phase and Study."""
    marked = F.regexp_replace("text", r"(?i)\b(Indication|Clinical\s+phase|Study)\b", "\n$1\n")
    d = lines.select(page, "line_no", F.posexplode(F.split(marked, "\n")).alias("part", "token"))
    d = d.withColumn("token", squeeze(F.col("token"))).filter("token <> ''")
    w = Window.partitionBy(page).orderBy("line_no", "part")
    return d.select(page, F.row_number().over(w).alias("i"), "token", alnum(F.col("token")).alias("n"))


FLOW_LABELS = ["indication", "clinical phase", "study"]


def labelled_flow(lines: DataFrame, page: str) -> DataFrame:
    """Rows from repeated Indication / Clinical phase / Study labels, the identity taken from
    up to two label-like tokens before."""
    t = label_tokens(lines, page).withColumn("stop", F.col("n").isin(FLOW_LABELS))
    t = t.withColumn("ident", F.when(~F.col("stop"), I.is_identity_candidate("token", None)).otherwise(False))
    w = Window.partitionBy(page).orderBy("i")
    entry = F.struct("i", "token", "n", "stop", "ident")
    t = t.withColumn("ahead", F.collect_list(entry).over(w.rowsBetween(1, 14))).withColumn(
        "behind", F.reverse(F.collect_list(entry).over(w.rowsBetween(-8, -1)))).filter("n = 'indication'")

    def value(at):  # token at relative position, blank when it is a label
        x = F.get("ahead", at)
        return F.when(x.isNotNull() & ~x["stop"], x["token"]).otherwise("")

    def find(label, start, span):  # relative position of the first such label
        hits = F.filter("ahead", lambda x, k: (x["n"] == label) & (k >= start) & (k < start + span))
        return F.get(hits, F.lit(0))["i"] - F.col("i") - 1

    t = t.withColumn("indication", value(F.lit(0)))
    t = t.withColumn("p_at", find("clinical phase", F.when(F.col("indication") != "", 1).otherwise(0), 6)).filter("p_at is not null")
    t = t.withColumn("phase_raw", value(F.col("p_at") + 1))
    t = t.withColumn("after", F.col("p_at") + F.when(F.col("phase_raw") != "", 2).otherwise(1))
    t = t.withColumn("s_at", find("study", F.col("after"), 5))
    study = F.when(F.col("s_at").isNotNull(), value(F.col("s_at") + 1)).otherwise("")
    t = t.withColumn("study", F.when((F.length(study) > 120) | (F.size(F.split(study, " ")) > 12), "").otherwise(study))
    stop_at = F.filter(F.transform("behind", lambda x, k: F.when(x["stop"], k)), lambda k: k.isNotNull())
    near = F.filter("behind", lambda x, k: x["ident"] & (k < F.coalesce(F.get(stop_at, F.lit(0)), F.lit(99))))
    t = t.withColumn("near", F.slice(near, 1, 2))
    one, two = F.get("near", F.lit(0))["token"], F.get("near", F.lit(1))["token"]
    t = t.withColumn("busy_until", F.max(F.col("i") + 1 + F.col("after")).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    t = t.filter("busy_until is null or busy_until <= i")
    return t.select(page, "i", F.when(two.isNotNull(), two).otherwise(F.coalesce(one, F.lit(""))).alias("asset"),
                    F.when(two.isNotNull(), one).otherwise("").alias("molecule"), "indication",
                    P.explicit("phase_raw").alias("phase"), "study").filter("asset <> '' and indication <> '' and phase <> ''")


CARD_LABELS = {  # fixed values
    "asset": ["molecule", "molecule name", "compound", "compound name", "asset", "asset name", "program", "program name",
              "programme", "programme name", "candidate", "candidate name"],
    "indication": ["indication", "indications", "potential indication", "potential indications", "disease", "disease indication"],
    "phase": ["clinical phase", "development phase", "phase status", "development stage"],
    "area": ["therapeutic area", "therapeutic areas", "therapeutic area s", "therapy area"],
    "study": ["study", "clinical study"],
    "partner": ["partner", "partners", "collaboration"],
    "other": ["modality", "target", "targets", "development details"],
}


def sectioned_cards(lines: DataFrame, page: str) -> DataFrame:
    """Cards under phase headings: an asset label opens a card, labelled values fill it."""
    n, kind = F.col("n"), None
    for name, words in CARD_LABELS.items():
        kind = F.when(n.isin(words), name) if kind is None else kind.when(n.isin(words), name)
    d = lines.withColumn("text", clean("text", "soft")).withColumn("n", alnum(F.regexp_replace("text", ":+$", "")))
    d = d.withColumn("kind", kind).withColumn("heading", P.section_heading("text", None))
    w = Window.partitionBy(page).orderBy("line_no")
    free = F.col("kind").isNull() & (F.col("heading") == "") & (F.length("text") <= 260)
    d = d.withColumn("free", free)
    v1 = F.when(F.lead("free").over(w), F.lead("text").over(w)).otherwise("")
    v2 = F.when((v1 != "") & (F.length(v1) <= 120) & F.lead("free", 2).over(w), F.lead("text", 2).over(w)).otherwise("")
    d = d.withColumn("value", v1).withColumn("value2", squeeze(F.concat_ws(" ", v1, v2)))
    opens = F.coalesce(F.col("kind") == "asset", F.lit(False)) | (F.col("heading") != "")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("card", F.sum(F.when(opens, 1).otherwise(0)).over(upto)).withColumn(
        "section_phase", F.last(F.nullif("heading", F.lit("")), True).over(upto))
    def last(k, v, ok=F.lit(True)):
        return F.max_by(F.when((F.col("kind") == k) & (v != "") & ok, v), F.when((F.col("kind") == k) & (v != "") & ok, F.col("line_no")))
    value = F.col("value")
    d = d.withColumn("explicit", F.when(F.col("kind") == "phase", P.explicit("value", None)))
    explicit = F.col("explicit")
    cards = d.groupBy(page, "card").agg(
        F.min("line_no").alias("line_no"), last("asset", value).alias("asset"), last("indication", F.col("value2")).alias("indication"),
        last("phase", explicit).alias("explicit_phase"), last("area", value).alias("area"),
        last("study", value, F.length("value") <= 120).alias("study"), F.max("section_phase").alias("section_phase"))
    return cards.filter(F.coalesce(I.is_identity_candidate("asset", None), F.lit(False))).select(
        page, "line_no", "asset", "indication", F.coalesce("explicit_phase", "section_phase").alias("phase"),
        F.when(F.col("explicit_phase").isNotNull(), "SOURCE_TEXT").otherwise("SOURCE_SECTION_HEADING").alias("phase_evidence"),
        F.coalesce("study", F.lit("")).alias("study"), F.coalesce("area", F.lit("")).alias("area")).filter(
        "indication is not null and phase is not null")


STOP_LABELS = ["name", "phase", "description", "indication", "therapeutic area", "downloads available"]  # fixed values


def value_after_label(lines: DataFrame, group: list[str], label: str) -> DataFrame:
    """First line after the label that is not a 'new' badge; blank at the next label."""
    n = alnum(F.regexp_replace("text", ":+$", ""))
    d = lines.withColumn("n", n).withColumn("skip", F.col("n").isin("", "new", "new phase"))
    w = Window.partitionBy(*group).orderBy("line_no")
    following = F.first(F.when(~F.col("skip"), F.struct("text", "n")), True).over(w.rowsBetween(1, Window.unboundedFollowing))
    d = d.withColumn("f", following).filter(F.col("n") == label)
    first = d.groupBy(*group).agg(F.min(F.struct("line_no", "f")).alias("m"))
    return first.select(*group, F.when(F.col("m.f.n").isin(STOP_LABELS), "").otherwise(
        F.coalesce(F.trim(F.translate(F.col("m.f.text"), "®™", "")), F.lit(""))).alias("value"))


def cards_by_anchor(pages: DataFrame, page: str, html: str, anchor: str) -> DataFrame:
    """Page text cut at every anchor pattern; the part before the first is not a card."""
    return (pages.select(page, F.posexplode(F.split(html, anchor)).alias("card", "raw")).filter("card > 0"))


def active_state(states: DataFrame, card: list[str]) -> DataFrame:
    """The one class that occurs once while another occurs three times among four states."""
    per = states.groupBy(*card, "class_name").agg(F.count("*").alias("n"), F.min("label").alias("label"))
    d = per.groupBy(*card).agg(F.sum("n").alias("states"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("unique_states"),
                               F.max("n").alias("common"), F.min(F.when(F.col("n") == 1, F.col("label"))).alias("label"))
    ok = (F.col("states") == 4) & (F.col("unique_states") == 1) & (F.col("common") == 3)
    return d.select(*card, F.when(ok, F.col("label")).alias("active"), F.when(ok, P.heading("label", "card_state")).otherwise("").alias("phase"))


# ---- element streams -----------------------------------------------------------------


def elements(pages: DataFrame, page: str, html: str, tags: str) -> DataFrame:
    """(page, pos, tag, css, raw, text) of the named elements in document order."""
    pattern = rf"(?is)<({tags})\b[^>]*>.*?</\1\s*>"
    d = pages.select(page, F.posexplode(F.regexp_extract_all(text_or_blank(html), F.lit(pattern), 0)).alias("pos", "raw"))
    return d.select(page, "pos", F.lower(F.regexp_extract("raw", r"^<([a-zA-Z0-9]+)", 1)).alias("tag"),
                    F.regexp_extract("raw", r"(?i)^<[^>]*class=[\"']([^\"']*)[\"']", 1).alias("css"), "raw", strip_html("raw").alias("text"))


def heading_context_items(pages: DataFrame, page: str, html: str) -> DataFrame:
    """List items under h2 area and h3 phase headings; anchor text wins over item text; an
    unknown h2 or a 'back to top' link leaves the section; removed items are flagged."""
    d = elements(pages, page, html, "h2|h3|li|a")
    inner = F.regexp_extract("raw", r"(?is)<a\b[^>]*>(.*?)</a>", 1)
    item = F.when((F.col("tag") == "li") & F.col("raw").rlike(r"(?i)<a\b"), strip_html(inner)).otherwise(F.col("text"))
    d = d.withColumn("item", item)
    back = F.col("tag").isin("li", "a") & F.lower("item").startswith("back to top")
    blank = F.struct(F.lit("").alias("area"), F.lit("").alias("as_of"), F.lit(False).alias("removed"))
    ctx = F.when(F.col("tag") == "h2", P.area_heading("text")).when(back, blank)
    w = Window.partitionBy(page).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("ctx", F.last(ctx, True).over(w)).withColumn("section", F.sum(F.when(ctx.isNotNull(), 1).otherwise(0)).over(w))
    phase = F.when(F.col("tag") == "h3", F.nullif(P.heading("text", "area_list"), F.lit("")))
    ws = Window.partitionBy(page, "section").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("phase", F.when(F.col("ctx.removed"), "Removed").otherwise(F.last(phase, True).over(ws)))
    d = d.filter(F.col("tag").isin("li", "a") & ~back & (F.col("ctx.area") != "") & F.col("phase").isNotNull()
                 & (F.length("item") >= 4) & ~F.lower("item").startswith("jump to"))
    d = d.groupBy(page, F.col("ctx.area").alias("area"), "phase", F.col("item").alias("program_text")).agg(
        F.min("pos").alias("pos"), F.first("ctx.as_of").alias("as_of"), F.max("ctx.removed").alias("removed"))
    return d.withColumns({
        "source_record_id": I.record_id("LIST-", [F.col("area"), F.col("phase"), F.col("program_text")], 16, True),
        "commercial_in_scope": F.col("phase").isin("Phase 2", "Phase 3", "Registration", "LCM") & ~F.col("removed"),
        "important_label_expansion": F.col("phase") == "LCM"})


def asset_indication_list(pages: DataFrame, page: str, html: str) -> DataFrame:
    """h3 phase, h4 asset, li indications, up to four context paragraphs per asset.
    Assets without an item come out with a NULL indication so they can be counted."""
    d = elements(pages, page, html, "h3|h4|li|p").filter("text <> ''")
    n = F.lower("text")
    phase = F.when(F.col("tag") == "h3", F.nullif(P.heading("text", "clinical_list"), F.lit("")))
    w = Window.partitionBy(page).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_p", phase).withColumn("phase", F.last("_p", True).over(w))
    opens = (F.col("tag") == "h4") & F.col("phase").isNotNull() & ~n.isin("more information", "no drugs found for your filtering criteria")
    starts = F.when(F.col("_p").isNotNull(), F.struct(F.lit("").alias("asset"))).when(opens, F.struct(F.col("text").alias("asset")))
    d = d.withColumn("asset", F.last(starts, True).over(w)["asset"]).withColumn("grp", F.sum(F.when(starts.isNotNull(), 1).otherwise(0)).over(w))
    d = d.filter("phase is not null and asset <> ''")
    stop = n.rlike("^(biosimilars?|small molecules?|novel biologics?)$")
    head = d.groupBy(page, "grp", "phase", "asset").agg(F.sort_array(F.collect_list(F.when(
        (F.col("tag") == "p") & (F.length("text") <= 400), F.struct("pos", "text")))).alias("c"))
    head = head.withColumn("context", F.array_join(F.transform(F.slice("c", 1, 4), lambda x: x["text"]), " | "))
    items = d.filter((F.col("tag") == "li") & ~stop).select(page, "grp", "pos", F.col("text").alias("indication"))
    return head.join(items, [page, "grp"], "left").select(page, "grp", "pos", "phase", "asset", "indication", "context")


def class_field_rows(pages: DataFrame, page: str, html: str) -> DataFrame:
    """Condition title then medicine rows, all found by their CSS class."""
    cls = "field-title|views-field-field-medicine-name|views-field-field-phase"
    pattern = (rf"(?is)<(\w+)[^>]*class=[\"'][^\"']*\b(?:{cls})\b[^\"']*[\"'][^>]*>.*?</\1>"
               r"|<div[^>]*class=[\"'][^\"']*\bviews-row\b[^\"']*[\"'][^>]*>")
    d = pages.select(page, F.posexplode(F.regexp_extract_all(text_or_blank(html), F.lit(pattern), 0)).alias("pos", "raw"))
    css = F.regexp_extract("raw", r"(?i)class=[\"']([^\"']*)", 1)
    d = d.withColumn("css", css).withColumn("text", strip_html("raw"))
    w = Window.partitionBy(page).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("condition", F.last(F.when(F.col("css").rlike(r"\bfield-title\b"), F.col("text")), True).over(w))
    d = d.withColumn("row_id", F.sum(F.when(F.col("css").rlike(r"\bviews-row\b"), 1).otherwise(0)).over(w)).filter("row_id > 0")
    pick = lambda c: F.max(F.when(F.col("css").contains(c), F.col("text")))
    out = d.groupBy(page, "row_id").agg(pick("medicine-name").alias("asset"), F.min_by("condition", "pos").alias("indication"), pick("field-phase").alias("phase_text"))
    return out.filter("asset is not null")


def marker_segments(texts: DataFrame, doc: str, text: str) -> DataFrame:
    """Text before each phase marker: area by its first keyword, asset before it, an optional
    focus prefix, then the indication. Rows that lack a part carry a reject reason."""
    marks = F.regexp_extract_all(text, F.lit(R.PHASE_MARKER), 0)
    parts = F.split(text, R.PHASE_MARKER)
    d = texts.select(doc, F.posexplode(F.transform(parts, lambda s, k: F.struct(s.alias("segment"), F.get(marks, k).alias("mark")))).alias("pos", "z"))
    d = d.select(doc, "pos", F.col("z.mark").alias("mark"), F.col("z.segment").alias("segment")).filter("mark is not null")
    lead = F.regexp_replace("segment", r"(?is)^.*(?:Partner[- ]run\s+study|Active\s+Filters)", "")
    d = d.withColumn("segment", clean(F.when(F.col("pos") == 0, lead).otherwise(F.col("segment")), "rendered"))
    d = d.withColumn("segment", F.trim(F.regexp_replace("segment", r"(?:\s+|^)1\s+2\s+3\s*$", "")))
    areas = "|".join(R.MARKER_AREAS.values())
    cut = rf"(?is)^(.*?)\b({areas})\b(.*)$"
    focus = "|".join(sorted(R.FOCUS_AREAS, key=len, reverse=True))
    d = d.withColumns({"asset": F.trim(F.regexp_extract("segment", cut, 1)), "area": F.initcap(F.regexp_extract("segment", cut, 2)),
                       "rest": F.trim(F.regexp_extract("segment", cut, 3))})
    d = d.withColumn("focus", F.regexp_extract("rest", rf"(?i)^({focus}) (?=\S)", 1))
    d = d.withColumn("indication", F.trim(F.when(F.col("focus") != "", F.substring("rest", F.length("focus") + 1, F.length("rest"))).otherwise(F.col("rest"))))
    m = P.marker("mark")
    reason = (F.when(F.col("area") == "", "THERAPEUTIC_AREA_NOT_FOUND")
              .when((F.col("asset") == "") | (F.col("indication") == ""), "ASSET_OR_INDICATION_MISSING"))
    return d.select(doc, "pos", "asset", I.development_code("asset", "bms").alias("development_code"), "area", "focus", "indication",
                    m["phase"].alias("phase"), m["geography"].alias("geography"), reason.alias("reject_reason"))


def next_meaningful(lines: DataFrame, page: str, skip: Column, stop: Column, look: int = 12) -> DataFrame:
    """Adds the next line that is not boilerplate within ``look`` lines, NULL at a stop line."""
    w = Window.partitionBy(page).orderBy("line_no").rowsBetween(1, look)
    d = lines.withColumn("_e", F.struct("line_no", "text", stop.alias("stop"), skip.alias("skip")))
    ahead = F.filter(F.collect_list("_e").over(w), lambda e: ~e["skip"] | e["stop"])
    first = F.get(ahead, F.lit(0))
    return d.withColumn("next_line", F.when(~first["stop"], first["text"])).withColumn(
        "next_no", F.when(~first["stop"], first["line_no"])).drop("_e")


START = rf"(?im)^[ ]*(?:{'|'.join(map(R.spaced, R.INDICATION_STARTS))})[ ]*$"
END = rf"(?:{'|'.join(map(R.spaced, R.INDICATION_ENDS))})\b"


def indication_section(c) -> Column:
    """The indications section of a label text: from a section heading to the next major
    heading, the candidate with the richest indication wording."""
    x = F.replace(text_or_blank(c), F.lit("\r"), F.lit("\n"))
    x = F.regexp_replace(F.regexp_replace(x, "[ \t]+", " "), "\n{3,}", "\n\n")

    def candidate(k, body, n):
        signal = F.size(F.regexp_extract_all(n, F.lit(r"\bindicat(?:ed|ion)\b"), 0))
        return F.struct(signal.alias("signal"), F.least(F.length(body), F.lit(12000)).alias("size"), (-k).alias("order"),
                        F.length(n).alias("n"), body.alias("body"))

    def section(pieces, k):
        # Texts are long: each step is bound, so that it runs once for a candidate.
        cut = lambda tail: F.regexp_extract(tail, rf"(?ims)\A(.{{20}}.*?)^[ ]*{END}", 1)
        body = lambda tail: let(cut(tail), lambda x: F.trim(F.when(x != "", x).otherwise(F.left(tail, F.lit(16000)))))
        return let(F.array_join(F.slice(pieces, k, F.size(pieces)), ""), lambda tail: let(
            body(tail), lambda own: let(alnum(own), lambda n: candidate(k, own, n))))

    def best(pieces):
        ks = F.when(F.size(pieces) > 1, F.sequence(F.lit(2), F.size(pieces))).otherwise(F.array().cast("array<int>"))
        good = F.filter(F.transform(ks, lambda k: section(pieces, k)), lambda s: (s["n"] >= 30) & (s["signal"] > 0))
        return F.coalesce(squeeze(F.array_max(good)["body"]), F.lit(""))
    return let(F.split(F.regexp_replace(x, START, "\u0001$0"), "\u0001"), best)


def strategy_choice(counts: DataFrame, doc: str, sequence: dict[str, int]) -> DataFrame:
    """The extraction method with most rows per document; earlier methods win ties."""
    order = F.coalesce(*[F.when(F.col("method") == m, F.lit(-s)) for m, s in sequence.items()])
    return counts.groupBy(doc).agg(F.max(F.struct(F.col("n"), order.alias("o"), F.col("method"))).alias("m")).select(
        doc, F.col("m.method").alias("method"), F.col("m.n").alias("n"))
