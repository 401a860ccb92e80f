"""Queries for pages, tables, workbooks and labelled text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import html as H
from ..operators import workbook as X
from . import bindings as B
from .registry import pick, query, scalar_cases, table
from .scalars import STRIP_SQL

strip = lambda x: STRIP_SQL.replace("html", x)


@query("H01_title_meta", f"""SELECT page_id, nullif(substr({strip("regexp_extract(html, '(?i)<title[^>]*>([\\s\\S]*?)</title>', 1)")}, 1, 300), '') AS title, 'about ' || page_id AS meta FROM pages""")
def h01(spark, d):
    meta = F.concat("html", F.lit("<meta content='about "), F.col("page_id").cast("string"), F.lit("' name='description' />"))
    return table(spark, d, "pages").select("page_id", H.title("html").alias("title"), H.meta_description(meta).alias("meta"))


@query("H02_headings", f"""SELECT page_id, 1 AS level, {strip('h')} AS text FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<h1[^>]*>[\\s\\S]*?</h1>')) AS h FROM pages)
WHERE {strip('h')} <> ''""")
def h02(spark, d):
    x = table(spark, d, "pages").select("page_id", F.explode(H.headings("html")).alias("h"))
    return x.select("page_id", "h.level", "h.text")


@query("H03_anchors", f"""WITH a AS (SELECT page_id, url, unnest(l) AS raw, generate_subscripts(l, 1) AS pos FROM (SELECT page_id, url, regexp_extract_all(html, '(?i)<a [^>]*href="[^"]+"[^>]*>[\\s\\S]*?</a>') AS l FROM pages)),
b AS (SELECT page_id, pos, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || regexp_extract(raw, 'href="([^"]+)"', 1) AS link, {strip('raw')} AS text FROM a),
c AS (SELECT page_id, link, arg_min(text, pos) AS text, min(pos) AS pos FROM b WHERE text <> '' GROUP BY page_id, lower(text), link)
SELECT page_id, link, text, row_number() OVER (PARTITION BY page_id ORDER BY pos)::INT AS position FROM c QUALIFY position <= 400""")
def h03(spark, d):
    return H.anchors(table(spark, d, "pages"), "page_id", "url", "html")


_L = ("regexp_replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<!--[\\s\\S]*?-->', ' ', 'g'), "
      "'(?i)<script\\b[^>]*>[\\s\\S]*?</script>', ' ', 'g'), '(?i)<style\\b[^>]*>[\\s\\S]*?</style>', ' ', 'g'), '\\s+', ' ', 'g'), "
      f"'(?i)</?({H.BLOCK})\\b[^>]*>', chr(10), 'g'), '<[^>]+>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', chr(39)), '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g')")


@query("H04_visible_lines", f"""WITH l AS (SELECT page_id, list_filter(list_transform(string_split({_L}, chr(10)), lambda v: trim(regexp_replace(v, '\\s+', ' ', 'g'))), lambda v: v <> '') AS ls FROM pages)
SELECT page_id, (generate_subscripts(ls, 1) - 1)::INT AS line_no, unnest(ls) AS text FROM l""")
def h04(spark, d):
    return H.visible_lines(table(spark, d, "pages"), "page_id", "html")


@query("S01_page_scan", f"SELECT page_id, url, octet_length(encode(html))::BIGINT AS bytes, length({STRIP_SQL})::BIGINT AS visible FROM pages")
def s01(spark, d):
    return table(spark, d, "pages").select("page_id", "url", F.octet_length("html").cast("long").alias("bytes"), F.length(T.strip_html("html")).cast("long").alias("visible"))


@query("H11_card_segments", """WITH s AS (SELECT page_id, string_split_regex(html, '<p>') AS l FROM pages)
SELECT page_id, card, md5(raw) AS digest FROM (SELECT page_id, generate_subscripts(l, 1)::INT - 1 AS card, unnest(l) AS raw FROM s) WHERE card > 0""")
def h11(spark, d):
    return H.cards_by_anchor(table(spark, d, "pages"), "page_id", "html", "<p>").select("page_id", "card", F.md5(F.col("raw").cast("binary")).alias("digest"))


@query("H12_active_state", """SELECT p_partkey, CASE WHEN p_size % 5 < 4 THEN ['1', '2', '3', 'R'][1 + p_size % 5] END AS active,
  CASE WHEN p_size % 5 < 4 THEN ['Phase 1', 'Phase 2', 'Phase 3', 'Filed / Registration'][1 + p_size % 5] ELSE '' END AS phase FROM part""")
def h12(spark, d):
    labels = F.array(*[F.lit(x) for x in "123R"])
    s = table(spark, d, "part").select("p_partkey", (F.col("p_size") % 5).alias("k"), F.posexplode(labels).alias("pos", "label"))
    return H.active_state(s.withColumn("class_name", F.when(F.col("pos") == F.col("k"), "on").otherwise("off")), ["p_partkey"])


@query("H18_indication_section", """SELECT doc_id, trim(regexp_replace('1 INDICATIONS AND USAGE ' || 'is indicated for ' || text, '\\s+', ' ', 'g')) AS section FROM documents
WHERE length(text) < 15000""")
def h18(spark, d):
    docs = table(spark, d, "documents").filter(F.length("text") < 15000)
    label = F.concat(F.lit("INDICATIONS\nsee below\nDOSAGE AND ADMINISTRATION\n1 INDICATIONS AND USAGE\nis indicated for "), "text", F.lit("\n2  DOSAGE AND ADMINISTRATION\nx"))
    return docs.select("doc_id", H.indication_section(label).alias("section"))


# Every document, whatever its length. An even doc_id has an end heading, which sets the end; without one the section is
# cut at 16,000 characters of the label, counted once runs of blanks and blank lines are shortened.
@query("H18_indication_section_whole", """WITH l AS (SELECT doc_id, '1 INDICATIONS AND USAGE' || chr(10) || 'is indicated for ' || coalesce(text, '') AS raw FROM documents),
s AS (SELECT doc_id, regexp_replace(regexp_replace(replace(raw, chr(13), chr(10)), '[ \\t]+', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g') AS tail FROM l)
SELECT doc_id, trim(regexp_replace(CASE WHEN doc_id % 2 = 0 THEN tail ELSE substr(tail, 1, 16000) END, '\\s+', ' ', 'g')) AS section FROM s""")
def h18_whole(spark, d):
    end = F.when(F.col("doc_id") % 2 == 0, "\n2  DOSAGE AND ADMINISTRATION\nx").otherwise("")
    label = F.concat(F.lit("INDICATIONS\nsee below\nDOSAGE AND ADMINISTRATION\n1 INDICATIONS AND USAGE\nis indicated for "), F.coalesce("text", F.lit("")), end)
    return table(spark, d, "documents").select("doc_id", H.indication_section(label).alias("section"))


@query("H19_strategy_choice", """SELECT user_id, arg_max(event_type, (n, -o)) AS method, max(n) AS n FROM (SELECT user_id, event_type, count(*) AS n,
  CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4 ELSE 5 END AS o FROM events GROUP BY 1, 2) GROUP BY 1""")
def h19(spark, d):
    c = table(spark, d, "events").groupBy("user_id", F.col("event_type").alias("method")).agg(F.count("*").alias("n"))
    return H.strategy_choice(c, "user_id", {"click": 1, "view": 2, "signup": 3, "purchase": 4, "error": 5})


@query("H20_sparse_page", f"""SELECT page_id, length(trim(regexp_replace(html, '<[^>]+>', ' ', 'g'))) < 800 OR
  len(list_filter(list_transform(string_split({_L}, chr(10)), lambda v: trim(v)), lambda v: v <> '')) < 20 AS sparse FROM pages""")
def h20(spark, d):
    return table(spark, d, "pages").select("page_id", H.sparse_page("html").alias("sparse"))


@query("C14_retrieval_route", f"""SELECT page_id, CASE WHEN page_id % 5 = 1 THEN 'browser' WHEN page_id % 5 = 2 THEN 'fail closed' WHEN length({STRIP_SQL}) < 800 THEN 'browser' ELSE 'direct' END AS route FROM pages""")
def c14(spark, d):
    status = F.when(F.col("page_id") % 5 == 1, 429).when(F.col("page_id") % 5 == 2, 500).otherwise(200)
    return table(spark, d, "pages").select("page_id", H.retrieval_route(status, F.length(T.strip_html("html"))).alias("route"))


# ---- tables and workbooks built from part ----------------------------------------------


def _cells(spark, d, header, values, area_every=0):
    """One sheet per part type: a header row, then one row per part in key order."""
    p = table(spark, d, "part")
    body = p.select(F.col("p_type").alias("doc_id"), (F.col("p_partkey") + 1).cast("int").alias("row_no"),
                    F.posexplode(F.array(*values)).alias("col_no", "text"))
    head = p.select(F.col("p_type").alias("doc_id")).distinct().select(
        "doc_id", F.lit(0).alias("row_no"), F.posexplode(F.array(*[F.lit(h) for h in header])).alias("col_no", "text"))
    return head.unionByName(body)


@query("X02_sheet_programmes", """SELECT p_type AS doc_id, (p_partkey + 1)::INT AS row_no, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_name END AS asset, 'Phase ' || (1 + p_size % 3) AS phase,
  CASE WHEN p_partkey % 10 = 0 THEN '' ELSE p_type || ' disease' END AS indication, p_partkey % 2 = 0 AS partnered, p_partkey % 10 = 0 AS rejected FROM part""")
def x02(spark, d):
    k = F.col("p_partkey")
    cells = _cells(spark, d, ["INN / Generic name", "Brand Name", "Potential Indication", "Current phase", "Partner", "Notes"],
                   [F.when(k % 3 == 0, "").otherwise(F.col("p_name")), F.col("p_brand"), F.when(k % 10 == 0, "").otherwise(F.concat("p_type", F.lit(" disease"))),
                    F.concat(F.lit("Phase "), 1 + F.col("p_size") % 3), F.when(k % 2 == 0, "Yes").otherwise("no"), F.lit("")])
    return X.sheet_programmes(cells, ["doc_id"]).select("doc_id", "row_no", "asset", "phase", "indication", "partnered", "rejected")


@query("X01_sheet_header", "SELECT p_type AS doc_id, count(*) AS n FROM part GROUP BY 1")
def x01(spark, d):
    cells = _cells(spark, d, ["Code", "INN", "Disease", "Stage"], [F.col("p_partkey").cast("string"), F.col("p_name"), F.col("p_type"), F.lit("Filed")])
    shifted = cells.withColumn("row_no", F.when(F.col("row_no") == 0, 7).otherwise(F.col("row_no") + 7))
    return X.sheet_programmes(shifted, ["doc_id"]).filter("not rejected").groupBy("doc_id").agg(F.count("*").alias("n"))


@query("H07_table_programmes", """SELECT p_type AS doc_id, (p_partkey + 1)::INT AS row_no, p_name AS asset, p_brand AS indication,
  CASE WHEN p_partkey % 4 = 3 THEN 'Phase 2' ELSE 'Phase ' || (1 + p_size % 3) END AS phase,
  CASE WHEN p_partkey % 4 = 3 THEN 'REGISTRY_FALLBACK' ELSE 'SOURCE_TEXT' END AS phase_evidence,
  coalesce(last_value(CASE WHEN p_partkey % 6 = 0 THEN 'Area ' || p_size END IGNORE NULLS) OVER (PARTITION BY p_type ORDER BY p_partkey ROWS UNBOUNDED PRECEDING), '') AS area
FROM part QUALIFY p_partkey % 6 <> 0""")
def h07(spark, d):
    k = F.col("p_partkey")
    section, fallback = k % 6 == 0, k % 4 == 3
    cells = _cells(spark, d, ["Program", "Indications", "Clinical phase", "Trial"],
                   [F.when(section, F.concat(F.lit("Area "), "p_size")).otherwise(F.col("p_name")), F.when(section, "").otherwise(F.col("p_brand")),
                    F.when(section | fallback, "").otherwise(F.concat(F.lit("Phase "), 1 + F.col("p_size") % 3)),
                    F.when(section, "").when(fallback, F.concat(F.lit("NCT"), F.lpad(k.cast("string"), 8, "0"))).otherwise("x")])
    registry = table(spark, d, "part").select(F.concat(F.lit("NCT"), F.lpad(k.cast("string"), 8, "0")).alias("nct"), F.lit("Phase 2").alias("registry_phase"))
    return H.table_programmes(cells, ["doc_id"], registry).select("doc_id", "row_no", "asset", "indication", "phase", "phase_evidence", "area")


@query("H06_header_mapping", """SELECT p_partkey, ['asset', 'molecule', 'developmentCode', 'indication', 'phase', 'partners', NULL][1 + p_partkey % 7] AS field FROM part""")
def h06(spark, d):
    head = pick("p_partkey", ["Program name", "INN", "Project  code", "Disease area", "Stage", "Partner(s)", "Notes"])
    from ..functions import rules as R
    return table(spark, d, "part").select("p_partkey", H.header_field(head, R.TABLE_HEADERS, False).alias("field"))


def _stack(spark, d, key, parts):
    """Lines of one page per part type: ``parts`` per row in key order."""
    return table(spark, d, "part").select(F.col(key).alias("doc_id"), F.posexplode(F.array(*parts)).alias("k", "text"), "p_partkey").select(
        "doc_id", (F.col("p_partkey") * len(parts) + F.col("k")).alias("line_no"), "text")


@query("H05_table_cells", """SELECT page_id, 0 AS table_no, 0 AS row_no, c AS col_no, CASE c WHEN 0 THEN 'Program' ELSE 'page ' || page_id END AS text FROM pages, (SELECT unnest([0, 1]) AS c)""")
def h05(spark, d):
    p = table(spark, d, "pages").select("page_id", F.concat("html", F.lit("<table><tr><th>Program</th><td> page <b>"), F.col("page_id").cast("string"), F.lit("</b></td></tr></table><tr><td>orphan</td></tr>")).alias("html"))
    return H.table_cells(p, "page_id", "html")


@query("H08_labelled_flow", """SELECT p_partkey AS doc_id, p_name AS asset, p_brand AS molecule, p_type || ' disease' AS indication, 'Phase ' || (1 + p_size % 3) AS phase, 'STAR-' || p_partkey AS study FROM part""")
def h08(spark, d):
    lines = _stack(spark, d, "p_partkey", [F.col("p_name"), F.col("p_brand"), F.concat(F.lit("Indication "), "p_type", F.lit(" disease")), F.lit("Clinical phase"),
                                           F.concat(F.lit("Phase "), 1 + F.col("p_size") % 3), F.concat(F.lit("Study STAR-"), "p_partkey")])
    return H.labelled_flow(lines, "doc_id").drop("i")


@query("H09_sectioned_cards", """SELECT p_type AS doc_id, p_name AS asset, p_brand || ' more' AS indication, CASE WHEN p_partkey % 3 = 0 THEN 'Phase 3' ELSE 'Filed / Registration' END AS phase,
  CASE WHEN p_partkey % 3 = 0 THEN 'SOURCE_TEXT' ELSE 'SOURCE_SECTION_HEADING' END AS phase_evidence, count(*) AS n FROM part GROUP BY ALL""")
def h09(spark, d):
    lines = _stack(spark, d, "p_type", [F.lit("Filing"), F.lit("Molecule name:"), F.col("p_name"), F.lit("Indication"), F.col("p_brand"), F.lit("more"), F.lit("Clinical phase"),
                                        F.when(F.col("p_partkey") % 3 == 0, "Phase 3 ongoing").otherwise("n/a")])
    return H.sectioned_cards(lines, "doc_id").groupBy("doc_id", "asset", "indication", "phase", "phase_evidence").agg(F.count("*").alias("n"))


@query("H10_value_after_label", """SELECT p_partkey AS doc_id, CASE WHEN p_partkey % 3 = 2 THEN '' ELSE p_name END AS value FROM part""")
def h10(spark, d):
    lines = _stack(spark, d, "p_partkey", [F.lit("Name"), F.lit("x"), F.lit("Indication"), F.when(F.col("p_partkey") % 3 == 0, "NEW").when(F.col("p_partkey") % 3 == 1, "new phase").otherwise("Description:"),
                                           F.concat("p_name", F.lit("®"))])
    return H.value_after_label(lines, ["doc_id"], "indication")


@query("H13_heading_context", """SELECT 'Oncology' AS area, 'Phase 2' AS phase, p_name || ' ' || p_partkey AS program_text, false AS removed, true AS commercial_in_scope, p_partkey AS page FROM part
UNION ALL SELECT 'Removed since last quarter', 'Removed', p_type || ' gone', true, false, p_partkey FROM part""")
def h13(spark, d):
    k = F.col("p_partkey").cast("string")
    page = F.concat(F.lit("<h2>Oncology (as of 1 May 2026)</h2><h3>Phase II</h3><ul><li><a>"), "p_name", F.lit(" "), k, F.lit("</a><span>hidden</span></li></ul><a>back to top</a><ul><li>lost item</li></ul>"
                    "<h2>Removed since last quarter</h2><ul><li>"), "p_type", F.lit(" gone</li></ul><h2>Contact</h2><li>footer link</li>"))
    out = H.heading_context_items(table(spark, d, "part").select(F.col("p_partkey").alias("page"), page.alias("html")), "page", "html")
    return out.select("page", "area", "phase", "program_text", "removed", "commercial_in_scope")


@query("H14_asset_indication_list", """SELECT p_partkey AS page, 'Phase 3' AS phase, p_name AS asset, p_type AS indication, 'ctx ' || p_brand AS context FROM part UNION ALL SELECT p_partkey, 'Approved', p_brand, NULL, '' FROM part""")
def h14(spark, d):
    page = F.concat(F.lit("<h3>Phase 3</h3><h4>"), "p_name", F.lit("</h4><p>ctx "), "p_brand", F.lit("</p><ul><li>Biosimilars</li><li>"), "p_type", F.lit("</li></ul><h4>More information</h4><h3>Approved</h3><h4>"), "p_brand", F.lit("</h4>"))
    return H.asset_indication_list(table(spark, d, "part").select(F.col("p_partkey").alias("page"), page.alias("html")), "page", "html").select("page", "phase", "asset", "indication", "context")


@query("H15_class_field_rows", "SELECT p_partkey AS page, p_name AS asset, p_type AS indication, 'Phase 2 phase_2' AS phase_text FROM part UNION ALL SELECT p_partkey, p_brand, p_type, NULL FROM part")
def h15(spark, d):
    row = lambda a, p: F.concat(F.lit('<div class="views-row medicine"><div class="views-field views-field-field-medicine-name"><div>'), a, F.lit("</div></div>"), p, F.lit("</div>"))
    page = F.concat(F.lit('<div class="overall-wrapper"><h3 class="field-title">'), "p_type", F.lit("</h3>"),
                    row(F.col("p_name"), F.lit('<div class="views-field-field-phase">Phase 2 <i>phase_2</i></div>')), row(F.col("p_brand"), F.lit("")), F.lit("</div>"))
    return H.class_field_rows(table(spark, d, "part").select(F.col("p_partkey").alias("page"), page.alias("html")), "page", "html").drop("row_id")


@query("H16_marker_segments", """SELECT p_partkey AS doc, 0 AS pos, p_name AS asset, 'Oncology' AS area, 'Lung Cancer' AS focus, p_type || ' line' AS indication, 'Phase 2' AS phase, '' AS geography, NULL::VARCHAR AS reject_reason FROM part
UNION ALL SELECT p_partkey, 1, p_brand, 'Immunology', '', 'Lupus', 'Filed / Registration', '', NULL FROM part UNION ALL SELECT p_partkey, 2, '', '', '', '', 'Phase 1', '', 'THERAPEUTIC_AREA_NOT_FOUND' FROM part""")
def h16(spark, d):
    text = F.concat(F.lit("Menu Oncology Partner-run study "), "p_name", F.lit(" Oncology Lung Cancer "), "p_type", F.lit(" line Phase 2 in Progress "), "p_brand",
                    F.lit(" Immunology Lupus Registration (US) stray Phase 1 in Progress"))
    return H.marker_segments(table(spark, d, "part").select(F.col("p_partkey").alias("doc"), text.alias("body")), "doc", "body").drop("development_code")


@query("H17_next_meaningful", "SELECT p_partkey AS doc_id, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_name END AS next_line FROM part")
def h17(spark, d):
    lines = _stack(spark, d, "p_partkey", [F.lit("Cancer"), F.lit("16px"), F.lit("spacer"), F.when(F.col("p_partkey") % 3 == 0, "Phase 3").otherwise("left"), F.col("p_name")])
    from ..functions import phase as P
    skip = F.col("text").isin("spacer", "left") | F.col("text").rlike(r"^\d+px$")
    out = H.next_meaningful(lines, "doc_id", skip, P.heading("text", "rendered") != "", 10)
    return out.filter("text = 'Cancer'").select("doc_id", "next_line")
