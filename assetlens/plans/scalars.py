"""Queries for the scalar operators: text, phase and identity."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import identity as I
from ..functions import phase as P
from ..functions import text as T
from ..operators import phrases
from . import bindings as B
from .registry import by_document, query, scalar_cases, table

joined = lambda fn: (lambda c: F.array_join(fn(c), "|"))


# ---- text over whole documents -----------------------------------------------


@query("N01_clean", f"SELECT doc_id, {B.clean_sql('text')} AS cleaned FROM documents")
def n01(spark, d):
    return table(spark, d, "documents").select("doc_id", T.clean("text").alias("cleaned"))


@query("N02_norm", f"SELECT doc_id, {B.norm_sql('text')} AS normed FROM documents")
def n02(spark, d):
    return table(spark, d, "documents").select("doc_id", T.norm("text").alias("normed"))


@query("N03_clean_profiles", f"""SELECT conv_id, turn, role, md5({B.clean_sql('text')}) AS soft,
       md5({B.clean_sql('text')}) AS document, md5({B.clean_sql('text')}) AS static,
       md5({B.clean_sql("translate(text, '-', '-')")}) AS marketing,
       md5({B.clean_sql("replace(text, '*', '')")}) AS rendered FROM conversations""")
def n03(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", "role", *[
        F.md5(T.clean("text", p).cast("binary")).alias(p)
        for p in ("soft", "document", "static", "marketing", "rendered")])


scalar_cases("N03_clean_glyphs", lambda c: T.clean(c, "document"), [
    ("a­b {n}", "ab {n}"), ("x\u0002y  {n}", "x-y {n}"), (" ► {n}", "{n}"),
    ("p–q−r {n}", "p-q-r {n}")])
scalar_cases("N01_clean_unicode", T.clean, [
    ("ﬁlm {n}™", "film {n}TM"), ("café ≥ 2", "café >= 2"),
    ("½ dose {n}", "1⁄2 dose {n}"), ("ＡＢ ≤ {n}", "AB <= {n}"),
    ("x—y {n}", "x-y {n}")])


@query("N04_brand_norm", """SELECT p_partkey AS row_key,
       trim(regexp_replace(lower(p_brand || ' and ' || p_name), '[^a-z0-9]+', ' ', 'g')) AS outcome FROM part""")
def n04(spark, d):
    raw = F.concat(F.col("p_brand"), F.lit("® & "), F.col("p_name"), F.lit("™"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("row_key"), T.brand_norm(raw).alias("outcome"))


@query("N05_phrase_containment", f"""WITH p AS (SELECT item_id, {B.norm_sql('text')} AS phrase FROM benchmark),
 t AS (SELECT doc_id, {B.norm_sql('text')} AS body FROM documents)
SELECT item_id, doc_id FROM p JOIN t ON phrase <> '' AND body <> ''
   AND contains(' ' || body || ' ', ' ' || phrase || ' ')""")
def n05(spark, d):
    return phrases.phrase_hits(
        table(spark, d, "documents").select("doc_id", T.norm("text").alias("body")),
        table(spark, d, "benchmark").select("item_id", T.norm("text").alias("phrase")),
        "doc_id", "body", "item_id", "phrase")


@query("N06_ordered_distinct", """WITH w AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
  FROM (SELECT doc_id, string_split_regex(text, '\\s+') AS ws FROM documents)),
k AS (SELECT doc_id, trim(regexp_replace(lower(word), '[^a-z0-9]+', ' ', 'g')) AS key, word, pos FROM w),
f AS (SELECT doc_id, key, arg_min(word, pos) AS word, min(pos) AS pos FROM k WHERE key <> '' GROUP BY ALL)
SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS words FROM f GROUP BY doc_id""")
def n06(spark, d):
    docs = by_document(table(spark, d, "documents").select("doc_id", "text"))
    words = docs.select("doc_id", F.posexplode(F.split("text", r"\s+")).alias("pos", "word"))
    firsts = (words.withColumn("key", T.norm_plain("word")).filter("key <> ''")
              .groupBy("doc_id", "key").agg(F.min(F.struct("pos", "word")).alias("f")))
    return firsts.groupBy("doc_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list("f")), lambda x: x["word"]), " ").alias("words"))


scalar_cases("N06_uniq_array", lambda c: F.array_join(T.uniq(F.split(c, ";")), "|"), [
    ("Alpha; alpha ;BETA;{n}", "Alpha|BETA|{n}"), ("; ;--;{n};{n}.", "{n}"), ("a-b;A B;a_b", "a-b")])
scalar_cases("N07_clinical_norm", T.clinical_norm, [
    ("1L HR+/HER2- Metastatic Breast Cancer {n}", "first line hr positive her2 negative metastatic breast cancer {n}"),
    ("First-line HR-positive, HER2-negative metastatic breast cancer", "first line hr positive her2 negative metastatic breast cancer"),
    ("NSCLC {n}", "non small cell lung cancer {n}"), ("SCLC", "small cell lung cancer"),
    ("mCRC (Fast Track) {n}", "metastatic colorectal cancer {n}"),
    ("mCRPC (biologic)", "metastatic castration resistant prostate cancer"),
    ("generalised myasthenia gravis {n}", "generalized myasthenia gravis {n}"),
    ("advanced solid tumours", "advanced solid tumors"), ("gMG", "generalized myasthenia gravis"),
    ("ATTRv-PN {n}", "hereditary transthyretin amyloidosis with polyneuropathy {n}"),
    ("hereditary transthyretin-mediated amyloid polyneuropathy (hATTR-PN)", "hereditary transthyretin amyloidosis with polyneuropathy"),
    ("ATTR-CM", "transthyretin amyloid cardiomyopathy"), ("2L DLBCL {n}", "second line diffuse large b cell lymphoma {n}"),
    ("RR MCL", "relapsed refractory mantle cell lymphoma"), ("3L+ RRMM", "third line relapsed refractory multiple myeloma"),
    ("paediatric PNH (orphan drug)", "pediatric paroxysmal nocturnal hemoglobinuria")])


@query("N08_extraction_fixes", """WITH s AS (SELECT p_partkey, 'x ' || ['PF-086425343', 'PF-072612711 and Dekavil2', 'MET-815i2', 'PF-08654696', 'none'][1 + p_partkey % 5]
  || '  ' || p_name AS raw FROM part)
SELECT p_partkey AS row_key, regexp_replace(replace(replace(replace(replace(replace(raw, 'PF-086425343', 'PF-08642534'),
  'PF-072612711', 'PF-07261271'), 'Dekavil2', 'Dekavil'), 'MET-815i2', 'MET-815i'), 'PF-08654696', 'PF-08654698'), '\\s+', ' ', 'g') AS fixed,
  CASE p_partkey % 5 WHEN 1 THEN 2 WHEN 4 THEN 0 ELSE 1 END::BIGINT AS n_applied FROM s""")
def n08(spark, d):
    from .registry import pick
    raw = F.concat(F.lit("x "), pick("p_partkey", ["PF-086425343", "PF-072612711 and Dekavil2", "MET-815i2",
                                                   "PF-08654696", "none"]), F.lit("  "), F.col("p_name"))
    out = table(spark, d, "part").select(F.col("p_partkey").alias("row_key"), T.apply_fixes(raw).alias("f"))
    return out.select("row_key", F.col("f.text").alias("fixed"), F.size("f.applied").cast("long").alias("n_applied"))


scalar_cases("N09_control_digits", T.control_digits, [
    ("AB\x13\x14\x1c {n}", "AB019 {n}"), ("\x01x\x02{n}\t", "x{n}\t"), ("{n}\x15\x16\x17", "{n}234")])


STRIP_SQL = """trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(replace(
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<!--[\\s\\S]*?-->', ' ', 'g'),
  '(?i)<script\\b[^>]*>[\\s\\S]*?</script>', ' ', 'g'), '(?i)<style\\b[^>]*>[\\s\\S]*?</style>', ' ', 'g'),
  '<[^>]+>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g'), '\\s+', ' ', 'g'))"""


@query("N10_strip_html", f"SELECT page_id, {STRIP_SQL} AS visible FROM pages")
def n10(spark, d):
    return table(spark, d, "pages").select("page_id", T.strip_html("html").alias("visible"))


@query("N10_entities", "SELECT doc_id, replace(replace(replace(replace(translate(text, '&;#', ''), 'a', '’'), 'e', 'é'), 'q', '≥'), 'z', '–') AS text FROM documents")
def n10_entities(spark, d):
    x = F.translate("text", "&;#", "")
    for letter, entity in (("a", "&#8217;"), ("e", "&#xE9;"), ("q", "&ge;"), ("z", "&ndash;")):
        x = F.replace(x, F.lit(letter), F.lit(entity))
    return table(spark, d, "documents").select("doc_id", T.unescape(x).alias("text"))


@query("N11_key_norm", "SELECT DISTINCT trim(regexp_replace(lower(p_type || '-' || p_brand || '/'), '[^a-z0-9]+', '_', 'g'), '_') AS key FROM part")
def n11(spark, d):
    return table(spark, d, "part").select(T.norm_key(F.concat("p_type", F.lit("-"), "p_brand", F.lit("/"))).alias("key")).distinct()


@query("N12_token_key", """SELECT p_partkey AS row_key, array_to_string(list_sort(string_split(
  trim(regexp_replace(lower(p_type || ', ' || p_name), '[^a-z0-9]+', ' ', 'g')), ' ')), ' ') AS outcome FROM part""")
def n12(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("row_key"),
                                          T.token_key(F.concat_ws(", ", "p_type", "p_name")).alias("outcome"))


scalar_cases("N13_molecule_components", joined(T.molecule_components), [
    ("CONJUGATED ESTROGENS + zinc", "conjugated estrogens|zinc"),
    ("estrogens, conjugated;ESTROGENS CONJUGATED", "conjugated estrogens"),
    ("b a\nc+d", "a b|c d"), (" ; ", "")])


@query("N14_company_root", """SELECT s_suppkey, trim(regexp_replace(lower(s_name), '[^a-z0-9]+', ' ', 'g'))
  || CASE s_suppkey % 3 WHEN 2 THEN ' bio' ELSE '' END AS root FROM supplier""")
def n14(spark, d):
    from .registry import pick
    name = F.concat("s_name", pick("s_suppkey", [" Pharmaceuticals, Inc.", " Therapeutics Ltd", " Bio PLC"]))
    return table(spark, d, "supplier").select("s_suppkey", T.company_root(name).alias("root"))


scalar_cases("N15_slug_candidates", joined(I.slug_candidates), [
    ("North Star {n}", "north-star-{n}|north"), ("Zyx Tablets", "zyx"), ("ABCD (x) for injection", "abcd")],
    placeholder="CAST(p_partkey AS VARCHAR(20))")
scalar_cases("N16_disease_term", T.disease_term, [
    ("Non small cell lung cancer {n}", "nsclc {n}"), ("T2DM – obesity/overweight", "type 2 diabetes - obesity/obesity"),
    ("Alzheimer’s disease", "alzheimer disease"), ("leukæmia café", "leuk mia cafe"),
    ("chronic kidney disease + OSA {n}", "ckd + obstructive sleep apnea {n}")])


@query("N17_canonical_text", """SELECT conv_id, turn, role, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS canonical
FROM conversations""")
def n17(spark, d):
    x = F.col("text")
    return table(spark, d, "conversations").select(
        "conv_id", "turn", "role", T.canonical_text(F.array(x, F.lit("  "), F.concat(F.lit(" "), x), x)).alias("canonical"))


scalar_cases("N18_as_of_date", lambda c: F.coalesce(*[T.as_of_date(c, p) for p in (
    "month_day", "as_of", "as_of_loose", "heading", "current_month")], F.lit("-")), [
    ("Pipeline July 29, 2026 {n}", "July 29, 2026"), ("(as of  4 Feb 2026)", "4 Feb 2026"),
    ("As of Sept 1, 2025", "Sept 1, 2025"), ("Pipeline is current as of May 2026.", "May 2026"), ("{n}", "-")])


@query("N19_date_epoch", """SELECT o_orderkey, epoch(date_trunc('day', o_orderdate))::DOUBLE * (o_orderkey % 4 <> 3)::INT AS epoch_seconds FROM orders""")
def n19(spark, d):
    day = F.col("o_orderdate")
    text = (F.when(F.col("o_orderkey") % 4 == 0, F.date_format(day, "MMM d, yyyy"))
            .when(F.col("o_orderkey") % 4 == 1, F.date_format(day, "yyyy-MM-dd"))
            .when(F.col("o_orderkey") % 4 == 2, F.date_format(day, "MM/dd/yyyy")).otherwise("soon"))
    return table(spark, d, "orders").select("o_orderkey", T.date_epoch(text).alias("epoch_seconds"))


@query("N20_label_pdf_url", """SELECT page_id, CASE WHEN page_id % 2 = 0 THEN
  'https://labeling.pfizer.com/ShowLabeling.aspx?format=PDF&id=' || page_id END AS pdf_url FROM pages""")
def n20(spark, d):
    host = F.when(F.col("page_id") % 2 == 0, "https://labeling.pfizer.com/Show?x=1&id=").otherwise("https://example.com/?id=")
    return table(spark, d, "pages").select("page_id", I.label_pdf_url(F.concat(host, F.col("page_id").cast("string"))).alias("pdf_url"))


@query("N21_plain_norm", f"SELECT page_id, md5({B.clean_sql('html')}) AS cleaned, md5({B.norm_sql('html')}) AS normed FROM pages")
def n21(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(T.clean("html", "plain").cast("binary")).alias("cleaned"),
                                           F.md5(T.norm("html", "plain").cast("binary")).alias("normed"))


# ---- phases, over line items ---------------------------------------------------

LINE = dict(key="l_orderkey", source="lineitem", placeholder="l_returnflag")


def phase_cases(name, fn, cases):
    """Count per outcome over every line item; each line takes one of the templates."""
    from .registry import pick, pick_sql

    def run(spark, d):
        raw = pick("l_orderkey", [c[0] for c in cases])
        out = table(spark, d, "lineitem").select(raw.alias("raw"))
        return (out.select(F.col("raw"), fn(F.col("raw")).cast("string").alias("outcome"))
                .groupBy("raw", "outcome").agg(F.count("*").alias("n")))

    sql = (f"SELECT {pick_sql('l_orderkey', [c[0] for c in cases])} AS raw, "
           f"{pick_sql('l_orderkey', [c[1] for c in cases])} AS outcome, count(*) AS n FROM lineitem GROUP BY ALL")
    query(name, sql)(run)


phase_cases("P01_hybrid_phase", P.hybrid, [
    ("Phase I/II", "phase 1 2"), ("Phase 1/2", "phase 1 2"), ("Phase 1/2/3", "phase 1 2 3"), ("Phase 2b/3", "phase 2 3"),
    ("Phase II/III", "phase 2 3"), ("Phase 2", "phase 2"), ("Phase 1", "phase 1"), ("Approved", "approved"),
    ("Filed / Registration", "registration"), ("phase 3 to phase 2", "phase 3"), ("Phase IIa & IIIb", "phase 2 3"),
    ("Filed", "registration"), ("Phase-2", "phase 2"), ("Phase 2 3", "phase 2"), ("", "")])
phase_cases("P02_legacy_phase", P.legacy, [
    ("Phase II/III", "phase 2 3"), ("Phase III", "phase 3"), ("phase ii", "phase 2"), ("Phase I/II", "phase 1 ii"), ("Filed", "filed")])
phase_cases("P03_explicit_phase", P.explicit, [
    ("Phase 1/2", "Phase 1"), ("phase 2 and phase 3", "Phase 3"), ("3", "Phase 3"), ("Regulatory review", "Filed / Registration"),
    ("pre-clinical", "Preclinical"), ("Phase 0", "Preclinical"), ("Phase II", ""), ("", "")])
phase_cases("P04_record_phase", P.record, [
    ("Phase 1/2", "Phase 2"), ("Marketed", "Approved"), ("under review", "Filed / Registration"), ("i", "Phase 1"),
    ("Phase III", "Phase 3"), ("phase_two", "Phase 2"), ("<b>Phase iv</b>", "Phase 4"), ("pre-clinical", "Preclinical"), ("soon", "")])
phase_cases("P04_sheet_phase", P.sheet, [
    ("Phase 1/2", "Phase 2"), ("Approved", ""), ("Filed", "Filed / Registration"), ("II/III", "Phase 3"), ("pre clinical", "Preclinical"), ("x", "")])
phase_cases("P05_printed_phase", P.printed, [
    ("P-II", "Phase 2"), ("Phase III", "Phase 3"), ("P-I then P-III", "Phase 1"), ("Phase 1/2", "Phase 1"), ("Approved", "Approved"),
    ("regulatory review", "Filed / Registration"), ("pre-clinical", "Preclinical"), ("none", "")])
phase_cases("P06_exact_phase", P.exact, [
    ("1", "Phase 1"), ("phase ii", "Phase 2"), ("Phase 3", "Phase 3"), ("4", "Phase 4"), ("approved in EU", "Approved"),
    ("Registration", "Filed / Registration"), ("phase 1/2", "")])
phase_cases("P07_stage_code", lambda c: P.stage_code(F.split(c, ";")[0], F.split(c, ";")[1]), [
    ("phase12;", "Phase 2"), ("Phase_2-3;", "Phase 3"), ("commercial;", "Approved"), ("Discovery;x", "Preclinical"),
    ("unknown;phase_3", ""), ("unknown;registrational", "Filed / Registration"), ("PHASE_1;", ""), ("phase 1;", "Phase 1")])
phase_cases("P08_stage_letter", P.stage_letter, [
    ("P", "Preclinical"), ("Ia", "Phase 1"), ("II", "Phase 2"), ("3", "Phase 3"), ("F", "Filed / Registration"), ("a", "Approved"), ("z", "")])
phase_cases("P09_stage_number", lambda c: P.stage_number(F.split(c, ";")[0], F.split(c, ";")[1]), [
    ("1;", "Phase 1"), ("4;", "Filed / Registration"), ("x;2 ongoing", "Phase 2"), ("phase 3;", "Phase 3"), ("filed;1", "Filed / Registration"), ("x;y", "")])
phase_cases("P10_display_phase", P.display, [
    ("Phase 1/2 phase_1", "Phase 2"), ("Phase 1/2/3", "Phase 2"), ("Phase 2/3", "Phase 3"), ("commercial", "Approved"), ("filed", "Filed / Registration"),
    ("Phase IV", "Phase 4"), ("n/a", "")])
phase_cases("P11_registry_label", lambda c: P.registry(F.split(c, ",")), [
    ("PHASE1,PHASE2", "Phase 2"), ("EARLY_PHASE1", "Phase 1"), ("NA", ""), ("PHASE4,PHASE3", "Phase 4")])
phase_cases("P12_registry_rank", lambda c: P.registry_phase(F.split(c, ",")), [
    ("PHASE1|PHASE2", "Phase 2"), ("NA", ""), ("EARLY_PHASE1,NA", "Phase 1"), ("phase 3 extra", "Phase 3")])
for _profile, _cases in {
    "area_list": [("Phase II", "Phase 2"), ("LCM projects", "LCM"), ("Under review", "Registration"), ("x", "")],
    "clinical_list": [("Pre-Clinical", "Preclinical"), ("Clinical", "Clinical"), ("Under Regulatory Review", "Filed / Registration")],
    "stage_bar": [("Proof of Concept", "Phase 2"), ("Registrational", "Phase 3"), ("Commercial", "Approved")],
    "card_state": [("R", "Filed / Registration"), ("2", "Phase 2"), ("9", "")],
    "rendered": [("Regulatory approval achieved", "Regulatory Approval Achieved"), ("phase 3", "Phase 3")],
}.items():
    phase_cases(f"P13_heading_{_profile}", (lambda p: lambda c: P.heading(c, p))(_profile), _cases)
phase_cases("P13_section_heading", P.section_heading, [
    ("Phase 2", "Phase 2"), ("Filing", "Filed / Registration"), ("pre-clinical", "Preclinical"), ("Phase 2 study of a very long line that is not a heading", "")])
phase_cases("P14_marker_phase", lambda c: F.concat_ws("/", P.marker(c)["phase"], P.marker(c)["geography"]), [
    ("Phase 2 in Progress", "Phase 2/"), ("Registration (US)", "Filed / Registration/US"), ("Registration", "Filed / Registration/"), ("x", "/")])


@query("P15_trial_status", """SELECT o_orderkey, [ 'Completed', 'Recruiting', 'Active, not recruiting', 'Terminated', 'Temporarily Closed'][1 + o_orderkey % 5] AS status,
  [3, 4, 4, 1, 2][1 + o_orderkey % 5]::INT AS priority FROM orders""")
def p15(spark, d):
    from .registry import pick
    raw = pick("o_orderkey", ["completed", "RECRUITING", "ACTIVE_NOT_RECRUITING", "Terminated", "TEMPORARILY_CLOSED"])
    s = P.friendly_status(raw)
    return table(spark, d, "orders").select("o_orderkey", s.alias("status"), P.status_priority(s).alias("priority"))


scalar_cases("P16_page_area", P.page_area, [
    ("Inflammation & Immunology {n}", ""), ("inflammation and immunology oncology", "Inflammation & Immunology"),
    ("Internal Medicine {n}", "Internal Medicine"), ("Oncology {n}", "Oncology"), ("our vaccines", "Vaccines"), ("oncologyx", "")])
scalar_cases("P16_area_heading", lambda c: F.concat_ws("/", P.area_heading(c)["area"], P.area_heading(c)["as_of"]), [
    ("Oncology (as of 1 May 2026)", "Oncology/1 May 2026"), ("Respiratory and Immunology", "Respiratory & Immunology/"),
    ("Removed since last quarter", "Removed since last quarter/"), ("{n}", "/")])


# ---- identities -----------------------------------------------------------------

for _profile, _cases in {
    "bms": [("BMS 986165 {n}", "BMS-986165"), ("x BMS‑986278", "BMS-986278"), ("{n}", "")],
    "pf": [("PF-07220060 {n}", "PF-07220060"), ("pf07220060", "PF07220060"), ("PF-1", "")],
    "ly": [("LY 3298176", "LY3298176"), ("ly-3298176 {n}", "LY-3298176"), ("{n}", "")],
    "amg": [("AMG-451 {n}", "AMG 451"), ("abp 938", "ABP 938")],
    "abbv": [("ABBV 400 {n}", "ABBV-400"), ("agn-151586", "AGN-151586"), ("{n}", "")],
    "bnt": [("BNT 327 / bnt327 DB-1303", "BNT327 / DB-1303"), ("{n}", "")],
    "az": [("azd0780 {n}", "AZD0780"), ("MEDI 5752", "MEDI-5752"), ("{n}", "")],
}.items():
    scalar_cases(f"I01_code_{_profile}", (lambda p: lambda c: I.development_code(c, p))(_profile), _cases)


def _flags(c):
    return F.concat_ws("", *[F.when(f(c), "1").otherwise("0") for f in (
        I.looks_like_code, I.is_code_like, I.strong_code, I.placeholder_code)])


scalar_cases("I02_code_shapes", _flags, [
    ("TAK-861", "1111"), ("RG6026", "1111"), ("BI 456906", "0111"), ("ABCxx+", "0001"), ("NME", "0000"), ("GSK", "0001"),
    ("Brand 2 {n}", "0100"), ("*X1", "0000"), ("a1b", "1100"), ("", "0000")])


@query("I02_part_code_shape", """SELECT p_partkey, regexp_matches(p_brand, '[A-Za-z]') AND regexp_matches(p_brand, '[0-9]') AS code_like,
  regexp_full_match('PT-' || lpad(CAST(p_partkey AS VARCHAR(20)), 6, '0'), '[A-Z]{1,6}[- ]?[A-Z]{0,4}[0-9]{3,}[A-Za-z0-9+._-]*') AS strong FROM part""")
def i02(spark, d):
    code = F.concat(F.lit("PT-"), F.lpad(F.col("p_partkey").cast("string"), 6, "0"))
    return table(spark, d, "part").select("p_partkey", I.is_code_like("p_brand").alias("code_like"), I.strong_code(code).alias("strong"))


scalar_cases("I03_identity_variants", joined(I.identity_variants), [
    ("ALPHAMAB (ABC-1234)", "alphamab|alphamab abc 1234"), ("betamab-abcd", "betamab|betamab abcd"),
    ("zzz {n} (x)", "zzz {n}|zzz {n} x"), ("", "")])
scalar_cases("I04_paren_codes", joined(I.paren_codes), [
    ("ALPHAMAB (ABC-1234)", "abc 1234"), ("x (AB-1, CD 2; EF3|word)", "ab 1|ef3"), ("{n}", "")])

_ident = lambda p: (lambda c: F.concat_ws("|", *[I.split_identity(c, p)[k] for k in ("asset", "brand", "molecule", "code", "mechanism")]))
for _profile, _cases in {
    "starred": [("WAINUA® (eplontersen)**", "WAINUA® (eplontersen)|WAINUA|eplontersen||"), ("ION582", "ION582|||ION582|"), ("{n}", "{n}||{n}||")],
    "embedded_code": [("Foo® (barumab) ABC-123", "Foo® (barumab) ABC-123|Foo|barumab|ABC-123|"), ("{n} (x1)", "{n} (x1)||||")],
    "trademark": [("Orserdu® (elacestrant)", "Orserdu® (elacestrant)|Orserdu|elacestrant||"), ("MEN 1703", "MEN 1703||MEN 1703|MEN 1703|")],
    "mechanism_suffix": [("enpatoran (TLR7/8 antagonist)", "enpatoran||enpatoran||TLR7/8 antagonist"), ("M3554 (anti-GD2)", "M3554|||M3554|anti-GD2"),
                         ("cladribine capsules (x )", "cladribine capsules||cladribine||x")],
    "code_in_paren": [("olanzapine LAI (TEV-749)", "olanzapine LAI||olanzapine LAI|TEV-749|"), ("TEV-408", "TEV-408|||TEV-408|"),
                      ("Biosimilar to Prolia®", "Biosimilar to Prolia|Prolia|||")],
    "device_brand": [("STACCATO alprazolam", "alprazolam|STACCATO|alprazolam||"), ("rozanolixizumab (FcRn)*", "rozanolixizumab||rozanolixizumab||FcRn")],
}.items():
    scalar_cases(f"I05_split_{_profile}", _ident(_profile), _cases)
scalar_cases("I05_split_name_and_code", lambda c: F.concat_ws("|", *[
    I.split_identity(F.split(c, ";")[0], "name_and_code", F.split(c, ";")[1])[k] for k in ("asset", "brand", "molecule", "code")]), [
    ("TEZSPIRE® (x);(tezepelumab-ekko)", "TEZSPIRE®|TEZSPIRE®|tezepelumab-ekko|"), ("{n};AMG 133", "{n}|||AMG 133")])


@query("I05_split_nested_paren", """SELECT p_partkey, p_name || ' A + B' AS asset, p_type || ' disease' AS indication FROM part""")
def i05_nested(spark, d):
    raw = F.concat(F.lit("■ "), "p_name", F.lit(" A* (anti-X (IgG) mAb) (alias) + B (y) "), "p_type", F.lit(" disease"))
    return (table(spark, d, "part").select("p_partkey", I.nested_entry(raw).alias("e"))
            .select("p_partkey", "e.asset", "e.indication"))


PROGRAM_LINES = [  # text, asset, molecule, code, brand, indication, status
    ("AZD0780 dyslipidaemia {n}", "AZD0780", None, "AZD0780", None, "dyslipidaemia {n}", "PASS"),
    ("baxdrostat (AZD1234) {n}", "baxdrostat", "baxdrostat", "AZD1234", None, "{n}", "PASS"),
    ("Imfinzi (durvalumab) NSCLC {n}", "Imfinzi", "durvalumab", None, "Imfinzi", "NSCLC {n}", "PASS"),
    ("datopotamab vedotin {n}", "datopotamab vedotin", "datopotamab vedotin", None, None, "{n}", "PASS"),
    ("efzimfotase alfa {n}", "efzimfotase alfa", "efzimfotase alfa", None, None, "{n}", "PASS"),
    ("EnhertuDESTINY-PanTumor02 {n}", "Enhertu", None, None, "Enhertu", "DESTINY-PanTumor02 {n}", "PASS"),
    ("Calquence (China) CLL {n}", "Calquence", None, None, "Calquence", "CLL {n}", "PASS"),
    ("Beyfortus/Synagis RSV {n}", "Beyfortus", None, None, "Beyfortus", "RSV {n}", "PASS"),
    ("Imfinzi (durvalumab)/Imjudo HCC {n}", "Imfinzi", "durvalumab", None, "Imfinzi", "HCC {n}", "PASS"),
    ("Solo", "Solo", None, None, "Solo", None, "REVIEW"),
]


def _program_sql():
    from .registry import sql_text
    rows = ", ".join("(" + ", ".join([str(i)] + ["NULL" if v is None else sql_text(v) for v in r[1:]]) + ")"
                     for i, r in enumerate(PROGRAM_LINES))
    return (f"SELECT p_partkey, asset, molecule, code, brand, replace(indication, '{{n}}', p_name) AS indication, status "
            f"FROM part JOIN (VALUES {rows}) v(i, asset, molecule, code, brand, indication, status) "
            f"ON i = p_partkey % {len(PROGRAM_LINES)}")


@query("I06_program_text", _program_sql())
def i06(spark, d):
    from .registry import pick
    text = F.replace(pick("p_partkey", [r[0] for r in PROGRAM_LINES]), F.lit("{n}"), F.col("p_name"))
    out = I.split_program_text(table(spark, d, "part").select("p_partkey", text.alias("raw")), "raw")
    return out.select("p_partkey", *[f"parsed.{k}" for k in ("asset", "molecule", "code", "brand", "indication", "status")])


scalar_cases("I07_study_codes", joined(I.study_codes), [
    ("Combo (Symbiotic-GI-16) {n}", "symbiotic gi 16"), ("x (MM-5) (TALAPRO-3)", "mm 5|talapro 3"), ("({n})", ""), ("FourLight-3", ""),
    ("(Be6A Lung-01)", "be6a lung 01"), ("(HER2CLIMB05)", "her2climb05")])
scalar_cases("I08_line_qualifier", I.line_qualifier, [
    ("1L {n}", "1L"), ("2L+ x", "2L"), ("second-line plus", "2L+"), ("third line {n}", "3L"), ("{n}", ""), ("2L+x", "2L+")])
scalar_cases("I09_qualifier_flags", lambda c: F.array_join(I.qualifier_flags(T.clinical_norm(c)), "|"), [
    ("neoadjuvant {n}", "adjuvant|neoadjuvant"), ("post-transplant maintenance", "maintenance|transplant-maintenance"),
    ("transplant-ineligible, post CD38", "post-cd38|transplant-ineligible"), ("metastatic early breast cancer", "early-stage|metastatic"),
    ("double-class exposed {n}", "double-class-exposed"), ("{n}", "")])
scalar_cases("I10_trial_ids", joined(I.trial_ids), [
    ("NCT01234567 nct01234567, NCT76543210", "NCT01234567|NCT76543210"), ("NCT123 {n}", "")])
scalar_cases("I11_brand_candidates_identity", joined(lambda c: I.brand_candidates(c, "identity")), [
    ("DAYPRO ALTA™ tablets", "DAYPRO ALTA|DAYPRO"), ("Zithromax® (x) for injection", "Zithromax"), ("North American {n}", "North American {n}|North"),
    ("For", ""), ("The {n}", "The {n}")])
scalar_cases("I11_brand_candidates_evidence", joined(lambda c: I.brand_candidates(c, "evidence")), [
    ("DAYPRO ALTA™ tablets", "DAYPRO ALTA"), ("North American {n}", "North American {n}"), ("MEDROL® Oral {n}", "MEDROL Oral {n}|MEDROL"), ("Medrol", "Medrol")])


@query("I12_application_candidates", """WITH a AS (SELECT o_orderkey, lpad((o_orderkey % 1000000)::VARCHAR, 6, '0') AS n FROM orders)
SELECT o_orderkey, n || '|BLA' || n || '|NDA' || n || '|ANDA' || n || '|X1' AS bare, 'NDA' || n || '|' || n AS stripped, n AS digits FROM a""")
def i12(spark, d):
    n = F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0")
    return table(spark, d, "orders").select(
        "o_orderkey", F.array_join(I.application_candidates(F.array(n, n, F.lit(" x 1"), F.lit(""))), "|").alias("bare"),
        F.array_join(I.application_candidates(F.array(F.concat(F.lit("nda "), n)), True), "|").alias("stripped"),
        F.array_join(I.numeric_applications(F.array(F.concat(F.lit("ANDA"), n), n, F.lit("12"))), "|").alias("digits"))


scalar_cases("I13_combination_components", joined(I.combination_components), [
    ("Alpha + {n}", "alpha|{n}"), ("ab + gamma", ""), ("{n}", ""), ("TALZENNA + XTANDI + xy", "talzenna|xtandi")])
scalar_cases("I14_labeler", I.labeler, [("MEDROL tablet [Pharma LLC]", "Pharma LLC"), ("{n}", "")])


@query("I15_label_links", """SELECT page_id, 'https://www.accessdata.fda.gov/drugsatfda_docs/label/2024/' || page_id || 's012lbl.pdf|'
 || 'https://www.accessdata.fda.gov/drugsatfda_docs/label/2024/' || page_id || 's003lbl.pdf|'
 || 'https://www.accessdata.fda.gov/drugsatfda_docs/label/2019/' || page_id || 'lbl.pdf' AS links FROM pages""")
def i15(spark, d):
    i = F.col("page_id").cast("string")
    extra = F.concat(F.lit("<a href=\"/drugsatfda_docs/label/2019/"), i, F.lit("lbl.pdf\">old</a><a href='/drugsatfda_docs/label/2024/"), i,
                     F.lit("s003lbl.pdf'><a href=\"https://www.accessdata.fda.gov/drugsatfda_docs/label/2024/"), i,
                     F.lit("s012lbl.pdf\"><a href=\"/drugsatfda_docs/label/2024/"), i, F.lit("S012lbl.pdf\">"))
    links = I.label_links(F.concat("html", extra))
    return table(spark, d, "pages").select("page_id", F.array_join(links, "|").alias("links"))


scalar_cases("I16_label_ingredients", lambda c: F.array_join(I.label_ingredients(c, F.array(F.lit("Medrol"), F.lit("Arthrotec"))), "|"), [
    ("MEDROL® (methylprednisolone {n}) Tablets", "methylprednisolone {n}"), ("Medrol soft base tablets", "soft base"),
    ("ARTHROTEC (diclofenac) MEDROL (x y)", "x y|diclofenac"), ("{n}", "")])


@query("I17_record_id", """SELECT p_partkey, 'id:' || substr(sha1(lower(p_type) || '|' || p_name || '|' || p_partkey), 1, 16) AS record_id,
  'ID-' || upper(substr(sha1(p_type || '|' || p_name), 1, 18)) AS upper_id FROM part""")
def i17(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", I.record_id("id:", [T.norm("p_type"), T.norm("p_name"), F.col("p_partkey").cast("string")]).alias("record_id"),
        I.record_id("ID-", [F.col("p_type"), F.col("p_name")], 18, True).alias("upper_id"))


@query("I18_candidate_id", f"""WITH {B.PROGRAM_SQL} SELECT 'acme|bench|' || replace({B.norm_sql('source_record_id')}, ' ', '_') || '|' ||
  replace({B.norm_sql('asset')}, ' ', '_') || '|' || replace({B.norm_sql('indication')}, ' ', '_') AS candidate_id FROM program_v""")
def i18(spark, d):
    p = B.programs(spark, d)
    return p.select(I.candidate_id("company", "source_family", "source_record_id", "asset", "brand", F.lit(None).cast("string"),
                                   F.lit(""), "indication").alias("candidate_id"))


def _fingerprint_sql():
    h = ("sha256('{\"id\":\"P' || p_partkey || '\",\"name\":\"' || p_name || '\",\"molecule\":\"' || p_type || '\"}')")
    sums = " || ':' || ".join(f"sum(('0x' || substr(h, {i * 8 + 1}, 8))::BIGINT)::HUGEINT::VARCHAR" for i in range(8))
    return (f"SELECT company, count(*) AS products, sha256(count(*)::VARCHAR || ':' || {sums}) AS fingerprint "
            f"FROM (SELECT p_brand AS company, {h} AS h FROM part) GROUP BY company")


@query("I19_catalog_fingerprint", _fingerprint_sql())
def i19(spark, d):
    return I.catalog_fingerprint(B.catalog(spark, d), ["company"], "product_id", ["name", "molecule"])


@query("I20_identity_candidate", f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
n AS (SELECT doc_id, {B.clean_sql('line')} AS s, {B.norm_sql('line')} AS n FROM l)
SELECT doc_id, count(*) AS lines, sum((s <> '' AND n <> '' AND length(s) <= 120 AND len(string_split(s, ' ')) <= 12
  AND NOT regexp_matches(n, '^[0-9]+$') AND NOT regexp_matches(n, 'phase [1-4]|registration|regulatory|filed|preclinical|pre clinical')
  AND NOT (starts_with(n, 'updated ') OR starts_with(n, 'last updated ') OR starts_with(n, 'download') OR starts_with(n, 'overview')
           OR starts_with(n, 'clinical trials') OR starts_with(n, 'major ongoing clinical studies')))::BIGINT)::BIGINT AS candidates
FROM n GROUP BY doc_id""")
def i20(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("lines"),
                                       F.sum(I.is_identity_candidate("line").cast("long")).alias("candidates"))


scalar_cases("I21_partners", joined(I.partners_of), [
    ("[\"A & B\", \" {n} \", \"\"]", "A & B|{n}"), ("{\"k\": \"{n}\"}", "{n}"), ("false", ""), ("{n}", "{n}"), ("\"x\"", "x")])


@query("I22_label_link_score", """SELECT page_id, [9, 5, 2, 0, NULL][1 + page_id % 5]::INT AS score FROM pages""")
def i22(spark, d):
    from .registry import pick
    anchor = pick("page_id", ["Medrol Prescribing Information for physicians", "U.S. Prescribing Information", "Physician site", "Home", "Medication Guide for physicians"])
    return table(spark, d, "pages").select("page_id", I.label_link_score(anchor, F.array(F.lit("MEDROL"))).alias("score"))
