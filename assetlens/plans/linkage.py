"""Queries for record linkage, classification and the candidate sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import phase as P
from ..functions import text as T
from ..operators import linkage as L
from ..operators import staging
from . import bindings as B
from .registry import pick, pick_sql, query, table

n = B.norm_sql


_BUILT: dict = {}


def _linkage(spark, d, mode="qualified"):
    """The comparison of one data set; its written feature tables serve every query."""
    key = (spark.sparkContext.applicationId, d, mode)
    if key not in _BUILT:
        _BUILT[key] = L.Linkage(B.programs(spark, d), B.portfolio(spark, d), B.aliases(spark), mode)
    return _BUILT[key]


PAIRS_SQL = f"""WITH {B.PORTFOLIO_SQL}, {B.PROGRAM_SQL},
s AS (SELECT source_record_id, asset, brand, indication, phase, {n('asset')} AS a, {n('brand')} AS b, {n('indication')} AS raw,
        CASE phase WHEN 'Phase I/II' THEN 'phase 1 2' WHEN 'Phase III' THEN 'phase 3' WHEN 'Phase 2b/3' THEN 'phase 2 3' ELSE 'phase 1' END AS ph
      FROM program_v),
e AS (SELECT * FROM s WHERE ph <> 'phase 1'),
p AS (SELECT record_id, portfolio_ordinal, {n('asset')} AS pa, {n('brand')} AS pb, {n('indication')} AS praw, {n('controlled_indication')} AS pc,
        lower(phase) AS pph, phase AS pphase FROM portfolio_v),
j AS (SELECT * FROM e JOIN p ON a = pa UNION SELECT * FROM e JOIN p ON b = pb),
w AS (SELECT *, CASE WHEN raw = praw THEN 100 ELSE 0 END AS x1,
        CASE WHEN len(string_split(CASE WHEN len(string_split(raw, ' ')) <= len(string_split(praw, ' ')) THEN raw ELSE praw END, ' ')) >= 3
              AND (CASE WHEN len(string_split(raw, ' ')) <= len(string_split(praw, ' '))
                        THEN contains(' ' || praw || ' ', ' ' || raw || ' ') ELSE contains(' ' || raw || ' ', ' ' || praw || ' ') END)
             THEN 82 ELSE 0 END AS x2,
        CASE WHEN contains(' ' || raw || ' ', ' ' || pc || ' ') THEN 72 ELSE 0 END AS x3,
        CASE WHEN ph = pph THEN 12 ELSE 0 END AS x4, a = pa AS by_asset, b = pb AS by_brand FROM j),
sc AS (SELECT *, greatest(x1, x2, x3) + x4 AS score FROM w)"""

RANK_SQL = PAIRS_SQL + """,
top AS (SELECT source_record_id, max(score) AS best FROM sc GROUP BY 1),
tied AS (SELECT sc.* FROM sc JOIN top USING (source_record_id) WHERE score = best AND best >= 72),
t AS (SELECT source_record_id, max(score) AS best, count(*) AS ties, arg_min(record_id, portfolio_ordinal) AS record_id,
        arg_min(pph, portfolio_ordinal) AS pph, bool_or(by_asset) AS t_asset, bool_or(by_brand) AS t_brand,
        arg_min((CASE WHEN x1 > 0 THEN 'Exact normalized source-facing indication;' ELSE '' END)
             || (CASE WHEN x2 > 0 THEN 'Deterministic source-indication containment;' ELSE '' END)
             || (CASE WHEN x3 > 0 THEN 'Controlled disease phrase present in source indication;' ELSE '' END)
             || (CASE WHEN x4 > 0 THEN 'Exact canonical phase;' ELSE '' END), portfolio_ordinal) AS evidence
      FROM tied GROUP BY 1),
i AS (SELECT source_record_id, bool_or(by_asset) AS i_asset, bool_or(by_brand) AS i_brand, count(*) AS records FROM sc GROUP BY 1),
c AS (SELECT s.*, t.* EXCLUDE (source_record_id), i.* EXCLUDE (source_record_id),
        CASE WHEN ph = 'phase 1' THEN 'EXCLUDED BY RULE' WHEN ties = 1 THEN 'MATCHED' WHEN ties > 1 THEN 'POSSIBLE DUPLICATE'
             WHEN i_asset IS NOT NULL THEN 'NEW INDICATION' ELSE 'NEW ASSET' END AS classification
      FROM s LEFT JOIN t USING (source_record_id) LEFT JOIN i USING (source_record_id))"""

CANDIDATE_SQL = RANK_SQL + """,
k AS (SELECT *, CASE WHEN classification IN ('MATCHED', 'POSSIBLE DUPLICATE') THEN t_asset WHEN classification = 'NEW INDICATION' THEN i_asset ELSE false END AS ma,
        CASE WHEN classification IN ('MATCHED', 'POSSIBLE DUPLICATE') THEN t_brand WHEN classification = 'NEW INDICATION' THEN i_brand ELSE false END AS mb FROM c),
candidate_v AS (SELECT source_record_id, asset, indication, phase, classification,
  CASE classification WHEN 'EXCLUDED BY RULE' THEN 'Exclude' WHEN 'POSSIBLE DUPLICATE' THEN 'Review' ELSE 'Include' END AS decision,
  CASE WHEN ph = 'phase 1' THEN 'Legacy / Low Commercial Value' WHEN ph = 'phase 3' THEN 'Active Phase 2+' ELSE 'Integrated Phase 2+' END AS basis,
  CASE WHEN classification = 'MATCHED' THEN record_id END AS matched_record_id, ties::BIGINT AS plausible_records, best::INT AS best_score,
  CASE WHEN ma AND mb THEN 'Composite Exact Identity' WHEN mb THEN 'Exact Brand' WHEN ma THEN 'Exact Asset' ELSE 'No Match' END AS match_method,
  CASE WHEN classification = 'MATCHED' THEN CASE WHEN ma AND mb THEN 'High' ELSE 'Medium' END WHEN classification = 'NEW INDICATION' THEN 'Medium' ELSE 'Low' END AS match_confidence,
  CASE classification WHEN 'MATCHED' THEN evidence WHEN 'POSSIBLE DUPLICATE' THEN 'Multiple existing Portfolio rows remain equally plausible at asset/indication qualifier grain.;'
     WHEN 'NEW INDICATION' THEN 'Exact asset identity exists, but no deterministic indication/qualifier match reached threshold.;' ELSE '' END AS evidence,
  CASE WHEN classification = 'MATCHED' AND ph <> pph THEN ph || '>' || pph ELSE '' END AS delta
FROM k)"""


@query("C07_classification", CANDIDATE_SQL + " SELECT * FROM candidate_v")
def c07(spark, d):
    c = _linkage(spark, d).candidates()
    return c.select("source_record_id", "asset", "indication", "phase", "classification", "decision",
                    F.array_join("inclusion_basis", ";").alias("basis"), "matched_record_id", "plausible_records",
                    "best_score", "match_method", "match_confidence",
                    F.concat_ws("", F.transform("match_evidence", lambda e: F.concat(e, F.lit(";")))).alias("evidence"),
                    F.concat_ws("", F.transform("field_deltas", lambda x: F.concat(
                        x["normalized_source"], F.lit(">"), x["normalized_portfolio"]))).alias("delta"))


@query("A01_class_summary", CANDIDATE_SQL + """ SELECT classification, count(candidate_v.source_record_id) AS n
FROM (SELECT unnest(['EXCLUDED BY RULE', 'MATCHED', 'NEW ASSET', 'NEW INDICATION', 'OWNERSHIP REVIEW', 'POSSIBLE DUPLICATE', 'SOURCE UNAVAILABLE']) AS classification)
LEFT JOIN candidate_v USING (classification) GROUP BY 1""")
def a01(spark, d):
    return L.class_summary(_linkage(spark, d).candidates())


@query("W01_ranked_best", RANK_SQL + " SELECT source_record_id, best::INT AS best_score, ties::BIGINT AS ties FROM t")
def w01(spark, d):
    link = _linkage(spark, d)
    return (link.rows.filter("gate is null").join(link.outcomes(), "profile")
            .select("source_record_id", F.col("score").alias("best_score"), "ties"))


@query("JN01_identity_links", PAIRS_SQL + """ SELECT a AS asset_key, b AS brand_key, pa AS portfolio_asset, pb AS portfolio_brand, count(*) AS pairs,
 CASE WHEN by_asset AND by_brand THEN 'Exact Brand;Exact Asset' WHEN by_asset THEN 'Exact Asset' ELSE 'Exact Brand' END AS methods
FROM sc GROUP BY ALL""")
def jn01(spark, d):
    links = L.identity_links(_linkage(spark, d))

    def key(col, kind):
        return F.get(F.transform(F.filter(col, lambda k: k["kind"] == kind), lambda k: k["key"]), F.lit(0))
    return links.select(key("s_keys", "asset").alias("asset_key"), key("s_keys", "brand").alias("brand_key"),
                        key("p_keys", "asset").alias("portfolio_asset"), key("p_keys", "brand").alias("portfolio_brand"),
                        (F.col("n_source") * F.col("n_portfolio")).alias("pairs"),
                        F.array_join("methods", ";").alias("methods"))


@query("JN01_new_indication_records", CANDIDATE_SQL + """ SELECT sc.source_record_id, count(*) AS records, sum(portfolio_ordinal)::BIGINT AS ordinals,
  max(score)::INT AS top_score FROM sc JOIN candidate_v USING (source_record_id) WHERE classification = 'NEW INDICATION' GROUP BY 1""")
def jn01_records(spark, d):
    link = _linkage(spark, d)
    per = link.records().groupBy("profile").agg(F.count("*").alias("records"), F.sum("portfolio_ordinal").alias("ordinals"),
                                                F.max("score").alias("top_score"))
    new = link.candidates().filter("classification = 'NEW INDICATION'").select("source_record_id", "profile")
    return new.join(per, "profile").select("source_record_id", "records", "ordinals", "top_score")


COMBO_SQL = f"""WITH {B.PORTFOLIO_SQL}, {B.PROGRAM_SQL},
c AS (SELECT DISTINCT {n('asset')} AS a, {n('brand')} AS b FROM portfolio_v WHERE portfolio_ordinal % 2 = 0),
s AS (SELECT source_record_id, ' ' || {n("asset || ' ' || brand || ' ' || indication")} || ' ' AS u FROM program_v WHERE phase <> 'Phase 1')
SELECT a || ' + ' || b AS combination, count(*) AS programmes FROM s JOIN c ON contains(u, ' ' || a || ' ') AND contains(u, ' ' || b || ' ') GROUP BY 1"""


@query("JN02_combination_division", COMBO_SQL)
def jn02(spark, d):
    folio = B.portfolio(spark, d)
    folio = folio.withColumn("brand", F.when(F.col("portfolio_ordinal") % 2 == 0, F.concat_ws(" + ", "asset", "brand")).otherwise(F.col("brand")))
    link = L.Linkage(B.programs(spark, d), folio, B.aliases(spark))
    hits = link.live.filter("kind = 'combo'").join(link.rows.filter("gate is null").select("profile"), "profile")
    return hits.groupBy(F.col("key").alias("combination")).agg(F.count("*").alias("programmes"))


@query("JN03_company_scope", f"""SELECT s_suppkey, s_nationkey % 5 = 0 OR lower(n_name) IN ('nation 3', 'nation_3', 'nation 7', 'nation_7') AS in_scope
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def jn03(spark, d):
    names = L.company_names(spark.createDataFrame([("Nation 3", "NATION-7")], "target string, alias string"))
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    s = s.withColumn("company", F.when(F.col("s_nationkey") % 5 == 0, F.lit(None)).otherwise(F.col("n_name")))
    hit = names.select("name", F.lit(True).alias("hit")).distinct()
    out = s.withColumn("name", T.norm("company")).join(hit, "name", "left")
    return out.select("s_suppkey", (F.col("company").isNull() | F.coalesce("hit", F.lit(False))).alias("in_scope"))


DECISIONS = [  # phase, status, decision, basis
    ("Phase 2", "Active", "Include", "Active Phase 2+"), ("Phase I/II", "Active", "Include", "Integrated Phase 2+"),
    ("Phase 1", "Active", "Exclude", "Legacy / Low Commercial Value"), ("Filed", "Active", "Include", "Filed / Registration"),
    ("Phase 3", "Programme terminated", "Exclude", "Inactive / Discontinued"), ("Preclinical", "Active", "Review", "Insufficient Evidence"),
    ("Phase 4", "Active", "Review", "Insufficient Evidence"), ("Phase 1/2/3", "Active", "Include", "Integrated Phase 2+")]


def _decision_sql(rows):
    key = "l_orderkey"
    return (f"SELECT {pick_sql(key, [r[0] for r in rows])} AS phase, {pick_sql(key, [r[2] for r in rows])} AS decision, "
            f"{pick_sql(key, [r[3] for r in rows])} AS basis, count(*) AS n FROM lineitem GROUP BY ALL")


def _decide(spark, d, mode, rows):
    from ..sources.contract import PROGRAM, conform
    p = table(spark, d, "lineitem").select(pick("l_orderkey", [r[0] for r in rows]).alias("phase"),
                                           pick("l_orderkey", [r[1] for r in rows]).alias("program_status"))
    p = conform(p, PROGRAM).withColumn("phase_key", P.hybrid("phase", "plain")).withColumn("rule", L.commercial_decision(mode))
    return p.groupBy("phase", F.col("rule.decision").alias("decision"),
                     F.array_join("rule.basis", ";").alias("basis")).agg(F.count("*").alias("n"))


@query("C01_commercial_decision", _decision_sql(DECISIONS))
def c01(spark, d):
    return _decide(spark, d, "qualified", DECISIONS)


EXACT_DECISIONS = [("Phase 2", "Active", "Include", "Active Phase 2+"), ("Phase II/III", "x", "Include", "Active Phase 2+"),
                   ("Phase I/II", "x", "Review", "Insufficient Evidence"), ("Registration", "x", "Include", "Filed / Registration"),
                   ("Phase 1", "x", "Exclude", "Legacy / Low Commercial Value"), ("", "withdrawn", "Exclude", "Inactive / Discontinued")]


@query("C08_exact_decision", _decision_sql(EXACT_DECISIONS))
def c08_decision(spark, d):
    return _decide(spark, d, "exact", EXACT_DECISIONS)


@query("C02_ownership_issue", """SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'Source explicitly indicates unresolved ownership/licensing.'
  WHEN s_nationkey <> 3 AND s_nationkey <> 7 THEN 'Source company ''' || n_name || ''' does not exactly resolve to target company/verified aliases.'
  WHEN s_suppkey % 4 = 1 THEN 'Source sponsor/owner ''' || s_name || ''' does not exactly resolve to target company/verified aliases and ownershipResolved was not explicitly true.' END AS reason
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def c02(spark, d):
    from ..sources.contract import PROGRAM, conform
    names = L.company_names(spark.createDataFrame([("Nation 3", "NATION-7")], "target string, alias string"))
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey") % 4
    rows = s.select("s_suppkey", F.lit("Nation 3").alias("target"), F.col("n_name").alias("company"), F.col("s_name").alias("sponsor_owner"),
                    F.when(k == 0, False).when(k == 2, True).when(k == 3, True).alias("ownership_resolved"))
    return L.with_ownership(conform(rows, PROGRAM), names).select("s_suppkey", F.col("ownership_reason").alias("reason"))


@query("C03_indication_score", PAIRS_SQL + " SELECT score::INT AS score, count(*) AS pairs FROM sc WHERE by_asset AND by_brand GROUP BY 1")
def c03(spark, d):
    link = _linkage(spark, d)
    names = lambda c: F.array_sort(F.transform(F.filter(c, lambda k: k["kind"].isin("asset", "brand")), lambda k: k["key"]))
    weight = link.rows.filter("gate is null").groupBy("profile").agg(F.count("*").alias("n"))
    s = link.profiles.join(weight, "profile").select(
        "n", F.struct("raw", "controlled", *L.SCORE_FEATURES).alias("s"), names("keys").alias("keys"))
    p = link.portfolio_profiles.select("records", F.struct("raw", "controlled", "aliases", *L.SCORE_FEATURES).alias("p"),
                                       names("keys").alias("keys"))
    score = L.indication_score(lambda c: F.col(f"s.{c}"), lambda c: F.col(f"p.{c}"))
    return s.join(p, "keys").groupBy(score.alias("score")).agg(F.sum(F.col("n") * F.col("records")).alias("pairs"))


KIND_SETS = ["code", "brand", "asset|brand", "combo", "alias", "molecule|alias", ""]
KIND_BEST = ["Exact Development Code", "Exact Brand", L.COMPOSITE, L.COMPOSITE, "Verified Alias", L.COMPOSITE, "No Match"]
KIND_CONF = [("High", "Medium", "Low"), ("Medium", "Medium", "Low"), ("High", "Medium", "Low"), ("High", "Medium", "Low"),
             ("Medium", "Medium", "Low"), ("High", "Medium", "Low"), ("Low", "Low", "Low")]


@query("C04_best_method", f"SELECT {pick_sql('l_partkey', KIND_BEST)} AS best, count(*) AS n FROM lineitem GROUP BY 1")
def c04(spark, d):
    kinds = F.split(pick("l_partkey", KIND_SETS), r"\|")
    return (table(spark, d, "lineitem").select(L.best_method(L.methods_of(kinds, "qualified")).alias("best"))
            .groupBy("best").agg(F.count("*").alias("n")))


@query("C05_match_confidence", f"""SELECT l_partkey % 7 AS kind_set, CASE WHEN l_quantity >= 36 THEN {pick_sql('l_partkey', [c[0] for c in KIND_CONF])}
  WHEN l_quantity >= 30 THEN {pick_sql('l_partkey', [c[1] for c in KIND_CONF])} ELSE 'Low' END AS confidence, count(*) AS n FROM lineitem GROUP BY ALL""")
def c05(spark, d):
    kinds = F.split(pick("l_partkey", KIND_SETS), r"\|")
    conf = L.match_confidence(L.methods_of(kinds, "qualified"), F.col("l_quantity") * 2)
    return (table(spark, d, "lineitem").select((F.col("l_partkey") % 7).alias("kind_set"), conf.alias("confidence"))
            .groupBy("kind_set", "confidence").agg(F.count("*").alias("n")))


@query("C06_field_deltas", """SELECT a.p_partkey AS record_key, 'Phase ' || (1 + a.p_size % 3) AS old_phase, 'Phase ' || (1 + (a.p_size + a.p_partkey % 2) % 3) AS new_phase
FROM part a WHERE a.p_partkey % 2 = 1""")
def c06(spark, d):
    a = table(spark, d, "part").select(F.col("p_partkey").alias("record_key"), F.concat(F.lit("Phase "), 1 + F.col("p_size") % 3).alias("old_phase"))
    b = table(spark, d, "part").select(F.col("p_partkey").alias("record_key"),
                                       F.concat(F.lit("Phase "), 1 + (F.col("p_size") + F.col("p_partkey") % 2) % 3).alias("new_phase"))
    return a.join(b, "record_key").filter(P.hybrid("old_phase", "plain") != P.hybrid("new_phase", "plain"))


EXACT_SQL = PAIRS_SQL + """,
m AS (SELECT source_record_id, count(*) AS ties, arg_min(record_id, portfolio_ordinal) AS record_id FROM sc WHERE raw = praw OR raw = pc GROUP BY 1),
any_match AS (SELECT DISTINCT source_record_id FROM sc)
SELECT s.source_record_id, CASE WHEN ph = 'phase 1' THEN 'EXCLUDED BY RULE' WHEN ties = 1 THEN 'MATCHED' WHEN ties > 1 THEN 'POSSIBLE DUPLICATE'
   WHEN a.source_record_id IS NOT NULL THEN 'NEW INDICATION' ELSE 'NEW ASSET' END AS classification,
   CASE WHEN ties = 1 THEN record_id END AS matched_record_id, ties::BIGINT AS plausible_records
FROM s LEFT JOIN m ON s.source_record_id = m.source_record_id LEFT JOIN any_match a ON s.source_record_id = a.source_record_id"""


@query("C08_exact_mode", EXACT_SQL)
def c08(spark, d):
    c = _linkage(spark, d, "exact").candidates()
    return c.select("source_record_id", "classification", "matched_record_id", "plausible_records")


@query("K01_candidate_export", CANDIDATE_SQL + """, o AS (SELECT source_record_id, classification, match_method, 'READ ONLY' AS guardrail
  FROM candidate_v WHERE classification IN ('NEW ASSET', 'NEW INDICATION', 'POSSIBLE DUPLICATE', 'OWNERSHIP REVIEW'))
SELECT *, row_number() OVER (ORDER BY source_record_id) AS ordinal, count(*) OVER () AS total FROM o""")
def k01(spark, d):
    staged = staging.staged_export(_linkage(spark, d).candidates(), ["source_record_id"])
    return staged.select("source_record_id", "classification", "match_method", F.lit("READ ONLY").alias("guardrail"), "ordinal", "total")


@query("U03_stage_subset", CANDIDATE_SQL + " SELECT classification, count(*) AS n FROM candidate_v WHERE classification IN ('NEW ASSET', 'NEW INDICATION', 'POSSIBLE DUPLICATE', 'OWNERSHIP REVIEW') GROUP BY 1")
def u03(spark, d):
    return staging.stage_subset(_linkage(spark, d).candidates()).groupBy("classification").agg(F.count("*").alias("n"))


@query("K04_review_line", CANDIDATE_SQL + """ SELECT classification || '|' || phase || '|' || asset || '|' || indication || '|' || match_method || '|' || match_confidence AS line,
 count(*) AS n FROM candidate_v GROUP BY 1""")
def k04(spark, d):
    return L.compact(_linkage(spark, d).candidates()).groupBy("line").agg(F.count("*").alias("n"))


@query("A04_phase_class_crosstab", CANDIDATE_SQL + """ SELECT phase, classification, match_confidence, match_method, count(*) AS n FROM candidate_v
GROUP BY GROUPING SETS ((phase, classification), (match_confidence), (match_method))""")
def a04(spark, d):
    c = _linkage(spark, d).candidates().select("phase", "classification", "match_confidence", "match_method")
    return c.groupingSets([["phase", "classification"], ["match_confidence"], ["match_method"]],
                          "phase", "classification", "match_confidence", "match_method").agg(F.count("*").alias("n"))


@query("M04_guardrails", f"WITH {B.PROGRAM_SQL} SELECT false AS master_writes, false AS fuzzy_matching, true AS ambiguous_identity_fails_closed, count(*) AS n FROM program_v")
def m04(spark, d):
    rows = staging.with_guardrails(B.programs(spark, d))
    g = F.col("guardrails")
    return rows.groupBy(g["master_writes"].alias("master_writes"), g["fuzzy_matching"].alias("fuzzy_matching"),
                        g["ambiguous_identity_fails_closed"].alias("ambiguous_identity_fails_closed")).agg(F.count("*").alias("n"))
