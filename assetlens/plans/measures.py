"""Queries for aggregates, windows, top-k, de-duplication, gates and the review queue."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import measures as M
from ..operators import quality as Q
from ..operators import staging as S
from ..operators.ordered import Ordered
from . import bindings as B
from .registry import query, table

n = B.norm_sql
cnt = lambda: F.count("*").alias("n")


@query("A02_counts_by_dimension", "SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), (l_linenumber))")
def a02(spark, d):
    li = table(spark, d, "lineitem")
    return li.groupingSets([["l_returnflag"], ["l_linestatus"], ["l_linenumber"]], "l_returnflag", "l_linestatus", "l_linenumber").agg(cnt())


@query("A03_phase_profile", """SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS phase_1, count(*) FILTER (l_returnflag = 'A') AS phase_2,
  count(*) FILTER (l_returnflag = 'N') AS phase_3, count(*) FILTER (l_returnflag = 'F') AS filed, count(*) AS total FROM lineitem GROUP BY 1""")
def a03(spark, d):
    return M.slot_profile(table(spark, d, "lineitem"), ["l_suppkey"], "l_returnflag", {"phase_1": "R", "phase_2": "A", "phase_3": "N", "filed": "F"})


@query("A05_attribute_union", """SELECT DISTINCT l_partkey, unnest(['status', 'supplier']) AS attribute, unnest([l_returnflag || l_linestatus, l_suppkey::VARCHAR]) AS value FROM lineitem""")
def a05(spark, d):
    return M.attribute_union(table(spark, d, "lineitem"), "l_partkey", {"status": F.concat("l_returnflag", "l_linestatus"), "supplier": F.col("l_suppkey")})


@query("A06_programme_rollup", """SELECT o_custkey AS asset_key, o_orderstatus AS condition_key, count(DISTINCT o_orderkey) AS trials, max(substr(o_orderpriority, 1, 1)::INT) AS phase_rank,
  max(CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 4 ELSE 2 END)::INT AS status_rank, arg_min(o_orderpriority, o_orderkey) AS title FROM orders GROUP BY 1, 2""")
def a06(spark, d):
    from ..functions import phase as P
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "recruiting").otherwise("unknown")
    trials = table(spark, d, "orders").select(
        F.col("o_custkey").alias("asset_key"), F.col("o_orderstatus").alias("condition_key"), F.col("o_orderkey").alias("nct"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("phase_rank"), P.status_priority(status).alias("status_rank"),
        F.col("o_orderkey").alias("ordinal"), F.col("o_orderpriority").alias("title"))
    return M.programme_rollup(trials)


@query("A06_programme_details", """WITH t AS (SELECT o_custkey AS asset_key, o_orderstatus AS condition_key, o_orderkey AS k, 'NCT' || (o_orderkey // 8) AS nct, substr(o_orderpriority, 1, 1)::INT AS r, o_orderpriority AS p,
  CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE substr(o_orderpriority, 3) END AS x FROM orders),
x AS (SELECT asset_key, condition_key, x, min(k) AS k FROM t WHERE x <> '' GROUP BY 1, 2, 3),
g AS (SELECT asset_key, condition_key, string_agg(x, '; ' ORDER BY k) AS info FROM x WHERE NOT EXISTS (SELECT 1 FROM x u WHERE u.asset_key = x.asset_key AND u.condition_key = x.condition_key AND u.k < x.k AND contains(u.x, x.x)) GROUP BY 1, 2),
h AS (SELECT asset_key, condition_key, string_agg(DISTINCT nct, ' ' ORDER BY nct) AS trial_ids, arg_max(p, r) AS phase, arg_min(condition_key, k) AS status FROM t GROUP BY 1, 2)
SELECT h.*, coalesce(info, '') AS additional_information FROM h LEFT JOIN g USING (asset_key, condition_key)""")
def a06_details(spark, d):
    k, p = F.col("o_orderkey"), F.col("o_orderpriority")
    trials = table(spark, d, "orders").select(
        F.col("o_custkey").alias("asset_key"), F.col("o_orderstatus").alias("condition_key"), k.alias("ordinal"), F.concat(F.lit("NCT"), F.floor(k / 8)).alias("nct"),
        F.substring(p, 1, 1).cast("int").alias("phase_rank"), p.alias("phase"), F.lit(1).alias("status_rank"), F.col("o_orderstatus").alias("status"),
        F.when(k % 3 == 0, "").when(k % 2 == 0, p).otherwise(F.substr(p, F.lit(3))).alias("information"))
    return M.programme_details(trials).withColumn("trial_ids", F.array_join("trial_ids", " "))


@query("A07_duplicate_surplus", """SELECT l_suppkey, (count(*) - count(DISTINCT (l_orderkey, l_linenumber)))::BIGINT AS surplus, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_rows FROM lineitem GROUP BY 1""")
def a07(spark, d):
    return M.duplicate_surplus(table(spark, d, "lineitem"), ["l_suppkey"], ["l_orderkey", "l_linenumber"])


@query("A08_variant_collisions", "SELECT p_name, p_brand, count(*) AS rows, count(DISTINCT p_type) AS variants FROM part GROUP BY 1, 2 HAVING count(DISTINCT p_type) > 1")
def a08(spark, d):
    return M.variant_collisions(table(spark, d, "part"), ["p_name", "p_brand"], "p_type")


@query("A09_class_role_counts", """SELECT event_type, active, total, row_number() OVER (ORDER BY active DESC, total DESC, event_type)::INT AS position
FROM (SELECT event_type, count(*) FILTER (value > 50) AS active, count(*) AS total FROM events GROUP BY 1)""")
def a09(spark, d):
    from pyspark.sql import Window
    e = table(spark, d, "events").groupBy("event_type").agg(F.sum(F.when(F.col("value") > 50, 1).otherwise(0)).alias("active"), F.count("*").alias("total"))
    w = Window.orderBy(F.desc("active"), F.desc("total"), "event_type")  # one row per event type
    return e.withColumn("position", F.row_number().over(w))


@query("A10_reject_reasons", """SELECT missing, count(*) AS n FROM (SELECT doc_id, unnest(list_filter([CASE WHEN quality IS NULL THEN 'quality' END, CASE WHEN toxic IS NULL THEN 'toxic' END,
  CASE WHEN lang = 'en' THEN 'lang' END], lambda x: x IS NOT NULL)) AS missing FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY 1""")
def a10(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left")
    gone = M.missing_fields({"quality": F.col("quality"), "toxic": F.col("toxic"), "lang": F.when(F.col("lang") != "en", F.col("lang"))})
    return docs.select(F.explode(gone).alias("missing")).groupBy("missing").agg(cnt())


@query("A11_distinct_statements", f"SELECT source, count(DISTINCT {n('text')}) AS statements, count(DISTINCT {n('text')}) > 1 AS ambiguous FROM documents GROUP BY 1")
def a11(spark, d):
    docs = table(spark, d, "documents").select("source", F.sha2(T.norm("text"), 256).alias("statement")).distinct()
    return docs.groupBy("source").agg(F.count("*").alias("statements")).withColumn("ambiguous", F.col("statements") > 1)


COVER_SQL = """WITH c AS (SELECT p_partkey AS product_id, string_split(p_name, ' ') AS components FROM part),
r AS (SELECT DISTINCT l_partkey AS product_id, l_suppkey AS row_id,
  CASE l_suppkey % 4 WHEN 0 THEN [string_split(p_name, ' ')[1]] WHEN 1 THEN [string_split(p_name, ' ')[2]]
   WHEN 2 THEN [string_split(p_name, ' ')[1], 'salt'] ELSE CASE WHEN l_partkey % 3 = 0 THEN list_distinct(string_split(p_name, ' ') || ['x']) ELSE ['x'] END END AS ingredients
  FROM lineitem JOIN part ON l_partkey = p_partkey),
j AS (SELECT *, list_has_all(ingredients, components) AS strict, list_has_all(components, ingredients) AS clean FROM c JOIN r USING (product_id)),
s AS (SELECT product_id, bool_or(strict) AS any_strict FROM j GROUP BY 1),
v AS (SELECT product_id, count(DISTINCT i) AS n FROM (SELECT product_id, unnest(ingredients) AS i FROM j WHERE clean) GROUP BY 1),
m AS (SELECT j.*, CASE WHEN any_strict THEN 'STRICT_ALL_COMPONENTS' WHEN len(components) > 1 AND coalesce(n, 0) = len(components) THEN 'ALTERNATE_FORMULATION_COMPONENTS' ELSE 'NO_COMPATIBLE_ROW' END AS mode
  FROM j JOIN s USING (product_id) LEFT JOIN v USING (product_id))
SELECT product_id, row_id, mode, CASE mode WHEN 'STRICT_ALL_COMPONENTS' THEN strict WHEN 'ALTERNATE_FORMULATION_COMPONENTS' THEN clean ELSE false END AS accepted FROM m"""


@query("A12_ingredient_cover", COVER_SQL)
def a12(spark, d):
    p = table(spark, d, "part")
    words = F.split("p_name", " ")
    products = p.select(F.col("p_partkey").alias("product_id"), words.alias("components"))
    li = table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
    k = F.col("l_suppkey") % 4
    rows = li.join(p.select("p_partkey", "p_name"), li.l_partkey == p.p_partkey).select(
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("row_id"),
        F.when(k == 0, F.array(words[0])).when(k == 1, F.array(words[1])).when(k == 2, F.array(words[0], F.lit("salt")))
        .when(F.col("l_partkey") % 3 == 0, F.array_distinct(F.concat(words, F.array(F.lit("x"))))).otherwise(F.array(F.lit("x"))).alias("ingredients"))
    return M.ingredient_cover(products, rows)


@query("A13_attribute_drift", "SELECT p_brand, count(DISTINCT p_name) AS assets, 49::BIGINT AS published, count(DISTINCT p_name) - 49 AS drift FROM part GROUP BY 1")
def a13(spark, d):
    c = table(spark, d, "part").groupBy("p_brand").agg(F.count_distinct("p_name").alias("assets"))
    return c.select("p_brand", "assets", F.lit(49).cast("long").alias("published"), (F.col("assets") - 49).alias("drift"))


@query("A14_source_diagnostics", f"""SELECT source, count(*) AS raw_rows, count(*) FILTER (n_chars >= 200) AS parsed, count(*) FILTER (n_chars < 200) AS rejected,
  count(DISTINCT CASE WHEN n_chars >= 200 THEN {n('text')} END) AS deduped FROM documents GROUP BY 1""")
def a14(spark, d):
    docs = table(spark, d, "documents").select("source", (F.col("n_chars") >= 200).alias("ok"), F.sha2(T.norm("text"), 256).alias("h"))
    per = docs.groupBy("source", "ok", "h").agg(cnt())
    return per.groupBy("source").agg(F.sum("n").alias("raw_rows"), F.sum(F.when(F.col("ok"), F.col("n")).otherwise(0)).alias("parsed"),
                                     F.sum(F.when(~F.col("ok"), F.col("n")).otherwise(0)).alias("rejected"),
                                     F.sum(F.when(F.col("ok"), 1).otherwise(0)).alias("deduped"))


# ---- windows over events: chunked, so a hot user spans many tasks ------------------


def _events(spark, d, rows_per_chunk=250_000):
    return Ordered(table(spark, d, "events").drop("props"), ["user_id"], ["ts", "event_id"], rows_per_chunk)


@query("W02_newest_row", "SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, max(o_orderdate)::DATE::VARCHAR AS newest FROM orders GROUP BY 1")
def w02(spark, d):
    x = M.newest(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderdate"])
    return x.select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("newest"))


@query("W03_pool_choice", """WITH r AS (SELECT l_partkey, CASE WHEN l_tax > 0.06 THEN 3 ELSE 0 END AS s, l_shipdate::DATE::VARCHAR AS effective, l_orderkey * 10 + l_linenumber AS row_id, l_returnflag AS st FROM lineitem),
p AS (SELECT l_partkey, count(*) FILTER (s > 0) AS h FROM r GROUP BY 1),
q AS (SELECT r.* FROM r JOIN p USING (l_partkey) WHERE h = 0 OR s > 0)
SELECT l_partkey, arg_max(row_id, (effective, row_id)) AS row_id, max(effective) AS effective, count(*) AS pool_size, count(DISTINCT st) AS statements FROM q GROUP BY 1""")
def w03(spark, d):
    row_id = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    rows = table(spark, d, "lineitem").select(
        "l_partkey", F.when(F.col("l_tax") > 0.06, 3).otherwise(0).alias("sponsor_score"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("effective"),
        row_id.alias("row_id"), (-row_id).alias("ordinal"), F.col("l_returnflag").alias("statement"))
    return M.pool_choice(rows, ["l_partkey"], ["effective"], ["row_id", "effective"]).drop("sponsor_score")


@query("W04_ordinal_after_dedup", """WITH f AS (SELECT user_id, event_type, round_even(value, 0)::BIGINT AS v, min(event_id) AS event_id FROM events GROUP BY ALL)
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS ordinal FROM f""")
def w04(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", "value")
    kept = M.first_kept(e, [F.col("user_id"), F.col("event_type"), F.bround("value")], ["event_id"])
    return Ordered(kept, ["user_id"], ["event_id"]).ordinal("ordinal").frame().select("user_id", "event_id", "ordinal")


@query("W05_previous_next", """SELECT event_id, lag(event_type) OVER w AS before, lag(value) OVER w AS value_before FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def w05(spark, d):
    out = _events(spark, d).previous(F.struct("event_type", "value"), "p").frame()
    return out.select("event_id", F.col("p.event_type").alias("before"), F.col("p.value").alias("value_before"))


@query("W06_islands", """WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) <= 3600000000 AND event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS fresh
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM g)
SELECT user_id, island::BIGINT AS island, count(*) AS n, min(event_id) AS first_event FROM s GROUP BY 1, 2""")
def w06(spark, d):
    e = _events(spark, d).previous(F.struct("ts", "event_type"), "p")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    gap = micros("ts") - micros("p.ts")
    same = (gap <= 3_600_000_000) & (F.col("event_type") == F.col("p.event_type"))
    out = e.islands(~F.coalesce(same, F.lit(False)), "island").frame()
    return out.groupBy("user_id", "island").agg(cnt(), F.min("event_id").alias("first_event"))


@query("W07_carry_forward", """SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS heading FROM events""")
def w07(spark, d):
    out = _events(spark, d).carry_forward(F.when(F.col("event_type") == "signup", F.col("value")), "heading").frame()
    return out.select("event_id", "heading")


# ---- order, limits, sets -------------------------------------------------------------


@query("T01_programme_order", f"""WITH {B.PROGRAM_SQL} SELECT source_record_id, row_number() OVER (ORDER BY {n('asset')}, {n('indication')}, source_record_id) AS position FROM program_v""")
def t01(spark, d):
    p = B.programs(spark, d).select("source_record_id", T.norm("asset").alias("a"), T.norm("indication").alias("i"))
    return Ordered(p, [], ["a", "i", "source_record_id"]).ordinal("position").frame().select("source_record_id", "position")


@query("T02_newest_n", """SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, position::INT AS position FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
  ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_suppkey, l_quantity) AS position FROM lineitem) WHERE position <= 12""")
def t02(spark, d):
    li = table(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity")
    top = M.top_n(li, ["l_partkey"], [F.desc("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_quantity")], 12)
    return top.select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "position")


@query("T03_first_samples", "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r <= 20")
def t03(spark, d):
    return M.top_n(table(spark, d, "documents").select("source", "doc_id"), ["source"], [F.col("doc_id")], 20).select("source", "doc_id")


@query("T04_candidate_caps", """SELECT doc_id, array_to_string(list_sort(list_distinct(string_split_regex(trim(text), '\\s+')))[1:5], '|') AS capped FROM documents""")
def t04(spark, d):
    words = F.split(F.trim("text"), r"\s+")
    return table(spark, d, "documents").select("doc_id", F.array_join(F.slice(F.array_sort(F.array_distinct(words)), 1, 5), "|").alias("capped"))


@query("U01_first_kept", f"SELECT {n('text')} AS key, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def u01(spark, d):
    docs = table(spark, d, "documents").select("doc_id", T.norm("text").alias("key"))
    return M.first_kept(docs, [F.col("key")], ["doc_id"]).select("key", "doc_id")


@query("U02_set_algebra", """WITH x AS (SELECT p_partkey, string_split(p_name, ' ') AS a, [lower(p_type), 'red', 'small'] AS b FROM part)
SELECT p_partkey, array_to_string(list_sort(list_distinct(a || b)), ' ') AS either, array_to_string(list_sort(list_distinct(list_filter(a, lambda v: list_contains(b, v)))), ' ') AS common,
  array_to_string(list_sort(list_distinct(list_filter(a, lambda v: NOT list_contains(b, v)))), ' ') AS only_a, list_has_any(a, b) AS overlaps FROM x""")
def u02(spark, d):
    a, b = F.split("p_name", " "), F.array(F.lower("p_type"), F.lit("red"), F.lit("small"))
    j = lambda c: F.array_join(F.array_sort(c), " ")
    return table(spark, d, "part").select("p_partkey", j(F.array_union(a, b)).alias("either"), j(F.array_intersect(a, b)).alias("common"),
                                          j(F.array_except(a, b)).alias("only_a"), F.arrays_overlap(a, b).alias("overlaps"))


@query("U04_in_scope", f"WITH {B.PROGRAM_SQL} SELECT source_record_id FROM program_v WHERE phase IN ('Phase III', 'Phase 2b/3') AND program_status <> 'Completed'")
def u04(spark, d):
    p = B.programs(spark, d)
    return p.filter(F.col("phase").isin("Phase III", "Phase 2b/3") & (F.col("program_status") != "Completed")).select("source_record_id")


@query("S06_payload_union", """SELECT 'owned' AS family, s_name AS name, s_nationkey AS nation, NULL::VARCHAR AS segment FROM supplier
UNION ALL SELECT 'partnered', c_name, c_nationkey, c_mktsegment FROM customer""")
def s06(spark, d):
    s = table(spark, d, "supplier").select(F.lit("owned").alias("family"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    c = table(spark, d, "customer").select(F.lit("partnered").alias("family"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    return s.unionByName(c, allowMissingColumns=True)


@query("K02_result_page", """WITH t AS (SELECT count(*) AS total_rows FROM orders) SELECT o_orderkey, total_rows, CASE WHEN 75 < total_rows THEN 75 END::BIGINT AS next_offset
FROM (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey OFFSET 25 LIMIT 50), t""")
def k02(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", (-F.col("o_totalprice")).alias("p"))
    return S.page(o, ["p", "o_orderkey"], 25, 60).drop("p")


@query("K03_extraction_envelope", """SELECT source, count(*) AS n_rows, count(*) FILTER (n_chars < 200) AS rejected, CASE WHEN count(*) FILTER (n_chars < 200) > greatest(3, floor(count(*) * 0.1)) THEN 'issue' ELSE 'pass' END AS severity
FROM documents GROUP BY 1""")
def k03(spark, d):
    x = table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n_rows"), F.sum(F.when(F.col("n_chars") < 200, 1).otherwise(0)).alias("rejected"))
    return x.withColumn("severity", F.when(Q.reject_rate(F.col("rejected"), F.col("n_rows"), "a"), "issue").otherwise("pass"))


# ---- gates -------------------------------------------------------------------------------


@query("Q01_core_fields", """SELECT lang, 'core_fields' AS gate, 'issue' AS severity, count(*) AS n, array_to_string(list_sort(list(doc_id))[1:20], ',') AS sample
FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL GROUP BY 1""")
def q01(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left")
    out = Q.completeness(docs, "lang", M.missing_fields({"quality": F.col("quality")}), "doc_id")
    return out.withColumn("sample", F.array_join(F.col("sample").cast("array<string>"), ","))


@query("Q02_controlled_values", "SELECT p_brand, p_type, count(*) AS n FROM part WHERE p_type NOT IN ('ECONOMY', 'SMALL', 'PROMO') GROUP BY 1, 2")
def q02(spark, d):
    allowed = spark.createDataFrame([("ECONOMY",), ("SMALL",), ("PROMO",)], "v string")
    return Q.unknown_values(table(spark, d, "part"), "p_brand", "p_type", allowed)


@query("Q03_row_bounds", """SELECT c.source, coalesce(n, 0) AS n, lo AS min_rows, hi AS max_rows, coalesce(n, 0) BETWEEN lo AND hi AS ok
FROM (VALUES ('en', 40, 200), ('de', 20, 150), ('fr', 50, 180), ('it', 4, 20)) c(source, lo, hi) LEFT JOIN (SELECT lang AS source, count(*) AS n FROM documents GROUP BY 1) x ON c.source = x.source""")
def q03(spark, d):
    config = spark.createDataFrame([("en", 40, 200), ("de", 20, 150), ("fr", 50, 180), ("it", 4, 20)], "source string, min_rows int, max_rows int")
    return Q.row_bounds(table(spark, d, "documents").groupBy(F.col("lang").alias("source")).agg(cnt()), config)


@query("Q04_empty_slots", """SELECT b.p_brand, s.p_type FROM (SELECT DISTINCT p_brand FROM part) b CROSS JOIN (SELECT unnest(['ECONOMY', 'SMALL', 'LARGE', 'NONE']) AS p_type) s
WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_brand = b.p_brand AND p.p_type = s.p_type)""")
def q04(spark, d):
    return Q.empty_slots(table(spark, d, "part"), "p_brand", "p_type", ["ECONOMY", "SMALL", "LARGE", "NONE"])


@query("Q05_duplicate_coordinates", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def q05(spark, d):
    return Q.duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("Q06_reject_rates", """SELECT l_suppkey, r > greatest(3, floor(t * 0.1)) AS a, r > greatest(3, floor(t * 0.15)) AS b, r > greatest(3, floor(t * 0.2)) AS c, r > greatest(5, floor(t * 0.25)) AS d, r > 0 AS e
FROM (SELECT l_suppkey, count(*) AS t, count(*) FILTER (l_discount > 0.08) AS r FROM lineitem GROUP BY 1)""")
def q06(spark, d):
    x = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("t"), F.sum(F.when(F.col("l_discount") > 0.08, 1).otherwise(0)).alias("r"))
    return x.select("l_suppkey", *[Q.reject_rate(F.col("r"), F.col("t"), k).alias(k) for k in "abcde"])


@query("Q07_baseline_drift", """SELECT coalesce(a.p_size, b.p_size) AS p_size, coalesce(a.n, 0) AS actual, coalesce(b.n, 0) AS expected, 'warning' AS severity
FROM (SELECT p_size + p_partkey % 2 AS p_size, count(*) AS n FROM part GROUP BY 1) a FULL JOIN (SELECT p_size::BIGINT AS p_size, count(*) AS n FROM part GROUP BY 1) b USING (p_size)
WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def q07(spark, d):
    p = table(spark, d, "part")
    a = p.groupBy((F.col("p_size") + F.col("p_partkey") % 2).alias("p_size")).agg(cnt())
    return Q.baseline_drift(a, p.groupBy(F.col("p_size").cast("long").alias("p_size")).agg(cnt()), ["p_size"])


@query("Q08_source_accounting", """SELECT o_orderkey, (o_orderkey % 7)::BIGINT AS declared, coalesce(parsed, 0) AS parsed, coalesce(rejected, 0) AS rejected, o_orderkey % 7 = coalesce(parsed, 0) + coalesce(rejected, 0) AS balanced
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) FILTER (l_returnflag <> 'N') AS parsed, count(*) FILTER (l_returnflag = 'N') AS rejected FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def q08(spark, d):
    declared = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 7).alias("declared"))
    parsed = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.when(F.col("l_returnflag") != "N", 1).otherwise(0)).alias("parsed"), F.sum(F.when(F.col("l_returnflag") == "N", 1).otherwise(0)).alias("rejected"))
    return Q.accounting(declared, parsed, ["o_orderkey"])


@query("Q09_layout_gate", """SELECT user_id, rf AS row_failures, bw AS boundary_warnings, cw AS coverage_warnings, CASE WHEN rf > 0 THEN 'issue' WHEN bw + cw > 0 THEN 'warning' ELSE 'pass' END AS severity
FROM (SELECT user_id, count(*) FILTER (event_type = 'error' AND value > 60) AS rf, count(*) FILTER (event_type = 'click') AS bw, count(*) FILTER (event_type = 'view') AS cw FROM events GROUP BY 1)""")
def q09(spark, d):
    one = lambda c: F.when(c, 1).otherwise(0).cast("long")
    t = F.col("event_type")
    e = table(spark, d, "events").select("user_id", one((t == "error") & (F.col("value") > 60)).alias("row_failures"),
                                         one(t == "click").alias("boundary_warnings"), one(t == "view").alias("coverage_warnings"))
    return Q.layout_gate(e, ["user_id"])


@query("Q10_named_checks", "SELECT l_suppkey, bool_and(l_quantity >= 1) AS quantity, bool_and(l_discount < 0.1) AS discount, bool_and(l_tax <= 0.08) AS tax, bool_and(l_quantity >= 1) AND bool_and(l_discount < 0.1) AND bool_and(l_tax <= 0.08) AS ok FROM lineitem GROUP BY 1")
def q10(spark, d):
    return Q.named_checks(table(spark, d, "lineitem"), ["l_suppkey"], {"quantity": F.col("l_quantity") >= 1, "discount": F.col("l_discount") < 0.1, "tax": F.col("l_tax") <= 0.08})


@query("Q11_publishable", """SELECT lang, count(*) AS n FROM documents WHERE lang NOT IN (SELECT lang FROM documents GROUP BY 1 HAVING count(*) FILTER (n_chars < 200) > greatest(3, floor(count(*) * 0.1))) GROUP BY 1""")
def q11(spark, d):
    docs = table(spark, d, "documents")
    g = docs.groupBy("lang").agg(F.count("*").alias("t"), F.sum(F.when(F.col("n_chars") < 200, 1).otherwise(0)).alias("r"))
    g = g.withColumn("severity", F.when(Q.reject_rate(F.col("r"), F.col("t"), "a"), "issue").otherwise("pass"))
    return Q.publishable(docs.select("lang", "doc_id"), g, "lang").groupBy("lang").agg(cnt())


@query("Q12_pagination", """SELECT conv_id, count(*) AS pages, bool_or(role = 'assistant' AND turn + 1 >= 5) AS truncated FROM conversations GROUP BY 1""")
def q12(spark, d):
    c = table(spark, d, "conversations").select("conv_id", (F.col("turn") + 1).alias("page_no"), F.when(F.col("role") == "assistant", "next").alias("next_token"))
    return Q.pagination(c, ["conv_id"], 5)


@query("Q13_single_page", """SELECT source, count(*) FILTER (regexp_matches(lower(text), '\\bwith of\\b')) AS matches, count(*) FILTER (regexp_matches(lower(text), '\\bwith of\\b')) = 1 AS ok FROM documents GROUP BY 1""")
def q13(spark, d):
    return Q.single_page(table(spark, d, "documents"), "source", F.lower("text").rlike(r"\bwith of\b"))


# ---- review queue -----------------------------------------------------------------------

MERGE_SQL = """WITH e AS (SELECT p_partkey AS id, ['Needs Review', 'Reviewed - Exclude', 'Resolved', 'Needs Review'][1 + p_partkey % 4] AS review_status,
   CASE WHEN p_partkey % 8 = 0 THEN 'POSSIBLE DUPLICATE' WHEN p_partkey % 4 IN (1, 2) THEN 'EXCLUDED BY RULE' ELSE 'NEW ASSET' END AS classification,
   CASE WHEN p_partkey % 4 IN (1, 2) THEN 'Exclude' ELSE 'Review' END AS decision, p_brand AS source_scope, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name END AS reason
   FROM part WHERE p_partkey % 5 <> 0),
i AS (SELECT p_partkey AS id, 'NEW INDICATION' AS classification, 'Include' AS decision, p_type AS source_scope, 'machine ' || p_type AS reason, p_name AS evidence FROM part WHERE p_partkey % 7 <> 0)
SELECT coalesce(e.id, i.id) AS id, CASE WHEN e.id IS NULL THEN 'inserted' WHEN i.id IS NULL THEN 'kept' ELSE 'updated' END AS action, coalesce(review_status, 'New') AS review_status,
  CASE WHEN e.decision = 'Exclude' THEN 'EXCLUDED BY RULE' WHEN e.classification = 'POSSIBLE DUPLICATE' THEN e.classification ELSE coalesce(i.classification, e.classification) END AS classification,
  CASE WHEN e.decision = 'Exclude' THEN 'Exclude' WHEN e.classification = 'POSSIBLE DUPLICATE' THEN e.decision ELSE coalesce(i.decision, e.decision) END AS decision,
  coalesce(e.source_scope, i.source_scope) AS source_scope, coalesce(nullif(e.reason, ''), i.reason) AS reason, i.evidence AS latest_evidence
FROM e FULL JOIN i ON e.id = i.id"""


@query("M01_review_queue_merge", MERGE_SQL)
def m01(spark, d):
    p, k = table(spark, d, "part"), F.col("p_partkey")
    blank = F.lit(None).cast("string")
    e = p.filter(k % 5 != 0).select(
        k.alias("id"), F.when(k % 4 == 1, "Reviewed - Exclude").when(k % 4 == 2, "Resolved").otherwise("Needs Review").alias("review_status"),
        F.when(k % 8 == 0, "POSSIBLE DUPLICATE").when((k % 4).isin(1, 2), "EXCLUDED BY RULE").otherwise("NEW ASSET").alias("classification"),
        F.when((k % 4).isin(1, 2), "Exclude").otherwise("Review").alias("decision"), blank.alias("programme_gate"), F.col("p_brand").alias("source_scope"),
        F.when(k % 3 == 0, "").otherwise(F.col("p_name")).alias("reason"), blank.alias("evidence"))
    i = p.filter(k % 7 != 0).select(k.alias("id"), F.lit("NEW INDICATION").alias("classification"), F.lit("Include").alias("decision"), blank.alias("programme_gate"),
                                    F.col("p_type").alias("source_scope"), F.concat(F.lit("machine "), "p_type").alias("reason"), F.col("p_name").alias("evidence"))
    out = S.merge_review_queue(e, i)
    return out.select("id", "action", "review_status", "classification", "decision", "source_scope", "reason", "latest_evidence")
