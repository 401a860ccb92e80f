"""Domain views over the benchmark tables, as Spark DataFrames and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import by_document, table


def portfolio(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(
        F.concat(F.lit("P"), F.col("p_partkey")).alias("record_id"),
        F.col("p_partkey").alias("portfolio_ordinal"),
        F.lit(None).cast("string").alias("company"),
        F.col("p_name").alias("asset"),
        F.lit(None).cast("string").alias("molecule"),
        F.concat(F.lit("PT-"), F.lpad(F.col("p_partkey").cast("string"), 6, "0")).alias("development_code"),
        F.col("p_brand").alias("brand"),
        F.concat_ws(" ", "p_type", "p_name").alias("indication"),
        F.col("p_type").alias("controlled_indication"),
        F.concat(F.lit("Phase "), 1 + F.col("p_size") % 3).alias("phase"))


PORTFOLIO_SQL = """portfolio_v AS (
  SELECT 'P' || p_partkey AS record_id, p_partkey AS portfolio_ordinal, p_name AS asset,
         'PT-' || lpad(p_partkey::VARCHAR, 6, '0') AS development_code, p_brand AS brand,
         p_type || ' ' || p_name AS indication, p_type AS controlled_indication,
         'Phase ' || (1 + p_size % 3) AS phase
  FROM part)"""


def programs(spark, d) -> DataFrame:
    """One row per distinct programme; line items shrink to part x flags before the join.

    The flags choose phase and status, and make some assets and some indications new.
    """
    flags = table(spark, d, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus").distinct()
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    new_asset = F.when((flag == "R") & (status == "O"), " x").otherwise("")
    return flags.join(p, flags.l_partkey == p.p_partkey).select(
        F.lit("Acme").alias("target"), F.lit("Acme").alias("company"), F.lit("Bench").alias("source_family"),
        F.concat("p_name", new_asset).alias("asset"), F.concat("p_brand", new_asset).alias("brand"),
        F.when((flag == "A") & (status == "O"), F.concat(F.lit("novel "), F.col("p_brand")))
        .otherwise(F.concat_ws(" ", "p_type", "p_name")).alias("indication"), F.col("p_type").alias("area"),
        F.when(flag == "N", "Phase 1").when(flag == "A", "Phase III").when(status == "F", "Phase I/II")
        .otherwise("Phase 2b/3").alias("phase"),
        F.when(status == "F", "Completed").otherwise("Active").alias("program_status")).distinct().withColumn(
        "source_record_id", F.concat_ws("|", "asset", "brand", "indication", "area", "phase", "program_status"))


PROGRAM_SQL = """program_v AS (
  SELECT DISTINCT asset || '|' || brand || '|' || indication || '|' || area || '|' || phase || '|' || program_status AS source_record_id,
         asset, brand, indication, area, phase, program_status
  FROM (SELECT p_name || x AS asset, p_brand || x AS brand, p_type AS area,
               CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'novel ' || p_brand ELSE p_type || ' ' || p_name END AS indication,
               CASE l_returnflag WHEN 'N' THEN 'Phase 1' WHEN 'A' THEN 'Phase III'
                    ELSE CASE l_linestatus WHEN 'F' THEN 'Phase I/II' ELSE 'Phase 2b/3' END END AS phase,
               CASE l_linestatus WHEN 'F' THEN 'Completed' ELSE 'Active' END AS program_status
        FROM (SELECT *, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN ' x' ELSE '' END AS x
              FROM lineitem JOIN part ON l_partkey = p_partkey)))"""


def aliases(spark) -> DataFrame:
    return spark.createDataFrame([("Acme", "Acme Inc")], "target string, alias string")


def catalog(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(F.concat(F.lit("P"), F.col("p_partkey")).alias("product_id"),
                    F.col("p_brand").alias("company"), F.col("p_name").alias("name"),
                    F.col("p_type").alias("molecule"))


def layout_words(spark, d) -> DataFrame:
    """Words of each document laid out twenty to a line; one page per document."""
    docs = table(spark, d, "documents")
    return (by_document(docs.select("doc_id", "text")).select("doc_id", F.posexplode(F.split("text", " ")).alias("pos", "text"))
            .select("doc_id", F.lit(1).alias("page_no"), "pos", "text",
                    (40.0 + 30.0 * (F.col("pos") % 20)).alias("x0"),
                    (20.0 + 12.0 * F.floor(F.col("pos") / 20)).alias("y0"))
            .withColumn("x1", F.col("x0") + 6.0 * F.length("text"))
            .withColumn("y1", F.col("y0") + 10.0))


LAYOUT_SQL = """layout_word_v AS (
  SELECT doc_id, 1 AS page_no, pos, text, 40.0 + 30.0 * (pos % 20) AS x0,
         20.0 + 12.0 * (pos // 20) AS y0,
         40.0 + 30.0 * (pos % 20) + 6.0 * length(text) AS x1, 30.0 + 12.0 * (pos // 20) AS y1
  FROM (SELECT doc_id, unnest(w) AS text, generate_subscripts(w, 1) - 1 AS pos
        FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)))"""


def norm_sql(x: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]+', ' ', 'g'))"


def clean_sql(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '\\s+', ' ', 'g'))"


def phase_table_words(spark, d) -> DataFrame:
    """Words of documents printed as pages of a five-column table, 800 words a page and 40 a row on two lines.

    The second line has no phase cell, and no asset words in some rows. Some assets end in a footnote number or begin with a mark, the digit of a
    phase stands two points low, 'New' stands left of its column, some rows lack a submission type, and every
    fourth page lists discontinued programmes.
    """
    docs = table(spark, d, "documents")
    dealt = by_document(docs.select("doc_id", "text"))
    w = dealt.select("doc_id", F.posexplode(F.split("text", " ")).alias("i", "word"))
    i = F.col("i")
    row, line, slot, page = F.floor(i % 800 / 40), F.floor(i % 40 / 20), i % 20, F.floor(i / 800).cast("int")
    kind = (F.col("doc_id") + F.floor(i / 40)) % 5
    first = (F.when((slot == 4) & (kind == 1), "2").when((slot == 4) & (kind == 2), "PF-07220060").when((slot == 4) & (kind == 3), "12")
             .when((slot == 0) & (kind == 4), "▶ Dekavil2")
             .when(slot == 15, F.when(kind == 0, "Registration").otherwise("Phase"))
             .when(slot == 16, F.when(kind == 0, "").otherwise((1 + kind % 3).cast("string")))
             .when(slot == 17, F.when(kind == 3, "Other").when(kind == 1, "Product").otherwise("New"))
             .when(slot == 18, F.when(kind == 1, "Enhancement").otherwise("Molecular")).when(slot == 19, F.when(kind == 1, "").otherwise("Entity"))
             .otherwise(F.col("word")))
    cells = w.filter((line == 0) | ((slot < 15) & ((kind != 1) | (slot > 4)))).select(
        "doc_id", page.alias("page_no"), (i % 800 + 20).cast("int").alias("pos"), F.when(line == 0, first).otherwise(F.col("word")).alias("text"),
        (40.0 + 30.0 * slot - F.when((line == 0) & (slot == 17), 6.0).otherwise(0.0)).alias("x0"),
        (40.0 + 24.0 * row + 8.0 * line + F.when((line == 0) & (slot == 16), 2.0).otherwise(0.0)).alias("y0"))
    word = lambda n, t, x, y: F.struct(F.lit(n).alias("pos"), (t if not isinstance(t, str) else F.lit(t)).alias("text"),
                                       F.lit(float(x)).alias("x0"), F.lit(float(y)).alias("y0"))
    title = F.element_at(F.array(*map(F.lit, ("Oncology", "Internal Medicine", "Vaccines", "Programs Discontinued Since Last Update"))), F.col("page_no") % 4 + 1)
    printed = F.array(word(0, title, 40, 2), word(1, "Compound", 40, 20), word(2, "Name", 90, 20), word(3, "Mechanism", 190, 20), word(4, "Indication", 340, 20),
                      word(5, "Phase", 490, 20), word(6, "Submission", 550, 20), word(7, "Type", 600, 20),
                      word(900, "Indicates", 40, 540), word(901, "Phase", 490, 545), word(902, "2", 520, 545))
    last = F.floor((F.size(F.split("text", " ")) - 1) / 800).cast("int")
    pages = dealt.filter("text is not null").select("doc_id", F.explode(F.sequence(F.lit(0), last)).alias("page_no")).distinct()
    frame = pages.select("doc_id", "page_no", F.explode(printed).alias("p")).select("doc_id", "page_no", "p.*")
    return cells.unionByName(frame).withColumns({"x1": F.col("x0") + 28, "y1": F.col("y0") + 10, "height": F.lit(600.0)})


PHASE_TABLE_SQL = """tw AS (
  SELECT doc_id, i // 800 AS page_no, i % 800 // 40 AS band0, i % 40 // 20 AS line, i % 20 AS slot, (doc_id + i // 40) % 5 AS kind, i, word
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents))),
tc AS (SELECT * FROM tw WHERE page_no % 4 < 3),
tr AS (SELECT doc_id, page_no, band0, any_value(kind) AS kind, max(slot) FILTER (line = 0) AS last_slot,
  string_agg(CASE WHEN line = 0 AND slot = 4 AND kind = 1 THEN '2' WHEN line = 0 AND slot = 4 AND kind = 2 THEN 'PF-07220060' WHEN line = 0 AND slot = 4 AND kind = 3 THEN '12'
                  WHEN line = 0 AND slot = 0 AND kind = 4 THEN '▶ Dekavil2' ELSE word END, ' ' ORDER BY i) FILTER (slot < 5 AND (line = 0 OR kind <> 1)) AS compound,
  string_agg(word, ' ' ORDER BY i) FILTER (slot BETWEEN 5 AND 9) AS mechanism, string_agg(word, ' ' ORDER BY i) FILTER (slot BETWEEN 10 AND 14) AS indication
  FROM tc GROUP BY 1, 2, 3)"""
