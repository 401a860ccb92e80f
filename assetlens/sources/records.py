"""Semi-structured sources: JSON payloads, nested registry and regulatory rows, XML, CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import identity as I
from ..functions import phase as P
from ..functions import rules as R
from ..functions.text import brand_norm, clean, let, norm, norm_key, squeeze, strip_html, text_or_blank, unescape

TRIAL_SCHEMA = """protocolSection struct<
  identificationModule struct<nctId string, briefTitle string, officialTitle string>,
  statusModule struct<overallStatus string>, designModule struct<phases array<string>>,
  conditionsModule struct<conditions array<string>>,
  sponsorCollaboratorsModule struct<leadSponsor struct<name string>>,
  armsInterventionsModule struct<armGroups array<struct<type string, interventionNames array<string>>>,
    interventions array<struct<type string, name string, description string, otherNames array<string>>>>>"""
APPLICATION_SCHEMA = """application_number string, sponsor_name string,
  products array<struct<brand_name string, dosage_form string, marketing_status string, active_ingredients array<struct<name string>>>>,
  openfda struct<product_type array<string>>"""
LABEL_SCHEMA = """id string, effective_time string, indications_and_usage array<string>,
  openfda struct<brand_name array<string>, generic_name array<string>, substance_name array<string>, manufacturer_name array<string>,
    application_number array<string>, product_type array<string>, route array<string>, spl_set_id array<string>>"""


def read_trials(spark, path: str) -> DataFrame:
    return spark.read.schema(TRIAL_SCHEMA).json(path)


def read_applications(spark, path: str) -> DataFrame:
    return spark.read.schema(APPLICATION_SCHEMA).json(path)


def read_labels(spark, path: str) -> DataFrame:
    return spark.read.schema(LABEL_SCHEMA).json(path)


# ---- semantic JSON ------------------------------------------------------------


def _objects(payload: Column, path: str) -> Column:
    text = payload if path == "$" else F.get_json_object(payload, path)
    arr = F.from_json(text, "array<string>")
    objects = F.filter(arr, lambda v: v.startswith("{"))
    if path == "$":  # a root list keeps its objects
        return F.when(F.ltrim(payload).startswith("["), objects)
    return F.when((F.size(arr) > 0) & (F.size(objects) == F.size(arr)), arr)


def record_list(df: DataFrame, payload: str) -> DataFrame:
    """Adds ``records`` (JSON objects as text) and ``record_path``: the root list, or the
    first non-empty all-object list under the known container names."""
    options = [("ROOT_LIST", "$")]
    for k in R.JSON_CONTAINERS:
        options.append((k, f"$.{k}"))
        options += [(f"{k}.{n}", f"$.{k}.{n}") for n in R.JSON_NESTED]
    found = F.lit(None).cast("struct<path:string,records:array<string>>")
    for name, path in reversed(options):
        records = _objects(F.col(payload), path)
        found = F.when(records.isNotNull(), F.struct(F.lit(name).alias("path"), records.alias("records"))).otherwise(found)
    d = df.withColumn("_f", found)
    return d.withColumn("record_path", F.coalesce("_f.path", F.lit("NOT_FOUND"))).withColumn("records", F.col("_f.records")).drop("_f")


def semantic_records(df: DataFrame, doc: str, payload: str) -> DataFrame:
    """One row per record: fields by key synonym, then by a column label the payload declares."""
    d = record_list(df, payload)
    columns = F.from_json(F.get_json_object(payload, "$.columns"),
                          "array<struct<values string, value string, key string, label string, name string, title string>>")
    aliases = F.map_from_entries(F.transform(
        F.filter(F.coalesce(columns, F.array().cast(
            "array<struct<values string, value string, key string, label string, name string, title string>>")),
            lambda c: F.coalesce(c["values"], c["value"], c["key"]).isNotNull() & F.coalesce(c["label"], c["name"], c["title"]).isNotNull()),
        lambda c: F.struct(norm_key(F.coalesce(c["label"], c["name"], c["title"])), norm_key(F.coalesce(c["values"], c["value"], c["key"])))))
    d = d.withColumn("_a", aliases)
    d = d.select(doc, "record_path", "_a", F.posexplode_outer("records").alias("ordinal", "record")).filter("ordinal is not null")
    entries = F.map_entries(F.from_json("record", "map<string,string>"))
    d = d.withColumn("_m", F.map_from_entries(F.transform(entries, lambda e: F.struct(norm_key(e["key"]), e["value"]))))

    def field(names):
        direct = [F.col("_m")[n] for n in names]
        labelled = [F.col("_m")[F.col("_a")[n]] for n in names]
        return F.coalesce(*direct, *labelled, F.lit(""))
    raw = {k: field(v) for k, v in R.JSON_FIELDS.items()}
    return d.select(doc, "record_path", "ordinal", *[
        (I.partners_of(v) if k == "partners" else P.record(v) if k == "phase" else strip_html(v)).alias(k) for k, v in raw.items()])


def nested_pages(df: DataFrame, payload: str) -> DataFrame:
    """Molecule -> pages -> indications with ordinal ids; an empty list keeps one blank row."""
    shape = ("array<struct<Name struct<HtmlString string>, Code struct<HtmlString string>, Pages array<struct<"
             "Phase struct<HtmlString string>, Indications array<struct<HtmlString string>>>>>>")
    d = df.select("*", F.posexplode(F.from_json(payload, shape)).alias("m", "molecule"))
    d = d.select("*", F.posexplode("molecule.Pages").alias("p", "page_item"))
    d = d.select("*", F.posexplode_outer("page_item.Indications").alias("i", "ind"))
    return d.select(*df.columns, F.concat_ws(":", "m", "p", F.coalesce("i", F.lit(0))).alias("record_id"),
                    strip_html(F.col("molecule.Name.HtmlString")).alias("molecule_name"),
                    F.col("molecule.Code.HtmlString").alias("molecule_code"),
                    strip_html(F.col("ind.HtmlString")).alias("indication"), P.exact(F.col("page_item.Phase.HtmlString")).alias("phase"))


def content_tree(df: DataFrame, payload: str) -> DataFrame:
    """Therapeutic area -> candidate -> indication with the first metadata object of each."""
    meta = "metaDataRef array<struct<title string>>"
    shape = (f"struct<therapeuticAreaRef array<struct<name string, productCandidateRef array<struct<name string, {meta}, "
             "indicationRef array<struct<name string, phase string, phaseStage string>>>>>>>")
    d = df.select("*", F.from_json(payload, shape).alias("t"))
    d = d.select("*", F.explode("t.therapeuticAreaRef").alias("area"))
    d = d.select("*", F.explode("area.productCandidateRef").alias("cand"))
    d = d.select("*", F.explode("cand.indicationRef").alias("ind"))
    return d.select(*df.columns, F.col("area.name").alias("area"), F.col("cand.name").alias("asset"),
                    F.get(F.col("cand.metaDataRef"), F.lit(0))["title"].alias("meta_title"), F.col("ind.name").alias("indication"),
                    P.stage_code(F.col("ind.phase"), F.col("ind.phaseStage")).alias("phase"))


def script_literal(script: Column, name: str) -> Column:
    """JSON list assigned to ``name`` in a script, as text."""
    return F.nullif(F.regexp_extract(script, rf"(?is)\b{name}\s*=\s*(\[.*\])\s*;?\s*$", 1), F.lit(""))


def embedded_config(html: Column, required: list[str]) -> Column:
    """First JSON script element that carries every required key."""
    bodies = F.transform(F.regexp_extract_all(html, F.lit(
        r"(?i)<script[^>]+type=[\"']application/json[\"'][^>]*>([\s\S]*?)</script>"), 1), lambda b: F.trim(unescape(b)))

    def has_all(b):
        ok = F.lit(True)
        for k in required:
            ok = ok & F.get_json_object(b, f"$.{k}").isNotNull()
        return ok
    return F.get(F.filter(bodies, has_all), F.lit(0))


def class_text(raw: Column, name: str) -> Column:
    return strip_html(F.regexp_extract(raw, rf"(?i)class=[\"'][^\"']*\b{name}\b[^\"']*[\"'][^>]*>([\s\S]*?)</(?:div|span|p|h[1-6])>", 1))


# ---- XML and CSV --------------------------------------------------------------------


def spl_indications(xml: Column) -> Column:
    """Text of the indications section (LOINC 34067-9): its own text, else that of its
    subsections."""
    section = "//*[local-name()='section'][*[local-name()='code'][@code='34067-9']]"
    own = F.call_function("xpath", xml, F.lit(f"{section}/*[local-name()='text']//text()"))
    deep = F.call_function("xpath", xml, F.lit(f"{section}//*[local-name()='text']//text()"))
    title = F.call_function("xpath", xml, F.lit(f"{section}/*[local-name()='title']//text()"))
    join = lambda a: squeeze(F.array_join(F.transform(a, lambda v: F.trim(v)), " "))
    return squeeze(F.concat_ws(" ", join(title), let(join(own), lambda o: F.when(o != "", o).otherwise(join(deep)))))


def spl_ingredients(xml: Column) -> Column:
    names = F.call_function("xpath", xml, F.lit(
        "//*[local-name()='ingredient'][starts-with(@classCode,'ACTI')]//*[local-name()='name']/text()"))
    return F.array_sort(F.array_distinct(F.transform(names, lambda v: squeeze(v))))


def spl_applications(xml: Column) -> Column:
    found = F.regexp_extract_all(F.upper(xml), F.lit(r"\b((?:NDA|ANDA|BLA)\s*\d{5,6})\b"), 1)
    return F.array_sort(F.array_distinct(F.transform(found, lambda v: F.regexp_replace(v, r"\s+", ""))))


def csv_below_header(lines: DataFrame, doc: str, keywords: list[str], columns: list[str], search: int = 100) -> DataFrame:
    """Rows of a CSV whose header line (all keywords present) follows a preamble; blank
    values become NULL. ``columns`` name the positions of the rows."""
    low = F.lower("line")
    is_head = F.col("line_no") < search
    for k in keywords:
        is_head = is_head & low.contains(k)
    head = lines.filter(is_head).groupBy(doc).agg(F.min("line_no").alias("_h"))
    body = lines.join(head, doc).filter((F.col("line_no") > F.col("_h")) & (F.trim("line") != ""))
    schema = ", ".join(f"`{c}` string" for c in columns)
    return body.select(doc, "line_no", F.from_csv("line", F.lit(schema)).alias("r")).select(
        doc, "line_no", *[F.nullif(F.trim(F.col(f"r.{c}")), F.lit("")).alias(c) for c in columns])


def by_header_synonym(df: DataFrame, names: list[str]) -> Column:
    """First non-blank column whose normalised name is one of ``names``."""
    canonical = lambda x: " ".join("".join(ch if ch.isalnum() else " " for ch in x.lower()).split())
    wanted = [c for n in names for c in df.columns if canonical(c) == canonical(n)]
    return F.coalesce(*[F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")) for c in wanted]) if wanted else F.lit(None).cast("string")


# ---- trials and applications ---------------------------------------------------------------


def sponsor_matches(company, sponsor) -> Column:
    """Equal company roots, or one a word-prefix of the other."""
    from ..functions.text import company_root
    c, s = company_root(company), company_root(sponsor)
    return (c != "") & (s != "") & ((c == s) | c.startswith(F.concat(s, F.lit(" "))) | s.startswith(F.concat(c, F.lit(" "))))


CODE_SHAPE = r"\b[A-Z]{2,}[A-Z0-9-]*\d+[A-Z0-9-]*\b"


def _variants(i: Column) -> Column:
    names = F.concat(F.array(i["name"]), F.coalesce(i["otherNames"], F.array().cast("array<string>")))
    return F.filter(F.transform(names, lambda v: norm(v, "plain")), lambda v: v != "")


def experimental_interventions(arms: Column, title: Column) -> Column:
    """Interventions of a study that are the tested asset, narrowed to title hits, else to
    code-like names, else kept only when a single one remains."""
    names = F.flatten(F.transform(F.filter(arms["armGroups"], lambda g: F.upper(g["type"]) == "EXPERIMENTAL"),
                                  lambda g: g["interventionNames"]))
    tested = F.filter(F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda n: norm(F.regexp_replace(
        n, r"(?i)^(?:DRUG|BIOLOGICAL|GENETIC|COMBINATION_PRODUCT)\s*:\s*", ""), "plain")), lambda n: n != "")
    head = norm(title, "plain")
    in_title = lambda i: F.exists(_variants(i), lambda v: head.contains(v))
    coded = lambda i: i["name"].rlike(CODE_SHAPE)
    in_arm = lambda i: F.exists(_variants(i), lambda v: F.exists(tested, lambda e: v.contains(e) | e.contains(v)))
    ok = F.filter(arms["interventions"], lambda i: F.upper(i["type"]).isin(R.INTERVENTION_TYPES) & (F.trim(i["name"]) != "")
                  & ~i["name"].rlike(R.CONTROL_TERMS) & ~i["name"].rlike(R.SUPPORTIVE_TERMS)
                  & F.when(F.size(tested) > 0, in_arm(i)).otherwise(in_title(i) | coded(i)))
    hits = F.filter(ok, in_title)
    codes = F.filter(ok, lambda i: coded(i) | F.exists(F.coalesce(i["otherNames"], F.array().cast("array<string>")), lambda a: a.rlike(CODE_SHAPE)))
    return F.when(F.size(hits) > 0, hits).when(F.size(codes) > 0, codes).when(F.size(ok) == 1, ok).otherwise(F.slice(ok, 1, 0))


def trial_rows(trials: DataFrame, company: str) -> DataFrame:
    """Study filter chain. ``reject_reason`` names the first rule a study fails; accepted
    studies give one row per tested intervention."""
    ps = F.col("protocolSection")
    d = trials.select(
        clean(ps["identificationModule"]["nctId"]).alias("nct"),
        clean(F.coalesce(ps["identificationModule"]["briefTitle"], ps["identificationModule"]["officialTitle"])).alias("title"),
        clean(ps["sponsorCollaboratorsModule"]["leadSponsor"]["name"]).alias("lead"),
        P.registry(F.coalesce(ps["designModule"]["phases"], F.array().cast("array<string>"))).alias("phase"),
        F.filter(F.transform(ps["conditionsModule"]["conditions"], lambda c: clean(c)), lambda c: c != "").alias("conditions"),
        F.upper(F.trim(ps["statusModule"]["overallStatus"])).alias("status"), ps["armsInterventionsModule"].alias("arms"))
    d = d.withColumn("tested", experimental_interventions(F.col("arms"), F.col("title")))
    reason = (F.when((F.col("lead") != "") & ~sponsor_matches(F.lit(company), "lead"), "sponsor")
              .when(F.col("phase") == "", "phase").when(F.coalesce(F.size("conditions"), F.lit(0)) <= 0, "conditions")
              .when(F.coalesce(F.size("tested"), F.lit(0)) <= 0, "experimental asset").when(~F.col("status").isin(R.ACTIVE_TRIAL_STATUS), "status"))
    d = d.withColumn("reject_reason", reason)
    kept = F.when(F.col("reject_reason").isNull(), F.col("tested"))
    d = d.select("*", F.explode_outer(kept).alias("i"))
    return d.select("nct", "title", F.col("i.name").alias("asset"), F.get("conditions", F.lit(0)).alias("condition"), "phase",
                    P.phase_rank("phase").alias("phase_rank"), P.friendly_status("status").alias("status"),
                    P.status_priority(P.friendly_status("status")).alias("status_rank"), "reject_reason",
                    norm(F.col("i.name")).alias("asset_key"), norm(F.get("conditions", F.lit(0))).alias("condition_key"))


def application_products(applications: DataFrame) -> DataFrame:
    """Application x product x active ingredient rows."""
    d = applications.select("application_number", "sponsor_name", F.explode("products").alias("p"))
    return d.select("application_number", "sponsor_name", F.col("p.brand_name").alias("brand_name"), F.col("p.dosage_form").alias("dosage_form"),
                    F.col("p.marketing_status").alias("marketing_status"), F.explode_outer("p.active_ingredients.name").alias("ingredient"),
                    brand_norm("p.brand_name").alias("brand_key"))
