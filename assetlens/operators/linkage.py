"""Record linkage of programmes to a portfolio.

Neither side is compared pair by pair. Both are reduced to distinct profiles, joined on
identity keys combined with indication evidence, and the portfolio side of that join is
collapsed to what the score depends on. Only pairs that reach a source's best score are
ever written out, so a key shared by a third of both tables costs its distinct score
features, not the product of its rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import identity as I
from ..functions import phase as P
from ..functions import rules as R
from ..functions.text import clean, clinical_norm, norm, phrase_in
from ..sources.contract import PORTFOLIO, PROGRAM, conform
from .materialize import materialize

KEYS = "array<struct<kind:string,key:string>>"
PRIORITY = [label for _, label in R.METHODS]
LABELS = dict(R.METHODS)
COMPOSITE = "Composite Exact Identity"


def _strings(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def cleaned(df: DataFrame, schema: dict[str, str], keep=()) -> DataFrame:
    """Contract rows with every text field cleaned once; absent fields stay literals."""
    rows, fix = conform(df, schema), {}
    for name, kind in schema.items():
        if name in keep or name not in df.columns:
            if kind == "string" and name not in keep:
                fix[name] = F.lit("")
        elif kind == "string":
            fix[name] = clean(name)
        elif kind == "array<string>":
            fix[name] = F.filter(F.transform(name, lambda v: clean(v)), lambda v: v != "")
    return rows.withColumns(fix)


# ---- row rules -------------------------------------------------------------


def commercial_decision(mode: str = "qualified") -> Column:
    """Ordered inclusion rules -> struct(decision, basis, reason), on clean text and
    the canonical ``phase_key``."""
    status = norm("program_status", None)

    def out(decision, basis, reason=None):
        return F.struct(F.lit(decision).alias("decision"), _strings(basis).alias("basis"),
                        (reason if isinstance(reason, Column) else F.lit(reason).cast("string")).alias("reason"))

    low = "Phase 1 is excluded unless explicitly strategic under COMMERCIAL_PORTFOLIO_V1."
    rule = (F.when(status.rlike("|".join(R.STOPPED_STATUS)), out(
                "Exclude", "Inactive / Discontinued",
                "Source status is inactive/discontinued/terminated/withdrawn."))
            .when(F.col("generic_commodity"), out(
                "Exclude", "Generic / Commodity",
                "Source identifies a generic/commodity product outside commercial scope."))
            .when(F.col("marketed_strategic_rx"), out("Include", "Strategic Marketed Rx Brand"))
            .when(F.col("important_label_expansion"), out("Include", "Important Label Expansion")))
    strategic = F.col("strategic_phase1")
    if mode == "exact":
        phase = P.legacy("phase", None)
        return (rule.when(phase.isin("filed", "filed registration", "registration"),
                          out("Include", "Filed / Registration"))
                .when(phase.isin(R.EXACT_MODE_PHASES), out("Include", "Active Phase 2+"))
                .when((phase == "phase 1") & strategic, out("Include", "Strategic Phase 1"))
                .when(phase == "phase 1", out("Exclude", "Legacy / Low Commercial Value", low))
                .when(phase == "", out("Review", "Insufficient Evidence", "No source-backed commercial "
                                       "inclusion signal or eligible development phase."))
                .otherwise(out("Review", "Insufficient Evidence", F.concat(
                    F.lit("Phase/status '"), F.col("phase"),
                    F.lit("' does not map deterministically to COMMERCIAL_PORTFOLIO_V1.")))))
    phase = F.col("phase_key")
    return (rule.when(phase == "registration", out("Include", "Filed / Registration"))
            .when(phase.rlike(r"^phase .*\b[123]\b.*\b[123]\b") & phase.rlike(r"\b[23]\b"),
                  out("Include", "Integrated Phase 2+"))
            .when(phase.rlike(r"^phase .*\b[23]\b"), out("Include", "Active Phase 2+"))
            .when(phase.rlike(r"^phase .*\b1\b") & strategic, out("Include", "Strategic Phase 1"))
            .when(phase.rlike(r"^phase .*\b1\b"), out("Exclude", "Legacy / Low Commercial Value", low))
            .otherwise(out("Review", "Insufficient Evidence",
                           "No deterministic commercial inclusion signal or eligible development phase.")))


def company_names(aliases: DataFrame) -> DataFrame:
    """(target, alias) -> distinct (target, name); the target's own name is one of them."""
    own = aliases.select("target", F.col("target").alias("alias"))
    return (aliases.select("target", "alias").union(own)
            .select("target", norm("alias").alias("name")).filter("name <> ''").distinct())


def with_ownership(rows: DataFrame, names: DataFrame, mode: str = "qualified") -> DataFrame:
    """Adds ``ownership_reason`` (NULL when the row clearly belongs to its target)."""
    known = names.select(F.col("target").alias("_t"), F.col("name").alias("_n"), F.lit(True).alias("_hit"))
    rows = rows.withColumns({"_company": norm("company", None), "_owner": norm("sponsor_owner", None)})
    for col, flag in (("_company", "_company_ok"), ("_owner", "_owner_ok")):
        rows = (rows.join(known, (F.col("target") == F.col("_t")) & (F.col(col) == F.col("_n")), "left")
                .withColumn(flag, F.coalesce("_hit", F.lit(False))).drop("_t", "_n", "_hit"))
    if mode == "exact":
        excused = F.exists("partners", lambda p: norm(p, None) == F.col("_owner"))
        tail = "' does not exactly resolve to target company/verified aliases; ownership requires review."
    else:
        excused = F.coalesce(F.col("ownership_resolved"), F.lit(False))
        tail = ("' does not exactly resolve to target company/verified aliases and ownershipResolved "
                "was not explicitly true.")
    reason = (F.when(~F.coalesce(F.col("ownership_resolved"), F.lit(True)),
                     "Source explicitly indicates unresolved ownership/licensing.")
              .when((F.col("_company") != "") & ~F.col("_company_ok"), F.concat(
                  F.lit("Source company '"), F.col("company"),
                  F.lit("' does not exactly resolve to target company/verified aliases.")))
              .when((F.col("_owner") != "") & ~F.col("_owner_ok") & ~excused, F.concat(
                  F.lit("Source sponsor/owner '"), F.col("sponsor_owner"), F.lit(tail))))
    return rows.withColumn("ownership_reason", reason).drop("_company", "_owner", "_company_ok", "_owner_ok")


# ---- identity keys and indication features -------------------------------------


def _keyed(kind: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("key")))


def _one(c) -> Column:
    return F.filter(F.array(norm(c, None)), lambda v: v != "")


def _key_array(sets: dict[str, Column]) -> Column:
    parts = [_keyed(kind, values) for kind, values in sets.items()]
    return F.array_distinct(F.concat(*parts)).cast(KEYS)


def source_keys(mode: str) -> Column:
    if mode == "exact":
        sets = {"code": _one("development_code"), "molecule": _one("molecule"),
                "brand": _one("brand"), "asset": _one("asset")}
        sets["display"] = F.array_union(sets["brand"], sets["asset"])
    else:
        sets = {"code": F.concat(_one("development_code"), I.paren_codes("asset", None),
                                 I.paren_codes("molecule", None), I.paren_codes("brand", None)),
                **{k: I.identity_variants(k, None) for k in ("molecule", "brand", "asset")}}
    named = [sets[k] for k in ("code", "molecule", "brand", "asset")]
    return _key_array({**sets, "alias": F.concat(*named)})


def portfolio_keys(mode: str) -> Column:
    if mode == "exact":
        sets = {"code": _one("development_code"), "molecule": _one("molecule"),
                "brand": _one("brand"), "asset": _one("asset"),
                "alias": F.filter(F.transform("aliases", lambda a: norm(a, None)), lambda a: a != "")}
        sets["display"] = F.array_union(sets["brand"], sets["asset"])
    else:
        sets = {"code": I.identity_variants("development_code", None),
                **{k: I.identity_variants(k, None) for k in ("molecule", "brand", "asset")},
                "alias": F.flatten(F.transform("aliases", lambda a: I.identity_variants(a, None)))}
    return _key_array(sets)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Hash rows over all shuffle partitions. Rule folds cost far more time than bytes, so a
    partition count chosen by bytes would leave most cores idle."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


SOURCE_RAW = ["target", "asset", "molecule", "development_code", "brand", "indication",
              "controlled_indication_candidate", "phase", "partners"]
PORTFOLIO_RAW = [c for c in PORTFOLIO if c not in ("record_id", "portfolio_ordinal", "portfolio_status")]


def _digest(cols) -> Column:
    return F.sha1(F.to_json(F.struct(*cols)))


def source_profiles(eligible: DataFrame, mode: str) -> DataFrame:
    """One row per distinct comparable content, with features computed once."""
    d = spread(eligible.select("profile", *SOURCE_RAW).dropDuplicates(["profile"]), "profile")
    d = d.withColumn("keys", source_keys(mode))
    if mode == "exact":
        return d.select("profile", "target", "keys", norm("indication", None).alias("raw"),
                        F.lit("").alias("controlled"), F.lit("").alias("universe"),
                        _strings().alias("studies"), F.lit("").alias("dev"), F.lit("").alias("line"),
                        _strings().alias("flags"), P.hybrid("phase", None).alias("phase"))
    d = d.withColumns({
        "raw": clinical_norm("indication", None), "controlled": clinical_norm("controlled_indication_candidate", None),
        "universe": norm(F.concat_ws(" ", "asset", "molecule", "brand", "indication",
                                     F.array_join("partners", " ")), None),
        "studies": I.study_codes("indication", None), "dev": norm("development_code", None),
        "line": I.line_qualifier("indication", None), "phase": P.hybrid("phase", None)})
    return d.withColumn("flags", I.qualifier_flags(F.col("raw"))).select(
        "profile", "target", "keys", "raw", "controlled", "universe", "studies", "dev", "line", "flags", "phase")


def portfolio_features(portfolio: DataFrame, names: DataFrame, mode: str) -> DataFrame:
    """Portfolio rows in scope of a target ('*' for rows without a company)."""
    d = cleaned(spread(portfolio, "record_id"), PORTFOLIO, keep=("record_id", "portfolio_ordinal"))
    scoped = names.select(F.col("name").alias("_n"), F.col("target").alias("_t"))
    d = (d.withColumn("_company", norm("company", None))
         .join(scoped, F.col("_company") == F.col("_n"), "left")
         .withColumn("scope", F.when(F.coalesce("company", F.lit("")) == "", "*").otherwise(F.col("_t")))
         .filter("scope is not null").drop("_n", "_t", "_company"))
    d = d.withColumn("keys", portfolio_keys(mode))
    common = ["record_id", "portfolio_ordinal", "scope", "keys"]
    if mode == "exact":
        values = F.array_distinct(F.filter(F.concat(
            F.array(norm("indication", None), norm("controlled_indication", None)),
            F.transform("indication_aliases", lambda a: norm(a, None))), lambda v: v != ""))
        return d.select(*common, F.lit("").alias("raw"), F.lit("").alias("controlled"),
                        values.alias("aliases"), _strings().alias("studies"), F.lit("").alias("dev"),
                        F.lit("").alias("line"), _strings().alias("flags"),
                        P.hybrid("phase", None).alias("phase"), F.col("phase").alias("phase_text"),
                        F.array().cast("array<array<string>>").alias("combos"))
    own_line = I.line_qualifier("indication", None)
    setting = F.filter(F.transform("treatment_setting_line", lambda v: I.line_qualifier(v, None)), lambda v: v != "")
    d = d.withColumns({
        "raw": clinical_norm("indication", None), "controlled": clinical_norm("controlled_indication", None),
        "ialiases": F.array_distinct(F.filter(F.transform(
            "indication_aliases", lambda a: clinical_norm(a, None)), lambda a: a != "")),
        "studies": I.study_codes("indication", None), "dev": norm("development_code", None),
        "line": F.when(own_line != "", own_line).otherwise(F.coalesce(F.get(setting, F.lit(0)), F.lit(""))),
        "flag_text": clinical_norm(F.concat_ws(" ", "indication", "biomarker_patient_segment"), None),
        "phase_text": F.col("phase"), "phase_key": P.hybrid("phase", None),
        "combos": F.filter(F.array(*[I.combination_components(c, None) for c in ("brand", "molecule", "asset")]),
                           lambda a: F.size(a) >= 2)})
    d = d.withColumn("flags", I.qualifier_flags(F.col("flag_text")))
    return d.select(*common, "raw", "controlled", F.col("ialiases").alias("aliases"), "studies", "dev",
                    "line", "flags", F.col("phase_key").alias("phase"), "phase_text", "combos")


def _first_word(c: Column) -> Column:
    return F.substring_index(c, " ", 1)


def combination_keys(profiles: DataFrame, portfolio: DataFrame) -> DataFrame:
    """(profile, scope, key) where every component of a portfolio combination occurs as a
    whole phrase in the source's identity text.

    Each combination is looked up by the first word of its rarest component, so one
    equi join replaces the division and common partners cause no fan-out.
    """
    combos = (portfolio.select("scope", F.explode("combos").alias("parts")).distinct()
              .withColumn("key", F.array_join("parts", " + ")))
    words = profiles.select("profile", "target", "universe",
                            F.explode(F.array_distinct(F.split("universe", " "))).alias("word"))
    heads = combos.select(F.explode(F.transform("parts", _first_word)).alias("word")).distinct()
    freq = words.select("word").join(heads, "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))
    anchored = (combos.withColumn("word", F.explode(F.array_distinct(F.transform("parts", _first_word))))
                .join(freq, "word").groupBy("scope", "key", "parts")
                .agg(F.min_by("word", F.struct("n", "word")).alias("word")))
    return (words.join(anchored, "word")
            .filter(F.col("scope").isin("*") | (F.col("scope") == F.col("target")))
            .filter(F.forall("parts", lambda c: phrase_in(c, F.col("universe"))))
            .select("profile", "scope", F.lit("combo").alias("kind"), "key").distinct())


def live_identities(profiles: DataFrame, portfolio: DataFrame, mode: str):
    """Keys both sides share: (profile, scope, kind, key), and a function from them to the
    portfolio rows that own one (scope, kind, key per row)."""
    p_keys = portfolio.select("scope", F.explode("keys").alias("k")).select("scope", "k.kind", "k.key").distinct()
    s_keys = profiles.select("profile", F.explode(F.array(F.lit("*"), "target")).alias("scope"), "keys")
    s_keys = s_keys.select("profile", "scope", F.explode("keys").alias("k")).select(
        "profile", "scope", "k.kind", "k.key")
    live = s_keys.join(p_keys, ["scope", "kind", "key"], "left_semi")
    if mode != "exact":
        live = live.unionByName(combination_keys(profiles, portfolio))

    def owned(shared: DataFrame) -> DataFrame:
        own = portfolio.withColumn("k", F.explode(F.concat("keys", F.transform(
            "combos", lambda c: F.struct(F.lit("combo").alias("kind"), F.array_join(c, " + ").alias("key"))))))
        own = own.select("*", "k.kind", "k.key").drop("keys", "combos", "k")
        return own.join(shared.select("scope", "kind", "key").distinct(), ["scope", "kind", "key"], "left_semi")

    return live, owned


SCORE_FEATURES = ["studies", "dev", "line", "flags", "phase"]
PAIR_FEATURES = ["raw", "controlled", "aliases", *SCORE_FEATURES, "phase_text"]


def portfolio_members(owned: DataFrame) -> DataFrame:
    """Portfolio rows that share a key with any source, with the id of their profile."""
    per_row = owned.groupBy("record_id", "portfolio_ordinal", "scope", *PAIR_FEATURES).agg(
        F.array_sort(F.collect_set(F.struct("kind", "key"))).cast(KEYS).alias("keys"))
    per_row = per_row.withColumn("dev", F.when(F.exists(
        "keys", lambda k: (k["kind"] == "code") & (k["key"] == F.col("dev"))), F.col("dev")).otherwise(""))
    return per_row.withColumn("pid", _digest(["scope", "keys", *PAIR_FEATURES]))


def portfolio_profiles(members: DataFrame) -> DataFrame:
    """Rows with the same live keys and indication features become one weighted profile."""
    return members.groupBy("pid", "scope", "keys", *PAIR_FEATURES).agg(
        F.count("*").alias("records"), F.min(F.struct("portfolio_ordinal", "record_id")).alias("first"))


def _windows3(words: Column) -> Column:
    grams = F.transform(F.sequence(F.lit(1), F.size(words) - 2), lambda i: F.array_join(F.slice(words, i, 3), " "))
    return F.when(F.size(words) >= 3, F.array_distinct(grams)).otherwise(_strings())


def _evidence(rule: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(rule).alias("rule"), v.alias("anchor")))


def source_evidence(mode: str) -> Column:
    raw = F.col("raw")
    present = F.when(raw != "", F.array(raw)).otherwise(_strings())
    if mode == "exact":
        return _evidence("exact", present)
    words = F.split(raw, " ")
    head = F.when(F.size(words) >= 3, F.array(F.array_join(F.slice(words, 1, 3), " "))).otherwise(_strings())
    controlled = F.when(F.col("controlled") != "", F.array("controlled")).otherwise(_strings())
    return F.concat(_evidence("exact", present), _evidence("controlled", controlled),
                    _evidence("inside", head), _evidence("around", _windows3(words)),
                    _evidence("phrase", F.when(raw != "", F.array_distinct(words)).otherwise(_strings())),
                    _evidence("study", F.col("studies")))


def portfolio_evidence(mode: str) -> Column:
    """struct(rule, anchor, text): ``text`` is what the source must be checked against."""
    raw, aliases = F.col("raw"), F.col("aliases")
    blank = lambda vs: F.transform(vs, lambda v: F.struct(v.alias("anchor"), F.lit("").alias("text")))

    def rule(name, pairs):
        return F.transform(pairs, lambda p: F.struct(F.lit(name).alias("rule"), p["anchor"].alias("anchor"),
                                                     p["text"].alias("text")))
    if mode == "exact":
        return rule("exact", blank(aliases))
    words = F.split(raw, " ")
    present = F.when(raw != "", F.array(raw)).otherwise(_strings())
    terms = F.filter(F.array_distinct(F.concat(F.array("controlled"), aliases)), lambda v: v != "")
    head = F.when(F.size(words) >= 3, F.array(F.array_join(F.slice(words, 1, 3), " "))).otherwise(_strings())
    with_raw = lambda vs: F.transform(vs, lambda v: F.struct(v.alias("anchor"), raw.alias("text")))
    phrases = F.transform(terms, lambda v: F.struct(_first_word(v).alias("anchor"), v.alias("text")))
    return F.concat(rule("exact", blank(present)), rule("controlled", blank(terms)),
                    rule("inside", with_raw(_windows3(words))), rule("around", with_raw(head)),
                    rule("phrase", phrases), rule("study", blank(F.col("studies"))))


BASE_SCORE = {"exact": R.SCORE_EXACT, "controlled": R.SCORE_CONTROLLED, "inside": R.SCORE_CONTAINED,
              "around": R.SCORE_CONTAINED, "phrase": R.SCORE_PHRASE, "study": 0}


def adjustment(s, p) -> Column:
    """Study, code, line, flag and phase terms of the score for two feature accessors."""
    study = F.arrays_overlap(s("studies"), p("studies"))
    code = study & (s("dev") != "") & (s("dev") == p("dev"))
    both_lines = (s("line") != "") & (p("line") != "")
    flags = F.size(F.array_intersect(s("flags"), p("flags")))
    return (F.when(study, R.SCORE_STUDY).otherwise(0) + F.when(code, R.SCORE_CODE).otherwise(0)
            + F.when(both_lines & (s("line") == p("line")), R.SCORE_LINE)
            .when(both_lines, R.SCORE_LINE_CONFLICT).otherwise(0)
            + F.least(F.lit(R.SCORE_FLAG_MAX), R.SCORE_FLAG * flags)
            + F.when((s("phase") != "") & (s("phase") == p("phase")), R.SCORE_PHASE).otherwise(0))


def _tokens_count(c: Column) -> Column:
    return F.size(F.split(c, " "))


def indication_tests(s, p) -> dict[str, Column]:
    """The wording tests of the score, by name."""
    raw, other = s("raw"), p("raw")
    shorter_is_source = _tokens_count(raw) <= _tokens_count(other)
    shorter = F.when(shorter_is_source, raw).otherwise(other)
    longer = F.when(shorter_is_source, other).otherwise(raw)
    return {
        "exact": (raw != "") & (raw == other),
        "controlled": (s("controlled") != "") & ((s("controlled") == p("controlled"))
                                                 | F.array_contains(p("aliases"), s("controlled"))),
        "contained": (raw != "") & (other != "") & (_tokens_count(shorter) >= 3) & phrase_in(shorter, longer),
        "phrase": phrase_in(p("controlled"), raw),
        "alias": F.exists(p("aliases"), lambda a: phrase_in(a, raw)),
    }


def indication_score(s, p) -> Column:
    """Full score of one pair, from feature accessors ``s(name)`` and ``p(name)``."""
    t = indication_tests(s, p)
    base = F.greatest(*[F.when(t[k], v).otherwise(0) for k, v in (
        ("exact", R.SCORE_EXACT), ("controlled", R.SCORE_CONTROLLED), ("contained", R.SCORE_CONTAINED),
        ("phrase", R.SCORE_PHRASE), ("alias", R.SCORE_PHRASE))])
    return base + adjustment(s, p)


def match_evidence(s, p) -> Column:
    t = indication_tests(s, p)
    study = F.arrays_overlap(s("studies"), p("studies"))
    both_lines = (s("line") != "") & (p("line") != "")
    common = F.array_sort(F.array_intersect(s("flags"), p("flags")))
    items = [
        (t["exact"], "Exact normalized source-facing indication"),
        (t["controlled"], "Exact controlled indication candidate"),
        (t["contained"], "Deterministic source-indication containment"),
        (t["phrase"], "Controlled disease phrase present in source indication"),
        (t["alias"], "Verified indication alias present in source indication"),
        (study, "Exact study/program code"),
        (study & (s("dev") != "") & (s("dev") == p("dev")),
         "Exact development code corroborates exact study/program code"),
        (both_lines & (s("line") == p("line")), "Exact treatment-line qualifier"),
        (both_lines & (s("line") != p("line")), "Treatment-line conflict"),
        (F.size(common) > 0, F.concat(F.lit("Qualifier agreement: "), F.array_join(common, ", "))),
        ((s("phase") != "") & (s("phase") == p("phase")), "Exact canonical phase"),
    ]
    return F.array_compact(F.array(*[F.when(c, v if isinstance(v, Column) else F.lit(v)) for c, v in items]))


# ---- methods and confidence -------------------------------------------------------


def methods_of(kinds: Column, mode: str) -> Column:
    """Key kinds -> method labels in priority order."""
    has = lambda k: F.array_contains(kinds, k)
    out = [F.when(has(kind), F.lit(label)) for kind, label in R.METHODS]
    if mode == "exact":
        out[-1] = F.when(has("display") & ~has("brand") & ~has("asset"), F.lit(COMPOSITE))
    return F.array_compact(F.array(*out))


def best_method(methods: Column) -> Column:
    return (F.when(F.size(methods) == 0, "No Match")
            .when((F.size(methods) >= 2) | F.array_contains(methods, LABELS["combo"]), COMPOSITE)
            .otherwise(F.get(methods, F.lit(0))))


def match_confidence(methods: Column, score: Column, mode: str = "qualified") -> Column:
    strong = _strings("Exact Development Code", "Exact Molecule / INN")
    if mode == "exact":
        return F.when(F.arrays_overlap(methods, strong) | (F.size(methods) >= 2), "High").when(
            F.size(methods) > 0, "Medium").otherwise("Low")
    strong = _strings("Exact Development Code", "Exact Molecule / INN", LABELS["combo"])
    return (F.when((score >= R.PLAUSIBLE) & (F.arrays_overlap(methods, strong) | (F.size(methods) >= 2)), "High")
            .when((F.size(methods) > 0) & (score >= R.MEDIUM), "Medium").otherwise("Low"))


def pair_kinds(a: Column, b: Column) -> Column:
    return F.array_distinct(F.transform(F.array_intersect(a, b), lambda k: k["kind"]))


# ---- the linkage ----------------------------------------------------------------------


class Linkage:
    """Stages of one comparison; every attribute is a DataFrame.

    Three feature tables feed several later joins. They are written once to the shared
    folder, so no rule fold runs twice and later plans start from plain scans."""

    def __init__(self, programs: DataFrame, portfolio: DataFrame, aliases: DataFrame, mode: str = "qualified"):
        self.mode = mode
        names = company_names(aliases)
        rows = cleaned(programs, PROGRAM, keep=("source_url", "source_record_id"))
        rows = rows.withColumn("phase_key", P.hybrid("phase", None))
        rows = rows.withColumn("rule", commercial_decision(mode))
        rows = with_ownership(rows, names, mode)
        rows = rows.withColumn("gate", F.when(F.col("source_unavailable"), "SOURCE UNAVAILABLE")
                               .when(F.col("rule.decision") == "Exclude", "EXCLUDED BY RULE")
                               .when(F.col("ownership_reason").isNotNull(), "OWNERSHIP REVIEW"))
        self.rows = rows.withColumn("profile", _digest(SOURCE_RAW))
        self.profiles = materialize(source_profiles(self.rows.filter("gate is null"), mode), "profiles")
        self.portfolio = materialize(portfolio_features(portfolio, names, mode), "portfolio")
        live, owned = live_identities(self.profiles, self.portfolio, mode)
        self.live = materialize(live, "live")
        self.members = materialize(portfolio_members(owned(self.live)), "members")
        self.portfolio_profiles = portfolio_profiles(self.members)

    def identities(self) -> DataFrame:
        """(profile, kinds): identity key kinds with any portfolio row."""
        return self.live.groupBy("profile").agg(F.array_sort(F.collect_set("kind")).alias("kinds"))

    def evidence_groups(self) -> DataFrame:
        """Portfolio side of the evidence join, collapsed to what the score needs."""
        d = self.portfolio_profiles.select("pid", "scope", "keys", F.explode(portfolio_evidence(self.mode)).alias("e"),
                                           *SCORE_FEATURES)
        return d.select("pid", "scope", F.explode("keys").alias("k"), "e.rule", "e.anchor", "e.text", *SCORE_FEATURES
                        ).select("pid", "scope", "k.kind", "k.key", "rule", "anchor", "text", *SCORE_FEATURES)

    def scored_groups(self) -> DataFrame:
        join_on = ["scope", "kind", "key", "rule", "anchor"]
        prefixed = [F.col(c).alias(f"p_{c}") for c in SCORE_FEATURES]
        groups = self.evidence_groups().select(*join_on, F.col("text").alias("p_text"), *prefixed).distinct()
        src = (self.profiles.select("profile", "raw", *SCORE_FEATURES, F.explode(source_evidence(self.mode)).alias("e"))
               .select("profile", "raw", *SCORE_FEATURES, "e.rule", "e.anchor"))
        src = src.join(self.live, "profile")
        d = src.join(groups, join_on)
        text, raw = F.col("p_text"), F.col("raw")
        fits = (F.when(F.col("rule") == "inside", (_tokens_count(raw) <= _tokens_count(text)) & phrase_in(raw, text))
                .when(F.col("rule") == "around", (_tokens_count(text) < _tokens_count(raw)) & phrase_in(text, raw))
                .when(F.col("rule") == "phrase", phrase_in(text, raw)).otherwise(True))
        base = reduce(lambda acc, kv: acc.when(F.col("rule") == kv[0], kv[1]), BASE_SCORE.items(), F.when(F.lit(False), 0))
        s, p = (lambda n: F.col(n)), (lambda n: F.col(f"p_{n}"))
        score = F.lit(R.SCORE_EXACT) if self.mode == "exact" else base + adjustment(s, p)
        return d.filter(fits).select("profile", *join_on, "p_text", *[f"p_{c}" for c in SCORE_FEATURES],
                                     score.alias("score"))

    def top_groups(self) -> DataFrame:
        """Groups at each profile's best score, when that score is plausible."""
        w = Window.partitionBy("profile")
        return (self.scored_groups().filter(F.col("score") >= R.PLAUSIBLE)
                .withColumn("best", F.max("score").over(w)).filter("score = best").drop("best"))

    def tied_pairs(self) -> DataFrame:
        """Distinct (profile, portfolio profile) at the best score."""
        join_on = ["scope", "kind", "key", "rule", "anchor", "p_text", *[f"p_{c}" for c in SCORE_FEATURES]]
        members = self.evidence_groups().select(
            "pid", "scope", "kind", "key", "rule", "anchor", F.col("text").alias("p_text"),
            *[F.col(c).alias(f"p_{c}") for c in SCORE_FEATURES])
        return self.top_groups().join(members, join_on).select("profile", "pid", "score").distinct()

    def outcomes(self) -> DataFrame:
        """One row per profile with its best portfolio match and tie count."""
        p = self.portfolio_profiles.select("pid", "records", "first", F.col("keys").alias("p_keys"), F.struct(
            "raw", "controlled", "aliases", *SCORE_FEATURES, "phase_text").alias("p"))
        combos = self.live.filter("kind = 'combo'").groupBy("profile").agg(
            F.collect_set(F.struct("kind", "key")).cast(KEYS).alias("combo_keys"))
        s = (self.profiles.join(combos, "profile", "left")
             .withColumn("s_keys", F.concat("keys", F.coalesce("combo_keys", F.array().cast(KEYS))))
             .select("profile", "s_keys", F.struct("raw", "controlled", *SCORE_FEATURES).alias("s")))
        pairs = self.tied_pairs().join(p, "pid").join(s, "profile")
        pairs = pairs.withColumn("pair_kinds", pair_kinds(F.col("s_keys"), F.col("p_keys")))
        best = pairs.groupBy("profile").agg(
            F.max("score").alias("score"), F.sum("records").alias("ties"),
            F.min_by(F.struct("first", "p"), F.col("first")).alias("m"),
            F.first("s").alias("s"),
            *[F.max(F.array_contains("pair_kinds", k)).alias(f"has_{k}") for k in self.kinds()])
        kinds = F.array_compact(F.array(*[F.when(F.col(f"has_{k}"), F.lit(k)) for k in self.kinds()]))
        sf, pf = (lambda n: F.col(f"s.{n}")), (lambda n: F.col(f"m.p.{n}"))
        return best.select("profile", "score", "ties", F.col("m.first.record_id").alias("record_id"),
                           kinds.alias("tied_kinds"),
                           F.col("m.p.phase").alias("portfolio_phase"), F.col("m.p.phase_text").alias("portfolio_phase_text"),
                           match_evidence(sf, pf).alias("evidence"))

    def kinds(self):
        return [k for k, _ in R.METHODS] + (["display"] if self.mode == "exact" else [])

    def candidates(self) -> DataFrame:
        """The classification cascade: one row per programme."""
        d = (self.rows.join(self.identities(), "profile", "left").join(self.outcomes(), "profile", "left"))
        exact = self.mode == "exact"
        matched = F.col("gate").isNull() & (F.col("ties") == 1)
        duplicate = F.col("gate").isNull() & (F.col("ties") > 1)
        cls = (F.when(F.col("gate").isNotNull(), F.col("gate")).when(matched, "MATCHED")
               .when(duplicate, "POSSIBLE DUPLICATE").when(F.col("kinds").isNotNull(), "NEW INDICATION")
               .otherwise("NEW ASSET"))
        d = d.withColumn("classification", cls)
        c = F.col("classification")
        methods = F.when(c.isin("MATCHED", "POSSIBLE DUPLICATE"), methods_of(F.col("tied_kinds"), self.mode)).when(
            c == "NEW INDICATION", methods_of(F.col("kinds"), self.mode)).otherwise(_strings())
        d = d.withColumn("methods", methods)
        source_phase = F.col("phase_key")
        delta = F.struct(F.lit("Development Phase").alias("field"), F.col("phase").alias("source_value"),
                         F.col("portfolio_phase_text").alias("portfolio_value"),
                         source_phase.alias("normalized_source"), F.col("portfolio_phase").alias("normalized_portfolio"))
        changed = (c == "MATCHED") & (source_phase != "") & (F.col("portfolio_phase") != "") & (
            source_phase != F.col("portfolio_phase")) & F.lit(not exact)
        d = d.withColumn("field_deltas", F.filter(F.array(delta), lambda _: F.coalesce(changed, F.lit(False))))
        blank_indication = F.lit(exact) & (norm("indication", None) == "")
        review = c.isin("SOURCE UNAVAILABLE", "OWNERSHIP REVIEW", "POSSIBLE DUPLICATE") | (
            (c == "NEW INDICATION") & blank_indication)
        reason = (
            F.when(c == "SOURCE UNAVAILABLE", "Authoritative discovery source was unavailable.")
            .when(c == "OWNERSHIP REVIEW", F.col("ownership_reason"))
            .when((c == "MATCHED") & (F.size("field_deltas") > 0),
                  "Existing Portfolio representation matched; read-only field delta requires downstream QA.")
            .when(c == "POSSIBLE DUPLICATE", (
                "More than one Portfolio record matches the same exact asset identity and exact indication; "
                "fail closed rather than selecting a record automatically.") if exact else
                "Fail closed: exact asset identity exists but qualifier-level reconciliation is ambiguous.")
            .when((c == "NEW INDICATION") & blank_indication,
                  "Asset identity matched, but source indication is blank; indication-level comparison cannot be completed.")
            .when(c == "NEW INDICATION", (
                "Asset identity matched exactly, but source indication did not exactly match any existing Portfolio "
                "indication/controlled indication/verified indication alias.") if exact else
                "Asset exists in Portfolio; source indication appears distinct after deterministic normalization. "
                "Review before any master-data write.")
            .otherwise(F.col("rule.reason")))
        basis = (F.when(c == "SOURCE UNAVAILABLE", _strings("Insufficient Evidence"))
                 .when(c == "OWNERSHIP REVIEW", F.array_distinct(F.concat("rule.basis", _strings("Ownership Ambiguous"))))
                 .otherwise(F.col("rule.basis")))
        evidence = (F.when((c == "MATCHED") & ~F.lit(exact), F.col("evidence"))
                    .when((c == "POSSIBLE DUPLICATE") & ~F.lit(exact), _strings(
                        "Multiple existing Portfolio rows remain equally plausible at asset/indication qualifier grain."))
                    .when((c == "NEW INDICATION") & ~F.lit(exact), _strings(
                        "Exact asset identity exists, but no deterministic indication/qualifier match reached threshold."))
                    .otherwise(_strings()))
        return d.select(
            I.candidate_id("target", "source_family", "source_record_id", "asset", "brand", "molecule",
                           "development_code", "indication", profile=None).alias("candidate_id"),
            *[x for x in PROGRAM if x not in ("strategic_phase1", "important_label_expansion", "marketed_strategic_rx",
                                              "generic_commodity", "source_unavailable", "ownership_resolved")],
            "classification", F.when(review, "Review").otherwise(F.col("rule.decision")).alias("decision"),
            basis.alias("inclusion_basis"), reason.alias("review_reason"),
            F.when(c == "MATCHED", F.col("record_id")).alias("matched_record_id"),
            F.when(c.isin("MATCHED", "POSSIBLE DUPLICATE"), F.col("ties")).alias("plausible_records"),
            F.when(c.isin("MATCHED", "POSSIBLE DUPLICATE"), F.col("score")).alias("best_score"),
            best_method(F.col("methods")).alias("match_method"),
            F.when(c == "MATCHED", match_confidence(F.col("methods"), F.col("score"), self.mode))
            .when((c == "NEW INDICATION"), "Medium").otherwise("Low").alias("match_confidence"),
            evidence.alias("match_evidence"), "field_deltas", "profile")

    def records(self) -> DataFrame:
        """Existing portfolio records of each profile, one row per (profile, record):
        the tied records, or for a new indication every identity match. Order a
        profile's records by score descending, then portfolio_ordinal."""
        rows = self.members.select("record_id", "portfolio_ordinal", "pid")
        tied = self.tied_pairs()
        rest = self.live.join(tied.select("profile").distinct(), "profile", "left_anti")
        owners = self.portfolio_profiles.select("pid", "scope", F.explode("keys").alias("k")).select("pid", "scope", "k.kind", "k.key")
        other = rest.join(owners, ["scope", "kind", "key"]).select("profile", "pid").distinct()
        p = self.portfolio_profiles.select("pid", F.struct("raw", "controlled", "aliases", *SCORE_FEATURES).alias("p"))
        s = self.profiles.select("profile", F.struct("raw", "controlled", *SCORE_FEATURES).alias("s"))
        sf, pf = (lambda n: F.col(f"s.{n}")), (lambda n: F.col(f"p.{n}"))
        other = other.join(p, "pid").join(s, "profile").select("profile", "pid", indication_score(sf, pf).alias("score"))
        return tied.unionByName(other).join(rows, "pid").select("profile", "record_id", "portfolio_ordinal", "score")


def identity_links(linkage: Linkage) -> DataFrame:
    """Identity pairs at the grain of distinct identity sets, weighted by rows.

    Source and portfolio rows with the same live keys are one set each, so the size of
    the result follows the number of distinct identities.
    """
    live = linkage.live.groupBy("profile", "scope").agg(
        F.array_sort(F.collect_set(F.struct("kind", "key"))).cast(KEYS).alias("s_keys"))
    weights = linkage.rows.filter("gate is null").groupBy("profile").agg(F.count("*").alias("n"))
    left = live.join(weights, "profile").groupBy("scope", "s_keys").agg(F.sum("n").alias("n_source"))
    right = linkage.portfolio_profiles.groupBy("scope", F.col("keys").alias("p_keys")).agg(F.sum("records").alias("n_portfolio"))
    l = left.select("*", F.explode("s_keys").alias("k"))
    r = right.select("*", F.explode("p_keys").alias("k"))
    pairs = l.join(r, ["scope", "k"]).select("scope", "s_keys", "p_keys", "n_source", "n_portfolio").distinct()
    return pairs.withColumn("methods", methods_of(pair_kinds(F.col("s_keys"), F.col("p_keys")), linkage.mode))


def class_summary(candidates: DataFrame) -> DataFrame:
    """Zero-filled count per class."""
    spark = candidates.sparkSession
    classes = spark.createDataFrame([(c,) for c in R.CLASSES], "classification string")
    counts = candidates.groupBy("classification").agg(F.count("*").alias("n"))
    return classes.join(counts, "classification", "left").select(
        "classification", F.coalesce("n", F.lit(0)).alias("n"))


def compact(candidates: DataFrame) -> DataFrame:
    """Review line: class, phase, asset, indication and match facts joined by '|'."""
    facts = ["classification", "phase", "asset", "indication", "match_method", "match_confidence"]
    return candidates.select("candidate_id", F.concat_ws("|", *[F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("?"))
                                                               for c in facts]).alias("line"))
