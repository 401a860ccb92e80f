"""Phase, stage and status canonicalisation. One function per source profile."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R
from .text import _map_literal, alnum, clean, let, norm, text_or_blank

ROMAN = {1: "i", 2: "ii", 3: "iii", 4: "iv"}
FILED = "Filed / Registration"


def _any(n: Column, words) -> Column:
    return n.rlike("|".join(words))


def _highest(n: Column, pattern, default) -> Column:
    """Highest phase 4..1 for which ``pattern(k)`` occurs."""
    out = None
    for k in (4, 3, 2, 1):
        hit = n.rlike(pattern(k))
        out = F.when(hit, f"Phase {k}") if out is None else out.when(hit, f"Phase {k}")
    return out.otherwise(default)


def hybrid(c, profile: str | None = "full") -> Column:
    """Comparator phase: ``phase 2 3`` for combined labels, ``registration`` for filings."""
    return let(clean(c, profile), _hybrid)


def _hybrid(text: Column) -> Column:
    raw, n = F.lower(text), alnum(text)
    token = "(?:iii|ii|i|[123])(?:[abc])?"
    span = F.regexp_extract(raw, rf"\bphase\s*({token}(?:\s*(?:/|\\|\+|&|-|to)\s*{token})*)", 1)
    stages = F.concat_ws(" ", F.when(span.rlike("(?<!i)i(?!i)|1"), "1"),
                         F.when(span.rlike("(?<!i)ii(?!i)|2"), "2"), F.when(span.rlike("iii|3"), "3"))
    single = F.regexp_extract(n, r"\bphase\s*([123])\b", 1)
    roman = (F.when(n == "phase i", "phase 1").when(n == "phase ii", "phase 2")
             .when(n == "phase iii", "phase 3"))
    return (F.when(raw == "", "")
            .when(n.isin("registration", "filed") | (n.contains("filed") & n.contains("registration")),
                  "registration")
            .when(stages != "", F.concat(F.lit("phase "), stages))
            .when(roman.isNotNull(), roman)
            .when(n.contains("phase 2 3") | raw.contains("phase 2/3"), "phase 2 3")
            .when(single != "", F.concat(F.lit("phase "), single))
            .otherwise(n))


def legacy(c, profile: str | None = "seed") -> Column:
    n = norm(c, profile)
    for a, b in (("phase ii iii", "phase 2 3"), ("phase iii", "phase 3"), ("phase ii", "phase 2"),
                 ("phase i", "phase 1")):
        n = F.replace(n, F.lit(a), F.lit(b))
    return n


def explicit(c, profile: str | None = "soft") -> Column:
    """Highest number that directly follows the word phase (so 1/2 gives Phase 1)."""
    return let(norm(c, profile), _explicit)


def _explicit(n: Column) -> Column:
    return (F.when(_any(n, ["registration", "regulatory", "filed"]), FILED)
            .otherwise(_highest(n, lambda k: rf"\bphase\s*{k}\b", F.when(
                n.rlike("^[1-4]$"), F.concat(F.lit("Phase "), n))
                .when(_any(n, ["pre clinical", "preclinical"]) | n.isin("phase 0", "0"), "Preclinical")
                .otherwise(""))))


def _standalone(k: int) -> str:
    return rf"\b(?:phase\s*)?(?:{ROMAN[k]}|{k})\b"


def record(c) -> Column:
    """JSON profile: any standalone number or roman numeral counts."""
    from .text import strip_html
    words = _map_literal({"one": "Phase 1", "two": "Phase 2", "three": "Phase 3", "four": "Phase 4"})

    def rules(n):
        word = F.regexp_extract(n, "phase[-_ ]?(one|two|three|four)", 1)
        return (F.when(n == "", "")
                .when(_any(n, ["approved", "marketed"]), "Approved")
                .when(_any(n, ["filed", "registration", "regulatory review", "under review"]), FILED)
                .when(_any(n, ["preclinical", "pre-clinical"]), "Preclinical")
                .otherwise(_highest(n, _standalone, F.coalesce(words[word], F.lit("")))))
    return let(F.lower(strip_html(c)), rules)


def sheet(c) -> Column:
    n = norm(c, "plain")
    return (F.when(_any(n, ["registration", "regulatory", "filed"]), FILED)
            .when(_any(n, ["preclinical", "pre clinical"]), "Preclinical")
            .otherwise(_highest(n, _standalone, "")))


def printed(c) -> Column:
    """Document profile: ``P-II`` before ``Phase III``; the first hit, not the highest."""
    s = clean(c, "plain")
    n = alnum(s)
    token = F.upper(F.coalesce(
        F.nullif(F.regexp_extract(s, r"(?i)\bP\s*[-–]?\s*(I{1,3}|IV|[1-4])\b", 1), F.lit("")),
        F.regexp_extract(s, r"(?i)\bPhase\s*(I{1,3}|IV|[1-4])\b", 1)))
    labels = {t: f"Phase {k}" for k, r in ROMAN.items() for t in (r.upper(), str(k))}
    return (F.when(_any(n, ["approved"]), "Approved")
            .when(_any(n, ["filed", "registration", "regulatory review"]), FILED)
            .when(_any(n, ["preclinical", "pre clinical"]), "Preclinical")
            .otherwise(F.coalesce(_map_literal(labels)[token], F.lit(""))))


def exact(c) -> Column:
    n = F.lower(clean(c, "plain"))
    out = None
    for k in (1, 2, 3, 4):
        hit = n.isin(str(k), f"phase {k}", f"phase {ROMAN[k]}")
        out = F.when(hit, f"Phase {k}") if out is None else out.when(hit, f"Phase {k}")
    return (out.when(n.contains("approved"), "Approved")
            .when(_any(n, ["filed", "registration"]), FILED).otherwise(""))


STAGE_WORDS = {  # fixed values
    "preclinical": "Preclinical", "preclinicalphase": "Preclinical", "discovery": "Preclinical",
    "research": "Preclinical", "commercial": "Approved", "approved": "Approved",
    "approval": "Approved", "marketed": "Approved", "registration": FILED, "registrational": FILED,
    "filed": FILED, "regulatoryreview": FILED,
}
STAGE_RANGES = {  # fixed values
    "phase12": "Phase 2", "phase1to2": "Phase 2", "phase1and2": "Phase 2",
    "phase23": "Phase 3", "phase2to3": "Phase 3", "phase2and3": "Phase 3",
}


def stage_code(c, fallback=None) -> Column:
    """Stage words, then ranges, then the document profile; then the second field."""
    raw = clean(c, "plain")
    key = alnum(raw, "")
    second = clean(fallback if fallback is not None else F.lit(""), "plain")
    second_words = {k: v for k, v in STAGE_WORDS.items() if k != "preclinicalphase"}
    blank = F.lit("")
    return F.coalesce(
        _map_literal({**STAGE_WORDS, **STAGE_RANGES})[key],
        F.nullif(printed(F.translate(raw, "_-", "//")), blank),
        _map_literal(second_words)[alnum(second, "")],
        printed(F.translate(second, "_", "/")))


STAGE_LETTERS = {  # fixed values
    "p": "Preclinical", "preclinical": "Preclinical", "preclinicalstage": "Preclinical",
    **dict.fromkeys(["ia", "ib", "i", "1", "1a", "1b", "phase1", "phase1a", "phase1b"], "Phase 1"),
    **dict.fromkeys(["ii", "2", "phase2"], "Phase 2"),
    **dict.fromkeys(["iii", "3", "phase3"], "Phase 3"),
    **dict.fromkeys(["iv", "4", "phase4"], "Phase 4"),
    **dict.fromkeys(["f", "filed", "filing", "registration", "regulatoryreview"], FILED),
    **dict.fromkeys(["a", "approved", "approval"], "Approved"),
}


def stage_letter(c) -> Column:
    return F.coalesce(_map_literal(STAGE_LETTERS)[alnum(clean(c, "plain"), "")], F.lit(""))


def stage_number(c, label=None) -> Column:
    """Numeric stage where 4 means registration; else words, else the label prefix."""
    n = F.lower(clean(c, "plain"))
    t = F.lower(clean(label if label is not None else F.lit(""), "plain"))
    out = (F.when(n == "1", "Phase 1").when(n == "2", "Phase 2").when(n == "3", "Phase 3")
           .when((n == "4") | _any(n, ["registration", "filed"]), FILED))
    for k in (1, 2, 3):
        out = out.when(n.contains(f"phase {k}") | t.startswith(str(k)), f"Phase {k}")
    return out.otherwise("")


def display(c) -> Column:
    """Display-label profile. The alternation tries 1/2 before 1/2/3."""
    s = clean(c, "plain")
    n = F.lower(s)
    token = F.regexp_extract(s, r"(?i)\bPhase\s*(1/2|2/3|1/2/3|[1-4])\b", 1)
    return (F.when(token != "", F.concat(F.lit("Phase "), F.right(token, F.lit(1))))
            .when(_any(n, ["approved", "commercial"]), "Approved")
            .when(_any(n, ["registration", "filed"]), FILED)
            .when(_any(n, ["preclinical", "pre-clinical"]), "Preclinical")
            .otherwise(printed(s)))


def registry(phases: Column) -> Column:
    """Highest label of a registry phase list; early phase 1 counts as 1."""
    keys = F.transform(phases, lambda p: F.replace(norm(p, "seed"), F.lit(" "), F.lit("")))
    out = F.when(F.array_contains(keys, "phase4"), "Phase 4")
    for k in (3, 2):
        out = out.when(F.array_contains(keys, f"phase{k}"), f"Phase {k}")
    return out.when(F.array_contains(keys, "phase1") | F.array_contains(keys, "earlyphase1"),
                    "Phase 1").otherwise("")


def registry_rank(phases: Column) -> Column:
    """Highest registry rank; NA is skipped; 0 when nothing ranks."""
    def rank(p):
        v = F.upper(clean(p, "soft"))
        digit = F.nullif(F.regexp_extract(v, "([1-4])", 1), F.lit("")).cast("int")
        return F.when(v == "NA", 0).otherwise(F.coalesce(_map_literal(R.TRIAL_PHASE_RANK)[v], digit, F.lit(0)))
    return F.coalesce(F.array_max(F.transform(phases, rank)), F.lit(0))


def registry_phase(phases: Column) -> Column:
    rank = registry_rank(phases)
    return F.when(rank > 0, F.concat(F.lit("Phase "), rank.cast("string"))).otherwise("")


def heading(c, profile: str) -> Column:
    key = F.lower(clean(c, "marketing")) if profile != "rendered" else norm(c, "static")
    return F.coalesce(_map_literal(R.PHASE_HEADINGS[profile])[key], F.lit(""))


def section_heading(c, profile: str | None = "soft") -> Column:
    """A short line that is only a phase heading."""
    s = clean(c, profile)
    n = alnum(s)
    return (F.when(F.length(s) > 48, "")
            .when(n.rlike(r"^phase\s*[1-4]$"), F.concat(F.lit("Phase "), F.right(n, F.lit(1))))
            .when(n.isin("filed", "filing", "registration", "regulatory review", "filed registration"), FILED)
            .when(n.isin("preclinical", "pre clinical"), "Preclinical").otherwise(""))


def marker(c) -> Column:
    """'Phase n in Progress' or 'Registration (geo)' -> struct(phase, geography)."""
    s = clean(c, "document")
    pattern = r"(?i)^(?:Phase\s*([123])\s+in\s+Progress|Registration(?:\s*\(([^)]*)\))?)$"
    number = F.regexp_extract(s, pattern, 1)
    hit = s.rlike(pattern)
    return F.struct(
        F.when(hit & (number != ""), F.concat(F.lit("Phase "), number)).when(hit, FILED)
        .otherwise("").alias("phase"),
        F.when(hit, squeeze_group(s, pattern, 2)).otherwise("").alias("geography"))


def squeeze_group(s: Column, pattern: str, group: int) -> Column:
    from .text import squeeze
    return squeeze(F.regexp_extract(s, pattern, group))


def friendly_status(c) -> Column:
    s = clean(c, "seed")
    return F.coalesce(_map_literal(R.TRIAL_STATUS)[F.upper(s)],
                      F.initcap(F.replace(s, F.lit("_"), F.lit(" "))))


def status_priority(c) -> Column:
    n = norm(c, "seed")
    return (F.when(n.isin("recruiting", "not yet recruiting", "active not recruiting",
                          "enrolling by invitation"), 4)
            .when(n == "completed", 3)
            .when(n.isin("suspended", "terminated", "withdrawn"), 1).otherwise(2))


def phase_rank(c) -> Column:
    d = F.regexp_extract(clean(c, "seed"), r"(?i)\bPhase\s*([1-4])\b", 1)
    return F.when(d != "", d.cast("int")).otherwise(0)


def page_area(c) -> Column:
    """Therapeutic area from page keywords, first rule wins."""
    return let(norm(c, "document"), lambda n: F.coalesce(*[F.when(n.rlike(pattern), label) for pattern, label in R.AREA_KEYWORDS], F.lit("")))


def area_heading(c) -> Column:
    """Heading -> struct(area, as_of, removed)."""
    s = clean(c, "marketing")
    inner = F.regexp_extract(s, r"(?i)^(.+?)\s*\(as of\s+([^)]+)\)\s*$", 1)
    as_of = F.regexp_extract(s, r"(?i)^(.+?)\s*\(as of\s+([^)]+)\)\s*$", 2)
    name = F.lower(F.when(inner != "", inner).otherwise(s))
    removed = F.lower(s) == "removed since last quarter"
    return F.struct(
        F.when(removed, "Removed since last quarter")
        .otherwise(F.coalesce(_map_literal(R.AREA_HEADINGS)[name], F.lit(""))).alias("area"),
        F.when(removed, "").otherwise(F.trim(as_of)).alias("as_of"), removed.alias("removed"))
