"""Text normalisation as Column -> Column functions."""

from __future__ import annotations

import functools
import re
import sys
import unicodedata
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_blank(c) -> Column:
    return F.coalesce(_c(c).cast("string"), F.lit(""))


def let(c: Column, fn) -> Column:
    """Bind ``c`` once and use it several times inside ``fn``.

    Long rule folds go through here: the argument is evaluated once, and the generated
    code of the stage stays far below the method size limit of the JVM."""
    return F.transform(F.array(c), fn)[0]


# ---- compatibility composition (NFKC) -----------------------------------


@functools.lru_cache(maxsize=1)
def _compatibility_tables():
    """Derive the tables from the Unicode database instead of listing them."""
    one_from, one_to, many, pairs = [], [], {}, {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF or 0xAC00 <= cp <= 0xD7A3:
            continue
        ch = chr(cp)
        out = unicodedata.normalize("NFKC", ch)
        if out != ch:
            if len(out) == 1:
                one_from.append(ch)
                one_to.append(out)
            else:
                many[ch] = out
        canon = unicodedata.decomposition(ch)
        if canon and not canon.startswith("<"):
            parts = [chr(int(x, 16)) for x in canon.split()]
            if len(parts) == 2 and out == ch and unicodedata.combining(parts[1]):
                pairs["".join(parts)] = ch
    return "".join(one_from), "".join(one_to), many, pairs


@functools.lru_cache(maxsize=1)
def _many_class() -> str:
    cps = sorted(ord(c) for c in _compatibility_tables()[2])
    spans, start = [], cps[0]
    for a, b in zip(cps, cps[1:] + [None]):
        if b != a + 1:
            spans.append(f"\\x{{{start:X}}}-\\x{{{a:X}}}")
            start = b
    return "[" + "".join(spans) + "]"


def _map_literal(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


MARK, TO = "\u0001", "\u0002"
UNTIDY = r"[^ -~\u00C0-\u0131]|^ | $|  "  # text without a match is clean in every profile but rendered
UNSTABLE = r"[^\x00-\x7F\u00C0-\u0131]"  # all other code points are their own NFKC form


@functools.lru_cache(maxsize=4)
def _lookup_text(kind: str) -> str:
    """A table as one string literal: MARK key TO value MARK key TO value ..."""
    table = {"many": lambda: _compatibility_tables()[2], "pairs": lambda: _compatibility_tables()[3],
             "decomposed": _decomposition_map}[kind]()
    return MARK + MARK.join(k + TO + v for k, v in table.items()) + MARK


def _lookup(kind: str, key: Column) -> Column:
    """Value of ``key`` in a string table, blank when it is absent."""
    hay = F.lit(_lookup_text(kind))
    probe = F.concat(F.lit(MARK), key, F.lit(TO))
    at = F.call_function("instr", hay, probe)
    return F.when(at > 0, F.substring_index(
        F.substring(hay, at + F.length(probe), F.lit(24)), MARK, 1)).otherwise("")


def nfkc(c) -> Column:
    """NFKC without a UDF. Rows of ASCII and plain accented Latin skip every step;
    one-to-one code points go through ``translate``; only rows that hold an expanding
    character or a combining mark are rebuilt character by character."""
    one_from, one_to, _, _ = _compatibility_tables()

    def step(acc, ch):
        pair = _lookup("pairs", F.concat(F.right(acc, F.lit(1)), ch))
        composed = F.when(pair == "", F.concat(acc, ch)).otherwise(
            F.concat(F.left(acc, F.length(acc) - 1), pair))
        many = _lookup("many", ch)
        return (F.when(ch.rlike(r"\p{M}"), composed)
                .when(ch.rlike(r"^[\x00-\x7F]"), F.concat(acc, ch))
                .otherwise(F.concat(acc, F.when(many == "", ch).otherwise(many))))

    def compose(x):
        mapped = F.translate(x, one_from, one_to)
        return F.when(x.rlike(r"\p{M}|" + _many_class()),
                      F.aggregate(F.split(mapped, ""), F.lit(""), step)).otherwise(mapped)

    return let(_c(c), lambda x: F.when(x.rlike(UNSTABLE), compose(x)).otherwise(x))


# ---- clean and norm -----------------------------------------------------


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, R.WS, " "))


def clean(c, profile: str | None = "full") -> Column:
    """Readable text. Profiles differ in which glyphs they repair; None means the
    text is clean already.

    full      NFKC, six dashes, comparison signs
    seed      NFKC, six dashes
    soft      NFKC, soft hyphen removed, six dashes
    document  soft hyphen and bullet glyphs removed, dashes, control 0x02 as dash
    static    soft hyphen removed, dashes
    marketing quotes and dashes to ASCII, trade marks removed
    basic     no-break space and long dashes
    rendered  stray superscript braces and asterisks removed
    plain     white space only
    """
    if profile is None:
        return _c(c)
    if profile == "rendered":
        return squeeze(_repaired(c, profile))
    return let(text_or_blank(c), lambda x: F.when(x.rlike(UNTIDY), squeeze(_repaired(x, profile))).otherwise(x))


def _repaired(c, profile: str) -> Column:
    x = text_or_blank(c)
    if profile == "full":
        x = F.translate(nfkc(x), R.DASHES, "-" * 6)
        x = F.replace(F.replace(x, F.lit("≥"), F.lit(">=")), F.lit("≤"), F.lit("<="))
    elif profile == "seed":
        x = F.translate(nfkc(x), R.DASHES, "-" * 6)
    elif profile == "soft":
        x = F.translate(nfkc(x), R.DASHES + "\u00ad", "-" * 6)
    elif profile == "document":
        x = F.translate(x, R.DASHES + "\u0002\u00ad\uf0a7\u25ba", "-" * 7)
    elif profile == "static":
        x = F.translate(x, R.DASHES + "\u00ad", "-" * 6)
    elif profile == "marketing":
        x = F.translate(x, "\u00a0\u2018\u2019\u2013\u2014\u00ae\u2122", " ''--")
    elif profile == "basic":
        x = F.translate(x, "\u00a0\u2013\u2014", " --")
    elif profile == "rendered":
        x = F.replace(F.replace(x, F.lit("^{®}"), F.lit("®")), F.lit("^{™}"), F.lit("™"))
        x = F.translate(x, "∗*", "")
    elif profile != "plain":
        raise ValueError(profile)
    return x


def alnum(c: Column, sep: str = " ") -> Column:
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", sep), F.lit(sep))


def norm(c, profile: str | None = "full") -> Column:
    """Lower-case words of a-z and 0-9. White space needs no step of its own here."""
    return alnum(_c(c) if profile is None else _repaired(c, profile))


def norm_plain(c) -> Column:
    return alnum(text_or_blank(c))


def norm_key(c) -> Column:
    return alnum(text_or_blank(c), "_")


def brand_norm(c) -> Column:
    """Trade marks dropped (not folded to letters) and ``&`` spelled out."""
    x = F.translate(text_or_blank(c), "®™©", "")
    x = F.replace(x, F.lit("&"), F.lit(" and "))
    return F.trim(F.lower(F.regexp_replace(x, "[^A-Za-z0-9]+", " ")))


def phrase_in(phrase: Column, text: Column) -> Column:
    """Whole-phrase containment of two normalised strings."""
    return ((phrase != "") & (text != "")
            & F.concat(F.lit(" "), text, F.lit(" ")).contains(F.concat(F.lit(" "), phrase, F.lit(" "))))


def uniq(values: Column, key=None) -> Column:
    """Ordered distinct by normalised key; the first spelling is kept."""
    key = key or norm
    pairs = F.transform(values, lambda v: F.struct(squeeze(v).alias("v"), key(v).alias("k")))
    return let(pairs, lambda ps: F.transform(
        F.filter(ps, lambda p, i: (p["k"] != "") & (
            F.array_position(F.transform(ps, lambda q: q["k"]), p["k"]) == i + 1)),
        lambda p: p["v"]))


def fold(c: Column, pairs) -> Column:
    for pattern, repl in pairs:
        c = F.regexp_replace(c, pattern, repl)
    return c


def clinical_norm(c, profile: str | None = "full") -> Column:
    """Deterministic disease wording: alias, polarity, spelling, abbreviations,
    annotations, treatment line; then alphanumeric."""
    def rules(x):
        short = F.regexp_replace(x, R.POLYNEUROPATHY_SHORT, R.POLYNEUROPATHY)
        full = fold(x, [(R.POLYNEUROPATHY_FULL, R.POLYNEUROPATHY), (R.POLYNEUROPATHY_PAREN, " "),
                        (R.POLYNEUROPATHY_SHORT, " ")])
        x = squeeze(F.when(x.rlike(R.POLYNEUROPATHY_FULL), full).otherwise(short))
        x = F.lower(fold(x, R.RECEPTOR_POLARITY))
        x = fold(x, [(rf"\b{a}\b", b) for a, b in R.SPELLING + R.ABBREVIATIONS])
        return alnum(fold(x, [(p, " ") for p in R.ANNOTATIONS] + R.LINE_SHORTHAND))
    return let(clean(c, profile), rules)


def disease_term(c) -> Column:
    """Compatibility decomposition, then short disease terms, keeping + - /."""
    x = F.lower(F.trim(text_or_blank(c)))
    x = F.translate(decompose(x), "\u2019\u2018\u2013\u2014\u2212", "''---")
    return squeeze(F.regexp_replace(fold(x, R.DISEASE_TERMS), r"[^a-z0-9+\-/ ]+", " "))


@functools.lru_cache(maxsize=1)
def _decomposition_map():
    out = {}
    for cp in list(range(0x80, 0x2500)) + list(range(0xFB00, 0xFB07)) + list(range(0xFF01, 0xFFEF)):
        ch = chr(cp)
        d = unicodedata.normalize("NFKD", ch)
        if d != ch:
            out[ch] = d
    return out


def decompose(c: Column) -> Column:
    """NFKD of the Latin, Greek, Cyrillic, symbol and width-variant blocks."""
    def step(acc, ch):
        parts = F.when(ch.rlike(r"^[\x00-\x7F]"), "").otherwise(_lookup("decomposed", ch))
        return F.concat(acc, F.when(parts == "", ch).otherwise(parts))
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.aggregate(F.split(c, ""), F.lit(""), step)).otherwise(c)


def apply_fixes(c) -> Column:
    """Verified extraction corrections -> struct(text, applied[from,to])."""
    x = clean(c, "document")
    states = [x]
    for wrong, right in R.EXTRACTION_FIXES:
        states.append(F.replace(states[-1], F.lit(wrong), F.lit(right)))
    applied = F.array_compact(F.array(*[
        F.when(states[i].contains(wrong), F.struct(F.lit(wrong).alias("from"), F.lit(right).alias("to")))
        for i, (wrong, right) in enumerate(R.EXTRACTION_FIXES)]))
    return F.struct(squeeze(states[-1]).alias("text"), applied.alias("applied"))


def control_digits(c) -> Column:
    """Code points 19..28 are digits of a font; other controls are dropped."""
    other = "".join(chr(i) for i in range(1, 32) if not 19 <= i <= 28 and chr(i) not in "\t\n\r")
    return F.translate(text_or_blank(c), "".join(chr(i) for i in range(19, 29)) + other, "0123456789")


#: Entity names with their text, and those that may lack the semicolon, from Python's own table of the HTML standard.
ENTITIES = {name: text.replace("\u00a0", " ") for name, text in html5.items()}
BARE = "|".join(sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True))
ENTITY = rf"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]{{0,31}};|(?:{BARE}))"
#: References to 128..159 mean the Windows code page, as the HTML standard says.
C1 = [bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)]


def _code_point(t: Column) -> Column:
    """Number in a numeric reference; one past the last code point when it is too long."""
    digits = F.regexp_extract(t, "^&#[xX]?0*([0-9a-fA-F]*)", 1)
    number = F.when(t.rlike("^&#[xX]"), F.conv(F.concat(F.lit("0"), digits), 16, 10)).otherwise(
        F.concat(F.lit("0"), digits)).cast("long")
    return F.when(F.length(digits) <= 8, number).otherwise(F.lit(0x110000).cast("long"))


def _numeric(n: Column) -> Column:
    """Text of a numeric reference: U+FFFD for what is no character, nothing for control characters."""
    none = (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
    control = (n.between(1, 31) & ~n.isin(9, 10, 12, 13)) | (n == 127) | n.between(0xFDD0, 0xFDEF) | (n % 0x10000 >= 0xFFFE)
    plain = F.when(none, F.lit(32)).otherwise(n)
    return (F.when(none, F.lit("\ufffd"))
            .when(n.between(0x80, 0x9F), F.get(F.array(*map(F.lit, C1)), (n - 0x80).cast("int")))
            .when(n == 0xA0, F.lit(" ")).when(control, F.lit(""))
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(plain), 8, "0")), "UTF-32")))


#: References that nearly every page has. None of their texts can become part of another reference.
COMMON = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&nbsp;": " ", "&#160;": " ", "&copy;": "©", "&reg;": "®",
          "&middot;": "·", "&ndash;": "–", "&mdash;": "—", "&rsquo;": "’"}


def unescape(c: Column) -> Column:
    """Character references of HTML as text, each read once; a no-break space becomes a space.

    Names need their semicolon unless the standard lets it go; unknown names stay as they are.
    A text with common references only is read by plain replacement, ``&amp;`` last.
    """
    def read(x):
        for reference, text in COMMON.items():
            x = F.replace(x, F.lit(reference), F.lit(text))
        return x

    def text(x):
        return let(read(x), lambda y: F.when(F.replace(y, F.lit("&amp;"), F.lit("")).rlike("&[#A-Za-z]"), _any_reference(x))
                   .otherwise(F.replace(y, F.lit("&amp;"), F.lit("&"))))
    return let(c, lambda x: F.when(x.contains("&"), text(x)).otherwise(x))


def _any_reference(c: Column) -> Column:
    names = F.str_to_map(F.lit("\u0001".join(f"{k}\u0002{v}" for k, v in ENTITIES.items())), F.lit("\u0001"), F.lit("\u0002"))

    def named(t):
        bare = F.regexp_extract(t, f"^&({BARE})", 1)
        return F.coalesce(F.try_element_at(names, F.substr(t, F.lit(2))),
                          F.when(bare != "", F.concat(F.try_element_at(names, bare), F.substr(t, F.length(bare) + 2))), t)

    found = F.transform(F.regexp_extract_all(c, F.lit(ENTITY), 0), lambda t: F.struct(
        t.alias("t"), F.when(t.startswith("&#"), _code_point(t)).alias("n")))
    texts = F.transform(found, lambda e: F.when(e["n"].isNotNull(), _numeric(e["n"])).otherwise(named(e["t"])))
    return F.array_join(F.zip_with(F.split(c, ENTITY, -1), texts, lambda gap, x: F.concat(gap, F.coalesce(x, F.lit("")))), "")


def strip_html(c) -> Column:
    x = text_or_blank(c)
    x = F.regexp_replace(x, r"<!--[\s\S]*?-->", " ")
    for tag in ("script", "style", "noscript", "svg"):
        x = F.regexp_replace(x, rf"(?i)<{tag}\b[^>]*>[\s\S]*?</{tag}>", " ")
    return squeeze(unescape(F.regexp_replace(x, "<[^>]+>", " ")))


def token_key(c) -> Column:
    """Order-insensitive token key."""
    return F.array_join(F.array_sort(F.split(brand_norm(c), " ")), " ")


def molecule_components(c) -> Column:
    """Distinct token keys of the parts between ' + ', newlines and ';'."""
    parts = F.split(text_or_blank(c), r"\s+\+\s+|[\n;]+")
    return F.array_distinct(F.filter(F.transform(parts, token_key), lambda v: v != ""))


def company_root(c) -> Column:
    return F.array_join(F.filter(F.split(norm(c, "seed"), " "),
                                 lambda t: ~t.isin(R.CORPORATE_SUFFIXES)), " ")


def canonical_text(values: Column) -> Column:
    return F.array_join(uniq(values, brand_norm), "\n\n")


def as_of_date(c, profile: str) -> Column:
    """Printed source date, kept as text."""
    month = "January|February|March|April|May|June|July|August|September|October|November|December"
    patterns = {
        "month_day": rf"\b(({month})\s+\d{{1,2}},\s+20\d{{2}})\b",
        "as_of": r"(?i)\bAs\s+of\s+([A-Z][a-z]+\s+\d{1,2},\s+\d{4})\b",
        "as_of_loose": r"(?i)As of\s+([A-Za-z]+\s+\d{1,2},\s+\d{4})",
        "heading": r"(?i)\(as of\s+([^)]+)\)\s*$",
        "current_month": r"(?i)Pipeline\s+is\s+current\s+as\s+of\s+([A-Za-z]+\s+20\d{2})",
    }
    return F.nullif(squeeze(F.regexp_extract(text_or_blank(c), patterns[profile], 1)), F.lit(""))


def date_epoch(c) -> Column:
    """Epoch seconds of 'Mon d, yyyy', 'yyyy-mm-dd' or 'm/d/yyyy'; 0 when none fits."""
    x = F.trim(text_or_blank(c))
    tries = [F.when(x.rlike(p), F.try_to_timestamp(x, F.lit(f))) for p, f in (
        (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
        (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
        (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"))]
    return F.coalesce(F.unix_timestamp(F.coalesce(*tries)), F.lit(0)).cast("double")
