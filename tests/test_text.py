"""Text rules against Python's own."""

import html
import random

from pyspark.sql import functions as F

from assetlens.functions.identity import nested_entry
from assetlens.functions.text import unescape
from assetlens.operators.html import indication_section

CASES = [None, "", "plain", "&", "&;", "a & b", "&amp;lt;", "&amp;amp;", "&ndash;&rsquo;&ge;&eacute;", "&#8217;&#x2265;&#X2265",
         "&notit;", "&notin;", "&ampfoo", "&AMP", "&unknown;", "&#0;", "&#128;&#150;&#129;", "&#xD800;", "&#x110000;",
         "&#99999999999999999999;", "&#xFFFFFFFFFFFF;", "&#1;x&#11;y&#127;z", "&#13;&#10;", "&#xFDD0;&#x1FFFE;", "&#;", "&#x;",
         "&copy2024&reg", "&fjlig;", "&NotEqualTilde;", "&#128512;", "&CounterClockwiseContourIntegral;", "&amp" + "x" * 60 + ";"]


def test_unescape(spark):
    rng = random.Random(7)
    pieces = ["&", "#", "x", "1", "50", "amp", "lt", "not", "in", ";", " ", "eacute", "Prime", "é", "&#", "&#x", "e9", "\n", "<"]
    texts = CASES + ["".join(rng.choices(pieces, k=rng.randint(1, 12))) for _ in range(3000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", unescape(F.col("t")).alias("x")).collect()
    wrong = [(texts[r.i], r.x) for r in rows
             if r.x != (None if texts[r.i] is None else html.unescape(texts[r.i]).replace(" ", " "))]
    assert not wrong, wrong[:10]


def test_indication_headings(spark):
    body = "\nThis drug is indicated for the treatment of adults with a severe disease.\nWARNINGS\nnone"
    heads = ["1 INDICATIONS AND USAGE", "indications and  usage", "INDICATIONS", "1 INDICATIONS", "2 INDICATIONS AND USAGE"]
    rows = spark.createDataFrame([(i, h + body) for i, h in enumerate(heads)], "i int, t string").select(
        "i", indication_section(F.col("t")).alias("x")).collect()
    assert [bool(r.x) for r in sorted(rows)] == [True, True, True, False, False]


def test_nested_entry(spark):
    cases = {
        "■ ABC* (anti-X (IgG) mAb) (alias) + B‡ (y (z)) severe asthma (adults)": ("ABC + B", "severe asthma (adults)"),
        "GemibotA  wrinkles (frown lines)": ("GemibotA wrinkles", ""), "GemibotA wrinkles": ("GemibotA", "wrinkles"), "Alpha* + Beta* disease": ("Alpha + Beta", "disease"),
        "(alias) ‡ lupus": ("", "lupus"), "one (open (never closed) lupus": ("one", ""), "x) y (g) ) z": ("x) y", ") z"), "A (b)(c) * (d) +  gout": ("A + gout", ""),
        "A (b) + (c) gout": ("A", "(c) gout"), "A (b) + B+C (d) + D gout": ("A + B+C + D", "gout"), "A (b) +": ("A", ""), "alone": ("", ""), "": ("", ""), None: ("", ""),
        "é😀 (x) 😀 (y) z": ("é😀", "😀 (y) z"), "A (b) ** (c) ‡gout": ("A", "gout")}
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, t string").select("i", nested_entry("t").alias("e")).select("i", "e.*").collect()
    assert {list(cases)[r.i]: (r.asset, r.indication) for r in rows} == cases
