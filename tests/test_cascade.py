"""The evidence cascade on hand-made sources: who decides, what stays open, what each stage reads."""

import pytest
from pyspark.sql import functions as F

from assetlens.functions.text import brand_norm
from assetlens.operators import evidence as E
from assetlens.operators.cascade import EvidenceCascade, EvidenceSources


@pytest.fixture(scope="module")
def run(spark):
    products = spark.createDataFrame([
        (1, "Alpha", ["NDA000001"], ["Maker"], ["alphadine"]), (2, "Beta", ["NDA000002"], ["Maker"], ["betadine"]),
        (3, "Gamma", ["NDA000003"], ["Maker"], ["gammadine"]), (4, "Delta", [], ["Maker"], ["deltadine"]),
        (5, "Omega", [], [], []), (6, "Kappa", ["NDA000006"], [], ["kappadine"])],
        "product_id int, name string, application_numbers array<string>, sponsor_names array<string>, active_ingredients array<string>")
    labels = spark.createDataFrame([
        ("l1", "20200101", 0, ["ALPHA"], ["NDA000001"], ["Maker"], ["alphadine"], ["for a"]),
        ("l2", "20200101", 1, ["BETA"], ["NDA000002"], ["Maker"], ["betadine"], []),
        ("l3", "20210101", 2, ["Beta"], ["NDA000902"], ["Other"], ["betadine"], ["for b"]),
        ("l6", "20210101", 3, ["Kappa"], ["NDA000906"], ["Other"], ["kappadine"], ["for k"])],
        "label_id string, effective string, ordinal int, brand_names array<string>, application_numbers array<string>, manufacturers array<string>, "
        "ingredient_names array<string>, indications array<string>")
    listing = spark.createDataFrame([
        ("s1", "Gamma tablet [Maker]", "2020", [], [], ["other"], "for g", "g"),
        ("s2", "Delta (deltadine) tablet [Maker]", "2019", [], [], [], "old", "old"),
        ("s3", "DELTA deltadine [Other]", "2021", [], [], [], "for d", "d"),
        ("s4", "Delta deltadine capsule [X]", "2021", [], [], [], "for d too", "dd"),
        ("s5", "Delta deltadine capsule [Y]", "2022", [], [], [], "", "e")],
        "setid string, title string, published string, listed_apps array<string>, document_apps array<string>, ingredient_names array<string>, text string, statement string")
    titles = spark.createDataFrame([], "product_id int, title string")
    pages = spark.createDataFrame([("000003", "<h1>Gamma gammadine</h1><a href='/drugsatfda_docs/label/2024/3s1lbl.pdf'>x</a>")], "application string, html string")
    texts = spark.createDataFrame([("https://www.accessdata.fda.gov/drugsatfda_docs/label/2024/3s1lbl.pdf",
                                    "Gamma tablets\nINDICATIONS AND USAGE\nis indicated for the treatment of gamma disease\nWARNINGS\nx")], "url string, text string")
    families = spark.createDataFrame([("beta", "NDA000002", ["betadine"]), ("beta", "NDA000902", ["betadine", "more"])],
                                     "brand_key string, application string, ingredients array<string>")
    out = EvidenceCascade(products, EvidenceSources(labels, listing, titles, pages, texts, families))
    return out, {r.product_id: r for r in out.run().collect()}


def test_who_decides(run):
    got = {k: (r.stage, r.status) for k, r in run[1].items()}
    assert got == {1: ("application", "Matched"), 2: ("brand", "Matched"), 3: ("application_page", "Matched"),
                   4: ("spl_brand", "Ambiguous"), 5: ("application", "Not Found"), 6: ("application", "Not Found")}


def test_trail_holds_every_stage_that_ran(run):
    assert run[1][1].trail == ["application=Matched"]
    assert run[1][2].trail == ["application=No Indication Text", "brand=Matched"]
    assert run[1][6].trail == ["application=Not Found", "application_page=Not Found", "brand=Application Mismatch", "spl=Not Found", "spl_brand=Not Found"]


def test_stages_read_what_is_open(run):
    read = {name: sorted(r[0] for r in d.select("product_id").collect()) for name, d in run[0].verdicts.items()}
    assert read == {"application": [1, 2, 3, 4, 5, 6], "brand": [2, 3, 4, 5, 6], "spl": [3, 4, 5, 6], "spl_brand": [3, 4, 5, 6],
                    "application_page": [3, 5, 6]}
    counts = {(r.stage, r.status): r.products for r in run[0].diagnostics().collect()}
    assert counts[("brand", "Application Mismatch")] == 1 and sum(v for (s, _), v in counts.items() if s == "spl") == 4


def test_title_is_evidence(run):
    # The newest document with text decides; only its title names the ingredient, and two of that date disagree.
    row = run[1][4]
    assert (row.effective, row.statements, row.confidence) == ("2021", 2, "Medium")


def test_family_flags(spark):
    families = spark.createDataFrame([("b", "NDA000001", ["x", "y"]), ("b", "NDA000002", ["x"])], "brand_key string, application string, ingredients array<string>")
    chosen = spark.createDataFrame([(1, ["b"], ["x"], ["000001"], ["NDA000002"]), (2, ["b"], ["y"], ["NDA000001"], ["NDA000002"]),
                                    (3, ["c"], ["x"], ["NDA000001"], []), (4, ["b"], [], ["NDA000001"], ["NDA000002"])],
                                   "product_id int, brands array<string>, ingredients array<string>, given array<string>, found array<string>")
    got = {r.product_id: (r.given_in, r.found_in) for r in E.family_flags(chosen, families).collect()}
    assert got == {1: (True, True), 2: (True, False), 3: (False, False), 4: (False, False)}
    assert chosen.select(brand_norm(F.lit("B®"))).first()[0] == "b"
