"""Domain semantics of the comparator on small fixtures, and its behaviour on hot keys."""

import pytest

from assetlens.operators.linkage import Linkage

ALIASES = [("Pfizer", "Pfizer Inc."), ("Vertex", "Vertex Pharmaceuticals")]
P_COLS = ("record_id string, portfolio_ordinal bigint, company string, asset string, molecule string, development_code string, "
          "brand string, indication string, controlled_indication string, phase string")
S_COLS = ("target string, company string, source_family string, source_record_id string, asset string, molecule string, "
          "development_code string, brand string, indication string, controlled_indication_candidate string, phase string")


def portfolio(spark, rows):
    return spark.createDataFrame([(r[0], i, *r[1:]) for i, r in enumerate(rows)], P_COLS)


def sources(spark, rows):
    return spark.createDataFrame([(r[0], r[0], "Company List", *r[1:]) for r in rows], S_COLS)


def run(spark, src, port, mode="qualified"):
    link = Linkage(sources(spark, src), portfolio(spark, port), spark.createDataFrame(ALIASES, "target string, alias string"), mode)
    return link, {r["source_record_id"]: r for r in link.candidates().collect()}


BASE_PORTFOLIO = [  # record, company, asset, molecule, code, brand, indication, controlled, phase
    ("rec_exact", "Pfizer", "atirmociclib", "atirmociclib", "PF-07220060", None,
     "First-line HR-positive, HER2-negative metastatic breast cancer", "Breast Cancer", "Phase 3"),
    ("rec_combo", "Pfizer", "TALZENNA + XTANDI", "talazoparib + enzalutamide", None, "TALZENNA + XTANDI",
     "HRR gene-altered metastatic castration-sensitive prostate cancer", "Prostate Cancer", "Filed / Registration"),
    ("rec_lyme", "Pfizer", "VLA15", None, "PF-07307405", None, "Prevention of Lyme disease", "Lyme Disease", "Filed / Registration"),
    ("rec_mab", None, "ALPHAMAB", "alphamab", "ABC-1234", None, "Asthma", "Asthma", "Phase 2"),
    ("rec_suffix", None, "BETA", "betamab-abcd", None, None, "Asthma", "Asthma", "Phase 2"),
    ("rec_other", None, "gammamab + deltamab", "gammamab + deltamab", None, None, "Asthma", "Asthma", "Phase 2"),
    ("rec_hcc", None, "Imfinzi", "durvalumab", None, "Imfinzi", "Hepatocellular carcinoma", "Hepatocellular carcinoma", "Phase 3"),
    ("rec_study", None, "PF-08634404", None, "PF-08634404", None, "1L Gastroesophageal (Symbiotic-GI-16)", None, "Phase 2"),
    ("rec_attr", None, "Wainua", "eplontersen", None, "Wainua", "hATTR-PN", None, "Phase 3"),
    ("vertex_cah", "Vertex Pharmaceuticals", "atumelnant", "atumelnant", "CRN04894", None,
     "Adults with classic congenital adrenal hyperplasia due to 21-hydroxylase deficiency; Phase 3 CALM-CAH",
     "Congenital Adrenal Hyperplasia", "Phase 3"),
]
BASE_SOURCES = [  # target, id, asset, molecule, code, brand, indication, controlled, phase
    ("Pfizer", "1", "atirmociclib (PF-07220060)", None, "PF-07220060", None, "1L HR+/HER2- Metastatic Breast Cancer (FourLight-3)", None, "Phase 3"),
    ("Pfizer", "2", "TALZENNA (talazoparib)", None, None, None,
     "Combo w/ XTANDI (enzalutamide) for DNA Damage Repair (DDR)-Deficient Metastatic Castration Sensitive Prostate Cancer (TALAPRO-3)", None, "Registration"),
    ("Pfizer", "3", "PF-07307405", None, "PF-07307405", None, "Lyme Disease", None, "Phase 3"),
    ("Pfizer", "4", "PF-NEW-ASSET", None, "PF-NEW-ASSET", None, "Novel Disease", None, "Phase 2"),
    ("Pfizer", "5", "PF-PH1", None, "PF-PH1", None, "Exploratory Disease", None, "Phase 1"),
    ("Pfizer", "6", "ALPHAMAB (ABC-1234)", None, None, None, "Asthma", None, "Phase 2"),
    ("Pfizer", "7", "betamab", "betamab", None, None, "Asthma", None, "Phase 2"),
    ("Pfizer", "8", "gammamab", "gammamab", None, None, "Asthma", None, "Phase 2"),
    ("Pfizer", "9", "Imfinzi", "durvalumab", None, None, "+ Imjudo HIMALAYA 1L unresectable HCC", None, "Phase 3"),
    ("Pfizer", "10", "PF-08634404", None, "PF-08634404", None, "1L Gastroesophageal Cancer (Symbiotic-GI-16)", None, "Phase 2"),
    ("Pfizer", "11", "PF-08634404", None, "PF-08634404", None, "1L Metastatic Colorectal Cancer (Symbiotic-GI-03)", None, "Phase 3"),
    ("Pfizer", "12", "Wainua", "eplontersen", None, None, "ATTRv-PN", None, "Phase 3"),
    ("Pfizer", "13", "Wainua", "eplontersen", None, None, "ATTR-CM", None, "Phase 3"),
    ("Vertex", "V1", "VX-993", None, "VX-993", None, "Diabetic Peripheral Neuropathy", None, "Phase 2"),
    ("Vertex", "V3", "atumelnant", "atumelnant", "CRN04894", None, "Cushing's Syndrome", "Cushing's Syndrome", "Phase 2"),
    ("Vertex", "V4", "atumelnant", "atumelnant", "CRN04894", None, "Congenital Adrenal Hyperplasia", "Congenital Adrenal Hyperplasia", "Phase 3"),
    ("Pfizer", "X", "atumelnant", "atumelnant", "CRN04894", None, "Congenital Adrenal Hyperplasia", "Congenital Adrenal Hyperplasia", "Phase 3"),
]
EXPECTED = {
    "1": ("MATCHED", "rec_exact"), "2": ("MATCHED", "rec_combo"), "3": ("MATCHED", "rec_lyme"), "4": ("NEW ASSET", None),
    "5": ("EXCLUDED BY RULE", None), "6": ("MATCHED", "rec_mab"), "7": ("MATCHED", "rec_suffix"), "8": ("NEW ASSET", None),
    "9": ("MATCHED", "rec_hcc"), "10": ("MATCHED", "rec_study"), "11": ("NEW INDICATION", None), "12": ("MATCHED", "rec_attr"),
    "13": ("NEW INDICATION", None), "V1": ("NEW ASSET", None), "V3": ("NEW INDICATION", None), "V4": ("MATCHED", "vertex_cah"),
    "X": ("NEW ASSET", None),
}


@pytest.fixture(scope="module")
def base(spark):
    return run(spark, BASE_SOURCES, BASE_PORTFOLIO)


def test_classes(base):
    assert {k: (r["classification"], r["matched_record_id"]) for k, r in base[1].items()} == EXPECTED


def test_details(base):
    rows = base[1]
    assert rows["1"]["match_method"] == "Composite Exact Identity" and rows["1"]["match_confidence"] == "High"
    assert rows["1"]["match_evidence"][0] == "Exact normalized source-facing indication" or "treatment-line" in " ".join(rows["1"]["match_evidence"])
    assert [d["normalized_portfolio"] for d in rows["3"]["field_deltas"]] == ["registration"]
    assert rows["2"]["match_method"] == "Composite Exact Identity"
    assert "Exact development code corroborates exact study/program code" in rows["10"]["match_evidence"]
    assert rows["5"]["decision"] == "Exclude" and rows["13"]["match_confidence"] == "Medium"


def test_records_in_rank_order(base):
    link, rows = base
    found = {r["profile"]: r["record_id"] for r in link.records().collect()}
    assert found[rows["11"]["profile"]] == "rec_study" and found[rows["1"]["profile"]] == "rec_exact"


def test_exact_mode(spark):
    port = [("a", None, "Alpha", None, None, "Alpha", "Asthma", "Airway Disease", "Phase 2"),
            ("b", None, "Beta", None, None, "Beta", "COPD", None, "Phase 2"), ("c", None, "Beta", None, None, None, "COPD", None, "Phase 3")]
    src = [("Pfizer", "1", "Alpha", None, None, None, "airway  disease", None, "Phase 2"), ("Pfizer", "2", "Beta", None, None, None, "COPD", None, "Phase II"),
           ("Pfizer", "3", "Beta", None, None, None, "", None, "Phase 3"), ("Pfizer", "4", "Gamma", None, None, "Beta", "x", None, "Phase 3")]
    rows = run(spark, src, port, "exact")[1]
    assert [rows[k]["classification"] for k in "1234"] == ["MATCHED", "POSSIBLE DUPLICATE", "NEW INDICATION", "NEW INDICATION"]
    assert rows["1"]["match_confidence"] == "Medium" and rows["3"]["decision"] == "Review"


def brute(src, port):
    """Reference outcome for plain rows: identity on asset or brand, equal indication."""
    out = {}
    for s in src:
        hits = [p for p in port if p[2] == s[2] or p[5] == s[5]]
        same = [p for p in hits if p[6] == s[6]]
        best = [p for p in same if p[8] == s[8]] or same
        out[s[1]] = ("NEW ASSET" if not hits else "NEW INDICATION" if not best else "MATCHED" if len(best) == 1 else "POSSIBLE DUPLICATE",
                     len(best) or None)
    return out


def test_hot_identity(spark):
    """A third of both sides share one asset; outcomes equal brute force."""
    words = ["red", "blue", "green", "gold", "grey", "pink", "plum"]
    port = [(f"p{i}", None, "hot" if i % 3 == 0 else f"asset{i % 17}", None, None, f"brand{i % 5}", f"{words[i % 7]} {words[i % 4]} disease", None, f"Phase {2 + i % 2}")
            for i in range(240)]
    src = [("Pfizer", f"s{i}", "hot" if i % 3 == 0 else f"asset{i % 19}", None, None, f"brand{i % 9}", f"{words[i % 7]} {words[i % 5]} disease", None, f"Phase {2 + i % 2}")
           for i in range(240)]
    rows = run(spark, src, port)[1]
    assert {k: (r["classification"], r["plausible_records"]) for k, r in rows.items()} == brute(src, port)
