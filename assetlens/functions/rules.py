"""Rule tables shared by the operators.

Fixed values: every list, pattern and number in this module must equal the
published behaviour that the engine reproduces, so they are stated literally.
"""

# ---- characters --------------------------------------------------------
DASHES = "\u2010\u2011\u2012\u2013\u2014\u2212"
# Python's notion of white space, spelled out because Java's \s is ASCII only.
WS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"

# ---- companies ---------------------------------------------------------
CORPORATE_SUFFIXES = [
    "inc", "incorporated", "corp", "corporation", "company", "co",
    "limited", "ltd", "plc", "llc", "pharmaceutical", "pharmaceuticals",
    "therapeutics", "biopharma", "biotechnology",
]

# ---- clinical normalisation, applied in this order -----------------------
POLYNEUROPATHY = "hereditary transthyretin amyloidosis with polyneuropathy"
POLYNEUROPATHY_FULL = (
    r"(?i)\b(?:hereditary\s+transthyretin(?:-\s*|\s+)mediated\s+amyloid\s+polyneuropathy"
    r"|hereditary\s+transthyretin(?:-\s*|\s+)mediated\s+amyloidosis\s+with\s+polyneuropathy"
    r"|hereditary\s+transthyretin\s+amyloidosis\s+with\s+polyneuropathy)\b"
)
POLYNEUROPATHY_SHORT = r"(?i)\b(?:hATTR[- ]?PN|ATTRv[- ]?PN)\b"
POLYNEUROPATHY_PAREN = r"(?i)\(\s*(?:hATTR[- ]?PN|ATTRv[- ]?PN)\s*\)"

RECEPTOR_POLARITY = [
    (r"(?i)(?<![A-Za-z0-9])HR\s*[- ]\s*positive\b", "HR positive"),
    (r"(?i)(?<![A-Za-z0-9])HR\s*[- ]\s*negative\b", "HR negative"),
    (r"(?i)(?<![A-Za-z0-9])HER2\s*[- ]\s*positive\b", "HER2 positive"),
    (r"(?i)(?<![A-Za-z0-9])HER2\s*[- ]\s*negative\b", "HER2 negative"),
    (r"(?i)(?<![A-Za-z0-9])HR\s*\+(?![A-Za-z0-9])", "HR positive"),
    (r"(?i)(?<![A-Za-z0-9])HR\s*-(?![A-Za-z0-9])", "HR negative"),
    (r"(?i)(?<![A-Za-z0-9])HER2\s*\+(?![A-Za-z0-9])", "HER2 positive"),
    (r"(?i)(?<![A-Za-z0-9])HER2\s*-(?![A-Za-z0-9])", "HER2 negative"),
]
SPELLING = [
    ("tumours", "tumors"),
    ("tumour", "tumor"),
    ("leukaemia", "leukemia"),
    ("haemoglobin", "hemoglobin"),
    ("oesophageal", "esophageal"),
    ("paediatric", "pediatric"),
    ("generalised", "generalized"),
    ("hyperkalaemia", "hyperkalemia"),
]
ABBREVIATIONS = [
    ("nsclc", "non small cell lung cancer"),
    ("sclc", "small cell lung cancer"),
    ("hcc", "hepatocellular carcinoma"),
    ("mcrc", "metastatic colorectal cancer"),
    ("crc", "colorectal cancer"),
    ("mcrpc", "metastatic castration resistant prostate cancer"),
    ("mcspc", "metastatic castration sensitive prostate cancer"),
    ("dlbcl", "diffuse large b cell lymphoma"),
    ("cll", "chronic lymphocytic leukemia"),
    ("mcl", "mantle cell lymphoma"),
    ("chl", "classical hodgkin lymphoma"),
    ("btc", "biliary tract cancer"),
    ("pnh", "paroxysmal nocturnal hemoglobinuria"),
    ("gmg", "generalized myasthenia gravis"),
    ("attr[- ]?cm", "transthyretin amyloid cardiomyopathy"),
    ("copd", "chronic obstructive pulmonary disease"),
    ("crswnp", "chronic rhinosinusitis with nasal polyps"),
    ("mibc", "muscle invasive bladder cancer"),
    ("nmibc", "non muscle invasive bladder cancer"),
    ("rrmm", "relapsed refractory multiple myeloma"),
]
ANNOTATIONS = [
    r"\(\s*biologic\s*\)",
    r"\([^)]*(?:orphan|fast\s*track|prime|breakthrough|priority\s*review|rpd)[^)]*\)",
]
LINE_SHORTHAND = [
    (r"\b1l\b", "first line"),
    (r"\b2l\+\b", "second line plus"),
    (r"\b2l\b", "second line"),
    (r"\b3l\+\b", "third line plus"),
    (r"\b3l\b", "third line"),
    (r"\bhr\+\b", "hr positive"),
    (r"\bhr-\b", "hr negative"),
    (r"\bher2\+\b", "her2 positive"),
    (r"\bher2-\b", "her2 negative"),
    (r"\brr\b", "relapsed refractory"),
]
LINE_QUALIFIERS = [
    (r"\b(?:1l|first[- ]line)\b", "1L"),
    (r"\b(?:2l\+|second[- ]line\s*plus)\b", "2L+"),
    (r"\b(?:2l|second[- ]line)\b", "2L"),
    (r"\b(?:3l\+|third[- ]line\s*plus)\b", "3L+"),
    (r"\b(?:3l|third[- ]line)\b", "3L"),
]
# (flag, any of these groups; a group is a list of phrases that must all occur)
QUALIFIER_FLAGS = [
    ("transplant-maintenance", [["post transplant"], ["transplant", "maintenance"]]),
    ("transplant-ineligible", [["transplant ineligible"]]),
    ("post-cd38", [["post cd38"], ["post cd 38"]]),
    ("double-class-exposed", [["double class exposed"]]),
    ("adjuvant", [["adjuvant"]]),
    ("neoadjuvant", [["neoadjuvant"]]),
    ("maintenance", [["maintenance"]]),
    ("metastatic", [["metastatic"]]),
    ("early-stage", [["early breast cancer"], ["early stage breast cancer"]]),
]
STUDY_FAMILIES = "mm|ev|dv|mevpro|fourlight|talapro|her2climb|symbiotic|mountaineer|padl1nk|be6a"

DISEASE_TERMS = [  # second profile: short disease terms
    (r"\bnon small cell lung cancer\b", "nsclc"),
    (r"\btype 2 diabetes mellitus\b", "type 2 diabetes"),
    (r"\bt2dm\b", "type 2 diabetes"),
    (r"\bt2d\b", "type 2 diabetes"),
    (r"\bobstructive sleep apnoea\b", "obstructive sleep apnea"),
    (r"\bosa\b", "obstructive sleep apnea"),
    (r"\bosteoarthritis\b", "oa"),
    (r"\bcardiovascular\b", "cv"),
    (r"\bchronic kidney disease\b", "ckd"),
    (r"\balzheimer'?s\b", "alzheimer"),
    (r"\bleukaemia\b", "leukemia"),
    (r"\btumours\b", "tumors"),
    (r"\boverweight\b", "obesity"),
]
EXTRACTION_FIXES = [
    ("PF-086425343", "PF-08642534"),
    ("PF-072612711", "PF-07261271"),
    ("Dekavil2", "Dekavil"),
    ("MET-815i2", "MET-815i"),
    ("PF-08654696", "PF-08654698"),
]

# ---- commercial rules and linkage ----------------------------------------
CLASSES = [
    "EXCLUDED BY RULE", "MATCHED", "NEW ASSET", "NEW INDICATION",
    "OWNERSHIP REVIEW", "POSSIBLE DUPLICATE", "SOURCE UNAVAILABLE",
]
STAGE_CLASSES = ["NEW ASSET", "NEW INDICATION", "POSSIBLE DUPLICATE", "OWNERSHIP REVIEW"]
STOPPED_STATUS = ["inactive", "discontinued", "terminated", "withdrawn", "suspended permanently"]
EXACT_MODE_PHASES = ["phase 2", "phase 2 3", "phase 3", "filed", "registration", "filed registration"]
SCORE_EXACT, SCORE_CONTROLLED, SCORE_CONTAINED, SCORE_PHRASE = 100, 95, 82, 72
SCORE_STUDY, SCORE_CODE, SCORE_LINE, SCORE_LINE_CONFLICT = 30, 15, 18, -15
SCORE_FLAG, SCORE_FLAG_MAX, SCORE_PHASE = 6, 18, 12
PLAUSIBLE, MEDIUM = 72, 60
METHODS = [  # key kind, label, in priority order
    ("code", "Exact Development Code"),
    ("molecule", "Exact Molecule / INN"),
    ("brand", "Exact Brand"),
    ("asset", "Exact Asset"),
    ("alias", "Verified Alias"),
    ("combo", "Exact Combination Components"),
]

# ---- identities ------------------------------------------------------------
BIOLOGIC_SUFFIX = r"(?i)^([A-Za-z][A-Za-z0-9]*?(?:mab|cept|grastim|poetin|tide))-[a-z]{4}$"
TRAILING_PAREN = r"^(.+?)\s*\(([^()]*)\)\s*$"
CODE_PROFILES = {  # profile -> ordered patterns
    "bms": [r"(?i)\bBMS[-\u2010-\u2015 ]?\d{5,9}\b"],
    "pf": [r"(?i)\bPF[-\u2010-\u2015]?\d{5,8}\b"],
    "ly": [r"(?i)\bLY[- ]?\d{6,9}\b"],
    "amg": [r"(?i)\b(?:AMG|ABP)[ -]?\d{2,4}\b"],
    "abbv": [
        r"(?i)\bABBV[- ]?\d{2,5}\b", r"(?i)\bAGN[- ]?\d{3,8}\b", r"(?i)\bAPG[- ]?\d{2,6}\b",
        r"(?i)\bKST[- ]?\d{2,6}\b", r"(?i)\bSIM\d{3,6}\b", r"(?i)\bUB[- ]?VV\d{2,5}\b",
        r"(?i)\bRC\d{2,6}\b",
    ],
    "bnt": [
        r"(?i)\bBNT\s*[-/]?\s*\d{2,5}\b", r"(?i)\bGEN\s*[-/]?\s*\d{2,5}\b",
        r"(?i)\bDB\s*[-/]?\s*\d{2,5}\b", r"(?i)\bYL\s*[-/]?\s*\d{2,5}\b",
        r"(?i)\bONC\s*[-/]?\s*\d{2,5}\b",
    ],
    "az": [r"(?i)\b(?:AZD\d+|ALXN\d+|MEDI[- ]?\d+|IPH\d+|JAB-[A-Za-z0-9]+|NT-\d+|FPI-\d+|PT\d+|ZS-\d+)\b"],
}
STUDY_TOKEN = (
    r"(?i)^(?:[A-Z][A-Za-z0-9]*[-]?[A-Za-z]*\d+[A-Za-z0-9-]*|"
    r"(?:ARTEMIDE|SERENA|CAMBRIA|DESTINY|TROPION|PACIFIC|CAPItello|EvoPAR|SOUNDTRACK|CLARITY|eVOLVE|"
    r"BaxHTN|BaxPA|CLEAR|TULIP|NAVIGATOR|OBERON|TITANIA|PROSPERO|MIRANDA|CALYPSO|PREVAIL|CARES|"
    r"DepleTTR|AUTUMN|CONCORD|TRANSCEND|DURGA|TREVI|VECTRA|ESCALADE|AMPLIFY|ECHO|KALOS|LOGOS|THARROS|"
    r"DAISY|IRIS|JASMINE|LAVENDER|CROSSING|EMBARK|JOURNEY|WAYPOINT|AWAKE)(?:[-_][A-Za-z0-9]+|\d+)*)$"
)
ATTACHED_STUDY = (
    r"(?<=[A-Za-z0-9])(?=(?:ARTEMIDE|SERENA|CAMBRIA|DESTINY|TROPION|PACIFIC|CAPItello|EvoPAR|SOUNDTRACK|"
    r"CLARITY|eVOLVE|BaxHTN|BaxPA|CLEAR|TULIP|NAVIGATOR|OBERON|TITANIA|PROSPERO|MIRANDA|CALYPSO|PREVAIL|"
    r"CARES|DepleTTR|AUTUMN|CONCORD|TRANSCEND|DURGA|TREVI|VECTRA|ESCALADE|AMPLIFY|ECHO|KALOS|LOGOS|"
    r"THARROS|DAISY|IRIS|JASMINE|LAVENDER|CROSSING|EMBARK|JOURNEY|WAYPOINT|AWAKE|AZURE|POTOMAC|KUNLUN|"
    r"VOLGA|NILE|MATTERHORN|POSEIDON|NeoCOAST|HIMALAYA|SAFFRON|ADAURA|ORCHARD)(?:[-0-9]|\b))"
)
DRUG_SUFFIX = (
    r"(?i)(?:mab|zumab|limab|imab|tecan|vedotin|paratide|guraxetan|samrotecan|estrant|stat|renone|"
    r"glipron|mirsen|limab|cept)$"
)
SOURCE_QUALIFIERS = ["china", "platform"]
IDENTITY_STOP_TERMS = [
    "pipeline", "phase 1", "phase 2", "phase 3", "phase 4", "registration", "regulatory",
    "haematology", "hematology", "immunology", "lipids", "nephrology", "oncology",
    "rare diseases", "rare disease", "neuroscience", "filters", "reset", "program", "programme",
    "potential indications", "potential indication s",
]
IDENTITY_STOP_PREFIXES = [
    "updated ", "last updated ", "major ongoing clinical studies", "download", "overview",
    "clinical trials",
]
NOT_A_CODE = ["development code", "generic name", "brand name", "type of drug", "modality"]
NOT_A_PLACEHOLDER = ["phase", "nme", "nmes", "ai", "ais", "us", "eu"]
BRAND_USE_ENDINGS = ["for intravenous use", "for oral use", "for injection"]
BRAND_FORM_ENDINGS = ["tablet", "tablets", "capsule", "capsules", "injection"]
BLOCK_TAGS = [
    "address", "article", "aside", "blockquote", "br", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h[1-6]", "header", "hr", "li", "main", "nav", "ol", "p", "pre", "section", "table", "tbody",
    "td", "tfoot", "th", "thead", "tr", "ul",
]
INDICATION_STARTS = ["1 INDICATIONS AND USAGE", "INDICATIONS AND USAGE", "INDICATIONS"]
INDICATION_ENDS = [
    "2 DOSAGE AND ADMINISTRATION", "DOSAGE AND ADMINISTRATION", "4 CONTRAINDICATIONS", "CONTRAINDICATIONS", "WARNINGS",
]
BRAND_STOP = ["for", "and", "the", "injection", "tablet", "tablets", "capsule", "capsules"]
LEAFLET_WORDS = [
    "medication guide", "patient information", "patient leaflet", "instructions for use", "ifu",
]
PRESENTATION_RULES = [
    (r"\binhaler\b", r"\binhalant\b|\binhaler\b"),
    (r"\bns\b", r"\bspray\b|\bmetered\b|\bnasal\b"),
    (r"\bnebulizer\b", r"\bnebul"),
    (r"\bcr\b", r"\bextended release\b|\bcr\b"),
    (r"\biv\b", r"\binjection\b|\bintravenous\b"),
    (r"\binjection\b", r"\binjection\b"),
    (r"\btablets?\b", r"\btablets?\b"),
    (r"\bcapsules?\b", r"\bcapsules?\b"),
]
INTERVENTION_TYPES = ["DRUG", "BIOLOGICAL", "GENETIC", "COMBINATION_PRODUCT"]
CONTROL_TERMS = r"(?i)\b(placebo|sham|control|standard of care|standard-of-care|soc only|vehicle)\b"
SUPPORTIVE_TERMS = (
    r"(?i)\b(adjuvant therapy|prophylactic therapy|supportive therapy|im therapy|blocker|antipyretic|"
    r"premedication|cornstarch|dietary therapy|saline|vehicle)\b"
)
ACTIVE_TRIAL_STATUS = [
    "RECRUITING", "NOT_YET_RECRUITING", "ACTIVE_NOT_RECRUITING", "ENROLLING_BY_INVITATION",
]
TRIAL_STATUS = {
    "RECRUITING": "Recruiting",
    "NOT_YET_RECRUITING": "Not yet recruiting",
    "ACTIVE_NOT_RECRUITING": "Active, not recruiting",
    "ENROLLING_BY_INVITATION": "Enrolling by invitation",
    "COMPLETED": "Completed",
    "TERMINATED": "Terminated",
    "WITHDRAWN": "Withdrawn",
    "SUSPENDED": "Suspended",
    "UNKNOWN": "Unknown",
}
TRIAL_PHASE_RANK = {
    "EARLY_PHASE1": 1, "PHASE1": 1, "PHASE1|PHASE2": 2, "PHASE2": 2, "PHASE2|PHASE3": 3,
    "PHASE3": 3, "PHASE4": 4,
}

# ---- headings and headers ------------------------------------------------
PHASE_HEADINGS = {
    "area_list": {
        "phase i": "Phase 1", "phase 1": "Phase 1", "phase ii": "Phase 2", "phase 2": "Phase 2",
        "phase iii": "Phase 3", "phase 3": "Phase 3", "lcm projects": "LCM", "lcm project": "LCM",
        "under review": "Registration", "registration": "Registration",
    },
    "clinical_list": {
        "pre-clinical": "Preclinical", "preclinical": "Preclinical", "phase 1": "Phase 1",
        "phase 2": "Phase 2", "phase 3": "Phase 3", "clinical": "Clinical",
        "under regulatory review": "Filed / Registration", "approved": "Approved",
    },
    "stage_bar": {
        "preclinical": "Preclinical", "phase 1": "Phase 1", "proof of concept": "Phase 2",
        "registrational": "Phase 3", "commercial": "Approved",
    },
    "card_state": {"1": "Phase 1", "2": "Phase 2", "3": "Phase 3", "r": "Filed / Registration"},
    "rendered": {
        "regulatory approval achieved": "Regulatory Approval Achieved",
        "regulatory review": "Regulatory Review", "phase 3": "Phase 3", "phase 2": "Phase 2",
        "phase 1": "Phase 1",
    },
}
AREA_HEADINGS = {
    "oncology": "Oncology",
    "cardiovascular, renal and metabolism": "Cardiovascular, Renal and Metabolism",
    "respiratory & immunology": "Respiratory & Immunology",
    "respiratory and immunology": "Respiratory & Immunology",
    "rare disease": "Rare Disease",
    "infectious disease": "Infectious Disease",
    "other": "Other",
}
AREA_KEYWORDS = [
    ("inflammation and immunology", "Inflammation & Immunology"),
    ("internal medicine", "Internal Medicine"),
    (r"\boncology\b", "Oncology"),
    (r"\bvaccines?\b", "Vaccines"),
]
FOCUS_AREAS = [
    "Multiple Myeloma", "Lymphoma", "Leukemia", "Sickle Cell Disease", "Prostate Cancer",
    "Lung Cancer", "Solid Tumors", "Breast Cancer", "Urothelial Cancer",
    "Hepatocellular Carcinoma", "Pancreatic Cancer", "Renal Cell Carcinoma", "Colorectal Cancer",
    "Gastric Cancer",
]
MARKER_AREAS = {
    "cardiovascular": "Cardiovascular", "hematology": "Hematology", "immunology": "Immunology",
    "neuroscience": "Neuroscience", "oncology": "Oncology",
}
PHASE_MARKER = r"(?i)\b(Phase\s*([123])\s+in\s+Progress|Registration\s*(?:\(([^)]*)\))?)\b"
JSON_FIELDS = {
    "asset": ["asset", "name", "drug_name", "drugname", "compound", "molecule", "program",
              "programme", "product", "candidate", "medicine"],
    "indication": ["indication", "investigational_indication", "desc", "disease",
                   "disease_indication", "condition"],
    "phase": ["phase", "stage", "development_stage", "developmentstage", "clinical_phase",
              "clinicalphase"],
    "therapeuticArea": ["therapeutic_area", "therapeuticarea", "therapy_area", "disease_areas",
                        "disease_area", "diseasearea"],
    "partners": ["partner", "partners", "collaboration", "collaborator", "licensee"],
    "target": ["target", "generic", "mechanism", "mechanism_of_action", "mechanismofaction"],
    "developmentCode": ["development_code", "developmentcode", "code", "project_code",
                        "program_code", "programme_code"],
    "brand": ["brand", "brand_name", "brandname"],
}
JSON_CONTAINERS = ["records", "items", "results", "data", "pipeline", "programmes", "programs"]
JSON_NESTED = ["records", "items", "results", "data"]
TABLE_HEADERS = {
    "asset": ["program", "programme", "compound", "compound name", "asset", "product", "medicine", "drug"],
    "molecule": ["molecule", "inn", "generic name"],
    "developmentCode": ["development code", "code", "project code"],
    "brand": ["brand", "brand name"],
    "indication": ["indication", "potential indication", "potential indications", "disease"],
    "phase": ["phase", "clinical phase", "stage"],
    "study": ["trial", "study", "clinical trial"],
    "therapeuticArea": ["therapy area", "therapeutic area", "disease area"],
    "partners": ["partner", "partners", "collaboration"],
}
SHEET_HEADERS = {
    "developmentCode": ["compound number", "compound no", "compound", "development code",
                        "project code", "code"],
    "molecule": ["inn generic name", "inn", "generic name", "molecule"],
    "brand": ["brand name", "brand"],
    "therapeuticArea": ["therapeutic area", "therapy area", "disease area"],
    "indication": ["indication", "potential indication", "disease"],
    "phase": ["current phase", "phase", "clinical phase", "stage"],
    "mechanismOfAction": ["mode of action vaccine type", "mode of action", "mechanism of action",
                          "moa", "vaccine type"],
    "partner": ["in license or other alliance relationship with third party", "partner",
                "partners", "alliance"],
    "notes": ["footnotes", "notes", "note"],
}

# ---- quality gates -------------------------------------------------------
REJECT_LIMITS = {"a": (3, 0.10), "b": (3, 0.15), "c": (3, 0.20), "d": (5, 0.25), "e": (0, 0.0)}


def spaced(phrase: str) -> str:
    """Pattern of a phrase with any white space between its words."""
    return r"\s+".join(phrase.split(" "))
