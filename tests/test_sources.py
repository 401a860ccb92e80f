"""Workbook reader, review queue, layout details and JSON shapes on fixtures."""

import io
import zipfile

from pyspark.sql import functions as F

from assetlens.operators import layout as G
from assetlens.operators.staging import merge_review_queue
from assetlens.operators.workbook import read_workbook_cells, sheet_programmes


def workbook() -> bytes:
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    strings = ["Compound Number", "INN", "Indication", "Current Phase", "X-101", "alphamab", "Asthma", "Phase II/III"]
    cell = lambda ref, i: f'<c r="{ref}" t="s"><v>{i}</v></c>'
    rows = "".join(f"<row>{''.join(cell(f'{c}{r}', k * 4 + i) for i, c in enumerate(['A', 'B', 'AA', 'AB']))}</row>" for k, r in enumerate((3, 4)))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {main}>" + "".join(f"<si><t>{s}</t></si>" for s in strings) + "</sst>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/s1.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
                   '<sheets><sheet name="List" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/worksheets/s1.xml", f"<worksheet {main}><sheetData>{rows}</sheetData></worksheet>")
    return out.getvalue()


def test_workbook(spark):
    files = spark.createDataFrame([("a.xlsx", bytearray(workbook()))], "path string, content binary")
    cells = read_workbook_cells(files)
    assert {(r["col_no"], r["text"]) for r in cells.filter("row_no = 0").collect()} == {
        (0, "Compound Number"), (1, "INN"), (26, "Indication"), (27, "Current Phase")}
    row = sheet_programmes(cells, ["doc_id", "sheet"]).first()
    assert (row["asset"], row["development_code"], row["indication"], row["phase"]) == ("alphamab", "X-101", "Asthma", "Phase 3")


def test_review_queue(spark):
    cols = "id string, review_status string, classification string, decision string, programme_gate string, source_scope string, reason string, evidence string"
    existing = spark.createDataFrame([
        ("1", "Needs Review", "NEW ASSET", "Review", "g", "scope", "my reason", "my evidence"),
        ("2", "Needs Review", "POSSIBLE DUPLICATE", "Review", "g", "scope", "dup", ""),
        ("3", "Reviewed - Exclude", "EXCLUDED BY RULE", "Exclude", "g", "scope", "r", ""),
        ("4", "Resolved", "EXCLUDED BY RULE", "Exclude", "g", "scope", "r", "")], cols)
    incoming = spark.createDataFrame([(str(i), "NEW INDICATION", "Include", "m", "m", "machine", "fresh") for i in range(1, 6)],
                                     "id string, classification string, decision string, programme_gate string, source_scope string, reason string, evidence string")
    r = {x["id"]: x for x in merge_review_queue(existing, incoming).collect()}
    assert len(r) == 5 and [r[k]["action"] for k in "12345"] == ["updated"] * 4 + ["inserted"]
    assert r["1"]["reason"] == "my reason" and r["1"]["evidence"] == "my evidence" and r["1"]["latest_evidence"] == "fresh"
    assert r["2"]["classification"] == "POSSIBLE DUPLICATE" and {r[k]["decision"] for k in "34"} == {"Exclude"}
    assert r["5"]["review_status"] == "New"


def test_running_mean_differs_from_gaps_when_a_line_drifts(spark):
    drift = spark.createDataFrame([("d", 1, 2.5 * i, 0.0, i) for i in range(6)], "doc_id string, page_no int, y double, x0 double, pos int")
    exact = G.running_mean_groups(drift, G.PAGE, "y", 3.0).agg(F.max("line")).first()[0]
    gaps = G.gap_groups(drift, G.PAGE, F.col("y"), ["pos"], 3.0, "line").agg(F.max("line")).first()[0]
    assert (exact, gaps) == (3, 1)
