"""Spreadsheet cells and the rows below their semantic header."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import phase as P
from ..functions import rules as R
from .html import mapped_rows

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(ref: str) -> int:
    value = 0
    for ch in re.match("[A-Z]*", ref or "").group():
        value = value * 26 + ord(ch) - 64
    return value - 1


def _sheet_cells(data: bytes):
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            for item in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(MAIN + "si"):
                shared.append("".join(t.text or "" for t in item.iter(MAIN + "t")))
        targets = {r.get("Id"): r.get("Target").lstrip("/") for r in
                   ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(MAIN + "sheet"):
            path = targets[sheet.get(REL)]
            path = path if path.startswith("xl/") else "xl/" + path
            for row_no, row in enumerate(ElementTree.fromstring(z.read(path)).iter(MAIN + "row")):
                for cell in row.iter(MAIN + "c"):
                    if cell.get("t") == "inlineStr":
                        text = "".join(t.text or "" for t in cell.iter(MAIN + "t"))
                    else:
                        text = cell.findtext(MAIN + "v") or ""
                        if cell.get("t") == "s" and text:
                            text = shared[int(text)]
                    if text.strip():
                        yield sheet.get("name"), row_no, _column(cell.get("r")), " ".join(text.split())


def read_workbook_cells(files: DataFrame) -> DataFrame:
    """binaryFile rows -> (doc_id, sheet, row_no, col_no, text)."""
    def parse(batches):
        for b in batches:
            yield pd.DataFrame([(p, *c) for p, d in zip(b["path"], b["content"]) for c in _sheet_cells(d)],
                               columns=["doc_id", "sheet", "row_no", "col_no", "text"])
    return files.select("path", "content").mapInPandas(
        parse, "doc_id string, sheet string, row_no int, col_no int, text string")


def useful_sheet(fields: Column) -> Column:
    has = lambda f: F.array_contains(fields, f)
    return has("indication") & has("phase") & (has("molecule") | has("brand") | has("developmentCode"))


def sheet_programmes(cells: DataFrame, group: list[str]) -> DataFrame:
    """Rows below the header (searched in the first 12 rows): asset is molecule, brand or
    code; a yes/no partner cell is a flag; rows that lack a core field are marked."""
    d = mapped_rows(cells, group, R.SHEET_HEADERS, True, 12, useful_sheet).filter("filled > 0")
    asset = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("molecule", "brand", "developmentCode")], F.lit(""))
    d = d.withColumn("asset", asset).withColumn("phase", P.sheet("phase"))
    flag = F.lower("partner").isin("yes", "no", "y", "n")
    return d.select(*group, "row_no", "asset", "molecule", "brand", F.col("developmentCode").alias("development_code"), "indication", "phase",
                    F.col("therapeuticArea").alias("area"), F.when(flag, "").otherwise(F.col("partner")).alias("partner"),
                    F.lower("partner").isin("yes", "y").alias("partnered"),
                    ((F.col("asset") == "") | (F.col("indication") == "") | (F.col("phase") == "")).alias("rejected"))
