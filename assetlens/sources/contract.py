"""Schemas of the linkage inputs and the projection of any frame onto them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROGRAM = {
    "target": "string", "company": "string", "source_family": "string", "source_record_id": "string",
    "source_url": "string", "source_watch_record_id": "string", "asset": "string", "molecule": "string",
    "development_code": "string", "brand": "string", "indication": "string",
    "controlled_indication_candidate": "string", "phase": "string", "program_status": "string",
    "sponsor_owner": "string", "partners": "array<string>", "source_unavailable": "boolean",
    "ownership_resolved": "boolean", "strategic_phase1": "boolean", "important_label_expansion": "boolean",
    "marketed_strategic_rx": "boolean", "generic_commodity": "boolean",
}
PORTFOLIO = {
    "record_id": "string", "portfolio_ordinal": "bigint", "company": "string", "asset": "string",
    "molecule": "string", "development_code": "string", "brand": "string", "aliases": "array<string>",
    "indication": "string", "controlled_indication": "string", "indication_aliases": "array<string>",
    "treatment_setting_line": "array<string>", "biomarker_patient_segment": "string",
    "portfolio_status": "string", "phase": "string",
}
NULLABLE_FLAG = {"ownership_resolved"}


def conform(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Project onto the contract; missing columns take the neutral value of their type."""
    def column(name, kind):
        c = F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)
        if kind.startswith("array"):
            return F.coalesce(c, F.array().cast(kind))
        if kind == "boolean" and name not in NULLABLE_FLAG:
            return F.coalesce(c, F.lit(False))
        return c
    extra = [c for c in df.columns if c not in schema]
    return df.select(*[column(n, k).alias(n) for n, k in schema.items()], *extra)


def programs_from_adapter(df: DataFrame, target: str, family: str, removed: str = "removed",
                          expansion_phases=("LCM",)) -> DataFrame:
    """Adapter rows -> contract rows: removed rows become Discontinued, life-cycle rows
    are label expansions, rows without asset, indication and phase stay out."""
    rows = df.filter((F.coalesce("asset", F.lit("")) != "") & (F.coalesce("indication", F.lit("")) != "")
                     & (F.coalesce("phase", F.lit("")) != ""))
    rows = rows.withColumns({
        "target": F.lit(target), "company": F.lit(target), "source_family": F.lit(family),
        "program_status": F.when(F.col(removed), "Discontinued").otherwise("Active"),
        "important_label_expansion": F.col("phase").isin(*expansion_phases)})
    return conform(rows, PROGRAM).drop(removed)
