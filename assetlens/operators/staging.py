"""Candidate sinks and the review-queue merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from .ordered import Ordered

GUARDRAILS = {  # fixed values
    "master_writes": False, "fuzzy_matching": False, "deterministic_clinical_normalization": True,
    "component_aware_combination_matching": True, "ambiguous_identity_fails_closed": True,
    "ambiguous_ownership_fails_closed": True, "phase_status_deltas_are_read_only": True,
    "portfolio_mutation": False, "hybrid_phase_aware": True, "integrated_phase_2_plus_included": True,
    "deterministic_identity_variants": True, "component_inference_from_composite_identity": False,
}


def guardrails() -> Column:
    return F.struct(*[F.lit(v).alias(k) for k, v in GUARDRAILS.items()])


def with_guardrails(df: DataFrame) -> DataFrame:
    return df.withColumn("guardrails", guardrails())


def stage_subset(candidates: DataFrame) -> DataFrame:
    return candidates.filter(F.col("classification").isin(R.STAGE_CLASSES))


EXPORT = ["candidate_id", "target", "source_family", "source_record_id", "source_url", "source_watch_record_id",
          "asset", "molecule", "development_code", "brand", "indication", "controlled_indication_candidate", "phase",
          "program_status", "sponsor_owner", "partners", "classification", "decision", "inclusion_basis",
          "review_reason", "matched_record_id", "plausible_records", "match_method", "match_confidence",
          "match_evidence", "field_deltas"]


def staged_export(candidates: DataFrame, order: list[str]) -> DataFrame:
    """Review classes with a global ordinal and the total, one JSON line each when written.

    The ordinal is a chunked running count, not a single-partition window."""
    staged = stage_subset(candidates).select(*EXPORT)
    total = staged.agg(F.count("*").alias("total"))
    return Ordered(staged, [], order).ordinal("ordinal").frame().crossJoin(F.broadcast(total))


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def page(df: DataFrame, order: list[str], offset: int, limit: int, cap: int = 50) -> DataFrame:
    """One page with the total and the offset of the next page (NULL on the last)."""
    limit = max(1, min(limit, cap))
    total = df.agg(F.count("*").alias("total_rows"))
    rows = df.orderBy(*order).offset(offset).limit(limit)
    following = F.lit(offset + limit).cast("long")
    return rows.crossJoin(F.broadcast(total)).withColumn(
        "next_offset", F.when(following < F.col("total_rows"), following))


CURATED = ["programme_gate", "source_scope", "reason", "evidence"]


def merge_review_queue(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Upsert by ``id``: curated columns stay, machine evidence is refreshed beside them,
    resolved duplicates and exclusions keep their outcome, fresh rows get status New."""
    e, i = existing.alias("e"), incoming.alias("i")
    both = e.join(i, F.col("e.id") == F.col("i.id"), "full_outer")
    known, fresh = F.col("e.id").isNotNull(), F.col("i.id").isNotNull()
    status = F.col("e.review_status")
    excluded = known & (status.isin("Reviewed - Exclude") | ((status == "Resolved") & (F.col("e.decision") == "Exclude")))
    duplicate = known & (F.col("e.classification") == "POSSIBLE DUPLICATE") & ~status.isin("Resolved")
    cls = (F.when(excluded, "EXCLUDED BY RULE").when(duplicate, F.col("e.classification"))
           .otherwise(F.coalesce("i.classification", "e.classification")))
    decision = F.when(excluded, "Exclude").when(duplicate, F.col("e.decision")).otherwise(
        F.coalesce("i.decision", "e.decision"))
    curated = [F.when(known & (F.coalesce(F.col(f"e.{c}"), F.lit("")) != ""), F.col(f"e.{c}"))
               .otherwise(F.col(f"i.{c}")).alias(c) for c in CURATED]
    return both.select(
        F.coalesce("e.id", "i.id").alias("id"),
        F.when(known & fresh, "updated").when(known, "kept").otherwise("inserted").alias("action"),
        F.when(known, status).otherwise("New").alias("review_status"), cls.alias("classification"),
        decision.alias("decision"), *curated, F.col("i.evidence").alias("latest_evidence"))
