"""Quality gates: one row per (source, gate) with severity, count and a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from .measures import top_n

SAMPLE = 20


def completeness(rows: DataFrame, source: str, missing: Column, ident: str) -> DataFrame:
    """Rows with missing core fields, with the first identifiers as sample."""
    bad = rows.withColumn("_missing", missing).filter(F.size("_missing") > 0)
    n = bad.groupBy(source).agg(F.count("*").alias("n"))
    first = top_n(bad.select(source, ident), [source], [F.col(ident)], SAMPLE)
    sample = first.groupBy(source).agg(F.array_sort(F.collect_list(ident)).alias("sample"))  # at most SAMPLE each
    return n.join(sample, source).select(source, F.lit("core_fields").alias("gate"),
                                         F.lit("issue").alias("severity"), "n", "sample")


def unknown_values(rows: DataFrame, source: str, value: str, allowed: DataFrame) -> DataFrame:
    """Values outside the controlled list."""
    bad = rows.join(F.broadcast(allowed.select(F.col(allowed.columns[0]).alias(value))), value, "left_anti")
    return bad.groupBy(source, value).agg(F.count("*").alias("n"))


def row_bounds(counts: DataFrame, config: DataFrame) -> DataFrame:
    """config(source, min_rows, max_rows) against counts(source, n); absent sources count 0."""
    d = config.join(counts, "source", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return d.withColumn("ok", F.col("n").between(F.col("min_rows"), F.col("max_rows")))


def empty_slots(rows: DataFrame, source: str, slot: str, expected: list[str]) -> DataFrame:
    """(source, slot) combinations that should have rows and have none."""
    want = rows.select(source).distinct().select(source, F.explode(F.array(*[F.lit(e) for e in expected])).alias(slot))
    return want.join(rows.select(source, slot).distinct(), [source, slot], "left_anti")


def duplicates(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def reject_rate(rejected: Column, total: Column, limit: str) -> Column:
    """True when rejections exceed max(floor, ratio of rows)."""
    floor, ratio = R.REJECT_LIMITS[limit]
    return rejected > F.greatest(F.lit(floor), F.floor(total * F.lit(ratio)).cast("int"))


def baseline_drift(actual: DataFrame, baseline: DataFrame, key: list[str]) -> DataFrame:
    """Differences to a stored profile; a warning, never an issue."""
    a, b = actual.withColumnRenamed("n", "actual"), baseline.withColumnRenamed("n", "expected")
    d = a.join(b, key, "full_outer").fillna(0, ["actual", "expected"])
    return d.filter("actual <> expected").withColumn("severity", F.lit("warning"))


def accounting(declared: DataFrame, parsed: DataFrame, key: list[str]) -> DataFrame:
    """Declared rows must equal parsed plus rejected rows."""
    d = declared.join(parsed, key, "left").fillna(0, ["parsed", "rejected"])
    return d.withColumn("balanced", F.col("declared") == F.col("parsed") + F.col("rejected"))


def layout_gate(rows: DataFrame, key: list[str]) -> DataFrame:
    """Sums of layout diagnostics and the resulting severity."""
    d = rows.groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("row_failures", "boundary_warnings", "coverage_warnings")])
    return d.withColumn("severity", F.when(F.col("row_failures") > 0, "issue").when(
        F.col("boundary_warnings") + F.col("coverage_warnings") > 0, "warning").otherwise("pass"))


def named_checks(rows: DataFrame, key: list[str], checks: dict[str, Column]) -> DataFrame:
    """Every named check over all rows of a key, and whether all hold."""
    d = rows.groupBy(*key).agg(*[F.every(c).alias(n) for n, c in checks.items()])
    ok = F.lit(True)
    for n in checks:
        ok = ok & F.col(n)
    return d.withColumn("ok", ok)


def publishable(rows: DataFrame, gates: DataFrame, source: str) -> DataFrame:
    """Rows of sources without an issue."""
    return rows.join(gates.filter("severity = 'issue'").select(source).distinct(), source, "left_anti")


def publish(rows: DataFrame, gates: DataFrame, source: str, path: str) -> None:
    """Overwrite only the partitions of clean sources, so the last good snapshot of the
    others stays."""
    (publishable(rows, gates, source).write.partitionBy(source)
     .option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path))


def pagination(pages: DataFrame, key: list[str], max_pages: int) -> DataFrame:
    """Coverage is incomplete when the last allowed page still names a next page."""
    return pages.groupBy(*key).agg(
        F.count("*").alias("pages"),
        F.coalesce(F.max(F.col("next_token").isNotNull() & (F.col("page_no") >= max_pages)), F.lit(False)).alias("truncated"))


def single_page(pages: DataFrame, doc: str, hit: Column) -> DataFrame:
    """Documents must hold exactly one matching page."""
    d = pages.groupBy(doc).agg(F.coalesce(F.sum(F.when(hit, 1)), F.lit(0)).alias("matches"))
    return d.withColumn("ok", F.col("matches") == 1)
