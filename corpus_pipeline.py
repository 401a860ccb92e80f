"""Corpus pipeline: toxicity, near-copies, repeated passages, benchmark leaks, mixing rates.

Every stage is (spark, docs, sf_dir) -> DataFrame. All but the last return the columns of
documents; the last adds n_tokens and rate. Null and empty texts pass every filter. Rows without
doc_id pass the near-copy stage, since nothing names them; identical rows are kept once there.
An empty input gives an empty output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlens.llm.common import written
from assetlens.llm.decontaminate import decontaminate
from assetlens.llm.mixing import mix_to_targets
from assetlens.llm.ngram_join import ngram_jaccard_join
from assetlens.llm.suffix_dedup import suffix_array_dedup
from assetlens.llm.toxicity import toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    scored = toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near-copies."""
    found = ngram_jaccard_join(docs.select("doc_id", "text"))
    copies = found.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(copies, "doc_id", "left_anti").select(*docs.columns)
    return kept.dropDuplicates(["doc_id", "text"])


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of repeated passages; a character that is cut in two goes."""
    found = suffix_array_dedup(docs)
    text = F.replace(F.make_valid_utf8(F.col("kept").cast("string")), F.lit("�"), F.lit(""))
    text = F.when(F.col("n_removed") > 0, text).otherwise(F.col("text"))
    out = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.where("n_hit = 0").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the rate at which it should be drawn, 0 included.

    Toxic documents are gone, so the targets are those of the domains without them, scaled to a sum of 1.
    """
    found = mix_to_targets(docs, table(spark, sf_dir, "labels").where("toxic = 0"))
    return found.select(*docs.columns, "n_tokens", "rate")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("mixing", mix),
]

#: The classifier and the fitted rates are not SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), spark)
    return STAGES[-1][1](spark, docs, sf_dir)
