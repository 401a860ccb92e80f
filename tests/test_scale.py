"""Plans that keep the work of a document or a row where it is."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from assetlens.functions import identity as I
from assetlens.functions import text as T
from assetlens.operators import html as H
from assetlens.operators.spatial import near_pairs

def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["N06_ordered_distinct", "S11_dedupe_nodes", "G01_line_groups", "G01_drifting_lines", "G24_drifting_bands", "G02_reading_text"])
def test_words_of_a_document_stay_together(spark, name, tmp_path):
    spark.createDataFrame([(1, "a b c a"), (2, "d e"), (3, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert _plan(entry.queries()[name](spark, str(tmp_path))).count("Exchange") == 1


def test_no_side_of_near_pairs_is_broadcast(spark):
    d = spark.range(5).select(F.col("id").alias("doc_id"), F.lit(1.0).alias("y"))
    pairs = near_pairs(d, d.withColumnRenamed("y", "ny"), ["doc_id"], "y", "ny", 3.0)
    assert "Broadcast" not in _plan(pairs) and pairs.count() == 5


def test_clinical_text_is_normalised_once(spark):
    d = spark.createDataFrame([("neoadjuvant x",), ("post-transplant maintenance",), ("",), (None,)], "t string")
    flags = d.select(I.qualifier_flags(T.clinical_norm("t")).alias("f"))
    once = d.select(T.clinical_norm("t").alias("f"))
    count = lambda q: q._jdf.queryExecution().optimizedPlan().toString().lower().count("myasthenia")
    assert count(flags) <= count(once) + 1
    assert [r.f for r in flags.collect()] == [["adjuvant", "neoadjuvant"], ["maintenance", "transplant-maintenance"], [], []]


def test_section_end_is_looked_for_once(spark):
    label = "1 INDICATIONS AND USAGE\nis indicated for the treatment of adults with x\n2 DOSAGE AND ADMINISTRATION\ny"
    d = spark.createDataFrame([(label,), ("none",), (None,)], "t string").select(H.indication_section("t").alias("s"))
    assert d._jdf.queryExecution().optimizedPlan().toString().count("4\\s+CONTRAINDICATIONS") == 1
    assert [r.s for r in d.collect()] == ["1 INDICATIONS AND USAGE is indicated for the treatment of adults with x", "", ""]
