"""Queries that must take every row, long texts included."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_indication_section_takes_long_documents(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r.section for r in entry.queries()["H18_indication_section_whole"](spark, SF).collect()}
    assert set(got) == set(docs)
    long = [i for i, t in docs.items() if len(t) >= 15_000]
    assert long and all(len(got[i]) > 10_000 for i in long)
    assert all(len(got[i]) <= 16_000 for i in docs if i % 2)
