"""Benchmark items without item_id still mark what they leak into."""

import pytest

from assetlens.llm.decontaminate import decontaminate


@pytest.mark.parametrize("block_bytes", [16, 4 << 20])
def test_items_without_id(spark, block_bytes):
    leak, named = "a b c d e f g h i j", "k l m n o p q r s t"
    docs = spark.createDataFrame([(1, f"x {leak} y"), (2, f"x {named} {leak}"), (3, "x y z")], "doc_id long, text string")
    items = spark.createDataFrame([(None, leak), (7, named), (None, None)], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, list(r["items"])) for r in decontaminate(docs, items, block_bytes=block_bytes).collect()}
    assert got == {1: (10, []), 2: (20, ["7"]), 3: (0, [])}
