"""Chat formatting: logged snapshots of a conversation collapse to the longest, which is rendered.

A rolling hash over the turns names every prefix of every conversation. A conversation whose
whole hash is a prefix of a longer one is dropped by an anti-join; equal conversations collapse
to the smallest conv_id. The rest is rendered with a role template. DataFrame operations only.

Turns are compared at their numbers. The rolling hash is an exclusive-or of 128 bits a turn row,
first over blocks of turns and then within a block, so a conversation of any length spreads over
tasks; it is rendered in parts of one block of turns each.

Results: rows without conv_id are left out; null role or text counts as empty; a null turn comes
before all others; repeated rows of a turn count once; different rows of one turn stand in the
order of role and text; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with nulls settled and repeated rows once."""
    return conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def prefixes(turns: DataFrame, block: int) -> DataFrame:
    """conv_id, turn and the hash (h1, h2) of the conversation up to that turn, with its last turn."""
    own = turns.select("conv_id", "turn", F.xxhash64("turn", "role", "text").alias("a"),
                       F.xxhash64("text", F.lit(7), "role", "turn").alias("b")).distinct()
    one = own.groupBy("conv_id", "turn").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")).withColumn(
        "_block", F.floor(F.col("turn") / block))
    sums = one.groupBy("conv_id", "_block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"),
                                                F.max("turn").alias("last"))
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    sums = sums.select("conv_id", "_block", F.coalesce(F.bit_xor("a").over(before), F.lit(0)).alias("a0"),
                       F.coalesce(F.bit_xor("b").over(before), F.lit(0)).alias("b0"), F.max("last").over(whole).alias("last"))
    inner = Window.partitionBy("conv_id", "_block").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    rolled = one.select("conv_id", "_block", "turn", F.bit_xor("a").over(inner).alias("a"), F.bit_xor("b").over(inner).alias("b"))
    return rolled.join(sums, ["conv_id", "_block"]).select(
        "conv_id", "turn", F.expr("a ^ a0").alias("h1"), F.expr("b ^ b0").alias("h2"), "last")


def maximal_conversations(conversations: DataFrame, block: int = 1024) -> DataFrame:
    """conv_id, last turn and number of equal conversations, of those that no other extends."""
    rolled = prefixes(turns_of(conversations), block)
    key = ["turn", "h1", "h2"]
    full = rolled.where("turn = last").groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    longer = rolled.groupBy(*key).agg(F.max("last").alias("last")).where("last > turn").select(*key)
    return full.join(longer, key, "left_anti").select("conv_id", F.col("turn").alias("last_turn"), "copies")


def render_chats(conversations: DataFrame, template: str = "<|%s|>\n%s<|end|>\n", block: int = 1024) -> DataFrame:
    """conv_id, part, copies, n_turns and rendered text of each maximal conversation, a row for each block of turns."""
    keep = maximal_conversations(conversations, block).select("conv_id", "copies")
    own = turns_of(conversations).join(keep, "conv_id").distinct()
    own = own.select("conv_id", "copies", F.floor(F.greatest("turn", F.lit(0)) / block).alias("part"),
                     F.struct("turn", "role", "text").alias("row"))
    parts = own.groupBy("conv_id", "copies", "part").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return parts.select("conv_id", "part", "copies", F.size("rows").cast("long").alias("n_turns"), F.array_join(
        F.transform("rows", lambda r: F.format_string(template, r["role"], r["text"])), "").alias("rendered"))
