"""Order-dependent work without one task per key.

Rows are cut into even chunks of the composite order (key, order columns). A chunk is a
contiguous run, so a hot key spans many chunks and each chunk is an ordinary small
window partition. What a chunk needs from earlier chunks of its key is a summary with at
most two rows per chunk boundary, which is proven small and therefore broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_CHUNK = 1_000_000
MAX_CHUNKS = 4096
SAMPLE = 64  # sampled rows per chunk


def chunk_bounds(df: DataFrame, order: list[str], rows_per_chunk: int = ROWS_PER_CHUNK):
    """Cut points of the composite order, from a hash sample (the same rows on every run)."""
    total = df.count()
    chunks = min(MAX_CHUNKS, -(-total // rows_per_chunk))
    if chunks <= 1:
        return []
    keep = max(1, total // (chunks * SAMPLE))
    sample = df.select(*order).filter(F.pmod(F.xxhash64(*order), F.lit(keep)) == 0)
    rows = sample.sort(*order).collect()  # about chunks * SAMPLE rows of the order columns
    return [rows[i * len(rows) // chunks] for i in range(1, chunks)] if rows else []


def with_chunk(df: DataFrame, order: list[str], bounds) -> DataFrame:
    """Adds ``_chunk``: the number of cut points at or below the row."""
    if not bounds:
        return df.withColumn("_chunk", F.lit(0))
    types = {f.name: f.dataType for f in df.schema.fields}
    cuts = F.array(*[F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(order, b)]) for b in bounds])
    here = F.struct(*[F.col(c) for c in order])
    # binary search keeps the cost at log2(chunks) comparisons per row
    steps = F.sequence(F.lit(1), F.lit(max(1, len(bounds)).bit_length()))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def halve(acc, _):
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        below = F.get(cuts, mid) <= here
        step = F.struct(F.when(below, mid + 1).otherwise(acc["lo"]).alias("lo"),
                        F.when(below, acc["hi"]).otherwise(mid).alias("hi"))
        return F.when(acc["lo"] < acc["hi"], step).otherwise(acc)

    return df.withColumn("_chunk", F.aggregate(steps, start, halve)["lo"])


class Ordered:
    """A frame in the order (keys, order columns), ready for chunked scans."""

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], rows_per_chunk: int = ROWS_PER_CHUNK):
        self.keys, self.order = keys, order
        bounds = chunk_bounds(df, keys + order, rows_per_chunk)
        self.split = bool(bounds)
        self.df = with_chunk(df, keys + order, bounds)

    @property
    def window(self):
        return Window.partitionBy("_chunk", *self.keys).orderBy(*self.order)

    def _carried(self, summary: DataFrame, expr: Column, name: str) -> DataFrame:
        """Per (chunk, key), ``expr`` over all earlier chunks of the key. Keys that live in
        one chunk need none; the others number at most one per cut point."""
        counted = summary.withColumn("_parts", F.count("*").over(Window.partitionBy(*self.keys)))
        w = Window.partitionBy(*self.keys).orderBy("_chunk")
        return counted.filter("_parts > 1").select("_chunk", *self.keys, expr(w).alias(name))

    def _attach(self, df: DataFrame, carry: DataFrame) -> DataFrame:
        # Both sides come from one frame, so the carry's columns get names of their own.
        own = {c: f"_carried_{i}" for i, c in enumerate(["_chunk", *self.keys])}
        carry = carry.withColumnsRenamed(own)
        cond = F.lit(True)
        for c, name in own.items():
            cond = cond & F.col(c).eqNullSafe(F.col(name))
        return df.join(F.broadcast(carry), cond, "left").drop(*own.values())

    def _next(self, df: DataFrame) -> "Ordered":
        out = object.__new__(Ordered)
        out.keys, out.order, out.split, out.df = self.keys, self.order, self.split, df
        return out

    def carry_forward(self, value: Column, name: str, inclusive: bool = True) -> "Ordered":
        """Last non-null ``value`` at or (not inclusive) strictly before the row."""
        end = 0 if inclusive else -1
        w = self.window.rowsBetween(Window.unboundedPreceding, end)
        d = self.df.withColumn("_v", value)
        d = d.withColumn(name, F.last("_v", True).over(w))
        if self.split:
            # One aggregate: null keys form a group of their own, and keys without a value get a null tail.
            present = self.df.withColumn("_v", value).groupBy("_chunk", *self.keys).agg(
                F.max_by("_v", F.when(F.col("_v").isNotNull(), F.struct(*self.order))).alias("_tail"))
            carry = self._carried(present, lambda w2: F.last("_tail", True).over(
                w2.rowsBetween(Window.unboundedPreceding, -1)), "_carry")
            d = self._attach(d, carry).withColumn(name, F.coalesce(name, "_carry")).drop("_carry")
        return self._next(d.drop("_v"))

    def previous(self, value: Column, name: str) -> "Ordered":
        """Value of the row before (NULL for the first row of a key)."""
        wrapped = F.struct(value.alias("v"))
        out = self.carry_forward(wrapped, name, inclusive=False)
        return self._next(out.df.withColumn(name, F.col(f"{name}.v")))

    def running_sum(self, value: Column, name: str) -> "Ordered":
        w = self.window.rowsBetween(Window.unboundedPreceding, 0)
        d = self.df.withColumn(name, F.sum(value).over(w))
        if self.split:
            part = self.df.groupBy("_chunk", *self.keys).agg(F.sum(value).alias("_part"))
            carry = self._carried(part, lambda w2: F.sum("_part").over(
                w2.rowsBetween(Window.unboundedPreceding, -1)), "_carry")
            d = self._attach(d, carry).withColumn(name, F.col(name) + F.coalesce("_carry", F.lit(0))).drop("_carry")
        return self._next(d)

    def running_max_before(self, value: Column, name: str) -> "Ordered":
        """Largest ``value`` of the rows before (NULL for the first row of a key)."""
        w = self.window.rowsBetween(Window.unboundedPreceding, -1)
        d = self.df.withColumn(name, F.max(value).over(w))
        if self.split:
            part = self.df.groupBy("_chunk", *self.keys).agg(F.max(value).alias("_part"))
            carry = self._carried(part, lambda w2: F.max("_part").over(
                w2.rowsBetween(Window.unboundedPreceding, -1)), "_carry")
            d = self._attach(d, carry).withColumn(name, F.greatest(name, "_carry")).drop("_carry")
        return self._next(d)

    def ordinal(self, name: str) -> "Ordered":
        """Row number within the key."""
        return self.running_sum(F.lit(1).cast("long"), name)

    def islands(self, starts_new: Column, name: str) -> "Ordered":
        """Number of island starts up to the row."""
        return self.running_sum(F.when(starts_new, 1).otherwise(0).cast("long"), name)

    def frame(self) -> DataFrame:
        return self.df.drop("_chunk")
