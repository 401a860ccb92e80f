"""Sharding by histogram sort: exact bytes below candidate keys are counted until splitters are good enough.

Rows are sorted by (hash of the text, hash of the row, number of the row), so equal texts stand together
and no two rows have the same key, however often a row is repeated. A splitter is a key; every round
counts, over a table of fixed-width keys and sizes, the bytes and rows between all candidate keys of all
open splitters, and the least and greatest key met there. A splitter is settled when the bytes below it
are within `tolerance` of a shard of its ideal, or when its bracket holds one row and the nearer side is
taken. Candidates stand between texts while more than one text is left in the bracket, so a group of
equal texts is cut only where keeping it whole would break the tolerance. Shards that are larger than
`part_bytes` are divided by further, looser splitters into parts, which are sorted apart.

Then every row goes to its part in one exchange, is sorted there, and gets its slot from its place in the
part and the rows of the parts before it. What reaches the driver are the candidates' counts: at most
`PROBES` or two for each open splitter, and the splitters grow with the parts only.

Results: null text has `overhead` bytes, as an empty one has; equal rows get slots of their own; an empty
table gives no rows; shards may stay empty when there are fewer rows than shards. Further columns are
kept, and columns that bear the name of a result are replaced.
"""

from __future__ import annotations

import math
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import release, saved

RESULTS = ("size", "law", "shard", "slot", "grown_shard")
KEY = ("_k1", "_k2", "_k3")
PROBES = 1 << 15
SHIFT, WORD = 1 << 63, (1 << 64) - 1


def number(parts) -> int:
    """The three longs of a key as one integer in the same order."""
    out = 0
    for p in parts:
        out = out << 64 | int(p) + SHIFT
    return out


def parts_of(key: int) -> tuple[int, int, int]:
    return tuple((key >> s & WORD) - SHIFT for s in (128, 64, 0))


def comparable(k1: np.ndarray, k2: np.ndarray, k3: np.ndarray) -> np.ndarray:
    """Keys as 24 bytes each that compare like them; 0xFF ends them, so that no trailing zero is lost."""
    flat = np.empty((len(k1), 25), np.uint8)
    for i, k in enumerate((k1, k2, k3)):
        flat[:, 8 * i : 8 * i + 8] = (k.astype(np.int64).view(np.uint64) ^ np.uint64(SHIFT)).astype(">u8").view(np.uint8).reshape(-1, 8)
    flat[:, 24] = 255
    return flat.reshape(-1).view("S25")


class Splits:
    """Sorted keys; where() tells how many of them are not above each row."""

    def __init__(self, keys: list[int]):
        self.k = [np.array(c, np.int64) for c in zip(*map(parts_of, keys))] if keys else [np.empty(0, np.int64)] * 3
        self.whole = comparable(*self.k)

    def where(self, k1: np.ndarray, k2: np.ndarray, k3: np.ndarray) -> np.ndarray:
        out = np.searchsorted(self.k[0], k1, "right")
        close = np.flatnonzero(np.searchsorted(self.k[0], k1, "left") != out)
        if len(close):
            out[close] = np.searchsorted(self.whole, comparable(k1[close], k2[close], k3[close]), "right")
        return out


def histogram(keys: DataFrame, probes: list[int]) -> dict[int, tuple[int, int, int, int]]:
    """(bytes, rows, least key, greatest key) of each interval between probes that holds rows; interval i lies above i probes."""
    splits = Splits(probes)

    def run(batches):
        for t in batches:
            if not t.num_rows:
                continue
            size, *k = (t.column(c).to_numpy() for c in ("size", *KEY))
            at = splits.where(*k)
            order = np.lexsort((*k[::-1], at))
            own = at[order]
            head = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            last = np.r_[head[1:], len(own)] - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[head]), pa.array(np.add.reduceat(size[order], head)), pa.array(np.diff(np.r_[head, len(own)])),
                 *(pa.array(c[order][head]) for c in k), *(pa.array(c[order][last]) for c in k)], names)
            release()

    names = ["i", "size", "n", "a1", "a2", "a3", "z1", "z2", "z3"]
    got = (keys.mapInArrow(run, ", ".join(f"{n} long" for n in names)).groupBy("i")
           .agg(F.sum("size"), F.sum("n"), F.min(F.struct("a1", "a2", "a3")), F.max(F.struct("z1", "z2", "z3"))).collect())
    return {r[0]: (r[1], r[2], number(r[3]), number(r[4])) for r in got}


class Open:
    """A splitter that is sought: bytes and rows below its bracket, in it, and the least and greatest key in it."""

    def __init__(self, ideal, slack, below, rows_below, size, rows, low, high):
        self.ideal, self.slack, self.below, self.rows_below = ideal, slack, below, rows_below
        self.size, self.rows, self.low, self.high = size, rows, low, high
        self.found: tuple[int, int] | None = None

    def edges(self):
        """Settle at an end of the bracket if that is close enough, or if one row is left."""
        down, up = self.ideal - self.below, self.below + self.size - self.ideal
        if min(down, up) <= self.slack or self.rows <= 1:
            self.found = (self.low, self.rows_below) if down <= up else (self.high + 1, self.rows_below + self.rows)

    def probes(self, n: int) -> list[int]:
        """The bracket's ends and keys in it: even ones and where the ideal would be, between texts if there are several."""
        span = self.high - self.low
        guess = self.low + span * (self.ideal - self.below) // max(self.size, 1)
        keys = {self.low + span * (i + 1) // n for i in range(n)} | {guess, self.high}
        if self.low >> 128 != self.high >> 128:
            keys = {k >> 128 << 128 for k in keys}
        return [self.low, self.high + 1, *(k for k in keys if self.low < k <= self.high)]


def splitters(keys: DataFrame, total: int, rows: int, low: int, high: int, shards: int, per_shard: int,
              tolerance: float, part_tolerance: float, fanout: int = 64) -> tuple[list[int], list[int], int]:
    """Keys at which the parts begin, the rows below each, and the rounds that it took."""
    parts, rounds = shards * per_shard, 0
    seek = []
    for j in range(1, parts):
        slack = tolerance * total / shards if j % per_shard == 0 else part_tolerance * total / parts
        seek.append(Open(total * j // parts, slack, 0, 0, total, rows, low, high))
    for s in seek:
        s.edges()
    while todo := [s for s in seek if s.found is None]:
        each = max(2, min(fanout, PROBES // len(todo)))
        probes = sorted({p for s in todo for p in s.probes(each)})
        found, at, below, rows_below = histogram(keys, probes), [], 0, 0
        for i in range(len(probes) + 1):
            got = found.get(i)
            at.append((below, rows_below, got))
            if got:
                below, rows_below = below + got[0], rows_below + got[1]
        filled = [(b, r, g) for b, r, g in at if g]
        starts = [b for b, _, _ in filled]
        for s in todo:
            # The interval with rows in which the ideal lies: its bracket from now on.
            below, rows_below, (size, n, low, high) = filled[max(bisect_left(starts, s.ideal) - 1, 0)]
            s.below, s.rows_below, s.size, s.rows, s.low, s.high = below, rows_below, size, n, low, high
            s.edges()
        rounds += 1
    # A looser splitter never passes a stricter one: parts stay in order.
    order = sorted(range(len(seek)), key=lambda i: seek[i].ideal)
    keys_at, rows_at = [seek[i].found[0] for i in order], [seek[i].found[1] for i in order]
    for i in range(1, len(keys_at)):
        if keys_at[i] < keys_at[i - 1]:
            keys_at[i], rows_at[i] = keys_at[i - 1], rows_at[i - 1]
    return keys_at, rows_at, rounds


def histogram_shards(docs: DataFrame, shards: int = 24, text: str = "text", overhead: int = 8, tolerance: float = 0.005,
                     part_bytes: int = 256 << 20, part_tolerance: float = 0.25) -> DataFrame:
    """Rows of docs with size, law ('bytes'), shard, slot (gapless from 0 in each shard) and grown_shard (null)."""
    spark = docs.sparkSession
    keep = [f.name for f in docs.schema.fields if f.name not in RESULTS]
    plain = [f.name for f in docs.schema.fields if f.name in keep and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    body = F.coalesce(F.col(text), F.lit(""))
    # Written once: the numbers of the rows must be the same in every round and in the exchange.
    rows = saved(docs.select(
        *keep, (F.octet_length(body) + F.lit(overhead).cast("long")).cast("long").alias("size"), F.xxhash64(body).alias("_k1"),
        F.xxhash64(*[F.col(f"`{c}`") for c in plain]).alias("_k2"), F.monotonically_increasing_id().alias("_k3")), spark)
    keys = rows.select("size", *KEY)
    n, total, low, high = keys.agg(F.count("*"), F.sum("size"), F.min(F.struct(*KEY)), F.max(F.struct(*KEY))).first()
    starts, below, per_shard = [], [], 1
    if n:
        per_shard = max(1, math.ceil(total / shards / part_bytes))
        starts, below, _ = splitters(keys, total, n, number(low), number(high), shards, per_shard, tolerance, part_tolerance)
    splits = spark.sparkContext.broadcast(Splits(starts))

    @F.pandas_udf("long")
    def part(k1: pd.Series, k2: pd.Series, k3: pd.Series) -> pd.Series:
        return pd.Series(splits.value.where(k1.to_numpy(), k2.to_numpy(), k3.to_numpy()))

    # Rows of the shard in parts before: a row for each part.
    before = [0, *below]
    offsets = [(i, i // per_shard, b - before[i // per_shard * per_shard]) for i, b in enumerate(before)]
    offsets = spark.createDataFrame(offsets, "_part long, shard int, _offset long")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*KEY))
    out = rows.withColumn("_part", part(*KEY)).withColumn("_place", place).join(F.broadcast(offsets), "_part")
    return out.select(*keep, "size", F.lit("bytes").alias("law"), "shard", (F.col("_offset") + F.col("_place") - 1).alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))
