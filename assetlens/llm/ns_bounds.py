"""Centroid clustering with Ns-bounds: exact Lloyd rounds that skip distances which cannot matter.

Every vector keeps, for each centroid, the distance at the round in which that distance was last
evaluated, and the number of that round. The centroids of all rounds are retained, so a stored
distance is loosened by the norm of the centroid's *total* displacement since that round (the norm of
the sum), which is never more than the sum of the norms of its moves. A centroid whose loosened lower
bound stays above the loosened upper bound of the vector's own centroid is not looked at; the own
distance is evaluated next, and only what still fails is rescanned in exact integers. Bounds carry a
margin for rounding, so they only ever cause more exact work.

Components are integers floor(scale * x). One pass a round writes the vectors with their bounds to the
shared folder and, in the same table, each task's sums by cluster, which Spark adds up; the table of the
round before is deleted. What reaches the driver is k centroids; the history is k * rounds of them.

Results: vectors that are null, of another length, or hold null or non-finite components are left out;
with fewer than k vectors each is a centroid; repeated vectors may give equal centroids, of which the
smaller number takes all; a row without id is clustered, but starts as a centroid only if others are
too few; an empty table gives no rows. Distances and inertias beyond a long are the largest long.
Further columns are kept, and columns that bear the name of a result are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, release, written_at

#: Up to these sizes of components float64 (with its matrix product) and int64 are exact.
FLOAT_SAFE, INT_SAFE, LIMB = 2**22, 2**27, 24
MARGIN = 1e-9
LONGEST = 2**63 - 1
RESULTS = ("cluster", "distance", "cluster_inertia", "inertia", "centroid")


def usable(vector: str, dims: int):
    """Exactly dims components, none null or non-finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) == dims) & finite


def narrowest(values: list[list[int]]) -> np.ndarray:
    """Exact integers in the cheapest type that keeps distances exact."""
    most = max((abs(v) for row in values for v in row), default=0)
    return np.array(values, np.float64 if most <= FLOAT_SAFE else np.int64 if most <= INT_SAFE else object)


def scaled(column, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, a row for each vector."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)
    with np.errstate(over="ignore"):
        y = np.floor(scale * x)
    most = np.abs(y).max(initial=0)
    if most <= FLOAT_SAFE:
        return y
    if most <= INT_SAFE:
        return y.astype(np.int64)
    return np.array([[math.floor(scale * v) if abs(v) < 2**52 else int(v) * scale for v in row] for row in x.tolist()], object)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to centroids."""
    if x.dtype != c.dtype:
        kind = object if object in (x.dtype, c.dtype) else np.int64
        x, c = (a if a.dtype == object else a.astype(np.int64).astype(kind) for a in (x, c))
    if x.dtype == object:
        return np.array([[sum((a - b) ** 2 for a, b in zip(p, q)) for q in c.tolist()] for p in x.tolist()], object).reshape(len(x), len(c))
    return (x * x).sum(1)[:, None] + (c * c).sum(1) - 2 * (x @ c.T)


def displacement(history: list[np.ndarray]) -> np.ndarray:
    """For each centroid (row) and past round (column), the norm of its total move since then."""
    now = history[-1]
    if any(c.dtype == object for c in history):
        return np.full((len(now), len(history)), np.inf)
    moved = [now.astype(float) - c.astype(float) for c in history]
    return np.stack([np.sqrt((m * m).sum(1)) for m in moved], 1)


def reassigned(x: np.ndarray, own: np.ndarray, dist: np.ndarray, at: np.ndarray, history: list[np.ndarray]):
    """Nearest centroid of each row, its exact squared distance, and how many distances were evaluated.

    own is the last assignment (None at first), dist and at the distances and rounds of the last
    evaluations; dist and at are brought up to date in place.
    """
    now, c = len(history) - 1, history[-1]
    n, k = len(x), len(c)
    if own is None or x.dtype == object:
        sq = squared(x, c)
        best = np.array([min(range(k), key=lambda j: (row[j], j)) for row in sq.tolist()], np.int64) if sq.dtype == object else sq.argmin(1)
        dist[:] = 0 if sq.dtype == object else np.sqrt(sq.astype(float))
        at[:] = now
        return best, sq[np.arange(n), best], n * k
    moved, rows = displacement(history), np.arange(n)
    loosened = moved[np.arange(k), at]
    with np.errstate(invalid="ignore"):
        low = dist - loosened - MARGIN * (1 + dist + loosened)
        high = dist[rows, own] + loosened[rows, own]
        fail = ~(low > high[:, None])
        fail[rows, own] = False
        # The own distance first: with it most failures vanish.
        looked = np.flatnonzero(fail.any(1))
        best, square = own.copy(), None
        square = np.empty(n, object if object in (x.dtype, c.dtype) else x.dtype if x.dtype == c.dtype else np.int64)
        for j in range(k):
            some = np.flatnonzero(own == j)
            if len(some):
                square[some] = squared(x[some], c[j : j + 1])[:, 0]
        exact = np.sqrt(square.astype(float)) if square.dtype != object else np.full(n, np.inf)
        if square.dtype != object:
            dist[rows, own], at[rows, own] = exact, now
        fail[looked] &= ~(low[looked] > (exact[looked] * (1 + MARGIN) + MARGIN)[:, None])
    evaluated = n
    for j in range(k):
        some = np.flatnonzero(fail[:, j])
        if not len(some):
            continue
        sq = squared(x[some], c[j : j + 1])[:, 0]
        evaluated += len(some)
        dist[some, j], at[some, j] = (0 if sq.dtype == object else np.sqrt(sq.astype(float))), now
        better = (sq < square[some]) | (sq == square[some]) & (j < best[some])
        best[some[better]], square[some[better]] = j, sq[better]
    return best, square, evaluated


def limbs(total: list[int]) -> list[list[int]]:
    """Integers as digits of LIMB bits, the last signed; one digit when all are small."""
    out = []
    while max(map(abs, total), default=0) > INT_SAFE:
        out.append([v & (1 << LIMB) - 1 for v in total])
        total = [v >> LIMB for v in total]
    return [*out, total]


class Sums:
    """A task's sums of components by cluster, exact whatever the size of the components."""

    def __init__(self, k: int, dims: int):
        self.total, self.n = [[0] * dims for _ in range(k)], [0] * k
        self.looked = 0

    def add(self, x: np.ndarray, cluster: np.ndarray) -> None:
        for j in np.unique(cluster).tolist():
            rows = x[cluster == j]
            part = (rows if rows.dtype == object else rows.astype(np.int64)).sum(0).tolist()
            self.total[j] = [a + b for a, b in zip(self.total[j], part)]
            self.n[j] += len(rows)

    def rows(self):
        """(cluster, digit, rows counted, values)"""
        for j, n in enumerate(self.n):
            if n:
                for i, digit in enumerate(limbs(self.total[j])):
                    yield j, i, n if i == 0 else 0, digit


def ns_cluster(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 40, rounds: int = 5,
               dims: int = 64, scale: int = 256, seed: int = 2, batch_rows: int = 4096) -> DataFrame:
    """Usable rows with cluster, distance (squared), cluster_inertia, inertia and centroid (components joined by commas)."""
    spark = rows.sparkSession
    keep = [f for f in rows.schema.fields if f.name not in RESULTS]
    names = [f.name for f in keep]
    data = rows.where(usable(vector, dims)).select(*names)
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    first = data.orderBy(rank.asc_nulls_last(), vector).limit(k).select(vector).toArrow()
    final = T.StructType([*keep, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType()),
                          T.StructField("cluster_inertia", T.LongType()), T.StructField("inertia", T.LongType()),
                          T.StructField("centroid", T.StringType())])
    if not first.num_rows:
        return spark.createDataFrame([], final)
    ints = [[int(v) for v in row] for row in scaled(first[vector], dims, scale).tolist()]
    history, k = [narrowest(ints)], len(ints)
    state = T.StructType([*(T.StructField(f.name, f.dataType) for f in keep)]
                         + [T.StructField(n, t) for n, t in (
                             ("cluster", T.IntegerType()), ("distance", T.LongType()), ("_dist", T.BinaryType()), ("_at", T.BinaryType()),
                             ("_digit", T.IntegerType()), ("_n", T.LongType()), ("_sum", T.ArrayType(T.LongType())))])

    def assign(data: DataFrame, again: bool, last: bool) -> DataFrame:
        known = list(history)

        def run(batches):
            sums, schema = Sums(k, dims), None
            for batch in batches:
                schema = batch.schema
                for lo in range(0, batch.num_rows, batch_rows):
                    t = batch.slice(lo, batch_rows)
                    x, n = scaled(t.column(vector), dims, scale), t.num_rows
                    if again:
                        own = t.column("cluster").to_numpy().astype(np.int64)
                        dist = np.frombuffer(b"".join(t.column("_dist").to_pylist()), np.float64).reshape(n, k).copy()
                        at = np.frombuffer(b"".join(t.column("_at").to_pylist()), np.uint16).reshape(n, k).copy()
                    else:
                        own, dist, at = None, np.empty((n, k)), np.empty((n, k), np.uint16)
                    best, square, _ = reassigned(x, own, dist, at, known)
                    sums.add(x, best)
                    square = pa.array([min(int(v), LONGEST) for v in square.tolist()], pa.int64())
                    none = [pa.nulls(n, pa.binary())] * 2 if last else [pa.array([r.tobytes() for r in m], pa.binary()) for m in (dist, at)]
                    yield pa.RecordBatch.from_arrays(
                        [*(t.column(c) for c in names), pa.array(best.astype(np.int32)), square, *none, pa.nulls(n, pa.int32()),
                         pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))], [*names, *state.names[len(names):]])
            if schema is not None and not last and (told := list(sums.rows())):
                c, i, n, v = zip(*told)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.nulls(len(c), schema.field(f).type) for f in names), pa.array(c, pa.int32()), pa.nulls(len(c), pa.int64()),
                     pa.nulls(len(c), pa.binary()), pa.nulls(len(c), pa.binary()), pa.array(i, pa.int32()), pa.array(n, pa.int64()),
                     pa.array(v, pa.list_(pa.int64()))], [*names, *state.names[len(names):]])
            release()
        return data.mapInArrow(run, state)

    table, path = written_at(assign(data, False, rounds == 0), spark)
    for r in range(rounds):
        # At most k rows and digits of one sum each.
        told = (table.where("_digit is not null").groupBy("cluster", "_digit")
                .agg(F.sum("_n").alias("n"), *(F.sum(F.col("_sum")[i]).alias(f"v{i}") for i in range(dims))).collect())
        now = [[int(v) for v in row] for row in history[-1].tolist()]
        count, total = [0] * k, [[0] * dims for _ in range(k)]
        for row in told:
            count[row[0]] += row[2]
            total[row[0]] = [a + (v << LIMB * row[1]) for a, v in zip(total[row[0]], row[3:])]
        history.append(narrowest([[v // n for v in s] if n else c for n, s, c in zip(count, total, now)]))
        vectors = table.where("_digit is null").select(*names, "cluster", "_dist", "_at")
        table, new = written_at(assign(vectors, True, r == rounds - 1), spark)
        discard(spark, path)
        path = new
    table = table.where("_digit is null").select(*names, "cluster", "distance")
    wide = "decimal(38,0)"
    parts = table.groupBy("cluster").agg(F.sum(F.col("distance").cast(wide)).alias("s")).collect()
    whole = min(sum(int(r.s) for r in parts), LONGEST)
    told = [(r.cluster, min(int(r.s), LONGEST), whole, ",".join(str(int(v)) for v in history[-1][r.cluster].tolist())) for r in parts]
    told = spark.createDataFrame(told, T.StructType(final.fields[len(names):len(names) + 1] + final.fields[len(names) + 2:]))
    # told has a row for each of the k clusters at most.
    return table.join(F.broadcast(told), "cluster").select(*final.names)
