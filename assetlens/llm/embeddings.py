"""Embedding near-dedup: an inverted multi-index over vector halves.

A codebook of each half of the unit vectors is fitted on a bounded sample; the two codes of a
vector name its cell in the product grid. Every vector looks at the cells nearest to it in
multi-sequence order (by the sum of the two halves' distances), as many as reach the target
recall on disturbed sample vectors, and is compared in double precision with all vectors of its
label there. A pair is looked for from its smaller id only, so it is counted once.

Equal vectors of a label are one class with a multiplicity, so copies are never paired. A task
holds one first-half code of one label; a crowded one is cut further by the second code, and both
the vectors that are looked up and those that look are dealt into bounded parts that all meet. A
task emits counts and a spanning forest of its links, never the links themselves.

Results: vectors without label, that are null, empty, zero, or hold a null or a component that is
not finite link with nothing and stand alone; vectors of different length do not link; rows
without vec_id are left out of links; repeated rows of one vec_id count as vectors of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage
from .components import components


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of unit length, in double precision; scaled first, so that no square overflows."""
    x = np.asarray(rows, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def halves(rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The two halves that codebooks see: cut or padded to `width` numbers."""
    x = np.zeros((len(rows), width))
    n = min(width, rows.shape[1])
    x[:, :n] = rows[:, :n]
    return x[:, : width // 2], x[:, width // 2 :]


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ book.T + (book * book).sum(1), 0)


def codebook(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """k-means by Lloyd's steps on a bounded sample."""
    rng = np.random.default_rng(seed)
    book = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = distances(x, book).argmin(1)
        n = np.bincount(own, minlength=len(book))
        total = np.zeros_like(book)
        np.add.at(total, own, x)
        book[n > 0] = total[n > 0] / n[n > 0, None]
    return book


def nearest_cells(one: np.ndarray, two: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes (first, second half) of the `many` nearest cells of each row, in multi-sequence order.

    The cell of ranks (i, j) comes after (i+1)(j+1)-1 others at least, so only ranks with
    (i+1)(j+1) <= many are looked at.
    """
    r1, r2 = np.argsort(one, 1), np.argsort(two, 1)
    i, j = np.meshgrid(np.arange(one.shape[1]), np.arange(two.shape[1]), indexing="ij")
    ok = (i + 1) * (j + 1) <= many
    i, j = i[ok], j[ok]
    total = np.take_along_axis(one, r1, 1)[:, i] + np.take_along_axis(two, r2, 1)[:, j]
    best = np.argsort(total, 1, kind="stable")[:, :many]
    return np.take_along_axis(r1, i[best], 1), np.take_along_axis(r2, j[best], 1)


def cells_for_recall(sample: np.ndarray, books, width: int, least: float, recall: float, seed: int = 9) -> int:
    """Cells to visit so that the wanted share of disturbed copies, down to `least` cosine, lies in them."""
    rng = np.random.default_rng(seed)
    side = rng.normal(size=sample.shape)
    side -= (side * sample).sum(1, keepdims=True) * sample
    side /= np.maximum(np.sqrt((side * side).sum(1, keepdims=True)), 1e-300)
    cos = rng.uniform(least, 1, (len(sample), 1))
    near = cos * sample + np.sqrt(1 - cos * cos) * side
    d = [distances(h, b) for h, b in zip(halves(sample, width), books)]
    own = [distances(h, b).argmin(1) for h, b in zip(halves(near, width), books)]
    at = np.arange(len(sample))
    total = d[0][at, own[0]] + d[1][at, own[1]]
    # Rank of the cell: how many cells are nearer, counted over the sorted second half.
    two = np.sort(d[1], 1)
    rank = np.array([sum(np.searchsorted(two[r], total[r] - x) for x in d[0][r] if x < total[r]) for r in at])
    return int(min(np.quantile(rank, recall) + 1, len(books[0]) * len(books[1])))


def block_links(base: pa.Table, ask: pa.Table, least: float):
    """(id, links) and forest edges between the vectors of a block and those that look there."""
    def matrix(t):
        return unit(np.array(t["vec"].to_pylist(), np.float64))
    b, q = matrix(base), matrix(ask)
    bid, bm, bj = (base[c].to_numpy() for c in ("id", "m", "j"))
    qid, qm = ask["id"].to_numpy(), ask["m"].to_numpy()
    size = np.array([len(x) for x in ask["js"].to_pylist()])
    who = np.repeat(np.arange(len(q)), size)
    j = np.concatenate([np.asarray(x, np.int64) for x in ask["js"].to_pylist()])
    order = np.argsort(j, kind="stable")
    who, j = who[order], j[order]
    base_order = np.argsort(bj, kind="stable")
    bj_sorted = bj[base_order]
    n_base, n_ask, edges = np.zeros(len(b), np.int64), np.zeros(len(q), np.int64), []
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for cell in np.unique(bj):
        mine = base_order[np.searchsorted(bj_sorted, cell) : np.searchsorted(bj_sorted, cell, "right")]
        asks = who[np.searchsorted(j, cell) : np.searchsorted(j, cell, "right")]
        for lo in range(0, len(asks), 2048):
            some = asks[lo : lo + 2048]
            hit = (q[some] @ b[mine].T >= least) & (qid[some][:, None] < bid[mine][None, :])
            n_ask[some] += hit @ bm[mine]
            n_base[mine] += qm[some] @ hit
            for r, c in zip(*np.nonzero(hit)):
                x, y = root(int(qid[some[r]])), root(int(bid[mine[c]]))
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    edges.append((int(qid[some[r]]), int(bid[mine[c]])))
    ids, n = np.r_[bid, qid], np.r_[n_base, n_ask]
    return ids[n > 0], n[n > 0], edges


def embedding_dedup(vectors: DataFrame, least: float = 0.93, recall: float = 0.97, sample_rows: int = 8192,
                    part_rows: int = 4096) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of vectors (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "embedding", "label")
    fine = (F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size("embedding") > 0)
            & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
            & F.exists("embedding", lambda x: x != 0))
    good = rows.where(fine)
    classes = good.groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("m"))
    classes = cut_lineage(classes, spark)
    total = classes.count()
    # The index is fitted on a bounded sample; every vector is indexed.
    picked = classes.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("embedding").collect()
    if picked:
        sizes = [len(r.embedding) for r in picked]
        width = max(set(sizes), key=sizes.count)
        width += width % 2
        sample = unit(np.array([x.embedding for x in picked if len(x.embedding) in (width, width - 1)
                                and len(x.embedding) == max(set(sizes), key=sizes.count)]))
        padded = np.zeros((len(sample), width))
        padded[:, : sample.shape[1]] = sample
        k = min(4096, max(8, math.isqrt(total) // 8))
        books = [codebook(h, k) for h in halves(padded, width)]
        many = cells_for_recall(padded[:2048], books, width, least, recall)
        shared = spark.sparkContext.broadcast((books, width, many))
    else:
        shared = None

    def code(tables):
        books, width, many = shared.value
        for t in tables:
            if not t.num_rows:
                continue
            lists = t.column("embedding").to_pylist()
            size = np.array([len(x) for x in lists])
            out = {c: [] for c in ("label", "dim", "i", "look", "id", "m", "j", "js", "vec")}
            label, ids, m = (t.column(c).to_pylist() for c in ("label", "id", "m"))
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                for lo in range(0, len(at), 256):
                    some = at[lo : lo + 256]
                    x = halves(unit(np.array([lists[r] for r in some])), width)
                    d = [distances(h, b) for h, b in zip(x, books)]
                    own = [y.argmin(1) for y in d]
                    ci, cj = nearest_cells(*d, many)
                    for k, r in enumerate(some):
                        by = {}
                        for a, z in zip(ci[k].tolist(), cj[k].tolist()):
                            by.setdefault(a, []).append(z)
                        by.setdefault(int(own[0][k]), [])
                        entries = [(False, int(own[0][k]), int(own[1][k]), [])] + [(True, a, None, z) for a, z in by.items() if z]
                        for look, i, j, js in entries:
                            for c, v in zip(out, (label[r], int(n), i, look, ids[r], m[r], j, js, lists[r])):
                                out[c].append(v)
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(),
                     pa.list_(pa.int32()), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([pa.array(out[c], k) for c, k in zip(out, kinds)], list(out))

    def compare(table):
        base, ask = table.filter(pc.invert(table["look"])), table.filter(table["look"])
        if not base.num_rows or not ask.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        ids, n, edges = block_links(base, ask, least)
        return pa.table({"a": pa.array([*ids.tolist(), *(e[0] for e in edges)], pa.int64()),
                         "b": pa.array([None] * len(ids) + [e[1] for e in edges], pa.int64()),
                         "n": pa.array([*n.tolist(), *([None] * len(edges))], pa.int64())})

    if shared is None:
        found = spark.createDataFrame([], "a long, b long, n long")
    else:
        placed = classes.withColumn("label", F.col("label").cast("int")).mapInArrow(
            code, "label int, dim int, i int, look boolean, id long, m long, j int, js array<int>, vec array<float>")
        put = dealt_blocks(placed, part_rows)
        found = cut_lineage(put.groupBy(*BLOCK).applyInArrow(compare, "a long, b long, n long"), spark)
    counts = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    group = components(found.where("b is not null")).withColumnRenamed("node", "id")
    named = classes.join(counts, "id", "left").join(group, "id", "left").select(
        "label", "embedding", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"),
        F.coalesce("root", "id").alias("component_id"))
    alone = rows.where(~F.coalesce(fine, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = good.join(named, ["label", "embedding"]).select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


BLOCK = ("label", "dim", "i", "sub", "part", "ask_part")


def dealt_blocks(placed: DataFrame, part_rows: int) -> DataFrame:
    """The rows of placed with the blocks they go to: about part_rows vectors that are looked up and as many that look.

    A first code with more vectors is cut by its second code (sub; else -1). A vector that is looked up goes to
    one part of its block and to all ask parts, a vector that looks to one ask part and to all parts.
    """
    key = ["label", "dim", "i"]
    cells = placed.select(*key, "look", F.posexplode(F.when(F.col("look"), F.col("js")).otherwise(F.array("j"))).alias("pos", "sub"))
    cells = cells.groupBy(*key, "sub").agg(
        F.count_if(~F.col("look")).alias("b"), F.count_if("look").alias("a"), F.count_if(F.col("look") & (F.col("pos") == 0)).alias("lead"))
    split = lambda n: F.ceil(n / part_rows).cast("int")
    entry = lambda sub, b, a: F.struct(sub.alias("key"), F.struct(split(b).alias("parts"), split(a).alias("asks")).alias("value"))
    # At most one entry for each second code.
    full = (F.col("b") > 0) & (F.col("a") > 0)
    plan = cells.groupBy(*key).agg(
        F.sum("b").alias("b"), F.sum("lead").alias("lead"),
        F.collect_list(F.when(full, entry(F.col("sub"), F.col("b"), F.col("a")))).alias("by"))
    crowded = F.col("b") > part_rows
    plan = plan.where("b > 0 and lead > 0").select(*key, crowded.alias("crowded"), F.map_from_entries(F.when(
        crowded, F.col("by")).otherwise(F.array(entry(F.lit(-1), F.col("b"), F.col("lead"))))).alias("plan"))
    sub = F.when(~F.col("crowded"), F.array(F.lit(-1))).when(F.col("look"), F.col("js")).otherwise(F.array("j"))
    rows = placed.join(plan, key).withColumn("sub", F.explode(sub))
    rows = rows.withColumn("js", F.when(F.col("look") & F.col("crowded"), F.array("sub")).otherwise(F.col("js")))
    rows = rows.withColumn("cut", F.try_element_at("plan", "sub")).where("cut is not null")
    one = lambda n: F.array(F.pmod(F.xxhash64("id"), n).cast("int"))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    parts, asks = F.col("cut.parts"), F.col("cut.asks")
    rows = rows.withColumn("part", F.explode(F.when(F.col("look"), every(parts)).otherwise(one(parts))))
    rows = rows.withColumn("ask_part", F.explode(F.when(F.col("look"), one(asks)).otherwise(every(asks))))
    return rows.select(*placed.columns, *BLOCK[3:])
