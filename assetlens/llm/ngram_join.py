"""N-gram Jaccard join: near-copies by word shingles, with prefixes under several token orders.

Texts that share `percent` of their shingles share a token among the first few under any order
of all tokens. Three orders are used, each by document frequency (rare first), with different
ties. Pairs are found under the first order, with the length and the positional bound, and are
verified only if they share a prefix token under every other order too. All of these are necessary
conditions, so no link is lost.

1. Texts with equal shingle sets become one class (their copies are never paired).
2. Document frequencies: groups send the tokens of class representatives to buckets, 3 bytes a
   token, and get a frequency level back. Classes without a repeated token in every prefix are
   alone; the others are written with their shingles and their repeated prefix tokens.
3. Every class meets the most typical class of each of its prefix tokens: a star, linear in the
   copies. Linked classes become components.
4. Only classes of different components are still joined on their prefix tokens, and only on tokens
   that several components hold. Rows of a token's largest component meet the rows outside it, never
   each other, so a group of copies is never compared pair by pair. This is exact.

Results: null and empty texts have no shingles and link with nothing; a text of fewer words than
a shingle is one shingle; repeated rows belong to one class; rows without doc_id get the component
of their class, and nothing is linked through them alone. Sets are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (bound_batches, BLOBS, LOWER, batches, blob_rows, blob_table, concat, cut_lineage, dealt, group_count, mix, pack,
                     prefix_hash, release, span_hash, text_bytes, unpack, window_hash, word_hashes, words)
from .components import components

ORDERS = (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)


def shingle_sets(buf: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted within the row, and the row offsets."""
    low = LOWER[buf]
    starts, ends, rows = words(low, off)
    p = prefix_hash(word_hashes(low, starts, ends))
    n = np.diff(rows)
    row = np.repeat(np.arange(len(n)), n)
    full = window_hash(p, size)
    inside = np.flatnonzero(row[: len(full)] == row[size - 1 :][: len(full)]) if len(full) else np.empty(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < size))
    token = np.r_[full[inside], span_hash(p, rows[short], rows[short + 1])]
    owner = np.r_[row[inside], short]
    order = np.argsort(token)
    order = order[np.argsort(owner[order].astype(np.uint16 if len(n) < 65_536 else np.int64), kind="stable")]
    token, owner = token[order], owner[order]
    keep = np.r_[True, (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])][: len(token)]
    token, owner = token[keep], owner[keep]
    return token, np.searchsorted(owner, np.arange(len(n) + 1))


def class_ids(token: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit name for each row's set."""
    total = np.zeros(len(token) + 1, np.uint64)
    np.cumsum(mix(token + np.uint64(0x1234567)), out=total[1:])
    return mix(total[ends[1:]] - total[ends[:-1]] + np.diff(ends).astype(np.uint64)).view(np.int64)


def classes(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles and class of every row."""
    def run(tables):
        for t in tables:
            n, c = [], []
            for _, buf, off in batches(t.column("text")):
                token, ends = shingle_sets(buf, off, size)
                n.append(np.diff(ends))
                c.append(class_ids(token, ends))
            yield pa.RecordBatch.from_arrays([t.column("doc_id"), pa.array(concat(n, np.int64)), pa.array(concat(c, np.int64))],
                                             ["doc_id", "n_shingles", "_c"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, _c long")


def own_sets(table: pa.Table, ids: np.ndarray, size: int):
    """(tokens, offsets, class ids) of the group's representatives, one batch at a time."""
    at = pc.is_in(table["doc_id"], pa.array(ids))
    for _, buf, off in batches(table.filter(at)["text"]):
        token, ends = shingle_sets(buf, off, size)
        yield token, ends, class_ids(token, ends)


def place(token: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 3-byte key of tokens; two tokens with both equal only share their level."""
    h = mix(token)
    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), (h & np.uint64(0xFFFFFF)).astype(np.uint32)


def planes(keys: np.ndarray) -> list[np.ndarray]:
    """The three bytes of each key, low bytes first; of sorted keys the high bytes shrink well."""
    return [(keys >> np.uint32(8 * i)).astype(np.uint8) for i in range(3)]


def joined(low: np.ndarray, mid: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Keys from their bytes."""
    return low | (mid.astype(np.uint32) << np.uint32(8)) | (high.astype(np.uint32) << np.uint32(16))


def group_tokens(table: pa.Table, ids: np.ndarray, size: int, buckets: int):
    """Per bucket: distinct keys of the group's tokens and the documents that hold them (255 at most)."""
    token = concat([t for t, *_ in own_sets(table, ids, size)], np.uint64)
    b, k = place(token, buckets)
    both = np.sort((b.astype(np.uint64) << np.uint64(32)) | k)
    first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]][: len(both)])
    times = np.minimum(np.diff(np.r_[first, len(both)]), 255).astype(np.uint8)
    both = both[first]
    b, k = (both >> np.uint64(32)).astype(np.int64), both.astype(np.uint32)
    at = np.flatnonzero(np.r_[True, b[1:] != b[:-1]][: len(b)])
    return [(int(b[a]), k[a:z], times[a:z]) for a, z in zip(at, np.r_[at[1:], len(b)])]


def levels(bucket: pa.Table) -> pa.Table:
    """Frequency level (0: once, then by powers of two) of each key that each group sent."""
    rows = blob_rows(bucket)
    lists = [(joined(*key), n) for *key, n in (unpack(x, *[np.uint8] * 4) for *_, x in rows)]
    keys = concat([k for k, _ in lists], np.uint32)
    order = np.argsort(keys)
    head = np.r_[True, keys[order][1:] != keys[order][:-1]][: len(keys)]
    n = np.add.reduceat(concat([n for _, n in lists], np.uint8)[order].astype(np.int64), np.flatnonzero(head)) \
        if len(keys) else np.empty(0, np.int64)
    level = np.empty(len(keys), np.uint8)
    level[order] = np.repeat(np.ceil(np.log2(n)).astype(np.uint8), np.diff(np.r_[np.flatnonzero(head), len(keys)]))
    out, at = [], 0
    for (b, g, _, _), (k, _) in zip(rows, lists):
        out.append((b, g, 0, pack(level[at : at + len(k)])))
        at += len(k)
    return blob_table(out)


def candidates(table: pa.Table, ids: np.ndarray, replies, size: int, buckets: int, percent: int) -> list[tuple]:
    """(class, size, shingles, prefix) of the classes with a repeated token in every prefix.

    The prefix is the repeated tokens under the first order with their positions, and 4 bytes of those under each
    other order: these only filter.
    """
    by = {b: unpack(x, np.uint8)[0] for b, _, k, x in replies if k == 0}
    told = group_tokens(table, ids, size, buckets)
    keys = concat([(np.uint64(b) << np.uint64(32)) | k.astype(np.uint64) for b, k, _ in told], np.uint64)
    level_of = concat([by[b] for b, *_ in told], np.uint8)
    out, seen = [], set()
    for token, ends, cid in own_sets(table, ids, size):
        b, k = place(token, buckets)
        level = level_of[np.searchsorted(keys, (b.astype(np.uint64) << np.uint64(32)) | k.astype(np.uint64))]
        n = np.diff(ends)
        prefix = n - (percent * n + 99) // 100 + 1
        unique = np.diff(np.r_[0, np.cumsum(level == 0)][ends])
        # Rare tokens come first under every order, so a prefix holds a repeated one only if unique ones leave room.
        for r in np.flatnonzero((n > 0) & (unique < prefix)).tolist():
            if (c := int(cid[r])) in seen:
                continue
            seen.add(c)
            t, lv, m = token[ends[r] : ends[r + 1]], level[ends[r] : ends[r + 1]].astype(np.int64), int(prefix[r])
            prefixes = []
            for salt in ORDERS:
                by_order = np.lexsort((mix(t ^ np.uint64(salt)), lv))[:m]
                pos = np.flatnonzero(lv[by_order] > 0)
                prefixes.append((t[by_order[pos]].view(np.int64), pos))
            key, pos = prefixes[0]
            out.append((c, int(n[r]), t.view(np.int64), key, pos, [k.astype(np.int32) for k, _ in prefixes[1:]]))
    return out


CANDIDATE = pa.schema([("c", pa.int64()), ("n", pa.int64()), ("tokens", pa.list_(pa.int64())), ("key", pa.list_(pa.int64())),
                       ("pos", pa.list_(pa.int64())), ("more", pa.list_(pa.list_(pa.int32())))])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that meet under every other order and whose sets overlap enough."""
    left, right = (sets.select(F.col("c").alias(x), F.col("n").alias(f"{x}n"), F.col("tokens").alias(f"{x}t"),
                               F.col("more").alias(f"{x}m")) for x in "ab")
    both = pairs.join(left, "a").join(right, "b")
    for order in range(len(ORDERS) - 1):
        both = both.where(F.arrays_overlap(F.col("am")[order], F.col("bm")[order]))
    both = both.withColumn("i", F.size(F.array_intersect("at", "bt")))
    return both.where(100 * F.col("i") >= percent * (F.col("an") + F.col("bn") - F.col("i"))).select("a", "b")


def ngram_jaccard_join(docs: DataFrame, size: int = 5, percent: int = 75, group_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id that links reach) of every row of docs."""
    bound_batches(docs.sparkSession)
    spark = docs.sparkSession
    total = text_bytes(docs)
    groups, buckets = group_count(total, group_bytes), group_count(total, 2 * group_bytes)
    meta = cut_lineage(classes(docs, size), spark)
    reps = meta.where("n_shingles > 0 and doc_id is not null").groupBy("_c").agg(F.min("doc_id").alias("doc_id"))

    def names(key, table):
        return blob_table([(0, key[0].as_py(), 5, pack(np.sort(table["doc_id"].to_numpy())))])

    def ids_of(rows) -> np.ndarray:
        return concat([unpack(x, np.int64)[0] for *_, k, x in rows if k == 5], np.int64)

    def send(key, table, own):
        found = group_tokens(table, ids_of(blob_rows(own)), size, buckets)
        return blob_table([(b, key[0].as_py(), 0, pack(*planes(k), n)) for b, k, n in found])

    def answer(table):
        return levels(table)

    def ship(key, table, told):
        rows = blob_rows(told)
        found = candidates(table, ids_of(rows), rows, size, buckets, percent)
        release()
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found), CANDIDATE)], schema=CANDIDATE) \
            if found else CANDIDATE.empty_table()

    own = dealt(docs.select("doc_id", "text"), groups, "doc_id")
    listed = dealt(reps.select("doc_id"), groups, "doc_id").groupBy("_g").applyInArrow(names, BLOBS)
    sent = own.groupBy("_g").cogroup(listed.groupBy("_g")).applyInArrow(lambda k, a, b: send(k, a, b), BLOBS)
    told = sent.groupBy("_b").applyInArrow(answer, BLOBS).unionByName(listed)
    found = own.groupBy("_g").cogroup(told.groupBy("_g")).applyInArrow(
        lambda k, a, b: ship(k, a, b), "c long, n long, tokens array<long>, key array<long>, pos array<long>, more array<array<int>>")
    found = cut_lineage(found, spark)
    sets = found.select("c", "n", "tokens", "more")
    entry = found.select("c", "n", F.explode(F.arrays_zip("key", "pos")).alias("e")).select("c", "n", "e.key", "e.pos")

    # The overlap that two linked sets need, and what their first common token leaves of each.
    need = F.ceil(F.lit(percent) * (F.col("n") + F.col("yn")) / (100 + percent))
    bounds = (F.col("n") - F.col("pos") >= need) & (F.col("yn") - F.col("ypos") >= need)

    typical = entry.groupBy("key").agg(F.min(F.struct("pos", "c", "n")).alias("y")).select(
        "key", F.col("y.c").alias("yc"), F.col("y.n").alias("yn"), F.col("y.pos").alias("ypos"))
    star = entry.join(typical, "key").where((F.col("c") != F.col("yc")) & bounds).select(
        F.greatest("c", "yc").alias("a"), F.least("c", "yc").alias("b")).distinct()
    links = cut_lineage(verified(star, sets, percent), spark)
    near = components(links)
    label = F.coalesce("root", "c")
    placed = entry.join(near.withColumnRenamed("node", "c"), "c", "left").select("c", "n", "key", "pos", label.alias("r"))
    # Tokens held by one component alone need no join; of the others, rows of the token's largest component
    # are never paired among themselves, so a crowd of copies costs one comparison for each row outside it.
    mixed = placed.groupBy("key").agg(F.min("r").alias("lo"), F.max("r").alias("hi")).where("lo <> hi")
    placed = cut_lineage(placed.join(mixed.select("key"), "key", "left_semi"), spark)
    largest = placed.groupBy("key", "r").count().groupBy("key").agg(
        F.max(F.struct("count", "r")).alias("most")).select("key", F.col("most.r").alias("big"))
    outside = placed.join(largest, "key").where("r <> big")
    other = placed.select("key", *(F.col(x).alias(f"y{x}") for x in ("c", "n", "pos", "r")))
    rest = outside.join(other, "key").where(
        (F.col("r") != F.col("yr")) & ((F.col("yr") == F.col("big")) | (F.col("c") > F.col("yc"))) & bounds)
    rest = rest.select(F.greatest("c", "yc").alias("a"), F.least("c", "yc").alias("b")).distinct()
    links = links.unionByName(verified(rest, sets, percent))
    group = components(links)
    one = reps.withColumnRenamed("doc_id", "_first").join(group.withColumnRenamed("node", "_c"), "_c", "left").withColumn(
        "root", F.coalesce("root", "_c"))
    lowest = one.groupBy("root").agg(F.min("_first").alias("component_id"))
    one = one.join(lowest, "root").select("_c", "component_id")
    out = meta.join(one, "_c", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(
        F.col("component_id")).alias("component_id"))
