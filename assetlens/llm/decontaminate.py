"""Benchmark decontamination: a prefix-filtered set join of documents with benchmark windows.

A window is `size` consecutive words of an item, or the whole of a shorter item. Its tokens are
its shingles. A document that holds the window holds all its shingles, so one necessary prefix
token is enough to find it: the window's rarest shingle by document frequency in the corpus.
Documents meet the windows on that token; the offset of the token bounds where the window must
start and end (length and positional bounds), and the words are then compared one by one.

The benchmark is read in blocks of bounded size; each block is one narrow pass over the documents
(no shuffle of texts). Nothing is capped: more windows make more blocks.

Results: null texts have no words, items without words no windows; ties in rarity go to the
shingle with the smaller hash, then to its first place; repeated items count by item_id; items without
item_id mark words as hit and add no name (the SQL of op9 leaves them out); repeated documents each get their row; without benchmark rows nothing is hit; further columns are kept,
and columns that bear the name of a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (bound_batches, ALNUM, LOWER, batches, group_count, mix, spread_starts, text_bytes,
                     word_hashes, words)

SHINGLE = 3
FILTER = 1 << 20


class Known:
    """Sorted 64-bit keys with a bit table in front, for many lookups that mostly fail."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.bits = np.zeros(FILTER, bool)
        self.bits[(self.keys & np.uint64(FILTER - 1)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in h that hold a key, and the index of that key."""
        at = np.flatnonzero(self.bits[(h & np.uint64(FILTER - 1)).astype(np.int64)])
        k = np.searchsorted(self.keys, h[at])
        k[k == len(self.keys)] = 0
        ok = self.keys[k] == h[at] if len(self.keys) else np.zeros(len(at), bool)
        return at[ok], k[ok]


def read_words(buf: np.ndarray, off: np.ndarray):
    low = LOWER[buf]
    starts, ends, rows = words(low, off, ALNUM)
    return word_hashes(low, starts, ends), rows


class Windows:
    """Distinct windows of a block of items: their words, their items, and the shingles they hold."""

    def __init__(self, items: list[tuple[str | None, str]], size: int):
        grams: dict[bytes, set[str]] = {}
        for name, text in items:
            buf = np.frombuffer(text.encode(), np.uint8)
            h, _ = read_words(buf, np.array([0, len(buf)]))
            for i in range(max(1, len(h) - size + 1) if len(h) else 0):
                grams.setdefault(h[i : i + size].tobytes(), set()).update(() if name is None else (name,))
        rows = sorted(grams)
        self.length = np.array([len(r) // 8 for r in rows], np.int64)
        self.words = np.zeros((len(rows), size), np.uint64)
        for i, r in enumerate(rows):
            self.words[i, : len(r) // 8] = np.frombuffer(r, np.uint64)
        self.items = [sorted(grams[r]) for r in rows]
        self.size = size
        self.shingle = np.minimum(self.length, SHINGLE)
        # All shingles of all windows, as (window, offset, hash).
        n = self.length - self.shingle + 1
        self.of = np.repeat(np.arange(len(rows)), n)
        self.offset = spread_starts(np.zeros(len(rows), np.int64), n)
        h = np.empty(len(self.of), np.uint64)
        for k in range(1, SHINGLE + 1):
            at = np.flatnonzero(self.shingle[self.of] == k)
            h[at] = shingle_hash(np.stack([self.words[self.of[at], self.offset[at] + j] for j in range(k)], 1)) \
                if len(at) else h[at]
        self.hash = h
        self.known = Known(h)

    def choose(self, frequency: dict[int, int]) -> None:
        """Keep each window's rarest shingle as its prefix token."""
        df = np.array([frequency.get(int(k), 0) for k in self.known.keys], np.int64)[
            np.searchsorted(self.known.keys, self.hash)] if len(self.hash) else np.empty(0, np.int64)
        order = np.lexsort((self.offset, self.hash, df, self.of))
        first = order[np.r_[True, self.of[order][1:] != self.of[order][:-1]]] if len(order) else order
        token = self.hash[first]
        by = np.argsort(token, kind="stable")
        self.window, self.at = self.of[first][by], self.offset[first][by]
        self.token = Known(token)
        self.begin = np.searchsorted(token[by], self.token.keys)
        self.many = np.diff(np.r_[self.begin, len(token)])
        self.of = self.offset = self.hash = self.known = None


def shingle_hash(parts: np.ndarray) -> np.ndarray:
    out = np.full(len(parts), parts.shape[1], np.uint64)
    for j in range(parts.shape[1]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, j])
    return out


def document_shingles(h: np.ndarray, rows: np.ndarray, sizes: list[int]):
    """(shingle hash, start) of every shingle inside a row, for each size that windows use."""
    for k in sizes:
        n = len(h) - k + 1
        if n > 0:
            out = np.full(n, k, np.uint64)
            for j in range(k):
                out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n])
            yield k, out


def frequencies(docs: DataFrame, block: Windows) -> dict[int, int]:
    """Documents that hold each shingle of the block, counted over the whole corpus."""
    shared = docs.sparkSession.sparkContext.broadcast((block.known, sorted(set(block.shingle.tolist()))))

    def count(tables):
        known, sizes = shared.value
        total = np.zeros(len(known.keys), np.int64)
        for t in tables:
            for _, buf, off in batches(t.column("text")):
                h, rows = read_words(buf, off)
                for _, s in document_shingles(h, rows, sizes):
                    at, k = known.find(s)
                    pair = np.unique((np.searchsorted(rows, at, "right") << 32) | k)
                    total += np.bincount(pair & 0xFFFFFFFF, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(known.keys[at].view(np.int64)), pa.array(total[at])], ["k", "n"])

    rows = docs.select("text").mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    return {r.k & (2**64 - 1): r.n for r in rows}


def block_hits(block: Windows, h: np.ndarray, rows: np.ndarray):
    """(start, window) of every occurrence of a window in the words h of rows."""
    found_at, found_w = [], []
    for k, s in document_shingles(h, rows, sorted(set(block.shingle.tolist()))):
        at, key = block.token.find(s)
        which = spread_starts(block.begin[key], block.many[key])
        at = np.repeat(at, block.many[key])
        w = block.window[which]
        start = at - block.at[which]
        row = np.searchsorted(rows, at, "right") - 1
        ok = (block.shingle[w] == k) & (start >= rows[row]) & (start + block.length[w] <= rows[row + 1])
        start, w = start[ok], w[ok]
        for j in range(block.size):
            inside = block.length[w] > j
            same = np.ones(len(w), bool)
            same[inside] = h[start[inside] + j] == block.words[w[inside], j]
            start, w = start[same], w[same]
        found_at.append(start)
        found_w.append(w)
    return np.concatenate(found_at) if found_at else np.empty(0, np.int64), \
        np.concatenate(found_w) if found_w else np.empty(0, np.int64)


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10, block_bytes: int = 4 << 20) -> DataFrame:
    """Rows of docs with n_words, n_hit and items (ids of the items found, as sorted strings)."""
    bound_batches(docs.sparkSession)
    names = ("n_words", "n_hit", "items")
    rest = [docs.schema[c] for c in docs.columns if c not in names]
    bench = benchmark.where(F.col("text").isNotNull()).select(
        F.col("item_id").cast("string").alias("item_id"), "text")
    blocks = group_count(text_bytes(bench), block_bytes, 1)
    markers = []
    out = docs.select(*(f.name for f in rest), F.lit(None).cast("binary").alias("_hit"),
                      F.array().cast("array<string>").alias("_items"))
    for b in range(blocks):
        # Bounded: one block of the benchmark, about block_bytes of text.
        rows = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).distinct().collect()
        block = Windows([(r.item_id, r.text) for r in rows], size)
        if not len(block.items):
            continue
        block.choose(frequencies(docs, block))
        markers.append(_marker(docs.sparkSession.sparkContext.broadcast(block)))

    def run(tables):
        # One Python worker for all blocks: texts go to Python and back once.
        for mark in markers:
            tables = mark(tables)
        yield from _counter()(tables)

    return out.mapInArrow(run, T.StructType([
        *rest, T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType()))]))


def _marker(shared):
    def run(tables):
        block = shared.value
        for t in tables:
            if not t.num_rows:
                continue
            hit, items = t.column("_hit").to_pylist(), t.column("_items").to_pylist()
            for at, buf, off in batches(t.column("text")):
                h, rows = read_words(buf, off)
                start, w = block_hits(block, h, rows)
                if not len(start):
                    continue
                cover = np.zeros(len(h) + 1, np.int32)
                np.add.at(cover, start, 1)
                np.add.at(cover, start + block.length[w], -1)
                covered = np.cumsum(cover)[:-1] > 0
                row = np.searchsorted(rows, start, "right") - 1
                for r in np.unique(row).tolist():
                    own = covered[rows[r] : rows[r + 1]]
                    if hit[at + r] is not None:
                        own = own | np.unpackbits(np.frombuffer(hit[at + r], np.uint8), count=len(own)).astype(bool)
                    hit[at + r] = np.packbits(own).tobytes()
                    new = {x for i in np.unique(w[row == r]) for x in block.items[i]}
                    items[at + r] = sorted(new | set(items[at + r]))
            cols = [t.column(c) for c in t.schema.names[:-2]]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(hit, pa.binary()), pa.array(items, pa.list_(pa.string()))],
                                             t.schema.names)
    return run


def _counter():
    def run(tables):
        for t in tables:
            if not t.num_rows:
                continue
            n = np.zeros(t.num_rows, np.int64)
            for at, buf, off in batches(t.column("text")):
                _, rows = words_only(buf, off)
                n[at : at + len(off) - 1] = np.diff(rows)
            hit = [0 if x is None else int(np.unpackbits(np.frombuffer(x, np.uint8)).sum())
                   for x in t.column("_hit").to_pylist()]
            names = t.schema.names[:-2]
            yield pa.RecordBatch.from_arrays(
                [*(t.column(c) for c in names), pa.array(n), pa.array(hit, pa.int64()), t.column("_items")],
                [*names, "n_words", "n_hit", "items"])
    return run


def words_only(buf, off):
    starts, _, rows = words(LOWER[buf], off, ALNUM)
    return starts, rows
