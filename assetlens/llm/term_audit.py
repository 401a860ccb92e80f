"""Source divergence audit with late string materialization.

Terms are runs of letters (every character beyond ASCII is one). Documents are read in bounded batches;
a batch is reduced to counts by (lang, source, digest), and to one row a digest with the least and the
greatest text met for it. Both kinds of rows are written at rest, and only the digests with their counts
are shuffled for the counting: fixed-width keys, reduced in the batch before. Terms in at least
`least_docs` documents of a lang are kept. For kept digests the least and greatest text are then compared
over all batches: where they differ, several terms share a digest, these digests are split, which means
that their terms take a wider digest of their own, and the counting runs again. Text is joined back only
for rows that are returned.

A term's share in a group is p = 1 + floor(UNIT * (count + 1) / (N + V)), N the group's counts over the V
kept terms of the lang, and the divergence of a term between p and q is floor((p - q)^2 / q), all exact.
Pairs of sources are compared in blocks of terms by blocks of at most `tile` sources: a block returns one
sum for each pair of its sources and nothing for each term, so no pair of rows of a term is ever emitted.

Results: null text, lang or source is read as ''; a group without terms takes part with counts of 0; a
lang without kept terms has value 0 for every pair of its sources and no term rows; repeated rows and
repeated ids are documents of their own; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, batches, bound_batches, discard, release, saved, spread_starts, word_hashes, words, written_at

UNIT = 1_000_000_000
#: Runs of bytes other than these are terms.
LETTERS = np.ones(256, bool)
LETTERS[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
ROWS = "kind int, lang string, source string, digest long, n long, df long, low string, high string"
BLOCK_ROWS = 200_000


def wide(term: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(term, digest_size=8).digest(), "little")


def digested(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, mask: np.uint64, split: np.ndarray) -> np.ndarray:
    """Digest of each term; terms whose digest was found to be shared get another one, by a hash of its own."""
    h = word_hashes(low, starts, ends) & mask
    for i in np.flatnonzero(np.isin(h, split)) if len(split) else ():
        h[i] = wide(low[starts[i] : ends[i]].tobytes())
    return h


def extremes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray):
    """Distinct digests with their least and greatest text; texts are compared as bytes against the first of each digest."""
    keys, first, back = np.unique(h, return_index=True, return_inverse=True)
    size = ends - starts
    lead = first[back]
    other = size != size[lead]
    same = np.flatnonzero(~other)
    at, to = spread_starts(starts[same], size[same]), spread_starts(starts[lead[same]], size[same])
    differs = low[at] != low[to]
    if differs.any():
        other[same[np.repeat(np.arange(len(same)), size[same])[differs]]] = True
    text = [low[starts[i] : ends[i]].tobytes() for i in first.tolist()]
    least, most = text, list(text)
    for i in np.flatnonzero(other).tolist():
        t, k = low[starts[i] : ends[i]].tobytes(), back[i]
        least[k], most[k] = min(least[k], t), max(most[k], t)
    return keys, least, most


class Batch:
    """Counts and texts of the terms of some documents, until they are told."""

    def __init__(self, mask: int, split: np.ndarray):
        self.mask, self.split = np.uint64(mask), split
        self.clear()

    def clear(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.parts, self.texts, self.size = [], {}, 0

    def add(self, langs: list[str], sources: list[str], buf: np.ndarray, off: np.ndarray) -> None:
        group = np.array([self.groups.setdefault(k, len(self.groups)) for k in zip(langs, sources)], np.int64)
        low = LOWER[buf]
        starts, ends, rows = words(low, off, LETTERS)
        if not len(starts):
            return
        h = digested(low, starts, ends, self.mask, self.split)
        for k, a, z in zip(*extremes(low, starts, ends, h)):
            old = self.texts.get(k)
            self.texts[k] = (a, z) if old is None else (min(a, old[0]), max(z, old[1]))
        row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        head = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])])
        self.parts.append(summed(group[row[head]], h[head], np.diff(np.r_[head, len(h)]), np.ones(len(head), np.int64)))
        self.size += len(buf)

    def told(self):
        """Rows of both kinds."""
        if self.parts:
            g, h, n, df = summed(*(np.concatenate(c) for c in zip(*self.parts)))
            lang, source = (pa.array([k[i] for k in self.groups], pa.string()).take(pa.array(g)) for i in (0, 1))
            yield table(len(g), kind=np.zeros(len(g), np.int32), lang=lang, source=source, digest=h.view(np.int64), n=n, df=df)
            keys = np.array(list(self.texts), np.uint64)
            low, high = zip(*((a, z if z != a else None) for a, z in self.texts.values()))
            yield table(len(keys), kind=np.ones(len(keys), np.int32), digest=keys.view(np.int64),
                        low=pa.array(low, pa.binary()).cast(pa.string()), high=pa.array(high, pa.binary()).cast(pa.string()))
        self.clear()
        release()


SCHEMA = pa.schema([("kind", pa.int32()), ("lang", pa.string()), ("source", pa.string()), ("digest", pa.int64()), ("n", pa.int64()),
                    ("df", pa.int64()), ("low", pa.string()), ("high", pa.string())])


def table(rows: int, /, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [columns[f.name] if isinstance(columns.get(f.name), pa.Array) else pa.array(columns[f.name], f.type) if f.name in columns
         else pa.nulls(rows, f.type) for f in SCHEMA], schema=SCHEMA)


def summed(g: np.ndarray, h: np.ndarray, n: np.ndarray, df: np.ndarray):
    """Sums of n and df by (g, h)."""
    order = np.lexsort((h, g))
    g, h = g[order], h[order]
    head = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (h[1:] != h[:-1])])
    return g[head], h[head], np.add.reduceat(n[order], head), np.add.reduceat(df[order], head)


def counted(docs: DataFrame, mask: int, split: list[int], batch_bytes: int) -> DataFrame:
    """Rows of ROWS: kind 0 are counts of (lang, source, digest) in a batch, kind 1 the texts of a digest in a batch.

    high is null where one text was met.
    """
    # Shared digests of 64 bits: none, but for texts made to collide.
    known = docs.sparkSession.sparkContext.broadcast(np.array(split, np.int64).view(np.uint64))

    def run(tables):
        batch = Batch(mask, known.value)
        for t in tables:
            langs, sources = t.column("lang").to_pylist(), t.column("source").to_pylist()
            for at, buf, off in batches(t.column("text")):
                n = len(off) - 1
                batch.add(langs[at : at + n], sources[at : at + n], buf, off)
                if batch.size >= batch_bytes:
                    yield from batch.told()
        yield from batch.told()
    return docs.mapInArrow(run, ROWS)


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + kept)), exact while counts have at most 28 digits."""
    wide = lambda c: c.cast("decimal(28,0)")
    return F.call_function("div", wide(n + 1) * F.lit(UNIT).cast("decimal(10,0)"), wide(total + kept)) + F.lit(1)


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def block_sums(block: pa.Table) -> pa.Table:
    """Sums of the divergences of each source of the rows' tile from each of the columns' tile, over the block's terms.

    Rows with a null digest tell the share of a term that a source does not hold.
    """
    side, sid, p = (block[c].to_numpy() for c in ("side", "sid", "p"))
    digest = block["digest"].combine_chunks()
    none = digest.is_null().to_numpy(zero_copy_only=False)
    digest = digest.fill_null(0).to_numpy()
    names, zero = [], []
    for s in (0, 1):
        some = none & (side == s)
        order = np.argsort(sid[some])
        names.append(sid[some][order])
        zero.append(p[some][order])
    keys, term = np.unique(digest[~none], return_inverse=True)
    side, sid, p = side[~none], sid[~none], p[~none]
    order = np.argsort(term, kind="stable")
    side, sid, p, term = side[order], sid[order], p[order], term[order]
    total = np.zeros((len(names[0]), len(names[1])), np.int64)
    step = max(1, (1 << 18) // max(1, len(names[0]) + len(names[1])))
    for lo in range(0, len(keys), step):
        hi = min(lo + step, len(keys))
        part = slice(*np.searchsorted(term, (lo, hi)))
        shares = []
        for s in (0, 1):
            m = np.repeat(zero[s][:, None], hi - lo, 1)
            own = side[part] == s
            m[np.searchsorted(names[s], sid[part][own]), term[part][own] - lo] = p[part][own]
            shares.append(m)
        for j, q in enumerate(shares[1]):
            d = shares[0] - q
            total[:, j] += (d * d // q).sum(1)
    a, b = np.repeat(names[0], len(names[1])), np.tile(names[1], len(names[0]))
    return pa.table({"sid": a, "other": b, "s": total.reshape(-1), "seen": np.full(len(a), len(keys), np.int64)})


def pair_sums(kept: DataFrame, groups: DataFrame, n_rows: int, tile: int) -> DataFrame:
    """(lid, sid, other, value) of each ordered pair of sources of a lang. kept: lid, sid, digest, p; groups: + p0, v."""
    blocks = max(1, -(-n_rows // BLOCK_ROWS))
    tiles = groups.groupBy("lid").agg(F.floor(F.max("sid") / tile).cast("long").alias("last"))
    own = F.floor(F.col("sid") / tile).cast("long")
    every = F.sequence(F.lit(0).cast("long"), F.col("last"))

    def sided(rows):
        """Each row as one of the rows' tile against all tiles, and as one of the columns' tile."""
        rows = rows.join(tiles, "lid")
        a = rows.withColumn("j", F.explode(every)).withColumn("i", own).withColumn("side", F.lit(0))
        b = rows.withColumn("i", F.explode(every)).withColumn("j", own).withColumn("side", F.lit(1))
        return a.unionByName(b).drop("last")

    some = kept.select("lid", "sid", "digest", "p", F.pmod("digest", F.lit(blocks)).alias("block"))
    zeros = groups.select("lid", "sid", F.lit(None).cast("long").alias("digest"), F.col("p0").alias("p"),
                          F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))

    def work(key, block):
        out = block_sums(block)
        return out.append_column("lid", pa.array([key[0].as_py()] * out.num_rows, pa.int64())).select(["lid", "sid", "other", "s", "seen"])

    sums = (sided(some.unionByName(zeros)).groupBy("lid", "i", "j", "block").applyInArrow(work, "lid long, sid long, other long, s long, seen long")
            .groupBy("lid", "sid", "other").agg(F.sum("s").alias("s"), F.sum("seen").alias("seen")))
    b = groups.select("lid", F.col("sid").alias("other"), F.col("p0").alias("q0"))
    sums = sums.where("sid <> other").join(groups, ["lid", "sid"]).join(b, ["lid", "other"])
    # Terms that no block has shown are held by neither: they all diverge alike.
    return sums.select("lid", "sid", "other", (F.col("s") + (F.col("v") - F.col("seen")) * gap(F.col("p0"), F.col("q0"))).alias("value"))


def term_audit(docs: DataFrame, least_docs: int = 3, top: int = 200, tile: int = 256, batch_bytes: int = 24 << 20,
               bits: int = 64) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank of every (lang, source) group of docs (lang, source, text).

    bits: width of the first digests; fewer make collisions, which must not change a result.
    """
    bound_batches(docs.sparkSession)
    spark = docs.sparkSession
    docs = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    named = docs.groupBy("lang", "source").count().select("lang", "source")
    langs = saved(named.select("lang").distinct().withColumn("lid", F.monotonically_increasing_id()), spark)
    sid = (F.row_number().over(Window.partitionBy("lid").orderBy("source")) - 1).cast("long")
    names = saved(named.join(langs, "lang").withColumn("sid", sid), spark)
    split: list[int] = []
    while True:
        told, path = written_at(counted(docs, (1 << bits) - 1, split, batch_bytes), spark)
        counts = told.where("kind = 0").join(names, ["lang", "source"])
        counts = counts.groupBy("lid", "digest", "sid").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
        whole = Window.partitionBy("lid", "digest")
        counts = counts.withColumns({"lang_n": F.sum("n").over(whole), "lang_df": F.sum("df").over(whole),
                                     "lead": F.row_number().over(whole.orderBy("sid")) == 1})
        counts = saved(counts.where(F.col("lang_df") >= least_docs).select("lid", "sid", "digest", "n", "lang_n", "lead"), spark)
        # Texts are reduced in each batch before they move, once for all langs.
        high = F.max(F.coalesce("high", "low"))
        texts = told.where("kind = 1").repartition("digest").groupBy("digest").agg(F.min("low").alias("low"), high.alias("high"))
        texts = saved(texts.join(counts.select("digest").distinct(), "digest", "left_semi"), spark)
        discard(spark, path)
        shared = [r[0] for r in texts.where("low <> high").select("digest").toLocalIterator()]
        if not shared:
            break
        split += shared
    langs = counts.groupBy("lid").agg(F.sum("n").alias("lang_total"), F.sum(F.col("lead").cast("long")).alias("v"))
    sums = counts.groupBy("lid", "sid").agg(F.sum("n").alias("total"))
    groups = names.select("lid", "sid").join(langs, "lid", "left").join(sums, ["lid", "sid"], "left").fillna(0, ["lang_total", "v", "total"])
    p0 = share(F.lit(0).cast("long"), F.col("total"), F.greatest("v", F.lit(1)))
    groups = saved(groups.withColumn("p0", F.when(F.col("v") > 0, p0).otherwise(F.lit(1))), spark)
    kept = counts.join(groups.select("lid", "sid", "total", "lang_total", "v"), ["lid", "sid"])
    kept = kept.withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))
    order = lambda *by: Window.partitionBy(*by).orderBy(F.desc("value"), "item")

    # A lang without kept terms has blocks of zero rows only, which give 0 for every pair.
    pairs = pair_sums(kept.select("lid", "sid", "digest", "p"), groups.select("lid", "sid", "p0", "v"), counts.count(), tile)
    pairs = pairs.join(names.select("lid", F.col("sid").alias("other"), F.col("source").alias("item")), ["lid", "other"])
    pairs = pairs.join(names, ["lid", "sid"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(order("lang", "source")))

    q = share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    terms = kept.withColumn("q", q).where("p > q").withColumn("value", gap(F.col("p"), F.col("q")))
    # Ranked without texts first: ties at the last rank all stay until their texts are there.
    terms = terms.withColumn("at", F.rank().over(Window.partitionBy("lid", "sid").orderBy(F.desc("value")))).where(F.col("at") <= top)
    terms = terms.select("lid", "sid", "digest", "value").join(texts.select("digest", F.col("low").alias("item")), "digest")
    terms = terms.join(names, ["lid", "sid"]).select("lang", "source", F.lit("term").alias("part"), "item", "value")
    terms = terms.withColumn("rank", F.row_number().over(order("lang", "source"))).where(F.col("rank") <= top)
    return pairs.unionByName(terms)
