"""Documents whose windows occur elsewhere: the exchange shared by the two substring operators.

A unit is a byte or a word. Two equal windows of `window` units hold equal k-gram minima, so
work goes in three passes over the same dealt documents:

1. every group sends the hashes of its winnowed k-grams; buckets answer which occur twice;
2. a window can only repeat if all k-gram minima inside it do. Runs of such windows that share
   the window's minimum are cut out as chunks and sent to the shard of that minimum, so equal
   windows always meet. Equal chunks of one group travel once, so a copied passage costs a shard
   one row per group, never one per copy. Windows of a minimum met over `hot` times would crowd
   one shard; they travel as sorted runs of 128-bit digests, dealt by digest over all shards;
3. shards answer with one bit per window, and the documents are cut.

Nothing is dropped: the filters use necessary conditions and the shards decide on whole windows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import (bound_batches, BLOBS, batches, blob_rows, blob_table, concat, cut, dealt, group_count, mix, pack, prefix_hash,
                     release, rows_of, sliding, spread_starts, text_bytes, unpack, window_hash)

TOP = np.uint64(2**64 - 1)


@dataclass(frozen=True)
class Rules:
    """window: units that make a repeat; gram and span: k-gram size and winnowing span, in units."""

    window: int
    gram: int
    span: int
    units: Callable      # (bytes, row offsets) -> (hash values, row offsets in units, payload of each unit)
    payload: type        # numpy kind of the payload
    judge: Callable      # (payload, chunk lengths, multiplicities, window) -> bool per window
    hot: int = 20_000


@dataclass
class Windows:
    """Of one batch: hash of windows' minima, which windows may repeat, and their chunks."""

    minima: np.ndarray
    may: np.ndarray
    prefix: np.ndarray
    payload: np.ndarray
    offsets: np.ndarray


def anchors(rules: Rules, values: np.ndarray, offsets: np.ndarray):
    """k-gram hashes (TOP where one crosses rows) and the minima of every span of k-grams."""
    p = prefix_hash(values)
    h = window_hash(p, rules.gram)
    if not len(h):
        return p, h, h
    ends = offsets[1:-1]
    crossing = spread_starts(np.maximum(ends - rules.gram + 1, 0), ends - np.maximum(ends - rules.gram + 1, 0))
    h[crossing[crossing < len(h)]] = TOP
    return p, h, sliding(np.minimum, h, rules.span) if len(h) >= rules.span else h[:0]


def anchor_hashes(rules: Rules, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct winnowed k-gram hashes of a group, with how often each stands there (255 at most)."""
    found = []
    for _, buf, off in batches(table["text"]):
        values, rows, _ = rules.units(buf, off)
        _, h, low = anchors(rules, values, rows)
        if not len(low):
            continue
        reach = rules.gram + rules.span - 1
        first = np.maximum(rows[1:-1] - reach + 1, 0)
        low = low.copy()
        over = spread_starts(first, rows[1:-1] - first)
        low[over[over < len(low)]] = 0  # spans over two rows would make the set depend on the order of rows
        pad = np.zeros(rules.span - 1, np.uint64)
        high = sliding(np.maximum, np.r_[pad, low, pad], rules.span)
        keys, n = np.unique(h[(h == high) & (h != TOP)], return_counts=True)
        found.append((keys, n))
    keys, at = np.unique(concat([k for k, _ in found], np.uint64), return_inverse=True)
    n = np.bincount(at, concat([n for _, n in found], np.int64), len(keys))
    return keys, np.minimum(n, 255).astype(np.uint8)


def flags_of(rules: Rules, bucket: pa.Table) -> pa.Table:
    """Answers of an anchor bucket: per group, which of its hashes stand twice, and which are hot."""
    rows = blob_rows(bucket)
    lists = [unpack(blob, np.uint64, np.uint8) for *_, blob in rows]
    keys, at = np.unique(concat([k for k, _ in lists], np.uint64), return_inverse=True)
    total = np.bincount(at, concat([n for _, n in lists], np.uint8), len(keys))[at]
    out, i = [], 0
    for (b, g, _, _), (k, _) in zip(rows, lists):
        n = total[i : i + len(k)]
        out.append((b, g, 0, pack(np.packbits(n > 1), np.packbits(n >= rules.hot))))
        i += len(k)
    return blob_table(out)


def flagged(table: pa.Table, answers, buckets: int, rules: Rules) -> tuple[np.ndarray, np.ndarray]:
    """The group's repeated k-gram hashes, sorted, and which of them are hot."""
    keys, _ = anchor_hashes(rules, table)
    order, which, bounds = cut(keys, buckets)
    twice, hot = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    at = {int(b): i for i, b in enumerate(which)}
    for b, _, kind, blob in answers:
        if kind == 0:
            a, z = bounds[at[b]], bounds[at[b] + 1]
            one, two = unpack(blob, np.uint8, np.uint8)
            twice[order[a:z]] = np.unpackbits(one, count=z - a).astype(bool)
            hot[order[a:z]] = np.unpackbits(two, count=z - a).astype(bool)
    return keys[twice], hot[twice]


def windows_of(rules: Rules, buf, off, repeated: np.ndarray) -> Windows | None:
    values, rows, payload = rules.units(buf, off)
    p, h, low = anchors(rules, values, rows)
    n = len(values) - rules.window + 1
    if n <= 0 or not len(repeated):
        return None
    runs = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    at = np.searchsorted(repeated, low[runs])
    at[at == len(repeated)] = 0
    known = repeated[at] == low[runs]
    bad = np.zeros(len(low) + 1, np.int32)
    np.cumsum(np.repeat(~known, np.diff(np.r_[runs, len(low)])), out=bad[1:])
    inner = rules.window - rules.gram - rules.span + 2
    may = bad[inner : inner + n] == bad[:n]
    ends = rows[1:]
    first = np.maximum(ends - rules.window + 1, rows[:-1])
    stop = spread_starts(first, ends - first)
    may[stop[stop < n]] = False
    return Windows(sliding(np.minimum, h, rules.window - rules.gram + 1), may, p, payload, rows)


def chunk_runs(w: Windows) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of each run that may repeat and shares its minimum."""
    where = np.flatnonzero(w.may)
    if not len(where):
        return where, where
    new = np.r_[True, (where[1:] != where[:-1] + 1) | (w.minima[where[1:]] != w.minima[where[:-1]])]
    at = np.flatnonzero(new)
    return where[at], np.diff(np.r_[at, len(where)])


def collect_chunks(rules: Rules, table: pa.Table, repeated, hot):
    """Of a group: chunks as (first, count, minimum, digest, batch), hot windows as digests, and the batches."""
    state, chunks, points = [], [], []
    for row, buf, off in batches(table["text"]):
        w = windows_of(rules, buf, off, repeated)
        state.append((row, buf, off, w))
        if w is None:
            continue
        first, count = chunk_runs(w)
        low = w.minima[first]
        is_hot = hot[np.searchsorted(repeated, low)] if len(low) else np.empty(0, bool)
        spot = spread_starts(first[is_hot], count[is_hot])
        points.append((len(state) - 1, spot, digest(w.prefix, spot, rules.window), digest2(w.payload, spot, rules.window)))
        first, count, low = first[~is_hot], count[~is_hot], low[~is_hot]
        own = digest(w.prefix, first, rules.window + count - 1)
        chunks.append((np.full(len(first), len(state) - 1), first, count, low, own))
    join = lambda parts, kinds: [concat([p[i] for p in parts], k) for i, k in enumerate(kinds)]
    return state, join(chunks, (np.int64, np.int64, np.int64, np.uint64, np.uint64)), \
        [(np.full(len(s), b), s, d, e) for b, s, d, e in points]


def digest(prefix: np.ndarray, start: np.ndarray, size) -> np.ndarray:
    from .common import span_hash
    return span_hash(prefix, start, start + size)


def digest2(payload: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """A second hash of windows, of their payload under other values."""
    if not len(start):
        return np.empty(0, np.uint64)
    return digest(prefix_hash(mix(payload.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))), start, size)


def chunk_blobs(rules: Rules, g: int, state, chunks, points, buckets: int):
    """Blobs to the shards, and for each chunk and point the place of its answer."""
    batch, first, count, low, own = chunks
    distinct, lead, back, times = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
    order, which, bounds = cut(low[lead], buckets)
    lead_sorted = lead[order]
    place = np.empty(len(distinct), np.int64)
    place[order] = np.arange(len(order))
    out = []
    sizes = count[lead_sorted] + rules.window - 1
    for i, b in enumerate(which):
        a, z = bounds[i], bounds[i + 1]
        text = [state[batch[j]][3].payload[first[j] : first[j] + s] for j, s in zip(lead_sorted[a:z], sizes[a:z])]
        out.append((int(b), g, 1, pack(sizes[a:z].astype(np.int32), np.minimum(times[order][a:z], 2).astype(np.uint8),
                                       np.concatenate(text))))
    one = concat([d for _, _, d, _ in points], np.uint64)
    two = concat([e for _, _, _, e in points], np.uint64)
    pairs = np.rec.fromarrays([one, two])
    keys, pback, ptimes = np.unique(pairs, return_inverse=True, return_counts=True)
    porder, pwhich, pbounds = cut(keys["f0"], buckets)
    for i, b in enumerate(pwhich):
        take = porder[pbounds[i] : pbounds[i + 1]]
        out.append((int(b), g, 2, pack(keys["f0"][take], keys["f1"][take], np.minimum(ptimes[take], 2).astype(np.uint8))))
    return out, (which, bounds, count[lead_sorted], place[back]), (pwhich, pbounds, porder, pback)


def merge_runs(runs: list) -> list[np.ndarray]:
    """Cross-shard merge: each sorted run is looked up by binary search in the merged others."""
    merged = np.sort(np.concatenate([np.rec.fromarrays([a, b]) for a, b, _ in runs]))
    out = []
    for a, b, n in runs:
        own = np.rec.fromarrays([a, b])
        out.append((n > 1) | (np.searchsorted(merged, own, "right") - np.searchsorted(merged, own, "left") > 1))
    return out


def judged(rules: Rules, bucket: pa.Table) -> pa.Table:
    """Answers of a shard: bits per window of each group's chunks and digests."""
    rows = blob_rows(bucket)
    out = rows_of([r for r in rows if r[2] == 0])
    parts = [(b, g, unpack(x, np.int32, np.uint8, rules.payload)) for b, g, k, x in rows if k == 1]
    if parts:
        sizes = concat([p[0] for *_, p in parts], np.int32).astype(np.int64)
        times = concat([p[1] for *_, p in parts], np.uint8).astype(np.int64)
        data = concat([p[2] for *_, p in parts], rules.payload)
        starts = np.cumsum(sizes) - sizes
        own = digest(prefix_hash(mix(data.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))), starts, sizes)
        _, lead, back = np.unique(own, return_index=True, return_inverse=True)
        total = np.bincount(back, times, len(lead)).astype(np.int64)
        text = data[spread_starts(starts[lead], sizes[lead])]
        bits = rules.judge(text, sizes[lead], total, rules.window)
        n = sizes[lead] - rules.window + 1
        at = np.cumsum(n) - n
        i = 0
        for b, g, p in parts:
            own = back[i : i + len(p[0])]
            out.append((b, g, 1, pack(np.packbits(bits[spread_starts(at[own], n[own])]))))
            i += len(p[0])
    runs = [(b, g, unpack(x, np.uint64, np.uint64, np.uint8)) for b, g, k, x in rows if k == 2]
    if runs:
        for (b, g, _), bits in zip(runs, merge_runs([r for *_, r in runs])):
            out.append((b, g, 2, pack(np.packbits(bits))))
    return blob_table(out)


def marked(rules: Rules, table: pa.Table, answers, buckets: int, shards: int):
    """(first row, bytes, row offsets, unit offsets, covered units) of each batch of a group."""
    repeated, hot = flagged(table, answers, buckets, rules)
    state, chunks, points = collect_chunks(rules, table, repeated, hot)
    _, (which, bounds, counts, place), (pwhich, pbounds, porder, pback) = chunk_blobs(
        rules, 0, state, chunks, points, shards)
    begin = np.cumsum(counts) - counts
    bits, pbits = np.zeros(int(counts.sum()), bool), np.zeros(len(porder), bool)
    at, pat = {int(b): i for i, b in enumerate(which)}, {int(b): i for i, b in enumerate(pwhich)}
    for b, _, kind, blob in answers:
        if kind == 1:
            a, z = bounds[at[b]], bounds[at[b] + 1]
            lo, hi = begin[a], begin[z - 1] + counts[z - 1]
            bits[lo:hi] = np.unpackbits(unpack(blob, np.uint8)[0], count=hi - lo).astype(bool)
        elif kind == 2:
            take = porder[pbounds[pat[b]] : pbounds[pat[b] + 1]]
            pbits[take] = np.unpackbits(unpack(blob, np.uint8)[0], count=len(take)).astype(bool)
    batch, first, count, *_ = chunks
    told = bits[spread_starts(begin[place], count)] if len(place) else bits[:0]
    where, owner = spread_starts(first, count)[told], np.repeat(batch, count)[told]
    hit = pbits[pback] if len(pback) else pbits[:0]
    where = np.r_[where, concat([s for _, s, *_ in points], np.int64)[hit]]
    owner = np.r_[owner, concat([b for b, *_ in points], np.int64)[hit]]
    for i, (row, buf, off, w) in enumerate(state):
        rows = w.offsets if w is not None else rules.units(buf, off)[1]
        cover = np.zeros(rows[-1] + 1, np.int32)
        mine = where[owner == i]
        np.add.at(cover, mine, 1)
        np.add.at(cover, mine + rules.window, -1)
        yield row, buf, off, rows, np.cumsum(cover)[:-1] > 0


def remove_repeats(docs: DataFrame, rules: Rules, finish: Callable, extra: T.StructType, group_bytes: int,
                   shard_bytes: int) -> DataFrame:
    """Rows of docs with the columns of `extra`, made by finish(bytes, offsets, unit offsets, covered)."""
    bound_batches(docs.sparkSession)
    total = text_bytes(docs)
    groups, buckets, shards = (group_count(total, n) for n in (group_bytes, 4 * group_bytes, shard_bytes))
    rest = [f for f in docs.schema.fields if f.name not in {x.name for x in extra.fields}]
    own = dealt(docs, groups, "doc_id")
    schema = T.StructType([*rest, *extra.fields])
    arrow = to_arrow_schema(schema)

    def send(key, table):
        keys, n = anchor_hashes(rules, table)
        order, which, bounds = cut(keys, buckets)
        return blob_table([(int(b), key[0].as_py(), 0, pack(keys[o := order[bounds[i]:bounds[i + 1]]], n[o]))
                           for i, b in enumerate(which)])

    def answer(table):
        return flags_of(rules, table)

    def ship(key, table, replies):
        rows = blob_rows(replies)
        state, chunks, points = collect_chunks(rules, table, *flagged(table, rows, buckets, rules))
        # The flags travel along, so that one plan holds all passes and the dealt documents are shuffled once.
        return blob_table([*rows_of(rows), *chunk_blobs(rules, key[0].as_py(), state, chunks, points, shards)[0]])

    def decide(table):
        return judged(rules, table)

    def close(table, replies):
        new = [finish(*x[1:]) for x in marked(rules, table, blob_rows(replies), buckets, shards)]
        release()
        cols = [table[f.name].cast(arrow.field(f.name).type) for f in rest]
        cols += [pa.chunked_array([pa.array(x[f.name], arrow.field(f.name).type) for x in new], arrow.field(f.name).type)
                 for f in extra.fields]
        return pa.Table.from_arrays(cols, schema=arrow)

    flags = own.groupBy("_g").applyInArrow(send, BLOBS).groupBy("_b").applyInArrow(answer, BLOBS)
    sent = own.groupBy("_g").cogroup(flags.groupBy("_g")).applyInArrow(lambda key, a, b: ship(key, a, b), BLOBS)
    bits = sent.groupBy("_b").applyInArrow(decide, BLOBS)
    return own.groupBy("_g").cogroup(bits.groupBy("_g")).applyInArrow(lambda key, a, b: close(a, b), schema)
