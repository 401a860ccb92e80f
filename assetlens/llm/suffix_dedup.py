"""Suffix-array dedup: bytes covered by a long string that also starts elsewhere are removed.

Shards hold every window that may repeat (see repeats.py). Each builds a suffix array of its
distinct chunks by Larsson-Sadakane refinement in numpy and reads common prefixes with Kasai's
rule. Windows of a hot minimum are spread over all shards as sorted digest runs and merged across
shards by binary search.

Results: null or empty text gives 0 bytes and no spans; a text shorter than `size` keeps all;
repeated rows are repeats of each other; any further columns of the input are kept, and columns
that bear the name of a result are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import BYTE_VALUES, spread_starts
from .repeats import Rules, remove_repeats


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions sorted by their first `depth` bytes, and each position's rank (equal if those agree).

    Larsson-Sadakane: sort by 8 bytes, then refine only groups that are still tied, by the rank
    of the position reached so far, doubling the sorted depth. A suffix ends with zero bytes.
    """
    n = len(text)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    padded = np.r_[text, np.zeros(8, np.uint8)]
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : i + n]
    sa = np.argsort(key)
    sorted_key = key[sa]
    head = np.r_[True, sorted_key[1:] != sorted_key[:-1]]
    base = np.flatnonzero(head)
    rank = np.empty(n, np.int64)
    rank[sa] = np.repeat(base, np.diff(np.r_[base, n]))
    have = 8
    size = np.diff(np.r_[base, n])
    active = sa[np.repeat(size > 1, size)]
    while have < depth and len(active):
        step = min(have, depth - have)
        nxt = active + step
        follow = np.where(nxt < n, rank[np.minimum(nxt, n - 1)] + 1, 0)
        group = rank[active]
        pair = (group.astype(np.uint64) << np.uint64(32)) | follow.astype(np.uint64)
        order = np.argsort(pair)
        active, pair, group = active[order], pair[order], group[order]
        opens = np.r_[True, group[1:] != group[:-1]]
        at = np.arange(len(active))
        first = np.maximum.accumulate(np.where(opens, at, 0))
        sa[group + at - first] = active
        sub = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        size = np.diff(np.r_[sub, len(active)])
        rank[active] = np.repeat((group + at - first)[sub], size)
        active = active[np.repeat(size > 1, size)]
        have += step
    return sa, rank


def common_prefixes(text: np.ndarray, sa: np.ndarray, rank: np.ndarray, depth: int, lane: int = 64) -> np.ndarray:
    """For each position, the prefix it shares with the suffix before it in sa, up to `depth`.

    Kasai: walking along the text, the shared length falls by one at most. The walk runs in
    lanes of `lane` positions at once. Ties up to `depth` are read from the ranks.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    out = np.zeros(n, np.int64)
    padded = np.r_[text, np.zeros(depth + 9, np.uint8)]
    word = np.zeros(n + depth + 2, np.uint64)
    for i in range(8):
        word = (word << np.uint64(8)) | padded[i : i + len(word)]
    lanes = np.arange(0, n, lane)
    carry = np.zeros(len(lanes), np.int64)
    for d in range(lane):
        at = lanes + d
        at = at[at < n]
        length = np.maximum(carry[: len(at)] - 1, 0)
        length[carry[: len(at)] >= depth] = 0
        prev = before[at]
        tied = (prev >= 0) & (rank[at] == rank[prev])
        length[tied] = depth
        length[prev < 0] = 0
        live = np.flatnonzero((prev >= 0) & ~tied)
        while len(live):
            a, b = word[at[live] + length[live]], word[prev[live] + length[live]]
            same = a == b
            diff = a ^ b
            for bits, take in ((32, 4), (16, 2), (8, 1)):
                clear = ~same & (diff >> np.uint64(64 - bits) == 0)
                length[live[clear]] += take
                diff = np.where(clear, diff << np.uint64(bits), diff)
            length[live[same]] += 8
            live = live[same & (length[live] < depth)]
        length = np.minimum(length, depth)
        out[at] = length
        carry[: len(at)] = length
    return out


def shared_windows(text: np.ndarray, sizes: np.ndarray, times: np.ndarray, window: int) -> np.ndarray:
    """Bit per window of the chunks: it stands at another place, or its chunk stands twice."""
    count = sizes - window + 1
    begin = np.cumsum(sizes) - sizes
    start = spread_starts(begin, count)
    sa, rank = suffix_array(text, window)
    lcp = common_prefixes(text, sa, rank, window)
    is_start = np.zeros(len(text), bool)
    is_start[start] = True
    # Ties with positions that are no window of their own chunk do not count.
    order = sa[is_start[sa]]
    tied = np.zeros(len(order), bool)
    if len(order) > 1:
        tied[1:] = rank[order[1:]] == rank[order[:-1]]
    bits = tied.copy()
    bits[:-1] |= tied[1:]
    out = np.zeros(len(text), bool)
    out[order] = bits & ((lcp[order] >= window) | (lcp[sa[np.minimum(rank[order] + 1, len(sa) - 1)]] >= window))
    return out[start] | np.repeat(times > 1, count)


def byte_units(buf: np.ndarray, off: np.ndarray):
    return BYTE_VALUES[buf], off, buf


def cut_bytes(buf, off, rows, covered) -> dict:
    """Spans and remaining bytes of each row of a batch."""
    edge = np.zeros(len(covered) + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(covered & (~np.r_[False, covered[:-1]] | edge[:-1]))
    ends = np.flatnonzero(covered & (~np.r_[covered[1:], False] | edge[1:])) + 1
    at = np.searchsorted(starts, off)
    kept = np.r_[0, np.cumsum(~covered)]
    left = buf[~covered].tobytes()
    return {"n_bytes": np.diff(off), "n_removed": np.diff(np.r_[0, np.cumsum(covered)][off]),
            "spans": [[{"start": int(s), "end": int(e)} for s, e in zip(starts[a:z] - o, ends[a:z] - o)]
                      for o, a, z in zip(off, at, at[1:])],
            "kept": [left[a:z] for a, z in zip(kept[off], kept[off][1:])]}


RESULT = T.StructType([
    T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                     T.StructField("end", T.LongType())]))),
    T.StructField("kept", T.BinaryType())])


def suffix_array_dedup(docs: DataFrame, size: int = 200, hot: int = 20_000, group_bytes: int = 4 << 20,
                       shard_bytes: int = 2 << 20) -> DataFrame:
    """Rows of docs (doc_id, text, ...) with n_bytes, n_removed, spans and the remaining bytes in `kept`."""
    gram, span = max(1, size // 4), max(1, size * 2 // 5)
    rules = Rules(size, gram, span, byte_units, np.uint8, shared_windows, hot)
    return remove_repeats(docs, rules, cut_bytes, RESULT, group_bytes, shard_bytes)
