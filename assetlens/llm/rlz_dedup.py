"""Substring dedup by relative Lempel-Ziv parsing: words covered by a window that also starts elsewhere go.

Every shard is a reference block with an index of its windows. The candidate runs of a document
(see repeats.py) meet every block that can hold them and are factored greedily: a factor is the
longest stretch that stands at another place of the block. Factors of `window` words or more
become spans, and parsing goes on with the windows that straddle the factor's end, so none is
missed at a boundary.

Results: null or empty text has no words; fewer words than `window` are all kept; repeated rows
are repeats of each other; any further columns of the input are kept, and columns that bear the
name of a result are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import mix, prefix_hash, span_hash, spread_starts, word_hashes, words
from .repeats import Rules, remove_repeats


def factor_windows(text: np.ndarray, sizes: np.ndarray, times: np.ndarray, window: int) -> np.ndarray:
    """Bit per window of the chunks of a block: it lies in a factor, or its chunk stands twice."""
    count = sizes - window + 1
    begin = np.cumsum(sizes) - sizes
    place = np.cumsum(count) - count
    start = spread_starts(begin, count)
    p = prefix_hash(mix(text.astype(np.uint64) + np.uint64(1)))
    key = span_hash(p, start, start + window)
    order = np.argsort(key, kind="stable")
    head = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]]) if len(key) else np.empty(0, np.int64)
    size = np.diff(np.r_[head, len(key)])
    own = np.empty(len(key), np.int64)
    own[order] = np.repeat(np.arange(len(head)), size)
    one, two = order[head], order[np.minimum(head + 1, max(len(order) - 1, 0))]
    chunk_end = begin + sizes
    of = np.repeat(np.arange(len(sizes)), count)
    bits = np.zeros(len(key) + 1, np.int32)
    live = np.flatnonzero(count > 0)
    cursor = np.zeros(len(sizes), np.int64)
    while len(live):
        at = place[live] + cursor[live]
        k = own[at]
        match = size[k] > 1
        step = np.ones(len(live), np.int64)
        a = at[match]
        src = np.where(one[k[match]] == a, two[k[match]], one[k[match]])
        low = np.full(len(a), window, np.int64)
        high = np.minimum(chunk_end[of[a]] - start[a], chunk_end[of[src]] - start[src])
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_] + 1) // 2
            x, y = start[a[open_]], start[src[open_]]
            same = span_hash(p, x, x + mid) == span_hash(p, y, y + mid)
            low[open_] = np.where(same, mid, low[open_])
            high[open_] = np.where(same, high[open_], mid - 1)
        np.add.at(bits, a, 1)
        np.add.at(bits, a + low - window + 1, -1)
        step[match] = low - window + 1
        cursor[live] += step
        live = live[cursor[live] < count[live]]
    return (np.cumsum(bits)[:-1] > 0) | np.repeat(times > 1, count)


def word_units(buf: np.ndarray, off: np.ndarray):
    starts, ends, rows = words(buf, off)
    h = word_hashes(buf, starts, ends)
    return h, rows, (h >> np.uint64(32)).astype(np.uint32)


def cut_words(buf, off, rows, covered) -> dict:
    """Word counts and the kept words, joined by one space, of each row of a batch."""
    starts, ends, _ = words(buf, off)
    keep = ~covered
    size = (ends - starts)[keep] + 1
    at = np.r_[0, np.cumsum(size)]
    out = buf[np.minimum(spread_starts(starts[keep], size), max(len(buf) - 1, 0))] if len(buf) else buf
    out = out.copy()
    out[at[1:] - 1] = 0x20
    text = out.tobytes()
    place = at[np.r_[0, np.cumsum(keep)][rows]]
    return {"n_words": np.diff(rows), "n_removed": np.diff(np.r_[0, np.cumsum(covered)][rows]),
            "kept": [text[a : max(a, z - 1)].decode("utf-8", "replace") for a, z in zip(place, place[1:])]}


RESULT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                       T.StructField("kept", T.StringType())])


def rlz_dedup(docs: DataFrame, window: int = 35, hot: int = 20_000, group_bytes: int = 4 << 20,
              shard_bytes: int = 2 << 20) -> DataFrame:
    """Rows of docs (doc_id, text, ...) with n_words, n_removed and the remaining words in `kept`."""
    gram = max(1, window // 6)
    rules = Rules(window, gram, max(1, window // 3), word_units, np.uint32, factor_windows, hot)
    return remove_repeats(docs, rules, cut_words, RESULT, group_bytes, shard_bytes)
