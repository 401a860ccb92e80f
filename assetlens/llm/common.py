"""Shared helpers of the training-data operators: byte views, rolling hashes, words, grouped exchange.

Python work always sees one bounded group of documents or one bounded bucket. Spark deals
documents to groups by a hash of doc_id, groups write packed blobs per bucket, buckets answer
with blobs per group, and a cogroup brings an answer back to its documents. The shuffle of the
documents is the same plan in each pass, so Spark reuses it and the text moves once.
"""

from __future__ import annotations

import ctypes
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}
BATCH_BYTES = 1 << 20
ASCII_SPACE = [0x20, *range(0x09, 0x0E)]


def _lut(excluded: list[int]) -> np.ndarray:
    out = np.ones(256, bool)
    out[excluded] = False
    return out


SPACED = _lut(ASCII_SPACE)
ALNUM = _lut([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
BYTE_VALUES = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _POWERS[name] = np.multiply.accumulate(out)
    return _POWERS["up"], _POWERS["down"]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """P with P[e] - P[s] scaled by the power of s the hash of values[s:e]."""
    up, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def span_hash(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed 64-bit hash of each span of the values behind p."""
    _, down = powers(len(p))
    return mix((p[end] - p[start]) * down[start] + (end - start).astype(np.uint64))


def window_hash(p: np.ndarray, size: int) -> np.ndarray:
    """Mixed hash of every window of `size` values; empty when there is none."""
    n = len(p) - size
    if n <= 0:
        return np.empty(0, np.uint64)
    _, down = powers(len(p))
    return mix((p[size:] - p[:n]) * down[:n] + np.uint64(size))


def flat_text(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def batches(column, limit: int = BATCH_BYTES):
    """(first row, bytes, offsets) of runs of rows of about `limit` bytes, or of one longer row."""
    buf, off = flat_text(column)
    at = 0
    while at < len(off) - 1:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield at, buf[off[at] : off[to]], off[at : to + 1] - off[at]
        at = to


def words(buf: np.ndarray, off: np.ndarray, inside: np.ndarray = SPACED):
    """Starts and ends of the words, and the offsets of each row in the list of words."""
    mask = np.zeros(len(buf) + 2, bool)
    mask[1:-1] = inside[buf]
    first = np.zeros(len(buf) + 1, bool)
    first[off] = True
    starts = np.flatnonzero(mask[1:] & (~mask[:-1] | first))
    ends = np.flatnonzero(mask[:-1] & (~mask[1:] | first))
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(prefix_hash(BYTE_VALUES[buf]), starts, ends)


def sliding(op, values: np.ndarray, size: int) -> np.ndarray:
    """op over every window of `size` values, by doubling."""
    out, have = values, 1
    while have < size:
        step = min(have, size - have)
        out = op(out[: len(out) - step], out[step:])
        have += step
    return out


def release() -> None:
    """Give freed memory back to the system: Python workers live on after a task, and so would what it freed."""
    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
        trim(0)


def bound_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python in batches of at most `rows` rows: whole texts are long, and a batch is held several times."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes in a text column, from one aggregate; sizes groups and buckets."""
    return int(docs.agg(F.sum(F.octet_length(column))).first()[0] or 0)


def group_count(total: int, each: int, least: int = 64) -> int:
    return max(least, math.ceil(total / each))


def dealt(docs: DataFrame, groups: int, *keys: str) -> DataFrame:
    """Documents with their group; the key is uniform whatever the text or source holds."""
    return docs.withColumn("_g", F.pmod(F.xxhash64(*keys), F.lit(groups)))


def cut(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts keys by (bucket, key), the buckets that occur, and their bounds in that order."""
    own = (mix(keys) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((keys, own))
    own = own[order]
    at = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.empty(0, np.int64)
    return order, own[at], np.r_[at, len(own)].astype(np.int64)


BLOBS = "_b long, _g long, _k int, blob binary"
BLOB_SCHEMA = pa.schema([("_b", pa.int64()), ("_g", pa.int64()), ("_k", pa.int32()), ("blob", pa.binary())])


def blob_table(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    """Packed rows, the answer of a group or bucket; what making them took is given back."""
    release()
    if not rows:
        return BLOB_SCHEMA.empty_table()
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), BLOB_SCHEMA)], schema=BLOB_SCHEMA)


def blob_rows(table: pa.Table):
    """(bucket, group, kind, bytes) in a fixed order, whatever order the shuffle gave."""
    rows = zip(*(table[c].to_pylist() for c in ("_b", "_g", "_k")), table["blob"])
    return [(b, g, k, memoryview(x.as_buffer())) for b, g, k, x in sorted(rows, key=lambda r: r[:3])]


def rows_of(rows) -> list[tuple[int, int, int, bytes]]:
    """blob_rows as rows for blob_table, to pass them on."""
    return [(b, g, k, x.tobytes()) for b, g, k, x in rows]


def pack(*parts: np.ndarray) -> bytes:
    """Arrays as one blob: their lengths, then their bytes."""
    head = np.array([len(parts), *(p.nbytes for p in parts)], np.int64)
    return b"".join([head.tobytes(), *(np.ascontiguousarray(p).tobytes() for p in parts)])


def unpack(blob, *kinds) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    sizes, at, out = np.frombuffer(blob, np.int64, n, 8), 8 * (n + 1), []
    for size, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(np.frombuffer(blob, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def concat(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, kind)


def spread_starts(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i]+1, ... counts[i] times, for each i in turn."""
    total = int(counts.sum())
    out = np.arange(total, dtype=np.int64)
    return out + np.repeat(starts - (np.cumsum(counts) - counts), counts)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that all executors share; a session without one gets a folder in its warehouse."""
    folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def cut_lineage(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_folder(spark)
    return df.checkpoint(eager=True)


def written_at(df: DataFrame, spark: SparkSession) -> tuple[DataFrame, str]:
    """df as a Parquet table in the shared folder, read again, and its path."""
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def saved(df: DataFrame, spark: SparkSession) -> DataFrame:
    """df as a Parquet table in the shared folder, read again with its own schema."""
    return written_at(df, spark)[0]


def written(df: DataFrame, spark: SparkSession) -> DataFrame:
    """df as a Parquet table in the shared folder, read again."""
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a written table that no later plan reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
