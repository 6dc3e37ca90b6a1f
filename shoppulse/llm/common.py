"""Shared helpers of the text operators: tables in the shared folder, word spans, hashes.

Words everywhere are ``[^\\x20\\x09-\\x0D]+``; all separators are single ASCII
bytes, so words are cut on the raw UTF-8 buffer of an Arrow batch without
decoding it.  Python's ``bytes.split()`` uses exactly the same separators.
"""

from __future__ import annotations

import gc
import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, ensure_checkpoint_dir
from ..storage import remove

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2000
BLOCK_BYTES = 1 << 20  # text bytes worked on at once inside a task
_LUT = np.zeros(256, dtype=bool)
_LUT[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
WORD_REGEX = r"[^\x20\x09-\x0D]+"

_M1 = np.uint64(0xFF51AFD7ED558CCD)
_M2 = np.uint64(0xC4CEB9FE1A85EC53)
_P = np.uint64(0x9E3779B97F4A7C15)
_S33 = np.uint64(33)


def table(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def bounded_batches(spark: SparkSession) -> None:
    """Texts go to Python ``BATCH_ROWS`` rows at a time or fewer; JVM and worker hold a batch each."""
    if int(spark.conf.get(ARROW_ROWS)) > BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(table(sf_dir, name))


def learnable(doc_id: Column | str, folds: int, held: int) -> Column:
    """True for the rows a model may learn labels from: crc32(doc_id as text) mod folds != held."""
    return held_out(doc_id, folds, held) == F.lit(False)


def held_out(doc_id: Column | str, folds: int, held: int) -> Column:
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(col.cast("string").cast("binary")) % folds == held


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder all executors share."""
    ensure_checkpoint_dir(spark)
    bounded_batches(spark)
    return f"{checkpoint_root(spark)}/llm/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffle_cleanup(spark: SparkSession):
    """Drop the shuffle files of each finished write: the rows are safe in the shared folder."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (cuts lineage, survives executors)."""
    path = shared_path(spark, label)
    with shuffle_cleanup(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove stored tables that nothing reads any more."""
    for df in tables:
        remove(df.sparkSession, df.stored_at)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---- memory of the Python workers ---------------------------------------------

_KEPT: list[dict] = []


def kept(cache: dict) -> dict:
    """``cache``, which a worker keeps from task to task until an operator forgets it."""
    _KEPT.append(cache)
    return cache


def forget() -> None:
    """Drop what earlier operators keep in this worker, for one that needs the room itself."""
    if any(_KEPT):
        for cache in _KEPT:
            cache.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()


# ---- text buffers -----------------------------------------------------------


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty; offsets start at 0."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]]
    return raw, off - off[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Cut rows into runs [a, b) of about ``limit`` bytes, at least one row each."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b
        a = b


def word_spans(raw: np.ndarray, offsets: np.ndarray):
    """Starts and ends of all words, and the first word of each row (length rows + 1)."""
    if len(raw) == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    sep = _LUT[raw]
    word = ~sep
    before = np.empty_like(sep)
    before[0] = True
    before[1:] = sep[:-1]
    first = offsets[:-1]
    before[first[first < len(raw)]] = True
    after = np.empty_like(sep)
    after[-1] = True
    after[:-1] = sep[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = True
    starts = np.flatnonzero(word & before)
    ends = np.flatnonzero(word & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _S33)
    x = x * _M1
    x ^= x >> _S33
    x *= _M2
    x ^= x >> _S33
    return x


LONG_SPAN = 256  # bytes beyond which a span is hashed on its own
_FULL = np.uint64((1 << 64) - 1)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes (equal bytes, equal hash), mixed after every 8 bytes."""
    size = ends - starts
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    room = np.concatenate([raw, np.zeros(8, np.uint8)])
    words = np.ndarray((len(raw) + 1,), "<u8", buffer=room, strides=(1,))  # 8 bytes from every place
    out = mix(size.astype(np.uint64) * _P + _M2)
    at = 0
    who = np.flatnonzero((size > 0) & (size <= LONG_SPAN))
    while len(who):
        rest = size[who] - at
        value = words[starts[who] + at]
        short = np.flatnonzero(rest < 8)
        value[short] &= _FULL >> (np.uint64(8) * (8 - rest[short]).astype(np.uint64))
        out[who] = mix(out[who] ^ value) * _P
        at += 8
        who = who[rest > 8]
    for k in np.flatnonzero(size > LONG_SPAN):
        digest = hashlib.blake2b(raw[starts[k] : ends[k]].tobytes(), digest_size=8).digest()
        out[k] = np.frombuffer(digest, "<u8")[0]
    return out


def window_hashes(words: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """Hash of each run of ``width`` consecutive entries (callers drop runs that cross rows)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = np.uint64((0xD6E8FEB86659FD93 * (2 * seed + 1)) & ((1 << 64) - 1) | 1)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        out *= base
        out += words[j : j + n]
    return mix(out + np.uint64(seed))
