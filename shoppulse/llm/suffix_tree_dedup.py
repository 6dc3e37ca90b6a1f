"""Repeated passages removed by hashed 13-word windows, partitioned by prefix.

No suffix tree is built: one depth decides, so a "tree" here is a bucket of suffixes cut
at ``width`` words, sorted and grouped by one fingerprint each.

Every position of a text that has ``width`` words ahead is a suffix, cut at that depth.

1. A pass counts the suffixes by hashed prefixes of 1, 2, 4 and 8 words (histograms of a
   fixed size).  Short prefixes that few suffixes share are packed together into
   memory-sized trees; a prefix with too many suffixes is extended to the next
   length, and what is still too common is dealt out by its whole window.
2. Each task sorts its own suffixes first: a window that also starts in a smaller
   document of the same block is settled there, so of a passage that very many
   documents share only one suffix a block leaves the task.
3. Each tree is settled alone: suffixes sorted by fingerprint; a run holds those that a
   suffix tree has below one node of depth ``width``.  A suffix in a run that also holds
   a smaller doc_id starts a repeat; overlapping repeats join to maximal ones.
4. The repeats go back to the documents, packed by document bucket, and the covered
   words are cut out.

Two windows count as equal if their tree (a hash of the prefix) and their 64-bit
fingerprint (a hash of the whole window with other seeds) agree.

Null and empty texts have no words.  Texts shorter than ``width`` words lose nothing.
Rows without doc_id are left as they are.  Repeated rows (same doc_id, same text) are
cut alike.  Columns other than doc_id and text are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import (
    blocks,
    forget,
    mix,
    partitions,
    read,
    span_hashes,
    stored,
    text_buffer,
    window_hashes,
    word_spans,
)

WIDTH = 13
LEVELS = (1, 2, 4, 8)  # prefix lengths that are tried before the whole window
HISTOGRAM_BITS = 14
TREE_SUFFIXES = 4 << 20  # suffixes a tree may hold
BLOCK_WORDS = 1 << 19  # words of a block inside a task
BUCKET_BYTES = 8 << 20  # text bytes cut together at the end

N_WORDS, N_REMOVED = "__n_words", "__n_removed"

_SHIFT = np.uint64(64 - HISTOGRAM_BITS)


class Block:
    """Word hashes of some whole documents, and their suffixes."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, docs: np.ndarray, width: int):
        self.words, self.width = words, width
        first = np.cumsum(counts) - counts
        windows = np.maximum(counts - width + 1, 0)
        total = int(windows.sum())
        self.row = np.repeat(np.arange(len(counts)), windows)
        self.start = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows)
        self.at = np.repeat(first, windows) + self.start  # word index of each suffix
        self.doc = docs[self.row]

    def prefix(self, length: int, seed: int) -> np.ndarray:
        return window_hashes(self.words, length, seed)[self.at]


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[Block, int]]:
    """Blocks of about ``BLOCK_WORDS`` words with their text bytes; a document is never split."""
    held, size, read_bytes = [], 0, 0
    for batch in batches:
        raw, offsets = text_buffer(batch.column("text"))
        docs = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b in blocks(offsets):
            part, edges = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            starts, ends, first = word_spans(part, edges)
            held.append((span_hashes(part, starts, ends), np.diff(first), docs[a:b]))
            size += len(starts)
            read_bytes += len(part)
            if size >= BLOCK_WORDS:
                yield Block(*map(np.concatenate, zip(*held)), width), read_bytes
                held, size, read_bytes = [], 0, 0
    if held:
        yield Block(*map(np.concatenate, zip(*held)), width), read_bytes


def _histogram_map(width: int, levels: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        counts = np.zeros((len(levels), 1 << HISTOGRAM_BITS), dtype=np.int64)
        text_bytes = 0
        for block, size in _blocks(batches, width):
            text_bytes += size
            for k, length in enumerate(levels):
                bucket = (block.prefix(length, length) >> _SHIFT).astype(np.int64)
                counts[k] += np.bincount(bucket, minlength=counts.shape[1])
        flat = counts.ravel()
        some = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(some, -1), pa.int32()),
                pa.array(np.append(flat[some], text_bytes), pa.int64()),
            ],
            names=["at", "n"],
        )

    return run


class Forest:
    """Which tree a suffix belongs to, by the shortest prefix that is rare enough."""

    def __init__(self, counts: np.ndarray, levels: tuple[int, ...], budget: int):
        self.levels = levels
        self.trees: list[np.ndarray] = []  # per level: tree of each prefix bucket, -1: extend it
        total = int(counts[0].sum()) if len(counts) else 0
        rest, made = total, 0
        for level in counts:
            # only suffixes that no shorter prefix has placed come here
            share = level * (rest / total if total else 0.0)
            tree = np.full(len(level), -1, dtype=np.int32)
            fits = np.flatnonzero(share <= budget)
            load = np.cumsum(share[fits])
            tree[fits] = made + (load // budget).astype(np.int32)
            if len(fits):
                made = int(tree[fits].max()) + 1
            self.trees.append(tree)
            rest = int(share[share > budget].sum())
        self.first_last = made
        self.last = max(1, -(-rest // budget))  # dealt out by whole windows
        self.size = self.first_last + self.last

    def place(self, block: Block, fingerprint: np.ndarray) -> np.ndarray:
        out = np.full(len(fingerprint), -1, dtype=np.int32)
        for length, tree in zip(self.levels, self.trees):
            open_ = np.flatnonzero(out < 0)
            if len(open_) == 0:
                return out
            if (tree < 0).all():
                continue
            bucket = (block.prefix(length, length)[open_] >> _SHIFT).astype(np.int64)
            out[open_] = tree[bucket]
        open_ = np.flatnonzero(out < 0)
        key = mix(fingerprint[open_] + np.uint64(0x9E3779B97F4A7C15))
        out[open_] = self.first_last + (key % np.uint64(self.last)).astype(np.int32)
        return out


def later_copies(fingerprint: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """True for each leaf below a node at full depth that also holds a smaller document."""
    out = np.zeros(len(fingerprint), dtype=bool)
    if len(fingerprint) == 0:
        return out
    order = np.argsort(fingerprint)
    leaf = fingerprint[order]
    fresh = np.empty(len(leaf), dtype=bool)
    fresh[0] = True
    np.not_equal(leaf[1:], leaf[:-1], out=fresh[1:])
    node = np.flatnonzero(fresh)
    smallest = np.minimum.reduceat(doc[order], node)
    size = np.diff(np.append(node, len(leaf)))
    out[order] = doc[order] > np.repeat(smallest, size)
    return out


def _pack(doc: np.ndarray, start: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Documents, suffixes of each, and word positions; ``doc`` comes in runs."""
    if len(doc) == 0:
        return b"", b"", b""
    fresh = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    counts = np.diff(np.append(fresh, len(doc))).astype(np.int32)
    return doc[fresh].tobytes(), counts.tobytes(), start.astype(np.int32).tobytes()


def _unpack(rows) -> tuple[np.ndarray, np.ndarray]:
    docs, starts = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for d, c, s in rows:
        docs.append(np.repeat(np.frombuffer(d, np.int64), np.frombuffer(c, np.int32)))
        starts.append(np.frombuffer(s, np.int32))
    return np.concatenate(docs), np.concatenate(starts)


_LEAVES_ARROW = pa.schema(
    [
        ("tree", pa.int32()),
        ("leaves", pa.binary()),
        ("docs", pa.binary()),
        ("counts", pa.binary()),
        ("starts", pa.binary()),
    ]
)
LEAVES = "tree int, leaves binary, docs binary, counts binary, starts binary"


def _leaves_map(forest, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        plan: Forest = forest.value
        part = TaskContext.get().partitionId()
        for block, _ in _blocks(batches, width):
            if len(block.doc) == 0:
                continue
            leaf = block.prefix(width, 101)
            settled = later_copies(leaf, block.doc)
            done = np.flatnonzero(settled)
            # settled here: passed on under a key of its own, away from the trees
            rows = [(-1 - part, b"", *_pack(block.doc[done], block.start[done]))]
            rest = np.flatnonzero(~settled)
            tree = plan.place(block, leaf)[rest]
            order = np.argsort(tree, kind="stable")
            rest, tree = rest[order], tree[order]
            cuts = np.flatnonzero(np.append(True, tree[1:] != tree[:-1])) if len(tree) else []
            for a, b in zip(cuts, [*cuts[1:], len(tree)]):
                some = rest[a:b]
                rows.append((int(tree[a]), leaf[some].tobytes(), *_pack(block.doc[some], block.start[some])))
            for a in range(0, len(rows), 256):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows[a : a + 256]), _LEAVES_ARROW)],
                    schema=_LEAVES_ARROW,
                )

    return run


_REPEATS_ARROW = pa.schema(
    [("bucket", pa.int64()), ("docs", pa.binary()), ("counts", pa.binary()), ("starts", pa.binary())]
)
REPEATS = "bucket long, docs binary, counts binary, starts binary"


def _tree(buckets: int):
    """Builds one tree; its repeats go out packed by document bucket."""

    def run(table: pa.Table) -> pa.Table:
        column = lambda name: table.column(name).to_pylist()
        doc, start = _unpack(zip(column("docs"), column("counts"), column("starts")))
        if table.num_rows and table.column("tree")[0].as_py() >= 0:
            leaf = np.concatenate([np.frombuffer(x, np.uint64) for x in column("leaves")])
            repeat = later_copies(leaf, doc)
            doc, start = doc[repeat], start[repeat]
        bucket = np.mod(doc, buckets)
        order = np.lexsort((start, doc, bucket))
        doc, start, bucket = doc[order], start[order], bucket[order]
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(doc) else []
        rows = [
            (int(bucket[a]), *_pack(doc[a:b], start[a:b])) for a, b in zip(cuts, [*cuts[1:], len(doc)])
        ]
        columns = zip(*rows) if rows else [[]] * len(_REPEATS_ARROW)
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _REPEATS_ARROW)], schema=_REPEATS_ARROW
        )

    return run


def _next_prime(n: int) -> int:
    n = max(n, 2)
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def repeats(docs: DataFrame, width: int = WIDTH) -> tuple[DataFrame, int]:
    """(packed window starts to remove by document bucket, number of buckets)."""
    spark = docs.sparkSession
    rows = docs.filter("doc_id is not null and text is not null").select("doc_id", "text")
    levels = tuple(k for k in LEVELS if k < width)
    sums = (
        rows.mapInArrow(_histogram_map(width, levels), "at int, n long")
        .groupBy("at")
        .agg(F.sum("n").alias("n"))
        .collect()  # a fixed number of buckets
    )
    counts = np.zeros(len(levels) << HISTOGRAM_BITS, dtype=np.int64)
    text_bytes = 0
    for r in sums:
        if r["at"] < 0:
            text_bytes = r["n"]
        else:
            counts[r["at"]] = r["n"]
    counts = counts.reshape(len(levels), -1)
    total = int(counts[0].sum())
    wide = 2 * partitions(spark)
    forest = Forest(counts, levels, min(TREE_SUFFIXES, max(1 << 10, total // wide)))
    buckets = _next_prime(max(wide, text_bytes // BUCKET_BYTES))
    shared = spark.sparkContext.broadcast(forest)  # a fixed size: the prefix buckets' trees
    leaves = rows.mapInArrow(_leaves_map(shared, width), LEAVES)
    found = leaves.groupBy("tree").applyInArrow(_tree(buckets), REPEATS)
    return stored(spark, found, "repeats"), buckets


def _cut_text(raw: bytes, gone: np.ndarray, joined: bool) -> bytes:
    """The text without the words marked in ``gone``."""
    if joined:
        words = raw.split()
        return b" ".join([words[i] for i in np.flatnonzero(~gone)])
    data = np.frombuffer(raw, np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(raw)]))
    after = np.append(starts[1:], len(raw))
    edge = np.zeros(len(raw) + 1, dtype=np.int64)
    np.add.at(edge, starts[gone], 1)  # from a removed word to the next word's start
    np.add.at(edge, after[gone], -1)
    return data[np.cumsum(edge)[:-1] == 0].tobytes()


def _cut_bucket(width: int, joined: bool):
    """Texts of a bucket and its repeats; both are bounded by the bucket's size."""

    def run(texts: pa.Table, packed: pa.Table) -> pa.Table:
        column = lambda name: packed.column(name).to_pylist()
        doc, start = _unpack(zip(column("docs"), column("counts"), column("starts")))
        order = np.argsort(doc, kind="stable")
        doc, start = doc[order], start[order]
        kept, n_words, n_removed = [], [], []
        for key, text in zip(texts.column("doc_id").to_pylist(), texts.column("text").to_pylist()):
            raw = (text or "").encode()
            a, b = (0, 0) if key is None else np.searchsorted(doc, [key, key + 1])
            words = len(raw.split())
            edge = np.zeros(words + width + 1, dtype=np.int32)
            np.add.at(edge, start[a:b], 1)
            np.add.at(edge, start[a:b] + width, -1)
            gone = np.cumsum(edge)[:words] > 0
            removed = int(gone.sum())
            if removed or joined:
                kept.append(_cut_text(raw, gone, joined).decode())
            else:
                kept.append(text)
            n_words.append(words)
            n_removed.append(removed)
        made = [pa.array(kept, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
        return pa.Table.from_arrays([texts.column("row"), *made], names=["row", "text", N_WORDS, N_REMOVED])

    return run


def cut_rows(docs: DataFrame, width: int = WIDTH, joined: bool = False) -> DataFrame:
    """row (all columns of ``docs``), text as cut, its words (``N_WORDS``), removed ones (``N_REMOVED``).

    ``joined``: the kept words joined by one blank (empty for null texts); otherwise
    the text keeps its own white space and untouched texts stay as they are.  The text
    inside ``row`` is null.
    """
    packed, buckets = repeats(docs, width)
    own = [F.lit(None).cast("string").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    # rows that no repeat can touch, and copies of one row, are dealt by their hash
    spread = F.pmod(F.xxhash64("text"), F.lit(buckets))
    bucket = F.coalesce(F.pmod("doc_id", F.lit(buckets)), spread).cast("long").alias("bucket")
    keyed = docs.select(F.struct(*own).alias("row"), F.col("doc_id").cast("long"), "text", bucket)
    schema = T.StructType([keyed.schema["row"], T.StructField("text", T.StringType())])
    schema = schema.add(N_WORDS, T.LongType()).add(N_REMOVED, T.LongType())
    return (
        keyed.groupBy("bucket")
        .cogroup(packed.groupBy("bucket"))
        .applyInArrow(_cut_bucket(width, joined), schema)
    )


def remove_repeats(docs: DataFrame, width: int = WIDTH, joined: bool = False) -> DataFrame:
    """``docs`` with each text cut, and its words (``N_WORDS``) and removed words (``N_REMOVED``).

    Columns of ``docs`` with these two names give way; ``cut_rows`` keeps them.
    """
    kept = [
        F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c)
        for c in docs.columns
        if c not in (N_WORDS, N_REMOVED)
    ]
    return cut_rows(docs, width, joined).select(*kept, N_WORDS, N_REMOVED)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: words of repeated 13-word windows removed, smallest doc_id kept."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    cut = remove_repeats(docs, WIDTH, joined=True)
    return cut.select(
        "doc_id",
        F.col(N_WORDS).alias("n_words"),
        F.col(N_REMOVED).alias("n_removed"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + {WIDTH - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WIDTH - 2})) AS i FROM d WHERE len(w) >= {WIDTH}) x
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first_doc FROM win) x
  WHERE doc_id > first_doc
), gone AS (
  SELECT DISTINCT doc_id, i + k AS p
  FROM (SELECT doc_id, i, unnest(range(0, {WIDTH})) AS k FROM later) y
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
  SELECT s.doc_id, string_agg(s.word, ' ' ORDER BY s.p) AS body, count(*) AS n
  FROM words s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.p = g.p
  WHERE g.p IS NULL GROUP BY s.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
