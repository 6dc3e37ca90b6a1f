"""Token ids in binary files: every id in the fewest bits the vocabulary needs.

A file holds whole documents in ascending doc_id order::

    header         48 bytes: magic, bits an id, ids a block, bucket, number in bucket,
                   documents, ids, blocks
    doc_id         8 bytes a document
    named          1 byte a document (0: the document had no doc_id)
    first          8 bytes a document + 1: its first id, counted from the file's start
    block offset   8 bytes a block + 1: where a block begins, counted from the body's start
    body           blocks of ``BLOCK`` ids; in a block, id i takes bits [i * width, (i + 1) * width)
                   of one run of little-endian 64-bit words

A range of ids is read by its blocks alone; 64 ids fill exactly ``width`` words, so packing
and unpacking are a few strided shifts in numpy.  The text sink that writes a file
ends it with one line feed, which is not part of the format.

1. One pass over doc_id and text sizes gives quantiles of doc_id: the edges of ``buckets``,
   at most ``MOST_BUCKETS``.  A doc_id that fills several buckets by itself is dealt over
   them by a hash of its ids.
2. A second pass tokenises where the texts lie and shuffles only packed ids.
3. Each bucket is sorted and cut into files of about ``IDS_PER_FILE`` ids; a document is never
   split over files.
4. Files are read back as they are; where a file begins in the whole stream follows from
   the id counts of the files before it.

Null and empty texts hold the end id alone.  Rows without doc_id come first.  Rows of one
doc_id are ordered by a hash of their ids; repeated rows are written each (equal rows of
a batch travel as one row with a count).  Very long texts are a file of their own.  An
empty table writes no file and gives no row.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import remove
from .best_fit_packing import JsonCodec
from .common import ARROW_ROWS, partitions, read, shared_path, shuffle_cleanup, stored

END_ID = 2
BLOCK = 1 << 14  # ids a block
IDS_PER_FILE = 1 << 23
BUCKET_BYTES = 128 << 20  # text bytes a bucket
MOST_BUCKETS = 4096
SLICE = 1000  # texts tokenised at once

MAGIC = b"IDBITS01"
HEADER = struct.Struct("<8sIIIIQQQ")


# ---- packing ------------------------------------------------------------------------


def bits_needed(vocabulary: int) -> int:
    """Bits of the largest id of a vocabulary of this size."""
    return max(1, (vocabulary - 1).bit_length())


def _period(width: int) -> tuple[int, int]:
    """Ids and words after which the bit positions repeat."""
    both = math.gcd(width, 64)
    return 64 // both, width // both


def pack_ids(ids: np.ndarray, width: int) -> np.ndarray:
    """64-bit words holding ``ids`` (a multiple of 64 of them), ``width`` bits each."""
    per, wide = _period(width)
    lanes = ids.reshape(-1, per)
    words = np.zeros((len(lanes), wide), dtype=np.uint64)
    for k in range(per):
        word, shift = divmod(k * width, 64)
        lane = lanes[:, k].astype(np.uint64)
        words[:, word] |= lane << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= lane >> np.uint64(64 - shift)
    return words.ravel()


def unpack_ids(words: np.ndarray, width: int) -> np.ndarray:
    """The ids behind whole groups of ``width`` words (64 ids a group)."""
    per, wide = _period(width)
    words = words.reshape(-1, wide)
    lanes = np.empty((len(words), per), dtype=np.uint32)
    mask = np.uint64((1 << width) - 1)
    for k in range(per):
        word, shift = divmod(k * width, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value |= words[:, word + 1] << np.uint64(64 - shift)
        lanes[:, k] = value & mask
    return lanes.ravel()


def padded(n):
    """Ids rounded up to whole groups of 64."""
    return (n + 63) // 64 * 64


class FileWriter:
    """One file in the making; full blocks are packed at once."""

    def __init__(self, width: int, bucket: int = 0, number: int = 0):
        self.width, self.bucket, self.number = width, bucket, number
        self.docs: list[int | None] = []
        self.sizes: list[int] = []
        self.size = 0
        self._open: list[np.ndarray] = []  # ids of the blocks not packed yet
        self._waiting = 0
        self._body: list[bytes] = []
        self._offsets = [0]

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc)
        self.sizes.append(len(ids))
        self.size += len(ids)
        self._open.append(ids)
        self._waiting += len(ids)
        if self._waiting >= 16 * BLOCK:
            self._pack(self._waiting // BLOCK)

    def _pack(self, blocks: int) -> None:
        ids = np.concatenate(self._open)
        whole, rest = ids[: blocks * BLOCK], ids[blocks * BLOCK :]
        data = np.zeros(padded(len(whole)), dtype=np.uint32)
        data[: len(whole)] = whole
        packed = pack_ids(data, self.width).astype("<u8").tobytes()
        self._body.append(packed)
        step = BLOCK * self.width // 8
        first = self._offsets[-1]
        self._offsets += [min(first + k * step, first + len(packed)) for k in range(1, blocks + 1)]
        self._open, self._waiting = [rest], len(rest)

    def closed(self) -> bytes:
        """The file's bytes."""
        if self._waiting:
            self._pack(-(-self._waiting // BLOCK))
        first = np.append(0, np.cumsum(self.sizes)).astype("<i8")
        blocks = len(self._offsets) - 1
        return b"".join(
            [
                HEADER.pack(MAGIC, self.width, BLOCK, self.bucket, self.number, len(self.docs), self.size, blocks),
                np.array([0 if d is None else d for d in self.docs], dtype="<i8").tobytes(),
                np.array([d is not None for d in self.docs], dtype=np.uint8).tobytes(),
                first.tobytes(),
                np.array(self._offsets, dtype="<u8").tobytes(),
                *self._body,
            ]
        )


class TokenFile:
    """Random access to one file's documents and ids."""

    def __init__(self, data: bytes):
        magic, self.width, self.block, self.bucket, self.number, self.n_docs, self.n_ids, blocks = (
            HEADER.unpack_from(data)
        )
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.doc_id = take("<i8", self.n_docs)
        self.named = take("u1", self.n_docs).astype(bool)
        self.first = take("<i8", self.n_docs + 1)
        self.offsets = take("<u8", blocks + 1)
        self.body = memoryview(data)[at : at + int(self.offsets[-1])]
        if len(self.body) != int(self.offsets[-1]):
            raise ValueError("token file is cut short")

    def ids(self, a: int, b: int) -> np.ndarray:
        """Ids [a, b) of the file, from the blocks that hold them."""
        a, b = max(0, a), min(b, self.n_ids)
        if a >= b:
            return np.zeros(0, np.uint32)
        low, high = a // self.block, -(-b // self.block)
        words = np.frombuffer(self.body[int(self.offsets[low]) : int(self.offsets[high])], "<u8")
        return unpack_ids(words, self.width)[a - low * self.block : b - low * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.first[k]), int(self.first[k + 1]))


# ---- writing ------------------------------------------------------------------------

PACKED = "bucket int, doc_id long, tie long, n long, copies long, words binary"
_PACKED_ARROW = pa.schema(
    [
        ("bucket", pa.int32()),
        ("doc_id", pa.int64()),
        ("tie", pa.int64()),
        ("n", pa.int64()),
        ("copies", pa.int64()),
        ("words", pa.binary()),
    ]
)
_NO_ID = np.iinfo(np.int64).min  # where rows without doc_id stand among the keys


def _bucket(edges: np.ndarray, doc: int | None, tie: int) -> int:
    """Ascending in (doc_id, tie): a doc_id that is several edges is dealt over their buckets."""
    key = _NO_ID if doc is None else doc
    low, high = (int(np.searchsorted(edges, key, side)) for side in ("left", "right"))
    return low + (tie * (high - low + 1) >> 63)


def _tokenise(path: str, end_id: int, edges: np.ndarray, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = JsonCodec.of(path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found = codec.encode([t or "" for t in part.column("text").to_pylist()])
                n = np.array([len(ids) + 1 for ids in found], dtype=np.int64)
                room = padded(n)
                start = np.cumsum(room) - room
                flat = np.zeros(int(room.sum()), dtype=np.uint32)
                for ids, a, size in zip(found, start, n):
                    flat[a : a + size - 1] = ids
                    flat[a + size - 1] = end_id
                words = memoryview(pack_ids(flat, width).astype("<u8").tobytes())
                rows: dict[tuple, int] = {}
                for doc, a, size, whole in zip(part.column("doc_id").to_pylist(), start, n, room):
                    own = bytes(words[int(a) * width // 8 : int(a + whole) * width // 8])
                    key = (doc, int(size), own)
                    rows[key] = rows.get(key, 0) + 1
                out = []
                for (doc, size, own), copies in rows.items():
                    tie = int.from_bytes(hashlib.blake2b(own, digest_size=8).digest(), "little") >> 1
                    out.append((_bucket(edges, doc, tie), doc, tie, size, copies, own))
                columns = zip(*out) if out else [[]] * len(_PACKED_ARROW)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _PACKED_ARROW)], schema=_PACKED_ARROW
                )

    return run


def _unpacked(batch: pa.RecordBatch, width: int) -> list[np.ndarray]:
    """Ids of each row of packed rows, unpacked together."""
    data = batch.column("words").cast(pa.large_binary())
    _, offsets, raw = data.buffers()
    edge = np.frombuffer(offsets, np.int64)[data.offset : data.offset + len(data) + 1]
    ids = unpack_ids(np.frombuffer(raw, "<u8", int(edge[-1] - edge[0]) // 8, int(edge[0])), width)
    first = (edge[:-1] - edge[0]) * 8 // width
    n = batch.column("n").to_numpy()
    return [ids[a : a + size] for a, size in zip(first, n)]


def _files(width: int, ids_per_file: int):
    def row(file: FileWriter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([file.closed()], pa.binary())], names=["data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = None
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                column = lambda name: part.column(name).to_pylist()
                for bucket, doc, copies, ids in zip(
                    column("bucket"), column("doc_id"), column("copies"), _unpacked(part, width)
                ):
                    ids = ids.copy()
                    for _ in range(copies):
                        if file is not None and (
                            file.bucket != bucket or file.size + len(ids) > ids_per_file
                        ):
                            yield row(file)
                            number = file.number + 1 if file.bucket == bucket else 0
                            file = FileWriter(width, bucket, number)
                        elif file is None:
                            file = FileWriter(width, bucket)
                        file.add(doc, ids)
        if file is not None:
            yield row(file)

    return run


def bucket_edges(docs: DataFrame, least: int) -> np.ndarray:
    """Quantiles of doc_id that cut the table into buckets of about ``BUCKET_BYTES`` of text."""
    key = F.coalesce(F.col("doc_id"), F.lit(int(_NO_ID)))
    size = docs.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    buckets = min(MOST_BUCKETS, max(least, size // BUCKET_BYTES + 1))
    if buckets < 2:
        return np.zeros(0, np.int64)
    cuts = [k / buckets for k in range(1, buckets)]
    found = docs.agg(F.percentile_approx(key, cuts, max(10_000, 20 * buckets)).alias("cuts")).first()["cuts"]
    return np.array(found or [], dtype=np.int64)


def write_tokens(
    docs: DataFrame, tokenizer_path: str, path: str, end_id: int = END_ID, ids_per_file: int = IDS_PER_FILE
) -> None:
    """Write the ids of ``docs`` (doc_id, text), each text closed by ``end_id``, to files under ``path``."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text")
    width = bits_needed(JsonCodec.of(tokenizer_path).tokenizer.get_vocab_size())
    edges = bucket_edges(rows, partitions(spark))
    packed = rows.mapInArrow(_tokenise(tokenizer_path, end_id, edges, width), PACKED)
    dealt = packed.repartitionById(len(edges) + 1, F.col("bucket")).sortWithinPartitions("bucket", "doc_id", "tie")
    files = dealt.mapInArrow(_files(width, ids_per_file), "data binary")
    with shuffle_cleanup(spark):
        # the text sink writes a string's bytes as they are; one row is one file
        files.select(F.col("data").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


# ---- reading ------------------------------------------------------------------------

FOUND = "bucket int, number int, place long, doc_id long, first long, n_tokens long, ids_crc32 long"
_FOUND_ARROW = pa.schema(
    [
        ("bucket", pa.int32()),
        ("number", pa.int32()),
        ("place", pa.int64()),
        ("doc_id", pa.int64()),
        ("first", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for value in batch.column("content"):
            if not value.as_py():
                continue  # an empty table leaves an empty part
            file = TokenFile(value.as_buffer())
            ids = file.ids(0, file.n_ids).astype("<u4", copy=False)
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(file.first, file.first[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(file.n_docs, file.bucket, np.int32)),
                    pa.array(np.full(file.n_docs, file.number, np.int32)),
                    pa.array(np.arange(file.n_docs)),
                    pa.array(file.doc_id, pa.int64(), mask=~file.named),
                    pa.array(file.first[:-1], pa.int64()),
                    pa.array(np.diff(file.first), pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                schema=_FOUND_ARROW,
            )


@contextmanager
def _single_rows(spark: SparkSession):
    """One row an Arrow batch: a row is a whole file."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, "1")
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def file_contents(spark: SparkSession, path: str) -> DataFrame:
    """The files under ``path``, a row each (``content``)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document on file."""
    with _single_rows(spark):
        found = stored(spark, file_contents(spark, path).mapInArrow(_documents, FOUND), "token-documents")
    files = found.groupBy("bucket", "number").agg(F.sum("n_tokens").alias("ids"))
    before = Window.partitionBy("bucket").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    # at most MOST_BUCKETS rows meet here
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = files.groupBy("bucket").agg(F.sum("ids").alias("ids"))
    buckets = buckets.select("bucket", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))
    starts = files.withColumn("inside", F.coalesce(F.sum("ids").over(before), F.lit(0))).join(buckets, "bucket")
    starts = starts.select("bucket", "number", (F.col("base") + F.col("inside")).alias("begin"))
    return found.join(starts, ["bucket", "number"]).select(
        "doc_id", (F.col("begin") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: ids of every document written to bit-packed files and read back."""
    import public_tokenizers as tokens

    path = shared_path(spark, "token-files")
    write_tokens(read(spark, sf_dir, "documents"), tokens.path("byte_bpe_50k.json"), path)
    found = read_documents(spark, path)
    remove(spark, path)  # what was read back is a table of its own
    return found
