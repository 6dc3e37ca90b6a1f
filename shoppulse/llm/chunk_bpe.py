"""Byte-level BPE encoding and decoding by overlapping chunks.

A text of at most ``chunk_chars`` characters is encoded where it is read.  A longer
one is cut into chunks that overlap their neighbours by ``overlap`` characters.
The chunks are spread over the cluster and pre-tokenised in parallel; between two
neighbours the first pre-token boundary that both of them found in their common
zone is where they resynchronise, and the text is cut there into pieces that are
encoded independently.  Neighbours without a common boundary become one piece, so
the result never depends on the chunk size.  Decoding concatenates raw bytes.

Null and empty texts give no ids and no bytes.  Repeated rows are encoded each: every
long row has a key of its own, also without doc_id or beside another text of its doc_id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe

CHUNK_CHARS = 1 << 16
OVERLAP = 1 << 10
IDS_SCHEMA = "key string, doc_id long, piece int, ids binary, decoded binary"


class Codec:
    """One tokenizer of a worker: encoder with its cache of pre-tokens, and byte table."""

    _made: dict[tuple[str, str], Codec] = {}

    def __init__(self, rank_path: str, pattern: str):
        import tiktoken

        ranks = bpe.rank_table(rank_path)
        self.library = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.cache = bpe.PieceCache(lambda ps: [self.library.encode_ordinary(p) for p in ps])
        self.cuts = regex.compile(pattern)
        by_id = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            by_id[rank] = token
        self.sizes = np.fromiter(map(len, by_id), dtype=np.int64, count=len(by_id))
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(by_id), dtype=np.uint8)

    @classmethod
    def of(cls, rank_path: str, pattern: str) -> Codec:
        key = (rank_path, pattern)
        if key not in cls._made:
            cls._made[key] = cls(rank_path, pattern)
        return cls._made[key]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return bpe.encode_texts(texts, self.cache, self.library.encode_ordinary)

    def decode(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.firsts[ids] - (ends - sizes), sizes)
        return self.bytes[shift + np.arange(len(shift))].tobytes()

    def starts(self, text: str) -> np.ndarray:
        """Positions where a pre-token starts."""
        cps = bpe.code_points(text)
        if bpe.is_plain(cps):
            return bpe.boundaries(cps)
        return np.fromiter((m.start() for m in self.cuts.finditer(text)), dtype=np.int64)


def _encode_map(rank_path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(rank_path, pattern)
        for batch in batches:
            for part in _slices(batch):
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids = codec.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"),
                        part.column("doc_id"),
                        part.column("piece"),
                        pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                        pa.array([codec.decode(x) for x in ids], pa.binary()),
                    ],
                    names=["key", "doc_id", "piece", "ids", "decoded"],
                )

    return run


def _slices(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _cut_chunks(chunk_chars: int, overlap: int):
    """Chunks of every row under a key of its own.

    The key counts the rows of one doc_id and text within a task.  Such rows are alike, so a
    task that runs again gives the same keys, in whatever order its rows come.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen: dict[tuple[int | None, bytes], int] = {}
        for batch in batches:
            for doc, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text"))):
                sha = hashlib.sha256(text.encode())
                alike = (doc, sha.digest())
                seen[alike] = seen.get(alike, 0) + 1
                key = f"{doc}:{sha.hexdigest()}:{task}:{seen[alike]}"
                last = (len(text) - 1) // chunk_chars
                for k in range(last + 1):
                    a = max(0, k * chunk_chars - overlap)
                    yield pa.RecordBatch.from_pylist(
                        [
                            {
                                "key": key,
                                "doc_id": doc,
                                "chunk": k,
                                "at": a,
                                "last": k == last,
                                "body": text[a : (k + 1) * chunk_chars + overlap],
                            }
                        ],
                        schema=_CHUNK_ARROW,
                    )

    return run


_CHUNK_ARROW = pa.schema(
    [
        ("key", pa.string()),
        ("doc_id", pa.int64()),
        ("chunk", pa.int32()),
        ("at", pa.int64()),
        ("last", pa.bool_()),
        ("body", pa.string()),
    ]
)
CHUNK_SCHEMA = "key string, doc_id long, chunk int, at long, last boolean, body string"


def _pretokenise(rank_path: str, pattern: str, chunk_chars: int, overlap: int):
    """Adds the pre-token boundaries of each chunk's two common zones (text positions).

    Only boundaries behind a character that is no white space are offered: there the
    text can be cut without changing what the pattern's look-ahead sees.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(rank_path, pattern)
        for batch in batches:
            left, right = [], []
            for chunk, at, body in zip(*(batch.column(c).to_pylist() for c in ("chunk", "at", "body"))):
                found = codec.starts(body)
                found = found[found > 0]
                found = np.array([p for p in found if not body[p - 1].isspace()], dtype=np.int64)
                # the last pre-tokens may be cut short by the chunk's end
                found = found[:-2] + at if len(found) > 2 else found[:0]
                here = chunk * chunk_chars
                left.append(found[(found >= here - overlap) & (found <= here + overlap)])
                here += chunk_chars
                right.append(found[(found >= here - overlap) & (found <= here + overlap)])
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(left, kind), pa.array(right, kind)],
                names=[*batch.schema.names, "left_zone", "right_zone"],
            )

    return run


def stitched_pieces(
    long_docs: DataFrame, rank_path: str, pattern: str, chunk_chars: int, overlap: int
) -> DataFrame:
    """(key, doc_id, piece, text), a key a row: the long texts cut where neighbouring chunks resynchronise."""
    spark = long_docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = (
        long_docs.select("doc_id", "text")
        .mapInArrow(_cut_chunks(chunk_chars, overlap), CHUNK_SCHEMA)
        .repartition(n, "key", "chunk")
        .mapInArrow(
            _pretokenise(rank_path, pattern, chunk_chars, overlap),
            CHUNK_SCHEMA + ", left_zone array<long>, right_zone array<long>",
        )
    )
    in_text = Window.partitionBy("key").orderBy("chunk")
    common = F.array_min(F.array_intersect("left_zone", F.lag("right_zone").over(in_text)))
    core = F.col("chunk").cast("long") * chunk_chars
    cut = (
        chunks.withColumn("begin", F.when(F.col("chunk") == 0, F.lit(0)).otherwise(common))
        .withColumn("next_begin", F.lead("begin").over(in_text))
        .withColumn("piece", (F.count("begin").over(in_text) - 1).cast("int"))
        # without a common boundary the neighbours meet at the chunk edge, in one piece
        .withColumn("from", F.coalesce("begin", core) - F.col("at"))
        .withColumn(
            "to",
            F.when(F.col("last"), F.col("at") + F.length("body"))
            .otherwise(F.coalesce("next_begin", core + chunk_chars))
            - F.col("at"),
        )
        .withColumn("body", F.expr("substring(body, int(`from`) + 1, int(`to` - `from`))"))
    )
    whole = F.array_sort(F.collect_list(F.struct("chunk", "body")))
    return (
        cut.groupBy("key", "doc_id", "piece")
        .agg(whole.alias("parts"))
        .select("key", "doc_id", "piece", F.array_join("parts.body", "").alias("text"))
    )


def encode(
    docs: DataFrame,
    rank_path: str,
    pattern: str,
    chunk_chars: int = CHUNK_CHARS,
    overlap: int = OVERLAP,
) -> tuple[DataFrame, DataFrame]:
    """(whole, pieces): ids (little-endian uint32) and decoded bytes of ``docs`` (doc_id, text).

    ``whole`` has a row for each text of at most ``chunk_chars`` characters (its key is null),
    ``pieces`` the pieces of the longer ones, numbered under each row's key.
    """
    rows = docs.select("doc_id", "text")
    size = F.coalesce(F.length("text"), F.lit(0))
    work = _encode_map(rank_path, pattern)
    whole = (
        rows.filter(size <= chunk_chars)
        .select(F.lit(None).cast("string").alias("key"), "doc_id", F.lit(0).alias("piece"), "text")
        .mapInArrow(work, IDS_SCHEMA)
    )
    long_docs = rows.filter(size > chunk_chars)
    cut = stitched_pieces(long_docs, rank_path, pattern, chunk_chars, overlap)
    pieces = cut.select("key", "doc_id", "piece", "text").mapInArrow(work, IDS_SCHEMA)
    return whole, pieces


def _digest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running digests over the ordered pieces of each key (one open at a time)."""
    open_key, open_doc, state = None, None, None

    def close():
        count, a, b = state
        return pa.RecordBatch.from_pylist(
            [
                {
                    "doc_id": open_doc,
                    "n_tokens": count,
                    "ids_sha256": a.hexdigest(),
                    "decoded_sha256": b.hexdigest(),
                }
            ],
            schema=_DIGEST_ARROW,
        )

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("key", "doc_id", "ids", "decoded"))
        for key, doc, ids, text in zip(*columns):
            if key != open_key:
                if open_key is not None:
                    yield close()
                open_key, open_doc, state = key, doc, [0, hashlib.sha256(), hashlib.sha256()]
            state[0] += len(ids) // 4
            state[1].update(ids)
            state[2].update(text)
    if open_key is not None:
        yield close()


_DIGEST_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
    ]
)
DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(whole: DataFrame, pieces: DataFrame) -> DataFrame:
    """Per row: n_tokens and the digests of its ids and decoded bytes."""
    short = whole.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = pieces.repartition(n, "key").sortWithinPartitions("key", "piece")
    return short.unionByName(ordered.mapInArrow(_digest_pieces, DIGEST_SCHEMA))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: ids and decoded bytes of every whole text, as digests per document."""
    import public_tokenizers as tokens

    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    path = tokens.path("byte_bpe_multi_50k.tiktoken")
    return digests(*encode(docs, path, tokens.PATTERN))
