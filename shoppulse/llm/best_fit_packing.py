"""Packing token sequences: a configuration linear program over the length histogram.

1. Every document becomes pieces of at most ``capacity`` tokens, each with its
   rank among the pieces of its length within its task (``tokenise``).
2. The histogram of piece lengths (at most ``capacity`` numbers, whatever the
   corpus) goes to the driver.  A configuration is a multiset of lengths that fits
   one sequence; the covering program over configurations is solved by
   multiplicative weights: the lengths are priced by how far they are covered, a knapsack
   dynamic program finds the most valuable configurations, and what they cover gets
   cheaper, until every length is covered (``Cover`` states the gap to the bound).
3. Shares of the fractional solution are rounded to whole sequences; the rest is packed by
   filling the largest piece's sequence exactly where the stock allows.  The share that
   needs the fewest sequences is taken, or filling alone where that needs fewer.
4. The plan says, for each length, which ranks go to which configuration, sequence
   and offset.  It has a bounded number of rows, so every task can look up its own
   pieces; nothing but the histogram is gathered.

Null and empty texts are one piece holding only the end token.  Extra columns are
ignored.  An empty table gives an empty result.  Repeated rows are packed each.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe
from .common import forget, kept, stored

CAPACITY = 1024
END_ID = 2
STEPS = 16  # a configuration covers at most this part of a length's demand
ETA = 0.02
REPRICE = 16  # configurations taken at the same prices
SHARES = tuple(1.0 - k / 20 for k in range(11))  # of the solution that is rounded, tried in turn

PIECES = (
    "block int, local_rank long, doc_id long, piece int, start long, length long, ids_crc32 long"
)
_PIECES_ARROW = pa.schema(
    [
        ("block", pa.int32()),
        ("local_rank", pa.int64()),
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)


class JsonCodec:
    """A tokenizer file of the ``tokenizers`` library behind a cache of pre-tokens.

    Ids are those of its plain call: texts that hold an added token's string, which the
    library cuts out before it pre-tokenises, go to the library whole.
    """

    _made: dict[str, JsonCodec] = kept({})

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        (self.newline,) = self.whole("\n")
        self.cache = bpe.PieceCache(self._pieces)

    @classmethod
    def of(cls, path: str) -> JsonCodec:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _pieces(self, pieces: list[str]) -> list[list[int]]:
        """Ids of distinct pre-tokens: joined by line ends, encoded at once, cut there again."""
        out: list[list[int]] = [[]] * len(pieces)
        solid = [i for i, p in enumerate(pieces) if not p[-1].isspace()]
        for a in range(0, len(solid), 4096):
            part = solid[a : a + 4096]
            ids = np.asarray(self.whole("\n".join(pieces[i] for i in part)), dtype=np.int64)
            cuts = np.flatnonzero(ids == self.newline)
            for i, piece in zip(part, np.split(ids, cuts)):
                piece = piece.tolist()
                out[i] = piece[1:] if piece[0] == self.newline else piece
        for i in set(range(len(pieces))) - set(solid):
            out[i] = self.whole(pieces[i])
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        holds = [any(x in t for x in self.added) for t in texts]
        plain = iter(bpe.encode_texts([t for t, h in zip(texts, holds) if not h], self.cache, self.whole))
        return [np.asarray(self.whole(t), dtype=np.uint32) if h else next(plain) for t, h in zip(texts, holds)]


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Piece lengths of a document of ``n`` tokens: only the first piece may be shorter."""
    if n <= capacity:
        return [n]
    first = n % capacity
    return ([first] if first else []) + [capacity] * (n // capacity)


def _tokenise(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = JsonCodec.of(path)
        block = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [t or "" for t in part.column("text").to_pylist()]
                rows = []
                for doc, ids in zip(part.column("doc_id").to_pylist(), codec.encode(texts)):
                    data = np.append(ids, end).astype("<u4").tobytes()
                    start = 0
                    for piece, size in enumerate(cut_lengths(len(data) // 4, capacity)):
                        crc = zlib.crc32(data[4 * start : 4 * (start + size)])
                        rows.append((block, int(seen[size]), doc, piece, start, size, crc))
                        seen[size] += 1
                        start += size
                columns = zip(*rows) if rows else [[]] * len(_PIECES_ARROW)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _PIECES_ARROW)],
                    schema=_PIECES_ARROW,
                )

    return run


# ---- the program over the histogram ------------------------------------------


def price_table(value: np.ndarray, capacity: int) -> np.ndarray:
    """Unbounded knapsack: the last length taken (0: none) of the most valuable multiset of each total.

    ``value[l]`` is the worth of one piece of length ``l`` (0: not offered).
    """
    best = np.zeros(capacity + 1)
    pick = np.zeros(capacity + 1, dtype=np.int64)
    offered = np.flatnonzero(value[1 : capacity + 1] > 0) + 1
    worth = value[offered]
    for c in range(int(offered[0]) if len(offered) else capacity + 1, capacity + 1):
        n = int(np.searchsorted(offered, c, side="right"))
        total = best[c - offered[:n]] + worth[:n]
        at = int(total.argmax())
        if total[at] > best[c - 1]:
            best[c], pick[c] = total[at], offered[at]
        else:
            best[c] = best[c - 1]
    return pick


def filling(pick: np.ndarray, room: int) -> dict[int, int]:
    """The most valuable multiset within ``room``, read off a price table."""
    config: dict[int, int] = {}
    while room > 0:
        size = int(pick[room])
        if size:
            config[size] = config.get(size, 0) + 1
        room -= size or 1
    return config


def best_configuration(value: np.ndarray, capacity: int) -> dict[int, int]:
    """Most valuable multiset of lengths with total at most ``capacity``."""
    return filling(price_table(value, capacity), capacity)


@dataclass
class Cover:
    """A feasible fractional solution: sequences of each configuration, and how good it is."""

    amounts: dict[tuple, float]  # configuration as sorted (length, times) pairs
    covered: np.ndarray  # pieces of each length that the configurations hold
    gap: float  # sequences over the volume bound, less 1


def solve_program(counts: np.ndarray, capacity: int, steps: int = STEPS, eta: float = ETA) -> Cover:
    """Covering program by multiplicative weights; it ends when every length is covered.

    A piece of length l is worth l times a weight that falls by the factor exp(-eta) for each
    ``1 / steps`` of its demand by which it is ahead of the length that is covered least.
    That length opens the next configuration and the knapsack program fills it; the
    configuration is taken until the first of its lengths has gained ``1 / steps``.  Prices are
    found anew after every ``REPRICE`` configurations.
    """
    need = counts.astype(float)
    lengths = np.arange(capacity + 1)
    covered = np.zeros(capacity + 1)
    amounts: dict[tuple, float] = {}
    share = np.where(need > 0, 0.0, np.inf)  # of the demand that is covered
    pick, age = None, 0
    while True:
        least = int(share.argmin())
        if share[least] >= 1 - 1e-9:
            break
        if pick is None or age >= REPRICE:
            ahead = np.minimum((share - share[least]) * steps, 60.0)
            value = np.where(share < 1 - 1e-9, lengths * np.exp(-eta * ahead), 0.0)
            pick, age = price_table(value, capacity), 0
        config = filling(pick, capacity - least)
        config[least] = config.get(least, 0) + 1
        age += 1
        sizes = np.array(list(config), dtype=np.int64)
        times = np.array(list(config.values()), dtype=float)
        amount = float((need[sizes] / times).min()) / steps
        covered[sizes] += amount * times
        share[sizes] = covered[sizes] / need[sizes]
        key = tuple(sorted(config.items()))
        amounts[key] = amounts.get(key, 0.0) + amount
    volume = float((need * lengths).sum()) / capacity
    return Cover(amounts, covered, sum(amounts.values()) / volume - 1 if volume else 0.0)


def _clip(config: dict[int, int], left: np.ndarray) -> int:
    return int(min(left[size] // times for size, times in config.items()))


def _fill(left: np.ndarray, capacity: int) -> dict[int, int]:
    """The largest piece left, and the pieces in stock that fill its sequence best.

    Reachable totals are the bits of a number, the larger pieces first; it stops at an
    exact filling.
    """
    largest = int(np.flatnonzero(left)[-1])
    room = capacity - largest
    stock = left[: room + 1].copy()
    if largest <= room:
        stock[largest] -= 1
    mask, reach, trail = (1 << (room + 1)) - 1, 1, []
    for size in np.flatnonzero(stock)[::-1].tolist():
        for _ in range(min(int(stock[size]), room // size)):
            more = reach | (reach << size & mask)
            if more == reach:
                break
            trail.append((size, reach))
            reach = more
        if reach >> room:
            break
    total = reach.bit_length() - 1
    config = {largest: 1}
    for size, before in reversed(trail):
        if not before >> total & 1:
            config[size] = config.get(size, 0) + 1
            total -= size
    return config


Plan = list[tuple[dict[int, int], int]]


def _taken(plan: Plan, left: np.ndarray, config: dict[int, int], whole: int) -> None:
    plan.append((config, whole))
    for size, times in config.items():
        left[size] -= whole * times


def _filled(plan: Plan, left: np.ndarray, capacity: int) -> Plan:
    """``plan`` and sequences for the pieces that are left, the largest first."""
    while left.any():
        config = _fill(left, capacity)
        _taken(plan, left, config, _clip(config, left))
    return plan


def sequences(plan: Plan) -> int:
    return sum(whole for _, whole in plan)


def round_program(counts: np.ndarray, cover: Cover, capacity: int, share: float = 1.0) -> tuple[Plan, int]:
    """Whole sequences [(configuration, how many)] that use every piece exactly once.

    ``share`` of the fractional amounts is rounded down so that the running sum is kept,
    configurations of large pieces first, and cut to the pieces there are; the rest is
    filled up.  Configurations that leave room are left to the filling too.  Also
    returns how many sequences come from the program.
    """
    left = counts.astype(np.int64).copy()
    plan: Plan = []
    carry = 0.0
    for key in sorted(cover.amounts, key=lambda k: (-k[0][0], k)):  # by the smallest length
        if sum(size * times for size, times in key) < capacity:
            continue
        carry = min(carry, 1.0) + cover.amounts[key] * (share if len(key) > 1 else 1.0)
        config = dict(key)
        whole = min(int(carry + 1e-9), _clip(config, left))
        if whole > 0:
            _taken(plan, left, config, whole)
            carry -= whole
    from_program = sequences(plan)
    return _filled(plan, left, capacity), from_program


def best_plan(counts: np.ndarray, capacity: int) -> tuple[Plan, int]:
    """The best rounding of the program, or plain filling where that needs fewer sequences.

    A smaller share leaves more of every length to the filling; each is tried.
    """
    cover = solve_program(counts, capacity)
    plans = [round_program(counts, cover, capacity, share) for share in SHARES]
    plans.append((_filled([], counts.astype(np.int64).copy(), capacity), 0))
    return min(plans, key=lambda made: (sequences(made[0]), -made[1]))


@dataclass
class Layout:
    """For each length, intervals of ranks with the sequences and offsets they go to."""

    key: np.ndarray  # length * STRIDE + first rank, sorted
    per_sequence: np.ndarray
    first_sequence: np.ndarray
    first_offset: np.ndarray

    STRIDE = 1 << 50

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = length * self.STRIDE + rank
        at = np.searchsorted(self.key, key, side="right") - 1
        inside = key - self.key[at]
        times = self.per_sequence[at]
        return (
            self.first_sequence[at] + inside // times,
            self.first_offset[at] + (inside % times) * length,
        )


def layout(plan: list[tuple[dict[int, int], int]], capacity: int) -> Layout:
    next_rank = np.zeros(capacity + 1, dtype=np.int64)
    sequence, rows = 0, []
    for config, whole in plan:
        offset = 0
        for size, times in sorted(config.items(), reverse=True):
            rows.append((size * Layout.STRIDE + int(next_rank[size]), times, sequence, offset))
            next_rank[size] += times * whole
            offset += size * times
        sequence += whole
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 4).T
    return Layout(*columns)


def _place(plan: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()  # all texts are tokenised
        for batch in batches:
            column = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
            sequence, offset = plan.place(column("length"), column("rank"))
            keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(sequence), pa.array(offset)],
                names=[*keep, "sequence_id", "offset"],
            )

    return run


RESULT = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, "
    "sequence_id long, offset long"
)


def pack(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text) with its sequence and place there."""
    cut = docs.select("doc_id", "text").mapInArrow(_tokenise(tokenizer_path, end_id, capacity), PIECES)
    pieces = stored(spark, cut, "packing-pieces")
    counts = pieces.groupBy("length", "block").agg(F.count("*").alias("n"))
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # <= capacity rows
        histogram[row["length"]] = row["n"]
    plan = layout(best_plan(histogram, capacity)[0], capacity)
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        "length", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    ranked = pieces.join(before, ["length", "block"]).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("before") + F.col("local_rank")).alias("rank"),
    )
    return ranked.mapInArrow(_place(plan), RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: every document's pieces packed into sequences of at most 1024 tokens."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return pack_documents(spark, docs)


def pack_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    import public_tokenizers as tokens

    return pack(spark, docs, tokens.path("byte_bpe_50k.json"))
