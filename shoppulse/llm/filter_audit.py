"""How filters interact: what each removes in every order, alone, and in vain.

Five filters judge a whole text; a failing one sets its bit in the document's mask:

    A  fewer than 200 words                      B  fewer than half of the words distinct
    C  over 3 % of the code points are A-Z       D  holds one of # $ % & * |
    E  identical to the text of any smaller doc_id

1. One pass measures A to D and digests each text; only narrow rows are kept.
2. Counting-Bloom prepass: every task counts its digests in ``HASHES`` of the sketch's
   slots, the sketches are added up, and a text with a slot that was hit once is
   certainly unique.  The sketch has about ``SLOTS_A_DOC`` slots a document, at most
   ``MOST_SLOTS``; what reaches the driver and the tasks is one bit a slot (32 MB at most).
   A sketch that is too full clears fewer texts and changes no result.
3. Only possible repeats are shuffled: grouped by the whole text (combined in the map task,
   so a hot text leaves each task once) they give the smallest doc_id of each text.
4. A possible repeat fails E unless it is that smallest one.  The flags meet the labels on
   doc_id, and documents are counted by part, mask and label.  All figures of the
   audit are sums over these counts (at most 32 masks a part).

Null and empty texts are empty and equal to each other.  Rows without doc_id have no
smaller doc_id and no label; repeated rows (same doc_id, same text) count each and do not
fail E by each other.  A doc_id that is labelled more than once has a label if any of its
rows has it.  A null ``lang`` is the part ''.  An empty table has no part and no row.
Very long texts are held one at a time.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, discard, read, stored, text_buffer

FILTERS = "ABCDE"
BIT = {name: 1 << i for i, name in enumerate(FILTERS)}
FEW_WORDS = 200
UPPER_PERCENT = 3
SPECIAL = b"#$%&*|"

SLOTS_A_DOC = 16
MOST_SLOTS = 1 << 28
SEGMENT_BITS = 16  # slots merged together
HASHES = 3
SKETCHED = 1 << 20  # documents that a task counts before it passes its sketch on

_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_SPECIAL = np.zeros(256, dtype=bool)
_SPECIAL[list(SPECIAL)] = True
_LEAD = np.ones(256, dtype=bool)  # bytes that begin a code point
_LEAD[0x80:0xC0] = False


# ---- filters A to D -----------------------------------------------------------------


def _sums(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(marks))[offsets])


def texts_of(column: pa.Array) -> Iterator[tuple[bytes, np.ndarray]]:
    """(bytes of some texts, their offsets), block by block."""
    raw, offsets = text_buffer(column)
    for a, b in blocks(offsets):
        yield raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def digest(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


_FLAGS_ARROW = pa.schema([("mask", pa.int32()), ("digest", pa.binary())])


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id and part with the mask of A to D and the digest."""
    for batch in batches:
        masks, digests = [], []
        for part, edges in texts_of(batch.column("text")):
            upper, points = _sums(_UPPER[part], edges), _sums(_LEAD[part], edges)
            mask = np.where(100 * upper > UPPER_PERCENT * points, BIT["C"], 0)
            mask |= np.where(_sums(_SPECIAL[part], edges) > 0, BIT["D"], 0)
            data = part.tobytes()
            for row, (a, b) in enumerate(zip(edges, edges[1:])):
                text = data[a:b]
                words = text.split()
                if len(words) < FEW_WORDS:
                    mask[row] |= BIT["A"]
                if 100 * len(set(words)) < 50 * len(words):
                    mask[row] |= BIT["B"]
                digests.append(digest(text))
            masks.append(mask)
        mask = np.concatenate(masks) if masks else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array(mask, pa.int32()), pa.array(digests, pa.binary())],
            names=["doc_id", "part", "mask", "digest"],
        )


def flags(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask of the filters A to D, and the text's digest."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("lang", F.lit("")).alias("part"), "text")
    return rows.mapInArrow(_measure, "doc_id long, part string, mask int, digest binary")


# ---- the counting sketch ------------------------------------------------------------


def slots_of(digests: pa.Array, slots: int) -> np.ndarray:
    """``HASHES`` slots of each digest (rows by hashes); ``slots`` is a power of two."""
    data = b"".join(digests.to_pylist())
    halves = np.frombuffer(data, "<u8").reshape(-1, 2)
    step = halves[:, 1] | np.uint64(1)
    out = [halves[:, 0] + np.uint64(k) * step for k in range(HASHES)]
    return (np.stack(out, axis=1) >> np.uint64(64 - slots.bit_length() + 1)).astype(np.int64)


_PART_ARROW = pa.schema([("segment", pa.int32()), ("at", pa.binary()), ("n", pa.binary())])


def _packed_counts(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    slot, n = np.unique(np.concatenate(held), return_counts=True)
    segment = slot >> SEGMENT_BITS
    at, count = (slot & ((1 << SEGMENT_BITS) - 1)).astype(np.uint16), np.minimum(n, 2).astype(np.uint8)
    cuts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
    ends = np.append(cuts[1:], len(slot))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(segment[cuts], pa.int32()),
            pa.array([at[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            pa.array([count[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
        ],
        schema=_PART_ARROW,
    )


def _count_slots(slots: int):
    """A task's sketch: counters up to 2 (more tells nothing else), by segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(slots_of(batch.column("digest"), slots).ravel())
            size += batch.num_rows
            if size >= SKETCHED:
                yield from _packed_counts(held)
                held, size = [], 0
        if held:
            yield from _packed_counts(held)

    return run


def _merge(table: pa.Table) -> pa.Table:
    """The sum of a segment's sketches, as a bit for every slot that was hit twice or more."""
    total = np.zeros(1 << SEGMENT_BITS, dtype=np.uint8)
    for at, n in zip(table.column("at").to_pylist(), table.column("n").to_pylist()):
        where = np.frombuffer(at, np.uint16)
        total[where] = np.minimum(total[where] + np.frombuffer(n, np.uint8), 2)
    bits = np.packbits(total == 2, bitorder="little").tobytes()
    return pa.table({"segment": table.column("segment")[:1], "bits": pa.array([bits], pa.binary())})


class Sketch:
    """One bit a slot: was it hit twice or more."""

    def __init__(self, slots: int, bits: np.ndarray):
        self.slots, self.bits = slots, bits

    def repeated(self, digests: pa.Array) -> np.ndarray:
        """False: certainly unique."""
        if len(digests) == 0:
            return np.zeros(0, bool)
        at = slots_of(digests, self.slots)
        return ((self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def sketch_of(rows: DataFrame, slots: int | None = None) -> Sketch:
    """The merged sketch of ``rows`` (digest)."""
    if slots is None:
        slots = 1 << max(SEGMENT_BITS, int(rows.count() * SLOTS_A_DOC).bit_length())
        slots = min(slots, MOST_SLOTS)
    merged = (
        rows.select("digest")
        .mapInArrow(_count_slots(slots), "segment int, at binary, n binary")
        .groupBy("segment")
        .applyInArrow(_merge, "segment int, bits binary")
    )
    bits = np.zeros(slots >> 3, dtype=np.uint8)
    size = 1 << (SEGMENT_BITS - 3)
    for row in merged.toLocalIterator():  # slots / 8 bytes in all
        bits[row["segment"] * size : (row["segment"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return Sketch(slots, bits)


def _tag(sketch):
    """Narrow rows with ``possible``: the text may be another's too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            possible = sketch.value.repeated(batch.column("digest"))
            yield batch.append_column("possible", pa.array(possible, pa.bool_()))

    return run


def _possible_texts(sketch):
    """The texts that may be repeats, with their digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for part, edges in texts_of(batch.column("text")):
                data = part.tobytes()
                found += [digest(data[a:b]) for a, b in zip(edges, edges[1:])]
            digests = pa.array(found, pa.binary())
            some = pa.array(np.flatnonzero(sketch.value.repeated(digests)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(some), digests.take(some), batch.column("text").take(some)],
                names=["doc_id", "digest", "text"],
            )

    return run


def first_holders(docs: DataFrame, sketch) -> DataFrame:
    """doc_id, digest of the smallest holder of each text that may be repeated."""
    texts = docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = texts.mapInArrow(_possible_texts(sketch), "doc_id long, digest binary, text string")
    holders = rows.groupBy("digest", "text").agg(F.min("doc_id").alias("doc_id"))
    return holders.select("doc_id", "digest")


# ---- masks and the audit -------------------------------------------------------------


def mask_counts(docs: DataFrame, labels: DataFrame, slots: int | None = None) -> DataFrame:
    """part, mask, n, good, toxic: documents by the filters they fail, and those labelled among them."""
    spark = docs.sparkSession
    narrow = stored(spark, flags(docs), "audit-flags")
    sketch = spark.sparkContext.broadcast(sketch_of(narrow, slots))
    tagged = narrow.mapInArrow(
        _tag(sketch), "doc_id long, part string, mask int, digest binary, possible boolean"
    )
    alike = ["doc_id", "digest", "part", "mask", "possible"]
    named = tagged.filter("doc_id is not null").groupBy(*alike).agg(F.count("*").alias("n"))
    first = first_holders(docs, sketch).withColumn("first", F.lit(True))
    marked = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic"),
    )
    repeat = F.col("possible") & F.col("first").isNull()
    n_if = lambda name: F.sum(F.when(F.col(name), F.col("n")).otherwise(F.lit(0))).cast("long")
    judged = (
        named.join(first, ["doc_id", "digest"], "left")
        .join(marked, "doc_id", "left")
        .withColumn("mask", F.col("mask") + F.when(repeat, F.lit(BIT["E"])).otherwise(F.lit(0)))
        .groupBy("part", "mask")
        .agg(F.sum("n").alias("n"), n_if("is_good").alias("good"), n_if("is_toxic").alias("toxic"))
    )
    none = F.lit(0).cast("long")
    unnamed = narrow.filter("doc_id is null").groupBy("part", "mask").agg(F.count("*").alias("n"))
    unnamed = unnamed.select("part", "mask", "n", none.alias("good"), none.alias("toxic"))
    sums = [F.sum(c).alias(c) for c in ("n", "good", "toxic")]
    out = stored(spark, judged.unionByName(unnamed).groupBy("part", "mask").agg(*sums), "audit-masks")
    discard(narrow)
    return out


def _steps() -> str:
    """Every step of every order: its filter's bit and the bits of the filters before it."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            rows.append({"filter_order": "".join(order), "step": step, "bit": BIT[name], "before": before})
            before |= BIT[name]
    return json.dumps(rows)


def audit(counts: DataFrame) -> DataFrame:
    """part, filter_order, step and the figures of each step, from ``counts`` (mask_counts)."""
    schema = "array<struct<filter_order: string, step: int, bit: int, before: int>>"
    steps = counts.select("*", F.inline(F.from_json(F.lit(_steps()), schema)))
    fails, earlier = "(mask & bit) <> 0", "(mask & before) <> 0"
    total = lambda test, n: F.expr(f"coalesce(sum({n}) filter (where {test}), 0)").cast("long")
    return steps.groupBy("part", "filter_order", "step").agg(
        total(f"not ({fails}) and not ({earlier})", "n").alias("kept"),
        total(f"{fails} and not ({earlier})", "n").alias("removed"),
        total(f"{fails} and {earlier}", "n").alias("redundant"),
        total("mask = bit", "n").alias("unique_fails"),
        total(f"{fails} and not ({earlier})", "good").alias("good_lost"),
        total(f"{fails} and not ({earlier})", "toxic").alias("toxic_lost"),
        # among the filters that a document fails, each comes first in its share of the orders
        total(fails, "n * (120 div bit_count(mask))").alias("shapley"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: the five filters in all 120 orders, by language."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return audit(mask_counts(docs, labels))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), f AS (
  SELECT doc_id, part,
         (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS fails
  FROM d
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), g AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, fails
), letter AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letter a JOIN letter b ON b.x <> a.x JOIN letter c ON c.x NOT IN (a.x, b.x)
  JOIN letter d ON d.x NOT IN (a.x, b.x, c.x) JOIN letter e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), steps AS (
  SELECT filter_order, step, filter_order[step] AS own, filter_order[1:step - 1] AS before
  FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders) x
), judged AS (
  SELECT part, filter_order, step, own, n, good, toxic, fails,
         contains(fails, own) AS hit,
         len(translate(fails, before, '')) < len(fails) AS gone
  FROM g, steps
), audit AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (WHERE NOT hit AND NOT gone), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE hit AND NOT gone), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE hit AND gone), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE fails = own), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE hit AND NOT gone), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE hit AND NOT gone), 0) AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM audit
"""
