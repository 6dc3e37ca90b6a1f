"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text is reduced to ``FEATURES`` (transformed counts, ratios and repetition measures).
The class means and covariances are summed over all learnable labelled rows; each
covariance is shrunk towards a scaled identity, its Cholesky factor is computed
once, and a document's score is the logistic of the difference of the classes'
Mahalanobis log-densities plus the log prior ratio.

Null and empty texts have the statistics of an empty text and are scored with them.
With a single learned class every score is that class; without labels it is 0.5.
Labels other than 0 and 1, or null, are not learned from.  Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (
    blocks,
    held_out,
    learnable,
    mix,
    read,
    span_hashes,
    stored,
    text_buffer,
    word_spans,
)

FEATURES = (
    "log_words",
    "word_length",
    "word_length_spread",
    "upper",
    "digits",
    "symbols",
    "marks",
    "exclamations",
    "pipes",
    "beyond_ascii",
    "distinct_words",
    "repeated_lines",
    "log_line_words",
)
SHRINKAGE = 0.1
# an ordinary text's words and lines that are added to every text before ratios are taken
SMOOTH, USUAL_LENGTH, USUAL_SPREAD, SMOOTH_LINES = 20, 5.0, 2.5, 2
THRESHOLD = 0.3
FOLDS, HELD = 5, 0


def _byte_classes() -> np.ndarray:
    out = np.full(256, 5, dtype=np.uint8)  # other control and punctuation bytes
    out[list(range(ord("a"), ord("z") + 1))] = 0
    out[list(range(ord("A"), ord("Z") + 1))] = 1
    out[list(range(ord("0"), ord("9") + 1))] = 2
    out[list(b"#*$%&<>@^~=+_\\/{}[]")] = 3
    out[list(b".,;:?'\"()-")] = 4
    out[ord("!")] = 6
    out[ord("|")] = 7
    out[128:] = 8
    return out


CLASSES = _byte_classes()


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """rows x FEATURES of the texts in one buffer."""
    rows = len(offsets) - 1
    kind = CLASSES[raw]

    def count(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[edges])

    per = {k: count(kind == k, offsets) for k in (1, 2, 3, 4, 6, 7, 8)}
    starts, ends, first = word_spans(raw, offsets)
    size = (ends - starts).astype(np.float64)
    words = np.diff(first)
    some = words + SMOOTH  # short texts are drawn towards an ordinary one
    total = np.append(0.0, np.cumsum(size))
    square = np.append(0.0, np.cumsum(size * size))
    solid = np.diff(total[first]) + SMOOTH * USUAL_LENGTH  # bytes inside words
    mean = solid / some
    around = (np.diff(square[first]) + SMOOTH * (USUAL_LENGTH**2 + USUAL_SPREAD**2)) / some
    spread = np.sqrt(np.maximum(around - mean * mean, 0.0))

    def distinct(hashes: np.ndarray, edges: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(rows), np.diff(edges))
        _, at = np.unique(mix(hashes + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
        return np.bincount(row[at], minlength=rows)

    different = distinct(span_hashes(raw, starts, ends), first)
    # lines with a word, each named by its first word
    breaks = np.flatnonzero(raw == 0x0A)
    line_from = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_from = line_from[line_from < len(raw)]
    line_to = np.minimum(
        np.append(line_from[1:], len(raw)),
        offsets[np.searchsorted(offsets, line_from, side="right")] if len(line_from) else 0,
    )
    has_word = np.searchsorted(starts, line_to) > np.searchsorted(starts, line_from)
    line_from, line_to = line_from[has_word], line_to[has_word]
    ends_in_break = raw[np.maximum(line_to - 1, 0)] == 0x0A if len(raw) else np.zeros(0, bool)
    line_to = line_to - ends_in_break
    edges = np.searchsorted(line_from, offsets)
    lines = np.diff(edges)
    some_lines = lines + SMOOTH_LINES
    repeated = lines - distinct(span_hashes(raw, line_from, line_to), edges)
    root = lambda k: np.sqrt(per[k] / solid)
    return np.column_stack(
        [
            np.log1p(words),
            mean,
            spread,
            root(1),
            root(2),
            root(3),
            root(4),
            root(6),
            root(7),
            root(8),
            (different + SMOOTH) / some,
            np.sqrt(repeated / some_lines),
            np.log1p((words + SMOOTH) / some_lines),
        ]
    )


_SCHEMA = "doc_id long, x array<double>"


def _statistics_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_buffer(batch.column("text"))
        for a, b in blocks(offsets):
            x = statistics(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a), pa.array(list(x), pa.list_(pa.float64()))],
                names=["doc_id", "x"],
            )


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics ``x`` of each whole text."""
    return docs.select("doc_id", "text").mapInArrow(_statistics_map, _SCHEMA)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, len(FEATURES))


def _moments_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and class: count, sums and sums of products, one number a row."""
    width = len(FEATURES) + 1
    total = np.zeros((2, width, width))
    for batch in batches:
        x = np.hstack([np.ones((batch.num_rows, 1)), _matrix(batch.column("x"))])
        label = batch.column("label").to_numpy(zero_copy_only=False)
        for c in (0, 1):
            part = x[label == c]
            total[c] += part.T @ part
    c, i, j = np.nonzero(np.ones_like(total))
    yield pa.RecordBatch.from_arrays(
        [pa.array(c * width * width + i * width + j, pa.int32()), pa.array(total.ravel())],
        names=["at", "value"],
    )


@dataclass
class Model:
    """Means, Cholesky factors, log-determinants and log priors of the two classes."""

    shift: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.shift) / self.scale
        density = []
        for mean, inverse, constant in zip(self.means, self.factors, self.constants):
            y = (z - mean) @ inverse.T
            density.append(constant - 0.5 * np.einsum("ij,ij->i", y, y))
        return 1.0 / (1.0 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def fit(total: np.ndarray, shrinkage: float = SHRINKAGE) -> Model | float:
    """Model from the classes' summed products (2 x width x width); a constant without two classes."""
    counts = total[:, 0, 0]
    if (counts == 0).any():
        return 0.5 if not counts.any() else float(counts[1] > 0)
    both = total.sum(axis=0)
    shift = both[0, 1:] / both[0, 0]
    scale = np.sqrt(np.maximum(np.diag(both)[1:] / both[0, 0] - shift**2, 1e-8))
    means, factors, constants = [], [], []
    for c in (0, 1):
        n = counts[c]
        mean = total[c, 0, 1:] / n
        cov = (total[c, 1:, 1:] / n - np.outer(mean, mean)) / np.outer(scale, scale)
        cov = (1 - shrinkage) * cov
        cov[np.diag_indices_from(cov)] += shrinkage * max(np.trace(cov) / len(cov), 1e-3)
        lower = np.linalg.cholesky(cov)
        means.append((mean - shift) / scale)
        factors.append(np.linalg.inv(lower))
        constants.append(float(np.log(n / counts.sum()) - np.log(np.diag(lower)).sum()))
    return Model(shift, scale, means, factors, constants)


def train(rows: DataFrame) -> Model | float:
    """``rows`` (x, label): only the summed moments, a fixed number of values, are collected."""
    width = len(FEATURES) + 1
    sums = (
        rows.select("x", F.col("label").cast("long").alias("label"))
        .filter("label in (0, 1)")
        .mapInArrow(_moments_map, "at int, value double")
        .groupBy("at")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    total = np.zeros(2 * width * width)
    for r in sums:
        total[r["at"]] = r["value"]
    return fit(total.reshape(2, width, width))


def _score_map(model: Model | float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"))
            got = model.score(x) if isinstance(model, Model) else np.full(len(x), model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got)], names=["doc_id", "score"])

    return run


def score(rows: DataFrame, model: Model | float) -> DataFrame:
    return rows.select("doc_id", "x").mapInArrow(_score_map(model), "doc_id long, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: quality score of every document, learned from four of five folds."""
    rows = stored(spark, features(read(spark, sf_dir, "documents")), "quality-features")
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    known = rows.filter(learnable("doc_id", FOLDS, HELD)).join(labels, "doc_id")
    scored = score(rows, train(known))
    return scored.select(
        "doc_id",
        held_out("doc_id", FOLDS, HELD).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
