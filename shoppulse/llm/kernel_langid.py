"""Language identification with a blended-spectrum string kernel.

k(x, y) counts the character n-grams (lengths ``SIZES``, hashed to ``2 ** BITS`` buckets)
present in both texts, normalised by the texts' own counts.  A bounded sample of
labelled texts gives the landmarks and the training set; the Nystroem map
k(x, L) K_LL^(-1/2) makes finite features of the kernel, and one-versus-rest kernel
ridge regression is solved on them.  Since k(x, L) is linear in x's presence vector,
landmarks and regression fold into one weight per bucket and language, and a batch
of texts is scored by one matrix product.

Null texts and texts without a letter are ``und`` with score 0.  Without any learnable
row every text is ``und``.  With a single learned language, that one is predicted.
Ties go to the language first in text order.  Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, learnable, read
from .ngrams import grams, padded, text_blocks

SIZES = (1, 2, 3)
BITS = 14
ROWS_PER_LANGUAGE = 400  # bound of the labelled sample
LANDMARKS_PER_LANGUAGE = 64
RIDGE = 1e-3
SHARPNESS = 4.0  # score: softmax of this times the regression outputs
UNDETERMINED = "und"
LEAST_SCORE = 0.4  # a filter keeps texts that score this much
PREDICTED, SCORE = "__lang_pred", "__lang_score"
FOLDS, HELD = 4, 2
_ROWS = 64


def presence(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(rows x buckets presence matrix as uint8, whether the row has a letter)."""
    chars, offsets = padded(texts)
    width = 1 << BITS
    found = np.zeros(len(texts) * width, dtype=np.uint8)
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(texts), dtype=np.int64) * width, sizes)
    for n in SIZES:
        at, bucket = grams(chars, n, BITS)
        if n == 1:
            solid = chars[at] != 32
            at, bucket = at[solid], bucket[solid]
        found[row[at] + bucket] = 1
    return found.reshape(len(texts), width), _letters(chars, offsets)


def _letters(chars: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.add.reduceat((chars != 32).astype(np.int64), offsets[:-1]) > 0


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # buckets x languages
    bias: np.ndarray

    def scores(self, found: np.ndarray) -> np.ndarray:
        own = np.sqrt(np.maximum(found.sum(axis=1, dtype=np.float32), 1.0))
        return (found.astype(np.float32) @ self.weights) / own[:, None] + self.bias


def fit(found: np.ndarray, labels: list[str]) -> Model:
    """Nystroem landmarks and one-versus-rest kernel ridge regression on a sample."""
    languages = sorted(set(labels))
    codes = np.array([languages.index(x) for x in labels])
    unit = found.astype(np.float64)
    unit /= np.sqrt(np.maximum(unit.sum(axis=1, keepdims=True), 1.0))
    chosen = np.concatenate(
        [np.flatnonzero(codes == c)[:LANDMARKS_PER_LANGUAGE] for c in range(len(languages))]
    )
    landmarks = unit[chosen]
    value, vector = np.linalg.eigh(landmarks @ landmarks.T)
    solid = value > 1e-8 * value.max()
    root = vector[:, solid] / np.sqrt(value[solid])
    features = (unit @ landmarks.T) @ root
    features = np.hstack([features, np.ones((len(features), 1))])
    target = np.where(codes[:, None] == np.arange(len(languages)), 1.0, -1.0)
    # each language weighs the same, however many rows of it the sample has
    weight = 1.0 / np.bincount(codes, minlength=len(languages))[codes][:, None]
    gram = features.T @ (weight * features)
    gram[np.diag_indices_from(gram)] += RIDGE * len(languages)
    solved = np.linalg.solve(gram, features.T @ (weight * target))
    folded = landmarks.T @ (root @ solved[:-1])
    return Model(languages, folded.astype(np.float32), solved[-1].astype(np.float32))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        order = batch.column("u").to_pylist()
        for a in range(0, len(texts), _ROWS):
            found, letters = presence(texts[a : a + _ROWS])
            rows = np.flatnonzero(letters)
            bits = np.packbits(found[rows], axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([langs[a + i] for i in rows], pa.string()),
                    pa.array([order[a + i] for i in rows], pa.float64()),
                    pa.array([b.tobytes() for b in bits], pa.binary()),
                ],
                names=["lang", "u", "bits"],
            )


def train(docs: DataFrame) -> Model | None:
    """Model from at most ``ROWS_PER_LANGUAGE`` learnable rows of each language.

    Rows are drawn by a hash of doc_id and text; equal rows are drawn once.  The bound is kept
    on the executors, so no more rows than that come back, however often a doc_id repeats.
    """
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(
        *(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 1.25 * ROWS_PER_LANGUAGE / n)))
    )
    u = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    first = Window.partitionBy("lang").orderBy("u")  # the limit is applied in the map task too
    drawn = (
        rows.withColumn("u", u)
        .filter(F.col("u") < share[F.col("lang")])
        .mapInArrow(_pack, "lang string, u double, bits binary")
        .groupBy("lang", "u")
        .agg(F.min("bits").alias("bits"))
        .withColumn("r", F.row_number().over(first))
        .filter(F.col("r") <= ROWS_PER_LANGUAGE)
    )
    kept = sorted(drawn.select("lang", "u", "bits").collect(), key=lambda r: (r["lang"], r["u"]))
    if not kept:
        return None
    bits = np.frombuffer(b"".join(bytes(r["bits"]) for r in kept), dtype=np.uint8)
    return fit(np.unpackbits(bits.reshape(len(kept), -1), axis=1), [r["lang"] for r in kept])


def predict(texts: list[str | None], model: Model | None) -> tuple[list[str], np.ndarray]:
    if model is None:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    found, letters = presence(texts)
    raw = SHARPNESS * model.scores(found).astype(np.float64)
    raw -= raw.max(axis=1, keepdims=True)
    odds = np.exp(raw)
    odds /= odds.sum(axis=1, keepdims=True)
    best = odds.argmax(axis=1)
    names = [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters)]
    return names, np.where(letters, odds[np.arange(len(best)), best], 0.0)


def _predict_map(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            names, scores = [], []
            for a, b in text_blocks(texts):
                for c in range(a, b, _ROWS):
                    got = predict(texts[c : min(b, c + _ROWS)], model)
                    names += got[0]
                    scores.append(got[1])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(names, pa.string()),
                    pa.array(np.concatenate(scores) if scores else [], pa.float64()),
                ],
                names=[*batch.schema.names, PREDICTED, SCORE],
            )

    return run


def _carried(docs: DataFrame) -> DataFrame:
    """``row`` (all columns, whatever their names) beside the text."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "text")


def _scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """row, text and the language (``PREDICTED``) and score (``SCORE``) of each whole text."""
    rows = _carried(docs)
    schema = T.StructType(list(rows.schema)).add(PREDICTED, T.StringType()).add(SCORE, T.DoubleType())
    return rows.mapInArrow(_predict_map(model), schema)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with the language (``PREDICTED``) and score (``SCORE``) of each whole text.

    Columns of ``docs`` with these two names give way.
    """
    kept = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in (PREDICTED, SCORE)]
    return _scored(docs, model).select(*kept, PREDICTED, SCORE)


def _with_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for a, b in text_blocks(texts):
            yield batch.slice(a, b - a).filter(pa.array(_letters(*padded(texts[a:b]))))


def known_language(docs: DataFrame, model: Model | None, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is determined with a score of ``least`` or more.

    Without a model nothing tells languages apart: only null texts and texts without a
    letter are rejected.
    """
    if model is None:
        rows = _carried(docs)
        return rows.mapInArrow(_with_letters, rows.schema).select("row.*")
    sure = (F.col(PREDICTED) != UNDETERMINED) & (F.col(SCORE) >= least)
    return _scored(docs, model).filter(sure).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: the language of every document, learned from three of four folds."""
    docs = read(spark, sf_dir, "documents")
    model = train(docs.filter(learnable("doc_id", FOLDS, HELD)))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out("doc_id", FOLDS, HELD).alias("held_out"),
        F.col(PREDICTED).alias("lang_pred"),
        F.col(SCORE).alias("score"),
    )
