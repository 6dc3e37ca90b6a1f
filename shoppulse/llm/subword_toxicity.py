"""Toxicity: averaged subword embeddings into a linear softmax.

A word's subwords are its character n-grams (lengths ``SIZES``, word edges included),
hashed to ``2 ** BITS`` embedding rows, so a misspelt word shares most vectors with the
word it stands for.  A bag is a passage of ``PASSAGE`` consecutive words; the mean of its
subword vectors goes to a two-class softmax, and a document scores as its most
toxic passage, so that a long text does not dilute a short insult.  Embeddings and
softmax are trained jointly in numpy on a bounded sample of labelled rows: of a toxic
document only its currently most toxic passage is a positive example, of a clean one
all sampled passages are negative.

Null, empty and wordless texts have no passage and score 0.  With one learned class only
(or none), and on an empty table, every score is 0.  Repeated rows are scored each.  Very
long texts are scored whole, a block of texts at a time.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, learnable, read
from .ngrams import grams, padded, text_blocks

SIZES = (3, 4, 5)
BITS = 19
DIM = 16
PASSAGE = 3  # one insult is a third of its passage, not lost in the mean of many words
THRESHOLD = 0.3
FOLDS, HELD = 4, 2
# bound of the labelled sample: rows a class, characters of each (a section of a longer text), and
# passages of a clean row
TOXIC_ROWS, CLEAN_ROWS, SAMPLE_CHARS, SAMPLE_PASSAGES = 1500, 2500, 8_000, 48
EPOCHS, RATE, CLEAN_PASSAGES = 8, 0.5, 9
LEAST_ROWS = 5  # a subword in fewer sampled texts stays at the zero vector, as an unseen one does


def bags(texts: list[str | None]):
    """(bucket of each subword, bag of each subword, first bag of each text) sorted by bag."""
    chars, offsets = padded(texts, digits=True)
    blank = chars == 32
    begins = np.flatnonzero(~blank[1:] & blank[:-1]) + 1  # first character of each word
    first_word = np.searchsorted(begins, offsets)
    words = np.diff(first_word)
    text_of = np.repeat(np.arange(len(texts)), words)
    bags_per_text = -(-words // PASSAGE)
    first_bag = np.append(0, np.cumsum(bags_per_text))
    within = np.arange(len(begins)) - first_word[:-1][text_of]
    bag_of_word = first_bag[text_of] + within // PASSAGE
    bucket, bag = [], []
    for n in SIZES:
        at, b = grams(chars, n, BITS)
        # a gram belongs to the word it has characters of
        word = np.searchsorted(begins, at + 1, side="right") - 1
        bucket.append(b)
        bag.append(bag_of_word[word])
    bucket, bag = np.concatenate(bucket), np.concatenate(bag)
    return bucket, bag, first_bag


@dataclass
class Model:
    """Per-subword logit (embedding times softmax difference) and bias."""

    logit: np.ndarray
    bias: float

    def passages(self, bucket: np.ndarray, bag: np.ndarray, n: int) -> np.ndarray:
        total = np.bincount(bag, weights=self.logit[bucket], minlength=n)
        size = np.maximum(np.bincount(bag, minlength=n), 1)
        return total / size + self.bias

    def score(self, texts: list[str | None]) -> np.ndarray:
        bucket, bag, first = bags(texts)
        out = np.zeros(len(texts))
        if first[-1]:
            values = self.passages(bucket, bag, int(first[-1]))
            some = np.flatnonzero(np.diff(first))
            best = np.maximum.reduceat(values, first[some])
            out[some] = 1.0 / (1.0 + np.exp(-np.clip(best, -700, 700)))
        return out


class Bags:
    """Subwords of the sampled passages, in rows by passage, and their counts by document."""

    def __init__(self, texts: list[str], labels: np.ndarray, rng: np.random.Generator):
        buckets, sizes, per_text = [], [], []
        self.rows_with = np.zeros((2, 1 << BITS), dtype=np.int32)  # documents of each class with it
        for label, text in zip(labels, texts):
            bucket, bag, first = bags([text])
            n = int(first[-1])
            self.rows_with[label, np.unique(bucket)] += 1
            if label == 0 and n > SAMPLE_PASSAGES:
                chosen = np.sort(rng.choice(n, SAMPLE_PASSAGES, replace=False))
                new = np.full(n, -1)
                new[chosen] = np.arange(SAMPLE_PASSAGES)
                bag, n = new[bag], SAMPLE_PASSAGES
                bucket, bag = bucket[bag >= 0], bag[bag >= 0]
            buckets.append(bucket[np.argsort(bag, kind="stable")].astype(np.int32))
            sizes.append(np.bincount(bag, minlength=n))
            per_text.append(n)
        self.bucket = np.concatenate(buckets)
        self.size = np.concatenate(sizes)
        self.start = np.append(0, np.cumsum(self.size))
        self.first = np.append(0, np.cumsum(per_text))

    def logits(self, logit: np.ndarray) -> np.ndarray:
        """Mean subword logit of every passage."""
        out = np.zeros(len(self.size))
        for a in range(0, len(self.size), 4096):
            b = min(len(self.size), a + 4096)
            value = logit[self.bucket[self.start[a] : self.start[b]]]
            total = np.append(0.0, np.cumsum(value, dtype=np.float64))
            out[a:b] = np.diff(total[self.start[a : b + 1] - self.start[a]]) / np.maximum(self.size[a:b], 1)
        return out

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(buckets, position of their passage in ``rows``)."""
        size = self.size[rows]
        shift = np.repeat(self.start[rows] - (np.cumsum(size) - size), size)
        return self.bucket[shift + np.arange(len(shift))], np.repeat(np.arange(len(rows)), size)


def fit(texts: list[str], labels: np.ndarray, seed: int = 7) -> Model | None:
    """Joint training of embeddings and softmax by Adagrad on the sample."""
    if len(set(labels.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    data = Bags(texts, labels, rng)
    width = 1 << BITS
    # start: log odds of a subword among toxic and clean documents, in one dimension
    c0, c1 = data.rows_with
    n1, n0 = int(labels.sum()), int((1 - labels).sum())
    odds = (np.log((c1 + 1.0) / (n1 + 2.0)) - np.log((c0 + 1.0) / (n0 + 2.0))).astype(np.float32)
    known = (c1 + c0 >= LEAST_ROWS).astype(np.float32)
    odds *= known
    embed = rng.normal(0, 0.01, (width, DIM)).astype(np.float32) * known[:, None]
    embed[:, 0] += odds
    soft = rng.normal(0, 0.01, (DIM, 2)).astype(np.float32)
    soft[0] += (-2.0, 2.0)
    bias = np.array([0.0, -2.0], dtype=np.float32)
    caches = [np.full_like(v, 1e-6) for v in (embed, soft, bias)]
    clean_docs, toxic_docs = np.flatnonzero(labels == 0), np.flatnonzero(labels == 1)
    for _ in range(EPOCHS):
        value = data.logits(embed @ (soft[:, 1] - soft[:, 0]))
        rows, target = [], []
        for docs, label, most in ((toxic_docs, 1, 1), (clean_docs, 0, CLEAN_PASSAGES)):
            for d in docs:
                a, b = data.first[d], data.first[d + 1]
                if a == b:
                    continue
                if label:
                    picked = [a + int(value[a:b].argmax())]
                else:  # the most suspicious ones and some at random
                    order = a + np.argsort(-value[a:b])[: most // 3]
                    picked = [*order, *rng.integers(a, b, most - len(order))]
                rows.extend(picked)
                target.extend([label] * len(picked))
        rows, target = np.array(rows), np.array(target)
        weight = np.where(target == 1, (target == 0).sum() / max((target == 1).sum(), 1), 1.0)
        weight = np.minimum(weight, 4.0)
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 512):
            part = order[at : at + 512]
            bucket, where = data.take(rows[part])
            size = np.maximum(data.size[rows[part]], 1)[:, None]
            total = np.zeros((len(bucket) + 1, DIM))
            np.cumsum(embed[bucket], axis=0, out=total[1:])
            edges = np.append(0, np.cumsum(data.size[rows[part]]))
            mean = np.diff(total[edges], axis=0) / size
            raw = mean @ soft + bias
            raw -= raw.max(axis=1, keepdims=True)
            prob = np.exp(raw)
            prob /= prob.sum(axis=1, keepdims=True)
            prob[np.arange(len(part)), target[part]] -= 1.0
            prob *= weight[part][:, None] / len(part)
            into = (prob @ soft.T) / size
            order_in = np.argsort(bucket)
            sorted_ = bucket[order_in]
            first = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
            used = sorted_[first]
            grad = np.add.reduceat(into[where[order_in]], first, axis=0).astype(np.float32)
            caches[0][used] += grad**2
            embed[used] -= RATE * known[used][:, None] * grad / np.sqrt(caches[0][used])
            for param, cache, g in ((soft, caches[1], mean.T @ prob), (bias, caches[2], prob.sum(axis=0))):
                cache += g**2
                param -= 0.1 * RATE * g / np.sqrt(cache)
    return Model((embed @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Model from a bounded sample: rows of each class by hash order, sections of long texts.

    Of a text of more than ``SAMPLE_CHARS`` characters that many are taken, from a place
    that a hash decides, so long texts are learned from too.
    """
    known = labels.filter("toxic in (0, 1)").select("doc_id", "toxic")
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    bound = {1: TOXIC_ROWS, 0: CLEAN_ROWS}
    share = F.create_map(
        *(F.lit(x) for label, n in sizes.items() for x in (label, min(1.0, 1.5 * bound[label] / n)))
    )
    picked = known.withColumn("u", u).filter(F.col("u") < share[F.col("toxic")])
    beyond = F.length("text") - SAMPLE_CHARS
    place = F.when(beyond > 0, F.pmod(F.xxhash64("doc_id", F.lit(1)), beyond + 1) + 1).otherwise(F.lit(1))
    section = F.substring("text", place.cast("int"), F.lit(SAMPLE_CHARS))
    texts = docs.filter(F.length("text") > 0).select("doc_id", section.alias("text"))
    # the larger share applies to both classes: most texts stay where they are
    texts = texts.withColumn("u2", u).filter(F.col("u2") < max(min(1.0, 1.5 * bound[c] / n) for c, n in sizes.items()))
    rows = picked.join(texts, "doc_id").select("toxic", "u", "doc_id", "text")
    sample = []
    for label in (0, 1):
        sample += rows.filter(F.col("toxic") == label).orderBy("u", "doc_id").limit(bound[label]).collect()
    return fit([r["text"] for r in sample], np.array([r["toxic"] for r in sample])) if sample else None


def _score_map(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            got = [np.zeros(0)]
            for a, b in text_blocks(texts):
                got.append(model.score(texts[a:b]) if model else np.zeros(b - a))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(got))], names=["doc_id", "score"]
            )

    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    return docs.select("doc_id", "text").mapInArrow(_score_map(model), "doc_id long, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: toxicity score of every document, learned from three of four folds."""
    docs = read(spark, sf_dir, "documents")
    may = learnable("doc_id", FOLDS, HELD)
    model = train(docs.filter(may), read(spark, sf_dir, "labels").filter(may))
    return score(docs, model).select(
        "doc_id",
        held_out("doc_id", FOLDS, HELD).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
