"""Corpus pipeline: quality rules, language, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
in the shared folder and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``.  An empty input passes through all stages.

SQL cannot express the language model, so there is no oracle SQL; the stages are tested
against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoppulse.llm import (
    best_fit_packing,
    grouped_prefix_join,
    kernel_langid,
    quality_rules,
    suffix_tree_dedup,
)
from shoppulse.llm.common import bounded_batches, discard, learnable, read, stored

# near copies: Jaccard similarity of SIMILAR_PERCENT per cent of the SHINGLE_WORDS-word shingles
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    return quality_rules.kept_documents(docs, quality_rules.CURRENT)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told (null text, no letter or no clear winner: rejected).

    Where no label can be learned from, every text with a letter stays.
    """
    bounded_batches(spark)
    may = learnable("doc_id", kernel_langid.FOLDS, kernel_langid.HELD)
    return kernel_langid.known_language(docs, kernel_langid.train(docs.filter(may)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar shingle sets."""
    return grouped_prefix_join.one_of_each(docs, SIMILAR_PERCENT, SHINGLE_WORDS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a smaller doc_id holds; n_chars follows the text."""
    cut = suffix_tree_dedup.cut_rows(docs)
    made = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed = F.col(suffix_tree_dedup.N_REMOVED) > 0
        size = F.when(changed, F.length("text").cast("long"))
        made["n_chars"] = F.coalesce(size, "row.n_chars")
    return cut.select(*(made.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences."""
    return best_fit_packing.pack_documents(spark, docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("language identification", language),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("best-fit packing", packing),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        if before is not None:
            discard(before)
        before = docs
    return docs
