"""Documents to training pieces: quality, near-duplicates, repeated passages, mixture, pieces.

Every stage takes and returns the columns of ``documents``; the last one adds its pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcraft.llm.classifier import classify, fit_classifier
from panelcraft.llm.common import meet_small
from panelcraft.llm.jaccard import join_similar
from panelcraft.llm.mixing import mix
from panelcraft.llm.model_queries import KEEP_FROM, coded
from panelcraft.llm.words_dedup import remove_repeated_words
from panelcraft.session import scratch_folder


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is high enough. Null and empty texts are scored like any others."""
    scored = classify(docs, *fit_classifier(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), name="__score")
    return scored.where(F.col("__score") >= KEEP_FROM).drop("__score")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest key of each near-duplicate group. Rows without a key, or without words, are
    alone in their group; rows that repeat a key stay or go together."""
    gone = join_similar(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return meet_small(docs, gone, F.col("doc_id") == F.col("__gone"), "left_anti")


def new_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that occur elsewhere, and their new lengths. No document goes; one may become empty."""
    left = remove_repeated_words(docs, spaced=True)
    text = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return left.select(*[text.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for."""
    return mix(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece ids, and whether the ids give the text back."""
    return coded(docs)


STAGES = [
    ("quality_classifier", good_documents), ("ngram_jaccard_join", one_of_each_group), ("substring_dedup", new_passages),
    ("source_mixing", mixture), ("sentencepiece", pieces),
]
#: Training, similarity joins and merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            folder = scratch_folder(spark, name)
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
