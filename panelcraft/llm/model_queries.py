"""Queries that SQL cannot express; their tests compare them with brute force, round trips or held-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcraft.llm import transducer
from panelcraft.llm.alignment import align
from panelcraft.llm.base_queries import documents
from panelcraft.llm.bytes_dedup import remove_repeated_bytes
from panelcraft.llm.classifier import classify, fit_classifier, fold
from panelcraft.llm.jaccard import join_similar
from panelcraft.llm.pieces import decode, encode, load_model
from panelcraft.llm.vectors import link_embeddings
from panelcraft.llm.words_dedup import remove_repeated_words

KEEP_FROM = 0.3


def op2_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return link_embeddings(spark.read.parquet(f"{folder}/embeddings.parquet"))


def _removed(spans: str) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["after"] - s["first"])


def op3_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """Digest of what is left of each document without byte strings that occur elsewhere."""
    found = remove_repeated_bytes(documents(spark, folder))
    return found.select("doc_id", "n_bytes", _removed("spans").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return join_similar(documents(spark, folder))


def op7_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Digest of what is left of each document without word passages that occur elsewhere."""
    found = remove_repeated_words(documents(spark, folder))
    return found.select("row.doc_id", "n_words", _removed("spans").alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of each document by a model that never saw the labels of fold 0."""
    docs = documents(spark, folder)
    scored = classify(docs, *fit_classifier(docs, spark.read.parquet(f"{folder}/labels.parquet")))
    return scored.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))


def coded(docs: DataFrame) -> DataFrame:
    """``docs`` with ``ids, n_pieces`` and ``same``, whether decoding gives the text back."""
    model = load_model()
    found = encode(docs, "text", model)
    return found.withColumns({"n_pieces": F.size("ids").cast("long"), "same": decode("ids", model).eqNullSafe(F.col("text"))})


def op9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return coded(documents(spark, folder)).select("doc_id", "n_pieces", "ids", "same")


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """How the tokens of two tokenizers correspond in each document; its groups as a digest."""
    found = align(documents(spark, folder))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


def op13_word_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids of each document and of the text that they decode to."""
    found = transducer.code(documents(spark, folder))
    n = (F.length("ids") / 4).cast("long")
    return found.select("doc_id", n.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES = {
    "op2_embeddings": op2_embeddings, "op3_substrings": op3_substrings, "op4_jaccard": op4_jaccard, "op7_passages": op7_passages, "op8_quality": op8_quality,
    "op9_pieces": op9_pieces, "op11_alignment": op11_alignment, "op13_word_bpe": op13_word_bpe,
}
ORACLES: dict[str, str] = {}
