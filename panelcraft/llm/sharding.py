"""Shards that all carry the mixture of the whole: proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcraft.operators.integrate import with_row_index

SEED = 20


def interleave(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", shards: int = 24, seed: int = SEED) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``, one row per row of ``docs``.

    Rows are shuffled by a seeded hash inside their source; the i-th of n rows of a source gets the fractional
    rank (i + 1/2) / n; all rows are sorted by it and the sequence is cut into ``shards`` runs whose lengths differ
    by one at most (the law is ``rows``). So every shard holds each source in proportion.

    A source, however large, is never one task's: both ranks come from range-partitioned sorts whose positions are
    shifted by the counts before them. Only keys, sizes and hashes move, no texts.

    Null and empty texts have size 8 and checksum 0. A null source is a stratum of its own; a null key is hashed as
    "null". Rows with equal keys, and wholly equal rows, each get a slot. An empty table gives an empty result. Only
    ``key``, ``text`` and ``source`` are read; columns of other names do not matter.
    """
    raw = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"), (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw.cast("binary")).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("stratum"),
        F.md5(F.concat_ws("-", F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(str(seed)))).alias("shuffle"),
    )
    tie = ["shuffle", "doc_id", "size", "text_crc32"]
    placed = with_row_index(rows, ["stratum", *tie], "at")
    strata = placed.groupBy("stratum").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    ranked = placed.join(strata, "stratum").withColumn("rank", (F.col("at") - F.col("first") + 0.5) / F.col("rows"))
    line = with_row_index(ranked.select("doc_id", "size", "text_crc32", "stratum", "shuffle", "rank"), ["rank", *tie, "stratum"], "place")
    total = F.lit(placed.count())
    shard = _whole(F.col("place") * shards, total)
    first = _whole(F.col("shard") * total + (shards - 1), F.lit(shards))
    return line.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("place") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.when(F.col("stratum") != "", F.substr("stratum", F.lit(2))).alias("source"),
    )


def _whole(a: Column, b: Column) -> Column:
    """Integer division of numbers that are not negative."""
    return F.call_function("div", a, b)
