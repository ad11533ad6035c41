"""Licence scans by diagonal voting, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Phrases and the labels they give; fixed values.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices and the labels they give; fixed values.
TEMPLATES = {
    "apache": "licensed under the apache license version 2 0",
    "apache-terms": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "mit": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software",
}
GRAM = 3
#: Diagonals at most so far apart are one place, with words put in or left out.
REACH = 2
#: A span is a notice when so many percent of the notice's k-grams are found in it.
COVERED = 60

_OTHER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def plain_words(text: str) -> Column:
    """Runs of letters, digits and characters beyond ASCII, A-Z in lower case; an empty array without text."""
    found = F.filter(F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), _OTHER), lambda w: w != "")
    return F.transform(found, lambda w: F.when(F.octet_length(w) == F.length(w), F.lower(w)).otherwise(w))


def _grams(ws: str) -> Column:
    """Hashes of all runs of ``GRAM`` words; null when there are fewer words."""
    at = F.sequence(F.lit(0), F.size(ws) - GRAM)
    return F.when(F.size(ws) >= GRAM, F.transform(at, lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(GRAM)])))


def _places(ws: str, phrase: str) -> Column:
    """Where the phrase's words stand one after the other."""
    parts = phrase.split(" ")
    at = F.sequence(F.lit(0), F.size(ws) - len(parts))

    def here(i: Column) -> Column:
        test = F.get(ws, i) == parts[0]
        for k, p in enumerate(parts[1:], 1):
            test = test & (F.get(ws, i + k) == p)
        return test

    none = F.array().cast("array<int>")
    return F.when((F.size(ws) >= len(parts)) & F.array_contains(ws, parts[-1]), F.filter(at, here)).otherwise(none)


def notice_spans(words: DataFrame, templates: Mapping[str, str] = TEMPLATES, reach: int = REACH, covered: int = COVERED) -> DataFrame:
    """``doc_id, content, label, first_word, last_word, share`` of the notices found in ``doc_id, content, ws``.

    Every k-gram of every document meets the template positions (a constant table of a few hundred rows, so it is
    broadcast). Hits vote for their diagonal, place in the text less place in the notice; diagonals of a document
    no further apart than ``reach`` are merged, and a merged span counts when its distinct k-grams cover the notice.
    """
    spark = words.sparkSession
    notices = spark.createDataFrame([(k, v.split(" ")) for k, v in templates.items()], "label string, ws array<string>")
    wanted = notices.select("label", F.greatest(F.size("ws") - GRAM + 1, F.lit(1)).alias("n_grams"), F.posexplode(_grams("ws")).alias("t", "gram"))
    grams = words.select("doc_id", "content", F.posexplode(_grams("ws")).alias("at", "gram"))
    hits = grams.join(F.broadcast(wanted), "gram")
    diagonal = hits.groupBy("doc_id", "content", "label", "n_grams", (F.col("at") - F.col("t")).alias("diagonal")).agg(
        F.collect_set("t").alias("ts"), F.min("at").alias("low"), F.max("at").alias("high")
    )
    by = Window.partitionBy("doc_id", "content", "label").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(by) > reach).cast("int"), F.lit(0))
    near = diagonal.withColumn("apart", apart).withColumn("place", F.sum("apart").over(by))
    spans = near.groupBy("doc_id", "content", "label", "n_grams", "place").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("ts")))).alias("votes"), F.min("low").alias("first_word"), (F.max("high") + GRAM - 1).alias("last_word")
    )
    share = F.col("votes") / F.col("n_grams")
    return spans.where(F.col("votes") * 100 >= F.col("n_grams") * covered).select("doc_id", "content", "label", "first_word", "last_word", share.alias("share"))


def scan_licences(docs: DataFrame, key: str = "doc_id", text: str = "text", phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``, one row per row of ``docs``.

    The base are the exact places of ``phrases``; ``labels`` adds those of the notices. The score is 1 with a base
    phrase, else the largest share of a notice that was found, else 0.

    Null and empty texts have no words, no labels and score 0. Rows are told apart by key and content, so rows with
    the same key but other texts are judged apart and wholly equal rows get equal results; null keys are allowed. An
    empty table gives an empty result. No text moves between tasks.
    """
    split = docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("content"), plain_words(text).alias("ws"))
    places = {label: f"p{i}" for i, label in enumerate(phrases.values())}
    based = split.select("doc_id", "content", F.size("ws").cast("long").alias("n_words"), *[_places("ws", p).alias(places[v]) for p, v in phrases.items()])
    at = F.concat(*places.values())
    base = based.select(
        "doc_id", "content", "n_words", F.size(at).cast("long").alias("n_base"), F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        F.array_compact(F.array(*[F.when(F.size(c) > 0, F.lit(v)) for v, c in places.items()])).alias("base"),
    )
    found = notice_spans(split, templates).groupBy("doc_id", "content").agg(F.collect_set("label").alias("more"), F.max("share").alias("best"))
    found = found.withColumnsRenamed({"doc_id": "__id", "content": "__content"})
    met = base.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("content") == F.col("__content")), "left")
    joined = lambda a: F.concat_ws(",", F.array_sort(F.array_distinct(a)))
    nothing = F.array().cast("array<string>")
    return met.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", joined(F.col("base")).alias("base_labels"),
        joined(F.concat("base", F.coalesce("more", nothing))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.least(F.coalesce("best", F.lit(0.0)), F.lit(1.0))).alias("score"),
    )
