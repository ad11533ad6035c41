"""Quality rules as a short-circuit cascade, with DataFrame functions only."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.common import words

SAMPLE_ROWS = 500
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A document fails where ``fails`` is true; ``fails`` reads the columns of ``measures``."""

    name: str
    fails: Column


def _share(part: str, whole: str, percent: int) -> Column:
    return F.col(part) * 100 > F.col(whole) * percent


def default_rules() -> list[Rule]:
    """Whole-number rules, so any SQL engine decides alike. They look for shapes that prose never has."""
    shouted = F.size(F.filter("__words", lambda w: (F.length(w) >= 4) & (F.upper(w) == w) & (F.lower(w) != w)))
    letterless = F.size(F.filter("__words", lambda w: F.lower(w) == F.upper(w)))
    return [
        Rule("symbols", _share("n_symbols", "n_words", 30)),
        Rule("duplicate_lines", _share("n_dup_lines", "n_lines", 30)),
        Rule("word_length", (F.col("word_chars") > F.col("n_words") * 20) | (F.col("word_chars") < F.col("n_words") * 2)),
        Rule("shouting", shouted * 100 > F.col("n_words") * 50),
        Rule("letters", letterless * 100 > F.col("n_words") * 40),
        Rule("exclamations", (F.length("__text") - F.length(F.replace("__text", F.lit("!"), F.lit("")))) * 100 > F.col("n_words") * 100),
    ]


def _repeated_words(hashes: Column) -> Column:
    """Words inside windows that occur twice or more, from the windows' hashes in text order.

    Sorted (hash, place) pairs bring equal windows together; the places found, again in order, each cover the
    words up to the next place, five at most.
    """
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda p, x, j: F.get(p, j)["h"].eqNullSafe(x["h"])
    found = lambda p: F.array_sort(F.transform(F.filter(p, lambda x, j: same(p, x, j - 1) | same(p, x, j + 1)), lambda x: x["i"]))
    covered = lambda at: F.aggregate(
        at, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"), i.alias("last")), lambda s: s["n"],
    )
    # ``transform`` over a one-element array binds a value once, so that it is not worked out at every use
    once = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    return once(pairs, lambda p: once(found(p), covered))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words`` and the helper columns
    ``__text``, ``__words`` that rules may read."""
    raw = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.transform(F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: F.xxhash64(x))
    split = docs.withColumn("__text", raw).withColumn("__words", words("__text")).withColumn("__lines", lines)
    hashed = split.withColumn("__h", F.transform("__words", lambda w: F.xxhash64(w)))
    at = F.sequence(F.lit(0), F.size("__h") - WINDOW)
    grams = F.when(F.size("__h") >= WINDOW, F.transform(at, lambda i: F.xxhash64(*[F.get("__h", i + k) for k in range(WINDOW)])))
    rolled = hashed.withColumn("__grams", grams)
    repeats = F.when(F.size(F.array_distinct("__grams")) < F.size("__grams"), _repeated_words(F.col("__grams"))).otherwise(F.lit(0))
    return rolled.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.aggregate("__words", F.lit(0).cast("long"), lambda t, w: t + F.length(w)),
            "n_symbols": F.length(F.regexp_replace("__text", r"[^#*$%&|<>]+", "")).cast("long"),
            "n_lines": F.size("__lines").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": repeats.cast("long"),
        }
    ).drop("__h", "__grams", "__lines")


def ordered_rules(docs: DataFrame, rules: Sequence[Rule], text: str = "text", rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by falling rejection per cost, both measured on up to ``rows`` rows.

    The order decides how much work is done, never the verdict: a document is kept when no rule fails it.
    """
    sample = measures(docs.limit(rows), text).persist()
    try:
        counts = sample.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(r.fails).alias(f"r{i}") for i, r in enumerate(rules)]).first()
        if not counts["n"]:
            return list(rules)
        worth = []
        for i, rule in enumerate(rules):
            start = time.perf_counter()
            sample.agg(F.count_if(rule.fails)).collect()
            worth.append((counts[f"r{i}"] / counts["n"] / max(time.perf_counter() - start, 1e-4), -i))
    finally:
        sample.unpersist()
    return [rules[-i] for _, i in sorted(worth, reverse=True)]


def cascade(rules: Sequence[Rule]) -> Column:
    """Name of the first rule that fails a document, null when none does; later rules are then not worked out."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.fails, F.lit(rule.name)).otherwise(verdict)
    return verdict


def quality_rules(docs: DataFrame, text: str = "text", rules: Sequence[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with the measures, ``base_failed`` (under 10 words, or over 20 % of them in repeated windows of five)
    and ``kept`` (not failed by the base or by any rule).

    Each row is judged on its own whole text; nothing moves between tasks. Null and empty texts have no words and
    fail. Ties and repeated rows are judged alike. An empty table gives an empty result. Columns of the input that
    bear the name of a result are replaced.
    """
    rules = default_rules() if rules is None else rules
    ordered = ordered_rules(docs, rules, text, sample_rows)
    base = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    judged = measures(docs, text).withColumn("base_failed", base)
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(ordered).isNull())
    return judged.withColumn("kept", kept).drop("__text", "__words")
