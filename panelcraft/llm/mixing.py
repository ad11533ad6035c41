"""Mixing sources to target weights by repeating documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcraft.llm.common import meet_small, n_words, seeded_fraction

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 7


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` from ``source, size``: the words each source should give.

    Sources by code point, null last, weigh ``weights`` in turn. All of them together give as many words as there
    are. A target stops at ``most`` times its source's size; the excess is shared again by weight until none is
    above. Sorted by size per weight, the stopped sources are a prefix, so running sums find the level in one go. The
    windows run over one row per source, after the sums.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
    cap = F.col("source_size") * most
    ranked = per.withColumn("weight", weight).withColumn("level", cap / F.col("weight"))
    rising = Window.partitionBy().orderBy("level", F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(Window.partitionBy()) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    shared = ranked.withColumn("share", left / F.sum("weight").over(after))
    free = shared.withColumn("level_if_free", F.when(F.col("share") <= F.col("level"), F.col("share")))
    water = F.max("level_if_free").over(Window.partitionBy())
    return free.select("source", "source_size", F.least(F.col("weight") * water, cap.cast("double")).alias("target"))


def mixing_plan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: int = SEED
) -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies`` for each row of ``docs``, without its text.

    The rate of a source is target / size. A document is taken floor(rate) times, and once more where a number
    seeded by its key falls below the rest of the rate; so reruns and any partitioning agree.

    Null and empty texts have size 0 and are copied like the others. A null source is a source. A source without
    words has target 0 and rate 0. A null key is hashed as "null"; rows with equal keys share their number. An
    empty table gives an empty plan.
    """
    sizes = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), n_words(text).alias("size"))
    return _with_copies(sizes, sizes, "doc_id", "source", weights, most, seed)


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The mixed corpus: every row of ``docs`` with all its columns, ``copies`` times (none where that is 0).

    Cases as in ``mixing_plan``. The texts do not move while the table of rates, one row per source, is small
    enough to be sent to them.
    """
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("doc_id"), F.col(source).alias("source"))
    sizes = docs.select(F.col(source).alias("source"), n_words(text).alias("size"))
    known = _with_copies(whole, sizes, "doc_id", "source", weights, most, seed)
    again = F.when(F.col("copies") > 0, F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return known.select("row", F.explode(again).alias("nth")).select("row.*")


def _with_copies(rows: DataFrame, sizes: DataFrame, key: str, source: str, weights: Sequence[int], most: int, seed: int) -> DataFrame:
    """``rows`` with ``source_size, target, rate, copies``."""
    targets = source_targets(sizes, weights, most).withColumnRenamed("source", "of")
    known = meet_small(rows, targets, F.col(source).eqNullSafe(F.col("of")), "left").drop("of")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    extra = seeded_fraction(F.col(key), seed) < F.col("rate") - F.floor("rate")
    return known.withColumn("rate", rate).withColumn("copies", (F.floor("rate") + extra.cast("long")).cast("long"))
