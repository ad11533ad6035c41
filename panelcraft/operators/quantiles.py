"""Exact, linearly interpolated quantiles, on one path for any number of rows and groups.

A mergeable sketch per group and column encloses each wanted order statistic between two values whose ranks it bounds;
the sketches stay rows of a table. One exact pass then counts what lies below each enclosure and keeps the distinct
values inside, of which there are a small, fixed number; their running counts give the value at the wanted rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcraft.session import cut_lineage

#: Ranks of a sketch are right to ``rows / accuracy``. It grows with the rows beyond ``ACCURACY * INSIDE`` of them, so
#: that an enclosure holds 8 * ``INSIDE`` values at most. One task sorts an enclosure, so this bounds what it holds.
ACCURACY, INSIDE = 10_000, 100_000
#: Numbers in the limits of all groups up to which every task gets them.
SENT = 1 << 20


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), rows: int | None = None, accuracy: int = ACCURACY,
) -> DataFrame:
    """Tidy table ``by..., column, prob, value``: one row per group, column and probability.

    Missing and NaN values are left out; without any value the result is NULL. Missing group keys are a group.
    ``rows`` spares a count; ``accuracy`` is that of the sketch and never changes a result.
    """
    columns, probs, by = list(columns), [float(p) for p in probs], list(by)
    accuracy = max(accuracy, (df.count() if rows is None else rows) // INSIDE)
    numbers = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"__c{i}") for i, c in enumerate(columns)]
    cells = df.select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(by)], *numbers)
    groups = [f"__g{i}" for i in range(len(by))]
    limits = _limits(cells, groups, len(columns), probs, accuracy)
    # one row per group, of unknown size to Spark: few groups would bring the rows of each into one task
    on = [F.col(g).eqNullSafe(F.col(f"{g}l")) for g in groups]
    small = not by or limits.count() * len(columns) * (2 * len(probs) + 1) <= SENT
    sent = F.broadcast(limits) if small else limits
    met = cells.join(sent, on) if by else cells.crossJoin(sent)
    places = [(i, j, i * len(probs) + j) for i in range(len(columns)) for j in range(len(probs))]
    low, high = (lambda k: F.col("__low")[k]), (lambda k: F.col("__high")[k])
    below = met.groupBy("__id").agg(F.array(*[F.count_if(F.col(f"__c{i}") < low(k)) for i, _, k in places]).alias("__below"))
    inside = F.array(*[F.when(F.col(f"__c{i}").between(low(k), high(k)), F.struct(F.lit(k).alias("__k"), F.col(f"__c{i}").alias("__v"))) for i, _, k in places])
    counted = met.select("__id", F.inline(F.filter(inside, lambda x: x.isNotNull()))).groupBy("__id", "__k", "__v").count()
    # the wanted places of each enclosure, counted from its first value
    ranks = F.array(*[
        F.struct(F.lit(k).alias("__k"), F.lit(columns[i]).alias("column"), F.lit(probs[j]).alias("prob"), (F.col("__n")[i] - 1).alias("last"), F.col("__below")[k].alias("under"))
        for i, j, k in places
    ])
    wanted = limits.join(below.withColumnRenamed("__id", "__of"), F.col("__id") == F.col("__of"), "left").select("__id", *[f"{g}l" for g in groups], F.inline(ranks))
    place = F.col("prob") * F.col("last")
    wanted = wanted.withColumns({"share": place - F.floor(place), "first": F.floor(place) - F.col("under"), "second": F.ceil(place) - F.col("under")})
    run = Window.partitionBy("__id", "__k").orderBy("__v")
    upto = counted.withColumn("upto", F.sum("count").over(run)).select(F.col("__id").alias("__of"), F.col("__k").alias("__kk"), "__v", "upto")
    at = upto.join(wanted.select("__id", "__k", "first", "second"), (F.col("__of") == F.col("__id")) & (F.col("__kk") == F.col("__k")))
    picked = at.groupBy("__of", "__kk").agg(
        F.min(F.when(F.col("upto") > F.col("first"), F.col("__v"))).alias("a"), F.min(F.when(F.col("upto") > F.col("second"), F.col("__v"))).alias("b"),
        F.min("first").alias("from"),
    )
    found = wanted.join(picked, (F.col("__id") == F.col("__of")) & (F.col("__k") == F.col("__kk")), "left")
    lost = (F.col("last") >= 0) & (F.col("a").isNull() | F.col("b").isNull() | (F.col("from") < 0))
    value = F.when(lost, F.raise_error(F.lit("a quantile lies outside the bounds of its sketch")).cast("double")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * F.col("share"))
    return found.select(*[F.col(f"{g}l").alias(c) for g, c in zip(groups, by)], "column", "prob", value.alias("value"))


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float], **options) -> dict[str, dict[float, float | None]]:
    """Fitted scalars ``{column: {prob: value}}`` for use as literals in a later projection.

    The columns are kept while the passes over them run, so that what made ``df`` is worked out once.
    """
    out: dict[str, dict[float, float | None]] = {c: {float(p): None for p in probs} for c in columns}
    if columns:
        kept = df.select(*columns).persist()
        try:
            for row in quantiles(kept, columns, probs, **options).collect():
                out[row["column"]][row["prob"]] = row["value"]
        finally:
            kept.unpersist()
    return out


def _limits(cells: DataFrame, groups: list[str], width: int, probs: list[float], accuracy: int) -> DataFrame:
    """Per group: ``__id``, number of values per column, and by column and probability the ends of the enclosure.

    With n values, a wanted place lies within n p - 1 and n p + 1, and the sketch is right to n / accuracy. So the values
    at p -+ 3 / accuracy enclose it where n is ``accuracy`` at least. All values of smaller groups are inside.
    """
    margin = 3.0 / accuracy
    ends = [(max(0.0, p - margin), min(1.0, p + margin)) for p in probs]
    shares = F.array(*[F.lit(x) for pair in ends for x in pair])
    sketched = cells.groupBy(*groups).agg(
        F.array(*[F.count(f"__c{i}") for i in range(width)]).alias("__n"),
        F.array(*[F.percentile_approx(f"__c{i}", shares, accuracy) for i in range(width)]).alias("__q"),
    )

    def bound(i: int, j: int, upper: int) -> Column:
        far = F.lit(float("inf") if upper else float("-inf"))
        return far if ends[j][upper] in (0.0, 1.0) else F.when(F.col("__n")[i] < accuracy, far).otherwise(F.col("__q")[i][2 * j + upper])

    bounds = [F.array(*[bound(i, j, u) for i in range(width) for j in range(len(probs))]).alias(n) for u, n in ((0, "__low"), (1, "__high"))]
    found = sketched.select(*[F.col(g).alias(f"{g}l") for g in groups], F.monotonically_increasing_id().alias("__id"), "__n", *bounds)
    if groups:
        return cut_lineage(found)
    return cells.sparkSession.createDataFrame(found.collect(), found.schema)  # one row, as long as there are columns
