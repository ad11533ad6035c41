"""Exploration across entities and dates: timelines, leader boards, coverage, overlap, correlation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcraft.functions.columns import numeric_columns
from panelcraft.functions.scalars import finite_or_null
from panelcraft.operators.clean import null_counts
from panelcraft.operators.moments import PairMoments, pair_moments
from panelcraft.operators.panel_windows import PanelKey, latest_per_entity, strict_rolling_mean

WIDE_PAIRS = 16


def daily_totals(df: DataFrame, columns: Sequence[str], date: str = "date") -> DataFrame:
    """Sum per date, a missing total counting as 0."""
    return df.where(F.col(date).isNotNull()).groupBy(date).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])


def timeline(daily: DataFrame, columns: Sequence[str], rows: int = 7, date: str = "date") -> DataFrame:
    """Strict moving averages over the per-date table, which has one row per calendar day."""
    window = Window.partitionBy().orderBy(date)
    features = [strict_rolling_mean(c, rows) for c in columns]
    return daily.select("*", *[f.build(window).alias(f.name) for f in features])


def top_rows(df: DataFrame, by: str, k: int, ties: Sequence[str]) -> DataFrame:
    """k largest; ties go to the smallest ``ties``. Plans as top-k per partition, then a merge."""
    return df.where(F.col(by).isNotNull()).orderBy(F.desc(by), *ties).limit(k)


def leader_board(df: DataFrame, key: PanelKey, measures: Sequence[str], by: str, k: int = 20) -> DataFrame:
    """Latest present values per entity, top ``k`` by one measure."""
    return top_rows(latest_per_entity(df, key, measures), by, k, [key.entity])


def rows_per_entity(df: DataFrame, entity: str) -> DataFrame:
    return df.where(F.col(entity).isNotNull()).groupBy(entity).agg(F.count(F.lit(1)).alias("n"))


def coverage(df: DataFrame, entity: str) -> DataFrame:
    """How many rows entities have: mean, median, extremes. Counts of counts keep the median small."""
    return rows_per_entity(df, entity).agg(
        F.count(F.lit(1)).alias("n_entities"), F.avg("n").alias("mean_rows"), F.median("n").alias("median_rows"),
        F.min("n").alias("min_rows"), F.max("n").alias("max_rows"),
    )


def distinct_entities(df: DataFrame, entity: str) -> DataFrame:
    return df.select(F.col(entity).alias("entity")).where(F.col(entity).isNotNull()).distinct()


def domain_overlap(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Common, left-only and right-only entities, and the share of the left side covered."""
    sides = [
        distinct_entities(df, k).select("entity", F.lit(i == 0).cast("int").alias("l"), F.lit(i == 1).cast("int").alias("r"))
        for i, (df, k) in enumerate(((left, left_key), (right, right_key)))
    ]
    flags = sides[0].unionByName(sides[1]).groupBy("entity").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    counted = flags.agg(
        F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("common"),
        F.count_if((F.col("l") == 1) & (F.col("r") == 0)).alias("left_only"),
        F.count_if((F.col("l") == 0) & (F.col("r") == 1)).alias("right_only"),
    )
    share = F.try_divide(F.col("common").cast("double"), F.col("common") + F.col("left_only")) * 100.0
    return counted.withColumn("coverage_pct", share)


def union_count(parts: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distinct entities over several tables."""
    entities = [distinct_entities(df, key) for df, key in parts.values()]
    return reduce(DataFrame.unionByName, entities).agg(F.count_distinct("entity").alias("n_entities"))


def entity_counts(parts: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distinct entities per table."""
    counted = [
        df.agg(F.count_distinct(key).alias("n_entities")).select(F.lit(name).alias("dataset"), "n_entities")
        for name, (df, key) in parts.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def correlation_columns(df: DataFrame, above: float = 0.3, limit: int | None = None) -> list[str]:
    """Numeric columns with more than ``above`` of their values present; the first ``limit`` of them if given."""
    numeric = df.select(*numeric_columns(df))
    counts = null_counts(numeric)
    rows = counts[""]
    return [c for c in numeric.columns if rows and 1 - counts[c] / rows > above][:limit]


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Upper triangle ``var1, var2, r`` over pairwise-complete rows: one pass for all pairs. NaN and infinities count as
    missing; r is NULL where a column has no spread."""
    pairs = list(combinations(list(columns), 2))
    if len(pairs) > WIDE_PAIRS:  # too many side by side would leave generated code
        return _triangle(df.sparkSession, pair_moments(df, columns))
    wide = df.agg(*[F.corr(finite_or_null(a), finite_or_null(b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.inline(F.array(*cells)))


def _triangle(spark: SparkSession, moments: PairMoments) -> DataFrame:
    r = moments.r()
    rows = [(a, b, _number(r[i, j])) for (i, a), (j, b) in combinations(enumerate(moments.columns), 2)]
    return spark.createDataFrame(rows, "var1 string, var2 string, r double")


def _number(x: float) -> float | None:
    return None if x != x else float(x)


def correlation_study(
    df: DataFrame, columns: Sequence[str], fits: Sequence[tuple[str, str]] = (), above: float = 0.7
) -> DataFrame:
    """The whole study from one set of moments: ``part, var1, var2, n, r, slope, intercept`` with part "matrix" for the
    full square and its unit diagonal, "strong" for pairs of an absolute r over ``above``, "fit" for the lines of var2
    over var1. Fits of columns that are not there are left out."""
    wanted = [(x, y) for x, y in fits if x in df.columns and y in df.columns]
    moments = pair_moments(df, list(dict.fromkeys([*columns, *(c for pair in wanted for c in pair)])))
    r, n, rows = moments.r(), moments.n, []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            value = 1.0 if i == j else _number(r[i, j])
            rows.append(("matrix", a, b, int(n[i, j]), value, None, None))
            if i < j and value is not None and abs(value) > above:
                rows.append(("strong", a, b, int(n[i, j]), value, None, None))
    for x, y in wanted:
        count, slope, intercept, value = moments.fit(x, y)
        rows.append(("fit", x, y, count, value, slope, intercept))
    schema = "part string, var1 string, var2 string, n long, r double, slope double, intercept double"
    return df.sparkSession.createDataFrame(rows, schema)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full square in long form, with the unit diagonal."""
    upper = correlations(df, columns)
    spark = df.sparkSession
    diagonal = spark.createDataFrame([(c, c, 1.0) for c in columns], upper.schema)
    return upper.unionByName(upper.select(F.col("var2").alias("var1"), F.col("var1").alias("var2"), "r")).unionByName(diagonal)


def strong_pairs(df: DataFrame, columns: Sequence[str], above: float = 0.7) -> DataFrame:
    return correlations(df, columns).where(F.abs("r") > above).orderBy(F.desc(F.abs("r")), "var1", "var2")


def score_correlations(df: DataFrame, score: str, columns: Sequence[str], k: int = 20) -> DataFrame:
    """Features most correlated with the score, by absolute value, keeping the sign."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(score).cast("double")).alias(f"r{i}") for i, c in enumerate(columns)])
    cells = [F.struct(F.lit(c).alias("feature"), F.col(f"r{i}").alias("r")) for i, c in enumerate(columns)]
    long = wide.select(F.inline(F.array(*cells))).where(F.col("r").isNotNull())
    return long.orderBy(F.desc(F.abs("r")), "feature").limit(k)


def linear_fits(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Least-squares line ``y = slope * x + intercept`` and r, per (x, y) pair of present columns."""
    usable = [(x, y) for x, y in pairs if x in df.columns and y in df.columns]
    if not usable:
        return df.sparkSession.createDataFrame([], "x string, y string, n long, slope double, intercept double, r double")
    aggs, cells = [], []
    for i, (x, y) in enumerate(usable):
        a, b = F.col(x).cast("double"), F.col(y).cast("double")
        aggs += [
            F.regr_count(b, a).alias(f"n{i}"), F.regr_slope(b, a).alias(f"s{i}"),
            F.regr_intercept(b, a).alias(f"i{i}"), F.corr(a, b).alias(f"r{i}"),
        ]
        cells.append(
            F.struct(
                F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"n{i}").alias("n"), F.col(f"s{i}").alias("slope"),
                F.col(f"i{i}").alias("intercept"), F.col(f"r{i}").alias("r"),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*cells)))
