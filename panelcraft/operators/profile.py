"""Data-quality profiles: missing cells, distributions, duplicates, histograms, quality scores.

Whole-table statistics come from one aggregate over all columns, then turn into tidy rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcraft.functions.columns import columns_matching, numeric_columns
from panelcraft.functions.scalars import (
    imbalance_band, missing_band, null_severity, quality_score, quality_status, right_closed_bins,
)
from panelcraft.operators.quantiles import quantile_table

KEY_MEASURE_KEYWORDS = ("cases", "deaths", "tests", "positive", "hospitalized", "icu", "vaccin")


def _percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100.0


def null_table(df: DataFrame) -> DataFrame:
    """Per column in schema order: type, rows, missing cells. One pass, one row unfolded."""
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(f"__{i}") for i, c in enumerate(df.columns)])
    cells = [
        F.struct(
            F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit(t).alias("dtype"),
            F.col("__n").alias("n_rows"), F.col(f"__{i}").alias("nulls"),
        )
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return wide.select(F.inline(F.array(*cells)))


def null_ratios(df: DataFrame) -> DataFrame:
    return null_table(df).select("column_name", F.try_divide(F.col("nulls"), F.col("n_rows")).alias("null_ratio"))


def null_profile(df: DataFrame) -> DataFrame:
    """Columns that have gaps: count, percentage (2 decimals), type and severity, worst first."""
    share = F.round(_percent(F.col("nulls"), F.col("n_rows")), 2)
    table = null_table(df).where(F.col("nulls") > 0)
    return table.select(
        "column_name", "dtype", "nulls", share.alias("null_pct"), null_severity(share).alias("severity")
    ).orderBy(F.desc("nulls"), "position")


def null_totals(df: DataFrame) -> DataFrame:
    """One row: cells, missing cells, their share, and columns per severity."""
    share = F.round(_percent(F.col("nulls"), F.col("n_rows")), 2)
    table = null_table(df).withColumn("band", F.when(F.col("nulls") > 0, null_severity(share)))
    bands = [F.count_if(F.col("band") == b).alias(b) for b in ("critical", "high", "medium", "low")]
    return table.agg(F.sum("n_rows").alias("cells"), F.sum("nulls").alias("null_cells"), *bands).withColumn(
        "null_pct", _percent(F.col("null_cells"), F.col("cells"))
    )


def completeness(df: DataFrame, keywords: Iterable[str] = KEY_MEASURE_KEYWORDS, above: float = 0.3) -> DataFrame:
    """Share of present values of the key measures; those at or below ``above`` are left out."""
    chosen = df.select(*columns_matching(df, keywords))
    present = F.col("n_rows") - F.col("nulls")
    share = F.try_divide(present, F.col("n_rows"))
    return null_table(chosen).where(share > above).select(
        "column_name", present.alias("present"), (share * 100.0).alias("complete_pct")
    )


def overview(df: DataFrame, entity: str, date: str) -> DataFrame:
    """Rows, columns, first and last date, number of entities."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_cols"),
        F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.count_distinct(entity).alias("n_entities"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage per present value; rows without a value stay in the denominator."""
    grouped = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("__total"))  # one row
    return grouped.crossJoin(total).select(column, "n", _percent(F.col("n"), F.col("__total")).alias("pct"))


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), column).limit(k)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Tidy count, mean, sample std, min, quartiles, max and coefficient of variation (%)."""
    columns = list(columns)
    q = quantile_table(df, columns, [0.25, 0.5, 0.75])
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
            F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
        ]
    cells = []
    for i, c in enumerate(columns):
        mean, std = F.col(f"m{i}"), F.col(f"s{i}")
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"), mean.alias("mean"), std.alias("std"),
                F.col(f"lo{i}").alias("min"),
                *[F.lit(q[c][p]).cast("double").alias(name) for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))],
                F.col(f"hi{i}").alias("max"),
                F.when(mean != 0, std / F.when(mean != 0, mean) * 100.0).otherwise(0.0).alias("cv_pct"),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows, rows equal to an earlier one over all columns (missing equals missing), and their share.

    Grouping by every column combines on the map side, so a heavily repeated row is no hot key.
    """
    grouped = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return grouped.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicates"),
    ).withColumn("duplicate_pct", F.coalesce(_percent(F.col("duplicates"), F.col("n_rows")), F.lit(0.0)))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins from min to max; the last one holds the maximum. Empty bins appear with 0."""
    value = F.col(column).cast("double")
    low, high = df.agg(F.min(value), F.max(value)).first()
    schema = "bin int, bin_start double, bin_end double, n long"
    if low is None:
        return df.sparkSession.createDataFrame([], schema)
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    slot = F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counted = df.where(value.isNotNull()).groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(counted, "bin", "left").select(
        "bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_start"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"), F.coalesce("n", F.lit(0)).alias("n"),
    )


def imbalance(df: DataFrame, column: str) -> DataFrame:
    """Largest and smallest class share, their ratio, and its band."""
    counted = value_counts(df, column)
    row = counted.agg(
        F.max_by(column, F.struct("n", column)).alias("majority"), F.max("pct").alias("majority_pct"),
        F.min_by(column, F.struct("n", column)).alias("minority"), F.min("pct").alias("minority_pct"),
    )
    ratio = F.try_divide(F.col("majority_pct"), F.col("minority_pct"))
    return row.withColumn("ratio", ratio).withColumn("balance", imbalance_band("ratio"))


def quartile_bins(df: DataFrame, column: str, labels: Sequence[str] = ("Q1", "Q2", "Q3", "Q4")) -> DataFrame:
    """Rows per quartile bin (right-closed, minimum included) and their share of the present values."""
    q = quantile_table(df, [column], [0.0, 0.25, 0.5, 0.75, 1.0])[column]
    edges = [q[p] for p in (0.0, 0.25, 0.5, 0.75, 1.0)]
    if edges[0] is None:
        return df.sparkSession.createDataFrame([], "bin string, n long, pct double")
    binned = df.where(F.col(column).isNotNull()).select(right_closed_bins(F.col(column).cast("double"), edges, labels).alias("bin"))
    return value_counts(binned, "bin")


def cleaning_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: columns and rows removed, missing cells removed, mean missing percentage before and after."""

    def totals(df: DataFrame, tag: str) -> DataFrame:
        share = _percent(F.col("nulls"), F.col("n_rows"))
        return null_table(df).agg(
            F.max("n_rows").alias(f"rows_{tag}"), F.count(F.lit(1)).alias(f"cols_{tag}"),
            F.sum("nulls").alias(f"nulls_{tag}"), F.avg(share).alias(f"mean_null_pct_{tag}"),
        )

    both = totals(before, "before").crossJoin(totals(after, "after"))  # one row each
    return both.select(
        "rows_before", "rows_after", (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
        "cols_before", "cols_after", (F.col("cols_before") - F.col("cols_after")).alias("cols_removed"),
        "nulls_before", "nulls_after", (F.col("nulls_before") - F.col("nulls_after")).alias("nulls_removed"),
        "mean_null_pct_before", "mean_null_pct_after",
        (F.col("mean_null_pct_before") - F.col("mean_null_pct_after")).alias("mean_null_pct_drop"),
    )


def type_composition(df: DataFrame) -> dict[str, int]:
    numeric = len(numeric_columns(df))
    dated = sum(isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)) for f in df.schema)
    text = sum(isinstance(f.dataType, T.StringType) for f in df.schema)
    return {"numeric_columns": numeric, "text_columns": text, "date_columns": dated}


def quality_report(df: DataFrame) -> DataFrame:
    """One row: size, missing share with band, duplicate share, column types, quality score and status."""
    totals = null_totals(df).select("null_cells", "null_pct")
    joined = totals.crossJoin(duplicate_rows(df))  # one row each
    composition = [F.lit(n).cast("long").alias(name) for name, n in type_composition(df).items()]
    scored = joined.select(
        "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols"), "null_cells", "null_pct",
        missing_band("null_pct").alias("null_band"), "duplicates", "duplicate_pct", *composition,
        quality_score("null_pct", "duplicate_pct").alias("score"),
    )
    return scored.withColumn("status", quality_status("score"))


def target_summary(df: DataFrame, target: str) -> DataFrame:
    """Class shares of a text target, or the description of a numeric one."""
    return describe(df, [target]) if target in numeric_columns(df) else value_counts(df, target)


def normality(df: DataFrame, column: str, alpha: float = 0.05) -> DataFrame:
    """Kolmogorov-Smirnov distance to the normal law fitted by mean and sample std."""
    values = df.select(F.col(column).cast("double").alias(column)).na.drop()
    mean, std = values.agg(F.avg(column), F.stddev_samp(column)).first()
    if not std:
        return df.sparkSession.createDataFrame([], "p_value double, statistic double, normal boolean")
    found = KolmogorovSmirnovTest.test(values, column, "norm", float(mean), float(std))
    return found.select(
        F.col("pValue").alias("p_value"), "statistic", (F.col("pValue") > alpha).alias("normal")
    )
