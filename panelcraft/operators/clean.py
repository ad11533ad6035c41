"""Cleaning as fit / transform: ``fit`` learns a few scalars in aggregate jobs, ``transform`` is lazy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.functions.columns import ColumnRoles, numeric_columns
from panelcraft.functions.scalars import clamp
from panelcraft.operators.panel_windows import MAX_ROWS, PanelKey, forward_fill
from panelcraft.operators.quantiles import quantile_table

SPARSE_THRESHOLD = 0.7
CLIP_FACTOR = 3.0


def null_counts(df: DataFrame) -> dict[str, int]:
    """``{"": rows, column: missing cells}`` from one aggregate over all columns."""
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    found = row.asDict()
    return {"": found.pop("__rows"), **found}


def sparse_columns(counts: Mapping[str, int], threshold: float = SPARSE_THRESHOLD, keep: Sequence[str] = ()) -> list[str]:
    """Columns whose missing share is strictly above ``threshold``, without those to keep."""
    rows = counts[""]
    return [c for c, n in counts.items() if c and c not in keep and rows and n / rows > threshold]


def drop_sparse_columns(df: DataFrame, threshold: float = SPARSE_THRESHOLD) -> DataFrame:
    return df.drop(*sparse_columns(null_counts(df), threshold))


def impute(df: DataFrame, values: Mapping[str, float | None]) -> DataFrame:
    """Fill missing cells of each column with its value; undefined values change nothing.

    A filled column becomes double so that an interpolated median is not truncated.
    """
    usable = {c: v for c, v in values.items() if v is not None and c in df.columns}
    if not usable:
        return df
    return df.select(
        *[
            F.coalesce(F.col(c).cast("double"), F.lit(float(usable[c]))).alias(c) if c in usable else F.col(c)
            for c in df.columns
        ]
    )


def zero_impute(df: DataFrame) -> DataFrame:
    targets = numeric_columns(df)
    return df.na.fill(0, subset=targets) if targets else df


def median_impute(df: DataFrame, columns: Sequence[str] | None = None, **options) -> DataFrame:
    """Fill with the column median (over all rows); a column without any value stays as it is."""
    names = numeric_columns(df) if columns is None else list(columns)
    return impute(df, {c: q[0.5] for c, q in quantile_table(df, names, [0.5], **options).items()})


def clip_bounds(quartiles: Mapping[str, Mapping[float, float | None]], factor: float = CLIP_FACTOR) -> dict[str, tuple[float, float]]:
    """``Q1 - factor * IQR`` and ``Q3 + factor * IQR`` for columns that have values."""
    bounds = {}
    for name, q in quartiles.items():
        if q[0.25] is not None and q[0.75] is not None:
            spread = (q[0.75] - q[0.25]) * factor
            bounds[name] = (q[0.25] - spread, q[0.75] + spread)
    return bounds


def clip(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.select(
        *[clamp(F.col(c).cast("double"), *bounds[c]).alias(c) if c in bounds else F.col(c) for c in df.columns]
    )


def iqr_clip(df: DataFrame, columns: Sequence[str], factor: float = CLIP_FACTOR, **options) -> DataFrame:
    return clip(df, clip_bounds(quantile_table(df, columns, [0.25, 0.75], **options), factor))


def iqr_outliers(df: DataFrame, columns: Sequence[str], factor: float = 1.5, **options) -> DataFrame:
    """Tidy count and share of values outside the whiskers; shares are of the present values."""
    bounds = clip_bounds(quantile_table(df, columns, [0.25, 0.75], **options), factor)
    aggs = []
    for i, (name, (low, high)) in enumerate(bounds.items()):
        outside = (F.col(name) < low) | (F.col(name) > high)
        aggs += [F.count(name).alias(f"n{i}"), F.count_if(outside).alias(f"o{i}")]
    wide = df.agg(*aggs)
    cells = [
        F.struct(
            F.lit(name).alias("column"), F.lit(low).alias("lower_bound"), F.lit(high).alias("upper_bound"),
            F.col(f"o{i}").alias("outliers"), (F.try_divide(F.col(f"o{i}"), F.col(f"n{i}")) * 100.0).alias("outlier_pct"),
        )
        for i, (name, (low, high)) in enumerate(bounds.items())
    ]
    return wide.select(F.inline(F.array(*cells)))


@dataclass
class Cleaner:
    """What one table needs: which steps run, and the scalars they were fitted to."""

    fill_group: str | None = None  # role whose columns are carried forward
    median_group: str | None = None  # role, or "numeric" for every numeric column
    clip_group: str | None = None
    zero_fill: bool = False
    key: PanelKey = field(default_factory=PanelKey)
    sparse_threshold: float = SPARSE_THRESHOLD
    keep: Sequence[str] = ()  # columns that later steps name: they stay however sparse they are
    clip_factor: float = CLIP_FACTOR
    max_rows: int = MAX_ROWS
    dropped: list[str] = field(default_factory=list)
    medians: dict[str, float | None] = field(default_factory=dict)
    bounds: dict[str, tuple[float, float]] = field(default_factory=dict)
    may_be_hot: bool = True

    def fit(self, df: DataFrame) -> Cleaner:
        counts = null_counts(df)
        rows = counts[""]
        self.may_be_hot = rows > self.max_rows
        self.dropped = sparse_columns(counts, self.sparse_threshold, self.keep)
        filled = self._carried(df.drop(*self.dropped))
        options = {"rows": rows}
        gappy = [c for c in self._group(filled, self.median_group) if counts[c]]
        clipped = self._group(filled, self.clip_group)
        if set(gappy) & set(clipped):  # quartiles of an imputed column depend on its median: two jobs
            self.medians = {c: q[0.5] for c, q in quantile_table(filled, gappy, [0.5], **options).items()}
            quartiles = quantile_table(impute(filled, self.medians), clipped, [0.25, 0.75], **options)
        else:
            wanted = [*gappy, *clipped]
            found = quantile_table(filled, wanted, [0.25, 0.5, 0.75], **options)
            self.medians = {c: found[c][0.5] for c in gappy}
            quartiles = {c: found[c] for c in clipped}
        self.bounds = clip_bounds(quartiles, self.clip_factor)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = self._carried(df.drop(*self.dropped))
        out = clip(impute(out, self.medians), self.bounds) if self.medians or self.bounds else out
        return zero_impute(out) if self.zero_fill else out

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def _carried(self, df: DataFrame) -> DataFrame:
        if self.fill_group is None or self.key.entity not in df.columns or self.key.date not in df.columns:
            return df
        return forward_fill(df, self.key, self._group(df, self.fill_group), max_rows=self.max_rows, check=self.may_be_hot)

    @staticmethod
    def _group(df: DataFrame, group: str | None) -> list[str]:
        if group is None:
            return []
        return numeric_columns(df) if group == "numeric" else list(getattr(ColumnRoles.resolve(df), group))


def cases_cleaner(**options) -> Cleaner:
    """Sparse columns out, measures carried forward, context columns to their median, extremes clipped."""
    return Cleaner(fill_group="epidemiological", median_group="socioeconomic", clip_group="outlier", **options)


def vaccinations_cleaner(**options) -> Cleaner:
    """Sparse columns out, cumulative doses carried forward, the rest 0."""
    return Cleaner(fill_group="vaccination", zero_fill=True, **options)


def by_age_cleaner(**options) -> Cleaner:
    return Cleaner(median_group="numeric", **options)


def by_manufacturer_cleaner(**options) -> Cleaner:
    return Cleaner(zero_fill=True, **options)
