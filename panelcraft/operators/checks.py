"""Validation of raw tables: key names, guards, date parsing, value clamps. Projections and filters only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.functions.columns import numeric_columns, require_columns, require_rows, standardize_columns
from panelcraft.functions.scalars import clamp, finite_or_null, parsed_date


def parse_dates(df: DataFrame, date: str = "date") -> DataFrame:
    """Turn ``date`` into a DATE and drop the rows where that fails."""
    return df.withColumn(date, parsed_date(date)).where(F.col(date).isNotNull())


def clamp_negatives(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Negative measures become 0; missing ones stay missing."""
    targets = set(numeric_columns(df) if columns is None else columns)
    return df.select(*[clamp(c, low=F.lit(0).cast(t)).alias(c) if c in targets else F.col(c) for c, t in df.dtypes])


def finite_measures(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN and infinities to NULL in floating columns (or the named ones)."""
    floating = {c for c, t in df.dtypes if t in ("double", "float")}
    targets = floating if columns is None else floating & set(columns)
    return df.select(*[finite_or_null(c).alias(c) if c in targets else F.col(c) for c in df.columns])


def numeric_only(df: DataFrame, exclude: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Keys in ``keep`` followed by the numeric columns that are not excluded."""
    return df.select(*keep, *numeric_columns(df, exclude=[*exclude, *keep]))


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def _validate(df: DataFrame, check_rows: bool) -> DataFrame:
    named = standardize_columns(df)
    require_columns(named, "location", "date")
    dated = parse_dates(named)
    return require_rows(dated, "the table or its part with valid dates") if check_rows else dated


def validate_cases(df: DataFrame, check_rows: bool = True) -> DataFrame:
    """Daily case table: standard keys, both present, parsable dates, at least one row left."""
    return _validate(df, check_rows)


def validate_vaccinations(df: DataFrame, check_rows: bool = True) -> DataFrame:
    """Daily vaccination table: as for cases, and no negative measure."""
    return clamp_negatives(_validate(df, check_rows))


def validate_by_age(df: DataFrame, check_rows: bool = True) -> DataFrame:
    """Age-group table; the date is parsed where it exists."""
    return _validate_side(df, check_rows)


def validate_by_manufacturer(df: DataFrame, check_rows: bool = True) -> DataFrame:
    """Manufacturer table; the date is parsed where it exists."""
    return _validate_side(df, check_rows)


def _validate_side(df: DataFrame, check_rows: bool) -> DataFrame:
    named = require_rows(standardize_columns(df)) if check_rows else standardize_columns(df)
    return parse_dates(named) if "date" in named.columns else named
