"""Engineered panel features: rates, rolling windows, lags, calendar, accelerations, interactions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date as Date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.functions.scalars import calendar_fields, per_million, ratio, zero_to_null
from panelcraft.operators.panel_windows import MAX_ROWS, PanelKey, expand_features, with_row_features

ROLLING_ROWS = (7, 14, 30)
LAG_ROWS = (7, 14, 30)
FLOW_COLUMNS = ("new_cases", "new_deaths")


def _replace(df: DataFrame, new: dict) -> DataFrame:
    kept = [F.col(c) for c in df.columns if c not in new]
    return df.select(*kept, *[expr.alias(name) for name, expr in new.items()])


def with_rates(df: DataFrame) -> DataFrame:
    """Cases per million, mortality, vaccination and full vaccination rates, where their columns exist."""
    have = set(df.columns)
    new = {}
    if {"total_cases", "population"} <= have:
        new["cases_per_million"] = per_million("total_cases", "population")
    if {"total_deaths", "total_cases"} <= have:
        new["mortality_rate"] = ratio("total_deaths", zero_to_null("total_cases"))
    if {"total_vaccinations", "population"} <= have:
        new["vaccination_rate"] = ratio("total_vaccinations", "population")
    if {"people_fully_vaccinated", "population"} <= have:
        new["full_vaccination_rate"] = ratio("people_fully_vaccinated", "population")
    return _replace(df, new)


def first_date(df: DataFrame, date: str = "date") -> Date | None:
    return df.agg(F.min(date)).first()[0]


def with_calendar(df: DataFrame, start: Date | None, date: str = "date") -> DataFrame:
    new = calendar_fields(date)
    new["days_since_start"] = F.datediff(F.col(date), F.lit(start).cast("date"))
    return _replace(df, new)


def with_interactions(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    new = {}
    if {"vaccination_rate", "population_density"} <= have:
        new["vac_density_interaction"] = F.col("vaccination_rate") * F.col("population_density")
    if {"cases_per_million", "population_density"} <= have:
        new["cases_density_interaction"] = F.col("cases_per_million") * F.col("population_density")
    return _replace(df, new)


@dataclass
class FeatureBuilder:
    """All engineered features; the only fitted value is the first date of the panel."""

    key: PanelKey = PanelKey()
    flows: Sequence[str] = FLOW_COLUMNS
    rolling_rows: Sequence[int] = ROLLING_ROWS
    lag_rows: Sequence[int] = LAG_ROWS
    max_rows: int = MAX_ROWS
    start: Date | None = None
    may_be_hot: bool = True

    def fit(self, df: DataFrame) -> FeatureBuilder:
        self.start, rows = df.agg(F.min(self.key.date), F.count(F.lit(1))).first()
        self.may_be_hot = rows > self.max_rows
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        features = expand_features(self.flows, df.columns, self.rolling_rows, self.lag_rows)
        out = with_row_features(with_rates(df), self.key, features, max_rows=self.max_rows, check=self.may_be_hot)
        return with_interactions(with_calendar(out, self.start, self.key.date))

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)
