"""Composite scores and the binned target."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcraft.functions.columns import find_column
from panelcraft.functions.scalars import capped_ratio, mean_of, right_closed_bins, unit_interval
from panelcraft.operators.quantiles import quantile_table

LEVELS = ("Low", "Medium", "High")
NEUTRAL_FACTOR = 0.5
NEUTRAL_CAPACITY = 50.0
CAP_PROBABILITY = 0.95


def beds_column(columns: Sequence[str]) -> str | None:
    return find_column(columns, ["beds"], required=False)


def level_of(score: Column | str, medium: float = 0.4, high: float = 0.7) -> Column:
    """Low up to ``medium``, Medium up to ``high``, High up to 1; each upper edge inside; else NULL."""
    return right_closed_bins(score, [0.0, medium, high, 1.0], LEVELS)


def level_rank(level: Column | str) -> Column:
    """0, 1, 2 for Low, Medium, High: the order is not alphabetic."""
    c = F.col(level) if isinstance(level, str) else level
    return F.when(c == "Low", 0).when(c == "Medium", 1).when(c == "High", 2)


@dataclass
class TargetBuilder:
    """Preparedness score and level, and healthcare capacity score."""

    medium: float = 0.4
    high: float = 0.7
    caps: dict[str, float | None] | None = None

    def fit(self, df: DataFrame) -> TargetBuilder:
        beds = beds_column(df.columns)
        wanted = [c for c in ("mortality_rate", beds, "gdp_per_capita") if c and c in df.columns]
        found = quantile_table(df, wanted, [CAP_PROBABILITY])
        self.caps = {c: q[CAP_PROBABILITY] for c, q in found.items()}
        return self

    def preparedness(self, columns: Sequence[str]) -> Column:
        beds = beds_column(columns)
        neutral = F.lit(NEUTRAL_FACTOR)
        vaccination = unit_interval("vaccination_rate") if "vaccination_rate" in columns else neutral
        mortality = neutral
        if "mortality_rate" in columns:
            share = capped_ratio("mortality_rate", self.caps.get("mortality_rate"), neutral=None)
            mortality = neutral if share is None else F.lit(1.0) - share
        capacity = capped_ratio(beds, self.caps.get(beds), NEUTRAL_FACTOR) if beds else neutral
        return mean_of(vaccination, mortality, capacity)

    def capacity(self, columns: Sequence[str]) -> Column:
        factors = []
        for name in (beds_column(columns), "gdp_per_capita"):
            if name and name in columns:
                factors.append(capped_ratio(name, self.caps.get(name), neutral=None))
        if "human_development_index" in columns:
            factors.append(unit_interval("human_development_index"))
        factors = [f for f in factors if f is not None]
        return mean_of(*factors) * F.lit(100.0) if factors else F.lit(NEUTRAL_CAPACITY)

    def transform(self, df: DataFrame) -> DataFrame:
        scored = df.withColumns(
            {"preparedness_score": self.preparedness(df.columns), "healthcare_capacity_score": self.capacity(df.columns)}
        )
        return scored.withColumn("preparedness_level", level_of("preparedness_score", self.medium, self.high))

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(classification rows, regression rows): those whose own target is present."""
        scored = self.transform(df)
        return (
            scored.where(F.col("preparedness_level").isNotNull()),
            scored.where(F.col("healthcare_capacity_score").isNotNull()),
        )


def create_targets(df: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    return TargetBuilder(**options).fit(df).split(df)
