"""Decisions taken from column names and types only: no job runs here."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Keyword groups that must equal the established column roles.
ENTITY_KEYWORDS = ("country", "location", "nation", "region", "pais")
DATE_KEYWORDS = ("date", "fecha", "time")
EPIDEMIOLOGICAL_KEYWORDS = (
    "cases", "deaths", "tests", "positive", "hospitalized", "icu",
    "hosp_patients", "weekly_hosp", "weekly_icu", "stringency", "reproduction",
)
SOCIOECONOMIC_KEYWORDS = (
    "gdp", "population", "density", "aged", "hospital_beds", "life_expectancy",
    "median_age", "diabetes", "handwashing", "human_development", "extreme_poverty",
)
OUTLIER_KEYWORDS = ("new_cases", "new_deaths")
VACCINATION_KEYWORDS = ("vaccination", "vaccinated", "dose", "booster")

# Order in which a regression target is looked for.
TARGET_PREFERENCE = (
    "days_to_70_percent_coverage",
    "healthcare_capacity_score",
    "preparedness_score",
    "people_vaccinated_per_hundred",
    "people_fully_vaccinated_per_hundred",
    "total_vaccinations_per_hundred",
    "vaccination_rate",
    "total_cases_per_million",
    "total_deaths_per_million",
    "response_effectiveness_score",
)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of numeric columns in schema order; booleans are not numeric."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def find_column(names: Sequence[str], keywords: Iterable[str], required: bool = True) -> str | None:
    """First name (in the given order) that contains any keyword, ignoring case."""
    wanted = [k.lower() for k in keywords]
    hit = next((n for n in names if any(k in n.lower() for k in wanted)), None)
    if hit is None and required:
        raise ValueError(f"no column matches {wanted}; available: {list(names)}")
    return hit


def standard_names(names: Sequence[str]) -> dict[str, str]:
    """Renames that bring the panel keys to ``location`` and ``date``."""
    renames: dict[str, str] = {}
    if "location" not in names:
        source = "country" if "country" in names else find_column(names, ENTITY_KEYWORDS, required=False)
        if source:
            renames[source] = "location"
    if "date" not in names:
        source = find_column(names, DATE_KEYWORDS, required=False)
        if source:
            renames[source] = "date"
    return renames


def standardize_columns(df: DataFrame) -> DataFrame:
    renames = standard_names(df.columns)
    return df.withColumnsRenamed(renames) if renames else df


def columns_matching(df: DataFrame, keywords: Iterable[str], numeric_only: bool = True) -> list[str]:
    """Columns whose lower-cased name contains any keyword (substring match)."""
    pool = numeric_columns(df) if numeric_only else df.columns
    wanted = list(keywords)
    return [c for c in pool if any(k in c.lower() for k in wanted)]


@dataclass(frozen=True)
class ColumnRoles:
    """Keyword groups of one schema. A column may sit in several groups."""

    epidemiological: tuple[str, ...]
    socioeconomic: tuple[str, ...]
    outlier: tuple[str, ...]
    vaccination: tuple[str, ...]

    @classmethod
    def resolve(cls, df: DataFrame) -> ColumnRoles:
        return cls(
            tuple(columns_matching(df, EPIDEMIOLOGICAL_KEYWORDS)),
            tuple(columns_matching(df, SOCIOECONOMIC_KEYWORDS)),
            tuple(columns_matching(df, OUTLIER_KEYWORDS)),
            tuple(columns_matching(df, VACCINATION_KEYWORDS)),
        )


def pick_target(df: DataFrame, preference: Sequence[str] = TARGET_PREFERENCE) -> str:
    """First preferred column that exists, otherwise the first numeric column."""
    present = set(df.columns)
    for name in preference:
        if name in present:
            return name
    numeric = numeric_columns(df)
    if not numeric:
        raise ValueError("no numeric column can serve as a target")
    return numeric[0]


def added_columns_by_category(
    before: Sequence[str], after: Sequence[str], categories: Mapping[str, Sequence[str]], other: str = "other"
) -> dict[str, list[str]]:
    """Columns present only in ``after``, filed under the first category whose keyword they contain."""
    known = set(before)
    filed: dict[str, list[str]] = {name: [] for name in (*categories, other)}
    for column in (c for c in after if c not in known):
        home = next((n for n, keys in categories.items() if any(k in column.lower() for k in keys)), other)
        filed[home].append(column)
    return filed


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}; available: {df.columns}")


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df
