"""Types of the raw columns that are known by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

# Column names of the raw tables that the operators know by name.
CASES_MEASURES = (
    "new_cases", "new_deaths", "total_cases", "total_deaths", "population", "population_density",
    "gdp_per_capita", "human_development_index", "hospital_beds_per_thousand", "life_expectancy",
    "new_tests", "icu_patients", "hosp_patients",
)
VACCINATION_MEASURES = ("total_vaccinations", "people_vaccinated", "people_fully_vaccinated")
RAW_TABLES = ("covid_daily", "vaccination_daily", "vaccination_by_age", "vaccination_by_manufacturer")


def _table(texts: Sequence[str], measures: Sequence[str]) -> T.StructType:
    fields = [T.StructField(n, T.StringType()) for n in texts]
    return T.StructType(fields + [T.StructField(n, T.DoubleType()) for n in measures])


CASES = _table(("country", "date", "code", "continent"), CASES_MEASURES)
VACCINATIONS = _table(("country", "date"), VACCINATION_MEASURES)
BY_AGE = _table(
    ("country", "date", "age_group"),
    ("people_vaccinated_per_hundred", "people_fully_vaccinated_per_hundred", "people_with_booster_per_hundred"),
)
BY_MANUFACTURER = _table(("country", "date", "vaccine"), ("total_vaccinations",))
SCHEMAS = dict(zip(RAW_TABLES, (CASES, VACCINATIONS, BY_AGE, BY_MANUFACTURER)))
