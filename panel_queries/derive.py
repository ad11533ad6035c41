"""Integration, engineered features and targets on panels built from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panel_queries.base import EVENT_PANEL_SQL, event_panel, query, r, text_date
from panelcraft.functions import scalars as sc
from panelcraft.operators import features, targets
from panelcraft.plans import stages
from panelcraft.session import scratch_folder, side_by_side
from panelcraft.sources import sinks

# ------------------------------------------------------------------------------------ the four raw tables

CASES_SQL = """
SELECT n_name AS country, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date,
       COUNT(*)::DOUBLE AS new_cases, NULLIF(COUNT(*) FILTER (o_orderstatus <> 'P'), 0)::DOUBLE AS new_deaths,
       ROUND(SUM(o_totalprice), 2) / 1000 AS total_cases, ROUND(SUM(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END), 2) / 1000 AS total_deaths,
       MAX(c_custkey)::DOUBLE AS population, MIN(c_acctbal) AS population_density,
       CASE WHEN MIN(c_acctbal) > 0 THEN MAX(c_acctbal) END AS gdp_per_capita,
       ROUND(MAX(o_totalprice) / 400000, 4) AS human_development_index,
       MAX(c_nationkey + 1)::DOUBLE AS hospital_beds_per_thousand,
       CASE WHEN COUNT(*) > 4 THEN COUNT(*) END::DOUBLE AS weekly_icu
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name, CAST(o_orderdate AS DATE)"""

SHIPMENTS_SQL = """
SELECT n_name AS country, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date, l_returnflag, l_quantity, l_linenumber
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""

VACCINATIONS_SQL = f"""
SELECT country, date, SUM(l_quantity) AS total_vaccinations,
       SUM(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) AS people_fully_vaccinated, COUNT(*)::DOUBLE AS new_cases
FROM ({SHIPMENTS_SQL}) GROUP BY country, date"""


def raw_cases(t):
    joined = (
        t.orders.select("o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")
        .join(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    done = F.col("o_orderstatus") != "P"
    n = F.count(F.lit(1)).cast("double")
    finished = F.count_if(done).cast("double")
    return joined.groupBy(F.col("n_name").alias("country"), F.col("o_orderdate").cast("date").cast("string").alias("date")).agg(
        n.alias("new_cases"), F.when(finished != 0, finished).alias("new_deaths"),
        (F.round(F.sum("o_totalprice"), 2) / 1000).alias("total_cases"),
        (F.round(F.sum(F.when(done, F.col("o_totalprice"))), 2) / 1000).alias("total_deaths"),
        F.max("c_custkey").cast("double").alias("population"), F.min("c_acctbal").alias("population_density"),
        F.when(F.min("c_acctbal") > 0, F.max("c_acctbal")).alias("gdp_per_capita"),
        F.round(F.max("o_totalprice") / 400000, 4).alias("human_development_index"),
        F.max(F.col("c_nationkey") + 1).cast("double").alias("hospital_beds_per_thousand"),
        F.when(n > 4, n).alias("weekly_icu"),
    )


def shipments(t):
    joined = (
        t.lineitem.select("l_suppkey", "l_shipdate", "l_returnflag", "l_quantity", "l_linenumber")
        .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation.select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return joined.select(
        F.col("n_name").alias("country"), F.col("l_shipdate").cast("date").cast("string").alias("date"),
        "l_returnflag", "l_quantity", "l_linenumber",
    )


def raw_vaccinations(t):
    full = F.sum(F.when(F.col("l_returnflag") != "R", F.col("l_quantity")))
    return shipments(t).groupBy("country", "date").agg(
        F.sum("l_quantity").alias("total_vaccinations"), full.alias("people_fully_vaccinated"),
        F.count(F.lit(1)).cast("double").alias("new_cases"),
    )


def raw_by_age(t):
    """Shipment rows; first doses only where the flag is not R, so there are gaps to impute."""
    dose = F.when(F.col("l_returnflag") != "R", F.col("l_quantity"))
    return shipments(t).select("country", "date", F.col("l_returnflag").alias("age_group"), dose.alias("people_vaccinated"))


def raw_by_manufacturer(t):
    dose = F.when(F.col("l_returnflag") != "A", F.col("l_quantity"))
    return shipments(t).select("country", "date", F.col("l_returnflag").alias("vaccine"), dose.alias("total_vaccinations"))


# ------------------------------------------------------------------------------------ the same, as SQL steps


def _fill(c):
    return (
        f"LAST_VALUE({c} IGNORE NULLS) OVER (PARTITION BY location ORDER BY date "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
    )


def _bounded(c, q):
    return (
        f"CASE WHEN {c} < {q}1 - 3 * ({q}3 - {q}1) THEN {q}1 - 3 * ({q}3 - {q}1) "
        f"WHEN {c} > {q}3 + 3 * ({q}3 - {q}1) THEN {q}3 + 3 * ({q}3 - {q}1) ELSE {c} END AS {c}"
    )


MASTER_STEPS = f"""
filled AS (SELECT country AS location, CAST(date AS DATE) AS date, population, population_density, gdp_per_capita,
                  human_development_index, hospital_beds_per_thousand,
                  {', '.join(_fill(c) for c in ('new_cases', 'new_deaths', 'total_cases', 'total_deaths'))}
           FROM (SELECT *, country AS location FROM ({CASES_SQL}))),
scalars AS (SELECT QUANTILE_CONT(gdp_per_capita, 0.5) AS gdp, QUANTILE_CONT(new_cases, 0.25) AS a1, QUANTILE_CONT(new_cases, 0.75) AS a3,
                   QUANTILE_CONT(new_deaths, 0.25) AS b1, QUANTILE_CONT(new_deaths, 0.75) AS b3 FROM filled),
cases AS (SELECT location, date, {_bounded('new_cases', 'a')}, {_bounded('new_deaths', 'b')}, total_cases, total_deaths, population,
                 population_density, COALESCE(gdp_per_capita, gdp) AS gdp_per_capita, human_development_index, hospital_beds_per_thousand
          FROM filled, scalars),
vaccinations AS (SELECT location, date, total_vaccinations, COALESCE(f, 0) AS people_fully_vaccinated, new_cases AS new_cases_vac
                 FROM (SELECT country AS location, CAST(date AS DATE) AS date, total_vaccinations, new_cases,
                              {_fill('people_fully_vaccinated').replace('PARTITION BY location', 'PARTITION BY country').rsplit(' AS ', 1)[0]} AS f
                       FROM ({VACCINATIONS_SQL}))),
doses AS (SELECT country AS location, CAST(date AS DATE) AS date, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS a,
                 CASE WHEN l_returnflag <> 'A' THEN l_quantity END AS m FROM ({SHIPMENTS_SQL})),
by_age AS (SELECT location, date, SUM(COALESCE(a, (SELECT QUANTILE_CONT(a, 0.5) FROM doses))) AS age_people_vaccinated FROM doses GROUP BY ALL),
by_manufacturer AS (SELECT location, date, SUM(COALESCE(m, 0)) AS manuf_total_vaccinations FROM doses GROUP BY ALL),
master AS (SELECT * FROM cases LEFT JOIN vaccinations USING (location, date) LEFT JOIN by_age USING (location, date)
           LEFT JOIN by_manufacturer USING (location, date))"""

_W = "(PARTITION BY location ORDER BY date"


def _flow(c):
    parts = []
    for n in (7, 14, 30):
        frame = f"OVER {_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        parts += [f"AVG({c}) {frame} AS {c}_rolling_{n}d_mean", f"STDDEV_SAMP({c}) {frame} AS {c}_rolling_{n}d_std"]
        parts.append(f"LAG({c}, {n}) OVER {_W}) AS {c}_lag_{n}d")
    one, two = f"LAG({c}, 1) OVER {_W})", f"LAG({c}, 2) OVER {_W})"
    return [*parts, f"({c} - {one}) - ({one} - {two}) AS {c}_acceleration"]


def _over_population(c):
    return f"CASE WHEN population <> 0 THEN {c} / population END"


FEATURE_STEPS = f"""{MASTER_STEPS},
rated AS (SELECT *, {_over_population('total_cases')} * 1000000 AS cases_per_million,
                 CASE WHEN total_cases <> 0 THEN total_deaths / total_cases END AS mortality_rate,
                 {_over_population('total_vaccinations')} AS vaccination_rate, {_over_population('people_fully_vaccinated')} AS full_vaccination_rate
          FROM master),
featured AS (SELECT *, {', '.join(_flow('new_cases') + _flow('new_deaths'))},
                    ISODOW(date) - 1 AS day_of_week, MONTH(date) AS month, QUARTER(date) AS quarter,
                    DATE_DIFF('day', (SELECT MIN(date) FROM master), date) AS days_since_start,
                    CASE WHEN ISODOW(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
                    vaccination_rate * population_density AS vac_density_interaction,
                    cases_per_million * population_density AS cases_density_interaction
             FROM rated)"""

TARGET_STEPS = f"""{FEATURE_STEPS},
caps AS (SELECT QUANTILE_CONT(mortality_rate, 0.95) AS mort, QUANTILE_CONT(hospital_beds_per_thousand, 0.95) AS beds,
                QUANTILE_CONT(gdp_per_capita, 0.95) AS gdp95 FROM featured),
scored AS (SELECT f.*, CASE WHEN vaccination_rate < 0 THEN 0 WHEN vaccination_rate > 1 THEN 1 ELSE vaccination_rate END AS fv,
                  1 - CASE WHEN mortality_rate / mort > 1 THEN 1 ELSE mortality_rate / mort END AS fm,
                  CASE WHEN hospital_beds_per_thousand / beds > 1 THEN 1 ELSE hospital_beds_per_thousand / beds END AS fb,
                  CASE WHEN gdp_per_capita / gdp95 > 1 THEN 1 ELSE gdp_per_capita / gdp95 END AS fg,
                  CASE WHEN human_development_index > 1 THEN 1 ELSE human_development_index END AS fh
           FROM featured f, caps),
targets AS (SELECT *, (fv + fm + fb) / 3 AS preparedness_score, (fb + fg + fh) / 3 * 100 AS healthcare_capacity_score FROM scored),
levelled AS (SELECT *, CASE WHEN preparedness_score < 0 THEN NULL WHEN preparedness_score <= 0.4 THEN 'Low'
                            WHEN preparedness_score <= 0.7 THEN 'Medium' WHEN preparedness_score <= 1 THEN 'High' END AS preparedness_level
             FROM targets)"""

MASTER_COLUMNS = [
    "new_cases", "new_deaths", "total_cases", "total_deaths", "population", "population_density", "gdp_per_capita",
    "human_development_index", "hospital_beds_per_thousand", "total_vaccinations", "people_fully_vaccinated", "new_cases_vac",
    "age_people_vaccinated", "manuf_total_vaccinations",
]
FEATURE_COLUMNS = ["cases_per_million", "mortality_rate", "vaccination_rate", "full_vaccination_rate"]
FEATURE_COLUMNS += [
    f"{c}_{k}" for c in ("new_cases", "new_deaths") for n in (7, 14, 30)
    for k in (f"rolling_{n}d_mean", f"rolling_{n}d_std", f"lag_{n}d")
]
FEATURE_COLUMNS += ["new_cases_acceleration", "new_deaths_acceleration", "vac_density_interaction", "cases_density_interaction"]
CALENDAR_COLUMNS = ["day_of_week", "month", "quarter", "days_since_start", "is_weekend"]


def _digits(column):
    """Products of big numbers carry fewer exact decimals."""
    return -3 if column.endswith("interaction") else 4 if column == "cases_per_million" else 7


def _sql(steps, table, columns, whole=(), texts=()):
    rounded = ", ".join(f"ROUND({c}, {_digits(c)})::DOUBLE AS {c}" for c in columns)
    exact = "".join(f", {c}::BIGINT AS {c}" for c in whole) + "".join(f", {c}" for c in texts)
    return f"WITH {steps} SELECT location, CAST(date AS VARCHAR) AS date, {rounded}{exact} FROM {table}"


def _out(df, columns, whole=(), texts=()):
    return df.select("location", text_date(), *[r(c, _digits(c)) for c in columns], *[F.col(c).cast("long").alias(c) for c in whole], *texts)


def raw_tables(t):
    """The four raw tables, stored once like the files a run starts from, so that fitting reads parquet
    instead of repeating the joins."""
    folder = scratch_folder(t.spark, "raw")
    made = {"cases": raw_cases(t), "vaccinations": raw_vaccinations(t), "by_age": raw_by_age(t), "by_manufacturer": raw_by_manufacturer(t)}
    stored = side_by_side([lambda n=n, d=d: sinks.write_stage(d, f"{folder}/{n}") for n, d in made.items()])
    return dict(zip(made, stored))


def master_panel(t):
    """The SQL names its columns, so they stay at every size: with more customers a day, few days lack a debtor."""
    return stages.build_master(**raw_tables(t), keep=MASTER_COLUMNS)


def stored_master(t):
    return sinks.write_stage(master_panel(t), scratch_folder(t.spark, "master"))


def featured_panel(t):
    return features.FeatureBuilder().fit_transform(stored_master(t))


@query("j4_integrate", _sql(MASTER_STEPS, "master", MASTER_COLUMNS))
def _(t):
    return _out(master_panel(t), MASTER_COLUMNS)


@query("f12_engineer_features", _sql(FEATURE_STEPS, "featured", MASTER_COLUMNS + FEATURE_COLUMNS, CALENDAR_COLUMNS))
def _(t):
    return _out(featured_panel(t), MASTER_COLUMNS + FEATURE_COLUMNS, CALENDAR_COLUMNS)


TARGET_COLUMNS = ["mortality_rate", "vaccination_rate", "preparedness_score", "healthcare_capacity_score"]


@query(
    "f13_classification_rows",
    _sql(TARGET_STEPS, "levelled WHERE preparedness_level IS NOT NULL", TARGET_COLUMNS, texts=["preparedness_level"]),
)
def _(t):
    rows, _rest = targets.create_targets(features.with_rates(stored_master(t)))
    return _out(rows, TARGET_COLUMNS, texts=["preparedness_level"])


@query(
    "f13_regression_rows",
    _sql(TARGET_STEPS, "levelled WHERE healthcare_capacity_score IS NOT NULL", TARGET_COLUMNS, texts=["preparedness_level"]),
)
def _(t):
    _rest, rows = targets.create_targets(features.with_rates(stored_master(t)))
    return _out(rows, TARGET_COLUMNS, texts=["preparedness_level"])


# ------------------------------------------------------------------------------------ single expressions


@query(
    "f1_per_million",
    "SELECT c_custkey, ROUND(CASE WHEN c_nationkey <> 0 THEN c_acctbal / c_nationkey * 1000000 END, 2) AS rate FROM customer",
)
def _(t):
    return t.customer.select("c_custkey", F.round(sc.per_million("c_acctbal", "c_nationkey"), 2).alias("rate"))


@query(
    "f2_mortality_rate",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ROUND(CASE WHEN l_discount <> 0 THEN l_tax / l_discount END, 6) AS rate FROM lineitem",
)
def _(t):
    rate = sc.ratio("l_tax", sc.zero_to_null("l_discount"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(rate, 6).alias("rate"))


@query(
    "f3_vaccination_rates",
    """SELECT p_partkey, ROUND(p_size / p_retailprice, 6) AS vaccination_rate, ROUND(p_partkey / p_retailprice, 6) AS full_vaccination_rate FROM part""",
)
def _(t):
    named = t.part.select(
        "p_partkey", F.col("p_size").alias("total_vaccinations"), F.col("p_partkey").alias("people_fully_vaccinated"),
        F.col("p_retailprice").alias("population"),
    )
    return features.with_rates(named).select("p_partkey", r("vaccination_rate"), r("full_vaccination_rate"))


@query(
    "f4_f5_calendar",
    f"""WITH p AS ({EVENT_PANEL_SQL}) SELECT location, CAST(date AS VARCHAR) AS date, new_cases, (ISODOW(date) - 1)::BIGINT AS day_of_week,
               MONTH(date)::BIGINT AS month, QUARTER(date)::BIGINT AS quarter,
               DATE_DIFF('day', (SELECT MIN(date) FROM p), date)::BIGINT AS days_since_start,
               CASE WHEN ISODOW(date) >= 6 THEN 1 ELSE 0 END::BIGINT AS is_weekend FROM p""",
)
def _(t):
    panel = event_panel(t).drop("new_deaths")
    out = features.with_calendar(panel, features.first_date(panel))
    return out.select("location", text_date(), "new_cases", *[F.col(c).cast("long").alias(c) for c in CALENDAR_COLUMNS])


@query(
    "f6_interactions",
    "SELECT p_partkey, ROUND(p_size * p_retailprice, 4) AS vac_density_interaction, ROUND(p_partkey * p_retailprice, 4) AS cases_density_interaction FROM part",
)
def _(t):
    named = t.part.select(
        "p_partkey", F.col("p_size").alias("vaccination_rate"), F.col("p_partkey").alias("cases_per_million"),
        F.col("p_retailprice").alias("population_density"),
    )
    return features.with_interactions(named).select("p_partkey", r("vac_density_interaction", 4), r("cases_density_interaction", 4))


@query(
    "f7_unit_interval",
    "SELECT c_custkey, ROUND(LEAST(GREATEST(c_acctbal / 5000, 0), 1), 6) AS share FROM customer",
)
def _(t):
    return t.customer.select("c_custkey", F.round(sc.unit_interval(F.col("c_acctbal") / 5000), 6).alias("share"))


@query(
    "f8_capped_ratio",
    """WITH q AS (SELECT QUANTILE_CONT(o_totalprice, 0.95) AS cap FROM orders)
       SELECT o_orderkey, ROUND(LEAST(o_totalprice / cap, 1), 6) AS share FROM orders, q""",
)
def _(t):
    cap = targets.quantile_table(t.orders, ["o_totalprice"], [0.95])["o_totalprice"][0.95]
    return t.orders.select("o_orderkey", F.round(sc.capped_ratio("o_totalprice", cap), 6).alias("share"))


_LEVELS_SQL = """
SELECT c_custkey, s, CASE WHEN s < 0 THEN NULL WHEN s <= 0.4 THEN 'Low' WHEN s <= 0.7 THEN 'Medium' WHEN s <= 1 THEN 'High' END AS level
FROM (SELECT c_custkey, ROUND(c_acctbal / 9000, 1) AS s FROM customer)"""


@query("f10_levels", _LEVELS_SQL)
def _(t):
    """Rounded scores, so that many rows sit exactly on a bin edge, some below 0 and some above 1."""
    scored = t.customer.select("c_custkey", F.round(F.col("c_acctbal") / 9000, 1).alias("s"))
    return scored.select("c_custkey", "s", targets.level_of("s").alias("level"))


_FACTOR_ROWS_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice / 60000 AS vaccination_rate,
    NULLIF(l_discount, 0) AS mortality_rate, l_quantity AS hospital_beds_per_thousand, l_extendedprice AS gdp_per_capita,
    l_tax * 15 AS human_development_index FROM lineitem"""


def _factor_rows(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_extendedprice") / 60000).alias("vaccination_rate"),
        sc.zero_to_null("l_discount").alias("mortality_rate"), F.col("l_quantity").alias("hospital_beds_per_thousand"),
        F.col("l_extendedprice").alias("gdp_per_capita"), (F.col("l_tax") * 15).alias("human_development_index"),
    )


@query(
    "f9_preparedness_score",
    f"""WITH d AS ({_FACTOR_ROWS_SQL}), q AS (SELECT QUANTILE_CONT(mortality_rate, 0.95) AS m, QUANTILE_CONT(hospital_beds_per_thousand, 0.95) AS b FROM d)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               ROUND((LEAST(vaccination_rate, 1) + (1 - CASE WHEN mortality_rate > m THEN 1 ELSE mortality_rate / m END)
                      + LEAST(hospital_beds_per_thousand / b, 1)) / 3, 9) AS preparedness_score FROM d, q""",
)
def _(t):
    rows = _factor_rows(t)
    scored = targets.TargetBuilder().fit(rows).transform(rows)
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r("preparedness_score", 9))


@query(
    "f11_capacity_score",
    f"""WITH d AS ({_FACTOR_ROWS_SQL}), q AS (SELECT QUANTILE_CONT(gdp_per_capita, 0.95) AS g, QUANTILE_CONT(hospital_beds_per_thousand, 0.95) AS b FROM d)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               ROUND((LEAST(hospital_beds_per_thousand / b, 1) + LEAST(gdp_per_capita / g, 1) + LEAST(human_development_index, 1)) / 3 * 100, 8)
               AS healthcare_capacity_score FROM d, q""",
)
def _(t):
    rows = _factor_rows(t)
    scored = targets.TargetBuilder().fit(rows).transform(rows)
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r("healthcare_capacity_score", 8))
