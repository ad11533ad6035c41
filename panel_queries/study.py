"""Profiles and exploration."""

from __future__ import annotations

from pyspark.sql import functions as F

from panel_queries.base import (
    EVENT_PANEL_SQL, GAPPY_PANEL_SQL, ORDER_PANEL_SQL, event_panel, gappy_panel, order_panel, query, r, text_date,
)
from panel_queries.core import DETAIL_SQL, ORDERS_KEY, detail_rows
from panelcraft.functions import scalars as sc
from panelcraft.functions.columns import added_columns_by_category
from panelcraft.operators import clean, explore, features, profile
from panelcraft.operators.panel_windows import RowFeature, latest_per_entity, with_row_features
from panelcraft.sources import sinks

DETAIL_COLUMNS = (
    "location", "date", "row_id", "new_cases", "new_deaths", "gdp_per_capita", "population", "weekly_icu", "people_vaccinated"
)


@query(
    "a5_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT({c}) AS n, ROUND(AVG({c}), 4) AS mean, ROUND(STDDEV_SAMP({c}), 4) AS std, MIN({c})::DOUBLE AS min,
            ROUND(QUANTILE_CONT({c}, 0.25), 4)::DOUBLE AS q1, ROUND(QUANTILE_CONT({c}, 0.5), 4)::DOUBLE AS median, ROUND(QUANTILE_CONT({c}, 0.75), 4)::DOUBLE AS q3,
            MAX({c})::DOUBLE AS max, ROUND(STDDEV_SAMP({c}) / AVG({c}) * 100, 4) AS cv_pct FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    ),
)
def _(t):
    out = profile.describe(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])
    return out.select("column_name", "n", *[r(c, 4) for c in ("mean", "std", "q1", "median", "q3", "cv_pct")], "min", "max")


@query(
    "a6_value_counts",
    f"""SELECT location, COUNT(*) AS n, ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM orders), 6)::DOUBLE AS pct
        FROM ({GAPPY_PANEL_SQL}) WHERE location IS NOT NULL GROUP BY location""",
)
def _(t):
    return profile.value_counts(gappy_panel(t), "location").select("location", "n", r("pct"))


@query(
    "a6_distinct_counts",
    "SELECT 'customers' AS dataset, COUNT(DISTINCT o_custkey) AS n_entities FROM orders UNION ALL SELECT 'parts', COUNT(DISTINCT l_partkey) FROM lineitem",
)
def _(t):
    return explore.entity_counts({"customers": (t.orders, "o_custkey"), "parts": (t.lineitem, "l_partkey")})


_DAILY_SQL = f"""SELECT date, SUM(new_cases)::BIGINT AS new_cases, COALESCE(SUM(new_deaths), 0)::BIGINT AS new_deaths
                 FROM ({ORDER_PANEL_SQL}) GROUP BY date"""


@query("a13_daily_totals", f"SELECT CAST(date AS VARCHAR) AS date, new_cases, new_deaths FROM ({_DAILY_SQL})")
def _(t):
    return explore.daily_totals(order_panel(t), ["new_cases", "new_deaths"]).withColumn("date", text_date())


_LATEST_SQL = f"""SELECT location, ARG_MAX(new_cases, row_key) FILTER (new_cases IS NOT NULL) AS new_cases,
    ARG_MAX(new_deaths, row_key) FILTER (new_deaths IS NOT NULL) AS new_deaths
    FROM (SELECT *, (date, row_id) AS row_key FROM ({GAPPY_PANEL_SQL})) WHERE location IS NOT NULL GROUP BY location"""


@query("a14_latest_per_entity", _LATEST_SQL)
def _(t):
    return latest_per_entity(gappy_panel(t), ORDERS_KEY, ["new_cases", "new_deaths"])


_CORR_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _corr_sql(pairs):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS var1, '{b}' AS var2, " + f"ROUND(CORR({a}, {b}), 6) AS r FROM lineitem"
        for a, b in pairs
    )


_ALL_PAIRS = [(a, b) for a in _CORR_COLUMNS for b in _CORR_COLUMNS if a != b]
_DIAGONAL = " UNION ALL ".join(f"SELECT '{c}', '{c}', 1.0" for c in _CORR_COLUMNS)


@query("a15_correlation_matrix", f"{_corr_sql(_ALL_PAIRS)} UNION ALL {_DIAGONAL}")
def _(t):
    return explore.correlation_matrix(t.lineitem, _CORR_COLUMNS).select("var1", "var2", r("r"))


@query(
    "a16_strong_pairs",
    f"SELECT var1, var2, r FROM ({_corr_sql([(a, b) for i, a in enumerate(_CORR_COLUMNS) for b in _CORR_COLUMNS[i + 1:]])}) WHERE ABS(r) > 0.7",
)
def _(t):
    return explore.strong_pairs(t.lineitem, _CORR_COLUMNS).select("var1", "var2", r("r"))


@query(
    "a17_score_correlations",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, ROUND(CORR({c}, l_extendedprice), 6) AS r FROM lineitem"
        for c in _CORR_COLUMNS if c != "l_extendedprice"
    ),
)
def _(t):
    cols = [c for c in _CORR_COLUMNS if c != "l_extendedprice"]
    return explore.score_correlations(t.lineitem, "l_extendedprice", cols).select("feature", r("r"))


_FITS = [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax")]


@query(
    "a18_linear_fits",
    " UNION ALL ".join(
        f"""SELECT '{x}' AS x, '{y}' AS y, COUNT(*) AS n, ROUND(REGR_SLOPE({y}, {x}), 5) AS slope, ROUND(REGR_INTERCEPT({y}, {x}), 5) AS intercept,
            ROUND(CORR({x}, {y}), 6) AS r FROM lineitem""" for x, y in _FITS
    ),
)
def _(t):
    return explore.linear_fits(t.lineitem, _FITS).select("x", "y", "n", r("slope", 5), r("intercept", 5), r("r"))


@query(
    "a19_duplicate_rows",
    """SELECT COUNT(*) AS n_rows, COUNT(*) - COUNT(DISTINCT (l_orderkey, k)) AS duplicates,
              ROUND((COUNT(*) - COUNT(DISTINCT (l_orderkey, k))) * 100.0 / COUNT(*), 6)::DOUBLE AS duplicate_pct
       FROM (SELECT l_orderkey, CASE WHEN l_linenumber > 2 THEN l_linenumber ELSE -1 END AS k FROM lineitem)""",
)
def _(t):
    rows = t.lineitem.select("l_orderkey", F.when(F.col("l_linenumber") > 2, F.col("l_linenumber")).alias("k"))
    return profile.duplicate_rows(rows).select("n_rows", "duplicates", r("duplicate_pct"))


@query(
    "a20_histogram",
    """WITH b AS (SELECT MIN(value) AS lo, MAX(value) AS hi FROM events),
            h AS (SELECT LEAST(FLOOR((value - lo) / ((hi - lo) / 30)), 29)::INTEGER AS bin, COUNT(*) AS n FROM events, b GROUP BY 1)
       SELECT s.bin::INTEGER AS bin, ROUND(lo + s.bin * (hi - lo) / 30, 6) AS bin_start, ROUND(lo + (s.bin + 1) * (hi - lo) / 30, 6) AS bin_end,
              COALESCE(n, 0) AS n
       FROM (SELECT UNNEST(RANGE(30)) AS bin) s CROSS JOIN b LEFT JOIN h ON s.bin = h.bin""",
)
def _(t):
    return profile.histogram(t.events, "value", 30).select("bin", r("bin_start"), r("bin_end"), "n")


@query(
    "a21_imbalance",
    """WITH c AS (SELECT quality, COUNT(*) * 100.0 / (SELECT COUNT(*) FROM labels) AS p FROM labels GROUP BY quality)
       SELECT ARG_MAX(quality, p) AS majority, ROUND(MAX(p), 6)::DOUBLE AS majority_pct, ARG_MIN(quality, p) AS minority, ROUND(MIN(p), 6)::DOUBLE AS minority_pct,
              ROUND(MAX(p) / MIN(p), 6)::DOUBLE AS ratio,
              CASE WHEN MAX(p) / MIN(p) < 2 THEN 'balanced' WHEN MAX(p) / MIN(p) < 3 THEN 'moderate' ELSE 'high' END AS balance FROM c""",
)
def _(t):
    out = profile.imbalance(t.labels, "quality")
    return out.select("majority", r("majority_pct"), "minority", r("minority_pct"), r("ratio"), "balance")


# ------------------------------------------------------------------------------------------ set operations


@query("u1_distinct_entities", "SELECT DISTINCT o_custkey AS entity FROM orders")
def _(t):
    return explore.distinct_entities(t.orders, "o_custkey")


_OVERLAP_SQL = """WITH l AS (SELECT DISTINCT user_id AS e FROM events WHERE event_type = 'purchase'),
     r AS (SELECT DISTINCT user_id AS e FROM events WHERE event_type = 'error'),
     c AS (SELECT (SELECT COUNT(*) FROM (SELECT e FROM l INTERSECT SELECT e FROM r)) AS common,
                  (SELECT COUNT(*) FROM (SELECT e FROM l EXCEPT SELECT e FROM r)) AS left_only,
                  (SELECT COUNT(*) FROM (SELECT e FROM r EXCEPT SELECT e FROM l)) AS right_only)
SELECT *, ROUND(common * 100.0 / (common + left_only), 6)::DOUBLE AS coverage_pct FROM c"""


def _two_user_sets(t):
    return (
        t.events.where(F.col("event_type") == "purchase").select("user_id"),
        t.events.where(F.col("event_type") == "error").select("user_id"),
    )


@query("u2_domain_overlap", _OVERLAP_SQL)
def _(t):
    left, right = _two_user_sets(t)
    out = explore.domain_overlap(left, "user_id", right, "user_id")
    return out.select("common", "left_only", "right_only", r("coverage_pct"))


@query(
    "u3_union_count",
    """SELECT COUNT(*) AS n_entities FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier
       UNION SELECT n_nationkey FROM nation UNION SELECT c_custkey FROM customer)""",
)
def _(t):
    return explore.union_count(
        {
            "customers": (t.customer, "c_nationkey"), "suppliers": (t.supplier, "s_nationkey"),
            "nations": (t.nation, "n_nationkey"), "keys": (t.customer, "c_custkey"),
        }
    )


# Keywords that file engineered columns into categories.
FEATURE_CATEGORIES = {
    "rates": ["rate", "ratio", "per_million", "pct"],
    "rolling": ["rolling"],
    "lags": ["lag"],
    "calendar": ["day", "month", "quarter", "week", "days_since"],
    "trends": ["acceleration"],
}


@query(
    "u4_added_columns",
    f"""WITH p AS ({EVENT_PANEL_SQL}), f AS (SELECT date,
           COUNT(new_cases) AS filled, COUNT(*) AS n FROM p GROUP BY date)
        SELECT 'calendar' AS category, c AS column_name, (SELECT SUM(n) FROM f)::BIGINT AS present
        FROM (SELECT UNNEST(['day_of_week', 'month', 'quarter', 'is_weekend', 'days_since_start']) AS c)""",
)
def _(t):
    """Columns added by the calendar step, by category, with the number of values each holds."""
    before = event_panel(t)
    after = features.with_calendar(before, features.first_date(before))
    filed = added_columns_by_category(before.columns, after.columns, FEATURE_CATEGORIES)
    found = [(k, c) for k, cols in filed.items() for c in cols]
    counted = after.agg(*[F.count(c).alias(c) for _, c in found])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("category"), F.lit(c).alias("column_name"), F.col(c).alias("present")) for k, c in found
    ])))


# ------------------------------------------------------------------------------------------ derived labels


@query(
    "f14_quartile_bins",
    """WITH q AS (SELECT QUANTILE_CONT(o_totalprice, 0.25) AS a, QUANTILE_CONT(o_totalprice, 0.5) AS b, QUANTILE_CONT(o_totalprice, 0.75) AS c FROM orders)
       SELECT CASE WHEN o_totalprice <= a THEN 'Q1' WHEN o_totalprice <= b THEN 'Q2' WHEN o_totalprice <= c THEN 'Q3' ELSE 'Q4' END AS bin,
              COUNT(*) AS n, ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM orders), 6)::DOUBLE AS pct FROM orders, q GROUP BY 1""",
)
def _(t):
    return profile.quartile_bins(t.orders, "o_totalprice").select("bin", "n", r("pct"))


_NULLS_SQL = f"""WITH d AS ({DETAIL_SQL}), w AS (SELECT COUNT(*) AS n_rows, {', '.join(f'COUNT(*) - COUNT({c}) AS {c}' for c in DETAIL_COLUMNS)} FROM d),
l AS ({' UNION ALL '.join(f"SELECT '{c}' AS column_name, {c} AS nulls, n_rows FROM w" for c in DETAIL_COLUMNS)}),
s AS (SELECT *, ROUND(nulls * 100.0 / n_rows, 2)::DOUBLE AS null_pct FROM l WHERE nulls > 0),
b AS (SELECT *, CASE WHEN null_pct > 70 THEN 'critical' WHEN null_pct > 50 THEN 'high' WHEN null_pct > 30 THEN 'medium' ELSE 'low' END AS severity FROM s)"""


@query("e1_null_profile", f"{_NULLS_SQL} SELECT column_name, nulls, null_pct, severity FROM b")
def _(t):
    return profile.null_profile(detail_rows(t)).drop("dtype")


@query(
    "f15_null_severity",
    f"""{_NULLS_SQL} SELECT (SELECT SUM(n_rows) FROM l)::BIGINT AS cells, (SELECT SUM(nulls) FROM l)::BIGINT AS null_cells,
        COUNT(*) FILTER (severity = 'critical') AS critical, COUNT(*) FILTER (severity = 'high') AS high,
        COUNT(*) FILTER (severity = 'medium') AS medium, COUNT(*) FILTER (severity = 'low') AS low,
        ROUND((SELECT SUM(nulls) * 100.0 / SUM(n_rows) FROM l), 6)::DOUBLE AS null_pct FROM b""",
)
def _(t):
    return profile.null_totals(detail_rows(t)).withColumn("null_pct", r("null_pct"))


@query(
    "e2_overview",
    """SELECT COUNT(*) AS n_rows, 6::BIGINT AS n_cols, CAST(CAST(MIN(o_orderdate) AS DATE) AS VARCHAR) AS first_date,
              CAST(CAST(MAX(o_orderdate) AS DATE) AS VARCHAR) AS last_date, COUNT(DISTINCT o_custkey) AS n_entities FROM orders""",
)
def _(t):
    out = profile.overview(t.orders, "o_custkey", "o_orderdate")
    dates = [F.col(c).cast("date").cast("string").alias(c) for c in ("first_date", "last_date")]
    return out.select("n_rows", "n_cols", *dates, "n_entities")


@query("e2_top_entities", "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 10")
def _(t):
    return profile.top_values(t.orders, "o_custkey")


@query(
    "e3_completeness",
    f"""WITH d AS ({DETAIL_SQL}) SELECT * FROM (
        {' UNION ALL '.join(f"SELECT '{c}' AS column_name, COUNT({c}) AS present, ROUND(COUNT({c}) * 100.0 / COUNT(*), 6)::DOUBLE AS complete_pct FROM d" for c in ("new_cases", "new_deaths", "weekly_icu", "people_vaccinated"))})
        WHERE complete_pct > 30""",
)
def _(t):
    return profile.completeness(detail_rows(t)).withColumn("complete_pct", r("complete_pct"))


_TIMELINE_SQL = f"""SELECT CAST(date AS VARCHAR) AS date, new_cases, new_deaths,
       CASE WHEN COUNT(*) OVER w = 7 THEN ROUND(AVG(new_cases) OVER w, 6) END AS new_cases_ma_7,
       CASE WHEN COUNT(*) OVER w = 7 THEN ROUND(AVG(new_deaths) OVER w, 6) END AS new_deaths_ma_7
FROM ({_DAILY_SQL}) WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""


@query("e4_timeline", _TIMELINE_SQL)
def _(t):
    measures = ["new_cases", "new_deaths"]
    out = explore.timeline(explore.daily_totals(order_panel(t), measures), measures)
    return out.select(text_date(), *measures, r("new_cases_ma_7"), r("new_deaths_ma_7"))


@query(
    "e4_peak_days",
    f"SELECT CAST(date AS VARCHAR) AS date, new_cases, new_deaths FROM ({_DAILY_SQL}) ORDER BY new_cases DESC, date LIMIT 10",
)
def _(t):
    daily = explore.daily_totals(order_panel(t), ["new_cases", "new_deaths"])
    return explore.top_rows(daily, "new_cases", 10, ["date"]).withColumn("date", text_date())


@query("e5_leader_board", f"SELECT * FROM ({_LATEST_SQL}) WHERE new_cases IS NOT NULL ORDER BY new_cases DESC, location LIMIT 20")
def _(t):
    return explore.leader_board(gappy_panel(t), ORDERS_KEY, ["new_cases", "new_deaths"], "new_cases")


@query(
    "o2_top_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def _(t):
    return explore.top_rows(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 20, ["o_orderkey"])


@query(
    "o1_sorted_panel",
    f"SELECT row_id, location, CAST(date AS VARCHAR) AS date, ROW_NUMBER() OVER (PARTITION BY location ORDER BY date NULLS LAST, row_id) AS position FROM ({GAPPY_PANEL_SQL}) WHERE location IS NOT NULL",
)
def _(t):
    """The panel order made visible: the position of each row inside its entity."""
    position = RowFeature("position", 0, lambda w: F.row_number().over(w))
    out = with_row_features(gappy_panel(t), ORDERS_KEY, [position]).where(F.col("location").isNotNull())
    return out.select("row_id", "location", text_date(), F.col("position").cast("long").alias("position"))


@query(
    "e6_coverage",
    """SELECT COUNT(*) AS n_entities, ROUND(AVG(n), 6) AS mean_rows, MEDIAN(n)::DOUBLE AS median_rows, MIN(n) AS min_rows, MAX(n) AS max_rows
       FROM (SELECT COUNT(*) AS n FROM orders GROUP BY o_custkey)""",
)
def _(t):
    return explore.coverage(t.orders, "o_custkey").withColumn("mean_rows", r("mean_rows"))


@query("e7_overlap_study", _OVERLAP_SQL.replace("'purchase'", "'view'").replace("'error'", "'click'"))
def _(t):
    left = t.events.where(F.col("event_type") == "view").select("user_id")
    right = t.events.where(F.col("event_type") == "click").select("user_id")
    out = explore.domain_overlap(left, "user_id", right, "user_id")
    return out.select("common", "left_only", "right_only", r("coverage_pct"))


_E8 = ["new_cases", "new_deaths", "gdp_per_capita", "population", "people_vaccinated"]


@query(
    "e8_correlation_study",
    f"WITH d AS ({DETAIL_SQL}) SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS var1, '{b}' AS var2, ROUND(CORR({a}, {b}), 6) AS r FROM d" for i, a in enumerate(["row_id", *_E8]) for b in ["row_id", *_E8][i + 1:]
    )
    + ") WHERE ABS(r) > 0.7",
)
def _(t):
    rows = detail_rows(t)
    return explore.strong_pairs(rows, explore.correlation_columns(rows)).select("var1", "var2", r("r"))


_E8_ALL = ["row_id", *_E8]
_E8_FITS = [("new_cases", "new_deaths"), ("gdp_per_capita", "people_vaccinated")]


def _e8_cell(part, a, b, r_of):
    both = f"COUNT(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    return f"SELECT '{part}' AS part, '{a}' AS var1, '{b}' AS var2, {both} AS n, {r_of} AS r, NULL::DOUBLE AS slope, NULL::DOUBLE AS intercept FROM d"


@query(
    "e8_full_study",
    f"WITH d AS ({DETAIL_SQL}) "
    + " UNION ALL ".join(_e8_cell("matrix", a, b, "1.0::DOUBLE" if a == b else f"ROUND(CORR({a}, {b}), 6)") for a in _E8_ALL for b in _E8_ALL)
    + " UNION ALL SELECT * FROM ("
    + " UNION ALL ".join(_e8_cell("strong", a, b, f"ROUND(CORR({a}, {b}), 6)") for i, a in enumerate(_E8_ALL) for b in _E8_ALL[i + 1:])
    + ") WHERE ABS(r) > 0.7 UNION ALL "
    + " UNION ALL ".join(
        f"SELECT 'fit', '{a}', '{b}', REGR_COUNT({b}, {a})::BIGINT, ROUND(CORR({a}, {b}), 6), ROUND(REGR_SLOPE({b}, {a}), 5), ROUND(REGR_INTERCEPT({b}, {a}), 3) FROM d"
        for a, b in _E8_FITS
    ),
)
def _(t):
    found = explore.correlation_study(detail_rows(t), _E8_ALL, _E8_FITS)
    return found.select("part", "var1", "var2", "n", r("r"), r("slope", 5), r("intercept", 3))


@query(
    "e9_cleaning_delta",
    f"""WITH d AS ({DETAIL_SQL}), n AS (SELECT COUNT(*) AS rows_n, COUNT(*) - COUNT(location) AS l, COUNT(*) - COUNT(new_cases) AS a, COUNT(*) - COUNT(new_deaths) AS b,
               COUNT(*) - COUNT(gdp_per_capita) AS g, COUNT(*) - COUNT(weekly_icu) AS w, COUNT(*) - COUNT(people_vaccinated) AS p FROM d)
        SELECT rows_n AS rows_before, rows_n AS rows_after, 0::BIGINT AS rows_removed, 9::BIGINT AS cols_before, 8::BIGINT AS cols_after, 1::BIGINT AS cols_removed,
               (l + a + b + g + w + p)::BIGINT AS nulls_before, l::BIGINT AS nulls_after, (a + b + g + w + p)::BIGINT AS nulls_removed,
               ROUND((l + a + b + g + w + p) * 100.0 / rows_n / 9, 6)::DOUBLE AS mean_null_pct_before, ROUND(l * 100.0 / rows_n / 8, 6)::DOUBLE AS mean_null_pct_after,
               ROUND((l + a + b + g + w + p) * 100.0 / rows_n / 9 - l * 100.0 / rows_n / 8, 6)::DOUBLE AS mean_null_pct_drop FROM n""",
)
def _(t):
    before = detail_rows(t)
    out = profile.cleaning_delta(before, clean.by_manufacturer_cleaner().fit_transform(before))
    for c in ("mean_null_pct_before", "mean_null_pct_after", "mean_null_pct_drop"):
        out = out.withColumn(c, r(c))
    return out


@query(
    "e10_target_study",
    f"""WITH d AS ({DETAIL_SQL}) SELECT location AS value, COUNT(*) AS n, ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM d), 6)::DOUBLE AS pct
        FROM d WHERE location IS NOT NULL GROUP BY location""",
)
def _(t):
    out = profile.target_summary(detail_rows(t), "location")
    return out.select(F.col("location").alias("value"), "n", r("pct"))


_REPORT_SQL = f"""WITH g AS ({DETAIL_SQL}),
n AS (SELECT COUNT(*) AS n_rows, {' + '.join(f'COUNT(*) - COUNT({c})' for c in DETAIL_COLUMNS)} AS null_cells FROM g),
s AS (SELECT n_rows, 9::BIGINT AS n_cols, null_cells::BIGINT AS null_cells, ROUND(null_cells * 100.0 / (n_rows * 9), 6)::DOUBLE AS null_pct FROM n)
SELECT *, CASE WHEN null_pct < 1 THEN 'excellent' WHEN null_pct < 5 THEN 'good' WHEN null_pct < 10 THEN 'acceptable' ELSE 'review' END AS null_band,
       0::BIGINT AS duplicates, 0.0::DOUBLE AS duplicate_pct, 7::BIGINT AS numeric_columns, 1::BIGINT AS text_columns, 1::BIGINT AS date_columns,
       100 - CASE WHEN null_pct > 10 THEN 30 WHEN null_pct > 5 THEN 15 WHEN null_pct > 1 THEN 5 ELSE 0 END AS score,
       CASE WHEN null_pct > 10 THEN 'acceptable' WHEN null_pct > 5 THEN 'good' ELSE 'excellent' END AS status FROM s"""


@query("e11_quality_report", _REPORT_SQL)
def _(t):
    return profile.quality_report(detail_rows(t)).withColumn("null_pct", r("null_pct"))


@query(
    "f16_quality_score",
    """WITH s AS (SELECT user_id, COUNT(*) * 100.0 / SUM(COUNT(*)) OVER () AS null_pct, COUNT(DISTINCT event_type) * 1.0 AS duplicate_pct FROM events GROUP BY user_id),
            q AS (SELECT user_id, ROUND(null_pct, 6)::DOUBLE AS null_pct, duplicate_pct::DOUBLE AS duplicate_pct,
                         100 - CASE WHEN null_pct > 10 THEN 30 WHEN null_pct > 5 THEN 15 WHEN null_pct > 1 THEN 5 ELSE 0 END
                             - CASE WHEN duplicate_pct > 5 THEN 20 WHEN duplicate_pct > 1 THEN 10 ELSE 0 END AS score FROM s)
       SELECT *, CASE WHEN score >= 90 THEN 'excellent' WHEN score >= 75 THEN 'good' WHEN score >= 60 THEN 'acceptable' ELSE 'needs work' END AS status FROM q""",
)
def _(t):
    users = t.events.groupBy("user_id").agg(F.count("*").alias("n"), F.count_distinct("event_type").cast("double").alias("duplicate_pct"))
    total = t.events.count()
    rows = users.select("user_id", (F.col("n") * 100.0 / F.lit(total)).alias("null_pct"), "duplicate_pct")
    scored = rows.withColumn("score", sc.quality_score("null_pct", "duplicate_pct"))
    return scored.select("user_id", r("null_pct"), "duplicate_pct", "score", sc.quality_status("score").alias("status"))


@query("e12_normality")
def _(t):
    return profile.normality(t.orders, "o_totalprice")


@query(
    "e13_stage_funnel",
    f"""WITH raw AS ({GAPPY_PANEL_SQL}), kept AS (SELECT * FROM raw WHERE new_deaths IS NOT NULL),
        s AS (SELECT 0 AS position, 'raw' AS stage, COUNT(*) AS n_rows, (COUNT(*) * 3 - COUNT(location) - COUNT(new_cases) - COUNT(new_deaths))::BIGINT AS null_cells FROM raw
              UNION ALL SELECT 1, 'kept', COUNT(*), (COUNT(*) - COUNT(location))::BIGINT FROM kept),
        p AS (SELECT *, null_cells * 100.0 / (n_rows * 5) AS np, FIRST_VALUE(n_rows) OVER (ORDER BY position) AS n0 FROM s)
        SELECT position, stage, n_rows, 5::BIGINT AS n_cols, null_cells, ROUND(np, 6)::DOUBLE AS null_pct, ROUND(n_rows * 100.0 / n0, 6)::DOUBLE AS rows_retained_pct,
               0.0::DOUBLE AS cols_added_pct, ROUND((FIRST_VALUE(np) OVER (ORDER BY position) - np) / FIRST_VALUE(np) OVER (ORDER BY position) * 100, 6)::DOUBLE AS null_reduction_pct
        FROM p""",
)
def _(t):
    raw = gappy_panel(t)
    out = sinks.stage_funnel({"raw": raw, "kept": raw.where(F.col("new_deaths").isNotNull())})
    return out.select(
        "position", "stage", "n_rows", "n_cols", "null_cells",
        *[r(c) for c in ("null_pct", "rows_retained_pct", "cols_added_pct", "null_reduction_pct")],
    )
