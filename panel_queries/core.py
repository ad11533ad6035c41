"""Sources, projections, checks, joins, aggregates, windows, cleaning, features and targets."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from panel_queries.base import (
    EVENT_PANEL_SQL, GAPPY_PANEL_SQL, ORDER_PANEL_SQL, event_panel, gappy_panel, order_panel, query, r, text_date,
)
from panelcraft.functions import columns as names
from panelcraft.functions import scalars as sc
from panelcraft.operators import checks, clean, explore, integrate, profile
from panelcraft.operators import panel_windows as pw
from panelcraft.operators.panel_windows import PanelKey
from panelcraft.operators.quantiles import quantiles
from panelcraft.session import scratch_folder
from panelcraft.sources import readers, sinks

KEY = PanelKey()
ORDERS_KEY = PanelKey(tiebreak=("row_id",))

# ------------------------------------------------------------------------------------------ sources, sinks

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()), T.StructField("o_orderstatus", T.StringType()),
    ]
)


@query(
    "s1_csv_scan",
    """SELECT o_orderkey, NULLIF(o_custkey, 0) AS o_custkey, o_totalprice,
              CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus,
              o_orderstatus || chr(10) || '"' || o_orderpriority || '", ' || chr(10) || o_orderkey AS note FROM orders""",
)
def _(t):
    """Read back from files whose quoted fields hold line breaks, quotes and commas."""
    path = scratch_folder(t.spark, "csv-scan")
    status = F.when(F.col("o_orderstatus") == "P", "NA").otherwise(F.col("o_orderstatus"))
    customer = F.when(F.col("o_custkey") == 0, "nan").otherwise(F.col("o_custkey").cast("string"))
    note = F.concat(F.col("o_orderstatus"), F.lit('\n"'), F.col("o_orderpriority"), F.lit('", \n'), F.col("o_orderkey").cast("string"))
    sinks.export_csv(
        t.orders.select("o_orderkey", customer.alias("o_custkey"), "o_totalprice", status.alias("o_orderstatus"), note.alias("note")), path
    )
    return readers.read_csv(t.spark, path, ORDERS_SCHEMA)


@query("s2_stage_round_trip", f"SELECT location, CAST(date AS VARCHAR) AS date, new_cases, new_deaths FROM ({ORDER_PANEL_SQL})")
def _(t):
    stored = sinks.write_stage(order_panel(t), scratch_folder(t.spark, "stage"))
    return stored.select("location", text_date(), "new_cases", "new_deaths")


@query(
    "s6_source_check",
    """SELECT 'orders' AS source, COUNT(*) AS n_rows FROM orders UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
       UNION ALL SELECT 'shipments', NULL""",
)
def _(t):
    """Row count of every source that is present, NULL for one that is not."""
    wanted = {n: f"{t.folder}/{n}.parquet" for n in ("orders", "lineitem", "shipments")}
    missing = set(readers.missing_sources(t.spark, wanted))
    counted = [
        t.spark.range(1).select(F.lit(n).alias("source"), F.lit(None).cast("long").alias("n_rows")) if n in missing
        else t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("source"), "n_rows")
        for n, path in wanted.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query(
    "s7_stage_summary",
    f"""WITH raw AS ({GAPPY_PANEL_SQL}), kept AS (SELECT * FROM raw WHERE new_cases IS NOT NULL)
    SELECT 0 AS position, 'raw' AS stage, COUNT(*) AS n_rows, 5::BIGINT AS n_cols,
           (COUNT(*) * 3 - COUNT(location) - COUNT(new_cases) - COUNT(new_deaths))::BIGINT AS null_cells,
           ROUND((COUNT(*) * 3 - COUNT(location) - COUNT(new_cases) - COUNT(new_deaths)) * 100.0 / (COUNT(*) * 5), 6)::DOUBLE AS null_pct
    FROM raw
    UNION ALL
    SELECT 1, 'kept', COUNT(*), 5, (COUNT(*) * 2 - COUNT(location) - COUNT(new_deaths))::BIGINT,
           ROUND((COUNT(*) * 2 - COUNT(location) - COUNT(new_deaths)) * 100.0 / (COUNT(*) * 5), 6)::DOUBLE
    FROM kept""",
)
def _(t):
    raw = gappy_panel(t)
    out = sinks.stage_summary({"raw": raw, "kept": checks.drop_incomplete(raw, ["new_cases"])})
    return out.select("position", "stage", "n_rows", "n_cols", "null_cells", r("null_pct"))


# ------------------------------------------------------------------------------------------ projections


@query(
    "p1_find_column",
    """SELECT 'date' AS keyword, 'o_orderdate' AS found, COUNT(o_orderdate) AS present FROM orders
       UNION ALL SELECT 'price', 'o_totalprice', COUNT(o_totalprice) FROM orders""",
)
def _(t):
    """Columns located by keyword, with the number of values each holds."""
    found = {k: names.find_column(t.orders.columns, [k]) for k in ("date", "price")}
    counted = t.orders.agg(*[F.count(c).alias(k) for k, c in found.items()])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("keyword"), F.lit(c).alias("found"), F.col(k).alias("present")) for k, c in found.items()
    ])))


@query(
    "p2_standard_names",
    "SELECT n_nationkey AS location, n_name, n_regionkey FROM nation",
)
def _(t):
    return names.standardize_columns(t.nation)


RAW_DATES_SQL = """
SELECT o_orderkey, o_totalprice,
       CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date
FROM orders"""


def raw_dates(t):
    text = F.col("o_orderdate").cast("date").cast("string")
    date = F.when(F.col("o_orderstatus") == "P", "pending").otherwise(text)
    return t.orders.select("o_orderkey", "o_totalprice", date.alias("date"))


@query(
    "p4_parse_dates",
    f"""SELECT o_orderkey, o_totalprice, CAST(TRY_CAST(date AS DATE) AS VARCHAR) AS date
        FROM ({RAW_DATES_SQL}) WHERE TRY_CAST(date AS DATE) IS NOT NULL""",
)
def _(t):
    return checks.parse_dates(raw_dates(t)).withColumn("date", text_date())


@query(
    "p3_guards",
    f"SELECT COUNT(*) AS n_rows, COUNT(DISTINCT date) AS n_dates FROM ({RAW_DATES_SQL}) WHERE TRY_CAST(date AS DATE) IS NOT NULL",
)
def _(t):
    """Required columns and rows are checked before and after the date filter; then what is left is counted."""
    raw = names.require_rows(raw_dates(t))
    names.require_columns(raw, "o_orderkey", "date")
    kept = names.require_rows(checks.parse_dates(raw), "table after date parsing")
    return kept.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("date").alias("n_dates"))


@query(
    "p5_clamp_negatives",
    """SELECT c_custkey, c_name, c_nationkey, GREATEST(c_acctbal, 0) AS c_acctbal, c_mktsegment FROM customer""",
)
def _(t):
    return checks.clamp_negatives(t.customer)


@query("p6_numeric_projection", "SELECT o_orderkey, o_totalprice FROM orders")
def _(t):
    return checks.numeric_only(t.orders, exclude=["o_custkey"])


@query(
    "p7_column_roles",
    f"""WITH p AS ({ORDER_PANEL_SQL}) SELECT 'epidemiological' AS role, 'new_cases' AS column_name, COUNT(new_cases) AS present FROM p
        UNION ALL SELECT 'epidemiological', 'new_deaths', COUNT(new_deaths) FROM p
        UNION ALL SELECT 'outlier', 'new_cases', COUNT(new_cases) FROM p
        UNION ALL SELECT 'outlier', 'new_deaths', COUNT(new_deaths) FROM p""",
)
def _(t):
    """Columns per role with the number of values each holds."""
    panel = order_panel(t)
    roles = names.ColumnRoles.resolve(panel)
    groups = [("epidemiological", roles.epidemiological), ("socioeconomic", roles.socioeconomic),
              ("outlier", roles.outlier), ("vaccination", roles.vaccination)]
    found = [(role, c) for role, cols in groups for c in cols]
    counted = panel.agg(*[F.count(c).alias(f"n{i}") for i, (_, c) in enumerate(found)])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(role).alias("role"), F.lit(c).alias("column_name"), F.col(f"n{i}").alias("present"))
        for i, (role, c) in enumerate(found)
    ])))


@query(
    "p8_replace_sentinels",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, NULLIF(l_discount, 0) AS discount_or_null,
              CASE WHEN l_tax > 0 THEN ROUND(l_discount / l_tax, 6) END AS discount_per_tax
       FROM lineitem""",
)
def _(t):
    inf = F.when(F.col("l_tax") > 0, F.col("l_discount") / F.when(F.col("l_tax") > 0, F.col("l_tax")))
    raw = t.lineitem.withColumn("discount_per_tax", inf.otherwise(F.lit(float("inf"))))
    return raw.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        sc.zero_to_null("l_discount").alias("discount_or_null"),
        F.round(sc.finite_or_null("discount_per_tax"), 6).alias("discount_per_tax"),
    )


@query(
    "p9_drop_incomplete",
    f"""SELECT row_id, new_cases, new_deaths FROM ({GAPPY_PANEL_SQL})
        WHERE new_cases IS NOT NULL AND new_deaths IS NOT NULL""",
)
def _(t):
    return checks.drop_incomplete(gappy_panel(t), ["new_cases", "new_deaths"]).select("row_id", "new_cases", "new_deaths")


@query("p10_drop_missing_target", f"SELECT row_id, new_cases FROM ({GAPPY_PANEL_SQL}) WHERE new_cases IS NOT NULL")
def _(t):
    return checks.drop_incomplete(gappy_panel(t), ["new_cases"]).select("row_id", "new_cases")


@query(
    "p11_pick_target",
    """SELECT 'vaccination_rate' AS target, COUNT(*) AS n, ROUND(AVG(o_totalprice), 4) AS mean FROM orders
       UNION ALL SELECT 'o_orderkey', COUNT(*), ROUND(AVG(o_orderkey), 4) FROM orders""",
)
def _(t):
    """The preferred target where it exists, else the first numeric column; each with count and mean."""
    parts = []
    for df in (t.orders.withColumnRenamed("o_totalprice", "vaccination_rate"), t.orders):
        target = names.pick_target(df)
        parts.append(df.agg(F.count(target).alias("n"), F.round(F.avg(target), 4).alias("mean")).select(F.lit(target).alias("target"), "n", "mean"))
    return parts[0].unionByName(parts[1])


@query(
    "p12_labels_by_position",
    """WITH a AS (SELECT vec_id, ROW_NUMBER() OVER (ORDER BY vec_id) AS i FROM embeddings),
            b AS (SELECT c_custkey, c_nationkey, ROW_NUMBER() OVER (ORDER BY c_custkey) AS i FROM customer)
       SELECT c_custkey, a.vec_id FROM b LEFT JOIN a USING (i)""",
)
def _(t):
    joined = integrate.attach_labels_by_position(
        t.customer.select("c_custkey"), t.embeddings.select("vec_id"), ["c_custkey"], ["vec_id"]
    )
    return joined.select("c_custkey", "vec_id")


@query(
    "p12_row_index",
    "SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS row_index FROM orders",
)
def _(t):
    return integrate.with_row_index(t.orders, ["o_totalprice", "o_orderkey"]).select("o_orderkey", "row_index")


@query("p13_first_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 6049")
def _(t):
    return integrate.first_rows(t.orders.select("o_orderkey", "o_totalprice"), 6049, ["o_orderkey"])


# ------------------------------------------------------------------------------------------ joins

SHIP_PANEL_SQL = """
SELECT n_name AS location, CAST(l_shipdate AS DATE) AS date, l_suppkey, l_quantity AS doses, l_linenumber AS boosters
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""


def ship_rows(t):
    joined = (
        t.lineitem.select("l_suppkey", "l_shipdate", "l_quantity", "l_linenumber")
        .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation.select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return joined.select(
        F.col("n_name").alias("location"), F.col("l_shipdate").cast("date").alias("date"), "l_suppkey",
        F.col("l_quantity").alias("doses"), F.col("l_linenumber").alias("boosters"),
    )


@query(
    "j1_null_safe_left_join",
    f"""WITH g AS ({GAPPY_PANEL_SQL}),
             a AS (SELECT location, date, COUNT(*) AS n_orders, COUNT(new_cases) AS new_cases FROM g GROUP BY ALL)
        SELECT g.row_id, g.location, CAST(g.date AS VARCHAR) AS date, g.new_cases, a.n_orders, a.new_cases AS new_cases_vac
        FROM g LEFT JOIN a ON g.location IS NOT DISTINCT FROM a.location AND g.date IS NOT DISTINCT FROM a.date""",
)
def _(t):
    rows = gappy_panel(t).select("row_id", "location", "date", "new_cases")
    side = rows.groupBy("location", "date").agg(F.count("*").alias("n_orders"), F.count("new_cases").alias("new_cases"))
    return integrate.left_join_on_keys(rows, side, suffix="_vac").withColumn("date", text_date())


_ROLL_SQL = f"""WITH panel AS ({ORDER_PANEL_SQL}), ship AS ({SHIP_PANEL_SQL}),
     rolled AS (SELECT location, date, SUM(doses) AS age_doses, SUM(boosters)::BIGINT AS age_boosters
                FROM ship WHERE location IS NOT NULL AND date IS NOT NULL GROUP BY ALL)
SELECT p.location, CAST(p.date AS VARCHAR) AS date, p.new_cases, p.new_deaths, age_doses, age_boosters
FROM panel p LEFT JOIN rolled r ON p.location IS NOT DISTINCT FROM r.location AND p.date IS NOT DISTINCT FROM r.date"""


@query("j2_roll_up_by_age", _ROLL_SQL)
def _(t):
    joined = integrate.roll_up_and_join(order_panel(t), ship_rows(t).drop("l_suppkey"), "age_")
    return joined.withColumn("date", text_date())


@query("j3_roll_up_by_manufacturer", _ROLL_SQL.replace("age_", "manuf_"))
def _(t):
    joined = integrate.roll_up_and_join(order_panel(t), ship_rows(t).drop("l_suppkey"), "manuf_")
    return joined.withColumn("date", text_date())


@query(
    "j5_attach_labels",
    """SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def _(t):
    return integrate.attach_labels(t.documents.select("doc_id", "lang"), t.labels.select("doc_id", "quality"), "doc_id")


# ------------------------------------------------------------------------------------------ aggregates


@query(
    "a1_sum_by_key",
    f"""SELECT location, CAST(date AS VARCHAR) AS date, COALESCE(SUM(row_id), 0)::BIGINT AS row_id,
               ROUND(COALESCE(SUM(new_cases), 0), 2)::DOUBLE AS new_cases, ROUND(COALESCE(SUM(new_deaths), 0), 2)::DOUBLE AS new_deaths
        FROM ({GAPPY_PANEL_SQL}) WHERE location IS NOT NULL AND date IS NOT NULL GROUP BY location, date""",
)
def _(t):
    out = integrate.sum_by_key(gappy_panel(t))
    return out.select("location", text_date(), "row_id", r("new_cases", 2), r("new_deaths", 2))


@query(
    "a2_null_ratio",
    f"""WITH g AS ({GAPPY_PANEL_SQL})
        SELECT 'location' AS column_name, ROUND(1 - COUNT(location) * 1.0 / COUNT(*), 6)::DOUBLE AS null_ratio FROM g
        UNION ALL SELECT 'date', 0.0 UNION ALL SELECT 'row_id', 0.0
        UNION ALL SELECT 'new_cases', ROUND(1 - COUNT(new_cases) * 1.0 / COUNT(*), 6)::DOUBLE FROM g
        UNION ALL SELECT 'new_deaths', ROUND(1 - COUNT(new_deaths) * 1.0 / COUNT(*), 6)::DOUBLE FROM g""",
)
def _(t):
    return profile.null_ratios(gappy_panel(t)).select("column_name", r("null_ratio"))


_MEDIANS_SQL = f"""WITH g AS ({GAPPY_PANEL_SQL})
SELECT 'new_cases' AS "column", 0.5::DOUBLE AS prob, ROUND(QUANTILE_CONT(new_cases, 0.5), 6) AS value FROM g
UNION ALL SELECT 'new_deaths', 0.5, ROUND(QUANTILE_CONT(new_deaths, 0.5), 6) FROM g"""


@query("a3_median", _MEDIANS_SQL)
def _(t):
    return quantiles(gappy_panel(t), ["new_cases", "new_deaths"], [0.5]).withColumn("value", r("value"))


_QUANTILES_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {p}::DOUBLE AS prob, ROUND(QUANTILE_CONT({c}, {p}), 6)::DOUBLE AS value FROM lineitem"""
    for c in ("l_extendedprice", "l_discount", "l_quantity")
    for p in (0.25, 0.5, 0.75, 0.95)
)
_QUANTILE_COLUMNS = ["l_extendedprice", "l_discount", "l_quantity"]


@query("a4_quantiles", _QUANTILES_SQL)
def _(t):
    return quantiles(t.lineitem, _QUANTILE_COLUMNS, [0.25, 0.5, 0.75, 0.95]).withColumn("value", r("value"))


@query("a4_quantiles_by_selection", _QUANTILES_SQL)
def _(t):
    """Same answer with a sketch so coarse that each enclosure holds many values."""
    found = quantiles(t.lineitem, _QUANTILE_COLUMNS, [0.25, 0.5, 0.75, 0.95], accuracy=50)
    return found.withColumn("value", r("value"))


@query(
    "a4_quantiles_by_group",
    " UNION ALL ".join(
        f"""SELECT l_returnflag, '{c}' AS "column", {p}::DOUBLE AS prob, ROUND(QUANTILE_CONT({c}, {p}), 6)::DOUBLE AS value
            FROM lineitem GROUP BY l_returnflag"""
        for c in ("l_extendedprice", "l_tax") for p in (0.25, 0.75)
    ),
)
def _(t):
    found = quantiles(
        t.lineitem, ["l_extendedprice", "l_tax"], [0.25, 0.75], by=["l_returnflag"], accuracy=50
    )
    return found.withColumn("value", r("value"))


# ------------------------------------------------------------------------------------------ windows


def _panel_out(df, *cols, digits=6):
    return df.select("location", text_date(), *[r(c, digits) for c in cols])


_FILL_SQL = f"""SELECT row_id, CASE WHEN location IS NOT NULL THEN LAST_VALUE(new_deaths IGNORE NULLS) OVER
    (PARTITION BY location ORDER BY date, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS new_deaths
    FROM ({GAPPY_PANEL_SQL})"""


@query("w1_forward_fill", _FILL_SQL)
def _(t):
    return pw.forward_fill(gappy_panel(t), ORDERS_KEY, ["new_deaths"]).select("row_id", "new_deaths")


@query("w1_forward_fill_split_entity", _FILL_SQL)
def _(t):
    """Same result when every entity is cut into chunks."""
    return pw.forward_fill(gappy_panel(t), ORDERS_KEY, ["new_deaths"], max_rows=100).select("row_id", "new_deaths")


def _over(rows):
    return f"(PARTITION BY location ORDER BY date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


_ROLLING_SQL = "SELECT location, CAST(date AS VARCHAR) AS date, " + ", ".join(
    f"ROUND({fn}({c}) OVER {_over(n)}, 6)::DOUBLE AS {c}_rolling_{n}d_{tag}"
    for n in (7, 14, 30) for c in ("new_cases", "new_deaths") for fn, tag in (("AVG", "mean"), ("STDDEV_SAMP", "std"))
) + f" FROM ({ORDER_PANEL_SQL})"


def _rolling(t, **options):
    feats = [
        f(c, n) for n in (7, 14, 30) for c in ("new_cases", "new_deaths") for f in (pw.rolling_mean, pw.rolling_std)
    ]
    return _panel_out(pw.with_row_features(order_panel(t), KEY, feats, **options), *[f.name for f in feats])


@query("w2_w3_rolling_mean_std", _ROLLING_SQL)
def _(t):
    return _rolling(t)


@query("w2_w3_rolling_split_entity", _ROLLING_SQL)
def _(t):
    return _rolling(t, max_rows=40)


_LAG_SQL = "SELECT location, CAST(date AS VARCHAR) AS date, " + ", ".join(
    f"LAG({c}, {n}) OVER (PARTITION BY location ORDER BY date)::DOUBLE AS {c}_lag_{n}d"
    for n in (7, 14, 30) for c in ("new_cases", "new_deaths")
) + f" FROM ({ORDER_PANEL_SQL})"


@query("w4_lags", _LAG_SQL)
def _(t):
    feats = [pw.lagged(c, n) for n in (7, 14, 30) for c in ("new_cases", "new_deaths")]
    return _panel_out(pw.with_row_features(order_panel(t), KEY, feats), *[f.name for f in feats])


_ACC_SQL = f"""SELECT row_id, CASE WHEN location IS NOT NULL THEN ROUND((new_cases - LAG(new_cases, 1) OVER w)
    - (LAG(new_cases, 1) OVER w - LAG(new_cases, 2) OVER w), 4) END AS new_cases_acceleration
    FROM ({GAPPY_PANEL_SQL}) WINDOW w AS (PARTITION BY location ORDER BY date, row_id)"""


@query("w5_acceleration", _ACC_SQL)
def _(t):
    out = pw.with_row_features(gappy_panel(t), ORDERS_KEY, [pw.acceleration("new_cases")])
    return out.select("row_id", r("new_cases_acceleration", 4))


@query("w5_acceleration_split_entity", _ACC_SQL)
def _(t):
    out = pw.with_row_features(gappy_panel(t), ORDERS_KEY, [pw.acceleration("new_cases")], max_rows=64)
    return out.select("row_id", r("new_cases_acceleration", 4))


@query(
    "w6_strict_rolling_mean",
    f"""WITH daily AS (SELECT date, SUM(new_cases) AS new_cases FROM ({EVENT_PANEL_SQL}) GROUP BY date)
        SELECT CAST(date AS VARCHAR) AS date, new_cases::BIGINT AS new_cases,
               CASE WHEN COUNT(new_cases) OVER w = 7 THEN ROUND(AVG(new_cases) OVER w, 6) END::DOUBLE AS new_cases_ma_7
        FROM daily WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def _(t):
    out = explore.timeline(explore.daily_totals(event_panel(t), ["new_cases"]), ["new_cases"], 7)
    return out.select(text_date(), "new_cases", r("new_cases_ma_7"))


# ------------------------------------------------------------------------------------------ validation

_RAW_CASES_SQL = """
SELECT n_name AS country, CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date,
       o_orderkey, c_acctbal AS total_vaccinations
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def raw_cases(t):
    joined = (
        t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
        .join(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    text = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_orderdate").cast("date").cast("string"))
    return joined.select(
        F.col("n_name").alias("country"), text.alias("date"), "o_orderkey", F.col("c_acctbal").alias("total_vaccinations")
    )


_VALID_SQL = f"""SELECT country AS location, CAST(TRY_CAST(date AS DATE) AS VARCHAR) AS date, o_orderkey, {{}} AS total_vaccinations
                 FROM ({_RAW_CASES_SQL}) WHERE TRY_CAST(date AS DATE) IS NOT NULL"""


@query("v1_validate_cases", _VALID_SQL.format("total_vaccinations"))
def _(t):
    return checks.validate_cases(raw_cases(t)).withColumn("date", text_date())


@query("v2_validate_vaccinations", _VALID_SQL.format("GREATEST(total_vaccinations, 0)"))
def _(t):
    return checks.validate_vaccinations(raw_cases(t)).withColumn("date", text_date())


@query("v3_validate_by_age", _VALID_SQL.format("total_vaccinations"))
def _(t):
    return checks.validate_by_age(raw_cases(t)).withColumn("date", text_date())


@query("v4_validate_by_manufacturer", _VALID_SQL.format("total_vaccinations"))
def _(t):
    return checks.validate_by_manufacturer(raw_cases(t)).withColumn("date", text_date())


# ------------------------------------------------------------------------------------------ cleaning

# order rows with measures that carry gaps: gdp is absent for low priority, icu almost everywhere
DETAIL_SQL = """
SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS location,
       CAST(o_orderdate AS DATE) AS date, o_orderkey AS row_id,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS new_cases,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS new_deaths,
       CASE WHEN o_orderpriority <> '5-LOW' THEN c_acctbal END AS gdp_per_capita,
       c_custkey AS population,
       CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' THEN o_totalprice END AS weekly_icu,
       CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END AS people_vaccinated
FROM orders JOIN customer ON o_custkey = c_custkey"""


def detail_rows(t):
    joined = t.orders.join(t.customer.select("c_custkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey"))
    status, priority, price = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    return joined.select(
        F.when(priority != "1-URGENT", priority).alias("location"), F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_orderkey").alias("row_id"), F.when(status != "P", price).alias("new_cases"),
        F.when(status == "F", price).alias("new_deaths"), F.when(priority != "5-LOW", F.col("c_acctbal")).alias("gdp_per_capita"),
        F.col("c_custkey").alias("population"),
        F.when((status == "O") & (priority == "2-HIGH"), price).alias("weekly_icu"),
        F.when(status != "O", price).alias("people_vaccinated"),
    )


def _ffill(c):
    return (
        f"CASE WHEN location IS NOT NULL THEN LAST_VALUE({c} IGNORE NULLS) OVER (PARTITION BY location ORDER BY date, row_id "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END"
    )


_CLEAN_CASES_SQL = f"""WITH d AS ({DETAIL_SQL}),
f AS (SELECT location, date, row_id, {_ffill("new_cases")} AS new_cases, {_ffill("new_deaths")} AS new_deaths,
             gdp_per_capita, population, people_vaccinated FROM d),
q AS (SELECT QUANTILE_CONT(gdp_per_capita, 0.5) AS m, QUANTILE_CONT(new_cases, 0.25) AS a1, QUANTILE_CONT(new_cases, 0.75) AS a3,
             QUANTILE_CONT(new_deaths, 0.25) AS b1, QUANTILE_CONT(new_deaths, 0.75) AS b3 FROM f)
SELECT row_id, location, CAST(date AS VARCHAR) AS date,
       ROUND(CASE WHEN new_cases < a1 - 0.1 * (a3 - a1) THEN a1 - 0.1 * (a3 - a1)
                  WHEN new_cases > a3 + 0.1 * (a3 - a1) THEN a3 + 0.1 * (a3 - a1) ELSE new_cases END, 7) AS new_cases,
       ROUND(CASE WHEN new_deaths < b1 - 0.1 * (b3 - b1) THEN b1 - 0.1 * (b3 - b1)
                  WHEN new_deaths > b3 + 0.1 * (b3 - b1) THEN b3 + 0.1 * (b3 - b1) ELSE new_deaths END, 7) AS new_deaths,
       ROUND(COALESCE(gdp_per_capita, m), 4) AS gdp_per_capita, population, people_vaccinated
FROM f, q"""
def _clean_cases(t, **options):
    # the narrow factor makes the clip bite on these prices
    cleaner = clean.cases_cleaner(key=ORDERS_KEY, clip_factor=0.1, **options)
    out = cleaner.fit_transform(detail_rows(t))
    return out.select(
        "row_id", "location", text_date(), r("new_cases", 7), r("new_deaths", 7), r("gdp_per_capita", 4), "population", "people_vaccinated"
    )


@query("c7_clean_cases", _CLEAN_CASES_SQL)
def _(t):
    return _clean_cases(t)


@query("c7_clean_cases_at_scale", _CLEAN_CASES_SQL)
def _(t):
    """Split entities and exact selection instead of one window and one aggregate per column."""
    return _clean_cases(t, max_rows=500)


@query(
    "c1_drop_sparse_columns",
    f"""SELECT location, CAST(date AS VARCHAR) AS date, row_id, new_cases, new_deaths, gdp_per_capita, population, people_vaccinated
        FROM ({DETAIL_SQL})""",
)
def _(t):
    return clean.drop_sparse_columns(detail_rows(t)).withColumn("date", text_date())


@query(
    "c2_grouped_forward_fill",
    f"SELECT row_id, {_ffill('new_cases')} AS new_cases, {_ffill('people_vaccinated')} AS people_vaccinated FROM ({DETAIL_SQL})",
)
def _(t):
    out = pw.forward_fill(detail_rows(t), ORDERS_KEY, ["new_cases", "people_vaccinated"])
    return out.select("row_id", "new_cases", "people_vaccinated")


@query(
    "c3_median_impute",
    f"""WITH d AS ({DETAIL_SQL}), q AS (SELECT QUANTILE_CONT(gdp_per_capita, 0.5) AS m FROM d)
        SELECT row_id, ROUND(COALESCE(gdp_per_capita, m), 4) AS gdp_per_capita FROM d, q""",
)
def _(t):
    out = clean.median_impute(detail_rows(t), ["gdp_per_capita"])
    return out.select("row_id", r("gdp_per_capita", 4))


@query("c4_zero_impute", f"SELECT row_id, COALESCE(new_cases, 0) AS new_cases, COALESCE(weekly_icu, 0) AS weekly_icu FROM ({DETAIL_SQL})")
def _(t):
    return clean.zero_impute(detail_rows(t)).select("row_id", "new_cases", "weekly_icu")


@query(
    "c5_iqr_clip",
    """WITH q AS (SELECT QUANTILE_CONT(value, 0.25) AS q1, QUANTILE_CONT(value, 0.75) AS q3 FROM events)
       SELECT event_id, ROUND(CASE WHEN value > q3 + 3 * (q3 - q1) THEN q3 + 3 * (q3 - q1)
                                   WHEN value < q1 - 3 * (q3 - q1) THEN q1 - 3 * (q3 - q1) ELSE value END, 4) AS value
       FROM events, q""",
)
def _(t):
    return clean.iqr_clip(t.events, ["value"]).select("event_id", r("value", 4))


@query(
    "c6_iqr_outliers",
    """WITH q AS (SELECT QUANTILE_CONT(value, 0.25) AS q1, QUANTILE_CONT(value, 0.75) AS q3 FROM events)
       SELECT 'value' AS "column", ROUND(ANY_VALUE(q1 - 1.5 * (q3 - q1)), 6) AS lower_bound, ROUND(ANY_VALUE(q3 + 1.5 * (q3 - q1)), 6) AS upper_bound,
              COUNT(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers,
              ROUND(COUNT(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) * 100.0 / COUNT(value), 6)::DOUBLE AS outlier_pct
       FROM events, q""",
)
def _(t):
    out = clean.iqr_outliers(t.events, ["value"])
    return out.select("column", r("lower_bound"), r("upper_bound"), "outliers", r("outlier_pct"))


@query(
    "c8_clean_vaccinations",
    f"""SELECT row_id, location, CAST(date AS VARCHAR) AS date, COALESCE(new_cases, 0) AS new_cases, COALESCE(new_deaths, 0) AS new_deaths,
               COALESCE(gdp_per_capita, 0) AS gdp_per_capita, population, COALESCE({_ffill('people_vaccinated')}, 0) AS people_vaccinated
        FROM ({DETAIL_SQL})""",
)
def _(t):
    out = clean.vaccinations_cleaner(key=ORDERS_KEY).fit_transform(detail_rows(t)).withColumn("date", text_date())
    return out.select("row_id", "location", "date", "new_cases", "new_deaths", "gdp_per_capita", "population", "people_vaccinated")


@query(
    "c9_clean_by_age",
    f"""WITH d AS ({DETAIL_SQL}), q AS (SELECT QUANTILE_CONT(new_cases, 0.5) AS a, QUANTILE_CONT(new_deaths, 0.5) AS b,
               QUANTILE_CONT(gdp_per_capita, 0.5) AS c, QUANTILE_CONT(people_vaccinated, 0.5) AS e FROM d)
        SELECT row_id, ROUND(COALESCE(new_cases, a), 4) AS new_cases, ROUND(COALESCE(new_deaths, b), 4) AS new_deaths,
               ROUND(COALESCE(gdp_per_capita, c), 4) AS gdp_per_capita, population, ROUND(COALESCE(people_vaccinated, e), 4) AS people_vaccinated
        FROM d, q""",
)
def _(t):
    out = clean.by_age_cleaner().fit_transform(detail_rows(t))
    return out.select("row_id", r("new_cases", 4), r("new_deaths", 4), r("gdp_per_capita", 4), "population", r("people_vaccinated", 4))


@query(
    "c10_clean_by_manufacturer",
    f"""SELECT row_id, COALESCE(new_cases, 0) AS new_cases, COALESCE(new_deaths, 0) AS new_deaths,
               COALESCE(gdp_per_capita, 0) AS gdp_per_capita, population, COALESCE(people_vaccinated, 0) AS people_vaccinated
        FROM ({DETAIL_SQL})""",
)
def _(t):
    out = clean.by_manufacturer_cleaner().fit_transform(detail_rows(t))
    return out.select("row_id", "new_cases", "new_deaths", "gdp_per_capita", "population", "people_vaccinated")
