"""Registry and the panels that the queries derive from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy access to the parquet tables of one scale."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def r(c, digits: int = 6):
    """Rounded double under the column's own name, so both engines agree on the last digits."""
    return F.round(F.col(c).cast("double"), digits).alias(c)


def text_date(c: str = "date"):
    return F.col(c).cast("string").alias(c)


# --- panels, and the same panels as SQL -------------------------------------------------------------------

EVENT_PANEL_SQL = """
SELECT event_type AS location, CAST(ts AS DATE) AS date, COUNT(*) AS new_cases,
       SUM(CASE WHEN value > 100 THEN 1 ELSE 0 END)::BIGINT AS new_deaths
FROM events GROUP BY event_type, CAST(ts AS DATE)"""


def event_panel(t: Tables) -> DataFrame:
    """One row per event type and day."""
    return t.events.groupBy(F.col("event_type").alias("location"), F.col("ts").cast("date").alias("date")).agg(
        F.count("*").alias("new_cases"), F.count_if(F.col("value") > 100).alias("new_deaths")
    )


ORDER_PANEL_SQL = """
SELECT n_name AS location, CAST(o_orderdate AS DATE) AS date, COUNT(*) AS new_cases,
       NULLIF(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END), 0)::BIGINT AS new_deaths
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name, CAST(o_orderdate AS DATE)"""


def order_panel(t: Tables) -> DataFrame:
    """One row per nation and order day, with gaps in the dates; days without a finished order have no
    ``new_deaths`` value."""
    joined = (
        t.orders.select("o_custkey", "o_orderdate", "o_orderstatus")
        .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    finished = F.count_if(F.col("o_orderstatus") == "F")
    return joined.groupBy(F.col("n_name").alias("location"), F.col("o_orderdate").cast("date").alias("date")).agg(
        F.count("*").alias("new_cases"), F.when(finished != 0, finished).alias("new_deaths")
    )


# rows with a missing entity, from orders of high priority
GAPPY_PANEL_SQL = """
SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS location,
       CAST(o_orderdate AS DATE) AS date, o_orderkey AS row_id,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS new_cases,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS new_deaths
FROM orders"""


def gappy_panel(t: Tables) -> DataFrame:
    """Orders as panel rows: repeated dates (``row_id`` breaks ties), missing entities, missing measures."""
    return t.orders.select(
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")).alias("location"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_orderkey").alias("row_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("new_cases"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("new_deaths"),
    )
