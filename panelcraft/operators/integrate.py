"""Roll-ups and null-safe left joins that build the master panel."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcraft.functions.columns import numeric_columns
from panelcraft.session import cut_lineage

KEYS = ("location", "date")


def sum_by_key(df: DataFrame, keys: Sequence[str] = KEYS, columns: Sequence[str] | None = None, prefix: str = "") -> DataFrame:
    """Sum of every numeric column per key. Rows with a missing key are left out; an all-missing sum is 0."""
    names = numeric_columns(df, exclude=keys) if columns is None else list(columns)
    present = df.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    return present.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"{prefix}{c}") for c in names])


def left_join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str] = KEYS, suffix: str = "_right") -> DataFrame:
    """Left join where a missing key matches a missing key; overlapping right columns get ``suffix``.

    Null-safe equality is still an equi-join, so Spark picks broadcast or sort-merge and can split skew.
    """
    taken = set(left.columns)
    carried = [(c, f"{c}{suffix}" if c in taken else c) for c in right.columns if c not in keys]
    side = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[F.col(c).alias(n) for c, n in carried])
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return left.join(side, on, "left").drop(*[f"__{k}" for k in keys])


def roll_up_and_join(left: DataFrame, detail: DataFrame, prefix: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Sum a finer-grained table to the keys, then left join it; unchanged when keys or measures are absent."""
    if any(k not in detail.columns for k in keys) or not numeric_columns(detail, exclude=keys):
        return left
    # null-safe like the join before it: the wide left side then keeps its partitioning and moves only once
    return left_join_on_keys(left, sum_by_key(detail, keys, prefix=prefix), keys)


def integrate(cases: DataFrame, vaccinations: DataFrame, by_age: DataFrame, by_manufacturer: DataFrame) -> DataFrame:
    """Master panel: cases, then vaccinations, then both roll-ups, all by (location, date)."""
    master = left_join_on_keys(cases, vaccinations, suffix="_vac")
    master = roll_up_and_join(master, by_age, "age_")
    return roll_up_and_join(master, by_manufacturer, "manuf_")


def attach_labels(df: DataFrame, labels: DataFrame, row_key: str, how: str = "left") -> DataFrame:
    """Cluster labels joined by row key (never by position)."""
    return df.join(labels, row_key, how)


def attach_labels_by_position(df: DataFrame, labels: DataFrame, order: Sequence[str], label_order: Sequence[str]) -> DataFrame:
    """Parity mode: the i-th row of one table meets the i-th row of the other, under explicit orders."""
    left = with_row_index(df, order, "__i")
    right = with_row_index(labels, label_order, "__i")
    return left.join(right, "__i", "left").drop("__i")


def with_row_index(
    df: DataFrame, order: Sequence[str], name: str = "row_index", store: Callable[[DataFrame], DataFrame] = cut_lineage
) -> DataFrame:
    """0-based position in a total order, stored once (``store``) so that it cannot change.

    A global sort spreads the rows over range partitions; positions inside each are shifted by the row counts
    of the partitions before it, a table with one row per partition. Rows move once.
    """
    bits = 33  # the generated id is (partition << 33) + position in the partition
    numbered = store(df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("__id", bits)
    before = Window.partitionBy().orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered.groupBy(part.alias("__part")).count().select(
        "__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before")
    )
    joined = numbered.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    position = F.col("__before") + F.col("__id").bitwiseAND(F.lit((1 << bits) - 1))
    return joined.select(*df.columns, position.alias(name))


def first_rows(df: DataFrame, rows: int, order: Sequence[str]) -> DataFrame:
    """The first ``rows`` rows of an explicit order (top-k per partition, then merged)."""
    return df.orderBy(*order).limit(rows)
