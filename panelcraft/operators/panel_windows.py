"""Row-frame windows over a panel: forward fill, rolling statistics, lags, second differences.

All expressions asked for in one call share one window specification, so Spark plans one exchange and one
sort. A window partition cannot be split by Spark itself; when one entity holds more than ``max_rows`` rows
it is cut here into consecutive chunks of bounded size. Every chunk also receives the few preceding rows its
frames can reach, so results are the same as with one window per entity.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from panelcraft.functions.columns import numeric_columns

MAX_ROWS = 5_000_000
SPLITS = 256


@dataclass(frozen=True)
class PanelKey:
    """Who and when. Name a ``tiebreak`` when (entity, date) repeats: without one the order of equal dates, and
    what row frames see there, is up to the shuffle."""

    entity: str = "location"
    date: str = "date"
    tiebreak: tuple[str, ...] = ()

    def rank(self) -> Column:
        """The order as one value. A bare date keeps ``max_by`` in a hash aggregate; a struct cannot."""
        return F.struct(self.date, *self.tiebreak) if self.tiebreak else F.col(self.date)

    def order(self) -> list[Column]:
        return [F.col(c).asc_nulls_last() for c in (self.date, *self.tiebreak)]


@dataclass(frozen=True)
class RowFeature:
    """A named expression over a window, and how many earlier rows it reads."""

    name: str
    reach: int
    build: Callable[[WindowSpec], Column]


def rolling_mean(column: str, rows: int, name: str | None = None) -> RowFeature:
    """Mean of the present values among the last ``rows`` rows."""
    return RowFeature(
        name or f"{column}_rolling_{rows}d_mean", rows - 1,
        lambda w: F.avg(column).over(w.rowsBetween(-(rows - 1), 0)),
    )


def rolling_std(column: str, rows: int, name: str | None = None) -> RowFeature:
    """Sample standard deviation; NULL with fewer than two present values."""
    return RowFeature(
        name or f"{column}_rolling_{rows}d_std", rows - 1,
        lambda w: F.stddev_samp(column).over(w.rowsBetween(-(rows - 1), 0)),
    )


def strict_rolling_mean(column: str, rows: int, name: str | None = None) -> RowFeature:
    """Mean of the last ``rows`` rows, NULL until all of them hold a value."""

    def build(w: WindowSpec) -> Column:
        frame = w.rowsBetween(-(rows - 1), 0)
        return F.when(F.count(column).over(frame) == rows, F.avg(column).over(frame))

    return RowFeature(name or f"{column}_ma_{rows}", rows - 1, build)


def lagged(column: str, rows: int, name: str | None = None) -> RowFeature:
    return RowFeature(name or f"{column}_lag_{rows}d", rows, lambda w: F.lag(column, rows).over(w))


def acceleration(column: str, name: str | None = None) -> RowFeature:
    """Difference of consecutive differences; the first two rows of an entity have none."""

    def build(w: WindowSpec) -> Column:
        one, two = F.lag(column, 1).over(w), F.lag(column, 2).over(w)
        return (F.col(column) - one) - (one - two)

    return RowFeature(name or f"{column}_acceleration", 2, build)


def largest_entity(df: DataFrame, entity: str) -> int:
    """Rows of the biggest entity: one map-side-combined count, one scalar back."""
    row = df.where(F.col(entity).isNotNull()).groupBy(entity).count().agg(F.max("count")).first()
    return row[0] or 0


def _is_hot(df: DataFrame, key: PanelKey, max_rows: int, check: bool) -> bool:
    return check and largest_entity(df, key.entity) > max_rows


def _window(key: PanelKey, *extra: str) -> WindowSpec:
    # rows without an entity never get a value, so they are spread by date instead of sharing one task
    spread = F.when(F.col(key.entity).isNull(), F.col(key.date))
    return Window.partitionBy(key.entity, *extra, spread).orderBy(*key.order())


def with_row_features(
    df: DataFrame, key: PanelKey, features: Sequence[RowFeature], max_rows: int = MAX_ROWS, check: bool = True
) -> DataFrame:
    """``df`` plus one column per feature; existing columns of the same name are replaced."""
    if not features:
        return df
    if not _is_hot(df, key, max_rows, check):
        return _project(df, key, features, _window(key))
    reach = max(f.reach for f in features)
    placed = _chunks(df, key, max(max_rows, reach + 1), reach)
    wide = _project(placed, key, features, _window(key, "_chunk"))
    names = {f.name for f in features}
    kept = [c for c in df.columns if c not in names] + [f.name for f in features]
    return wide.where("_own").select(*kept)


def _project(df: DataFrame, key: PanelKey, features: Sequence[RowFeature], window: WindowSpec) -> DataFrame:
    names = {f.name for f in features}
    known = F.col(key.entity).isNotNull()
    base = [F.col(c) for c in df.columns if c not in names]
    return df.select(*base, *[F.when(known, f.build(window)).alias(f.name) for f in features])


def forward_fill(
    df: DataFrame, key: PanelKey, columns: Sequence[str], max_rows: int = MAX_ROWS, check: bool = True
) -> DataFrame:
    """Carry the last present value forward inside each entity; leading gaps stay missing."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    known = F.col(key.entity).isNotNull()

    def filled(window: WindowSpec) -> dict[str, Column]:
        frame = window.rowsBetween(Window.unboundedPreceding, 0)
        return {c: F.when(known, F.last(c, ignorenulls=True).over(frame)) for c in columns}

    if not _is_hot(df, key, max_rows, check):
        new = filled(_window(key))
        return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])

    placed = _chunks(df, key, max_rows, 0)
    order = key.rank()
    tails = placed.where(known).groupBy(key.entity, "_chunk").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(f"_tail_{c}") for c in columns]
    )
    earlier = Window.partitionBy(key.entity).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select(
        F.col(key.entity).alias("_e"), F.col("_chunk").alias("_c"),
        *[F.last(f"_tail_{c}", ignorenulls=True).over(earlier).alias(f"_carry_{c}") for c in columns],
    )
    new = filled(_window(key, "_chunk"))
    inside = placed.select(
        "_chunk", *[new[c].alias(c) if c in new else F.col(c) for c in df.columns]
    )
    joined = inside.join(carry, (F.col(key.entity) == F.col("_e")) & (F.col("_chunk") == F.col("_c")), "left")
    return joined.select(
        *[F.coalesce(F.col(c), F.col(f"_carry_{c}")).alias(c) if c in new else F.col(c) for c in df.columns]
    )


def _chunks(df: DataFrame, key: PanelKey, max_rows: int, reach: int) -> DataFrame:
    """Rows with a ``_chunk`` number inside their entity, plus copies (``_own`` false) of the rows that a
    later chunk can look back to.

    Cells are (entity, date); a cell that is itself too big is first cut by ranges of its leading tiebreak.
    Only cell counts are ordered, never the rows. Entities are cut at cell borders.
    """
    split = _split_cells(df, key, max_rows)
    cell = [key.entity, key.date, "_part"]
    cells = split.where(F.col(key.entity).isNotNull()).groupBy(*cell).agg(F.count("*").alias("_n"))
    run = Window.partitionBy(key.entity).orderBy(F.col(key.date).asc_nulls_last(), "_part")
    sized = cells.withColumn("_start", F.coalesce(F.sum("_n").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    sized = sized.withColumn("_chunk", F.floor(F.col("_start") / F.lit(max_rows)))
    # chunk numbers follow start offsets, so at most two later chunks begin within ``reach`` <= max_rows rows
    heads = Window.partitionBy(key.entity).orderBy("_chunk")
    chunk_heads = sized.groupBy(key.entity, "_chunk").agg(F.min("_start").alias("_head"))
    chunk_heads = chunk_heads.select(
        F.col(key.entity).alias("_e"), F.col("_chunk").alias("_c"),
        *[F.lead(c, i).over(heads).alias(f"{c}{i}") for i in (1, 2) for c in ("_chunk", "_head")],
    )
    ends = F.col("_start") + F.col("_n") + F.lit(reach)
    targets = F.array_compact(
        F.array(F.col("_chunk"), *[F.when(F.col(f"_head{i}") < ends, F.col(f"_chunk{i}")) for i in (1, 2)])
    )
    located = sized.join(
        chunk_heads, (F.col(key.entity) == F.col("_e")) & (F.col("_chunk") == F.col("_c"))
    ).select(
        F.col(key.entity).alias("_ke"), F.col(key.date).alias("_kd"), F.col("_part").alias("_kp"),
        targets.alias("_targets"),
    )
    rows = split.join(
        located,
        F.col(key.entity).eqNullSafe(F.col("_ke"))
        & F.col(key.date).eqNullSafe(F.col("_kd"))
        & (F.col("_part") == F.col("_kp")),
        "left",
    )
    return rows.select(*df.columns, F.posexplode_outer("_targets").alias("_pos", "_chunk")).select(
        *df.columns, "_chunk", (F.coalesce(F.col("_pos"), F.lit(0)) == 0).alias("_own")
    )


def _split_cells(df: DataFrame, key: PanelKey, max_rows: int) -> DataFrame:
    """Adds ``_part``: 0, or the tiebreak range of a row whose (entity, date) alone exceeds ``max_rows``."""
    ties = [c for c in key.tiebreak[:1] if c in numeric_columns(df)]
    cells = df.where(F.col(key.entity).isNotNull()).groupBy(key.entity, key.date).count()
    big = cells.where(F.col("count") > max_rows).select(F.col(key.entity).alias("_be"), F.col(key.date).alias("_bd"))
    if not ties or big.isEmpty():
        return df.withColumn("_part", F.lit(0))
    on = F.col(key.entity).eqNullSafe(F.col("_be")) & F.col(key.date).eqNullSafe(F.col("_bd"))
    cuts = F.array(*[F.lit(i / SPLITS) for i in range(1, SPLITS)])
    bounds = (
        df.select(key.entity, key.date, ties[0]).join(big, on, "left_semi")
        .groupBy(F.col(key.entity).alias("_be"), F.col(key.date).alias("_bd"))
        .agg(F.percentile_approx(ties[0], cuts, 10_000).alias("_cuts"), F.count("*").alias("_rows"))
    )
    # about half of max_rows in a part: a row is compared with no more bounds than its cell needs
    parts = F.least(F.lit(SPLITS), F.ceil(F.col("_rows") * 2 / F.lit(max_rows)).cast("int"))
    chosen = F.transform(F.sequence(F.lit(1), parts - 1), lambda i: F.element_at("_cuts", F.floor(i * SPLITS / parts).cast("int")))
    bounds = bounds.select("_be", "_bd", chosen.alias("_bounds"))
    joined = df.join(bounds, on, "left")
    part = F.size(F.filter("_bounds", lambda b: b <= F.col(ties[0])))
    return joined.select(*df.columns, F.when(F.col("_bounds").isNull(), 0).otherwise(part).alias("_part"))


def latest_per_entity(df: DataFrame, key: PanelKey, columns: Sequence[str]) -> DataFrame:
    """Last present value of every column, each column on its own; map-side combined, so no hot entity."""
    order = key.rank()
    return df.where(F.col(key.entity).isNotNull()).groupBy(key.entity).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns]
    )


def expand_features(columns: Sequence[str], present: Sequence[str], windows: Sequence[int], lags: Sequence[int]) -> list[RowFeature]:
    """Rolling mean and std, lags and acceleration for those of ``columns`` that exist."""
    names = [c for c in columns if c in present]
    out: list[RowFeature] = []
    for rows in windows:
        for c in names:
            out += [rolling_mean(c, rows), rolling_std(c, rows)]
    out += [lagged(c, rows) for rows in lags for c in names]
    return out + [acceleration(c) for c in names]
