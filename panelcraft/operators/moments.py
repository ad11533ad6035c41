"""Counts, sums and products of all pairs of columns in one pass: what correlations, fits and covariances come from."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.functions.scalars import finite_or_null

#: A spread below this share of the squared values is rounding, and counts as none.
ROUNDING = 1e-13


@dataclass
class PairMoments:
    """``n[i, j]`` rows that have both columns; over them ``total[i, j]`` sums column i, ``squares[i, j]`` its squares and
    ``products[i, j]`` the products, all about ``origin``."""

    columns: list[str]
    origin: np.ndarray
    n: np.ndarray
    total: np.ndarray
    squares: np.ndarray
    products: np.ndarray

    def spread(self) -> np.ndarray:
        """[i, j]: squared deviations of column i over the rows that have both; 0 where only rounding is left."""
        found = self.squares - self.total**2 / np.maximum(self.n, 1)
        return np.where(found > ROUNDING * self.squares, found, 0.0)

    def shared(self) -> np.ndarray:
        return self.products - self.total * self.total.T / np.maximum(self.n, 1)

    def covariance(self) -> np.ndarray:
        """Sample covariances over pairwise-complete rows; NaN with fewer than two."""
        return np.where(self.n > 1, self.shared() / np.maximum(self.n - 1, 1), np.nan)

    def r(self) -> np.ndarray:
        """Pearson's r over pairwise-complete rows, NaN where a column has no spread."""
        spread = self.spread()
        scale = np.sqrt(spread * spread.T)
        return np.where(scale > 0, np.clip(self.shared() / np.where(scale > 0, scale, 1.0), -1.0, 1.0), np.nan)

    def fit(self, x: str, y: str) -> tuple[int, float | None, float | None, float | None]:
        """(rows, slope, intercept, r) of the least-squares line of ``y`` over ``x``; None without spread in ``x``."""
        i, j = self.columns.index(x), self.columns.index(y)
        n, spread, r = int(self.n[i, j]), self.spread()[i, j], self.r()[i, j]
        if not spread > 0:
            return n, None, None, None
        slope = self.shared()[i, j] / spread
        level = self.origin[j] + self.total[j, i] / n - slope * (self.origin[i] + self.total[i, j] / n)
        return n, float(slope), float(level), None if np.isnan(r) else float(r)


def pair_moments(df: DataFrame, columns: Sequence[str]) -> PairMoments:
    """One scan for the means, about which values are summed, and one for the products: each task multiplies whole Arrow
    batches and returns one row per column, whatever it read. Missing, NaN and infinite values take no part."""
    columns, p = list(columns), len(columns)
    values = df.select(*[finite_or_null(c).alias(f"c{i}") for i, c in enumerate(columns)])
    means = values.agg(*[F.avg(f"c{i}").alias(f"m{i}") for i in range(p)]).first()
    origin = np.array([m or 0.0 for m in means])

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((p, 4 * p))
        for b in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns], axis=1)
            there = ~np.isnan(x)
            x, there = np.where(there, x - origin, 0.0), there.astype(float)
            sums += np.concatenate([there.T @ there, x.T @ there, (x**2).T @ there, x.T @ x], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(p), pa.int32()), pa.array(list(sums), pa.list_(pa.float64()))], names=["at", "sums"])

    found = values.mapInArrow(job, "at int, sums array<double>").groupBy("at").agg(Summarizer.sum(array_to_vector("sums")).alias("sums"))
    out = np.zeros((p, 4 * p))
    for r in found.select("at", vector_to_array("sums").alias("sums")).collect():  # one row per column
        out[r["at"]] = r["sums"]
    return PairMoments(columns, origin, *np.split(out, 4, axis=1))
