"""Pair moments against numpy over pairwise-complete rows."""

import math

import numpy as np
import pytest

from panelcraft.operators import explore
from panelcraft.operators.moments import pair_moments


def table(rows=400, width=80, seed=6):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, width)) @ rng.normal(size=(width, width)) + 1e6 * rng.normal(size=width)  # far from zero
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 3] = 7.25  # no spread
    x[:, 5] = np.nan  # no value
    return x


def frame(spark, x):
    rows = [[None if math.isnan(v) else float(v) for v in p] for p in x]
    return spark.createDataFrame(rows, ", ".join(f"x{i} double" for i in range(x.shape[1])))


def pair(x, i, j):
    both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
    return x[both, i], x[both, j]


def test_wide_correlations_equal_pairwise_complete_ones(spark):
    x = table()
    df = frame(spark, x).repartition(6)
    found = explore.correlations(df, df.columns)
    assert "Generate" not in found._jdf.queryExecution().toString()  # no row is unfolded
    rows = found.collect()
    assert len(rows) == 80 * 79 // 2
    for r in rows:
        i, j = int(r["var1"][1:]), int(r["var2"][1:])
        if {i, j} & {3, 5}:
            assert r["r"] is None
        else:
            assert r["r"] == pytest.approx(np.corrcoef(*pair(x, i, j))[0, 1], abs=1e-7)


def test_fits_and_covariances(spark):
    x = table(width=8)
    found = pair_moments(frame(spark, x), [f"x{i}" for i in range(8)])
    a, b = pair(x, 0, 1)
    slope, level = np.polyfit(a - a.mean(), b, 1)
    n, s, c, r = found.fit("x0", "x1")
    assert (n, s) == (len(a), pytest.approx(slope, rel=1e-6)) and c == pytest.approx(level - slope * a.mean(), rel=1e-6)
    assert found.covariance()[0, 1] == pytest.approx(np.cov(a, b)[0, 1], rel=1e-6)
    assert found.fit("x3", "x0")[1:] == (None, None, None) and found.fit("x5", "x0")[0] == 0


def test_study_and_odd_tables(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5), (2.0, 4.0, None), (float("nan"), 1.0, 7), (float("inf"), 1.0, 7)], "a double, b double, c int")
    rows = {(r["part"], r["var1"], r["var2"]): r for r in explore.correlation_study(df, ["a", "b"], [("a", "b"), ("a", "gone")]).collect()}
    assert len(rows) == 6 and rows["fit", "a", "b"]["slope"] == pytest.approx(2.0) and rows["fit", "a", "b"]["n"] == 2
    assert rows["strong", "a", "b"]["r"] == pytest.approx(1.0) and rows["matrix", "a", "a"]["n"] == 2
    empty = {r["r"] for r in explore.correlation_study(df.limit(0), ["a", "c"]).collect()}
    assert empty == {1.0, None}
