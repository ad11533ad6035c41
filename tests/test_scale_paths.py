"""The paths meant for big or skewed inputs must agree with the plain ones."""

from datetime import date, timedelta
from types import SimpleNamespace

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelcraft.operators import panel_windows as pw
from panelcraft.operators import splits, tuning
from panelcraft.operators.clean import quantile_table
from panelcraft.operators.panel_windows import PanelKey
from panelcraft.session import kept
from panelcraft.sources.csv_records import csv_records


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-3, 3).map(float), st.floats(-1e6, 1e6)), min_size=1, max_size=300))
def test_selection_equals_interpolated_quantiles(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    found = quantile_table(df, ["x"], [0.0, 0.25, 0.5, 0.95, 1.0], accuracy=7)["x"]
    for p, v in found.items():
        assert v == pytest.approx(np.quantile(xs, p), rel=1e-9, abs=1e-9)


def test_selection_with_a_heavy_value_and_groups(spark):
    rng = np.random.default_rng(1)
    xs = np.concatenate([np.full(4000, 5.0), rng.normal(5, 1e-3, 3000), rng.exponential(100, 3000)])
    df = spark.createDataFrame([(int(i % 3), float(x)) for i, x in enumerate(xs)], "g int, x double")
    found = quantile_table(df.where("g = 1"), ["x"], [0.1, 0.4, 0.6, 0.99], accuracy=20)["x"]
    for p, v in found.items():
        assert v == pytest.approx(np.quantile(xs[1::3], p), rel=1e-9)


def hot_panel(spark):
    """One entity with most rows, one of its dates with a third of them, gaps and a missing entity."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(900):
        entity = "hot" if i % 10 else "cold"
        day = date(2021, 1, 1) + timedelta(days=7 if i % 3 == 0 else int(rng.integers(0, 60)))
        rows.append((entity if i % 50 else None, day, i, float(i % 17) if i % 4 else None))
    return spark.createDataFrame(rows, "location string, date date, k long, x double")


KEY = PanelKey(tiebreak=("k",))
FEATURES = [pw.rolling_mean("x", 30), pw.rolling_std("x", 7), pw.lagged("x", 14), pw.acceleration("x")]


@pytest.mark.parametrize("max_rows", [1, 31, 40, 100, 5000])
def test_split_entity_keeps_window_results(spark, max_rows):
    df = hot_panel(spark)
    plain = pw.with_row_features(df, KEY, FEATURES, check=False).orderBy("k").collect()
    assert pw.with_row_features(df, KEY, FEATURES, max_rows=max_rows).orderBy("k").collect() == plain


@pytest.mark.parametrize("max_rows", [1, 25, 200])
def test_split_entity_keeps_forward_fill(spark, max_rows):
    df = hot_panel(spark)
    plain = pw.forward_fill(df, KEY, ["x"], check=False).orderBy("k").collect()
    assert pw.forward_fill(df, KEY, ["x"], max_rows=max_rows).orderBy("k").collect() == plain


def test_chunks_are_bounded(spark):
    df = hot_panel(spark).where("location is not null")
    placed = pw._chunks(df, KEY, 40, 30)
    own = placed.where("_own").groupBy("location", "_chunk").count().agg(F.max("count")).first()[0]
    assert own < 120  # a cell may be as big as its part
    assert placed.where("_own").count() == df.count()


def test_hash_thresholds_do_not_depend_on_ranking_size(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("c"))
    assert splits.hash_thresholds(df, "c", "k", [0.2, 0.5]) == splits.hash_thresholds(df, "c", "k", [0.2, 0.5], ranked_rows=1)


def test_one_exchange_for_all_row_features(spark):
    df = hot_panel(spark)
    out = pw.with_row_features(df, KEY, FEATURES, check=False)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    executed = out._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 1 and plan.count("Window ") <= len({1, 2, 3})


def test_training_rows_lie_on_all_cores(spark):
    """A narrow table is read in few parts: before, a training kept those, and left the other cores idle."""
    cores = spark.sparkContext.defaultParallelism
    few = spark.range(0, 900, 1, 1).select("id", F.rand(1).alias("x"))
    with kept(few) as rows:
        assert rows.rdd.getNumPartitions() == cores and rows.storageLevel.useMemory
        sizes = rows.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(sizes) == cores and max(r["count"] for r in sizes) < 2 * 900 / cores
        assert sorted(rows.collect()) == sorted(few.collect())
    assert not rows.storageLevel.useMemory and not few.storageLevel.useMemory
    mine = spark.range(50).persist()
    with kept(mine) as rows:
        assert rows is mine
    assert mine.storageLevel.useMemory  # what the caller keeps stays kept
    mine.unpersist()


@pytest.mark.parametrize("train", ["grid_search", "cross_val_score"])
def test_trainings_spread_their_rows(spark, monkeypatch, train):
    seen = []
    monkeypatch.setattr(tuning, "cross_validate", lambda e, g, v, df, *a: seen.append(df.rdd.getNumPartitions()) or SimpleNamespace(avgMetrics=[1.0], stdMetrics=[0.0], bestModel=None))
    few = spark.range(0, 90, 1, 1).withColumn("fold", (F.col("id") % 3).cast("int"))
    args = (None, [{}], None, few) if train == "grid_search" else (None, None, few)
    getattr(tuning, train)(*args)
    assert seen == [spark.sparkContext.defaultParallelism]


def test_csv_lines_pass_through_python_once(spark, tmp_path):
    """Before, the states of all lines were worked out three times: for the splits, the whole and the broken records."""
    (tmp_path / "a.csv").write_text('a,"b\nc"\nd,e\n\n"f ""g""\n\nh",i\n')
    found = csv_records(spark, str(tmp_path / "a.csv"))
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()
    assert [r["value"] for r in found.orderBy("block", "record").collect()] == ['a,"b\nc"', "d,e", '"f ""g""\n\nh",i']
