"""Quantiles of few groups: the rows of a group must not meet in one task."""

import pytest
from pyspark.sql import functions as F

from panelcraft.operators import quantiles as q


def _table(spark):
    return spark.range(0, 3000, 1, 8).select((F.col("id") % 3).alias("g"), F.xxhash64("id").cast("double").alias("x"))


@pytest.fixture
def joins_by_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("sent, name", [(q.SENT, "BroadcastHashJoin"), (0, "SortMergeJoin")])
def test_limits_of_few_groups_go_to_the_rows(spark, monkeypatch, joins_by_shuffle, sent, name):
    monkeypatch.setattr(q, "SENT", sent)
    df = _table(spark)
    found = q.quantiles(df, ["x"], [0.25, 0.5], by=["g"], accuracy=50)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"{name} [coalesce(__g0" in plan
    want = {(r["g"], p): v for r in df.groupBy("g").agg(F.percentile("x", F.array(F.lit(0.25), F.lit(0.5))).alias("v")).collect() for p, v in zip((0.25, 0.5), r["v"])}
    got = {(r["g"], r["prob"]): r["value"] for r in found.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
