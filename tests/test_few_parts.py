"""Every task of a pass reports to the driver: their number must not follow the parts of the input."""

import numpy as np
from pyspark.sql import functions as F

from panelcraft.operators import kmeans
from panelcraft.session import PARTS_A_CORE, in_few_parts


def test_passes_run_in_few_parts(spark, monkeypatch):
    most = PARTS_A_CORE * spark.sparkContext.defaultParallelism
    x = np.concatenate([np.random.default_rng(0).normal(c, 0.2, (150, 2)) for c in (0, 5, 9)])
    df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").repartition(3 * most).persist()
    seen, sums = [], kmeans._sums
    monkeypatch.setattr(kmeans, "_sums", lambda rows, centres: seen.append(rows.rdd.getNumPartitions()) or sums(rows, centres))
    fit = kmeans.fit_many(df, "v", [3], 2, 1)[3]
    df.unpersist()
    assert seen and max(seen) <= most
    assert sorted(fit.sizes) == [150, 150, 150] and np.allclose(sorted(fit.means[:, 0]), sorted(x[i : i + 150, 0].mean() for i in (0, 150, 300)))


def test_few_parts_hold_all_rows(spark):
    few = in_few_parts(spark.range(0, 1000, 1, 500))
    assert few.rdd.getNumPartitions() == PARTS_A_CORE * spark.sparkContext.defaultParallelism
    assert few.agg(F.sum("id")).first()[0] == 499500
    assert in_few_parts(spark.range(0, 10, 1, 2)).rdd.getNumPartitions() == 2
