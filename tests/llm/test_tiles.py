"""Pairs of tiles are read side by side: what is shuffled or stored does not grow with the pairs."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from panelcraft.llm import vectors
from panelcraft.session import ensure_checkpoint_dir


def held(folder: str) -> int:
    return sum(f.stat().st_size for f in Path(folder.removeprefix("file:")).rglob("*") if f.is_file())


def test_pairs_of_tiles_are_not_shuffled(spark, monkeypatch):
    plans = []
    paired = vectors._pairs_of_tiles
    monkeypatch.setattr(vectors, "_pairs_of_tiles", lambda *a: plans.append(paired(*a)) or plans[-1])
    x = np.random.default_rng(3).normal(size=(400, 16)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    vectors.link_embeddings(df, tile=16).count()
    text = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in text and "Exchange" not in text
    assert plans[0].count() > 200  # pairs, of some 25 tiles


def test_what_is_stored_grows_with_the_vectors(spark):
    """Four times the vectors, sixteen times the pairs of tiles: about four times the bytes."""
    rng = np.random.default_rng(4)
    ensure_checkpoint_dir(spark)
    folder, sizes = spark.sparkContext.getCheckpointDir(), []
    for n in (1_000, 4_000):
        x = rng.normal(size=(n, 32)).astype(np.float32)
        path = os.path.join(folder, f"vectors-{n}")
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(8).write.parquet(path)
        before = held(folder)
        assert vectors.link_embeddings(spark.read.parquet(path), tile=32).count() == n
        sizes.append(held(folder) - before)
    assert sizes[1] < 4 * 4_000 * 32 * 4 and sizes[1] < 8 * sizes[0]


def test_repeated_keys_and_multiples(spark):
    """A multiple of a vector equals it as a unit vector; rows of one key share their results."""
    rows = [(1, [1.0, 2.0, 0.5]), (2, [2.0, 4.0, 1.0]), (2, [0.0, 0.0, 1.0]), (3, [0.0, 0.01, 1.0]), (4, [-1.0, 0.0, 0.0])]
    got = vectors.link_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = {(r["vec_id"], r["component_id"], r["n_copies"]) for r in got.collect()}
    assert got.count() == 5 and {r[0] for r in found} == {1, 2, 3, 4}
    assert (1, 1, 2) in found and (4, 4, 1) in found and (3, 2, 1) in found
    assert got.where(F.col("vec_id") == 2).select("component_id", "n_links").distinct().count() == 1
