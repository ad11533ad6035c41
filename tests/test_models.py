"""Model builders and flows on a small three-class fixture."""

import inspect
from functools import partial

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import __spark_entry__ as entry
from panel_queries import modeling
from panelcraft.operators import clustering, experiments, metrics, models, splits, tuning
from panelcraft.plans import flows


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(240, 3))
    score = x[:, 0] + 0.5 * x[:, 1]
    level = np.where(score < -0.5, "Low", np.where(score < 0.5, "Medium", "High"))
    data = [(i, *map(float, p), str(c), float(10 + 3 * p[0] - 2 * p[1])) for i, (p, c) in enumerate(zip(x, level))]
    return spark.createDataFrame(data, "row_key long, a double, b double, c double, preparedness_level string, target double").cache()


@pytest.fixture(scope="module")
def ready(rows):
    coded = splits.label_indexer(rows, "preparedness_level").transform(rows)
    assembled = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(coded)
    return splits.with_stratified_folds(assembled, "row_key", "preparedness_level", 2).cache()


@pytest.mark.parametrize(
    "train",
    [
        partial(models.train_logistic, max_iter=30, folds=2),
        partial(models.train_random_forest, trees=5, depth=4, folds=2),
        partial(models.train_boosted_subspace, trees=2, depth=2, folds=2),
        partial(models.train_gradient_boosting, trees=2, depth=2, folds=2),
        partial(models.train_kernel_svm, size=64, max_iter=10, folds=2),
    ],
)
def test_classifier_learns_and_gives_probabilities(ready, train):
    tuned = train(ready)
    out = tuned.model.transform(ready)
    p = out.select("label", "prediction", models.class_probabilities(out).alias("p"))
    sums = p.select(F.aggregate("p", F.lit(0.0), lambda t, x: t + x).alias("s"), F.size("p").alias("n")).distinct().collect()
    assert all(r["s"] == pytest.approx(1.0) and r["n"] == 3 for r in sums)
    assert metrics.classification_metrics(p, "label", "prediction").first()["accuracy"] > 0.7
    assert 0 < tuned.best_score <= 1 and tuned.cv_std >= 0


def test_ridge_equals_closed_form(spark, ready):
    data = ready.select("features", F.col("target").alias("label"), "a", "b", "c").cache()
    x = data.select("a", "b", "c").toPandas().to_numpy()
    y = data.select("label").toPandas()["label"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 50 * np.eye(3), xc.T @ yc)
    assert models.ridge(data, alpha=50.0).fit(data).coefficients.toArray() == pytest.approx(want, rel=1e-6)
    assert models.linear().fit(data).coefficients.toArray() == pytest.approx([3, -2, 0], abs=1e-6)


def test_one_point_grid_has_no_spread(ready):
    data = ready.withColumn("label", F.col("target"))
    tuned = models.train_linear(data, folds=2)
    assert tuned.spread == 0.0 and tuned.best_score == pytest.approx(1.0)


def test_cross_val_score(ready):
    mean, std = tuning.cross_val_score(models.random_forest(3, 3), tuning.accuracy(), ready, folds=2)
    assert 0.4 < mean <= 1 and std >= 0


def test_experiments_share_the_split(spark, rows):
    labels = {n: rows.select("row_key", (F.col("a") > 0).cast("int").alias("cluster")) for n in ("kmeans", "hierarchical")}
    prepared = experiments.experiment_splits(rows.drop("target"), "row_key", "preparedness_level", labels)
    assert prepared.inputs["kmeans"] == ["a", "b", "c", "kmeans_cluster"]
    results, importance, _ = experiments.run_experiments(prepared, trees=3, depth=3, folds=2)
    report = experiments.experiment_report(results, importance)
    assert {r["experiment"] for r in report["comparison"].collect()} == {"BASELINE", "KMEANS", "HIERARCHICAL"}
    assert report["comparison"].where("experiment = 'BASELINE'").first()["accuracy_improvement"] == 0.0
    assert report["cluster_rank"].count() == 2


def test_experiments_score_the_same_rows(spark, rows, monkeypatch):
    """Gaps in inputs and labellings that hold few of the rows."""
    gappy = rows.drop("target").withColumns({"b": F.when(F.col("row_key") % 3 != 0, F.col("b")), "d": F.lit(None).cast("double")})
    gappy = gappy.withColumn("c", F.when(F.col("row_key") % 7 == 0, float("inf")).otherwise(F.col("c")))
    few = rows.where("row_key % 4 = 0").select("row_key", (F.col("a") > 0).cast("int").alias("cluster"))
    seen = []

    def counted(df, *columns):
        seen.append({r["row_key"] for r in df.select("row_key").collect()})
        return metrics.classification_metrics(df, *columns)

    monkeypatch.setattr(experiments, "classification_metrics", counted)
    prepared = experiments.experiment_splits(gappy, "row_key", "preparedness_level", {"kmeans": few, "hierarchical": few})
    experiments.run_experiments(prepared, trees=2, depth=2, folds=2)
    test = {r["row_key"] for r in prepared.rows.where("is_test").collect()}
    assert len(test) > 40 and seen == [test] * 3
    clusters = {r["row_key"]: r["kmeans_cluster"] for r in prepared.rows.collect()}
    assert {k % 4 == 0 for k, c in clusters.items() if c == experiments.MISSING_CLUSTER} == {False} and len(clusters) == 240


def test_classification_flow_saves_models(spark, rows, tmp_path):
    trainers = {"Random Forest": partial(models.train_random_forest, trees=2, depth=2, folds=2)}
    out = flows.run_classification(rows.drop("target"), trainers=trainers, folds=2, folder=str(tmp_path))
    assert out["ranking"].count() == 1 and (tmp_path / "random_forest").exists()
    assert out["labels"] == ["High", "Low", "Medium"]
    assert out["evaluation"].first()["roc_auc_ovr"] > 0.5


class Called(Exception):
    pass


SIZES = {"trees", "depth", "leaf", "size", "max_iter", "maxIter", "folds", "starts", "micro", "ks", "trainers", "rate", "strengths"}
CALLS = {
    "m1_logistic_regression": (models, "train_logistic"), "m2_random_forest": (models, "train_random_forest"),
    "m3_boosted_subspace": (models, "train_boosted_subspace"), "m4_kernel_svm": (models, "train_kernel_svm"),
    "m5_gradient_boosting": (models, "train_gradient_boosting"), "r3_forest_regressor": (models, "train_forest_regressor"),
    "r4_boosted_subspace_regressor": (models, "train_boosted_regressor"), "r5_gradient_boosting_regressor": (models, "train_boosted_regressor"),
    "t6_grid_search": (models, "train_logistic"), "t7_cross_val_score": (models, "random_forest"), "x7_cv_summary": (models, "train_ridge"),
    "o3_top_importance": (models, "random_forest"), "s4_model_persistence": (models, "random_forest"),
    "m6_cluster_experiments": (experiments, "run_experiments"), "x13_cluster_importance": (experiments, "run_experiments"),
    "k2_search_k": (clustering, "search_k"), "k3_kmeans": (clustering, "train_kmeans"), "g2_classification_flow": (flows, "run_classification"),
    "g3_regression_flow": (flows, "run_regression"), "g4_unsupervised_flow": (flows, "run_unsupervised"),
    "g5_integration_flow": (flows, "run_integration"), "g6_supervised_flow": (flows, "run_supervised"),
}


@pytest.mark.parametrize("name", sorted(CALLS))
def test_queries_use_the_operators_configuration(spark, monkeypatch, name):
    module, function = CALLS[name]
    defaults = {p.name: p.default for p in inspect.signature(getattr(module, function)).parameters.values()}

    def stop(*args, **given):
        frames = [a for a in args if isinstance(a, DataFrame) and "fold" in a.columns]
        raise Called(given | dict(zip(defaults, args)), [a.select("fold").distinct().count() for a in frames])

    monkeypatch.setattr(module, function, stop)
    monkeypatch.setattr(modeling, "_labels", lambda t: {})
    monkeypatch.setattr(experiments, "experiment_splits", lambda *a, **k: None)
    with pytest.raises(Called) as found:
        entry.queries()[name](spark, "/root/testdata/sf0.001")
    given, folds = found.value.args
    assert {k: v for k, v in given.items() if k in SIZES and v != defaults.get(k)} == {}
    assert not {"classification_options", "regression_options"} & set(given)
    assert folds in ([], [defaults.get("folds")])
