"""Estimators and their grids. Defaults are the documented configurations; every size is a parameter."""

from __future__ import annotations

import time
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcraft.operators.booster import Boosting, boost, score_summary
from panelcraft.operators.forest import Growth, grow
from panelcraft.operators.kernel_svm import fit_svm, weighted_f1_of
from panelcraft.operators.tuning import Tuned, grid_search, r2, weighted_f1
from panelcraft.session import kept

SEED = 42
FOLDS = 3


def one_point_grid() -> list:
    return ParamGridBuilder().build()


# ---------------------------------------------------------------------------------------- classification


def logistic(reg_param: float = 0.0, max_iter: int = 2000) -> LogisticRegression:
    return LogisticRegression(family="multinomial", standardization=False, regParam=reg_param, elasticNetParam=0.0, maxIter=max_iter)


def train_logistic(df: DataFrame, strengths: Sequence[float] = (0.1, 1.0), max_iter: int = 2000, folds: int = FOLDS) -> Tuned:
    """L2 logistic regression over inverse strengths C. A summed loss with weight C equals a mean loss with
    penalty 1 / (C n), n being the rows of the fit at hand: those of a fold complement, then all."""
    n = df.count()
    inner = n * (folds - 1) / folds
    base = logistic(max_iter=max_iter)
    grid = ParamGridBuilder().addGrid(base.regParam, [1.0 / (c * inner) for c in strengths]).build()
    tuned = grid_search(base, grid, weighted_f1(), df, folds)
    best = strengths[int(np.argmax(tuned.grid_means))]
    start = time.time()
    tuned.model = logistic(1.0 / (best * n), max_iter).fit(df)
    tuned.best_params = {"C": best, "max_iter": max_iter}
    tuned.seconds += time.time() - start
    return tuned


def random_forest(trees: int = 100, depth: int = 20, leaf: int = 1, seed: int = SEED) -> RandomForestClassifier:
    return RandomForestClassifier(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, featureSubsetStrategy="sqrt", seed=seed, maxMemoryInMB=1024
    )


def train_random_forest(df: DataFrame, trees: int = 100, depth: int = 20, leaf: int = 1, folds: int = FOLDS) -> Tuned:
    return _grown(df, Growth(trees, depth, leaf), folds, "f1", {"numTrees": trees, "maxDepth": depth})


def _grown(df: DataFrame, p: Growth, folds: int, score: str, params: dict) -> Tuned:
    """The forests of the folds and of all rows are grown side by side."""
    start = time.time()
    classes = int(df.agg(F.max("label")).first()[0]) + 1 if score == "f1" else 0
    with kept(df) as rows:
        model, scores = grow(rows, p, classes, folds)
    mean, std = score_summary(scores, score)
    return Tuned(model, params, mean, [mean], [std], time.time() - start)


def train_boosted_subspace(df: DataFrame, trees: int = 100, depth: int = 5, rate: float = 0.1, folds: int = FOLDS) -> Tuned:
    """Second-order boosting with 80 % of the rows and, per tree, of the columns; all classes in one model."""
    return _boosted(df, Boosting(trees, depth, rate, columns=0.8), folds, "f1")


def train_gradient_boosting(df: DataFrame, trees: int = 100, depth: int = 5, rate: float = 0.1, folds: int = FOLDS) -> Tuned:
    """Boosting on residuals with 80 % of the rows per tree; all classes in one model."""
    return _boosted(df, Boosting(trees, depth, rate, second_order=False), folds, "f1")


def _boosted(df: DataFrame, p: Boosting, folds: int, score: str) -> Tuned:
    """The models of the folds and of all rows are trained side by side."""
    start = time.time()
    classes = int(df.agg(F.max("label")).first()[0]) + 1 if score == "f1" else 0
    with kept(df) as rows:
        model, scores = boost(rows, p, classes, folds)
    mean, std = score_summary(scores, score)
    params = {"trees": p.rounds, "depth": p.depth, "rate": p.rate, "rows": p.rows, "columns": p.columns}
    return Tuned(model, params, mean, [mean], [std], time.time() - start)


def class_probabilities(df: DataFrame) -> Column:
    """Array of class probabilities."""
    return vector_to_array("probability")


def train_kernel_svm(df: DataFrame, strength: float = 1.0, size: int = 512, folds: int = FOLDS, max_iter: int = 100, seed: int = SEED) -> Tuned:
    """Support-vector classifier with a Gaussian kernel on ``size`` landmarks, over the folds 0 to ``folds`` - 1 of ``fold``.
    Margins of all pairs of classes, of all folds and of the whole are trained in at most ``max_iter`` jobs together."""
    start = time.time()
    with kept(df.select("features", "label", "fold")) as rows:
        model, confusion, _ = fit_svm(rows, strength, size, range(folds), max_iter, seed)
    mean, std = score_summary([{"f1": weighted_f1_of(c)} if c.sum() else {} for c in confusion], "f1")
    params = {"C": strength, "kernel": "rbf", "gamma": model.landmarks.gamma, "landmarks": len(model.landmarks.points)}
    return Tuned(model, params, mean, [mean], [std], time.time() - start)


# ---------------------------------------------------------------------------------------- regression


def linear() -> LinearRegression:
    return LinearRegression(regParam=0.0, solver="normal", fitIntercept=True)


def ridge(df: DataFrame, alpha: float = 1.0) -> LinearRegression:
    """Penalty ``alpha * |w|^2`` on the summed squares. The solver works on a label scaled by its population
    standard deviation and on the mean loss, hence the factor."""
    row = df.agg(F.count("label").alias("n"), F.stddev_pop("label").alias("s")).first()
    penalty = alpha * (row["s"] or 0.0) / max(1, row["n"])
    return LinearRegression(regParam=penalty, elasticNetParam=0.0, standardization=False, solver="normal", fitIntercept=True)


def forest_regressor(trees: int = 100, depth: int = 20, leaf: int = 1, seed: int = SEED) -> RandomForestRegressor:
    return RandomForestRegressor(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, featureSubsetStrategy="sqrt", seed=seed, maxMemoryInMB=1024
    )


def train_linear(df: DataFrame, folds: int = FOLDS) -> Tuned:
    tuned = grid_search(linear(), one_point_grid(), r2(), df, folds)
    tuned.best_params = {"fit_intercept": True}
    return tuned


def train_ridge(df: DataFrame, alpha: float = 1.0, folds: int = FOLDS) -> Tuned:
    tuned = grid_search(ridge(df, alpha * folds / (folds - 1)), one_point_grid(), r2(), df, folds)
    tuned.model = ridge(df, alpha).fit(df)
    tuned.best_params = {"alpha": alpha, "fit_intercept": True}
    return tuned


def train_forest_regressor(df: DataFrame, trees: int = 100, depth: int = 20, folds: int = FOLDS) -> Tuned:
    return _grown(df, Growth(trees, depth), folds, "r2", {"trees": trees, "depth": depth})


def train_boosted_regressor(df: DataFrame, trees: int = 100, depth: int = 5, rate: float = 0.1, columns: str = "all", folds: int = FOLDS) -> Tuned:
    """Boosting on residuals, or, with a share of ``columns`` per tree, second-order boosting."""
    share = 1.0 if columns == "all" else float(columns)
    return _boosted(df, Boosting(trees, depth, rate, columns=share, second_order=columns != "all"), folds, "r2")


def importance_table(model: Model, inputs: Sequence[str], spark, experiment: str | None = None) -> DataFrame:
    """``feature, importance`` for a tree ensemble, one row per input."""
    values = model.featureImportances.toArray()
    rows = [(experiment, n, float(v)) for n, v in zip(inputs, values)]
    table = spark.createDataFrame(rows, "experiment string, feature string, importance double")
    return table if experiment else table.drop("experiment")


def top_importance(table: DataFrame, k: int = 10) -> DataFrame:
    return table.orderBy(F.desc("importance"), "feature").limit(k)
