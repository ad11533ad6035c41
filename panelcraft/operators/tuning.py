"""Grid search and cross-validation scores over explicit fold columns."""

from __future__ import annotations

import math
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame

from panelcraft.operators.splits import with_block_folds, with_stratified_folds
from panelcraft.session import kept

PARALLELISM = 2


def weighted_f1() -> Evaluator:
    return MulticlassClassificationEvaluator(metricName="f1", labelCol="label", predictionCol="prediction")


def accuracy() -> Evaluator:
    return MulticlassClassificationEvaluator(metricName="accuracy", labelCol="label", predictionCol="prediction")


def r2() -> Evaluator:
    return RegressionEvaluator(metricName="r2", labelCol="label", predictionCol="prediction")


@dataclass
class Tuned:
    """Best model refitted on all training rows, with its cross-validation scores."""

    model: Model
    best_params: dict[str, Any]
    best_score: float
    grid_means: list[float]
    grid_stds: list[float]
    seconds: float
    extra: dict[str, Any] = field(default_factory=dict)

    @property
    def cv_mean(self) -> float:
        """Mean over grid points of the fold means."""
        return sum(self.grid_means) / len(self.grid_means)

    @property
    def cv_std(self) -> float:
        """Mean over grid points of the fold standard deviations."""
        return sum(self.grid_stds) / len(self.grid_stds)

    @property
    def spread(self) -> float:
        """Standard deviation of the means across grid points; 0 for a one-point grid."""
        mean = self.cv_mean
        return math.sqrt(sum((m - mean) ** 2 for m in self.grid_means) / len(self.grid_means))

    def row(self, name: str, regression: bool = False) -> tuple:
        mean, std = (self.best_score, self.spread) if regression else (self.cv_mean, self.cv_std)
        return (name, mean, std, self.seconds, str(self.best_params))


TRAINING_SCHEMA = "model string, cv_mean double, cv_std double, seconds double, params string"


def folded(df: DataFrame, key: str, folds: int, label: str | None) -> DataFrame:
    """Stratified folds for a class label, contiguous blocks by key otherwise."""
    return with_stratified_folds(df, key, label, folds) if label else with_block_folds(df, [key], folds)


def cross_validate(
    estimator: Estimator, grid: Sequence[Mapping], evaluator: Evaluator, df: DataFrame, folds: int, fold_column: str = "fold",
    parallelism: int = PARALLELISM,
) -> CrossValidatorModel:
    return CrossValidator(
        estimator=estimator, estimatorParamMaps=list(grid), evaluator=evaluator, numFolds=folds, foldCol=fold_column,
        parallelism=parallelism, collectSubModels=False,
    ).fit(df)


def grid_search(
    estimator: Estimator, grid: Sequence[Mapping], evaluator: Evaluator, df: DataFrame, folds: int = 3, fold_column: str = "fold",
    parallelism: int = PARALLELISM,
) -> Tuned:
    """Score every grid point on the folds, then keep the model refitted with the best one."""
    start = time.time()
    with kept(df) as rows:  # every fold and grid point reads the same rows
        fitted = cross_validate(estimator, grid, evaluator, rows, folds, fold_column, parallelism)
    means, stds = [float(m) for m in fitted.avgMetrics], [float(s) for s in fitted.stdMetrics]
    best = max(range(len(means)), key=means.__getitem__)
    params = {p.name: v for p, v in grid[best].items()}
    return Tuned(fitted.bestModel, params, means[best], means, stds, time.time() - start)


def cross_val_score(
    estimator: Estimator, evaluator: Evaluator, df: DataFrame, folds: int = 5, fold_column: str = "fold"
) -> tuple[float, float]:
    """(mean, population std) of one estimator over the folds."""
    with kept(df) as rows:
        fitted = cross_validate(estimator, ParamGridBuilder().build(), evaluator, rows, folds, fold_column)
    return float(fitted.avgMetrics[0]), float(fitted.stdMetrics[0])
