"""Do cluster labels help a classifier? Three forests on the same split: plain, and with each label."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.functions.columns import numeric_columns, require_columns
from panelcraft.operators.booster import score_summary
from panelcraft.operators.checks import finite_measures
from panelcraft.operators.clean import median_impute
from panelcraft.operators.forest import ForestModel, Growth, grow
from panelcraft.operators.integrate import attach_labels
from panelcraft.operators.metrics import classification_metrics, compare_experiments, experiment_conclusion, importance_rank
from panelcraft.operators.models import importance_table
from panelcraft.operators.splits import SEED, TEST_SHARE, label_indexer, with_stratified_folds, with_stratified_split
from panelcraft.session import scratch_folder, spread
from panelcraft.sources.sinks import write_stage

RESULT_SCHEMA = (
    "experiment string, n_features long, accuracy double, f1 double, cv_mean double, cv_std double, seconds double"
)
#: Cluster of a row that a labelling does not hold; DBSCAN's noise is -1.
MISSING_CLUSTER = -2


@dataclass
class ExperimentSplits:
    """One split shared by all experiments, and the inputs, without gaps, each of them uses."""

    rows: DataFrame
    inputs: dict[str, list[str]]
    key: str
    target: str


def experiment_splits(
    df: DataFrame, key: str, target: str, labels: Mapping[str, DataFrame], test_share: float = TEST_SHARE, seed: int = SEED,
    exclude: Sequence[str] = (),
) -> ExperimentSplits:
    """``labels`` maps an experiment to its ``key, cluster`` table, joined by row key as ``<name>_cluster``.

    Gaps in numeric inputs get the median (0 in a column without any value), rows without a label get the cluster
    ``MISSING_CLUSTER``: no experiment leaves a row out.
    """
    require_columns(df, key, target)
    base = numeric_columns(df, exclude=[key, target, *exclude])
    wide = median_impute(finite_measures(df.select(key, target, *base), base), base).na.fill(0, subset=base)
    inputs = {"baseline": base}
    for name, table in labels.items():
        column = f"{name}_cluster"
        wide = attach_labels(wide, table.select(key, F.col("cluster").alias(column)), key).na.fill(MISSING_CLUSTER, subset=[column])
        inputs[name] = [*base, column]
    stored = write_stage(wide, scratch_folder(df.sparkSession, "experiments"))  # the split, the folds and all experiments read it
    return ExperimentSplits(with_stratified_split(stored, key, target, test_share, seed), inputs, key, target)


def run_experiments(
    splits: ExperimentSplits, trees: int = 100, depth: int = 10, leaf: int = 2, folds: int = 5
) -> tuple[DataFrame, DataFrame, dict[str, ForestModel]]:
    """(result row per experiment, importance of every input per experiment, fitted models), all on the same rows."""
    spark = splits.rows.sparkSession
    indexer = label_indexer(splits.rows, splits.target)
    coded, classes = indexer.transform(splits.rows), len(indexer.labels)
    train = spread(with_stratified_folds(coded.where(~F.col("is_test")), splits.key, splits.target, folds)).persist()
    test = spread(coded.where("is_test")).persist()
    results, importances, models = [], None, {}
    try:
        for name, inputs in splits.inputs.items():
            assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error")
            ready = assembler.transform(train)
            start = time.time()
            # the forest of all rows and those of the folds grow side by side; the seconds are those of all of them
            model, scores = grow(ready, Growth(trees, depth, leaf), classes, folds)
            seconds = time.time() - start
            scored = model.transform(assembler.transform(test))
            row = classification_metrics(scored, "label", "prediction").first()
            mean, std = score_summary(scores, "accuracy")
            results.append((name, len(inputs), row["accuracy"], row["f1_weighted"], mean, std, seconds))
            table = importance_table(model, inputs, spark, name)
            importances = table if importances is None else importances.unionByName(table)
            models[name] = model
    finally:
        train.unpersist()
        test.unpersist()
    return spark.createDataFrame(results, RESULT_SCHEMA), importances, models


def experiment_report(results: DataFrame, importances: DataFrame, k: int = 10) -> dict[str, DataFrame]:
    """Comparison with the baseline, conclusion, and the rank of each cluster input."""
    comparison = compare_experiments(results)
    asked = {r["experiment"]: f"{r['experiment']}_cluster" for r in results.select("experiment").collect() if r["experiment"] != "baseline"}
    return {
        "comparison": comparison, "conclusion": experiment_conclusion(comparison),
        "cluster_rank": importance_rank(importances, asked, k),
    }
