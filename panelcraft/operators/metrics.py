"""Model metrics and comparison tables. Rows are reduced to counts or sums first; the rest is tiny."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcraft.functions.scalars import (
    accuracy_band, four_decimals, mean_plus_minus, speed_band, tradeoff_zone,
)
from panelcraft.session import cut_lineage


def _safe(numerator: Column, denominator: Column) -> Column:
    """0 where the denominator is 0."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def confusion_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Long confusion matrix ``by..., label, prediction, n``."""
    return df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    """Rows are true classes, columns predicted ones, both in the given order."""
    counts = confusion_counts(df, label, prediction)
    return counts.groupBy("label").pivot("prediction", list(classes)).agg(F.sum("n")).na.fill(0)


def class_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1, support per class that occurs as a label or as a prediction."""
    keys = [*by, "class"]
    zero = F.lit(0).cast("long")
    labels = counts.select(*by, F.col("label").alias("class"), F.col("n").alias("support"), zero.alias("predicted"),
                           F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits"))
    guesses = counts.select(*by, F.col("prediction").alias("class"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("hits"))
    per = labels.unionByName(guesses).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    precision, recall = _safe(F.col("hits"), F.col("predicted")), _safe(F.col("hits"), F.col("support"))
    out = per.select(*keys, precision.alias("precision"), recall.alias("recall"), "support", "hits")
    return out.withColumn("f1", _safe(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def _averages(per_class: DataFrame, by: Sequence[str]) -> DataFrame:
    total = F.sum("support")
    aggs = [_safe(F.sum("hits"), total).alias("accuracy"), total.alias("support")]
    for m in ("precision", "recall", "f1"):
        aggs += [F.avg(m).alias(f"{m}_macro"), _safe(F.sum(F.col(m) * F.col("support")), total).alias(f"{m}_weighted")]
    return (per_class.groupBy(*by) if by else per_class.groupBy()).agg(*aggs)


def classification_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and macro / weighted precision, recall, F1; one row per ``by`` group (model)."""
    return _averages(class_metrics(confusion_counts(df, label, prediction, by), by), by).drop("support")


def classification_report(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per class, then macro and weighted averages."""
    per = class_metrics(confusion_counts(df, label, prediction, by), by)
    rows = per.select(*by, F.col("class").cast("string").alias("class"), "precision", "recall", "f1", "support")
    averages = _averages(per, by)
    for kind in ("macro", "weighted"):
        picked = [F.col(f"{m}_{kind}").alias(m) for m in ("precision", "recall", "f1")]
        rows = rows.unionByName(averages.select(*by, F.lit(f"{kind} avg").alias("class"), *picked, "support"))
    return rows


def roc_auc_ovr(df: DataFrame, label: str, scores: Mapping[str, str | Column], by: Sequence[str] = ()) -> DataFrame:
    """One-vs-rest ROC AUC averaged by class frequency; NULL when a class has no positive or no negative.

    Rows shrink to counts per distinct score. Counts are cumulated inside score ranges and shifted by the
    totals of the ranges below, so one class never has to be sorted by a single task.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("class"), (F.col(s) if isinstance(s, str) else s).cast("double").alias("score"),
                (F.col(label) == F.lit(c)).cast("long").alias("positive"),
            )
            for c, s in scores.items()
        ]
    )
    keys = [*by, "class"]
    counted = df.select(*by, F.inline(cells)).groupBy(*keys, "score").agg(
        F.sum("positive").alias("pos"), F.sum(1 - F.col("positive")).alias("neg")
    )
    # range partitions of the whole order, stored so that the ranges stay put; a class spans as many as it needs
    placed = cut_lineage(counted.repartitionByRange(*keys, "score").withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy(*keys, "part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("below", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
    parts = local.groupBy(*keys, "part").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
        F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2.0)).alias("wins"),
    )
    lower = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifted = parts.withColumn("under", F.coalesce(F.sum("neg").over(lower), F.lit(0)))
    per_class = shifted.groupBy(*keys).agg(
        F.sum("pos").alias("p"), F.sum("neg").alias("q"), F.sum(F.col("wins") + F.col("pos") * F.col("under")).alias("u")
    ).withColumn("auc", F.try_divide(F.col("u"), F.col("p").cast("double") * F.col("q")))
    complete = F.count_if(F.col("auc").isNull()) == 0
    weighted = F.try_divide(F.sum(F.col("auc") * F.col("p")), F.sum("p").cast("double"))
    grouped = per_class.groupBy(*by) if by else per_class.groupBy()
    return grouped.agg(F.when(complete, weighted).alias("roc_auc_ovr"))


def regression_metrics(df: DataFrame, target: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """R2, MSE, RMSE, MAE, and MAPE (%) over non-zero targets: two aggregates, the second a plain sum.

    The total sum of squares uses the variance aggregate, which is stable for large means.
    """
    y, p = F.col(target).cast("double"), F.col(prediction).cast("double")
    error = y - p
    share = F.when(y != 0, F.abs(error / F.when(y != 0, y)))
    grouped = df.groupBy(*by) if by else df.groupBy()
    out = grouped.agg(
        F.count(error).alias("n"), F.sum(error * error).alias("sse"), F.sum(F.abs(error)).alias("sae"),
        F.var_pop(F.when(error.isNotNull(), y)).alias("variance"), (F.avg(share) * 100.0).alias("mape"),
    )
    mse = F.try_divide(F.col("sse"), F.col("n"))
    r2 = 1.0 - F.try_divide(F.col("sse"), F.col("variance") * F.col("n"))
    return out.select(
        *by, r2.alias("r2"), mse.alias("mse"), F.sqrt(mse).alias("rmse"), F.try_divide(F.col("sae"), F.col("n")).alias("mae"), "mape"
    )


def union_scored(scored: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """Predictions of several models under one ``model`` column, so that they are evaluated in one job."""
    parts = [df.select(F.lit(name).alias("model"), *columns) for name, df in scored.items()]
    return reduce(DataFrame.unionByName, parts)


def evaluate_classifiers(scored: DataFrame, label: str, prediction: str, scores: Mapping[str, str | Column] | None = None) -> DataFrame:
    """Metric row per model over a ``union_scored`` table; with class scores also the AUC."""
    metrics = classification_metrics(scored, label, prediction, by=["model"])
    return metrics.join(roc_auc_ovr(scored, label, scores, by=["model"]), "model", "left") if scores else metrics


def evaluate_regressors(scored: DataFrame, target: str, prediction: str) -> DataFrame:
    return regression_metrics(scored, target, prediction, by=["model"])


# ------------------------------------------------------------------- comparison tables (one row per model)


def classification_ranking(training: DataFrame, metrics: DataFrame) -> DataFrame:
    """Formatted comparison, best weighted F1 first. ``training`` has model, cv_mean, cv_std, seconds, params."""
    joined = training.join(metrics, "model")
    return joined.select(
        "model", mean_plus_minus("cv_mean", "cv_std").alias("cv_score"), four_decimals("accuracy").alias("test_accuracy"),
        four_decimals("f1_weighted").alias("test_f1_weighted"), four_decimals("precision_weighted").alias("test_precision_weighted"),
        four_decimals("recall_weighted").alias("test_recall_weighted"), F.format_string("%.2f", "seconds").alias("training_time_s"),
        F.col("params").alias("best_params"),
    ).orderBy(F.desc("test_f1_weighted"), "model")


def regression_ranking(training: DataFrame, metrics: DataFrame) -> DataFrame:
    """Comparison with numeric errors, best R2 first."""
    joined = training.join(metrics, "model")
    return joined.select(
        "model", "r2", "rmse", "mae", "mape", mean_plus_minus("cv_mean", "cv_std", spaced=True).alias("cv_r2")
    ).orderBy(F.desc("r2"), "model")


def ranked(df: DataFrame, by: str, ties: Sequence[str]) -> DataFrame:
    """Adds ``position``, 1 for the largest. For report tables with one row per model."""
    return df.withColumn("position", F.row_number().over(Window.partitionBy().orderBy(F.desc(by), *ties)))


def with_tradeoff(df: DataFrame, accuracy: str = "accuracy", seconds: str = "seconds") -> DataFrame:
    return df.withColumns(
        {
            "zone": tradeoff_zone(accuracy, seconds), "accuracy_band": accuracy_band(accuracy),
            "speed_band": speed_band(seconds),
        }
    )


def best_model(df: DataFrame, by: str, ties: Sequence[str] = ("model",)) -> DataFrame:
    return df.orderBy(F.desc(by), *ties).limit(1)


def fastest_good_model(df: DataFrame, accuracy: str = "accuracy", seconds: str = "seconds", above: float = 0.99) -> DataFrame:
    return df.where(F.col(accuracy) > above).orderBy(seconds, "model").limit(1)


def tradeoff_summary(df: DataFrame) -> DataFrame:
    """Ranking rows plus the roles ``best`` and ``fastest good`` in one table for export."""
    order = ranked(df, "accuracy", ["model"]).select("model", "accuracy", "seconds", "position")
    best = best_model(df, "accuracy").select("model", F.lit(True).alias("is_best"))
    fast = fastest_good_model(df).select("model", F.lit(True).alias("is_fastest_good"))
    return order.join(best, "model", "left").join(fast, "model", "left").na.fill(False, ["is_best", "is_fastest_good"])


def compare_experiments(results: DataFrame, baseline: str = "baseline") -> DataFrame:
    """Each experiment against the baseline row: accuracy, F1 and time deltas.

    ``results`` has experiment, n_features, accuracy, f1, cv_mean, cv_std, seconds.
    """
    base = results.where(F.col("experiment") == baseline).select(
        F.col("accuracy").alias("__a"), F.col("f1").alias("__f"), F.col("seconds").alias("__s")
    )
    return results.crossJoin(base).select(  # the baseline is one row
        F.upper("experiment").alias("experiment"), "n_features", "accuracy", (F.col("accuracy") - F.col("__a")).alias("accuracy_improvement"),
        "f1", (F.col("f1") - F.col("__f")).alias("f1_improvement"), mean_plus_minus("cv_mean", "cv_std", spaced=True).alias("cv_score"),
        "seconds", (F.col("seconds") - F.col("__s")).alias("time_diff"),
    )


def experiment_conclusion(comparison: DataFrame) -> DataFrame:
    """Best experiment by accuracy, and whether any experiment beats the baseline."""
    return comparison.agg(
        F.max_by("experiment", F.col("accuracy")).alias("best_experiment"), F.max("accuracy").alias("best_accuracy"),
        (F.max("accuracy_improvement") > 0).alias("clusters_help"),
    )


def importance_rank(importance: DataFrame, cluster_features: Mapping[str, str], k: int = 10) -> DataFrame:
    """Rank of each experiment's cluster feature among its ``k`` most important ones (NULL: not among them)."""
    order = Window.partitionBy("experiment").orderBy(F.desc("importance"), "feature")
    top = importance.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    asked = importance.sparkSession.createDataFrame(list(cluster_features.items()), "experiment string, feature string")
    return asked.join(top, ["experiment", "feature"], "left").select(
        "experiment", "feature", "rank", "importance",
        F.when(F.col("rank").isNull(), F.lit(f"not in top {k}")).otherwise(F.concat(F.lit("#"), F.col("rank"))).alias("note"),
    )
