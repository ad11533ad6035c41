"""Writing stage tables, metrics, models and labels."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Store a stage as parquet and go on from the stored copy, which also cuts the lineage."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """A quote inside a field is doubled, as ``read_csv`` expects."""
    df.write.mode("overwrite").options(header=True, quote=chr(34), escape=chr(34)).csv(path)


def flatten_metrics(nested: Mapping, prefix: str = "") -> list[tuple[str, float | None, str | None]]:
    """(dotted name, number, text) per leaf."""
    out: list[tuple[str, float | None, str | None]] = []
    for name, value in nested.items():
        full = f"{prefix}.{name}" if prefix else str(name)
        if isinstance(value, Mapping):
            out += flatten_metrics(value, full)
        elif isinstance(value, (int, float)) and not isinstance(value, bool):
            out.append((full, float(value), None))
        else:
            out.append((full, None, None if value is None else json.dumps(value, ensure_ascii=False, default=str)))
    return out


def metrics_frame(spark: SparkSession, model: str, nested: Mapping) -> DataFrame:
    """Tidy ``model, metric, value, text`` from a nested dictionary of results."""
    rows = [(model, name, number, text) for name, number, text in flatten_metrics(nested)]
    return spark.createDataFrame(rows, "model string, metric string, value double, text string")


def write_metrics(df: DataFrame, path: str) -> None:
    """JSON lines; the table is a report, one small file is meant."""
    df.coalesce(1).write.mode("overwrite").json(path)


def save_model(model: MLWritable, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def save_labels(df: DataFrame, row_key: str, label: str, path: str) -> DataFrame:
    """(row key, cluster) or (row key, vector): keyed, never by position."""
    return write_stage(df.select(row_key, label), path)


def stage_summary(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Per stage, in the given order: rows, columns, missing cells and their share. One job per stage, run
    together as a union."""
    parts = []
    for position, (name, df) in enumerate(stages.items()):
        empty_cells = sum((F.count_if(F.col(c).isNull()) for c in df.columns), start=F.lit(0))
        parts.append(
            df.agg(F.count(F.lit(1)).alias("n_rows"), empty_cells.cast("long").alias("null_cells")).select(
                F.lit(position).alias("position"), F.lit(name).alias("stage"), "n_rows",
                F.lit(len(df.columns)).cast("long").alias("n_cols"), "null_cells",
                (F.try_divide(F.col("null_cells"), F.col("n_rows") * len(df.columns)) * 100.0).alias("null_pct"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def stage_funnel(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Stage summary plus rows kept, columns added and missing share removed against the first stage."""
    first = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # few rows
    head = {c: F.first(c).over(first) for c in ("n_rows", "n_cols", "null_pct")}
    return stage_summary(stages).select(
        "*",
        (F.try_divide(F.col("n_rows"), head["n_rows"]) * 100.0).alias("rows_retained_pct"),
        (F.try_divide(F.col("n_cols") - head["n_cols"], head["n_cols"]) * 100.0).alias("cols_added_pct"),
        (F.try_divide(head["null_pct"] - F.col("null_pct"), head["null_pct"]) * 100.0).alias("null_reduction_pct"),
    )


def vector_rows(df: DataFrame, row_key: str, vector: str) -> DataFrame:
    """A vector column as an array, so that any reader can use it."""
    if isinstance(df.schema[vector].dataType, T.ArrayType):
        return df.select(row_key, vector)
    return df.select(row_key, vector_to_array(vector).alias(vector))
