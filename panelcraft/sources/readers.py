"""Reading raw tables."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcraft.sources.csv_records import csv_records

# Text that means "missing" in a raw file, besides an empty field.
MISSING_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Header CSV; missing tokens and unreadable numbers become NULL.

    Columns are matched to ``schema`` by name, in any order. A quote inside a quoted field is doubled; a quoted field
    may hold line breaks, and large files are read in splits all the same. Files that are read together must have the
    same header; one that differs is an error, never read by position. A row with too few fields ends in NULLs, further
    fields than the header has are left out. A column the schema does not know is double when all its values are
    numbers, else text: one aggregate over the file, run only when there is such a column.
    """
    records = csv_records(spark, path)
    first = "block = 0 AND record = 1"
    headers = records.where(first).select(F.regexp_replace("value", "^\ufeff", "").alias("value")).distinct().limit(2).collect()
    if len(headers) != 1:
        raise ValueError("no header, or files with different ones")
    header = [n or f"_c{i}" for i, n in enumerate(next(csv.reader([headers[0]["value"]])))]
    as_text = ", ".join(f"`{n.replace('`', '``')}` string" for n in header)
    parsed = F.from_csv("value", as_text, {"quote": '"', "escape": '"'})
    raw = records.where(f"NOT ({first})").select(parsed.alias("x")).select("x.*")
    present = raw.select(*[F.when(~F.col(f"`{n}`").isin(*MISSING_TOKENS), F.col(f"`{n}`")).alias(n) for n in header])
    known = {f.name: f.dataType for f in schema.fields}
    types = {**_inferred(present, [n for n in header if n not in known]), **known}
    return present.select(
        *[F.col(f"`{n}`") if isinstance(types[n], T.StringType) else F.col(f"`{n}`").try_cast(types[n]).alias(n) for n in header]
    )


def _inferred(df: DataFrame, columns: Sequence[str]) -> dict[str, T.DataType]:
    if not columns:
        return {}
    text_only = [F.count_if(F.col(f"`{n}`").isNotNull() & F.col(f"`{n}`").try_cast("double").isNull()).alias(n) for n in columns]
    row = df.agg(*text_only).first()
    return {n: T.StringType() if row[n] else T.DoubleType() for n in columns}


def source_exists(spark: SparkSession, path: str) -> bool:
    """Does any file match? Uses the file system that the path names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(target)
    return found is not None and len(found) > 0


def missing_sources(spark: SparkSession, paths: Mapping[str, str]) -> list[str]:
    return [name for name, path in paths.items() if not source_exists(spark, path)]


def require_sources(spark: SparkSession, paths: Mapping[str, str]) -> None:
    missing = missing_sources(spark, paths)
    if missing:
        raise FileNotFoundError(f"raw tables not found: {missing}")


def read_tables(spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, T.StructType]) -> dict[str, DataFrame]:
    """All raw tables by name; CSV by default, parquet when the path says so."""
    require_sources(spark, paths)
    return {
        name: spark.read.parquet(path) if path.endswith(".parquet") else read_csv(spark, path, schemas[name])
        for name, path in paths.items()
    }
