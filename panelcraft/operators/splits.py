"""Deterministic splits and folds, label coding, standardisation, model matrices.

A row's place in a split is the md5 of its key and the seed, so it never depends on partitioning or order.
Exact class proportions come from one threshold per class, found by counting hash prefixes: rows are never
ranked as a whole and no class ends up on one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcraft.functions.columns import numeric_columns, pick_target
from panelcraft.functions.vectors import packed
from panelcraft.operators.checks import drop_incomplete, finite_measures
from panelcraft.operators.clean import impute, median_impute
from panelcraft.operators.integrate import with_row_index
from panelcraft.operators.quantiles import quantile_table

SEED = 42
TEST_SHARE = 0.2
MAX_CLASSES = 200
RANKED_ROWS = 50_000
PREFIX = 3
CLASSIFICATION_EXCLUDED = ("preparedness_level", "preparedness_score", "healthcare_capacity_score")
REGRESSION_EXCLUDED = ("location", "iso_code", "date", "code", "continent")


def row_hash(key: str, seed: int = SEED) -> Column:
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))  # a row without a key is dealt out like the others
    return F.md5(F.concat(text, F.lit(f"-{seed}")))


def hash_thresholds(
    df: DataFrame, label: str | None, key: str, shares: Sequence[float], seed: int = SEED, ranked_rows: int = RANKED_ROWS
) -> dict[tuple, str]:
    """``{(class, share): hash}`` such that exactly round(share * class size) rows have a smaller or equal hash."""
    cls = F.col(label) if label else F.lit(0)
    hashed = df.select(cls.alias("__c"), row_hash(key, seed).alias("__h"))
    sizes: dict[tuple, list] = {}
    found = hashed.groupBy("__c", F.substring("__h", 1, PREFIX).alias("p")).count().limit(MAX_CLASSES * 16**PREFIX + 1).collect()
    for row in found:
        sizes.setdefault(row["__c"], []).append((row["p"], row["count"]))
    if len(sizes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")

    out: dict[tuple, str] = {}
    pending: list[list] = []  # [class, share, prefix, rank inside the prefix, rows in the prefix]
    for c, buckets in sizes.items():
        total = sum(n for _, n in buckets)
        for share in shares:
            wanted = math.floor(share * total + 0.5)
            if wanted == 0:
                out[(c, share)] = ""
            else:
                pending.append([c, share, *_locate(buckets, wanted)])

    spark = df.sparkSession
    while True:
        wide = [p for p in pending if p[4] > ranked_rows and len(p[2]) < 32]
        if not wide:
            break
        for width in {len(p[2]) for p in wide}:
            same = [p for p in wide if len(p[2]) == width]
            prefixes = spark.createDataFrame(sorted({(p[2],) for p in same}), "__p string")
            inside = hashed.join(F.broadcast(prefixes), F.substring("__h", 1, width) == F.col("__p"))
            deeper = inside.groupBy("__c", "__p", F.substring("__h", 1, width + PREFIX).alias("p")).count().collect()
            for p in same:
                buckets = [(row["p"], row["count"]) for row in deeper if row["__c"] == p[0] and row["__p"] == p[2]]
                p[2:] = _locate(buckets, p[3])

    for width in {len(p[2]) for p in pending}:
        same = [p for p in pending if len(p[2]) == width]
        wanted = spark.createDataFrame(sorted({(p[2],) for p in same}), "__p string")
        inside = hashed.join(F.broadcast(wanted), F.substring("__h", 1, width) == F.col("__p"))
        order = Window.partitionBy("__c", "__p").orderBy("__h")  # at most ``ranked_rows`` rows each
        ranked = inside.withColumn("rank", F.row_number().over(order))
        cuts = {(p[0], p[2], p[3]) for p in same}
        picks = spark.createDataFrame(sorted({(p, n) for _, p, n in cuts}), "__q string, __n int")
        chosen = ranked.join(F.broadcast(picks), (F.col("__p") == F.col("__q")) & (F.col("rank") == F.col("__n")))
        at = {(row["__c"], row["__p"], row["rank"]): row["__h"] for row in chosen.collect()}
        for p in same:
            out[(p[0], p[1])] = at[(p[0], p[2], p[3])]
    return out


def _locate(buckets: Sequence[tuple[str, int]], rank: int) -> list:
    before = 0
    for prefix, n in sorted(buckets):
        if before + n >= rank:
            return [prefix, rank - before, n]
        before += n
    raise ValueError("rank beyond the class")


def _threshold_column(cuts: dict[tuple, str], share: float, label: str | None) -> Column:
    own = {c: h for (c, s), h in cuts.items() if s == share}
    if label is None:
        return F.lit(next(iter(own.values()), ""))
    if not own:
        return F.lit("")
    missing = F.lit(own.pop(None, ""))  # rows without a class are a class of their own
    if not own:
        return missing
    pairs = [F.lit(x) for item in own.items() for x in item]
    return F.when(F.col(label).isNull(), missing).otherwise(F.create_map(*pairs)[F.col(label)])


def with_stratified_split(
    df: DataFrame, key: str, label: str, test_share: float = TEST_SHARE, seed: int = SEED, ranked_rows: int = RANKED_ROWS
) -> DataFrame:
    """Adds ``is_test``: in every class exactly round(share * size) rows, those of the smallest hashes."""
    cuts = hash_thresholds(df, label, key, [test_share], seed, ranked_rows)
    return df.withColumn("is_test", row_hash(key, seed) <= _threshold_column(cuts, test_share, label))


def with_plain_split(df: DataFrame, key: str, test_share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Adds ``is_test`` from the hash alone: no job, and the share holds up to sampling error."""
    bound = format(int(test_share * 16**8), "08x")
    return df.withColumn("is_test", F.substring(row_hash(key, seed), 1, 8) < bound)


def train_test(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(~F.col("is_test")).drop("is_test"), df.where("is_test").drop("is_test")


def with_stratified_folds(df: DataFrame, key: str, label: str, folds: int, seed: int = SEED, name: str = "fold") -> DataFrame:
    """Folds of equal size inside every class, by hash range."""
    shares = [i / folds for i in range(1, folds)]
    cuts = hash_thresholds(df, label, key, shares, seed)
    passed = sum(((row_hash(key, seed) > _threshold_column(cuts, s, label)).cast("int") for s in shares), start=F.lit(0))
    return df.withColumn(name, passed)


def with_block_folds(df: DataFrame, order: Sequence[str], folds: int, name: str = "fold") -> DataFrame:
    """Contiguous blocks in row order; the first ``n % folds`` blocks hold one row more."""
    n = df.count()
    size, extra = divmod(n, folds)
    indexed = with_row_index(df, order, "__i")
    edge = extra * (size + 1)
    i = F.col("__i")
    fold = F.when(i < edge, F.floor(i / F.lit(size + 1))).otherwise(F.lit(extra) + F.floor((i - edge) / F.lit(max(1, size))))
    return indexed.select(*df.columns, fold.cast("int").alias(name))


def label_indexer(df: DataFrame, label: str, output: str = "label") -> StringIndexerModel:
    """Class codes in alphabetical order of the class names."""
    return StringIndexer(inputCol=label, outputCol=output, stringOrderType="alphabetAsc", handleInvalid="error").fit(df)


def label_decoder(indexer: StringIndexerModel, column: str = "prediction", output: str = "predicted_class") -> IndexToString:
    return IndexToString(inputCol=column, outputCol=output, labels=list(indexer.labels))


def position_moments(df: DataFrame, values: Column) -> dict[int, tuple[float | None, float | None]]:
    """``{position: (mean, population std)}`` of an array: unfolded and combined per position before the shuffle,
    which stays in generated code for any width."""
    long = df.select(F.posexplode(values).alias("position", "x"))
    rows = long.groupBy("position").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).collect()
    return {r["position"]: (r["m"], r["s"]) for r in rows}


@dataclass
class Standardizer:
    """Centre and divide by the population standard deviation; a constant column becomes 0."""

    columns: Sequence[str] = ()
    mean: dict[str, float] = field(default_factory=dict)
    std: dict[str, float] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> Standardizer:
        self.columns = list(self.columns) or numeric_columns(df)
        found = position_moments(df, packed(self.columns))
        self.mean = {c: found.get(i, (None, None))[0] for i, c in enumerate(self.columns)}
        self.std = {c: found.get(i, (None, None))[1] for i, c in enumerate(self.columns)}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        def scaled(c: str) -> Column:
            if self.mean[c] is None:
                return F.lit(None).cast("double")
            centred = F.col(c).cast("double") - F.lit(self.mean[c])
            return centred / F.lit(self.std[c]) if self.std[c] else F.when(F.col(c).isNotNull(), F.lit(0.0))

        return df.select(*[scaled(c).alias(c) if c in self.mean else F.col(c) for c in df.columns])

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


def standardize_array(df: DataFrame, column: str, width: int) -> DataFrame:
    """The same for an array column of fixed width, kept as an array."""
    found = position_moments(df, F.col(column).cast("array<double>"))
    mean = F.array(*[F.lit(found[i][0]) for i in range(width)])
    scale = F.array(*[F.lit(1.0 / found[i][1] if found[i][1] else 0.0) for i in range(width)])
    centred = F.zip_with(F.col(column).cast("array<double>"), mean, lambda x, m: x - m)
    return df.withColumn(column, F.zip_with(centred, scale, lambda x, s: x * s))


@dataclass
class ModelMatrix:
    """Rows ready for an estimator: key, target, numeric inputs without gaps, and the test flag."""

    rows: DataFrame
    key: str
    target: str
    inputs: list[str]

    def assembled(self, output: str = "features") -> DataFrame:
        return VectorAssembler(inputCols=self.inputs, outputCol=output).transform(self.rows)


def classification_matrix(
    df: DataFrame, key: str, target: str = "preparedness_level", exclude: Sequence[str] = CLASSIFICATION_EXCLUDED,
    test_share: float = TEST_SHARE, seed: int = SEED, fit_on: str = "all",
) -> ModelMatrix:
    """Numeric inputs with infinities and gaps filled by the median, and a stratified split.

    Medians come from all rows by default, as documented; ``fit_on="train"`` learns them from train rows only.
    """
    labelled = drop_incomplete(df, [target])
    inputs = numeric_columns(labelled, exclude=[*exclude, target, key])
    rows = finite_measures(labelled.select(key, target, *inputs), inputs)
    split = with_stratified_split(rows, key, target, test_share, seed)
    return ModelMatrix(_imputed(split, inputs, fit_on), key, target, inputs)


def regression_matrix(
    df: DataFrame, key: str, target: str | None = None, exclude: Sequence[str] = REGRESSION_EXCLUDED,
    test_share: float = TEST_SHARE, seed: int = SEED, fit_on: str = "all",
) -> ModelMatrix:
    """As above for a numeric target. Medians are learned before rows without a target are dropped."""
    target = target or pick_target(df)
    inputs = numeric_columns(df, exclude=[*exclude, target, key])
    rows = finite_measures(df.select(key, target, *inputs), inputs)
    split = with_plain_split(rows, key, test_share, seed)
    return ModelMatrix(drop_incomplete(_imputed(split, inputs, fit_on), [target]), key, target, inputs)


def _imputed(df: DataFrame, inputs: list[str], fit_on: str) -> DataFrame:
    if fit_on == "all":
        return median_impute(df, inputs)
    medians = quantile_table(df.where(~F.col("is_test")), inputs, [0.5])
    return impute(df, {c: q[0.5] for c, q in medians.items()})
