"""Hand-made edge cases: missing keys, empty groups, bin edges, constant columns."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from panelcraft.functions import columns as names
from panelcraft.functions import scalars as sc
from panelcraft.operators import checks, clean, explore, features, integrate, metrics, patterns, profile, splits, targets
from panelcraft.operators import panel_windows as pw
from panelcraft.operators.panel_windows import PanelKey
from panelcraft.sources import readers, sinks

KEY = PanelKey()


def values(df, *cols):
    return [tuple(r) if len(cols) > 1 else r[0] for r in df.select(*cols).collect()]


def panel(spark, rows):
    days = [(loc, date(2021, 1, d), v) for loc, d, v in rows]
    return spark.createDataFrame(days, "location string, date date, x double")


def ordered(df, *cols):
    return values(df.orderBy("location", "date"), *cols)


def test_invalid_dates_are_dropped(spark):
    df = spark.createDataFrame([("2021-01-01",), ("x",), (None,)], "date string")
    assert values(checks.parse_dates(df), "date") == [date(2021, 1, 1)]


def test_negative_to_zero_keeps_missing(spark):
    df = spark.createDataFrame([(-1.0, -2), (None, 3)], "a double, b int")
    assert values(checks.clamp_negatives(df), "a", "b") == [(0.0, 0), (None, 3)]


def test_sparse_threshold_is_strict(spark):
    df = spark.range(100).select(
        F.when(F.col("id") >= 70, 1).alias("kept"), F.when(F.col("id") >= 71, 1).alias("gone"), "id"
    )
    assert clean.drop_sparse_columns(df).columns == ["kept", "id"]


def test_forward_fill(spark):
    df = panel(spark, [("a", 1, None), ("a", 2, 5.0), ("a", 3, None), ("b", 1, None), ("b", 2, 7.0), (None, 1, 9.0)])
    out = pw.forward_fill(df, KEY, ["x"])
    assert ordered(out.where("location is not null"), "x") == [None, 5.0, 5.0, None, 7.0]
    assert values(out.where("location is null"), "x") == [None]


def test_rolling_statistics(spark):
    df = panel(spark, [("a", 1, 1.0), ("a", 2, None), ("a", 3, 3.0), ("b", 1, 1.0), ("b", 2, 2.0)])
    out = pw.with_row_features(df, KEY, [pw.rolling_mean("x", 7, "m"), pw.rolling_std("x", 7, "s"), pw.strict_rolling_mean("x", 2, "t")])
    assert ordered(out, "m") == [1.0, 1.0, 2.0, 1.0, 1.5]
    assert ordered(out, "s")[3:] == [None, pytest.approx(0.7071067811865476)]
    assert ordered(out, "t") == [None, None, None, None, 1.5]


def test_acceleration_starts_anew_per_entity(spark):
    df = panel(spark, [("a", d, float(d * d)) for d in range(1, 5)] + [("b", d, float(d)) for d in range(1, 4)])
    out = pw.with_row_features(df, KEY, [pw.acceleration("x", "a")])
    assert ordered(out, "a") == [None, None, 2.0, 2.0, None, None, 0.0]


def test_sum_of_missing_is_zero_and_missing_keys_drop(spark):
    df = panel(spark, [("a", 1, None), ("a", 1, None), (None, 1, 4.0)])
    assert values(integrate.sum_by_key(df), "location", "x") == [("a", 0.0)]


def test_join_matches_missing_keys_and_fans_out(spark):
    left = panel(spark, [(None, 1, 1.0), ("a", 1, 2.0)])
    right = panel(spark, [(None, 1, 5.0), (None, 1, 6.0)])
    out = integrate.left_join_on_keys(left, right, suffix="_vac")
    assert out.columns == ["location", "date", "x", "x_vac"]
    assert sorted(values(out, "x", "x_vac"), key=str) == [(1.0, 5.0), (1.0, 6.0), (2.0, None)]


def test_roll_up_skipped_without_keys(spark):
    left = panel(spark, [("a", 1, 1.0)])
    assert integrate.roll_up_and_join(left, spark.range(3), "age_") is left


def test_latest_is_per_column(spark):
    df = spark.createDataFrame(
        [("a", date(2021, 1, 1), 1.0, 2.0), ("a", date(2021, 1, 2), 3.0, None)], "location string, date date, x double, y double"
    )
    assert values(pw.latest_per_entity(df, KEY, ["x", "y"]), "x", "y") == [(3.0, 2.0)]


def test_level_edges(spark):
    scores = [0.0, 0.4, 0.40001, 0.7, 1.0, -0.0005, 1.01, None]
    df = spark.createDataFrame([(s,) for s in scores], "s double").select(targets.level_of("s").alias("l"))
    assert values(df, "l") == ["Low", "Low", "Medium", "Medium", "High", None, None, None]


def test_ratios_by_zero_are_missing(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (1.0, 2.0)], "a double, b double").select(sc.ratio("a", "b").alias("r"))
    assert values(df, "r") == [None, None, 0.5]


def test_duplicates_count_missing_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3)], "a int, b int")
    assert tuple(profile.duplicate_rows(df).first())[:2] == (3, 1)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "c double, d double")
    assert values(splits.Standardizer(["c", "d"]).fit_transform(df), "c", "d") == [(0.0, -1.0), (0.0, 1.0)]


def test_constant_feature_is_not_distinctive(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0), (0, 1.0, 2.0), (1, 1.0, 9.0)], "k int, c double, d double")
    assert set(values(patterns.distinctive_features(df, "k"), "feature")) == {"d"}
    assert (0, "c", 0.0) in values(patterns.contrast_matrix(df, "k"), "cluster", "feature", "z")


def test_unusable_cap_is_neutral(spark):
    df = spark.createDataFrame([(0.5, 0.0, 0.0)] * 3, "vaccination_rate double, mortality_rate double, hospital_beds double")
    built = targets.TargetBuilder().fit(df).transform(df).first()
    assert built["preparedness_score"] == pytest.approx(0.5)
    assert built["healthcare_capacity_score"] == 50.0


def test_single_row_class_stays_in_train(spark):
    df = spark.createDataFrame([(i, "a") for i in range(10)] + [(99, "b")], "k long, c string")
    out = splits.with_stratified_split(df, "k", "c")
    assert values(out.groupBy("c").agg(F.count_if("is_test").alias("n")).orderBy("c"), "c", "n") == [("a", 2), ("b", 0)]


def test_never_predicted_class_has_zero_precision(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a")], "l string, p string")
    rows = {r["class"]: r for r in metrics.classification_report(df, "l", "p").collect()}
    assert rows["b"]["precision"] == 0.0 and rows["b"]["f1"] == 0.0


def test_mape_without_targets_is_missing(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0)], "y double, p double")
    assert metrics.regression_metrics(df, "y", "p").first()["mape"] is None


def test_auc_with_one_class_is_missing(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.9)], "l string, s double")
    assert metrics.roc_auc_ovr(df, "l", {"a": "s"}).first()[0] is None


def test_nan_is_missing_for_quantiles(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    assert clean.quantile_table(df, ["x"], [0.5])["x"][0.5] == 2.0
    assert clean.quantile_table(df, ["x"], [0.5], accuracy=20)["x"][0.5] == 2.0


def test_empty_input_raises(spark):
    empty = spark.createDataFrame([], "country string, date string")
    with pytest.raises(ValueError):
        checks.validate_cases(empty)
    bad = spark.createDataFrame([("a", "never")], "country string, date string")
    with pytest.raises(ValueError):
        checks.validate_cases(bad)
    with pytest.raises(ValueError):
        checks.validate_cases(spark.range(3))


def test_standard_names():
    assert names.standard_names(["country", "location_code", "fecha"]) == {"country": "location", "fecha": "date"}
    assert names.standard_names(["Region", "Update_Time"]) == {"Region": "location", "Update_Time": "date"}
    assert names.standard_names(["location", "date"]) == {}


def test_csv_tokens(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("country,date,x\nA,2021-01-01,NA\n,2021-01-02,oops\nB,2021-01-03,1.5\n")
    schema = "country string, date string, x double"
    df = readers.read_csv(spark, str(path), spark.createDataFrame([], schema).schema)
    assert values(df, "country", "x") == [("A", None), (None, None), ("B", 1.5)]
    wide = tmp_path / "wide.csv"
    wide.write_text("unit,x,extra,country\nt,1,2.5,A\nu,NA,,B\n")
    got = readers.read_csv(spark, str(wide), df.schema)
    assert got.dtypes == [("unit", "string"), ("x", "double"), ("extra", "double"), ("country", "string")]
    assert values(got, "country", "x", "extra") == [("A", 1.0, 2.5), ("B", None, None)]
    assert readers.missing_sources(spark, {"a": str(path), "b": str(tmp_path / "none.csv")}) == ["b"]
    with pytest.raises(FileNotFoundError):
        readers.require_sources(spark, {"b": str(tmp_path / "none.csv")})


def test_row_index_is_total(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.concat(F.lit("k"), F.col("id") % 10).alias("s"))
    assert values(integrate.with_row_index(df, ["v"]).orderBy("v"), "row_index") == list(range(1000))
    assert sorted(values(integrate.with_row_index(df, ["s", "v"]), "row_index")) == list(range(1000))


def test_block_folds_are_contiguous(spark):
    out = splits.with_block_folds(spark.range(10).toDF("k"), ["k"], 3)
    assert values(out.orderBy("k"), "fold") == [0, 0, 0, 0, 1, 1, 1, 2, 2, 2]


def test_metrics_flatten_to_rows(spark):
    df = sinks.metrics_frame(spark, "m", {"a": {"b": 1, "c": "x"}, "d": None})
    assert sorted(values(df, "metric", "value", "text"), key=str) == [("a.b", 1.0, None), ("a.c", None, '"x"'), ("d", None, None)]


def test_strict_moving_average_on_the_timeline(spark):
    df = spark.createDataFrame([(date(2021, 1, d), float(d)) for d in range(1, 9)], "date date, x double")
    got = values(explore.timeline(df, ["x"], 7).orderBy("date"), "x_ma_7")
    assert got == [None] * 6 + [4.0, 5.0]


def test_feature_builder_adds_all_columns(spark):
    rows = [("a", date(2021, 1, d), float(d), 1.0, 10.0 * d, 2.0, 1000.0, 3.0, 50.0, 20.0) for d in range(1, 40) if d < 32]
    df = spark.createDataFrame(
        rows,
        "location string, date date, new_cases double, new_deaths double, total_cases double, total_deaths double, population double, "
        "population_density double, total_vaccinations double, people_fully_vaccinated double",
    )
    out = features.FeatureBuilder().fit_transform(df)
    assert len(out.columns) - len(df.columns) == 31


def test_csv_with_quotes_and_other_headers(spark, tmp_path):
    from pyspark.sql import types as T

    from panelcraft.sources.readers import read_csv

    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.DoubleType())])
    (tmp_path / "a.csv").write_text('name,n\n"say ""hi"", ok",5\n')
    assert [tuple(r) for r in read_csv(spark, str(tmp_path / "a.csv"), schema).collect()] == [('say "hi", ok', 5.0)]
    (tmp_path / "b.csv").write_text("n,name\n6,x\n")
    with pytest.raises(Exception):  # never by position
        read_csv(spark, str(tmp_path), schema).collect()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_with_line_breaks_in_many_splits(spark, tmp_path, end):
    """Random fields with quotes, commas and line breaks; records begin and end anywhere in the splits of a file."""
    import csv
    import random

    from pyspark.sql import types as T

    rng = random.Random(7)
    field = lambda: "".join(rng.choice(["a", " ", '"', ",", "\n", "é", "\n\n", '"\n'])  for _ in range(rng.randint(1, 12)))
    rows = [(str(i), field() if i % 5 else "long\n" * rng.randint(1, 400), i) for i in range(80)]
    for f in range(2):
        with open(tmp_path / f"{f}.csv", "w", newline="") as out:
            writer = csv.writer(out, lineterminator=end)
            writer.writerows([("k", "text", "n"), *rows[f::2]])
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n", T.LongType())])
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k, v in zip(old, ("2000", "1")):
            spark.conf.set(k, v)
        df = readers.read_csv(spark, str(tmp_path), schema)
        got = {r["k"]: (r["text"], r["n"]) for r in df.collect()}
        records = readers.csv_records(spark, str(tmp_path))
        assert records.select("file", "block").distinct().count() >= 8
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == {k: (t, n) for k, t, n in rows}


def test_csv_quotes_that_open_nothing(spark, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "a.csv").write_text('\n\nname,n\n5" disk,1\n\n"x\n",2\n,3\nshort\n')
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.LongType())])
    got = readers.read_csv(spark, str(tmp_path), schema).collect()
    assert sorted(map(tuple, got), key=str) == sorted([('5" disk', 1), ("x\n", 2), (None, 3), ("short", None)], key=str)


def test_split_keeps_rows_without_class_or_key(spark):
    from panelcraft.operators.splits import with_stratified_split

    rows = [(i, None if i % 3 == 0 else "ab"[i % 2]) for i in range(60)] + [(None, "a")]
    got = with_stratified_split(spark.createDataFrame(rows, "k long, c string"), "k", "c").groupBy("c", "is_test").count().collect()
    assert sum(r["count"] for r in got) == 61 and all(r["is_test"] is not None for r in got)
    assert {r["c"]: r["count"] for r in got if r["is_test"]}[None] == 4
