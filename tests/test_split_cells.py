"""A cell of many rows is cut into the parts it needs."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelcraft.operators import panel_windows as pw

KEY = pw.PanelKey(tiebreak=("row_id",))


def test_big_cells_are_cut_into_as_many_parts_as_they_need(spark):
    day = F.to_date(F.when(F.col("row_id") < 1200, F.lit("2021-01-01")).otherwise(F.lit("2021-01-02")))
    df = spark.range(1300).withColumnRenamed("id", "row_id").select("row_id", F.lit("a").alias("location"), day.alias("date"))
    df = df.withColumn("x", F.when(F.col("row_id") % 700 == 3, F.col("row_id").cast("double")))
    found = pw._split_cells(df, KEY, 500).groupBy("date", "_part").agg(F.count("*").alias("n"), F.min("row_id").alias("a"), F.max("row_id").alias("z"))
    sizes = sorted(((r["a"], r["z"], r["n"]) for r in found.collect() if r["a"] < 1200))
    assert 3 <= len(sizes) <= 5 and max(n for *_, n in sizes) <= 500 and sum(n for *_, n in sizes) == 1200
    assert all(z < a for (_, z, _), (a, *_) in zip(sizes, sizes[1:]))  # ranges of the tiebreak
    run = Window.partitionBy("location").orderBy("date", "row_id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("x", F.last("x", ignorenulls=True).over(run)).orderBy("row_id").collect()
    assert pw.forward_fill(df, KEY, ["x"], max_rows=500).select(*df.columns).orderBy("row_id").collect() == want
