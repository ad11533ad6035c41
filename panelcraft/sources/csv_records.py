"""Records of delimited text files that stay splittable although quoted fields may hold line breaks.

Whether a line starts inside quotes depends on all text before it. So every split reports what it does to either state,
outside or inside quotes; a prefix over the splits of a file, one row each, fixes which holds. Lines that are records by
themselves never move; only the lines of broken records are brought together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcraft.session import cut_lineage, scratch_folder
from panelcraft.sources.sinks import write_stage

OUTSIDE, INSIDE = 0, 1
#: The states of so many splits, a row each, are sent to all tasks; those of more are joined.
SENT_SPLITS = 100_000


def line_end(line: str, state: int, delimiter: str = ",", quote: str = '"') -> int:
    """State after a line that starts in ``state``. A quote opens a field only as its first character, and closes it
    unless it is doubled; anywhere else it is an ordinary character."""
    at, n = 0, len(line)
    while True:
        if state == INSIDE:
            at = line.find(quote, at)
            while 0 <= at < n - 1 and line[at + 1] == quote:
                at = line.find(quote, at + 2)
            if at < 0:
                return INSIDE
            state = OUTSIDE
        elif at < n and line[at] == quote:
            state, at = INSIDE, at + 1
            continue
        at = line.find(delimiter, at)
        if at < 0:
            return OUTSIDE
        at += 1


def _states(delimiter: str, quote: str):
    """Lines of each split with their number, and for either state before the split: the state before and after the
    line, and how many records have begun in the split up to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, number, states, begun = None, 0, [OUTSIDE, INSIDE], [0, 0]
        for b in batches:
            plain = pc.invert(pc.match_substring(b.column("value"), quote)).to_pylist()
            texts = b.column("value").to_pylist()
            blank = pc.equal(pc.utf8_trim_whitespace(b.column("value")), "").to_pylist()
            keys = zip(b.column("file").to_pylist(), b.column("block").to_pylist())
            rows: dict[str, list] = {c: [] for c in ("line", "s0", "e0", "r0", "s1", "e1", "r1")}
            k = 0
            for key, run_ in groupby(keys):
                if key != place:
                    place, number, states, begun = key, 0, [OUTSIDE, INSIDE], [0, 0]
                for _ in run_:
                    rows["line"].append(number)
                    for h in (0, 1):
                        before = states[h]
                        begun[h] += before == OUTSIDE and not blank[k]
                        if not plain[k]:
                            states[h] = line_end(texts[k], before, delimiter, quote)
                        rows[f"s{h}"].append(before)
                        rows[f"e{h}"].append(states[h])
                        rows[f"r{h}"].append(begun[h])
                    number += 1
                    k += 1
            columns = [*b.columns, *[pa.array(v, pa.int64()) for v in rows.values()]]
            yield pa.RecordBatch.from_arrays(columns, names=[*b.schema.names, *rows])

    return run


def csv_records(spark: SparkSession, path: str | Sequence[str], delimiter: str = ",", quote: str = '"') -> DataFrame:
    """``file, block, record, value``: the records of the files, those with line breaks in quotes in one piece.

    ``block`` is the place in the file of the split where a record begins, ``record`` its number there, from 1. Lines end
    with a line feed or with a carriage return and a line feed; inside quotes either becomes a line feed. Blank lines
    between records are left out.
    """
    lines = spark.read.format("text").option("lineSep", "\n").load(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.regexp_replace("value", "\r$", "").alias("value"),
    )
    schema = "file string, block long, value string, line long, s0 long, e0 long, r0 long, s1 long, e1 long, r1 long"
    # stored once: splits, whole records and broken ones are read from it, and lines pass through Python a single time
    both = write_stage(lines.mapInArrow(_states(delimiter, quote), schema), scratch_folder(spark, "csv-lines"))
    # a split keeps the state before it, swaps it, or sets it: what it was set to last, and the swaps since, fix it
    last = F.max_by(F.struct("e0", "e1", "r0", "r1"), "line")
    splits = both.groupBy("file", "block").agg(last.alias("x")).select("file", "block", "x.*")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.sum((F.col("e0") > F.col("e1")).cast("int"))
    known = splits.withColumn("swaps", swaps.over(order))
    known = known.withColumn("set", F.when(F.col("e0") == F.col("e1"), (F.col("e0") + F.col("swaps")) % 2))
    flips = F.coalesce(F.last("swaps").over(before), F.lit(0))
    known = known.withColumn("state", (F.coalesce(F.last("set", ignorenulls=True).over(before), F.lit(OUTSIDE)) + flips) % 2)
    records = F.when(F.col("state") == OUTSIDE, F.col("r0")).otherwise(F.col("r1"))
    owner = F.when(records > 0, F.struct(F.col("block").alias("block"), records.alias("record")))
    known = known.withColumn("owner", owner).withColumn("owner", F.last("owner", ignorenulls=True).over(before))
    known = cut_lineage(known.select(F.col("file").alias("in_file"), F.col("block").alias("in_block"), "state", "owner"))
    if known.count() <= SENT_SPLITS:
        known = F.broadcast(known)
    pick = lambda c: F.when(F.col("state") == OUTSIDE, F.col(f"{c}0")).otherwise(F.col(f"{c}1"))
    met = both.join(known, (F.col("file") == F.col("in_file")) & (F.col("block") == F.col("in_block")))
    met = met.select("file", "block", "line", "value", pick("s").alias("s"), pick("e").alias("e"), pick("r").alias("record"), "owner")
    alone = (F.col("s") == OUTSIDE) & (F.col("e") == OUTSIDE)
    whole = met.where(alone).select("file", "block", "record", "value")
    home = F.when(F.col("record") > 0, F.struct("block", "record")).otherwise(F.col("owner"))
    parts = met.where(~alone).select("file", home.alias("home"), F.struct("block", "line", "value").alias("part"))
    broken = parts.groupBy("file", "home").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    joined = broken.select("file", "home.block", "home.record", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"))
    return whole.unionByName(joined).where(F.trim("value") != "")
