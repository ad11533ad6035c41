"""Session defaults and the one place that decides where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",  # split a hot key even where joins share a shuffle
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "panelcraft", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's defaults; cluster sizing stays with the caller."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``; a temporary folder only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="panelcraft-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably (survives executor loss) and drop its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, inside the session's checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a scratch folder, and read from there."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def every_pair(left: DataFrame, right: DataFrame, on: Column | None = None) -> DataFrame:
    """Each row of ``left`` beside each of ``right`` (where ``on`` holds), the rows of a part of ``left`` one after the other.
    Both should be stored: the parts of ``right`` are read again for each part of ``left``, and nothing is shuffled or
    broadcast, however many pairs there are."""
    return left.hint("shuffle_replicate_nl").join(right, F.lit(True) if on is None else on)


#: Parts a core, at most, in which many passes read their rows.
PARTS_A_CORE = 4


def in_few_parts(df: DataFrame) -> DataFrame:
    """``df`` in a few parts a core at most, without a shuffle. A task reports to the driver whatever it read, so the
    reports of many passes would grow with the parts of the input."""
    return df.coalesce(PARTS_A_CORE * df.sparkSession.sparkContext.defaultParallelism)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in a part for every core at least. Narrow tables are read in few parts, and what passes over them many
    times would leave most cores idle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Rows for many passes, spread over the cores and kept meanwhile; rows that the caller keeps stay as they are."""
    if df.storageLevel.useMemory or df.storageLevel.useDisk:
        yield df
        return
    rows = df.persist()  # first, so that counting its parts works nothing out twice
    wide = spread(rows)
    try:
        yield rows if wide is rows else wide.persist()
    finally:
        if wide is not rows:
            wide.unpersist()
        rows.unpersist()


def side_by_side(steps: Sequence[Callable[[], Any]], at_once: int = 4) -> list:
    """Submit independent jobs together, so that the tail of one does not leave executors idle."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]
