"""What several operators of this package share: words, seeded fractions, groups of linked ids."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcraft.session import cut_lineage, scratch_folder

SPACES = r"[\x20\x09-\x0D]+"
#: Words, and bytes of words, that a task remembers; a larger vocabulary starts afresh, so memory stays bounded.
CACHED_WORDS, CACHED_BYTES = 300_000, 16_000_000
#: Bytes of texts that a task takes at a time, about; a single longer text is taken alone.
SLICE_BYTES = 16_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)


def words(text: str | Column) -> Column:
    """Maximal runs of characters other than space, tab and line ends; an empty array without text."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(c, F.lit("")), SPACES), lambda w: w != "")


def n_words(text: str | Column) -> Column:
    """How many words ``words`` would give, without making them."""
    c = F.col(text) if isinstance(text, str) else text
    marks = F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return (F.length(marks) - F.length(F.replace(marks, F.lit("x"), F.lit("")))).cast("long")


def meet_small(rows: DataFrame, small: DataFrame, on: Column, how: str, most_rows: int = 100_000) -> DataFrame:
    """Join with a table that is small as a rule: broadcast when it is stored and counted as such, else shuffled."""
    stored = cut_lineage(small)
    return rows.join(F.broadcast(stored) if stored.count() <= most_rows else stored, on, how)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table in the shared folder: lost executors do not take it along."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def seeded_fraction(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the key and the seed only; the same in any SQL engine with md5."""
    digest = F.md5(F.concat_ws("-", F.coalesce(key.cast("string"), F.lit("null")), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


_memories: list[WordMemory] = []  # of this worker process


class WordMemory(dict):
    """What a task works out for words, remembered while it fits; see ``emptied_after``."""

    held = 0

    def __init__(self):
        super().__init__()
        _memories.append(self)

    def work_out(self, word):
        raise NotImplementedError

    def __missing__(self, word):
        if len(self) >= CACHED_WORDS or self.held >= CACHED_BYTES:
            self.clear()
        self.held += len(word)
        found = self[word] = self.work_out(word)
        return found

    def clear(self) -> None:
        super().clear()
        self.held = 0


def forget_words() -> None:
    for memory in _memories:
        memory.clear()


def emptied_after(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a partition; no word is remembered when the partition has ended.

    Python workers live on from stage to stage, and what they remember would pile up.
    """

    def bounded(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            forget_words()

    return bounded


class WordHashes(WordMemory):
    """64-bit hashes of byte words."""

    def work_out(self, word: bytes) -> int:
        return xxhash.xxh3_64_intdigest(word)

    def of(self, ws: list[bytes]) -> np.ndarray:
        return np.fromiter((self[w] for w in ws), np.uint64, len(ws))


def scrambled(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX2
    x = (x ^ (x >> np.uint64(27))) * _MIX
    return x ^ (x >> np.uint64(31))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash for each run of ``width`` neighbouring hashes; order matters."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = out * _MIX + hashes[i : i + n]
    return scrambled(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def minimizers(h: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` neighbours of ``h``, the position of its smallest value (the leftmost one)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at, span = h.copy(), np.arange(len(h), dtype=np.int64), 1
    while span < width:  # doubling: minima over 1, 2, 4 ... and at last over exactly ``width``
        step = min(span, width - span)
        take = best[step:] < best[: len(best) - step]
        at = np.where(take, at[step:], at[: len(at) - step])
        best = np.where(take, best[step:], best[: len(best) - step])
        span += step
    return at[:n]


def linked_groups(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``node, component``: the smallest id reachable from each id that ``edges (u, v)`` names.

    Large-star and small-star steps by turns, each stored reliably; the count and a checksum of the links tell
    when they have settled. A star's centre may hold any share of all links: minima are combined before they
    move, and the joins are plain equi-joins that adaptive execution splits.
    """
    links = cut_lineage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    mark = None
    for _ in range(max_rounds):
        row = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if row == mark or row[0] == 0:
            break
        mark = row
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where((F.col("v") > F.col("u")) & (F.col("v") != F.col("m"))).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(down.select("u", F.col("m").alias("v"))).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        links = cut_lineage(small.where("u <> v").distinct())
    else:
        raise RuntimeError("the groups did not settle")
    stars = links.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    centres = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(centres.join(stars.select("node"), "node", "left_anti"))


def slices(batch: pa.RecordBatch, text: int | pa.Array, rows: int = 10_000, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """``batch`` in consecutive slices of at most ``rows`` rows and about ``most`` bytes (``SLICE_BYTES``) of ``text``,
    a column of it or strings of its rows."""
    most = SLICE_BYTES if most is None else most
    column = batch.column(text) if isinstance(text, int) else text
    sizes = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in column], np.int64)
    start, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and (size + n > most or i - start >= rows):
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows or not batch.num_rows:
        yield batch.slice(start)


def texts_of(batch: Iterable) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null is empty."""
    return [b"" if v is None else v.encode() for v in batch]
