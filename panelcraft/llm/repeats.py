"""What both substring operators share: find the places whose windows may occur elsewhere, bring equal ones together.

A text is a sequence of symbols, bytes or words. Each window of ``width`` symbols elects the smallest k-gram hash in
it, so equal windows elect equal k-grams: their anchor. The neighbouring windows of one text that elect the same
place form a piece, and only pieces of equal anchors need to be compared. Pieces that are equal as a whole are
counted, not compared; the rest goes to an index, block by block of whole anchors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcraft.llm.common import WordHashes, emptied_after, minimizers, scrambled, signed, slices
from panelcraft.session import cut_lineage

#: Symbols of a text that are looked at together; longer texts are cut, with overlap, so memory stays bounded.
STRETCH = 1 << 20
#: An anchor that so many places of one batch share is settled in the batch.
HEAVY = 32
#: Different pieces of one anchor that an index block takes; more are compared window by window, as rows.
CROWD = 4_096
#: Characters of text whose places one anchor range holds, about; ranges grow in number with the input, not in size.
RANGE_CHARS = 8_000_000
#: Bytes of pieces in an index block; an index takes about a hundred bytes of memory for each.
BLOCK = 500_000

_words = WordHashes()  # of this worker process
_BYTE_HASHES = scrambled(np.arange(1, 257, dtype=np.uint64))


@dataclass(frozen=True)
class Symbols:
    """``kind`` is "bytes" or "words"; windows are ``width`` symbols wide and elect k-grams of ``gram`` symbols."""

    kind: str
    width: int
    gram: int

    @property
    def dtype(self) -> np.dtype:
        return np.dtype(np.uint8 if self.kind == "bytes" else np.uint64)

    def of(self, text: str | None) -> np.ndarray:
        """Bytes, or 64-bit hashes of the words."""
        raw = (text or "").encode()
        return np.frombuffer(raw, np.uint8) if self.kind == "bytes" else _words.of(raw.split())

    def grams(self, symbols: np.ndarray) -> np.ndarray:
        """Hashes of all k-grams, by doubling."""
        h, span = (_BYTE_HASHES[symbols] if self.kind == "bytes" else symbols), 1
        while span < self.gram:
            step = min(span, self.gram - span)
            h = h[: len(h) - step] * np.uint64(0x9E3779B97F4A7C15) + (h[step:] ^ (h[step:] >> np.uint64(29)))
            span += step
        return scrambled(h)

    def pieces(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, first window and number of windows of each piece."""
        anchors, starts, spans = [], [], []
        for at in range(0, len(symbols) - self.width + 1, STRETCH):
            part = symbols[at : at + STRETCH + self.width - 1]
            h = self.grams(part)
            elected = minimizers(h, self.width - self.gram + 1)
            first = np.flatnonzero(np.r_[True, elected[1:] != elected[:-1]])
            anchors.append(scrambled(h[elected[first]]))  # elected hashes are small ones; ranges of them must be even
            starts.append(first + at)
            spans.append(np.diff(np.r_[first, len(elected)]))
        none = np.zeros(0, np.int64)
        return (np.concatenate(anchors), np.concatenate(starts), np.concatenate(spans)) if anchors else (none.astype(np.uint64), none, none)


_ENTRY = np.dtype([("anchor", "u8"), ("content", "u8"), ("i0", "i8"), ("i1", "i4"), ("start", "i8"), ("span", "i4")])
_PLACES = "i0 long, i1 int, anchor long, content long, start long, span int"


def _entries(symbols: Symbols, ranges: int):
    """Pieces of each batch, cut by anchor range; those of anchors that the batch itself holds often go apart."""
    width = np.uint64((1 << 64) // ranges + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 2)):
            parts, seen = [], xxhash.xxh3_64()
            for i0, i1, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                seq = symbols.of(text.as_py())
                anchors, starts, spans = symbols.pieces(seq)
                raw, size = memoryview(seq.tobytes()), seq.dtype.itemsize
                e = np.empty(len(anchors), _ENTRY)
                e["anchor"], e["i0"], e["i1"], e["start"], e["span"] = anchors, i0, i1, starts, spans
                ends = (starts + spans + symbols.width - 1) * size
                e["content"] = [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip((starts * size).tolist(), ends.tolist())]
                seen.update(b"%d %d" % (i0, i1))
                parts.append(e)
            e = np.concatenate(parts) if parts else np.empty(0, _ENTRY)
            e = e[np.argsort(e["anchor"], kind="stable")]
            first = np.flatnonzero(np.r_[True, e["anchor"][1:] != e["anchor"][:-1]]) if len(e) else np.zeros(0, np.int64)
            often = np.repeat(np.diff(np.r_[first, len(e)]) > HEAVY, np.diff(np.r_[first, len(e)]))
            apart, marks = e[often], np.unique(e["anchor"][often])
            e = e[~often]
            rows = [(ranges + seen.intdigest() % (1 << 20), apart.tobytes(), b"")] if len(apart) else []
            edges = np.arange(ranges + 1).astype(np.uint64)
            cut, cut_marks = np.searchsorted(e["anchor"] // width, edges), np.searchsorted(marks // width, edges)
            for r in range(ranges):
                if cut[r + 1] > cut[r] or cut_marks[r + 1] > cut_marks[r]:
                    mine = e[cut[r] : cut[r + 1]]
                    # column by column: what is alike lies together
                    rows.append((r, b"".join(mine[c].tobytes() for c in _ENTRY.names), marks[cut_marks[r] : cut_marks[r + 1]].tobytes()))
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([r for r, _, _ in rows], pa.int32()), "entries": pa.array([b for _, b, _ in rows], pa.binary()),
                "marks": pa.array([m for _, _, m in rows], pa.binary()),
            })

    return emptied_after(run)


def _columns(data: bytes) -> np.ndarray:
    n, at = len(data) // _ENTRY.itemsize, 0
    e = np.empty(n, _ENTRY)
    for c in _ENTRY.names:
        size = n * _ENTRY[c].itemsize
        e[c] = np.frombuffer(data[at : at + size], _ENTRY[c])
        at += size
    return e


def _shared(ranges: int):
    """Pieces of one range whose anchor is held elsewhere; those set apart by a batch are passed on."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if int(pdf["part"].iloc[0]) >= ranges:
            e = np.concatenate([np.frombuffer(b, _ENTRY) for b in pdf["entries"]])
        else:
            e = np.concatenate([_columns(b) for b in pdf["entries"]])
            marks = np.concatenate([np.frombuffer(b, np.uint64) for b in pdf["marks"]])
            e = e[np.argsort(e["anchor"], kind="stable")]
            same = e["anchor"][1:] == e["anchor"][:-1] if len(e) else np.zeros(0, bool)
            e = e[(np.r_[False, same] | np.r_[same, False] | np.isin(e["anchor"], marks)) if len(e) else np.zeros(0, bool)]
        return pd.DataFrame({
            "i0": e["i0"], "i1": e["i1"], "anchor": signed(e["anchor"].copy()), "content": signed(e["content"].copy()), "start": e["start"], "span": e["span"]
        })

    return run


_PIECES = "anchor long, content long, many boolean, crowd boolean, piece binary"


def _cut_pieces(symbols: Symbols):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, wanted in zip(b.column("text"), b.column("wanted").to_pylist()):
                seq, out = symbols.of(text.as_py()), {c: [] for c in ("anchor", "content", "many", "crowd", "piece")}
                for w in wanted:
                    for c in ("anchor", "content", "many", "crowd"):
                        out[c].append(w[c])
                    out["piece"].append(seq[w["start"] : w["start"] + w["span"] + symbols.width - 1].tobytes())
                yield pa.RecordBatch.from_pydict({
                    "anchor": pa.array(out["anchor"], pa.int64()), "content": pa.array(out["content"], pa.int64()), "many": pa.array(out["many"], pa.bool_()),
                    "crowd": pa.array(out["crowd"], pa.bool_()), "piece": pa.array(out["piece"], pa.binary()),
                })

    return emptied_after(run)


_RUNS = "anchor long, content long, runs array<int>"


def runs_of(flags: np.ndarray) -> list[int]:
    """Starts and ends, in turn, of the runs of true values."""
    return np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0])).tolist()


def _blocks(symbols: Symbols, repeated: Callable[[list[np.ndarray], int], list[np.ndarray]]):
    """Whole anchors, up to ``BLOCK`` bytes at a time, go through the index; flags of windows come back as runs."""

    def settle(held: pd.DataFrame) -> pd.DataFrame:
        pieces = [np.frombuffer(p, symbols.dtype) for p in held["piece"]]
        flags = repeated(pieces, symbols.width)
        out = held[["anchor", "content"]].assign(runs=[runs_of(f) for f in flags])
        return out[[bool(r) for r in out["runs"]]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for pdf in batches:
            sizes = pdf["piece"].map(len).to_numpy()
            anchor, at = pdf["anchor"].to_numpy(), 0
            ends = np.flatnonzero(np.r_[anchor[1:] != anchor[:-1], False]) + 1  # where the next row begins another anchor
            if held and len(pdf) and held[-1]["anchor"].iloc[-1] != anchor[0] and size >= BLOCK:
                yield settle(pd.concat(held))
                held, size = [], 0
            total = np.cumsum(sizes)
            for end in ends:
                if size + total[end - 1] - (total[at - 1] if at else 0) >= BLOCK:
                    held.append(pdf.iloc[at:end])
                    yield settle(pd.concat(held))
                    held, size, at = [], 0, end
            if at < len(pdf):
                held.append(pdf.iloc[at:])
                size += int(sizes[at:].sum())
        if held:
            yield settle(pd.concat(held))

    return run


def _window_rows(symbols: Symbols):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for anchor, content, many, piece in zip(*(b.column(c).to_pylist() for c in ("anchor", "content", "many", "piece"))):
                size = symbols.dtype.itemsize
                n = len(piece) // size - symbols.width + 1
                hashes = [xxhash.xxh3_128_digest(piece[i * size : (i + symbols.width) * size]) for i in range(n)]
                yield pa.RecordBatch.from_pydict({
                    "anchor": pa.array([anchor] * n, pa.int64()), "content": pa.array([content] * n, pa.int64()), "many": pa.array([many] * n, pa.bool_()),
                    "at": pa.array(range(n), pa.int32()), "window": pa.array(hashes, pa.binary()),
                })

    return run


def identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with 96 bits that tell rows apart by key and text; wholly equal rows share them, and their result."""
    return docs.withColumns({"__i0": F.xxhash64(F.col(key), F.col(text)), "__i1": F.hash(F.col(key), F.col(text))})


def repeated_windows(docs: DataFrame, text: str, symbols: Symbols, repeated: Callable[[list[np.ndarray], int], list[np.ndarray]]) -> DataFrame:
    """``i0, i1, runs``: for each row of ``docs`` (as ``identified``) with such windows, pairs of first window and
    window after the last, of windows that start anywhere else too."""
    spark: SparkSession = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = docs.agg(F.sum(F.length(text))).first()[0] or 0
    ranges = max(16, parts, size // RANGE_CHARS + 1)
    blobs = docs.select("__i0", "__i1", F.col(text)).mapInArrow(_entries(symbols, ranges), "part int, entries binary, marks binary")
    places = cut_lineage(blobs.groupBy("part").applyInPandas(_shared(ranges), _PLACES))
    kinds = places.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("k"), F.min(F.struct("i0", "i1", "start", "span")).alias("one"))
    kinds = cut_lineage(kinds)
    several = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    to_cut = kinds.join(several, "anchor").select(
        F.col("one.i0").alias("__i0"), F.col("one.i1").alias("__i1"),
        F.struct("anchor", "content", (F.col("k") > 1).alias("many"), (F.col("kinds") > CROWD).alias("crowd"), "one.start", "one.span").alias("w"),
    )
    wanted = to_cut.groupBy("__i0", "__i1").agg(F.collect_list("w").alias("wanted"))
    met = docs.select("__i0", "__i1", F.col(text).alias("text")).join(wanted, ["__i0", "__i1"]).select("text", "wanted")
    pieces = cut_lineage(met.mapInArrow(_cut_pieces(symbols), _PIECES))
    small = pieces.where("NOT crowd").select("anchor", "content", "piece").repartition(parts, "anchor").sortWithinPartitions("anchor", "content")
    indexed = small.mapInPandas(_blocks(symbols, repeated), _RUNS)
    windows = pieces.where("crowd").mapInArrow(_window_rows(symbols), "anchor long, content long, many boolean, at int, window binary")
    twice = windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window")
    crowded = windows.join(twice, "window").groupBy("anchor", "content").agg(F.flatten(F.collect_list(F.array("at", F.col("at") + 1))).alias("runs"))
    found = indexed.unionByName(crowded).groupBy("anchor", "content").agg(F.first("runs").alias("runs"))
    whole = kinds.where("k > 1").select("anchor", "content", F.array(F.lit(0), "one.span").alias("runs"))
    once = found.join(kinds.where("k > 1").select("anchor", "content"), ["anchor", "content"], "left_anti")
    marks = places.join(once.unionByName(whole), ["anchor", "content"])
    shifted = F.transform("runs", lambda x: x + F.col("start"))
    return marks.groupBy("i0", "i1").agg(F.flatten(F.collect_list(shifted)).alias("runs"))


def covered(runs: list[int] | np.ndarray | None, width: int) -> list[tuple[int, int]]:
    """Maximal stretches of symbols under windows of ``width`` that start inside ``runs``."""
    if runs is None or len(runs) == 0:
        return []
    pairs = np.asarray(runs, np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    low, high = pairs[:, 0], np.maximum.accumulate(pairs[:, 1] + width - 1)
    new = np.r_[True, low[1:] > high[:-1]]
    first = np.flatnonzero(new)
    return list(zip(low[first].tolist(), high[np.r_[first[1:] - 1, len(high) - 1]].tolist()))


def without(docs: DataFrame, text: str, runs: DataFrame) -> DataFrame:
    """``docs`` with its ``runs`` (null where none)."""
    return docs.join(runs.select(F.col("i0").alias("__i0"), F.col("i1").alias("__i1"), F.col("runs").alias("__runs")), ["__i0", "__i1"], "left")
