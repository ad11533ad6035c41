"""Removes byte strings that occur elsewhere, found with a run-length index."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.repeats import Symbols, covered, identified, repeated_windows, without
from panelcraft.llm.suffixes import SuffixOrder

LENGTH = 200
GRAM = 24


class RunLengthIndex:
    """Burrows-Wheeler transform of ``pieces`` by its runs, with a sample at both ends of each run.

    A sample is a place of the text and how far its suffix agrees with the neighbour beyond the run. Inside a run,
    going one symbol forward in the text makes an agreement one shorter; so the samples, of which a repetitive text has
    few, give the longest match of every place with any other, streamed in text order.
    """

    def __init__(self, pieces: list[np.ndarray]):
        order = SuffixOrder(pieces)
        self.size = len(order.symbols)
        self.starts, self.ends = order.starts, order.ends
        sa = order.order
        before = order.symbols[sa - 1]  # of the first place: the last end mark
        mark = before < len(pieces)
        head = np.r_[True, (before[1:] != before[:-1]) | mark[1:]] if self.size else np.zeros(0, bool)
        heads = np.flatnonzero(head)
        tails = np.r_[heads[1:] - 1, self.size - 1] if len(heads) else heads
        self.symbols, self.lengths = before[heads], tails - heads + 1  # the transform itself
        self.head_at, self.tail_at = sa[heads], sa[tails]
        self.head_match, self.tail_match = np.zeros(len(heads), np.int64), np.zeros(len(heads), np.int64)
        self.head_match[1:] = order.agree(sa[heads[1:] - 1], sa[heads[1:]])
        self.tail_match[:-1] = order.agree(sa[tails[:-1]], sa[tails[:-1] + 1])

    def matching_statistics(self) -> np.ndarray:
        """For each place of the text, end marks included, the longest match with another place."""
        best = np.zeros(self.size, np.int32)
        place = np.arange(self.size, dtype=np.int32)
        for at, match in ((self.head_at, self.head_match), (self.tail_at, self.tail_match)):
            value, last = np.zeros(self.size, np.int32), np.zeros(self.size, np.int32)
            value[at], last[at] = match, at
            np.maximum.accumulate(last, out=last)  # the last sampled place
            value = value[last]
            value -= place
            value += last
            np.maximum(best, value, out=best)
        return best


def repeated_by_runs(pieces: list[np.ndarray], width: int) -> list[np.ndarray]:
    """For each piece, which of its windows start anywhere else in ``pieces``."""
    if not pieces:
        return []
    index = RunLengthIndex(pieces)
    match = index.matching_statistics()
    return [match[a : b - width + 1] >= width for a, b in zip(index.starts, index.ends)]


def _kept(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [(t.as_py() or "").encode() for t in b.column("text")]
            spans = [covered(r.values.to_numpy() if r.is_valid else None, length) for r in b.column("runs")]
            kept = []
            for data, gone in zip(raw, spans):
                at = [0, *[x for s in gone for x in s], len(data)]
                kept.append(b"".join(data[i:j] for i, j in zip(at[::2], at[1::2])))
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "n_bytes": pa.array([len(d) for d in raw], pa.int64()),
                "spans": pa.array([[{"first": i, "after": j} for i, j in s] for s in spans], pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))),
                "kept": pa.array(kept, pa.binary()),
            })

    return run


def remove_repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for each row: maximal removed runs and the bytes that are left.

    Each byte under a string of ``length`` bytes that also starts anywhere else, in the same text or another, is
    removed; strings never cross texts and are judged on the input. Candidates share an elected k-gram; blocks of them
    are indexed by the runs of their Burrows-Wheeler transform, whose matching statistics mark the long matches.

    Null and empty texts have no bytes. Wholly equal rows are copies of each other like any others. Null keys are
    allowed. An empty table gives an empty result. Only ``key`` and ``text`` are read.
    """
    rows = identified(docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")), "doc_id", "text")
    runs = repeated_windows(rows, "text", Symbols("bytes", length, min(gram, length)), repeated_by_runs)
    met = without(rows, "text", runs).select("doc_id", "text", F.col("__runs").alias("runs"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return met.mapInArrow(_kept(length), f"doc_id {kind}, n_bytes long, spans array<struct<first:long,after:long>>, kept binary")


def brute_force(texts: list[str | None], length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """n_bytes, n_removed, n_spans, kept_sha256 of each text, by counting every string."""
    raw, seen = [(t or "").encode() for t in texts], {}
    for d in raw:
        for i in range(len(d) - length + 1):
            seen[d[i : i + length]] = seen.get(d[i : i + length], 0) + 1
    out = []
    for d in raw:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.r_[0, gone.astype(np.int8)]) == 1).sum())
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest()))
    return out
