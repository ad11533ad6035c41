"""Removes passages of words that occur elsewhere, by relative Lempel-Ziv parsing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.repeats import Symbols, covered, identified, repeated_windows, without
from panelcraft.llm.suffixes import SuffixOrder

WORDS = 35
GRAM = 6


class ReferenceBlock:
    """An indexed block of pieces; says how far the text from a place on can be copied from another place of it."""

    def __init__(self, pieces: list[np.ndarray]):
        self.index = SuffixOrder(pieces)
        sa = self.index.order
        with_next = self.index.agree(sa[:-1], sa[1:])
        self.longest = np.zeros(len(sa), np.int64)
        self.longest[sa] = np.maximum(np.r_[0, with_next], np.r_[with_next, 0])

    def factor(self, places: np.ndarray) -> np.ndarray:
        return self.longest[places]


def repeated_by_factors(pieces: list[np.ndarray], width: int) -> list[np.ndarray]:
    """For each piece, which of its windows start anywhere else in ``pieces``.

    Every piece is parsed greedily into the longest factors that can be copied from elsewhere in the block. Windows
    inside one factor are repeated. A window across the end of a factor may be part of a longer match that began
    inside it, so those are looked up one by one.
    """
    if not pieces:
        return []
    block = ReferenceBlock(pieces)
    starts, ends = block.index.starts, block.index.ends
    flags = np.zeros(len(block.index.symbols), bool)
    live, at = np.arange(len(pieces)), starts.copy()
    near = np.arange(width)
    while len(live):
        # one factor of every piece that is not yet parsed to its end
        length = np.maximum(block.factor(at[live]), 1)
        after = np.minimum(at[live] + length, ends[live])
        inside = np.maximum(after - width + 1 - at[live], 0)
        if inside.any():
            offset = np.arange(inside.sum()) - np.repeat(np.cumsum(inside) - inside, inside)
            flags[np.repeat(at[live], inside) + offset] = True
        across = np.maximum(after[:, None] - width + 1, at[live][:, None]) + near
        check = across[(across < after[:, None]) & (across + width <= ends[live][:, None])]
        flags[check[block.factor(check) >= width]] = True
        at[live] = after
        live = live[at[live] + width <= ends[live]]
    return [flags[a : b - width + 1] for a, b in zip(starts, ends)]


def _kept(width: int, spaced: bool):
    """The words left of each text: joined by spaces, or with the text's own spaces around them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        word = re.compile(r"[^\x20\x09-\x0D]+")
        for b in batches:
            texts = [t.as_py() for t in b.column("text")]
            kept, spans, counts = [], [], []
            for text, r in zip(texts, b.column("runs")):
                gone = covered(r.values.to_numpy() if r.is_valid else None, width)
                if spaced and not gone:
                    kept.append(text)
                    spans.append([])
                    counts.append(len((text or "").encode().split()))
                    continue
                found = [m.span() for m in word.finditer(text or "")]
                at = [0, *[x for s in gone for x in s], len(found)]
                if spaced:  # a removed passage takes the spaces after it along
                    cuts = [0, *[found[x][0] if x < len(found) else len(text) for s in gone for x in s], len(text)]
                    kept.append("".join(text[i:j] for i, j in zip(cuts[::2], cuts[1::2])))
                else:
                    kept.append(" ".join(text[x:y] for i, j in zip(at[::2], at[1::2]) for x, y in found[i:j]))
                spans.append([{"first": i, "after": j} for i, j in gone])
                counts.append(len(found))
            yield pa.RecordBatch.from_arrays([
                *[b.column(c) for c in b.schema.names if c not in ("text", "runs")], pa.array(counts, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))), pa.array(kept, pa.string()),
            ], names=[*[c for c in b.schema.names if c not in ("text", "runs")], "n_words", "spans", "kept"])

    return run


def remove_repeated_words(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WORDS, gram: int = GRAM, spaced: bool = False) -> DataFrame:
    """``row, n_words, spans, kept`` for each row: the row itself as a struct, the removed runs of words, the text left.

    Each word under a window of ``width`` words whose words also start anywhere else, in the same text or another, is
    removed; windows never cross texts and are judged on the input. ``kept`` joins the words left by one space, or
    keeps the text's own spaces with ``spaced``. Words are compared by 64-bit hashes, ``width`` of them at a time.

    Null and empty texts have no words; with ``spaced`` they stay as they are. Wholly equal rows are copies of each
    other like any others. Null keys are allowed. An empty table gives an empty result. Extra columns pass inside
    ``row``, whatever their names.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("__key"), F.col(text).cast("string").alias("text"))
    rows = identified(rows, "__key", "text")
    runs = repeated_windows(rows, "text", Symbols("words", width, min(gram, width)), repeated_by_factors)
    rest = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name == text else F.col("row")[f.name].alias(f.name) for f in docs.schema.fields])
    met = without(rows.withColumn("row", rest), "text", runs).select("row", "text", F.col("__runs").alias("runs"))
    kind = met.schema["row"].dataType.simpleString()
    return met.mapInArrow(_kept(width, spaced), f"row {kind}, n_words long, spans array<struct<first:long,after:long>>, kept string")


def brute_force(texts: list[str | None], width: int = WORDS) -> list[tuple[int, int, str]]:
    """n_words, n_removed and the words kept of each text, by counting every window."""
    docs, seen = [(t or "").encode().split() for t in texts], {}
    for d in docs:
        for i in range(len(d) - width + 1):
            w = tuple(d[i : i + width])
            seen[w] = seen.get(w, 0) + 1
    out = []
    for d in docs:
        gone = [False] * len(d)
        for i in range(len(d) - width + 1):
            if seen[tuple(d[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((len(d), sum(gone), b" ".join(w for w, g in zip(d, gone) if not g).decode()))
    return out
