"""An index block of pieces stays small in a task's memory, and so does a range of anchors."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa

from panelcraft.llm.bytes_dedup import GRAM, LENGTH, repeated_by_runs
from panelcraft.llm.repeats import Symbols, _blocks, _entries


def test_index_blocks_take_bounded_memory():
    rng = np.random.default_rng(3)
    texts = rng.integers(97, 105, (1_200, 376)).astype(np.uint8)
    rows = [(i, k, t[k:].tobytes()) for i, t in enumerate(texts) for k in range(5)]  # of every anchor five pieces, one text
    held = pd.DataFrame(rows, columns=["anchor", "content", "piece"])
    tracemalloc.start()
    found = pd.concat(_blocks(Symbols("bytes", LENGTH, GRAM), repeated_by_runs)(iter([held])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == len(held) and held["piece"].map(len).sum() > 2_000_000
    # all windows of the shorter pieces lie in the longer ones; of the longest its first one does not
    assert all(r.runs == [int(r.content == 0), 376 - LENGTH + 1 - r.content] for r in found.itertuples())
    assert peak < 80_000_000


def test_anchor_ranges_are_even():
    text = np.random.default_rng(4).integers(97, 123, 400_000).astype(np.uint8).tobytes().decode()
    batch = pa.RecordBatch.from_pydict({"i0": pa.array([1], pa.int64()), "i1": pa.array([2], pa.int32()), "text": [text]})
    found = pa.Table.from_batches(_entries(Symbols("bytes", LENGTH, GRAM), 20)(iter([batch])))
    sizes = {p: len(e) for p, e in zip(found["part"].to_pylist(), found["entries"].to_pylist())}
    assert sorted(sizes) == list(range(20)) and max(sizes.values()) < 1.5 * min(sizes.values())
