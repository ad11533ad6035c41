"""Quality classifier: random-indexing word vectors pooled per document, and a small network on top."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.common import WordMemory, emptied_after, forget_words

#: Word vectors: rows of a hashed table, so that its size does not follow the vocabulary.
SLOTS = 8_192
WIDTH = 64
#: Neighbours on each side that add their index vectors, and non-zero entries of an index vector.
AROUND = 2
NONZERO = 2
#: Rows the network is fitted on at most; those with the smallest hash of their key.
FIT_ROWS = 20_000
HIDDEN = 32
EPOCHS = 60
SEED = 5
_SPREAD = 64  # parts in which tables of counts travel


#: Letters become a or A (all bytes beyond ASCII: a), digits 0.
_OUTLINE = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c > 127 else 48 if 48 <= c <= 57 else c for c in range(256))
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)
_WORD_SLOTS = SLOTS - SLOTS // 8


class _Slots(WordMemory):
    """Word -> slot of the word and slot of its outline, as one number."""

    def work_out(self, word: bytes) -> int:
        outline = _RUNS.sub(rb"\1", word.translate(_OUTLINE))
        out = _WORD_SLOTS + xxhash.xxh3_64_intdigest(outline) % (SLOTS // 8)
        return xxhash.xxh3_64_intdigest(word.lower()) % _WORD_SLOTS * SLOTS + out

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the words, slots of their outlines."""
        ws = text.split()
        return np.divmod(np.fromiter((self[w] for w in ws), np.int64, len(ws)), SLOTS)


_slots = _Slots()  # of this worker process


def index_vectors(seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of each slot's sparse random index vector."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, WIDTH, (SLOTS, NONZERO)), rng.choice([-1.0, 1.0], (SLOTS, NONZERO))


def _neighbourhoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of neighbours' index vectors over a task's rows, as parts of the slot table."""
    places, signs = index_vectors()
    total, waiting = np.zeros(SLOTS * WIDTH), []

    def settle() -> None:
        for own, other in waiting:
            for k in range(NONZERO):
                np.add(total, np.bincount(own * WIDTH + places[other, k], signs[other, k], SLOTS * WIDTH), out=total)
        waiting.clear()

    pending = 0
    for batch in batches:
        for text in batch.column(0):
            if not text.is_valid:
                continue
            for line in _slots.of(text.as_py().encode()):
                for d in range(1, AROUND + 1):
                    if len(line) > d:
                        waiting.append((line[:-d], line[d:]))
                        waiting.append((line[d:], line[:-d]))
                        pending += 2 * len(line)
            if pending > 2_000_000:
                waiting[:] = [tuple(np.concatenate(x) for x in zip(*waiting))]
                settle()
                pending = 0
    if waiting:
        waiting[:] = [tuple(np.concatenate(x) for x in zip(*waiting))]
        settle()
    parts = total.astype(np.float64).reshape(_SPREAD, -1)
    yield pa.RecordBatch.from_pydict({"part": pa.array(range(_SPREAD), pa.int32()), "sums": pa.array([p.tobytes() for p in parts], pa.binary())})


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(SLOTS * WIDTH // _SPREAD)
    for b in pdf["sums"]:
        total += np.frombuffer(b)
    return pd.DataFrame({"part": [pdf["part"].iloc[0]], "sums": [total.tobytes()]})


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Unit context vector of each slot, from every text of ``docs``.

    A task sends one fixed table of whole numbers in parts; parts are added in two steps, so no task meets more than
    the square root of the number of tasks. The result has a fixed size (``SLOTS`` x ``WIDTH``).
    """
    local = docs.select(text).mapInArrow(emptied_after(_neighbourhoods), "part int, sums binary")
    some = F.pmod(F.spark_partition_id(), F.lit(64))
    half = local.withColumn("some", some).groupBy("part", "some").applyInPandas(_added, "part int, sums binary")
    parts = half.groupBy("part").applyInPandas(_added, "part int, sums binary").collect()
    table = np.zeros((_SPREAD, SLOTS * WIDTH // _SPREAD))
    for row in parts:
        table[row["part"]] = np.frombuffer(row["sums"])
    table = table.reshape(SLOTS, WIDTH)
    norms = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.where(norms > 0, norms, 1.0)).astype(np.float32)


def _pooled(text: bytes, vectors: np.ndarray) -> np.ndarray:
    """Means of the word and of the outline vectors; the length, the share of text on lines seen before, and the
    share of words equal to the word before, which a mean cannot show."""
    both = _slots.of(text)
    n = len(both[0])
    if not n:
        return np.zeros(2 * WIDTH + 3)
    means = [sum(vectors[line[i : i + 65_536]].sum(axis=0, dtype=np.float64) for i in range(0, n, 65_536)) / n for line in both]
    lines = text.split(b"\n")
    again = len(text) - sum(map(len, set(lines)))
    return np.concatenate([*means, [math.log1p(n) / 10, again / len(text), np.count_nonzero(both[0][1:] == both[0][:-1]) / n]])


@dataclass
class Network:
    """Two layers on standardised inputs; the temperature makes its probabilities honest on rows kept apart."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def margins(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x) / self.temperature, -30, 30)))


def fit_network(x: np.ndarray, y: np.ndarray, apart: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Adam on the log loss of the rows that are not ``apart``; then the temperature with the least loss on those that are."""
    rng = np.random.default_rng(seed)
    fit, yf = x[~apart], y[~apart].astype(float)
    mean, scale = fit.mean(0), fit.std(0) + 1e-6
    z = (fit - mean) / scale
    p = [rng.normal(0, math.sqrt(2 / z.shape[1]), (z.shape[1], hidden)), np.zeros(hidden), rng.normal(0, math.sqrt(1 / hidden), hidden), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(z)), max(1, len(z) // 128)):
            h = np.maximum(z[rows] @ p[0] + p[1], 0)
            g = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3][0], -30, 30))) - yf[rows]) / len(rows)
            gh = np.outer(g, p[2]) * (h > 0)
            grads, step = [z[rows].T @ gh + 1e-4 * p[0], gh.sum(0), h.T @ g + 1e-4 * p[2], np.array([g.sum()])], step + 1
            for i, grad in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * grad
                v[i] = 0.999 * v[i] + 0.001 * grad**2
                p[i] = p[i] - 0.003 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]))
    if apart.any():
        margin, ya = net.margins(x[apart]), y[apart]
        loss = lambda t: np.logaddexp(0, np.where(ya == 1, -margin, margin) / t).mean()
        net.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    return net


def fold(key) -> F.Column:
    """Remainder by 5 of the checksum of the key as text; 0 is held out."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(5))


def fit_classifier(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = FIT_ROWS) -> tuple[np.ndarray, Network | None]:
    """Word vectors from all texts, and the network from at most ``rows`` labelled rows outside fold 0.

    Fold 1 of those is kept apart for the temperature. Both results have a fixed size. Without a labelled row, or
    with one class only, there is no network.
    """
    vectors = word_vectors(docs, text)
    marked = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("__id")).agg(F.max(label).alias("__y"))
    chosen = marked.where(fold("__id") != 0).orderBy(F.xxhash64("__id"), "__id").limit(rows)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [_pooled((t.as_py() or "").encode(), shared.value).tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_pydict({"apart": b.column("apart"), "y": b.column("y"), "x": pa.array(x, pa.binary())})

    met = docs.join(F.broadcast(chosen), F.col(key) == F.col("__id"))  # at most ``rows`` ids are sent
    found = met.select((fold(key) == 1).alias("apart"), F.col("__y").cast("int").alias("y"), F.col(text).alias("text"))
    got = found.mapInArrow(emptied_after(features), "apart boolean, y int, x binary").toPandas()
    if got["y"].nunique() < 2:
        return vectors, None
    got = got.sort_values(["x", "y"], kind="stable")  # the order of tasks must not change the fit
    got = got.iloc[: 2 * rows]  # keys may repeat in ``docs``
    x = np.stack([np.frombuffer(b) for b in got["x"]])
    apart = got["apart"].to_numpy(bool)
    return vectors, fit_network(x, got["y"].to_numpy(), apart if (~apart).any() and len(set(got["y"][~apart])) == 2 else np.zeros(len(got), bool))


def classify(docs: DataFrame, vectors: np.ndarray, network: Network | None, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 under ``name``.

    Scores see the text only; each row is scored where it lies. Null and empty texts get the score of a document
    without words; without a network all scores are 0.5. Extra columns pass, one that bears the name of the result is
    replaced. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table, net = shared.value
        for part in texts:
            if net is None or not len(part):
                yield pd.Series(np.full(len(part), 0.5))
                continue
            x = np.stack([_pooled(b"" if t is None else t.encode(), table) for t in part])
            yield pd.Series(net.scores(x))
        forget_words()

    return docs.withColumn(name, scored(F.col(text).cast("string")))
