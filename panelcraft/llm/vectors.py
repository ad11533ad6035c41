"""Near-duplicate embeddings by PCA-ordered tiled comparison."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import md5
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcraft.llm.common import linked_groups
from panelcraft.session import every_pair, stored

#: Vectors in a tile, and dimensions added to the partial products at a time.
TILE = 1_024
STEP = 16
#: Pairs of vectors that a task collects before it tells their links.
HELD = 1 << 16
#: Leading directions whose bands tell which tiles can meet.
BANDS = 2
_SLACK = 1e-9


def _units(x: np.ndarray) -> np.ndarray:
    """Rows divided by their length; the same bits for the same row, whatever rows are beside it."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow of the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True)) + 0.0


def _matrix(column, width: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(-1, width)


def _moments(width: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                part = _units(_matrix(b.column("raw").to_pylist(), width, kind))
                part = np.hstack([part, np.ones((len(part), 1))])
                total = part.T @ part if total is None else total + part.T @ part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"m": pa.array([total.tobytes()], pa.binary())})

    return run


def _principal(good: DataFrame, width: int, kind: str) -> np.ndarray:
    """Orthogonal directions by falling variance; only (width + 1)-square sums leave the tasks."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum((np.frombuffer(v) for b in batches for v in b.column("m").to_pylist()), np.zeros((width + 1) ** 2))
        yield pa.RecordBatch.from_pydict({"m": pa.array([total.tobytes()], pa.binary())})

    sums = good.select("raw").mapInArrow(_moments(width, kind), "m binary").repartition(16).mapInArrow(added, "m binary").collect()
    m = sum((np.frombuffer(r["m"]) for r in sums), np.zeros((width + 1) ** 2)).reshape(width + 1, width + 1)
    n = max(m[-1, -1], 1.0)
    cov = m[:-1, :-1] / n - np.outer(m[-1, :-1], m[-1, :-1]) / n**2
    return np.linalg.eigh((cov + cov.T) / 2)[1][:, ::-1]


def _suffixes(x: np.ndarray) -> np.ndarray:
    """Norms of what is left of each row from each dimension on."""
    return np.sqrt(np.maximum(np.cumsum(x[:, ::-1] ** 2, axis=1)[:, ::-1], 0))


def _near(a: np.ndarray, sa: np.ndarray, b: np.ndarray, sb: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose product can reach ``least``: leading dimensions first, the rest bounded by suffix norms."""
    width = a.shape[1]
    if width > STEP:  # the bound of the rest is one dimension more
        got = np.hstack([a[:, :STEP], sa[:, STEP : STEP + 1]]) @ np.hstack([b[:, :STEP], sb[:, STEP : STEP + 1]]).T
    else:
        got = a @ b.T
    i, j = np.divmod(np.flatnonzero(got >= least - _SLACK), got.shape[1] or 1)
    if width > STEP:
        part = got[i, j] - sa[i, STEP] * sb[j, STEP]
    for k in range(STEP, width, STEP):  # pairs that cannot reach the threshold drop out after each block
        part = part + np.einsum("ij,ij->i", a[i, k : k + STEP], b[j, k : k + STEP])
        rest = sa[i, k + STEP] * sb[j, k + STEP] if k + STEP < width else 0.0
        keep = part >= least - _SLACK - rest
        i, j, part = i[keep], j[keep], part[keep]
    return i, j


class _Tile:
    """Unit vectors of a stored tile, their turned form, ids and weights."""

    def __init__(self, row: dict, side: str, width: int, kind: str, turn: np.ndarray):
        self.unit = _units(np.frombuffer(row["v" + side], kind).reshape(-1, width))
        self.turned = self.unit @ turn
        self.rest = _suffixes(self.turned)
        self.ids, self.weights = (np.frombuffer(row[c + side], np.int64) for c in "iw")


def _tile_pairs(width: int, kind: str, turn: np.ndarray, least: float):
    """Links between the tiles ``a`` and ``b`` of each row, as sums and a spanning set of links per vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, left = None, None
        for batch in batches:
            for i in range(batch.num_rows):  # a row at a time: a batch holds many tiles
                row = batch.slice(i, 1).to_pylist()[0]
                if row["ta"] != tile:  # pairs come by their first tile
                    tile, left = row["ta"], _Tile(row, "a", width, kind, turn)
                same = row["tb"] == tile
                found = _links(left, left if same else _Tile(row, "b", width, kind, turn), same, least)
                if found is not None:
                    yield found

    return run


def _links(a: _Tile, b: _Tile, same: bool, least: float) -> pa.RecordBatch | None:
    pairs = []
    step = max(1, HELD * 16 // max(1, len(b.ids)))
    for start in range(0, len(a.ids), step):
        part = slice(start, start + step)
        i, j = _near(a.turned[part], a.rest[part], b.turned, b.rest, least)
        i = i + start
        if same:
            i, j = i[i < j], j[i < j]
        for s in range(0, len(i), HELD):  # the exact test, on unit vectors in double precision and their own dimensions
            p, q = i[s : s + HELD], j[s : s + HELD]
            ok = np.einsum("ij,ij->i", a.unit[p], b.unit[q]) >= least
            pairs.append((p[ok], q[ok]))
    i, j = (np.concatenate([p[k] for p in pairs]) if pairs else np.zeros(0, np.int64) for k in (0, 1))
    if not len(i):
        return None
    links = np.concatenate([np.bincount(i, b.weights[j], len(a.ids)), np.bincount(j, a.weights[i], len(b.ids))])
    ids, peer = np.concatenate([a.ids, b.ids]), _spanning(i, j + len(a.ids), a.ids, b.ids)
    keep = links > 0
    return pa.RecordBatch.from_pydict({
        "id": pa.array(ids[keep]), "links": pa.array(links[keep].astype(np.int64)), "peer": pa.array(peer[keep])
    })


def _spanning(i: np.ndarray, j: np.ndarray, ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """For each vector of two tiles the smallest id of its group of links inside them: as many links as vectors."""
    low = np.concatenate([ia, ib]).copy()
    while len(i):
        was = low.copy()
        np.minimum.at(low, i, was[j])
        np.minimum.at(low, j, low[i])
        if (low == was).all():
            break
    return low


def link_embeddings(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.95, tile: int = TILE
) -> DataFrame:
    """``vec_id, n_links, component_id, kept, n_copies`` for each row: near-duplicates by cosine of at least ``least``.

    Equal unit vectors are merged with their number first, so a crowd of copies is one vector. The others are turned
    into principal directions and cut into tiles inside bands of the leading ones: two vectors that near differ by
    at most sqrt(2 - 2 least) in any direction, so only tiles of neighbouring bands whose ranges come that close meet.
    Tiles are stored once, in the precision of the table, and read again for each part of the others: the pairs of
    tiles are quadratic, what is shuffled or stored is not. In a pair products grow by blocks of dimensions, and a pair
    of vectors drops out once the norms of what is left cannot carry it to ``least``. Pairs left are tested in double
    precision on their own dimensions. A pair of tiles returns one sum and one link per vector, never its pairs.

    Null, zero and non-finite vectors, and vectors of other lengths, link with nothing. A null key gets null for
    ``component_id`` and ``kept``. Rows that repeat a key each get a row with the same results; vectors of one key
    count as that key's. An empty table gives an empty result. Only ``key`` and ``vector`` are read.
    """
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    plain = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", plain) & F.exists("v", lambda x: x != 0)
    element = vectors.schema[vector].dataType.elementType if isinstance(vectors.schema[vector].dataType, T.ArrayType) else None
    kind = "f4" if isinstance(element, T.FloatType) else "f8"
    good = rows.where(usable).mapInArrow(_coded(kind), "vec_id long, width int, mark binary, raw binary")
    # the mark of a unit vector stands for it: 16 bytes move in its place
    marks = stored(good.select("vec_id", "width", "mark"), "marks")
    sizes = [r[0] for r in marks.select("width").distinct().collect()]  # lengths, as a rule one
    parts = None
    for width in sizes:
        found = _links_of_width(good.where(F.col("width") == width), width, kind, least, tile)
        parts = found if parts is None else parts.unionByName(found)
    if parts is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"), F.lit(1).cast("long").alias("n_copies"))
    parts = stored(parts, "links")
    outer = parts.groupBy("id").agg(F.sum("links").alias("links"))
    groups = linked_groups(parts.where("id <> peer").select(F.col("id").alias("u"), F.col("peer").alias("v")).distinct())
    merged = marks.groupBy("width", "mark").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("w"))
    known = merged.join(outer, "id", "left").join(groups.withColumnRenamed("node", "id"), "id", "left").select(
        "width", "mark", "w", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n"), F.coalesce("component", "id").alias("c")
    )
    found = marks.join(known, ["width", "mark"]).groupBy("vec_id").agg(F.max("n").alias("n"), F.min("c").alias("c"), F.max("w").alias("w"))
    return rows.select("vec_id").join(found, "vec_id", "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("c", "vec_id")).alias("kept"), F.coalesce("w", F.lit(1)).cast("long").alias("n_copies"),
    )


def _coded(kind: str):
    """Vectors as bytes, in the precision they have, and a mark of 16 bytes of their unit vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = b.column("v")
            sizes, ends = np.asarray(vectors.value_lengths()), np.cumsum(np.asarray(vectors.value_lengths()), dtype=np.int64)
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            marks, raw = np.empty(len(sizes), object), np.empty(len(sizes), object)
            for width in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == width)
                x = flat[(ends[at] - width)[:, None] + np.arange(width)]
                for i, unit, own in zip(at.tolist(), _units(x), x.astype(kind)):
                    marks[i], raw[i] = md5(unit.tobytes(), usedforsecurity=False).digest(), own.tobytes()
            yield pa.RecordBatch.from_pydict({
                "vec_id": b.column("vec_id"), "width": pa.array(sizes, pa.int32()), "mark": pa.array(marks, pa.binary()), "raw": pa.array(raw, pa.binary()),
            })

    return run


def _links_of_width(good: DataFrame, width: int, kind: str, least: float, tile: int) -> DataFrame:
    """``id, links, peer`` from every pair of tiles that can hold a link."""
    turn = _principal(good, width, kind)
    tiles = stored(_tiles(good, width, kind, turn, least, tile), "tiles")
    return _pairs_of_tiles(tiles, least).mapInArrow(_tile_pairs(width, kind, turn, least), "id long, links long, peer long")


def _reach(least: float) -> float:
    return float(np.sqrt(max(0.0, 2 - 2 * least))) + _SLACK


def _tiles(good: DataFrame, width: int, kind: str, turn: np.ndarray, least: float, tile: int) -> DataFrame:
    """Different vectors with their number, about ``tile`` of them a row, none of two bands."""
    reach, bands = _reach(least), min(BANDS, width)
    cells = [f"c{k}" for k in range(bands)]

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = _units(_matrix(b.column("raw").to_pylist(), width, kind)) @ turn[:, :bands]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *(pa.array(np.floor(z[:, k] / reach).astype(np.int64)) for k in range(bands)), pa.array(z[:, 0].copy())],
                names=[*b.schema.names, *cells, "z0"],
            )

    kinds = ", ".join(f"{c} long" for c in cells)
    # how many tiles a band needs: an estimate will do, and spares storing the merged vectors
    counts = good.select("mark", "raw").mapInArrow(turned, f"mark binary, raw binary, {kinds}, z0 double").groupBy(*cells).agg(
        F.ceil(F.approx_count_distinct("mark") / tile).cast("long").alias("n_tiles")
    )
    merged = good.groupBy("mark").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("w"), F.first("raw").alias("raw")).select("id", "w", "raw")
    placed = merged.mapInArrow(turned, f"id long, w long, raw binary, {kinds}, z0 double")
    n_tiles = F.greatest(F.coalesce("n_tiles", F.lit(1)), F.lit(1))
    lots = placed.join(counts, cells, "left").withColumn("lot", F.pmod(F.xxhash64("id"), n_tiles))

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        return pd.DataFrame({
            **{c: [pdf[c].iloc[0]] for c in cells}, "lot": [pdf["lot"].iloc[0]], "i": [pdf["id"].to_numpy(np.int64).tobytes()],
            "w": [pdf["w"].to_numpy(np.int64).tobytes()], "v": [b"".join(pdf["raw"])], "low": [pdf["z0"].min()], "high": [pdf["z0"].max()],
        })

    return lots.groupBy(*cells, "lot").applyInPandas(packed, f"{kinds}, lot long, i binary, w binary, v binary, low double, high double")


def _pairs_of_tiles(tiles: DataFrame, least: float) -> DataFrame:
    """Each two tiles that can hold a link, side by side, once."""
    cells, reach = [c for c in tiles.columns if c[0] == "c"], _reach(least)
    side = lambda s: tiles.select(F.struct(*cells, "lot").alias(f"t{s}"), *[F.col(c).alias(c + s) for c in ("i", "w", "v", "low", "high", *cells)])
    near = [F.abs(F.col(f"{c}a") - F.col(f"{c}b")) <= 1 for c in cells]
    close = (F.col("lowa") - F.col("highb") <= reach) & (F.col("lowb") - F.col("higha") <= reach)
    met = every_pair(side("a"), side("b"), (F.col("ta") <= F.col("tb")) & reduce(and_, near) & close)
    return met.select("ta", "tb", *[c + s for s in "ab" for c in "iwv"])
