"""Joins documents whose sets of word shingles overlap: prefixes of token combinations.

A shingle is a 48-bit hash of its words; within one document or one pair of documents a false match is beyond
reach (one in a million for two texts of 20,000 words). Tokens are ordered by the number of sets that hold them, so a prefix holds the rare ones. A document x of n
shingles may miss ``n - ceil(t n)`` of them in a partner. Rare tokens index alone; frequent ones only in
combinations of two, very frequent ones of three, inside bins of the token space so that their number stays linear.
A combination class with m tokens in the prefix survives m - k errors, so the prefix is extended until, summed over
classes, the allowed errors are too few to destroy every signature. Of two similar sets, the one whose prefix ends
first then shares a whole signature with the other.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.common import WordHashes, emptied_after, linked_groups, rolling, scrambled, signed, slices
from panelcraft.session import cut_lineage

WORDS = 5
BITS = 48
#: Two sets are linked when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Tokens held by more sets than this index in pairs, in triples.
FREQUENT, VERY_FREQUENT = 32, 1_024
#: A token that so many sets of one batch hold travels as one count, not once per set.
HEAVY = 32
_ALL = 65_535  # marks such a count
_FEW_PAIRS = 100_000
#: Characters of text whose tokens one token range holds, about; ranges grow in number with the input, not in size.
RANGE_CHARS = 16_000_000
#: Tokens and sets of a block, about; a single longer set is a block of its own.
BLOCK_TOKENS, BLOCK_SETS = 32_768, 256
_COLUMNS = 4_096  # tokens of two blocks that are compared at a time

_A = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_words = WordHashes()  # of this worker process


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words, A-Z in lower case; shorter texts are one run."""
    ws = (text or "").translate(_A).encode().split() if text and not text.isascii() else (text or "").encode().lower().split()
    return np.unique(rolling(_words.of(ws), min(words, max(1, len(ws)))) >> np.uint64(64 - BITS))


def _pack(tokens: np.ndarray) -> bytes:
    """Sorted numbers as byte planes of their differences: the leading planes are zeros, which shuffles compress."""
    return np.diff(tokens, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)[:, : BITS // 8].T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(BITS // 8, -1).T
    whole = np.zeros((len(planes), 8), np.uint8)
    whole[:, : BITS // 8] = planes
    return np.cumsum(whole.view(np.uint64).ravel(), dtype=np.uint64)


_BLOBS = "part int, chunk long, tokens binary, sets binary, counts binary, head binary"


def _spread(ranges: int, words: int):
    """Tokens of each batch of documents, cut by token range, with the batch's own number of each set.

    A batch is named by where it is and what it holds: batches of equal content stay apart.
    """
    width = np.uint64((1 << BITS) // ranges + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        for at, whole in enumerate(batches):
            for start, part in enumerate(slices(whole, 1)):
                yield chunk(part, (partition, at, start))

    def chunk(batch: pa.RecordBatch, place: tuple[int, int, int]) -> pa.RecordBatch:
        name, number, sets, docs = xxhash.xxh3_64(repr(place).encode()), {}, [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = shingles(text.as_py(), words)
            content = xxhash.xxh3_128_digest(found.tobytes())
            name.update(repr(doc).encode() + content)
            at = -1
            if doc is not None and len(found):
                if content not in number:
                    number[content] = len(sets)
                    sets.append([found, doc, content])
                at = number[content]
                sets[at][1] = min(sets[at][1], doc)
            docs.append((doc is not None, doc or 0, len(found), at))
        tokens = np.concatenate([s[0] for s in sets]) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), [len(s[0]) for s in sets]).astype(np.uint16)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else np.zeros(0, np.int64)
        length = np.diff(np.r_[first, len(tokens)])
        heavy = np.repeat(length > HEAVY, length)
        head = pickle.dumps((
            np.array(docs, np.int64).reshape(-1, 4), np.array([s[1] for s in sets], np.int64),
            np.array([int.from_bytes(s[2][:8], "little") for s in sets], np.uint64), np.array([len(s[0]) for s in sets], np.int64), tokens[heavy], owner[heavy],
        ), protocol=5)
        keep = ~heavy
        keep[first] = True
        count = np.ones(len(tokens), np.uint32)
        count[first] = np.where(length > HEAVY, length, 1)
        owner = np.where(heavy, _ALL, owner).astype(np.uint16)
        tokens, owner, count = tokens[keep], owner[keep], count[keep]
        cut = np.searchsorted(tokens // width, np.arange(ranges + 1).astype(np.uint64))
        home = name.intdigest() % ranges  # the part that carries what only this batch needs, so that it meets no other's
        rows = [(r, a, b) for r, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a or r == home]
        me = signed(np.array([name.intdigest()], np.uint64))[0]
        return pa.RecordBatch.from_pydict({
            "part": pa.array([r for r, _, _ in rows], pa.int32()), "chunk": pa.array([me] * len(rows), pa.int64()),
            "tokens": pa.array([_pack(tokens[a:b]) for _, a, b in rows], pa.binary()), "sets": pa.array([owner[a:b].tobytes() for _, a, b in rows], pa.binary()),
            "counts": pa.array([count[a:b].tobytes() for _, a, b in rows], pa.binary()),
            "head": pa.array([head if r == home else None for r, _, _ in rows], pa.binary()),
        })

    return emptied_after(run)


def _counted(pdf: pd.DataFrame) -> pd.DataFrame:
    """One token range of all batches: what other sets hold too goes back to its batch, with how many hold it."""
    tokens = [_unpack(b) for b in pdf["tokens"]]
    sizes = [len(t) for t in tokens]
    t = np.concatenate(tokens)
    row = np.repeat(np.arange(len(pdf)), sizes)
    owner = np.concatenate([np.frombuffer(b, np.uint16) for b in pdf["sets"]])
    count = np.concatenate([np.frombuffer(b, np.uint32) for b in pdf["counts"]])
    order = np.argsort(t, kind="stable")
    st = t[order]
    first = np.flatnonzero(np.r_[True, st[1:] != st[:-1]]) if len(st) else np.zeros(0, np.int64)
    held = np.zeros(len(t), np.int64)
    if len(st):
        sums = np.add.reduceat(count[order].astype(np.int64), first)
        held[order] = np.repeat(sums, np.diff(np.r_[first, len(st)]))
    keep = held > 1
    ends = np.searchsorted(row[keep], np.arange(len(pdf) + 1))
    t, owner, held = t[keep], owner[keep], np.minimum(held[keep], _ALL).astype(np.uint16)
    out = pdf[["part", "chunk"]].assign(
        tokens=[_pack(t[a:b]) for a, b in zip(ends[:-1], ends[1:])], sets=[owner[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])],
        counts=[held[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], head=pdf["head"],
    )
    return out[(np.diff(ends) > 0) | out["head"].notna()]


def signatures(tokens: np.ndarray, held: np.ndarray, n: int, spare: int) -> np.ndarray:
    """Signatures of a set of ``n`` tokens; ``tokens`` are those other sets hold too, by rising (held, token).

    ``spare`` errors can be borne. The tokens nobody else holds come first and bear one error each, so there is
    nothing to index when they outnumber ``spare``.
    """
    need = spare + 1 - (n - len(tokens))
    if need <= 0:
        return np.zeros(0, np.uint64)
    found = []
    own = n.bit_length() - 1
    for level in (own, own + 1):  # similar sets are of the same level or of neighbouring ones
        bins = max(1, (1 << level) // 16)
        k = 1 + (held > FREQUENT).astype(np.int64) + (held > VERY_FREQUENT) if level > 3 else np.ones(len(tokens), np.int64)
        group = np.where(k == 1, -1, (scrambled(tokens) % np.uint64(bins)).astype(np.int64) * 4 + k)
        by = np.argsort(group, kind="stable")
        g = group[by]
        start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        rank = np.empty(len(g), np.int64)
        rank[by] = np.arange(len(g)) - np.repeat(start, np.diff(np.r_[start, len(g)]))
        bears = np.cumsum((k == 1) | (rank >= k - 1))
        end = int(np.searchsorted(bears, need)) + 1
        found.append(tokens[:end][k[:end] == 1])
        salt = scrambled(np.array([level + 77], np.uint64))[0]
        for name in np.unique(group[:end]):
            if name < 0:
                continue
            members, size = tokens[:end][group[:end] == name], int(name % 4)
            if len(members) >= size:
                picks = np.array(list(combinations(np.sort(members).tolist(), size)), np.uint64)
                found.append(rolling_rows(picks) ^ salt)
    return np.unique(np.concatenate(found))


def rolling_rows(picks: np.ndarray) -> np.ndarray:
    total = np.zeros(len(picks), np.uint64)
    for c in range(picks.shape[1]):
        total = scrambled(total + picks[:, c])
    return total


_FOUND = "doc long, n long, same long, content long, odd double, tokens binary, signs array<long>"  # without content: a document, else a set


def _indexed(percent: int):
    """One batch of documents with what is known of its tokens: a row per document, and per set that needs an index."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        docs, first, content, n, heavy_t, heavy_s = pickle.loads(pdf["head"].dropna().iloc[0])
        t = np.concatenate([_unpack(b) for b in pdf["tokens"]])
        owner = np.concatenate([np.frombuffer(b, np.uint16) for b in pdf["sets"]]).astype(np.int64)
        held = np.concatenate([np.frombuffer(b, np.uint16) for b in pdf["counts"]]).astype(np.int64)
        marks = owner == _ALL
        if marks.any():  # counts of the heavy tokens go to all their sets
            mt, mh = t[marks], held[marks]
            order = np.argsort(mt)
            found = mh[order][np.searchsorted(mt[order], heavy_t)]
            t, owner, held = np.r_[t[~marks], heavy_t], np.r_[owner[~marks], heavy_s.astype(np.int64)], np.r_[held[~marks], found]
        order = np.lexsort((t, held, owner))
        t, owner, held = t[order], owner[order], held[order]
        ends = np.searchsorted(owner, np.arange(len(first) + 1))
        rows = [(d if there else None, k, int(first[s]) if s >= 0 else None, None, None, None, None) for there, d, k, s in docs.tolist()]
        for s in range(len(first)):
            a, b = ends[s], ends[s + 1]
            size = int(n[s])
            spare = size - -(-size * percent // 100)
            if size - (b - a) <= spare:
                signs = signatures(t[a:b], held[a:b], size, spare)
                odd = -float(np.log2(held[a:b]).sum()) / size
                rows.append((int(first[s]), size, int(first[s]), int(signed(content[s : s + 1])[0]), odd, _pack(np.sort(t[a:b])), signed(signs).tolist()))
        out = pd.DataFrame(rows, columns=["doc", "n", "same", "content", "odd", "tokens", "signs"])
        return out.astype({"doc": "Int64", "n": "Int64", "same": "Int64", "content": "Int64"})

    return run


def _alike(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y, n, m in zip(b.column("tu"), b.column("tv"), b.column("nu").to_pylist(), b.column("nv").to_pylist()):
                both = len(np.intersect1d(_unpack(x.as_buffer()), _unpack(y.as_buffer()), assume_unique=True))
                keep.append(100 * both >= percent * (n + m - both))
            yield b.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _block(pdf: pd.DataFrame) -> pd.DataFrame:
    """The sets of one block as one row: its distinct tokens, and for each the sets that hold it."""
    tokens = [_unpack(b) for b in pdf["tokens"]]
    t, owner = np.concatenate(tokens), np.repeat(np.arange(len(pdf)), [len(x) for x in tokens])
    order = np.argsort(t, kind="stable")
    distinct, counts = np.unique(t, return_counts=True)
    numbers = [pdf[c].to_numpy(np.int64) for c in ("content", "group", "n")]
    data = pickle.dumps((*numbers, _pack(distinct), counts.astype(np.uint32), owner[order].astype(np.uint32)), protocol=5)
    return pd.DataFrame({"block": [pdf["block"].iloc[0]], "data": [data]})


def _between(percent: int):
    """Links between sets of two blocks that are in different groups, one for each pair of groups."""

    def compared(x: bytes, y: bytes) -> tuple[np.ndarray, np.ndarray]:
        (u, gu, nu, tu, cu, ou), (v, gv, nv, tv, cv, ov) = pickle.loads(x), pickle.loads(y)
        if len(np.unique(np.r_[gu, gv])) == 1:
            return u[:0], v[:0]
        tu, tv = _unpack(tu), _unpack(tv)
        common, iu, iv = np.intersect1d(tu, tv, assume_unique=True, return_indices=True)

        def columns(at: np.ndarray, size: int, counts: np.ndarray) -> np.ndarray:
            column = np.full(size, -1)
            column[at] = np.arange(len(at))
            return np.repeat(column, counts)

        ku, kv = columns(iu, len(tu), cu), columns(iv, len(tv), cv)
        both = np.zeros((len(u), len(v)), np.int64)
        for start in range(0, len(common), _COLUMNS):
            sides = []
            for k, owner, size in ((ku, ou, len(u)), (kv, ov, len(v))):
                here = (k >= start) & (k < start + _COLUMNS)
                held = np.zeros((size, min(_COLUMNS, len(common) - start)), np.float32)
                held[owner[here], k[here] - start] = 1
                sides.append(held)
            both += (sides[0] @ sides[1].T).astype(np.int64)
        like = (100 * both >= percent * (nu[:, None] + nv[None, :] - both)) & (gu[:, None] != gv[None, :])
        i, j = np.nonzero(like)
        first = np.unique(np.stack([gu[i], gv[j]]), axis=1, return_index=True)[1]
        return u[i[first]], v[j[first]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, y in zip(b.column("x"), b.column("y")):
                u, v = compared(x.as_buffer(), y.as_buffer())
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


def _stars(sets: DataFrame, percent: int) -> DataFrame:
    """``u, v``: links between the sets of a signature and the most typical of them.

    Near copies of one text differ more from each other than from it. Its tokens are the ones most sets hold, so the
    set with the least ``odd`` is the original or close to it, and the same one for most signatures of a crowd.
    """
    bodies = sets.select("content", "n", "tokens")
    rows = sets.select(F.explode("signs").alias("sign"), "content", "n", "odd")
    centres = rows.groupBy("sign").agg(F.min(F.struct("odd", "content", "n")).alias("c"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    fits = F.least("n", "c.n") * 100 >= F.greatest("n", "c.n") * percent
    met = rows.join(centres, "sign").where((F.col("content") != F.col("c.content")) & fits)
    pairs = cut_lineage(met.select(F.least("content", "c.content").alias("u"), F.greatest("content", "c.content").alias("v")).distinct())
    few = pairs.count() <= _FEW_PAIRS  # then the pairs go to the bodies, else both move

    def side(s: str) -> DataFrame:
        found = bodies.select(F.col("content").alias(s), F.col("n").alias(f"n{s}"), F.col("tokens").alias(f"t{s}"))
        return (F.broadcast(pairs) if few else pairs).join(found, s)

    return cut_lineage(side("u").join(side("v"), ["u", "v"]).mapInArrow(_alike(percent), "u long, v long"))


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """``u, v``: links between the contents of ``content, n, odd, tokens, signs`` that connect whatever is similar.

    A signature that many sets share is not expanded into pairs. Its sets are first compared with one of them, and
    groups are formed. Sets that share a signature with another group then lie in blocks of bounded size, by the
    commonest of their signatures; two blocks that share a signature meet once, however many they share, and sets of
    different groups in them are compared in full. So no link between groups is lost.
    """
    stars = _stars(sets, percent)
    groups = linked_groups(stars).withColumnRenamed("node", "content")
    grouped = sets.select("content", "n", "tokens", "signs").join(groups, "content", "left").withColumn("group", F.coalesce("component", "content"))
    rows = grouped.select(F.explode("signs").alias("sign"), "content", "n", "group")
    open_ = rows.groupBy("sign").agg(F.min("group").alias("g0"), F.max("group").alias("g1"), F.count(F.lit(1)).alias("m")).where("g0 <> g1")
    rows = cut_lineage(rows.join(open_.select("sign", "m"), "sign"))
    home = rows.groupBy("content").agg(F.max(F.struct("m", "sign"))["sign"].alias("crowd"), F.first("n").alias("n"), F.first("group").alias("group"))
    parts = F.ceil(F.greatest(F.sum("n") / F.lit(BLOCK_TOKENS), F.count(F.lit(1)) / F.lit(BLOCK_SETS)))
    block = F.xxhash64("crowd", F.pmod(F.xxhash64("content"), F.col("parts")))
    placed = cut_lineage(home.join(home.groupBy("crowd").agg(parts.alias("parts")), "crowd").select("content", "n", "group", block.alias("block")))
    bodies = sets.select("content", "tokens").join(placed, "content")
    blocks = cut_lineage(bodies.groupBy("block").applyInPandas(_block, "block long, data binary"))
    there = cut_lineage(rows.select("sign", "content").join(placed.select("content", "block"), "content").select("sign", "block").distinct())
    pairs = there.join(there.select("sign", F.col("block").alias("other")), "sign").where("block <= other").select("block", "other").distinct()
    met = pairs.join(blocks.withColumnRenamed("data", "x"), "block").join(blocks.toDF("other", "y"), "other")
    return stars.unionByName(cut_lineage(met.select("x", "y").mapInArrow(_between(percent), "u long, v long")))


def join_similar(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row: size of its set of shingles, and the smallest key that links
    of at least ``percent`` per cent Jaccard similarity reach.

    Texts are read once. Token counts travel as packed blocks per batch and token range; a token that many sets of a
    batch share travels once per batch. Copies inside a batch are merged before anything moves.

    Null and empty texts have no shingles and link with nothing. A row with a null key links with nothing and has a
    null component. Rows that repeat a key each get a row; what one of them reaches, all reach. An empty table gives an
    empty result. ``docs`` should be stored, or at least give its rows in the same order when read again after a
    loss. Only ``key`` and ``text`` are read.
    """
    size = docs.agg(F.sum(F.length(F.col(text).cast("string")))).first()[0] or 0
    ranges = max(16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // RANGE_CHARS + 1)
    blobs = docs.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(_spread(ranges, words), _BLOBS)
    known = blobs.groupBy("part").applyInPandas(_counted, _BLOBS)
    found = cut_lineage(known.groupBy("chunk").applyInPandas(_indexed(percent), _FOUND))
    # sets of equal content are one from here on, named by it
    merged = found.where("content IS NOT NULL").groupBy("content").agg(F.first("n").alias("n"), F.first("odd").alias("odd"), F.first("tokens").alias("tokens"), F.first("signs").alias("signs"), F.min("doc").alias("doc"))
    merged = cut_lineage(merged)
    edges = _links(merged, percent)
    named = merged.select("content", "doc")
    near = edges.join(named.toDF("u", "a"), "u").join(named.toDF("v", "b"), "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
    equal = found.where("content IS NOT NULL").select("content", F.col("doc").alias("u")).join(named, "content").select("u", F.col("doc").alias("v"))
    rows = found.where("content IS NULL").select("doc", "n", "same")
    inside = rows.select(F.col("doc").alias("u"), F.col("same").alias("v"))  # copies inside a batch
    groups = linked_groups(near.unionByName(equal).unionByName(inside).where("u <> v").distinct())
    return rows.join(groups.withColumnRenamed("node", "doc"), "doc", "left").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id")
    )
