"""SentencePiece encoding and decoding as a relational lattice.

Texts are cut at spaces; the distinct words are cut further wherever no piece crosses, into units. Every distinct unit
becomes a lattice: its substrings of bounded length, joined to the piece table. The edges of a unit are folded by a
higher-order aggregate into its pieces, and texts are put together from the pieces of their units.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from panelcraft.llm.common import slices
from panelcraft.session import scratch_folder

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # stands for a space
#: Units whose pieces are sent to every task, at most; the pieces of all other units are joined.
FREQUENT = 200_000
#: Characters of a unit that the fold takes: its cuts are the bits of one long. Longer ones, which no natural text
#: has, are merged with a heap (or, for unigram models, folded all the same).
LONGEST_UNIT = 61
#: Different units that a task counts before it passes them on and starts afresh.
REMEMBERED = 300_000
#: Bytes of texts that are cut into units at a time, about; a single longer text is taken alone.
PART_BYTES = 2_000_000
_DIGITS = "0123456789ABCDEF"
_GAPS = range(0xFDD0, 0x110000)  # the first that no text at hand holds stands between units


@dataclass(frozen=True)
class PieceModel:
    """Pieces and scores of a model file; ``kind`` says how its scores are meant: "bpe" merges or "unigram" paths."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    bytes_from: int  # id of <0x00>, or -1
    unknown: int
    kind: str
    special: frozenset[int] = frozenset()  # ids of control, byte and unused pieces, as the model file marks them
    control: frozenset[int] = frozenset()  # those of them that decode to nothing

    @property
    def longest(self) -> int:
        return max(len(p) for p in self.pieces)

    def plain(self) -> list[tuple[str, int, float]]:
        """Pieces that match text: no control, unknown, byte or unused pieces, however these are spelt."""
        skip = self.special | {self.unknown}
        return [(p, i, s) for i, (p, s) in enumerate(zip(self.pieces, self.scores)) if i not in skip]

    def meets(self) -> frozenset[str]:
        """Neighbouring characters that some piece holds; between any others a text can be cut."""
        return frozenset(p[i : i + 2] for p, _, _ in self.plain() for i in range(len(p) - 1))

    def merges(self) -> tuple[list[tuple[str, int, int, int]], list[str]]:
        """``(piece, id, rank, middle)`` of each piece that merging can make, and the pieces made out of turn.

        While nothing crosses the ends of a piece, merging inside it goes as it would go in the piece alone. So a piece
        only ever comes from the two parts that merging it alone ends with; ``middle`` is the length of the first one,
        0 for characters. A piece is out of turn when a part of it has no better score than the piece itself.
        """
        rank = {p: (s, i) for p, i, s in self.plain()}
        order = {s: k for k, s in enumerate(sorted({s for s, _ in rank.values()}, reverse=True), 1)}
        found, late = [], []
        for p, (s, i) in rank.items():
            middle = 0
            if len(p) > 1:
                whole, middle = _merged(p, rank)
                if len(whole) > 1:
                    continue
                if any(len(x) > 1 and rank[x][0] <= s for x in (p[:middle], p[middle:])):
                    late.append(p)
            found.append((p, i, order[s], middle))
        return found, late


def load_model(path: str = MODEL, kind: str = "bpe") -> PieceModel:
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = tuple(m.id_to_piece(i) for i in range(m.vocab_size()))
    ids = range(len(pieces))
    control = frozenset(i for i in ids if m.is_control(i))
    special = control | {i for i in ids if m.is_byte(i) or m.is_unused(i)}
    return PieceModel(pieces, tuple(m.get_score(i) for i in ids), m.piece_to_id("<0x00>") if "<0x00>" in pieces else -1, m.unk_id(), kind, special, control)


class Cutter:
    """Cuts texts into the units that a lattice may take alone: wherever no piece holds both neighbours, and before
    each run of spaces. Together the units of a text are the text with a space before it and spaces marked; marks never
    stand after other characters in a piece. Of a text without characters there are none."""

    def __init__(self, meets: frozenset[str]):
        letters = sorted(set("".join(meets)) | {MARK})
        self.kind = np.zeros(0x110000, np.int32)  # of a character; 0: no piece joins it to another
        self.kind[list(map(ord, letters))] = np.arange(1, len(letters) + 1)
        self.many = len(letters) + 1
        pairs = np.array([list(map(ord, p)) for p in meets], np.int64).reshape(-1, 2)
        apart = np.ones((self.many, self.many), bool)
        apart[self.kind[pairs[:, 0]], self.kind[pairs[:, 1]]] = False
        mark = self.kind[ord(MARK)]
        apart[np.arange(self.many) != mark, mark] = True
        self.apart = apart.ravel()

    def units(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The units of all texts in a row, and after how many of them each text ends."""
        sizes = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        ends = np.cumsum(sizes)
        if not sizes.any():
            return [], np.zeros(len(texts), np.int64)
        marked = "".join([MARK + t for t in texts if t]).replace(" ", MARK)
        codes = np.frombuffer(marked.encode("utf-32-le"), np.uint32)
        kind = self.kind[codes]
        cut = np.r_[True, self.apart[kind[:-1] * self.many + kind[1:]]]
        cut[ends[(sizes > 0) & (ends < len(codes))]] = True
        first = np.flatnonzero(cut)
        gap = next(g for g in _GAPS if chr(g) not in marked)
        return np.insert(codes, first[1:], gap).tobytes().decode("utf-32-le").split(chr(gap)), np.searchsorted(first, ends)


def _counts(model: PieceModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, n = Cutter(model.meets()), Counter()

        def counted() -> pa.RecordBatch:
            units = sorted(n)  # what begins alike lies together, which shuffles compress
            return pa.RecordBatch.from_pydict({"unit": pa.array(units, pa.string()), "n": pa.array([n[u] for u in units], pa.int64())})

        for b in batches:
            for part in slices(b, 0, most=PART_BYTES):
                n.update(cutter.units(part.column(0).to_pylist())[0])
                if len(n) >= REMEMBERED:
                    yield counted()
                    n.clear()
        yield counted()

    return run


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table in the shared folder: it survives lost executors and is smaller than a checkpoint."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def lattice(units: DataFrame, table: DataFrame, longest: int) -> DataFrame:
    """The columns of ``units`` and ``a, b`` with those of ``table``: each substring ``unit[a:b]`` that is a piece, and
    each single character, with nulls if it is none.

    Substrings no longer than the longest piece are exploded where the unit lies and meet the piece table, which is of
    the model's fixed size and so is broadcast.
    """
    size = F.length("unit")
    starts = units.select("*", F.explode(F.sequence(F.lit(0), size - 1)).alias("a"))
    spans = starts.select("*", F.explode(F.sequence(F.col("a") + 1, F.least(size, F.col("a") + longest))).alias("b"))
    cut = spans.withColumn("piece", F.substring("unit", F.col("a") + 1, F.col("b") - F.col("a")))
    return cut.join(F.broadcast(table), "piece", "left").where("id IS NOT NULL OR b = a + 1").drop("piece")


def _once(value: Column, f) -> Column:
    """``f(value)`` with the value worked out once; inside a lambda a plain column would be worked out at every use."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _spelled(at: Column, model: PieceModel) -> Column:
    """Ids of the character at ``at`` of the unit, which is no piece: its bytes, or unknown."""
    if model.bytes_from < 0:
        return F.array(F.lit(model.unknown))
    raw = F.hex(F.encode(F.substring("unit", at + 1, F.lit(1)), "UTF-8"))
    digit = lambda k: F.instr(F.lit(_DIGITS), F.substring(raw, k, F.lit(1))) - 1
    return F.transform(F.sequence(F.lit(1), F.length(raw), F.lit(2)), lambda k: digit(k) * 16 + digit(k + 1) + model.bytes_from)


def merged_ids(units: DataFrame, model: PieceModel) -> DataFrame:
    """The columns of ``units`` and ``ids`` by merging: of all neighbouring segments that together are a piece the pair
    with the best score, the leftmost on ties, becomes one, until none is left.

    The cuts of a unit are the bits of a long. A piece comes from one pair of parts only, so an edge applies when,
    of the bits between its ends, exactly its ends and its middle are set; it then clears its middle. Parts have better
    scores than what they make (units where they have not must not come here), so merges come in the order of scores
    and one fold over the edges in that order makes them all.
    """
    table = units.sparkSession.createDataFrame(model.merges()[0], "piece string, id int, rank int, middle int")
    bit = lambda at: F.expr(f"shiftleft(1L, {at})")
    ends, middle = bit("a") + bit("b"), F.expr("CASE WHEN middle > 0 THEN shiftleft(1L, a + middle) ELSE 0L END")
    # single characters come first and change nothing
    order = F.expr("CASE WHEN b = a + 1 THEN a ELSE rank * 64 + a END")
    edge = F.struct(order.alias("order"), ends.alias("ends"), middle.alias("middle"), (bit("b") + bit("b") - bit("a")).alias("between"), "id")
    folded = lattice(units, table, model.longest).groupBy(*units.columns).agg(F.sort_array(F.collect_list(edge)).alias("edges"))
    every = F.expr("shiftleft(1L, length(unit) + 1)") - 1
    cuts = F.aggregate(
        "edges", every, lambda c, e: F.when(c.bitwiseAND(e["between"]) == e["ends"] + e["middle"], c.bitwiseXOR(e["middle"])).otherwise(c)
    )
    left = _once(cuts, lambda c: F.filter("edges", lambda e: c.bitwiseAND(e["between"]) == e["ends"]))
    path = F.sort_array(F.transform(left, lambda e: F.struct(e["ends"].alias("ends"), e["order"].alias("order"), e["id"].alias("id"))))
    ids = _once(path, lambda p: F.when(F.forall(p, lambda e: e["id"].isNotNull()), F.transform(p, lambda e: e["id"])).otherwise(
        F.flatten(F.transform(p, lambda e: F.when(e["id"].isNotNull(), F.array(e["id"])).otherwise(_spelled(e["order"], model))))))
    return folded.select(*units.columns, ids.alias("ids"))


def best_path(edges: str, size: Column, unknown_score: float) -> Column:
    """Ends of the pieces on the path with the best sum of scores (Viterbi); a character that is no piece costs
    ``unknown_score``. Edges come sorted by start, so the best way to a start is known when its edges are met."""
    empty = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(F.when(i == 0, F.lit(0.0)).alias("score"), F.lit(0).alias("from")))

    def add(way: Column, e: Column) -> Column:
        total = F.get(way, e["a"])["score"] + F.coalesce(e["score"], F.lit(unknown_score))
        here = F.get(way, e["b"])["score"]
        new = F.struct(total.alias("score"), e["a"].alias("from"))
        return F.when(here.isNull() | (total > here), F.transform(way, lambda x, i: F.when(i == e["b"], new).otherwise(x))).otherwise(way)

    ways = F.aggregate(F.col(edges), empty, add)
    # walk back from the end; ``next`` as in ``merged_path``
    walked = lambda w: F.aggregate(
        F.reverse(F.sequence(F.lit(1), size)), F.struct(size.alias("at"), F.array_repeat(F.lit(0), size).alias("after")),
        lambda s, i: F.when(
            s["at"] == i,
            F.struct(F.get(w, i)["from"].alias("at"), F.transform(s["after"], lambda x, k: F.when(k == F.get(w, i)["from"], i).otherwise(x)).alias("after")),
        ).otherwise(s),
        lambda s: s["after"],
    )
    return _once(ways, walked)


def _merged(unit: str, rank: dict[str, tuple[float, int]]) -> tuple[list[str], int]:
    """Segments of one unit after all merges, best pair first, and the length of the left part of the last merge."""
    after = list(range(1, len(unit) + 1))  # end of the segment that starts here
    before = [-1, *range(len(unit) - 1)]
    alive, heap, last = [True] * len(unit), [], 0

    def offer(a: int) -> None:
        if a >= 0 and after[a] < len(unit):
            joined = unit[a : after[after[a]]]
            if joined in rank:
                heapq.heappush(heap, (-rank[joined][0], a, after[a], after[after[a]]))

    for a in range(len(unit)):
        offer(a)
    while heap:
        _, a, middle, end = heapq.heappop(heap)
        if alive[a] and after[a] == middle and middle < len(unit) and alive[middle] and after[middle] == end:
            after[a], alive[middle], last = end, False, middle - a
            if end < len(unit):
                before[end] = a
            offer(a)
            offer(before[a])
    return [unit[a : after[a]] for a in range(len(unit)) if alive[a]], last


def heap_ids(unit: str, rank: dict[str, tuple[float, int]], model: PieceModel) -> list[int]:
    """Pieces of a unit by the same merges as ``merged_ids``, the best pair taken from a heap."""
    ids: list[int] = []
    for piece in _merged(unit, rank)[0]:
        if piece in rank:
            ids.append(rank[piece][1])
        else:
            ids.extend(model.bytes_from + x for x in piece.encode()) if model.bytes_from >= 0 else ids.append(model.unknown)
    return ids


def unit_ids(units: DataFrame, model: PieceModel) -> DataFrame:
    """The columns of ``units`` (distinct ``unit``) and ``ids``: its pieces; characters that are no piece as bytes, or
    unknown. Units longer than a long has bits, and those with pieces made out of turn (runs of spaces, as a rule), are
    merged with a heap."""
    if model.kind != "bpe":
        return _viterbi_ids(units, model)
    late = model.merges()[1]

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = {p: (s, i) for p, i, s in model.plain()}
        for b in batches:
            ids = pa.array([heap_ids(u, rank, model) for u in b.column("unit").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns, ids], names=[*b.schema.names, "ids"])

    apart = F.length("unit") > LONGEST_UNIT
    if late:  # a piece that holds another late piece needs no test of its own
        least = [p for p in late if not any(q != p and q in p for q in late)]
        apart = apart | F.col("unit").rlike("|".join(rf"\Q{p}\E" for p in least))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in units.schema)
    return merged_ids(units.where(~apart), model).unionByName(units.where(apart).mapInArrow(merged, f"{schema}, ids array<int>"))


def _viterbi_ids(units: DataFrame, model: PieceModel) -> DataFrame:
    """Ids on the best path of each unit."""
    table = units.sparkSession.createDataFrame(model.plain(), "piece string, id int, score double")
    edges = F.sort_array(F.collect_list(F.struct("a", "b", "id", "score"))).alias("edges")
    folded = lattice(units, table, model.longest).groupBy(*units.columns).agg(edges)
    path = best_path("edges", F.length("unit"), min(model.scores) - 10)
    chosen = _once(path, lambda after: F.filter("edges", lambda e: F.get(after, e["a"]) == e["b"]))
    ids = F.flatten(F.transform(chosen, lambda e: F.when(e["id"].isNotNull(), F.array(e["id"])).otherwise(_spelled(e["a"], model))))
    return folded.select(*units.columns, ids.alias("ids"))


def encode(docs: DataFrame, text: str = "text", model: PieceModel | None = None, name: str = "ids", frequent: int = FREQUENT) -> DataFrame:
    """``docs`` with the piece ids of each text under ``name``.

    All distinct units of the table go through the lattice once. The ids of the commonest, ``frequent`` at most (a fixed
    bound), are sent to all tasks; the others are joined to the parts of the table that use them. A part is some
    megabytes of rows, compressed as one value; so few pairs of part and unit move, and texts move compressed.

    Null texts get null, empty ones an empty array. Rows are told apart by nothing but their text, so ties and repeated
    rows do not matter. An empty table gives an empty result. Extra columns pass; one that bears the name of the
    result is replaced.
    """
    model = model or load_model()
    spark: SparkSession = docs.sparkSession
    texts = docs.select(F.col(text).cast("string").alias("text")).where("text <> ''")
    units = _stored(texts.mapInArrow(_counts(model), "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n")), "units")
    # the least count, a power of two, that no more than ``frequent`` units reach
    level = F.length(F.bin("n")) - 1
    sizes = dict(units.groupBy(level.alias("level")).count().collect())  # 64 rows at most
    least, reached = 64, 0
    while least > 0 and reached + sizes.get(least - 1, 0) <= frequent:
        least -= 1
        reached += sizes.get(least, 0)
    # a unit makes about a hundred substrings, so parts are cut by their number
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(sizes.values()) // 50_000 + 1)
    coded_units = unit_ids(units.select("unit", (level >= least).alias("common")).repartition(parts, "unit").sortWithinPartitions("unit"), model)
    short = np.dtype(np.uint16 if len(model.pieces) <= 1 << 16 else np.int32)

    def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("ids")
            at = (ids.offsets.to_numpy() - ids.offsets[0].as_py()) * short.itemsize
            data = pa.py_buffer(ids.flatten().to_numpy().astype(short))
            code = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(at.astype(np.int32)), data])
            yield pa.RecordBatch.from_arrays([b.column("unit"), b.column("common"), code], names=["unit", "common", "code"])

    codes = _stored(coded_units.mapInArrow(shortened, "unit string, common boolean, code binary"), "codes")
    sent = spark.sparkContext.broadcast({r["unit"]: bytes(r["code"]) for r in codes.where("common").toLocalIterator()})
    kept = [c for c in docs.columns if c != name]
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    if docs.schema[text].dataType != StringType():
        rows = rows.withColumn("text", F.col("row")[text].cast("string"))
    place = docs.columns.index(text)

    def strings(b: pa.RecordBatch) -> pa.Array:
        return b.column("text") if "text" in b.schema.names else b.column("row").field(place)

    def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
        """Parts of the rows, numbered alike in every pass over them."""
        found = (part for b in batches for part in slices(b, strings(b), most=PART_BYTES))
        return enumerate(found, TaskContext.get().partitionId() << 32)

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, known = Cutter(model.meets()), sent.value
        for k, part in parts_of(batches):
            missing = sorted(set(cutter.units(strings(part).to_pylist())[0]).difference(known))
            yield pa.RecordBatch.from_pydict({"part": pa.array([k] * len(missing), pa.int64()), "unit": pa.array(missing, pa.string())})

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
        for k, part in parts_of(batches):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                out.write_batch(part)
            yield pa.RecordBatch.from_pydict({"part": pa.array([k], pa.int64()), "packed": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    used = rows.mapInArrow(rare, "part long, unit string")
    extra = used.join(codes.where("NOT common").select("unit", "code"), "unit").groupBy("part").agg(F.collect_list(F.struct("unit", "code")).alias("extra"))
    met = rows.mapInArrow(packed, "part long, packed binary").join(extra, "part", "left").select("packed", "extra")

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, known, rank = Cutter(model.meets()), sent.value, {}
        for b in batches:
            for i in range(b.num_rows):
                part = pa.ipc.open_stream(b.column("packed")[i].as_buffer()).read_next_batch()
                units, ends = cutter.units(strings(part).to_pylist())
                more = b.column("extra")[i].values
                own = {} if more is None else dict(zip(more.field("unit").to_pylist(), more.field("code").to_pylist()))
                for u in set(units).difference(known, own):  # should the rows have come in another order than before
                    rank = rank or {p: (s, j) for p, j, s in model.plain()}
                    own[u] = np.array(heap_ids(u, rank, model), short).tobytes()
                spelt = [known[u] if u in known else own[u] for u in units]
                after = np.r_[0, np.cumsum(np.fromiter(map(len, spelt), np.int64, len(spelt)) // short.itemsize)]
                values = pa.array(np.frombuffer(b"".join(spelt), short).astype(np.int32))
                ids = pa.ListArray.from_arrays(pa.array(np.r_[0, after[ends]].astype(np.int32)), values, mask=strings(part).is_null())
                yield pa.RecordBatch.from_arrays([part.column("row"), ids], names=["row", "ids"])

    coded = met.mapInArrow(put_together, f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>")
    return coded.select(*[F.col("row")[c].alias(c) for c in kept], F.col("ids").alias(name))


def decode(ids: str | Column, model: PieceModel | None = None) -> Column:
    """The text of piece ids, with DataFrame functions: pieces as bytes, end to end, without the first space."""
    model = model or load_model()
    raw = [p.replace(MARK, " ").encode().hex() for p in model.pieces]
    for i in range(256 if model.bytes_from >= 0 else 0):
        raw[model.bytes_from + i] = f"{i:02x}"
    for i in model.control:
        raw[i] = ""
    raw[model.unknown] = " ⁇ ".encode().hex()
    table = F.split(F.lit(",".join(raw)), ",")
    c = F.col(ids) if isinstance(ids, str) else ids
    spelled = F.decode(F.unhex(F.array_join(F.transform(c, lambda i: F.get(table, i)), "")), "UTF-8")
    return F.when(F.startswith(spelled, F.lit(" ")), F.substr(spelled, F.lit(2))).otherwise(spelled)
