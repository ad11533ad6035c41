"""Alignment of the tokens that two tokenizers make of the same texts.

Tokens of both are byte ranges of one text. Every token points to the token that overlaps it and reaches farthest to
the right; doubling these pointers leads all tokens of a connected stretch to its last one, which names the group.
Groups end where tokens of both end together: those two are linked, and the links are counted over all texts.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.common import stored

BYTE_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text that are aligned at once, and whose distinct links are counted together; a longer text stands alone.
CHUNK_BYTES = 1 << 20
#: Characters given to a tokenizer at once, where a text can be cut without changing its tokens.
PART = 1 << 16
#: Fixed value: how a byte-level tokenizer finds words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_WORD = 500
_OTHER = re.compile("[^\t\n\r -~\xa0-\u024f\u2010-\u2026]")
_CUT = re.compile(r"(?<=[a-z]) (?=[a-z])")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


@dataclass
class Side:
    """A tokenizer: ids of texts, and the bytes of its tokens."""

    encode: Callable[[str], np.ndarray]
    spelled: list[bytes]

    def __post_init__(self) -> None:
        self.lengths = np.array([len(t) for t in self.spelled], np.int64)
        self.table = np.array(self.spelled, object)

    def spell(self, ids: np.ndarray) -> bytes:
        return b"".join(self.table[ids].tolist())


@lru_cache(maxsize=1)
def byte_side(content: bytes) -> Side:
    """A byte-level tokenizer file; special tokens inside texts are plain text.

    Where the ids of tokens are the order of the merges, a faster library gives the same ids for texts of Latin letters
    and words of usual length; all other texts go to the library of the file.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    import tiktoken
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    made = Tokenizer.from_buffer(content)
    made.encode_special_tokens = True
    made.no_truncation()
    made.no_padding()
    letters = sorted(ByteLevel.alphabet())
    # printable bytes stand for themselves, the others are numbered from 256 on
    own = {c: ord(c) for c in letters if ord(c) < 256}
    rest = iter(sorted(set(range(256)) - set(own.values())))
    own.update({c: next(rest) for c in letters if ord(c) >= 256})
    spelled = [b""] * made.get_vocab_size()
    vocab = made.get_vocab(with_added_tokens=False)
    for token, i in vocab.items():
        spelled[i] = bytes(own[c] for c in token)
    quick = None
    j = json.loads(content)
    merges = [m if isinstance(m, str) else " ".join(m) for m in j["model"]["merges"]]
    level = j["pre_tokenizer"]
    if level["type"] == "ByteLevel" and level["use_regex"] and not level["add_prefix_space"] and j["normalizer"] is None and [vocab[m.replace(" ", "")] for m in merges] == list(range(256, 256 + len(merges))):
        quick = tiktoken.Encoding("bytes", pat_str=WORDS, mergeable_ranks={spelled[i]: i for i in vocab.values()}, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if quick and not _OTHER.search(text) and max(map(len, text.split()), default=0) <= LONG_WORD:
            return quick.encode_to_numpy(" " + text, disallowed_special=())
        # one part at a time: what this library makes of it besides ids is large, and goes at once
        return np.concatenate([np.array(made.encode_batch_fast([p], add_special_tokens=False)[0].ids, np.uint32) for p in cut(" " + text)])

    return Side(encode, spelled)


def cut(text: str, size: int = PART) -> list[str]:
    """Parts of a text, cut before a space between two small letters, where a new word always begins."""
    parts, start = [], 0
    while len(text) - start > size:
        found = _CUT.search(text, start + size)
        if not found:
            break
        parts.append(text[start : found.start()])
        start = found.start()
    return [*parts, text[start:]]


@lru_cache(maxsize=1)
def piece_side(content: bytes) -> Side:
    """A sentence-piece model, which puts a space before each text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    spelled = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        byte = _BYTE_PIECE.fullmatch(piece) if model.is_byte(i) else None
        spelled.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
    return Side(lambda text: np.array(model.encode(text, num_threads=1), np.uint32), spelled)


def last_tokens(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of two tokenizations of the same bytes, given by their ends: the token of the first side that
    closes its group.

    Tokens of the first side are numbered first. Each points to the token of the other side that holds its last byte,
    if that reaches as far or farther; of two that end together the one of the first side points to itself. Pointers
    only lead to the right, so doubling them settles after as many rounds as the longest chain has bits.
    """
    n = len(ends_a)
    other = np.searchsorted(ends_b, ends_a)
    together = ends_b[other] == ends_a if n else np.zeros(0, bool)
    to = np.concatenate([np.where(together, np.arange(n), n + other), np.searchsorted(ends_a, ends_b)])
    while True:
        farther = to[to]
        if np.array_equal(farther, to):
            return to[:n], to[n:]
        to = farther


@dataclass
class _Chunk:
    """Tokens of some texts: ids, compressed, which tokens end a group, and the distinct links with their numbers."""

    ids: list[list[bytes]]
    last: list[list[bytes]]
    link: np.ndarray
    times: np.ndarray


def _chunk(texts: list[str | None], sides: Sequence[Side]) -> _Chunk:
    found, places = ([], []), []
    for k, t in enumerate(texts):
        if t:
            whole = b" " + t.encode()
            own = [side.encode(t) for side in sides]
            if all(side.spell(ids) == whole for side, ids in zip(sides, own)):
                places.append(k)
                found[0].append(own[0])
                found[1].append(own[1])
    out = _Chunk([[b""] * len(texts) for _ in sides], [[b""] * len(texts) for _ in sides], np.zeros(0, np.int64), np.zeros(0, np.int64))
    if not places:
        return out
    # texts lie end to end: all tokens of a text end where the tokens of the other side do
    flat = [np.concatenate(ids) for ids in found]
    to_a, to_b = last_tokens(*[np.cumsum(side.lengths[ids]) for side, ids in zip(sides, flat)])
    last = to_a == np.arange(len(to_a)), np.append(to_b[1:] != to_b[:-1], True)
    out.link, out.times = np.unique(flat[0][last[0]].astype(np.int64) << 32 | flat[1][last[1]].astype(np.int64), return_counts=True)
    for k, side in enumerate(sides):
        at = np.cumsum([0, *map(len, found[k])]).tolist()
        packed, shrink = flat[k].astype(stored_type(len(side.spelled))), zstandard.ZstdCompressor(level=1).compress
        for place, i, j in zip(places, at, at[1:]):
            out.ids[k][place], out.last[k][place] = shrink(packed[i:j].tobytes()), np.packbits(last[k][i:j]).tobytes()
    return out


def stored_type(vocabulary: int) -> str:
    """The smallest unsigned type, little-endian, for the ids of a vocabulary."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _aligned(a, b, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, part, made = (byte_side(a.value), piece_side(b.value)), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column("text")
            sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]) if len(texts) else np.zeros(0)
            for start, end in blocks(sizes, chunk_bytes):
                c = _chunk(texts.slice(start, end - start).to_pylist(), sides)
                n, first = end - start, lambda v, n: pa.array([v, *[None] * (n - 1)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 32 | made] * n, pa.int64()), batch.column("row").slice(start, n), *[pa.array(v, pa.binary()) for v in (*c.ids, *c.last)],
                     first(c.link, n), first(c.times, n)], names=["chunk", "row", "a", "b", "last_a", "last_b", "link", "times"],
                )
                made += 1

    return run


def blocks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive rows whose sizes add up to ``most`` at most, or one larger row."""
    total, start, n = np.concatenate([[0], np.cumsum(sizes)]), 0, len(sizes)
    while start < n:
        end = max(int(np.searchsorted(total, total[start] + most, side="right")) - 1, start + 1)
        yield start, end
        start = end


def _finished(vocab_a: int, vocab_b: int):
    # an id and what follows it: a comma inside a group, a bar or a semicolon at the end of its part
    spelled = [np.array([f"{i}{c}" for c in (",", end) for i in range(n)], object) for n, end in ((vocab_a, "|"), (vocab_b, ";"))]

    def run(key, docs: pa.Table, known: pa.Table) -> pa.Table:
        docs, known = docs.combine_chunks(), known.sort_by("link")
        link, n, best = known["link"].to_numpy(), known["n"].to_numpy(), known["best"].to_numpy()
        ids, last, counts, widen = [], [], [], zstandard.ZstdDecompressor().decompress
        for c, kind in (("a", stored_type(vocab_a)), ("b", stored_type(vocab_b))):
            own = [np.frombuffer(widen(v) if v else b"", kind) for v in docs[c].to_pylist()]
            marks = [np.unpackbits(np.frombuffer(v, np.uint8), count=len(x)) for v, x in zip(docs[f"last_{c}"].to_pylist(), own)]
            counts.append(np.array([len(x) for x in own], np.int64))
            ids.append(np.concatenate(own).astype(np.int64))
            last.append(np.concatenate(marks).astype(bool))
        at = np.searchsorted(link, ids[0][last[0]] << 32 | ids[1][last[1]])
        # places in the texts of the groups: all tokens of one side in groups before, or up to, the own one
        group = [np.cumsum(x) - x for x in last]
        upto = [np.concatenate([[0], np.flatnonzero(x) + 1]) for x in last]
        words = np.empty(len(ids[0]) + len(ids[1]), object)
        words[np.arange(len(ids[0])) + upto[1][group[0]]] = spelled[0][ids[0] + last[0] * vocab_a]
        words[np.arange(len(ids[1])) + upto[0][group[1] + 1]] = spelled[1][ids[1] + last[1] * vocab_b]
        ends = [np.concatenate([[0], np.cumsum(c)]) for c in counts]
        both, words = (ends[0] + ends[1]).tolist(), words.tolist()
        texts = ["".join(words[i:j])[:-1] for i, j in zip(both, both[1:])]
        groups = np.diff(np.concatenate([[0], np.cumsum(last[0])])[ends[0]])

        def per_text(values: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0], np.cumsum(values[at].astype(np.int64))])[np.concatenate([[0], np.cumsum(groups)])])

        return pa.table([docs["row"], *map(pa.array, [counts[0], counts[1], groups, groups, per_text(best), per_text(n)]), pa.array(texts, pa.string())],
                        names=["row", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    return run


def align(
    docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", byte_tokenizer: str = BYTE_TOKENIZER,
    piece_tokenizer: str = PIECE_TOKENIZER, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """The columns ``keep`` of each row of ``docs`` and how the tokens of its text, with a space before it, correspond.

    ``n_a, n_b``: tokens of the byte-level (A) and of the piece tokenizer (B). ``groups``: stretches between places
    where tokens of both end, ``a1,a2|b1;a3|b2,b3`` by ids; ``n_groups`` of them. ``n_links``: pairs of tokens of A and
    B that end together. ``count_sum``: for each link, how many links over all rows hold the same two ids, added up.
    ``n_best``: links whose two ids are linked as often as any A id is with that B id, ties included.

    Null and empty texts, and those that a tokenizer does not spell byte by byte, have no tokens: zeros and ''. Repeated
    rows count again, and each gives a row. An empty table gives an empty result. Columns outside ``keep`` are not looked
    at; one in ``keep`` that bears the name of a result column is an error.

    The rows of about ``chunk_bytes`` of text send each distinct link once. Ids are stored once and meet the counts by
    chunk; the two tokenizer files, of fixed size, are sent to all tasks.
    """
    results = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    if set(keep) & set(results):
        raise ValueError(f"columns named like a result: {sorted(set(keep) & set(results))}")
    context, files = docs.sparkSession.sparkContext, []
    for path in (byte_tokenizer, piece_tokenizer):
        with open(path, "rb") as f:
            files.append(f.read())
    sent = [context.broadcast(f) for f in files]
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text).cast("string").alias("text"))
    kept = rows.schema["row"].dataType.simpleString()
    coded = stored(rows.mapInArrow(_aligned(*sent, chunk_bytes), f"chunk long, row {kept}, a binary, b binary, last_a binary, last_b binary, link array<long>, times array<long>"), "aligned")
    links = coded.where("link IS NOT NULL").select(F.col("chunk").alias("of"), F.inline(F.arrays_zip("link", "times")))
    counted = links.groupBy("link").agg(F.sum("times").alias("n")).withColumn("b_id", F.col("link").bitwiseAND(F.lit((1 << 32) - 1)))
    most = counted.groupBy("b_id").agg(F.max("n").alias("most"))
    known = links.select("of", "link").join(counted.join(most, "b_id").select("link", "n", (F.col("n") == F.col("most")).alias("best")), "link")
    vocab = len(byte_side(files[0]).spelled), len(piece_side(files[1]).spelled)
    schema = f"row {kept}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    texts = coded.select("chunk", "row", "a", "b", "last_a", "last_b")
    met = texts.groupBy("chunk").cogroup(known.select("of", "link", "n", F.col("best").cast("int").alias("best")).groupBy("of")).applyInArrow(_finished(*vocab), schema)
    return met.select(*[F.col("row")[c].alias(c) for c in keep], *results)
