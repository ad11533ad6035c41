"""BPE encoding and decoding as streams, in constant memory.

Merging a text from left to right needs to look ahead only so far: a merge is decided by what stands to its right
within a distance that follows from the merge list alone (``sufficient_lookahead``). The encoder keeps a window of
symbols and emits every token that ends before the last so many of them; the decoder turns the bytes of tokens into
text with an incremental state machine.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import struct
import unicodedata
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
#: Words that a task remembers, and the length of the longest of them; beyond it starts afresh.
REMEMBERED, LONGEST_REMEMBERED = 400_000, 64
#: A merge as one number: its rank, then the token it makes; and none.
RANK_SHIFT, MADE, NEVER = 24, (1 << 24) - 1, 1 << 60
#: Symbols taken in at a time, besides the lookahead.
BLOCK = 512
#: Words up to this length are merged by looking through their pairs, longer ones with a heap.
SHORT = 24
#: Characters before this one are in normal form by themselves, and their kinds are settled.
LATIN = 0x180
#: Bytes of decoded text in one batch of results.
BATCH_BYTES = 32 << 20
#: Control characters that Python takes for white space, and Unicode does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACES = re.compile("[\t-\r \x85\xa0  -     　]+")


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable Latin-1 bytes for
    themselves, the others by the characters from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[int, int, int]], lengths: dict[int, int]) -> int:
    """Symbols beyond a place that decide whether a token ends there, for ``(left, right, made)`` in order of rank.

    Two texts that agree up to a place can part to the left of it only by a chain of merges. A merge of (u, v) is
    undone when a merge of a lower rank takes the end of v: its left part is then a token at the right edge of v, at
    a time before that token became part of a larger one. Or it is undone inside v, by one of the merges that make v.
    ``reach`` is the longest such chain from each merge, in symbols, found in order of rank.
    """
    makers: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # token -> (rank, left, right)
    inside: dict[int, int] = defaultdict(int)  # longest chain from a merge inside the token, from its start
    ranks: dict[int, list[int]] = defaultdict(list)  # by left part: ranks, and the longest reach up to each of them
    reached: dict[int, list[int]] = defaultdict(list)
    edges: dict[int, dict[int, int]] = {}  # token -> token at its right edge -> the last rank at which it stands alone
    used: set[int] = set()
    longest = 0

    def at_edge(token: int) -> dict[int, int]:
        found = edges.get(token)
        if found is None:
            found = {}
            for rank, _, right in makers[token]:
                found[right] = max(found.get(right, -1), rank)
                for t, until in at_edge(right).items():
                    found[t] = max(found.get(t, -1), min(until, rank))
            edges[token] = found
        return found

    def beyond(token: int, rank: int) -> int:
        k = bisect_left(ranks[token], rank)
        return reached[token][k - 1] if k else 0

    for rank, (left, right, made) in enumerate(merges):
        used.update((left, right))
        if made in used:
            raise ValueError("a merge comes before the merges of its parts")
        size = lengths[right]
        reach = max([size, inside[right], size + beyond(right, rank), *[size + beyond(t, min(until, rank)) for t, until in at_edge(right).items()]])
        ranks[left].append(rank)
        reached[left].append(max(reach, reached[left][-1] if reached[left] else 0))
        makers[made].append((rank, left, right))
        edges.pop(made, None)
        inside[made] = max(inside[made], inside[left], lengths[left] + reach)
        longest = max(longest, reach)
    return longest


@dataclass(frozen=True)
class BpeModel:
    """What a tokenizer file says: merges by pair, words ends, special tokens, normal forms."""

    tokens: tuple[bytes, ...]  # by id, UTF-8
    first: tuple[int, ...]  # id of each byte inside a word
    last: tuple[int, ...]  # and at its end
    merges: dict[tuple[int, int], int] = field(repr=False)  # pair -> rank and token, in one number
    special: dict[str, int]
    pattern: str
    lookahead: int


@lru_cache(maxsize=2)
def read_model(content: bytes) -> BpeModel:
    """The model of a tokenizer file. Files with other steps than byte-level words in lower case are refused."""
    j = json.loads(content)
    steps = [n["type"] for n in j["normalizer"]["normalizers"]]
    split, level = j["pre_tokenizer"]["pretokenizers"]
    if steps != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or not split["invert"] or level["use_regex"] or j["decoder"] is not None:
        raise ValueError("not a tokenizer of byte-level words in lower case")
    model, vocab = j["model"], dict(j["model"]["vocab"])
    end = model["end_of_word_suffix"] or ""
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
    letters = _byte_letters()
    first, last = tuple(vocab[c] for c in letters), tuple(vocab[c + end] for c in letters)
    lengths = dict.fromkeys([*first, *last], 1)
    for a, b, made in merges:
        lengths[made] = lengths[a] + lengths[b]
    special = {t["content"]: t["id"] for t in j["added_tokens"]}
    if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in j["added_tokens"]):
        raise ValueError("special tokens that depend on what is around them")
    tokens = [b""] * (max([*vocab.values(), *special.values()]) + 1)
    for t, i in [*vocab.items(), *special.items()]:
        tokens[i] = t.encode()
    ranked = {(a, b): rank << RANK_SHIFT | made for rank, (a, b, made) in enumerate(merges)}
    return BpeModel(tuple(tokens), first, last, ranked, special, split["pattern"]["Regex"], sufficient_lookahead(merges, lengths))


def merged(symbols: list[int], merges: dict[tuple[int, int], int]) -> tuple[list[int], list[int]]:
    """Tokens of a sequence of symbols, always merging the pair of the lowest rank, the leftmost on ties, and the
    number of symbols before the end of each."""
    n = len(symbols)
    if n <= SHORT:
        return _merged_short(list(symbols), merges)
    token, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(merges[p], i) for i, p in enumerate(zip(token, token[1:])) if p in merges]
    heapq.heapify(heap)
    while heap:
        code, i = heapq.heappop(heap)
        j = after[i]
        if token[i] < 0 or j >= n or merges.get((token[i], token[j])) != code:
            continue
        token[i], token[j], after[i] = code & MADE, -1, after[j]
        if after[i] < n:
            before[after[i]] = i
        for left, right in ((i, after[i]), (before[i], i)):
            if left >= 0 and right < n:
                new = merges.get((token[left], token[right]))
                if new is not None:
                    heapq.heappush(heap, (new, left))
    alive = [i for i in range(n) if token[i] >= 0]
    return [token[i] for i in alive], [after[i] for i in alive]


def _merged_short(token: list[int], merges: dict[tuple[int, int], int]) -> tuple[list[int], list[int]]:
    """As ``merged``, by looking through the pairs again after each merge: quicker where there are few."""
    ends, get = list(range(1, len(token) + 1)), merges.get
    found = [get(p, NEVER) for p in zip(token, token[1:])]
    while found:
        best = min(found)
        if best == NEVER:
            break
        i = found.index(best)
        token[i : i + 2] = [best & MADE]
        del ends[i], found[i]
        if i < len(found):
            found[i] = get((token[i], token[i + 1]), NEVER)
        if i:
            found[i - 1] = get((token[i - 1], token[i]), NEVER)
    return token, ends


class WordEncoder:
    """Tokens of one word whose bytes come in pieces of any length; it holds ``lookahead`` and one block of symbols."""

    def __init__(self, model: BpeModel, block: int = BLOCK):
        self.model, self.block, self.held = model, block, bytearray()

    def feed(self, piece: bytes) -> Iterator[int]:
        """Tokens that no further byte can change."""
        for i in range(0, len(piece), self.block):
            self.held += piece[i : i + self.block]
            if len(self.held) > self.model.lookahead + self.block:
                first = self.model.first
                tokens, ends = merged([first[b] for b in self.held], self.model.merges)
                stable = [k for k in range(len(ends)) if ends[k] + self.model.lookahead < len(self.held)]
                if stable:
                    yield from tokens[: stable[-1] + 1]
                    del self.held[: ends[stable[-1]]]

    def close(self) -> list[int]:
        """The remaining tokens; the word ends here."""
        held, self.held = self.held, bytearray()
        first = self.model.first
        return merged([*[first[b] for b in held[:-1]], *[self.model.last[b] for b in held[-1:]]], self.model.merges)[0]


class WordIds(dict):
    """Word in normal form -> its ids, 4 bytes each, remembered while they fit."""

    def __init__(self, model: BpeModel):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> bytes:
        raw, model = word.encode(), self.model
        if len(raw) <= SHORT:  # shorter than any lookahead: the stream would begin at its end
            symbols = [*map(model.first.__getitem__, raw)]
            symbols[-1] = model.last[raw[-1]]
            tokens = _merged_short(symbols, model.merges)[0]
        else:
            encoder = WordEncoder(model)
            tokens = [*encoder.feed(raw), *encoder.close()]
        found = packed(tokens)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


def packed(ids: list[int]) -> bytes:
    """Ids as unsigned 32-bit numbers, little-endian."""
    return struct.pack(f"<{len(ids)}I", *ids)


class TextEncoder(dict):
    """Part of a text without white space -> its ids, 4 bytes each, remembered while they fit. Normal forms, words
    and merges never cross white space, so the ids of a text are those of its parts, end to end."""

    def __init__(self, model: BpeModel):
        super().__init__()
        self.model, self.ids = model, WordIds(model)
        self.special = re.compile("(" + "|".join(re.escape(t) for t in sorted(model.special, key=len, reverse=True)) + ")") if model.special else None
        kinds = {k: "".join(re.escape(chr(c)) for c in range(LATIN) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
        spaces = "\t-\r \x85\xa0"
        pattern = model.pattern.replace(r"\p{L}", kinds["L"]).replace(r"\p{N}", kinds["N"]).replace(r"\s", spaces)
        self.words = re.compile(pattern).findall
        self.beyond = re.compile(f"[^\0-{chr(LATIN - 1)}]").search
        # beyond Latin letters, normal forms and words depend on the version of Unicode: they are the library's
        self.normal = normalizers.Sequence([normalizers.NFC(), normalizers.Replace(Regex(r"\s+"), " "), normalizers.Lowercase()])
        self.split = pre_tokenizers.Split(Regex(model.pattern), "removed", invert=True)

    def __missing__(self, part: str) -> bytes:
        if not self.beyond(part) and not (self.special and self.special.search(part)):
            words = self.words(part.lower())
            found = self.ids[words[0]] if len(words) == 1 else b"".join([self.ids[w] for w in words])
        else:
            found = b"".join([self._span(s) for s in (self.special.split(part) if self.special else [part])])
        if len(part) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[part] = found
        return found

    def _span(self, span: str) -> bytes:
        """Ids of a special token, or of the words between two."""
        known = self.model.special.get(span)
        if known is not None:
            return packed([known])
        return b"".join([self.ids[w] for w, _ in self.split.pre_tokenize_str(self.normal.normalize_str(span))])

    def encode(self, text: str) -> bytes:
        """Ids of a text, as unsigned 32-bit numbers, little-endian."""
        parts = _SPACES.split(text) if _SEPARATORS.search(text) else text.split()
        return b"".join(map(self.__getitem__, parts))


class TextDecoder:
    """Ids in pieces of any length -> text. Tokens are set apart by one space, as a tokenizer without a decoder does.
    Bytes that are no UTF-8 become U+FFFD, also where a character is spread over pieces."""

    def __init__(self, model: BpeModel):
        self.table = np.array([b" " + t for t in model.tokens], dtype=object)
        self.reset()

    def reset(self) -> None:
        self.state, self.begun = codecs.getincrementaldecoder("utf-8")("replace"), False

    def feed(self, ids: np.ndarray) -> str:
        raw = b"".join(self.table[ids].tolist())
        if raw and not self.begun:
            raw, self.begun = raw[1:], True
        return self.state.decode(raw)

    def close(self) -> str:
        rest = self.state.decode(b"", final=True)
        self.reset()
        return rest

    def decode(self, ids: bytes, block: int = 1 << 16) -> str:
        values = np.frombuffer(ids, "<u4")
        if len(values) <= block:
            return self.feed(values) + self.close()
        return "".join([*[self.feed(values[i : i + block]) for i in range(0, len(values), block)], self.close()])


def _model(docs: DataFrame, path: str) -> Broadcast:
    """The tokenizer file, read where Spark can; files of vocabularies have a fixed size."""
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def unpacked(ids: bytes) -> list[int]:
    return np.frombuffer(ids, "<u4").tolist()


def encode(docs: DataFrame, text: str = "text", tokenizer: str = TOKENIZER, name: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text under ``name``: unsigned 32-bit numbers, little-endian, as ``unpacked`` reads.

    They are the ids of the tokenizer file, no special tokens added; those that stand in a text are taken for
    themselves. Null and empty texts, and texts of nothing but white space, give no ids. Rows are told apart by nothing,
    so ties and repeated rows do not matter; an empty table gives an empty result. Extra columns pass; one that bears
    the name of the result is replaced.
    """
    return _mapped(docs, F.coalesce(F.col(text).cast("string"), F.lit("")), tokenizer, {name: "binary"}, _encoded)


def decode(docs: DataFrame, ids: str = "ids", tokenizer: str = TOKENIZER, name: str = "decoded") -> DataFrame:
    """``docs`` with the text of the ids under ``name``; null ids give ''. Ids beyond the vocabulary are an error."""
    return _mapped(docs, F.coalesce(F.col(ids), F.lit(b"")), tokenizer, {name: "string"}, _decoded)


def code(docs: DataFrame, text: str = "text", tokenizer: str = TOKENIZER, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass over the rows."""
    return _mapped(docs, F.coalesce(F.col(text).cast("string"), F.lit("")), tokenizer, {ids: "binary", decoded: "string"}, _both)


def _encoded(model: BpeModel):
    encoder = TextEncoder(model)
    return lambda text: (encoder.encode(text),)


def _decoded(model: BpeModel):
    decoder = TextDecoder(model)
    return lambda ids: (decoder.decode(ids),)


def _both(model: BpeModel):
    encoder, decoder = TextEncoder(model), TextDecoder(model)

    def run(text: str) -> tuple[bytes, str]:
        ids = encoder.encode(text)
        return ids, decoder.decode(ids)

    return run


def _mapped(docs: DataFrame, value, tokenizer: str, results: dict[str, str], make) -> DataFrame:
    """``docs`` with what ``make(model)`` gives for ``value``; rows travel as one struct, so no name can clash."""
    content = _model(docs, tokenizer)
    kept = [c for c in docs.columns if c not in results]
    rows = docs.select(F.struct(*docs.columns).alias("row"), value.alias("value"))
    types = [pa.binary() if t == "binary" else pa.string() for t in results.values()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make(read_model(content.value))
        for b in batches:
            start, size, found = 0, 0, []
            for k, v in enumerate(b.column("value"), 1):
                found.append(step(v.as_py()))
                size += sum(map(len, found[-1]))
                if size >= BATCH_BYTES or k == b.num_rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*found), types)]
                    yield pa.RecordBatch.from_arrays([b.column("row").slice(start, k - start), *columns], names=["row", *[f"r{i}" for i in range(len(types))]])
                    start, size, found = k, 0, []

    schema = ", ".join([f"row {rows.schema['row'].dataType.simpleString()}", *[f"r{i} {t}" for i, t in enumerate(results.values())]])
    done = rows.mapInArrow(run, schema)
    return done.select(*[F.col("row")[c].alias(c) for c in kept], *[F.col(f"r{i}").alias(n) for i, n in enumerate(results)])
