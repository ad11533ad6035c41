"""Alignment of tokenizers, divergence of sources and streamed BPE against libraries, brute force and SQL."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from panelcraft.llm import alignment, divergence, transducer
from panelcraft.llm.base_queries import DIVERGENCE_SQL
from tests.compare import mismatch

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_a long, groups string, ids binary, row string, rank int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns named like results."""
    long = " ".join(f"w{i % 7919}x{i % 104729}" for i in range(60_000))
    texts = [
        (1, None), (2, ""), (3, "  \t\n "), (4, "the same words"), (5, "the same words"), (5, "the same words"), (None, "the same words"), (6, long),
        (7, "▁marked ▁"), (8, "<|endoftext|> and <s> <0x41> <|startoftext|>x"), (9, "é ü 日本 😀 ñ é    ΣΑΣ İstanbul " * 20), (10, "x" * 70_000),
        (11, "a\x1cb\x00c\x85d e  f   g"), (12, "It's WE'LL don't 1234 #!?"), (None, None), (13, "naïve 𝒳 � ﬁ"), (14, "haha" * 5_000 + "!"),
    ]
    rows = [(i, t, None if n % 3 else "en", None if n % 4 == 0 else f"s{n % 3}", None, n, "g", b"1", None, 3) for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3, "n_a").cache()


# ------------------------------------------------------------------------------------------------ alignment


def brute_alignment(texts):
    """Rows as the contract words them, text by text; links from sets of ends."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    letters = {c: i for i, c in enumerate(transducer._byte_letters())}
    names = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    spelled = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    found, links = [], []
    for t in texts:
        x = a.encode(" " + t, add_special_tokens=False).ids if t else []
        y = b.encode(t, num_threads=1) if t else []
        raw = (" " + t).encode() if t else b""
        if b"".join(names[i] for i in x) != raw or b"".join(map(spelled, y)) != raw:
            x, y = [], []
        ends = [np.cumsum([len(names[i]) for i in x]).tolist(), np.cumsum([len(spelled(i)) for i in y]).tolist()]
        both = sorted(set(ends[0]) & set(ends[1]))
        groups, start = [], [0, 0]
        for e in both:
            stop = [at.index(e, i) + 1 for at, i in zip(ends, start)]
            groups.append("|".join(",".join(map(str, ids[i:j])) for ids, i, j in zip((x, y), start, stop)))
            start = stop
        own = [tuple(int(p.split(",")[-1]) for p in g.split("|")) for g in groups]
        found.append((len(x), len(y), len(groups), ";".join(groups)))
        links.append(own)
    count = Counter(p for own in links for p in own)
    best = defaultdict(int)
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    return [(na, nb, ng, len(own), sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own), g) for (na, nb, ng, g), own in zip(found, links)]


def aligned(df, **options):
    rows = alignment.align(df, **options).collect()
    return sorted((r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups"]) for r in rows)


def test_alignment_equals_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = brute_alignment([r["text"] for r in docs.select("text").collect()])
    assert aligned(docs) == sorted(want) and aligned(docs, chunk_bytes=5_000) == sorted(want)
    digests = {hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "" for w in want}
    got = entry.queries()["op11_alignment"](spark, FOLDER).collect()
    assert {r["groups_sha256"] for r in got} == digests and len(got) == docs.count()


def test_alignment_of_odd_rows(odd):
    texts = [r["text"] for r in odd.select("text").collect() if r["text"] is None or len(r["text"]) < 25_000]
    short = odd.where("text IS NULL OR length(text) < 25000")
    assert aligned(short) == sorted(brute_alignment(texts))
    whole = {r["doc_id"]: r for r in alignment.align(odd.where("doc_id IS NOT NULL")).collect()}
    assert whole[1]["n_a"] == whole[2]["n_links"] == whole[7]["n_b"] == 0 and whole[7]["groups"] == ""
    assert whole[6]["n_a"] > 60_000 and whole[10]["n_groups"] > 0  # the long texts are there as a whole
    assert alignment.align(odd).count() == odd.count() and alignment.align(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        alignment.align(odd, keep=("n_a",))


def test_pointers_find_the_last_token():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 60)
        a, b = (sorted({n, *[rng.randint(1, n) for _ in range(rng.randint(0, 30))]}) for _ in range(2))
        to_a, to_b = alignment.last_tokens(np.array(a), np.array(b))
        both = sorted(set(a) & set(b))
        close = lambda e: a.index(min(x for x in both if x >= e))
        assert to_a.tolist() == [close(e) for e in a] and to_b.tolist() == [close(e) for e in b]


def test_texts_are_cut_where_tokens_end():
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = "".join(random.Random(5).choice(["word ", " two", "  ", "\n", "don't ", "x1 y", "é ", "UP low"]) for _ in range(4_000))
    parts = alignment.cut(text, 100)
    assert "".join(parts) == text and len(parts) > 20
    assert [i for p in parts for i in tok.encode(p).ids] == tok.encode(text).ids


def test_chunks_hold_all_rows():
    sizes = np.array([5, 0, 7, 100, 1, 1, 0])
    assert list(alignment.blocks(sizes, 12)) == [(0, 3), (3, 4), (4, 7)]
    assert list(alignment.blocks(np.array([]), 12)) == []


# ----------------------------------------------------------------------------------------------- divergence


def test_terms_are_those_of_the_pattern():
    import re

    text = "Don't STOP-me; Élan_ÀB 日本x9y @[`{\x7f z"
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    want = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower)
    assert [t.decode() for t in divergence.terms(text.encode())] == want


def test_divergence_of_odd_rows_equals_sql(spark, odd, monkeypatch):
    more = odd.select("doc_id", "text", "lang", "source")
    extra = spark.createDataFrame([(None, f"red green w{i % 3} the same", "de", f"s{i % 4}") for i in range(12)] + [(1, "", "xx", "a"), (2, None, "xx", "b")], more.schema)
    both = more.unionByName(extra)
    con = duckdb.connect()
    con.register("documents", both.toArrow())
    assert mismatch(divergence.source_divergence(both), con, DIVERGENCE_SQL) is None
    monkeypatch.setattr(divergence, "HELD", 5)  # many small sums
    clash = both.withColumns({"term": F.lit("t"), "n": F.lit(1), "value": F.lit(2), "rank": F.lit(1)})
    assert mismatch(divergence.source_divergence(clash), con, DIVERGENCE_SQL) is None
    assert divergence.source_divergence(odd.limit(0)).count() == 0
    pairs = divergence.source_divergence(both).where("part = 'pair' AND lang = 'xx'").collect()
    assert [(r["item"], r["value"]) for r in sorted(pairs)] == [("b", 0), ("a", 0)]


def test_divergence_keeps_the_top(spark):
    docs = spark.createDataFrame([("en", s, " ".join(f"{s}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300))) for s in "ab" for _ in range(3)], "lang string, source string, text string")
    found = divergence.source_divergence(docs).where("part = 'term'")
    assert {r["source"]: r["count"] for r in found.groupBy("source").count().collect()} == {"a": 200, "b": 200}
    assert divergence.source_divergence(docs, top=7).where("part = 'term'").count() == 14


# ----------------------------------------------------------------------------------------------- streamed BPE


@pytest.fixture(scope="module")
def model():
    with open(transducer.TOKENIZER, "rb") as f:
        return transducer.read_model(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_codes_equal_the_library(spark, odd, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").unionByName(odd.select("text"))
    for r in transducer.code(docs).collect():
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert transducer.unpacked(r["ids"]) == want
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)


def test_codes_of_odd_rows_keep_columns(odd):
    coded = transducer.encode(odd)
    assert coded.columns == [*[c for c in odd.columns if c != "ids"], "ids"] and coded.count() == odd.count()
    assert coded.where("text IS NULL").first()["ids"] == b""
    back = transducer.decode(coded)
    assert back.columns == [*coded.columns, "decoded"] and back.where("doc_id = 4").first()["decoded"] == "the</w> same</w> words</w>"
    assert transducer.decode(odd.select(F.lit(None).cast("binary").alias("ids"))).first()["decoded"] == ""
    assert transducer.code(odd.limit(0)).count() == 0


def test_every_character_as_the_library(model, library):
    encoder = transducer.TextEncoder(model)
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = [f"ab{chr(c)}cd {chr(c)} e{chr(c)}́!" for c in points]
    for i in range(0, len(texts), 20_000):
        for t, e in zip(texts[i:], library.encode_batch_fast(texts[i : i + 20_000], add_special_tokens=False)):
            assert transducer.unpacked(encoder.encode(t)) == e.ids, ascii(t)


@pytest.mark.parametrize("alphabet", ["ab", "a", "in", "thesang", "ha", "!?.", "éü", "aeinorst"])
def test_streamed_words_as_whole_words(model, library, alphabet):
    rng = random.Random(alphabet)
    for n in (1, 2, 30, 200, 700, 5_000):
        word = "".join(rng.choice(alphabet) for _ in range(n))
        encoder, ids = transducer.WordEncoder(model, block=16), []
        raw, start, most = word.encode(), 0, 0
        while start < len(raw):
            step = rng.randint(1, 40)
            ids.extend(encoder.feed(raw[start : start + step]))
            most, start = max(most, len(encoder.held)), start + step
        ids.extend(encoder.close())
        assert ids == library.encode(word, add_special_tokens=False).ids
        assert most <= model.lookahead + 16 + 16 + 64  # whatever the length of the word


def small_model(pairs, alphabet):
    tokens = {c: i for i, c in enumerate(alphabet)}
    merges = []
    for a, b in pairs:
        tokens.setdefault(a + b, len(tokens))
        merges.append((tokens[a], tokens[b], tokens[a + b]))
    lengths = {i: len(t) for t, i in tokens.items()}
    return tokens, merges, lengths


def test_lookahead_suffices_for_random_merge_lists():
    """No token that ends so far before the end of a prefix differs from the tokens of any longer text."""
    rng = random.Random(11)
    needed = 0
    for _ in range(150):
        made = ["a", "b", "c"]
        pairs = []
        while len(pairs) < 12:
            p = (rng.choice(made), rng.choice(made))
            if p not in pairs and p[0] + p[1] not in made:
                pairs.append(p)
                made.append(p[0] + p[1])
        tokens, merges, lengths = small_model(pairs, "abc")
        ahead = transducer.sufficient_lookahead(merges, lengths)
        ranked = {(a, b): r << transducer.RANK_SHIFT | m for r, (a, b, m) in enumerate(merges)}
        for _ in range(40):
            text = [tokens[c] for c in "".join(rng.choice("abc") for _ in range(60))]
            whole = set(transducer.merged(text, ranked)[1])
            for n in range(1, 60):
                ends = set(transducer.merged(text[:n], ranked)[1])
                apart = [e for e in ends ^ whole if e < n]
                if apart:
                    needed = max(needed, n - min(apart))
                    assert n - min(apart) <= ahead
    assert needed > 3


def test_lookahead_of_a_chain_and_wrong_orders():
    tokens, merges, lengths = small_model([("a", "b"), ("c", "a"), ("b", "c")], "abc")
    assert transducer.sufficient_lookahead(merges, lengths) >= 2
    with pytest.raises(ValueError):
        transducer.sufficient_lookahead([(3, 2, 4), (0, 1, 3)], {0: 1, 1: 1, 2: 1, 3: 2, 4: 3})


def test_decoder_takes_ids_in_pieces(model, library):
    ids = library.encode("日本 naïve <|endoftext|> \U0001f600 the words", add_special_tokens=False).ids
    decoder = transducer.TextDecoder(model)
    for size in (1, 2, 3, 100):
        text = "".join(decoder.feed(np.array(ids[i : i + size])) for i in range(0, len(ids), size)) + decoder.close()
        assert text == library.decode(ids, skip_special_tokens=False)


def test_batches_are_cut_by_bytes_and_rows(monkeypatch):
    from panelcraft.llm import common

    monkeypatch.setattr(common, "SLICE_BYTES", 10)
    texts = ["aaaa", None, "bbbb", "c" * 50, "", "é" * 4, "dd", "e"]
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(len(texts))), "text": pa.array(texts)})
    parts = list(common.slices(batch, 1, rows=3))
    assert [t for p in parts for t in p.column(1).to_pylist()] == texts
    assert [p.num_rows for p in parts] == [3, 1, 3, 1]
    assert [p.num_rows for p in common.slices(batch.slice(0, 0), 1)] == [0]


def test_words_are_forgotten_after_a_partition(monkeypatch):
    from panelcraft.llm import common

    monkeypatch.setattr(common, "CACHED_BYTES", 100)
    memory = common.WordHashes()
    run = common.emptied_after(lambda batches: (memory.of(b) for b in batches))
    sizes = []
    for hashes in run([[b"w%d" % i for i in range(k, k + 10)] for k in range(0, 1000, 10)]):
        assert len(hashes) == 10
        sizes.append(memory.held)
    assert 0 < max(sizes) <= 110 and len(memory) == 0 and memory.held == 0
