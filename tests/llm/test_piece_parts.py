"""Texts are cut into units part by part; ids are the library's wherever spaces stand and however rows are ordered."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from panelcraft.llm import pieces
from panelcraft.llm.pieces import MODEL, MARK, Cutter, encode, load_model


def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def some_texts():
    r = random.Random(5)
    return ["", None, " ", "  ", " a", "a ", "a  b   c ", "▁x▁▁y", "\n", "日本 語", "﷐ a﷐b", *("".join(r.choices("ab e.\nthTn\t  é😀", k=r.randint(1, 30))) for _ in range(300))]


def test_units_of_many_texts_are_those_of_each():
    cutter, texts = Cutter(load_model().meets()), some_texts()
    units, ends = cutter.units(texts)
    for text, first, after in zip(texts, [0, *ends], ends):
        assert "".join(units[first:after]) == (MARK + text.replace(" ", MARK) if text else "")
        assert cutter.units([text])[0] == units[first:after]


def test_ids_of_small_parts_equal_the_library(spark, monkeypatch):
    monkeypatch.setattr(pieces, "PART_BYTES", 100)
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    lib, texts = library(), some_texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["ids"] for r in encode(df, frequent=20).collect()}
    assert got == {i: None if t is None else lib.encode(t) for i, t in enumerate(texts)}


def test_texts_of_another_type_stay_as_they_are(spark):
    df = spark.createDataFrame([(1, 10), (2, None), (3, 7)], "doc_id long, text int")
    got = encode(df).orderBy("doc_id").collect()
    assert [r["text"] for r in got] == [10, None, 7] and [r["ids"] for r in got] == [library().encode("10"), None, library().encode("7")]


def test_pairs_move_by_part_and_texts_compressed(spark):
    """Equal units of a part move once, whatever texts hold them, and texts move as one value a part."""
    df = spark.createDataFrame([(i, f"Qzxj{i % 7}w " * 50) for i in range(2_000)], "doc_id long, text string").coalesce(1)
    plan = encode(df, frequent=0)._jdf.queryExecution().executedPlan().toString()
    assert "packed" in plan and "hashpartitioning(part" in plan
    assert encode(df, frequent=0).select(F.sum(F.size("ids"))).first()[0] > 0
