"""Operators for training data against SQL, brute force, round trips, held-out rows and hand-made edge cases."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from panelcraft.llm import bytes_dedup, repeats, words_dedup
from panelcraft.llm.classifier import classify, fit_classifier, fold
from panelcraft.llm.jaccard import join_similar, shingles
from panelcraft.llm.licences import scan_licences
from panelcraft.llm.mixing import mix, mixing_plan, source_targets
from panelcraft.llm.pieces import MODEL, PieceModel, decode, encode, load_model, unit_ids
from panelcraft.llm.rules import quality_rules
from panelcraft.llm.sharding import interleave
from panelcraft.llm.vectors import link_embeddings

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, row string, shard int, label int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns named like results."""
    passage = " ".join(f"word{i}" for i in range(60))
    long = " ".join(f"w{i % 7919}x{i % 104729}" for i in range(60_000))
    texts = [
        (1, None), (2, ""), (3, "  \t\n "), (4, passage), (5, passage), (5, passage), (6, passage + " and a tail"), (None, passage), (7, "one two three"),
        (8, "one two three"), (9, long), (10, "Licensed under CC BY 4.0.\nAll rights reserved."), (11, "é ü 日本 😀 ñ " * 20), (12, "De " * 3_000), (None, None),
    ]
    rows = [(i, t, None if n % 3 else "en", None if n % 4 == 0 else f"s{n % 3}", None, n, None, 1, None) for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3, "size").cache()


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def components(ids, edges):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


# --- mixing and sharding ------------------------------------------------------------------------------------


def test_targets_stop_at_three_times_the_source(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 10), (None, 0)], "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(sizes).collect()}
    assert got == {"a": pytest.approx(1020 - 60), "b": 30.0, "c": 30.0, None: 0.0}


def test_mix_is_the_plan(odd):
    plan = {(r["doc_id"], r["size"]): r["copies"] for r in mixing_plan(odd).collect()}
    taken = Counter((r["doc_id"], len((r["text"] or "").encode().split())) for r in mix(odd).collect())
    rows = Counter((r["doc_id"], len((r["text"] or "").encode().split())) for r in odd.collect())
    assert mix(odd).columns == odd.columns
    assert all(0 <= c <= 3 for c in plan.values())
    assert {k: plan[k] * n for k, n in rows.items() if plan[k]} == dict(taken)


def test_mix_agrees_for_any_partitioning(docs):
    a = Counter(r["doc_id"] for r in mix(docs.repartition(7)).select("doc_id").collect())
    assert a == Counter(r["doc_id"] for r in mix(docs).select("doc_id").collect())


def test_shards_of_odd_rows(odd):
    rows = interleave(odd, shards=4).collect()
    assert len(rows) == odd.count()
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))


def test_shards_hold_the_mixture(docs):
    got = interleave(docs, shards=4).groupBy("shard", "source").count().collect()
    by = defaultdict(list)
    for r in got:
        by[r["source"]].append(r["count"])
    assert all(max(c) - min(c) <= 2 for c in by.values())


# --- rules and licences -------------------------------------------------------------------------------------


def test_rules_on_odd_rows(odd):
    got = {r["doc_id"]: r for r in quality_rules(odd).collect()}
    assert got[1]["n_words"] == 0 and not got[1]["kept"] and not got[2]["kept"]
    assert got[4]["kept"] and got[12]["n_repeat_words"] == 3_000 and got[12]["base_failed"]
    assert got[9]["n_words"] == 60_000 and got[9]["n_repeat_words"] == 0


def test_rule_order_does_not_matter(docs):
    from panelcraft.llm.rules import default_rules

    verdict = lambda rules: {r["doc_id"]: r["kept"] for r in quality_rules(docs, rules=rules).select("doc_id", "kept").collect()}
    assert verdict(default_rules()) == verdict(default_rules()[::-1])


def test_licences_on_odd_rows(odd):
    got = [r for r in scan_licences(odd).collect()]
    assert len(got) == odd.count()
    ten = next(r for r in got if r["doc_id"] == 10)
    assert (ten["n_base"], ten["first_word"], ten["last_word"], ten["base_labels"], ten["score"]) == (2, 2, 6, "cc-by,reserved", 1.0)
    assert all(r["score"] == 0.0 and r["labels"] == "" for r in got if r["doc_id"] in (1, 2, 3, 4))


def test_notice_with_a_word_put_in(spark):
    df = spark.createDataFrame([(1, "so it is Licensed under the Apache public License, Version 2.0, we say")], "doc_id long, text string")
    row = scan_licences(df).first()
    assert row["n_base"] == 0 and row["labels"] in ("", "apache") and row["score"] < 1


# --- near-duplicates ----------------------------------------------------------------------------------------


def brute_groups(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    edges = []
    for x in range(len(sets)):
        for y in range(x):
            both = len(np.intersect1d(sets[x][1], sets[y][1]))
            if both and 100 * both >= 75 * (len(sets[x][1]) + len(sets[y][1]) - both):
                edges.append((sets[x][0], sets[y][0]))
    return {i: len(s) for i, s in sets}, components([i for i, _ in sets], edges)


def check_groups(df):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    sizes, low = brute_groups(rows)
    got = join_similar(df).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (sizes[i], low[i]) for i in sizes}


def test_jaccard_against_brute_force(docs):
    check_groups(docs)


def test_jaccard_near_the_threshold(spark):
    rng = np.random.default_rng(3)
    rows, key = [], 0
    for size in (1, 4, 5, 6, 7, 8, 9, 12, 20, 40, 90, 200):
        base = [f"t{size}_{i}" for i in range(size)]
        for _ in range(12):
            ws = list(base)
            for _ in range(int(rng.integers(0, 1 + size // 16 + 1))):
                ws[int(rng.integers(0, size))] = f"x{rng.integers(0, 4)}"
            rows.append((key, " ".join(ws[: size - int(rng.integers(0, 1 + size // 8))])))
            key += 1
    check_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_jaccard_of_a_crowd(spark, monkeypatch):
    """Frequent and very frequent tokens, signatures that many sets share, several rounds."""
    from panelcraft.llm import jaccard

    monkeypatch.setattr(jaccard, "FREQUENT", 3)
    monkeypatch.setattr(jaccard, "VERY_FREQUENT", 8)
    rng = np.random.default_rng(4)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(150):
        ws = list(base)
        for at in rng.integers(0, 80, int(rng.integers(0, 5))):
            ws[at] = f"e{rng.integers(0, 1000)}"
        rows.append((i, " ".join(ws)))
    check_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))


def test_jaccard_of_blocks(spark, monkeypatch):
    """Families around several texts, members of which are alike only through others, in many small blocks."""
    from panelcraft.llm import jaccard

    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 500)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 4)
    rng = np.random.default_rng(5)
    rows = []
    for family in range(3):
        base = [f"b{i}" for i in range(100)] if family < 2 else [f"c{i}" for i in range(100)]
        for i in range(80):
            ws = list(base)
            for at in rng.integers(0, 100, int(rng.integers(1, 8))):
                ws[at] = f"e{rng.integers(0, 6)}"
            rows.append((family * 100 + i, " ".join(ws[family * 8 :])))
    check_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))


def test_jaccard_of_odd_rows(odd):
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in join_similar(odd).collect()]
    assert len(got) == odd.count()
    by = {i: c for i, _, c in got}
    assert by[5] == by[6] == 4 and by[8] == 7 and by[None] is None and by[1] == 1
    assert {n for i, n, _ in got if i in (1, 2, 3)} == {0}


def test_jaccard_keeps_rows_of_equal_batches(spark, tmp_path):
    """A part file that a table holds twice, and runs of equal rows over several batches."""
    passage = " ".join(f"word{i}" for i in range(60))
    part = spark.createDataFrame([(1, passage), (1, passage), (2, passage + " tail"), (None, None), (3, None)], "doc_id long, text string")
    for _ in range(2):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
    got = Counter((r["doc_id"], r["component_id"]) for r in join_similar(spark.read.parquet(str(tmp_path / "docs"))).collect())
    assert got == {(1, 1): 4, (2, 1): 2, (None, None): 2, (3, 3): 2}
    equal = spark.range(25_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    assert join_similar(equal.coalesce(1)).count() == 25_000


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 24))
    x = np.repeat(centres, 12, axis=0) + rng.normal(size=(480, 24)) * 0.22
    x[100:110] = x[99]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x.astype(np.float32))]
    bad = [(900, None), (901, [0.0] * 24), (902, [float("nan")] * 24), (903, [float("inf")] * 24), (904, []), (905, [1.0, 2.0]), (906, [None] * 24), (907, [2.0, 4.0])]
    df = spark.createDataFrame([*rows, *bad, (None, rows[0][1])], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in link_embeddings(df, tile=64).collect()}
    u = np.array([v for _, v in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    low = components(range(480), [tuple(e) for e in np.argwhere(near)])
    assert near.sum() > 100
    for i in range(480):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (near[i].sum(), low[i], low[i] == i)
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i, _ in bad if i not in (905, 907))
    assert got[907]["component_id"] == 905 and got[None]["component_id"] is None


# --- repeated substrings ------------------------------------------------------------------------------------


def byte_rows(df):
    found = bytes_dedup.remove_repeated_bytes(df).collect()
    return sorted((r["n_bytes"], sum(s["after"] - s["first"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in found)


def word_rows(df):
    found = words_dedup.remove_repeated_words(df).collect()
    return sorted((r["n_words"], sum(s["after"] - s["first"] for s in r["spans"]), r["kept"]) for r in found)


@pytest.mark.parametrize("crowd", [4_096, 2])
def test_substrings_against_brute_force(docs, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    texts = [r["text"] for r in docs.select("text").collect()]
    assert byte_rows(docs) == sorted(bytes_dedup.brute_force(texts))
    assert word_rows(docs.repartition(5)) == sorted(words_dedup.brute_force(texts))


def test_substrings_of_odd_rows(odd, monkeypatch):
    monkeypatch.setattr(repeats, "STRETCH", 1_000)
    monkeypatch.setattr(repeats, "HEAVY", 1)
    monkeypatch.setattr(repeats, "BLOCK", 2_000)
    texts = [r["text"] for r in odd.select("text").collect()]
    assert byte_rows(odd) == sorted(bytes_dedup.brute_force(texts))
    assert word_rows(odd) == sorted(words_dedup.brute_force(texts))


def test_indexes_agree_with_counting():
    rng = np.random.default_rng(6)
    for _ in range(30):
        pieces = [rng.integers(0, 2, int(rng.integers(4, 40))).astype(np.uint8) for _ in range(int(rng.integers(1, 9)))]
        seen = Counter(tuple(p[i : i + 4]) for p in pieces for i in range(len(p) - 3))
        want = [[seen[tuple(p[i : i + 4])] > 1 for i in range(len(p) - 3)] for p in pieces]
        assert [f.tolist() for f in bytes_dedup.repeated_by_runs(pieces, 4)] == want
        assert [f.tolist() for f in words_dedup.repeated_by_factors(pieces, 4)] == want


# --- classifier ---------------------------------------------------------------------------------------------


def test_classifier_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = fit_classifier(docs, labels)
    got = classify(docs, *model).where(fold("doc_id") == 0).join(labels, "doc_id").select("quality", "score").toPandas()
    good, bad = got[got.quality == 1].score.to_numpy(), got[got.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.9
    assert ((got.score >= 0.3) == (got.quality == 1)).mean() > 0.9
    again = fit_classifier(docs, labels)
    assert np.allclose(again[1].w1, model[1].w1)


def test_classifier_on_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (9, 0), (4, None), (None, 1), (12, 0), (6, 1)], "doc_id long, quality int")
    got = classify(odd, *fit_classifier(odd, labels))
    assert got.columns == [*odd.columns, "score"] and all(0 <= r["score"] <= 1 for r in got.collect())
    assert {r["score"] for r in classify(odd, *fit_classifier(odd, labels.limit(0))).collect()} == {0.5}
    assert classify(none, *fit_classifier(none, labels)).count() == 0


# --- pieces -------------------------------------------------------------------------------------------------


def test_pieces_equal_the_library(spark, odd, docs):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    some = docs.limit(40).select("doc_id", "text").unionByName(odd.where("doc_id <> 9").select("doc_id", "text"))
    more = spark.createDataFrame([(70, "  two  spaces\t\n tab "), (71, "    "), (72, "x" * 300), (73, "<s> <0x41> </s>"), (74, "List<?> <?><?> Map<?,<?>>")], "doc_id long, text string")
    got = encode(some.unionByName(more), frequent=500).withColumn("back", decode("ids")).collect()
    for r in got:
        if r["text"] is None:
            assert r["ids"] is None and r["back"] is None
        else:
            assert r["ids"] == lib.encode(r["text"]) and r["back"] == r["text"]


def test_unigram_path_is_the_best(spark):
    scores = {"a": -3.0, "b": -3.0, "c": -3.0, "ab": -4.0, "bc": -3.5, "abc": -9.0, "aa": -5.0}
    model = PieceModel(("<unk>", *scores), (0.0, *scores.values()), -1, 0, "unigram")
    words = ["abc", "aabc", "abab", "cab", "bca", "a", "aaaa"]
    got = {r["unit"]: r["ids"] for r in unit_ids(spark.createDataFrame([(w,) for w in words], "unit string"), model).collect()}

    def best(w):
        return max(((scores[w[:k]] + (best(w[k:])[0] if w[k:] else 0), [w[:k], *(best(w[k:])[1] if w[k:] else [])]) for k in range(1, len(w) + 1) if w[:k] in scores), default=(-1e9, []))

    for w in words:
        parts = [model.pieces[i] for i in got[w]]
        assert "".join(parts) == w and sum(scores[p] for p in parts) == pytest.approx(best(w)[0])


# --- all together -------------------------------------------------------------------------------------------


def test_empty_tables(none, spark):
    for f in (mixing_plan, mix, interleave, quality_rules, scan_licences, join_similar, bytes_dedup.remove_repeated_bytes, words_dedup.remove_repeated_words):
        assert f(none).count() == 0
    assert encode(none, model=load_model()).count() == 0
    assert link_embeddings(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    now, columns = docs, docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = now
        stage(spark, now, FOLDER).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert now.columns == columns
        if name == "quality_classifier":
            kept = classify(before, *fit_classifier(before, spark.read.parquet(f"{FOLDER}/labels.parquet"))).where("score >= 0.3")
            assert {r["doc_id"] for r in now.collect()} == {r["doc_id"] for r in kept.collect()}
        elif name == "ngram_jaccard_join":
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            assert {r["doc_id"] for r in now.collect()} == set(brute_groups(rows)[1].values())
        elif name == "substring_dedup":
            rows = before.orderBy("doc_id").collect()
            want = words_dedup.brute_force([r["text"] for r in rows])
            got = now.orderBy("doc_id").collect()
            assert [" ".join((r["text"] or "").split()) for r in got] == [" ".join(w[2].split()) for w in want]
            assert all(r["n_chars"] == len(r["text"]) for r in got)
        elif name == "source_mixing":
            copies = {r["doc_id"]: r["copies"] for r in mixing_plan(before).collect() if r["copies"]}
            assert Counter(r["doc_id"] for r in now.collect()) == copies
        else:
            assert now.where("NOT same").count() == 0 and now.count() == before.count()


def test_pipeline_on_odd_rows(spark, odd):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, FOLDER).count() >= 0, name


def test_queries_without_sql_have_rows(spark):
    sql = entry.oracle_sql()
    for name in ("op2_embeddings", "op3_substrings", "op4_jaccard", "op7_passages", "op8_quality", "op9_pieces"):
        assert name not in sql and entry.queries()[name](spark, FOLDER).count() > 0
