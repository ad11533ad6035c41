"""How far apart the sources of a language are: smoothed term shares, their chi-square distances, and the terms that
tell a source from its language.

A task takes the terms of a text in two passes over its bytes, lower-casing and blanking by one translate table, then
splitting; a counter per document gives frequencies, which are added up by source before anything moves. All later
arithmetic is exact, on whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcraft.llm.common import stored

#: A term of a language stands in so many of its documents at least.
LEAST_DOCUMENTS = 3
#: Shares are whole numbers in units of 1 / ``SCALE``.
SCALE = 1_000_000_000
TOP_TERMS = 200
#: Counter entries that a task holds before it adds them up and sends them on.
HELD = 1_000_000
#: One pass over the bytes of a text: capital letters become small ones, other ASCII characters blanks.
TABLE = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of letters and non-ASCII characters of a UTF-8 text, A-Z in lower case."""
    return text.translate(TABLE).split()


class _Counts:
    """Counters of documents, one after the other, and their sums by group and term."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.terms: list[bytes] = []
        self.numbers: list[int] = []
        self.group: list[int] = []
        self.sizes: list[int] = []

    def add(self, group: tuple[str, str], text: bytes) -> None:
        own = Counter(terms(text))
        self.terms.extend(own)
        self.numbers.extend(own.values())
        self.group.append(self.groups.setdefault(group, len(self.groups)))
        self.sizes.append(len(own))

    def summed(self) -> pa.RecordBatch:
        """A row per group and term, and one without a term for each group."""
        flat = pa.table([pa.array(np.repeat(self.group, self.sizes).astype(np.int64)), pa.array(self.terms, pa.binary()), pa.array(self.numbers, pa.int64())], names=["g", "term", "n"])
        met = flat.group_by(["g", "term"]).aggregate([("n", "sum"), ("n", "count")]).combine_chunks()
        own, nothing = np.arange(len(self.groups)), np.zeros(len(self.groups), np.int64)
        at = pa.array(np.concatenate([met["g"].to_numpy(), own]).astype(np.int64))
        langs, sources = (pa.array([g[k] for g in self.groups], pa.string()).take(at) for k in (0, 1))
        names = pa.chunked_array([*met["term"].cast(pa.string()).chunks, pa.nulls(len(own), pa.string())], pa.string()).combine_chunks()
        n, docs = (pa.array(np.concatenate([met[c].to_numpy(), nothing])) for c in ("n_sum", "n_count"))
        return pa.RecordBatch.from_arrays([langs, sources, names, n, docs], names=["lang", "source", "term", "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts = _Counts()
        for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            counts.add((lang, source), text.as_buffer().to_pybytes())
            if len(counts.terms) >= HELD:
                yield counts.summed()
                counts = _Counts()
        yield counts.summed()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, term, n, docs``: how often a term occurs in a group, and in how many of its documents; one row
    without a term for each group. A term is a text, a document a row; nulls count as ''."""
    own = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))]
    counted = docs.select(*own).mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, whole: str) -> Column:
    """Smoothed share of ``n`` occurrences, rounded down, plus 1; ``whole`` is all occurrences plus one per term."""
    return F.expr(f"1L + (cast({n} + 1L AS decimal(19,0)) * {SCALE}) div cast({whole} AS decimal(19,0))")


def _apart(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def source_divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", top: int = TOP_TERMS, least_documents: int = LEAST_DOCUMENTS
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for each (lang, source) group of ``docs``.

    Part ``pair``: the distance of the group to each other source of its language, over all kept terms, those that
    occur in neither included. Part ``term``: the ``top`` kept terms that the group has more often than its language,
    by their distance. A language keeps the terms that stand in ``least_documents`` of its rows. Ties are ordered by
    the item's bytes.

    Null texts, languages and sources count as ''. A group without terms has all pairs and no terms; a language that
    keeps no term has pairs of value 0. A repeated row counts again. An empty table gives an empty result. Columns
    other than the three named are not looked at.

    Distances are summed over what occurs only: terms that a group lacks share one value, so the distance of a pair is
    worked out from the terms of both, from each group's distinct counts, and from how many terms are left. Pairs of
    sources are made within a term (half the square of the number of sources at most) and added up by their two counts
    before they move.
    """
    counts = stored(term_counts(docs, text, lang, source), "terms")
    groups = counts.where("term IS NULL").select("lang", "source")
    known = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("parts")
    )
    kept = stored(known.where(F.col("docs") >= least_documents).select("lang", "term", "n", "parts"), "kept")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("all"))
    single = kept.select("lang", "term", "n", F.inline("parts").alias("source", "own"))
    sums = single.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("has"), F.sum("own").alias("total"))
    zero = {"has": 0, "total": 0, "v": 0, "all": 0}
    whole = groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").fillna(zero)
    # a language without terms has no shares; 1 keeps the division defined where nothing uses it
    whole = whole.withColumn("whole", F.greatest(F.col("total") + F.col("v"), F.lit(1))).withColumn("none", _share("0L", "whole"))
    whole = stored(whole, "groups")
    return _pairs(kept, single, whole).unionByName(_terms(single, whole, top))


def _terms(single: DataFrame, whole: DataFrame, top: int) -> DataFrame:
    met = single.join(whole.select("lang", "source", "whole", (F.col("all") + F.col("v")).alias("lang_whole")), ["lang", "source"])
    shares = met.withColumn("p", _share("own", "whole")).withColumn("q", _share("n", "lang_whole")).where("p > q")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    found = shares.select("lang", "source", "term", _apart("p", "q").alias("value")).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    return found.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pairs(kept: DataFrame, single: DataFrame, whole: DataFrame) -> DataFrame:
    side = {k: whole.select("lang", F.col("source").alias(k), F.col("whole").alias(f"{k}_whole"), F.col("none").alias(f"{k}_none"), F.col("has").alias(f"{k}_has")) for k in "st"}
    exact = "decimal(38,0)"

    def times(m: str, value: Column) -> Column:
        return F.col(m).cast("decimal(18,0)") * value.cast("decimal(19,0)")

    # terms that one source has, as if the other had none of them: by the distinct counts of a source
    alone = single.groupBy("lang", "source", "own").agg(F.count(F.lit(1)).alias("m"))
    alone = alone.join(whole.select("lang", "source", "whole", "none"), ["lang", "source"]).withColumn("p", _share("own", "whole"))
    met = alone.join(whole.select("lang", F.col("source").alias("other"), F.col("none").alias("z")), "lang").where("source <> other")
    lone = met.select("lang", F.inline(F.array(
        F.struct(F.col("source").alias("s"), F.col("other").alias("t"), times("m", _apart("p", "z")).alias("value")),
        F.struct(F.col("other").alias("s"), F.col("source").alias("t"), times("m", _apart("z", "p")).alias("value")),
    ))).groupBy("lang", "s", "t").agg(F.sum("value").cast(exact).alias("value"))
    # terms of both, less what was counted for each alone
    two = kept.where(F.size("parts") > 1).select("lang", F.posexplode("parts").alias("at", "a"), "parts")
    two = two.select("lang", "a", F.explode(F.slice("parts", F.col("at") + 2, F.size("parts"))).alias("b"))
    two = two.groupBy("lang", F.col("a.source").alias("s"), F.col("b.source").alias("t"), F.col("a.n").alias("m"), F.col("b.n").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    two = two.select("lang", F.inline(F.array(F.struct("s", "t", "m", "k", "n"), F.struct(F.col("t").alias("s"), F.col("s").alias("t"), F.col("k").alias("m"), F.col("m").alias("k"), "n"))))
    two = two.join(side["s"], ["lang", "s"]).join(side["t"], ["lang", "t"]).withColumn("p", _share("m", "s_whole")).withColumn("q", _share("k", "t_whole"))
    gained = (times("n", _apart("p", "q")) - times("n", _apart("p", "t_none")) - times("n", _apart("s_none", "q")) + times("n", _apart("s_none", "t_none"))).cast(exact)
    both = two.select("lang", "s", "t", gained.alias("value")).groupBy("lang", "s", "t").agg(F.sum("value").cast(exact).alias("value"))
    # terms of neither
    every = side["s"].join(side["t"], "lang").where("s <> t").join(whole.select("lang", F.col("source").alias("s"), "v"), ["lang", "s"])
    left = F.col("v") - F.col("s_has") - F.col("t_has")
    rest = F.when(F.col("v") > 0, left.cast("decimal(18,0)") * _apart("s_none", "t_none").cast("decimal(19,0)")).otherwise(F.lit(0)).cast(exact)
    rest = every.select("lang", "s", "t", rest.alias("value"))
    summed = lone.unionByName(both).unionByName(rest).groupBy("lang", "s", "t").agg(F.sum("value").cast("long").alias("value"))
    ranked = Window.partitionBy("lang", "s").orderBy(F.desc("value"), "t")
    return summed.select("lang", F.col("s").alias("source"), F.lit("pair").alias("part"), F.col("t").alias("item"), "value", F.row_number().over(ranked).alias("rank"))
