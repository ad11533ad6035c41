"""Queries whose results SQL can express: mixing, quality rules, licence scans, shards, divergence of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcraft.llm.divergence import source_divergence
from panelcraft.llm.licences import PHRASES, TEMPLATES, scan_licences
from panelcraft.llm.mixing import mixing_plan
from panelcraft.llm.rules import quality_rules
from panelcraft.llm.sharding import interleave


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of each document."""
    plan = mixing_plan(documents(spark, folder))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules(documents(spark, folder)).select(*columns)


def op6_licences(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licences(documents(spark, folder))


def op10_shards(spark: SparkSession, folder: str) -> DataFrame:
    return interleave(documents(spark, folder))


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(documents(spark, folder))


# --- the same results in SQL -------------------------------------------------------------------------------

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

MIX_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1.0::DOUBLE AS weight FROM s),
-- each round stops the sources above three times their size and shares the rest again
r AS (
  SELECT source, source_size, weight, false AS stopped, 0 AS round FROM w
  UNION ALL
  SELECT source, source_size, weight, stopped OR hit, round + 1 FROM (
    SELECT *, bool_or(hit AND NOT stopped) OVER () AS go FROM (
      SELECT *, weight * ((sum(source_size) OVER () - sum(CASE WHEN stopped THEN 3 * source_size ELSE 0 END) OVER ())
        / nullif(sum(CASE WHEN stopped THEN 0 ELSE weight END) OVER (), 0)) > 3 * source_size AS hit FROM r
      WHERE round = (SELECT max(round) FROM r))) WHERE go),
l AS (SELECT * FROM r WHERE round = (SELECT max(round) FROM r)),
t AS (
  SELECT source, source_size, CASE WHEN stopped THEN 3.0 * source_size ELSE weight
    * ((sum(source_size) OVER () - sum(CASE WHEN stopped THEN 3 * source_size ELSE 0 END) OVER ())
      / nullif(sum(CASE WHEN stopped THEN 0 ELSE weight END) OVER (), 0)) END::DOUBLE AS target FROM l),
p AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0) ELSE 0.0 END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, (floor(rate) + CASE WHEN ('0x' || substr(md5(concat(coalesce(doc_id::VARCHAR, 'null'), '-7')), 1, 8))::BIGINT / 4294967296.0
    < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies FROM p)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c"""

RULES_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
m AS (
  SELECT doc_id, t, ws, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM m)),
twice AS (SELECT doc_id, unnest(range(i, i + 5)) AS word FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT word)::BIGINT AS n_repeat_words FROM twice GROUP BY doc_id),
j AS (
  SELECT m.*, len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words FROM m LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM j)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols * 100 > n_words * 30 OR n_dup_lines * 100 > n_lines * 30
    OR word_chars > n_words * 20 OR word_chars < n_words * 2
    OR len(list_filter(ws, lambda w: length(w) >= 4 AND upper(w) = w AND lower(w) <> w)) * 100 > n_words * 50
    OR len(list_filter(ws, lambda w: lower(w) = upper(w))) * 100 > n_words * 40
    OR (length(t) - length(replace(t, '!', ''))) * 100 > n_words * 100) AS kept
FROM b"""

_NOTICES = ", ".join(f"('{k}', string_split('{v}', ' '))" for k, v in TEMPLATES.items())
_PLACES = " UNION ALL ".join(
    f"SELECT doc_id, i, '{label}' AS label FROM starts WHERE array_to_string(ws[i:i + {len(p.split()) - 1}], ' ') = '{p}'" for p, label in PHRASES.items()
)

LICENCES_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
b AS ({_PLACES}),
base AS (
  SELECT doc_id, count(*)::BIGINT AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word, list(DISTINCT label) AS base FROM b GROUP BY doc_id),
n(label, ws) AS (VALUES {_NOTICES}),
w AS (SELECT label, len(ws) - 2 AS n_grams, i AS t, array_to_string(ws[i:i + 2], ' ') AS gram FROM (SELECT *, unnest(range(1, len(ws) - 1)) AS i FROM n)),
h AS (SELECT doc_id, label, n_grams, t, i - t AS diagonal FROM starts JOIN w ON array_to_string(ws[i:i + 2], ' ') = gram AND i <= len(ws) - 2),
g AS (SELECT DISTINCT doc_id, label, diagonal FROM h),
a AS (SELECT *, coalesce((diagonal - lag(diagonal) OVER (PARTITION BY doc_id, label ORDER BY diagonal) > 2)::INT, 0) AS apart FROM g),
p AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, label ORDER BY diagonal) AS place FROM a),
v AS (SELECT doc_id, label, n_grams, count(DISTINCT t) AS votes FROM h JOIN p USING (doc_id, label, diagonal) GROUP BY doc_id, label, n_grams, place),
f AS (SELECT doc_id, list(DISTINCT label) AS more, max(votes / n_grams) AS best FROM v WHERE votes * 100 >= n_grams * 60 GROUP BY doc_id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN f USING (doc_id)"""

# the table of the checksum follows from its polynomial; one fold over the bytes of a text
SHARDS_SQL = """
WITH RECURSIVE step(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i) UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM step WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8),
b AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 8 AS size, list_prepend(4294967295, list_transform(range(octet_length(encode(coalesce(text, '')))),
    lambda i: ('0x' || substr(hex(encode(coalesce(text, ''))), 2 * i + 1, 2))::BIGINT)) AS bs FROM documents),
c AS (
  SELECT doc_id, source, size, xor(list_reduce(bs, lambda x, y: xor(x // 256, t[xor(x % 256, y) + 1])), 4294967295) AS text_crc32,
    md5(concat(coalesce(doc_id::VARCHAR, 'null'), '-20')) AS h FROM b, tab),
r AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY h, doc_id, size, text_crc32) - 1 + 0.5::DOUBLE)
    / count(*) OVER (PARTITION BY source) AS rank FROM c),
p AS (SELECT *, row_number() OVER (ORDER BY rank, h, doc_id, size, text_crc32, source) - 1 AS place, count(*) OVER () AS total FROM r),
s AS (SELECT *, place * 24 // total AS shard FROM p)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard, place - (shard * total + 23) // 24 AS slot, NULL::INT AS grown_shard, source FROM s"""

DIVERGENCE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
t AS (SELECT id, lang, source, unnest(ws) AS term FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n, count(DISTINCT id) AS docs FROM t GROUP BY ALL),
k AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY ALL HAVING sum(docs) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, count(term)::HUGEINT AS v, coalesce(sum(n), 0)::HUGEINT AS total FROM (SELECT DISTINCT lang FROM g) LEFT JOIN k USING (lang) GROUP BY lang),
x AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM x GROUP BY ALL),
p AS (SELECT x.*, 1 + 1000000000::HUGEINT * (n + 1) // (s.total + v) AS p FROM x JOIN s USING (lang, source) JOIN l USING (lang)),
q AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (k.n + 1) // (total + v) AS q FROM k JOIN l USING (lang)),
far AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
marks AS (SELECT p.lang, p.source, p.term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT FROM marks)
SELECT * FROM r WHERE part = 'pair' OR rank <= 200"""

QUERIES = {"op1_mix": op1_mix, "op5_quality_rules": op5_quality_rules, "op6_licences": op6_licences, "op10_shards": op10_shards, "op12_divergence": op12_divergence}
ORACLES = {"op1_mix": MIX_SQL, "op5_quality_rules": RULES_SQL, "op6_licences": LICENCES_SQL, "op10_shards": SHARDS_SQL, "op12_divergence": DIVERGENCE_SQL}
