"""Queries that apply each operator to its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import table


def op1_cgk_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from plumbline.llm.decontaminate import leaks

    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_deleted_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    from plumbline.llm.language import scored

    return scored(table(spark, folder, "documents"), order=3)


def op3_minhash_odd_sketch(spark: SparkSession, folder: str) -> DataFrame:
    from plumbline.llm.near import near_duplicates

    return near_duplicates(table(spark, folder, "documents"))


def op4_column_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from plumbline.llm.repeats import without_repeats

    return without_repeats(table(spark, folder, "documents"))


def op5_boosted_private_data(spark: SparkSession, folder: str) -> DataFrame:
    from plumbline.llm.private import fitted, found

    docs = table(spark, folder, "documents")
    return found(docs, fitted(docs))


def op6_site_templates(spark: SparkSession, folder: str) -> DataFrame:
    from plumbline.llm.pages import extracted

    return extracted(table(spark, folder, "pages"))


def op7_toxicity_bigru(spark: SparkSession, folder: str) -> DataFrame:
    from plumbline.llm.toxicity import fitted, scored

    docs = table(spark, folder, "documents")
    return scored(docs, fitted(docs, table(spark, folder, "labels")))


def op8_iblt_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    from plumbline.llm.fingerprint import compared

    return compared(table(spark, folder, "documents"))


def op9_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    from plumbline.llm.mixing import Mix

    return Mix(table(spark, folder, "documents")).documents()


def op10_feistel_shards(spark: SparkSession, folder: str) -> DataFrame:
    from plumbline.llm.sharding import sharded

    return sharded(table(spark, folder, "documents"))


def op11_suffix_tree_runs(spark: SparkSession, folder: str) -> DataFrame:
    from plumbline.llm.periodic import digests, periodic_runs, periodic_tails

    return digests(periodic_runs(periodic_tails(table(spark, folder, "documents"))))


def op12_four_russians_negatives(spark: SparkSession, folder: str) -> DataFrame:
    from plumbline.llm.negatives import mined

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mined(table(spark, folder, "embeddings"), F.col("id") % 100 == 0, label=label)


def op13_prefix_tree_join(spark: SparkSession, folder: str) -> DataFrame:
    from plumbline.llm.trie import joined

    return joined(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_cgk_decontamination, op2_deleted_interpolation, op3_minhash_odd_sketch, op4_column_suffix_dedup, op5_boosted_private_data, op6_site_templates, op7_toxicity_bigru, op8_iblt_fingerprint, op9_mix_sources, op10_feistel_shards, op11_suffix_tree_runs,
                                op12_four_russians_negatives, op13_prefix_tree_join)}

#: Groups of documents whose distinct shingles have 100 * intersection >= 85 * union; @W is the shingle's words.
_GROUPS = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + @W - 1], ' ') AS g
  FROM w, unnest(range(1, greatest(len(ws) - @W + 1, 1) + 1)) AS t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
m AS (SELECT a, min(b) AS least FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m.least, w.doc_id)) AS component_id@MORE
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN m ON m.a = w.doc_id"""

#: Runs as islands of equal words at distance q, found where eight words repeat; a run of a multiple of its period is one that
#: a shorter period has found. crc32 is a fold over the digits' bits.
_RUNS = r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w0,
  4294967295 - list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda c: [ord(c)::BIGINT + 8589934592, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda h, x: CASE WHEN x >= 0 THEN xor(h, x - 8589934592) WHEN h % 2 = 1 THEN xor(h // 2, 3988292384) ELSE h // 2 END) AS h FROM documents),
e AS (SELECT doc_id, w0, len(w0) AS n, h % 10 = 0 AND len(w0) > 0 AS planted, (h // 10) % greatest(len(w0), 1) AS a, (h // 10) % 8 AS r FROM d),
f AS (SELECT doc_id, n, CASE WHEN planted THEN list_transform(range(n),
    lambda i: CASE WHEN i < a THEN w0[i + 1] ELSE w0[a + (i - a) % (1 + (n - a) // (3 + r)) + 1] END) ELSE w0 END AS w FROM e),
g AS (SELECT doc_id, n, i, hash(w[i + 1:i + 8]) AS k FROM f, unnest(range(n - 7)) AS t(i) WHERE n >= 24),
p AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.k = y.k AND x.i < y.i AND 3 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM p),
u AS (SELECT doc_id, q, min(i) AS start, count(*) + 7 + q AS length FROM s GROUP BY doc_id, q, island),
v AS (SELECT doc_id, start, length, min(q) AS period FROM u WHERE length >= greatest(24, 3 * q) GROUP BY doc_id, start, length),
b AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM v GROUP BY doc_id),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) AS place FROM v),
c AS (SELECT f.doc_id, list_filter(range(f.n), lambda i: NOT list_bool_or(list_transform(coalesce(z.runs, [[0::BIGINT, 0::BIGINT]]), lambda x: i >= x[1] AND i < x[2]))) AS stay, f.w
  FROM f LEFT JOIN (SELECT doc_id, list([start + period, start + length]) AS runs FROM v GROUP BY doc_id) z ON z.doc_id = f.doc_id)
SELECT c.doc_id, coalesce(b.n_runs, 0) AS n_runs, o.start, o.length, o.period, 1000 * o.length // o.period AS exponent_milli,
  sha256(coalesce(b.lines, '')) AS runs_sha256, sha256(coalesce(array_to_string(list_transform(stay, lambda i: w[i + 1]), ' '), '')) AS collapsed_sha256
FROM c LEFT JOIN b ON b.doc_id = c.doc_id LEFT JOIN o ON o.doc_id = c.doc_id AND o.place = 1"""

_NEGATIVES = r"""WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS alike, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor, other, score FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.other AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other) AS INTEGER) AS rank,
  s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.alike AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5"""

SQL: dict[str, str] = {
    "op3_minhash_odd_sketch": _GROUPS.replace("@W", "5").replace("@MORE", ",\n  w.doc_id <= coalesce(m.least, w.doc_id) AS kept"),
    "op11_suffix_tree_runs": _RUNS,
    "op12_four_russians_negatives": _NEGATIVES,
    "op13_prefix_tree_join": _GROUPS.replace("@W", "4").replace("@MORE", "")}
