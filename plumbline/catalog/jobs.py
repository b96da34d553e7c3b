"""Whole jobs and column families bound to the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.catalog.base import LINE_NUMBERS, REF_CUR, lineitem, query, reference_and_current, round_all, rounded, table
from plumbline.catalog.modelling import NEIGHBOURS, _vectors
from plumbline.catalog.profiling import bins_sql
from plumbline.catalog.storage import scratch
from plumbline.operators import knn
from plumbline.operators.calibrate import fit_calibration
from plumbline.operators.impute import ImputePolicy
from plumbline.operators.profile import describe
from plumbline.operators.rules import NullOutside, apply_rules
from plumbline.operators.tables import shared_numeric_columns
from plumbline.plans import articles, preprocess
from plumbline.plans.clean import CleanConfig, CleanJob
from plumbline.plans.families import ColumnFamilies, Family

PAGES = CleanJob(CleanConfig(
    keys=("url",), score="n_html", ties=("page_id",), prefixes=("https://",),
    enforcement=lambda columns: [NullOutside("length_outside", ("n_html",), 500.0, 2500.0)],
    imputation=lambda columns: ImputePolicy(median=("n_html",))))
PAGE_SQL = """k AS (SELECT page_id, length(html)::DOUBLE AS n, CASE WHEN page_id % 11 = 0 THEN ' None '
  ELSE '  ' || upper(regexp_replace(lower(trim(url)), '/[^/]*$', '')) END AS k FROM pages),
f AS (SELECT page_id, n, lower(trim(k)) AS k FROM k),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, page_id DESC) AS r FROM f WHERE starts_with(k, 'https://')) WHERE r = 1),
e AS (SELECT k, page_id, CASE WHEN n BETWEEN 500 AND 2500 THEN n END AS n FROM b)"""


def _raw_pages(spark, folder):
    host = F.regexp_replace(F.lower(F.trim("url")), "/[^/]*$", "")
    return table(spark, folder, "pages").select(
        "page_id", F.when(F.col("page_id") % 11 == 0, F.lit(" None ")).otherwise(F.concat(F.lit("  "), F.upper(host))).alias("url"),
        F.length("html").alias("n_html"))


@query(f"""WITH {PAGE_SQL} SELECT k AS url, page_id::DOUBLE AS page_id, round(coalesce(n, (SELECT quantile_cont(n, 0.5) FROM e)), 4) AS n_html FROM e""")
def clean_pages(spark, folder):
    """The cleaning job with URL keys: normalised, foreign and bad ones dropped, the longest page of each kept, lengths repaired."""
    return round_all(PAGES.run(_raw_pages(spark, folder)).table.select("url", "page_id", "n_html"), 4)


@query(f"""WITH {PAGE_SQL}, bad AS (SELECT count(*) AS n FROM f WHERE k IN ('', 'nan', 'none', 'null'))
SELECT 'keys' AS stage, 'bad_tokens' AS rule, '*' AS "column", n FROM bad
UNION ALL SELECT 'keys', 'foreign_prefix', '*', (SELECT count(*) FROM f WHERE NOT starts_with(k, 'https://')) - n FROM bad
UNION ALL SELECT 'keys', 'deduplicated', '*', (SELECT count(*) FROM f WHERE starts_with(k, 'https://')) - (SELECT count(*) FROM b)
UNION ALL SELECT 'coercion', 'coerced', unnest(['page_id', 'url', 'n_html']), 0
UNION ALL SELECT 'enforcement', 'length_outside:nulled', 'n_html', count(*) FILTER (n IS NULL) FROM e
UNION ALL SELECT 'enforcement', unnest(['length_outside:changed', 'length_outside:filled']), 'n_html', 0
UNION ALL SELECT 'imputation', 'continuous_median:filled', 'n_html', count(*) FILTER (n IS NULL) FROM e
UNION ALL SELECT 'imputation', unnest(['continuous_median:changed', 'continuous_median:nulled']), 'n_html', 0
UNION ALL SELECT 'imputation', 'continuous_median:' || unnest(['changed', 'nulled', 'filled']), 'page_id', 0""")
def clean_pages_audit(spark, folder):
    job = CleanJob(CleanConfig(**{**PAGES.config.__dict__, "imputation": lambda columns: ImputePolicy(median=("n_html", "page_id"))}))
    return job.run(_raw_pages(spark, folder)).audit


FAMILIES = ColumnFamilies({"key": Family(names=("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")),
                           "money": Family(prefixes=("l_ext", "l_tax")), "amount": Family(prefixes=("l_quant",))}, rest="other")
_IN_FAMILY = {"money": ["l_extendedprice", "l_tax"], "amount": ["l_quantity"], "other": ["l_discount"]}


@query(" UNION ALL ".join(f"""SELECT '{family}' AS family, '{c}' AS "column", round(avg({c}), 4) AS mean FROM lineitem"""
                          for family, columns in _IN_FAMILY.items() for c in columns))
def family_means(spark, folder):
    """Columns by family: by prefix, by name, and the numeric rest."""
    rows = lineitem(spark, folder)
    found = FAMILIES.of(rows)
    pairs = [(f, c) for f, columns in found.items() if f != "key" for c in columns]
    means = rows.agg(*[rounded(F.avg(c), 4).alias(c) for _, c in pairs])
    return means.select(F.inline(F.array(*[F.struct(F.lit(f).alias("family"), F.lit(c).alias("column"), F.col(c).alias("mean")) for f, c in pairs])))


@query(f"WITH {REF_CUR} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", (SELECT round(avg({c}), 4) FROM ref) AS ref_mean, (SELECT round(avg({c}), 4) FROM cur) AS cur_mean"""
    for c in ("l_extendedprice", "l_quantity")))
def shared_column_means(spark, folder):
    """Columns that are numeric on both sides: one side lacks a column, the other has one as text."""
    ref, cur = reference_and_current(spark, folder)
    ref = ref.select(*LINE_NUMBERS).drop("l_tax")
    cur = cur.select(*LINE_NUMBERS).withColumn("l_discount", F.col("l_discount").cast("string"))
    columns = shared_numeric_columns(ref, cur)
    side = lambda df, name: describe(df, columns, {}).select("column", rounded(F.col("mean"), 4).alias(name))      # noqa: E731
    return side(ref, "ref_mean").join(F.broadcast(side(cur, "cur_mean")), "column")


def _clipped(column, value, k=3.0):
    return f"greatest((SELECT avg({value}) - {k} * stddev_samp({value}) FROM ref), least((SELECT avg({value}) + {k} * stddev_samp({value}) FROM ref), {value})) AS {column}"


@query(f"""WITH {REF_CUR}, z AS (SELECT l_orderkey, l_linenumber, {_clipped('n_tokens_title', 'l_quantity * l_quantity * l_quantity')},
  {_clipped('shares', 'exp(l_extendedprice / 10000)')}, {_clipped('n_unique_tokens', 'l_discount * 20')}, {_clipped('kw_min_min', '(l_tax * 100 - 1)')} FROM cur)
SELECT l_orderkey, l_linenumber, round(n_tokens_title, 2) AS n_tokens_title, round(shares, 2) AS shares,
  round(greatest(0.0, least(1.0, n_unique_tokens)), 6) + 0.0 AS n_unique_tokens, round(kw_min_min, 6) + 0.0 AS kw_min_min FROM z""")
def reconstruct_articles(spark, folder):
    """The preset's reconstruction: every count, the target and the sentinels into three deviations of the reference."""
    named = lambda df: df.select("l_orderkey", "l_linenumber", (F.col("l_quantity") * F.col("l_quantity") * F.col("l_quantity")).alias("n_tokens_title"),
                                 F.exp(F.col("l_extendedprice") / 10000).alias("shares"), (F.col("l_discount") * 20).alias("n_unique_tokens"),
                                 (F.col("l_tax") * 100 - 1).alias("kw_min_min"))
    ref, cur = reference_and_current(spark, folder)
    out = apply_rules(named(cur), fit_calibration(named(ref), articles.reconstruction_config()))
    return out.select("l_orderkey", "l_linenumber", rounded(F.col("n_tokens_title"), 2).alias("n_tokens_title"), rounded(F.col("shares"), 2).alias("shares"),
                      rounded(F.col("n_unique_tokens")).alias("n_unique_tokens"), rounded(F.col("kw_min_min")).alias("kw_min_min"))


@query(f"""WITH {bins_sql('lineitem', LINE_NUMBERS, 30, 'h')} SELECT "column", bin, round(lo, 5) AS lo, round(hi, 5) AS hi, n FROM h""")
def preprocess_histograms(spark, folder):
    df = lineitem(spark, folder).select("l_orderkey", "l_linenumber", *LINE_NUMBERS)
    return round_all(preprocess.preprocess(df, ["l_orderkey", "l_linenumber"]).histograms, 5)


@query(" UNION ALL ".join(f"SELECT '{a}' AS column_i, '{b}' AS column_j, round(corr({a}, {b}), 6) + 0.0 AS r FROM lineitem"
                          for i, a in enumerate(LINE_NUMBERS) for b in LINE_NUMBERS[i + 1:]))
def preprocess_correlations(spark, folder):
    df = lineitem(spark, folder).select("l_orderkey", "l_linenumber", *LINE_NUMBERS)
    return round_all(preprocess.preprocess(df, ["l_orderkey", "l_linenumber"]).correlations)


@query(f"""WITH {NEIGHBOURS} SELECT query_id, round(coalesce(avg(y) FILTER (d = 0),
  sum(y / d) FILTER (d > 0) / sum(1 / d) FILTER (d > 0)), 6) AS prediction FROM near GROUP BY query_id""")
def knn_stored_predictions(spark, folder):
    """An index written, loaded and asked."""
    queries, rows, features = _vectors(spark, folder)
    path = scratch(spark)
    knn.build_index(rows, features, "vec_id", "label").save(path)
    return round_all(knn.NeighbourIndex.load(spark, path).regress(queries.withColumnRenamed("vec_id", "query_id"), "query_id", 15))


@query(f"WITH {NEIGHBOURS} SELECT true AS found_nine_tenths, count(*) AS exact_pairs FROM near")
def knn_projection_recall(spark, folder):
    """Recall of the random-projection join against the exact one."""
    queries, rows, features = _vectors(spark, folder)
    q, t = queries.withColumnRenamed("vec_id", "query_id"), rows.withColumnRenamed("vec_id", "train_id")
    near = knn.approximate_join(q, t, features, "query_id", "train_id", 15, tables=24, bits=4, probes=4)
    exact = knn.knn_join(q, t, features, "query_id", "train_id", 15)
    hits = exact.join(near.select("query_id", "train_id", F.lit(1).alias("hit")), ["query_id", "train_id"], "left")
    return hits.agg((F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("found_nine_tenths"), F.count(F.lit(1)).alias("exact_pairs"))
