"""Profiles, distributions, correlations and scaling."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from plumbline.catalog.base import LINE_NUMBERS, lineitem, long_sql, query, round_all, rounded, table
from plumbline.catalog.cleaning import NULLED, nulled
from plumbline.operators import correlation as corr
from plumbline.operators import profile, scale
from plumbline.operators.tables import small_table

WIDTH = 64   # length of an embedding vector


def _share(expr):
    return f"round(100.0::DOUBLE * {expr} / count(*), 6) + 0.0"


# ---------------------------------------------------------------- missing cells

@query(f"WITH {NULLED} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS missing,
    {_share(f'count(*) FILTER ({c} IS NULL)')} AS missing_pct FROM n""" for c in LINE_NUMBERS))
def missing_by_column(spark, folder):
    return round_all(profile.missing_by_column(nulled(spark, folder), LINE_NUMBERS))


@query(f"WITH {NULLED}, m AS (" + " UNION ALL ".join(
    f"SELECT count(*) FILTER ({c} IS NULL) AS missing, {_share(f'count(*) FILTER ({c} IS NULL)')} AS pct FROM n"
    for c in LINE_NUMBERS) + """)
SELECT count(*) FILTER (missing > 0) AS columns_with_missing, count(*) FILTER (pct > 5) AS columns_over_pct,
  sum(missing)::BIGINT AS missing_cells FROM m""")
def missing_overview(spark, folder):
    return profile.missing_overview(nulled(spark, folder).select(*LINE_NUMBERS))


FAMILIES = {"amount": ["l_quantity", "l_extendedprice"], "share": ["l_discount", "l_tax"], "all": LINE_NUMBERS}


@query(f"WITH {NULLED}, m AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS family, 100.0::DOUBLE * count(*) FILTER ({c} IS NULL) / count(*) AS pct FROM n"
    for f, cs in FAMILIES.items() for c in cs) + """)
SELECT family, count(*) AS n_cols, round(avg(pct), 6) + 0.0 AS avg_missing_pct, round(max(pct), 6) + 0.0 AS max_missing_pct,
  count(*) FILTER (pct > 5) AS cols_over_pct FROM m GROUP BY family""")
def missing_by_family(spark, folder):
    return round_all(profile.missing_by_family(nulled(spark, folder), FAMILIES))


ROW_MISSING = " + ".join(f"({c} IS NULL)::INT" for c in LINE_NUMBERS)


@query(f"""WITH {NULLED}, m AS (SELECT {ROW_MISSING} AS m FROM n)
SELECT count(*) AS n_rows, round(avg(m), 6) AS mean, round(stddev_samp(m), 6) AS sd, min(m)::INT AS min,
  quantile_cont(m, 0.5)::DOUBLE AS p50, quantile_cont(m, 0.9)::DOUBLE AS p90, quantile_cont(m, 0.95)::DOUBLE AS p95,
  quantile_cont(m, 0.99)::DOUBLE AS p99, max(m)::INT AS max FROM m""")
def row_missing_dist(spark, folder):
    return round_all(profile.missing_per_row(nulled(spark, folder), LINE_NUMBERS))


@query(f"""WITH {NULLED} SELECT count(*) FILTER (({ROW_MISSING}) * 100.0 > 20.0 * 4) AS sparse_rows, count(*) AS n_rows FROM n""")
def sparse_rows(spark, folder):
    return profile.sparse_rows(nulled(spark, folder), 20.0, LINE_NUMBERS)


@query(f"WITH {NULLED} SELECT " + " || ".join(f"CASE WHEN {c} IS NULL THEN '1' ELSE '0' END" for c in LINE_NUMBERS)
       + " AS pattern, count(*) AS n FROM n GROUP BY 1")
def null_patterns(spark, folder):
    return profile.null_patterns(nulled(spark, folder), LINE_NUMBERS)


@query(f"WITH {NULLED}, p AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS column_i, '{b}' AS column_j, count(*) FILTER ({a} IS NULL AND {b} IS NULL) AS n FROM n"
    for a, b in itertools.combinations(LINE_NUMBERS, 2)) + ") SELECT * FROM p")
def co_missing(spark, folder):
    return profile.co_missing(nulled(spark, folder), LINE_NUMBERS)


# ------------------------------------------------------------------- profiles

def _describe_sql(source, columns, extra=""):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 5) + 0.0 AS mean, round(stddev_samp({c}), 5) AS sd,
        round(min({c})::DOUBLE, 5) + 0.0 AS min, round(quantile_cont({c}::DOUBLE, 0.25), 5) + 0.0 AS p25,
        round(quantile_cont({c}::DOUBLE, 0.5), 5) + 0.0 AS p50, round(quantile_cont({c}::DOUBLE, 0.75), 5) + 0.0 AS p75,
        round(max({c})::DOUBLE, 5) + 0.0 AS max{extra.format(c=c)} FROM {source}""" for c in columns)


UNIQUE = ", round(100.0::DOUBLE * count(*) FILTER ({c} IS NULL) / count(*), 5) + 0.0 AS missing_pct, count(DISTINCT {c}) AS unique_values"


@query(f"WITH {NULLED} " + _describe_sql("n", LINE_NUMBERS))
def describe(spark, folder):
    return round_all(profile.describe(nulled(spark, folder), LINE_NUMBERS), 5)


@query(f"WITH {NULLED} " + _describe_sql("n", LINE_NUMBERS, UNIQUE))
def numeric_profile(spark, folder):
    return round_all(profile.numeric_profile(nulled(spark, folder), LINE_NUMBERS), 5)


ORDER_NUMBERS = ["o_orderkey", "o_custkey", "o_totalprice"]


@query(_describe_sql("orders", ORDER_NUMBERS, UNIQUE))
def numeric_profile_orders(spark, folder):
    return round_all(profile.numeric_profile(table(spark, folder, "orders"), ORDER_NUMBERS), 5)


def _categorical_sql(source, columns):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", (SELECT count(DISTINCT {c}) FROM {source}) AS unique_values,
        (SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS most_frequent,
        (SELECT {_share(f'count(*) FILTER ({c} IS NULL)')} FROM {source}) AS missing_pct""" for c in columns)


@query(_categorical_sql("documents", ["text", "lang", "source"]))
def categorical_profile(spark, folder):
    return round_all(profile.categorical_profile(table(spark, folder, "documents"), ["text", "lang", "source"]))


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(" UNION ALL ".join(f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS unique_values FROM orders""" for c in ORDER_COLUMNS))
def cardinality(spark, folder):
    return profile.cardinality(table(spark, folder, "orders"), ORDER_COLUMNS)


@query("""SELECT (SELECT count(*) FROM documents) - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents))
  AS duplicate_rows""")
def duplicate_rows(spark, folder):
    return profile.duplicate_rows(table(spark, folder, "documents").select("text", "lang", "source", "n_chars"))


@query(f"""WITH {NULLED} SELECT count(*) AS n_rows, 7::BIGINT AS n_columns, sum({ROW_MISSING})::BIGINT AS null_cells,
  6::BIGINT AS numeric_columns, 1::BIGINT AS other_columns FROM n""")
def table_shape(spark, folder):
    return profile.table_shape(nulled(spark, folder))


@query(" UNION ALL ".join(f"""SELECT '{c}' AS "column", value FROM (SELECT min(v) AS value, max(v) AS hi FROM (
  SELECT {e}::DOUBLE AS v FROM part)) WHERE value = hi""" for c, e in (
    ("p_size", "p_size"), ("flat", "p_size * 0 + 3"), ("p_retailprice", "p_retailprice"))))
def constant_columns(spark, folder):
    df = table(spark, folder, "part").select("p_size", (F.col("p_size") * 0 + 3).alias("flat"), "p_retailprice")
    return profile.constant_columns(df)


# --------------------------------------------------------------- distributions

def bins_sql(source, columns, bins, name="h"):
    """CTEs with the equal-width histogram of stacked columns (own range per column)."""
    return f"""{name}_v AS ({long_sql(source, columns)}),
{name}_r AS (SELECT "column", min(value) - CASE WHEN min(value) = max(value) THEN 0.5 ELSE 0 END AS lo,
  max(value) + CASE WHEN min(value) = max(value) THEN 0.5 ELSE 0 END AS hi FROM {name}_v GROUP BY "column"),
{name}_g AS (SELECT v."column", value, lo, hi, (hi - lo) / {bins}.0::DOUBLE AS step,
  least(floor((value - lo) * {bins}.0::DOUBLE / (hi - lo)), {bins - 1}) AS b
  FROM {name}_v v JOIN {name}_r r ON v."column" = r."column" WHERE value IS NOT NULL),
{name}_b AS (SELECT "column", (CASE WHEN value < lo + b * step THEN b - 1
  WHEN value >= lo + (b + 1) * step AND b < {bins - 1} THEN b + 1 ELSE b END)::INT AS bin, count(*) AS n FROM {name}_g GROUP BY 1, 2),
{name} AS (SELECT r."column", g.bin::INT AS bin, lo + g.bin * ((hi - lo) / {bins}.0::DOUBLE) AS lo,
  lo + (g.bin + 1) * ((hi - lo) / {bins}.0::DOUBLE) AS hi, coalesce(n, 0) AS n
  FROM {name}_r r CROSS JOIN range({bins}) g(bin) LEFT JOIN {name}_b b ON b."column" = r."column" AND b.bin = g.bin)"""


@query(f"WITH {NULLED}, {bins_sql('n', LINE_NUMBERS, 30)} "
       'SELECT "column", bin, round(lo, 5) + 0.0 AS lo, round(hi, 5) + 0.0 AS hi, n FROM h')
def histogram(spark, folder):
    return round_all(profile.histogram(nulled(spark, folder), LINE_NUMBERS, 30), 5)


@query(f"WITH e AS (SELECT ln(1 + value) AS value FROM events), {bins_sql('e', ['value'], 50)} "
       'SELECT "column", bin, round(lo, 5) + 0.0 AS lo, round(hi, 5) + 0.0 AS hi, n FROM h')
def log_histogram(spark, folder):
    return round_all(profile.log_histogram(table(spark, folder, "events"), "value", 50), 5)


@query(" UNION ALL ".join(f"""
SELECT '{c}' AS "column", round(q1, 5) + 0.0 AS q1, round(q2, 5) + 0.0 AS median, round(q3, 5) + 0.0 AS q3,
  round(min({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 5) + 0.0 AS whisker_lo,
  round(max({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 5) + 0.0 AS whisker_hi,
  count(*) FILTER (NOT {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM {t}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM {t})
GROUP BY q1, q2, q3""" for t, c in (("events", "value"), ("lineitem", "l_extendedprice"))))
def boxplot_stats(spark, folder):
    return round_all(profile.box_plot(table(spark, folder, "events"), ["value"]).unionByName(
        profile.box_plot(lineitem(spark, folder), ["l_extendedprice"])), 5)


@query("""
WITH s AS (SELECT count(value) AS n, stddev_samp(value) AS sd, min(value) AS lo, max(value) AS hi FROM events),
w AS (SELECT *, sd * pow(n, -0.2::DOUBLE) AS h FROM s)
SELECT round(lo + g.i * ((hi - lo) / 199), 5) AS x,
  round(sum(exp(-0.5 * pow((lo + g.i * ((hi - lo) / 199) - value) / h, 2))) / (n * h * sqrt(2 * pi())), 8) + 0.0 AS density
FROM events, w, range(200) g(i) GROUP BY g.i, lo, hi, n, h""")
def kde_curve(spark, folder):
    curve = profile.density_curve(table(spark, folder, "events"), "value")
    return curve.select(rounded(F.col("x"), 5).alias("x"), rounded(F.col("density"), 8).alias("density"))


# ---------------------------------------------------------------- correlations

def _pairs_sql(source, columns):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_i, '{b}' AS column_j, corr({b}, {a}) AS r FROM {source}"
        for a, b in itertools.combinations(columns, 2))


@query(f"WITH {NULLED}, c AS ({_pairs_sql('n', LINE_NUMBERS)}) SELECT column_i, column_j, round(r, 6) + 0.0 AS r FROM c")
def corr_matrix(spark, folder):
    return round_all(corr.correlation(nulled(spark, folder), LINE_NUMBERS))


def embeddings(spark, folder):
    whole = F.when(F.size("embedding") == WIDTH, F.col("embedding")).otherwise(   # never a prefix of a longer vector
        F.raise_error(F.lit(f"an embedding is not of length {WIDTH}")).cast("array<float>"))
    return table(spark, folder, "embeddings").withColumn("embedding", whole).select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(WIDTH)])


@query(f"""
WITH p AS (SELECT a.i AS i, b.i AS j FROM range({WIDTH}) a(i), range({WIDTH}) b(i) WHERE a.i < b.i)
SELECT 'e' || i AS column_i, 'e' || j AS column_j,
  round(corr(embedding[(i + 1)::INT]::DOUBLE, embedding[(j + 1)::INT]::DOUBLE), 6) + 0.0 AS r FROM embeddings, p GROUP BY i, j""")
def corr_wide(spark, folder):
    return round_all(corr.correlation(embeddings(spark, folder), [f"e{i}" for i in range(WIDTH)]))


#: Two constants among continuous columns, and gaps that differ from column to column.
GAPPED = {f"g{k}": (f"CASE WHEN l_orderkey % {k + 7} = 0 THEN NULL ELSE {c} * {k + 1} + l_partkey % {k + 2} END::DOUBLE")
          for k, c in enumerate(LINE_NUMBERS * 2)} | {"third": "(2.0::DOUBLE / 3)", "zero": "0.0::DOUBLE"}


def gapped(spark, folder):
    return lineitem(spark, folder).selectExpr(*[
        f"cast({sql.replace('::DOUBLE', '')} as double) AS {c}" if c != "third" else "2.0D / 3 AS third" for c, sql in GAPPED.items()])


GAPPED_SQL = "g AS (SELECT " + ", ".join(f"{sql} AS {c}" for c, sql in GAPPED.items()) + " FROM lineitem)"


def _gapped_pairs(value):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_i, '{b}' AS column_j, CASE WHEN min(x) < max(x) AND min(y) < max(y) THEN round(corr(x, y), 6) + 0.0 END AS r "
        f"FROM (SELECT {value('x')} AS x, {value('y')} AS y FROM (SELECT {a} AS x, {b} AS y FROM g WHERE {a} IS NOT NULL AND {b} IS NOT NULL))"
        for a, b in itertools.combinations(GAPPED, 2))


@query(f"WITH {GAPPED_SQL} {_gapped_pairs(lambda c: c)}")
def corr_with_constants(spark, folder):
    return round_all(corr.correlation(gapped(spark, folder), list(GAPPED)))


@query(f"WITH {GAPPED_SQL} {_gapped_pairs(lambda c: f'rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE')}")
def corr_spearman_gaps(spark, folder):
    return round_all(corr.correlation(gapped(spark, folder), list(GAPPED), "spearman"))


@query("""WITH n AS (SELECT l_quantity, l_discount, l_orderkey FROM lineitem)
SELECT 'q' AS "column", count(*) FILTER (l_orderkey % 5 = 0) AS missing,
  round(100.0::DOUBLE * count(*) FILTER (l_orderkey % 5 = 0) / count(*), 6) + 0.0 AS missing_pct FROM n
UNION ALL SELECT 'd', count(*) FILTER (l_orderkey % 7 = 0), round(100.0::DOUBLE * count(*) FILTER (l_orderkey % 7 = 0) / count(*), 6) + 0.0 FROM n""")
def missing_nan(spark, folder):
    """NaN and infinity in a table that was handed in."""
    rows = lineitem(spark, folder).selectExpr(
        "if(l_orderkey % 5 = 0, double('NaN'), l_quantity) AS q", "if(l_orderkey % 7 = 0, double('Infinity'), l_discount) AS d")
    return round_all(profile.missing_by_column(rows))


def _rank(c):
    return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE"


@query("WITH k AS (SELECT " + ", ".join(f"{_rank(c)} AS {c}" for c in LINE_NUMBERS)
       + f" FROM lineitem), c AS ({_pairs_sql('k', LINE_NUMBERS)}) SELECT column_i, column_j, round(r, 6) + 0.0 AS r FROM c")
def corr_spearman(spark, folder):
    return round_all(corr.correlation(lineitem(spark, folder), LINE_NUMBERS, "spearman"))


@query(f"""WITH {NULLED}, c AS (SELECT l_quantity AS a, l_tax AS b FROM n WHERE l_quantity IS NOT NULL AND l_tax IS NOT NULL),
k AS (SELECT {_rank('a')} AS a, {_rank('b')} AS b FROM c)
SELECT 'l_quantity' AS column_i, 'l_tax' AS column_j, round(corr(a, b), 6) + 0.0 AS r FROM k""")
def corr_spearman_gaps(spark, folder):
    return round_all(corr.correlation(nulled(spark, folder), ["l_quantity", "l_tax"], "spearman"))


@query("""
WITH c AS (SELECT p_size AS x, p_retailprice AS y, count(*)::DOUBLE AS n FROM part GROUP BY 1, 2),
s AS (SELECT sum(a.n * b.n * sign(a.x - b.x) * sign(a.y - b.y)) AS num FROM c a, c b),
t AS (SELECT sum(n) AS n FROM c),
tx AS (SELECT sum(m * m) AS v FROM (SELECT sum(n) AS m FROM c GROUP BY x)),
ty AS (SELECT sum(m * m) AS v FROM (SELECT sum(n) AS m FROM c GROUP BY y))
SELECT 'p_size' AS column_i, 'p_retailprice' AS column_j,
  round(num / (sqrt(t.n * t.n - tx.v) * sqrt(t.n * t.n - ty.v)), 6) + 0.0 AS r FROM s, t, tx, ty""")
def corr_kendall(spark, folder):
    return round_all(corr.correlation(table(spark, folder, "part"), ["p_size", "p_retailprice"], "kendall"))


TARGET = "l_extendedprice"
FEATURES = [c for c in LINE_NUMBERS if c != TARGET]
TARGET_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", corr({c}, {TARGET}) AS r FROM lineitem""" for c in FEATURES)


@query(f"""WITH c AS ({TARGET_SQL}) SELECT "column", round(r, 6) + 0.0 AS r FROM c""")
def corr_target(spark, folder):
    return round_all(corr.target_correlation(lineitem(spark, folder), TARGET, LINE_NUMBERS))


@query(f"""WITH c AS ({TARGET_SQL})
SELECT "column", round(r, 6) + 0.0 AS r, 'top' AS "end" FROM (SELECT * FROM c ORDER BY r DESC, "column" LIMIT 2)
UNION ALL SELECT "column", round(r, 6) + 0.0 AS r, 'bottom' AS "end" FROM (SELECT * FROM c ORDER BY r, "column" LIMIT 2)""")
def corr_target_ends(spark, folder):
    return round_all(corr.top_and_bottom(corr.target_correlation(lineitem(spark, folder), TARGET, LINE_NUMBERS), 2))


LINKED = {"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "l_tax": "l_tax",
          "doubled": "2 * l_quantity + l_tax", "gross": "l_extendedprice * (1 + l_tax)"}
LINKED_SQL = "k AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in LINKED.items()) + " FROM lineitem)"


def _linked(spark, folder):
    return lineitem(spark, folder).select(*[F.expr(e).alias(c) for c, e in LINKED.items()])


@query(f"""WITH {LINKED_SQL}, c AS ({_pairs_sql('k', list(LINKED))})
SELECT column_i, column_j, round(r, 6) + 0.0 AS r FROM c WHERE abs(r) > 0.85 ORDER BY abs(r) DESC LIMIT 10""")
def high_corr_pairs(spark, folder):
    return round_all(corr.high_pairs(corr.correlation(_linked(spark, folder))))


@query(f"""WITH {LINKED_SQL}, c AS ({_pairs_sql('k', list(LINKED))}),
d AS (SELECT DISTINCT column_j FROM c WHERE abs(r) > 0.9)
SELECT name, name IN (SELECT column_j FROM d) AS dropped FROM (VALUES {', '.join(f"('{c}')" for c in LINKED)}) v(name)""")
def drop_high_corr(spark, folder):
    df = _linked(spark, folder)
    dropped = corr.redundant_columns(df, threshold=0.9)
    return small_table(spark, [(c, c in dropped) for c in df.columns], "name string, dropped boolean")


# --------------------------------------------------------------------- scaling

@query("SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem), 5) + 0.0 AS {c}"
    for c in LINE_NUMBERS) + " FROM lineitem")
def zscore(spark, folder):
    df = lineitem(spark, folder).select("l_orderkey", "l_linenumber", *LINE_NUMBERS)
    return round_all(scale.scale_features(df, ["l_orderkey", "l_linenumber"]), 5)


@query("""SELECT p_partkey, round((p_size - lo)::DOUBLE / (hi - lo), 6) AS p_size, round((p_retailprice - a) / (b - a), 6) AS p_retailprice,
  0.0::DOUBLE AS flat FROM part, (SELECT min(p_size) AS lo, max(p_size) AS hi, min(p_retailprice) AS a, max(p_retailprice) AS b FROM part)""")
def minmax(spark, folder):
    df = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice", (F.col("p_size") * 0).alias("flat"))
    return round_all(scale.min_max_features(df, ["p_partkey"]))


@query("SELECT " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem), 5) + 0.0 AS {c}"
    for c in FEATURES) + ", l_extendedprice FROM lineitem")
def scaled_with_target(spark, folder):
    df = lineitem(spark, folder).select("l_linestatus", *LINE_NUMBERS)
    return round_all(scale.scaled_with_target(df, TARGET, ["l_linestatus"]), 5)


@query()
def pca_project(spark, folder):
    return scale.run_pca(embeddings(spark, folder), 0.8, ["vec_id", "label"]).data


# Components of two standardised columns are their scaled sum and difference.
@query("""
WITH s AS (SELECT (p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER () AS a,
  (p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER () AS b, p_partkey FROM part),
r AS (SELECT corr(a, b) AS r FROM s)
SELECT p_partkey, round(abs(CASE WHEN r >= 0 THEN a + b ELSE a - b END) / sqrt(2), 5) + 0.0 AS pc1,
  round(abs(CASE WHEN r >= 0 THEN a - b ELSE a + b END) / sqrt(2), 5) + 0.0 AS pc2, round(ln(1 + p_partkey), 6) AS colour FROM s, r""")
def pca_plane(spark, folder):
    df = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    return scale.plane_projection(df, "p_partkey").select(
        "p_partkey", rounded(F.abs("PC1"), 5).alias("pc1"), rounded(F.abs("PC2"), 5).alias("pc2"),
        rounded(F.col("colour")).alias("colour"))
