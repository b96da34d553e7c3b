"""Keys, types, row-local rules, imputation, calibration and the cleaning job."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.catalog.base import (
    LINE_NUMBERS, REF_CUR, lineitem, query, reference_and_current, round_all, rounded, table)
from plumbline.functions import cells, rows
from plumbline.operators import calibrate as cal
from plumbline.operators import checks, coerce, impute, keys, profile, tables
from plumbline.operators.rules import (
    AbsOf, AnyFlag, Clip, ClipEach, NullNegative, NullOutside, RescueProportion, Simplex, SingleOne, SnapBinary,
    apply_rules, rules_report)
from plumbline.plans.clean import CleanConfig, CleanJob
from plumbline.sources import files

NUMBER = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"
LINE_TIES = ["l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_shipdate", "l_returnflag",
             "l_linestatus"]
LINE_ORDER = ", ".join(f"{c} DESC" for c in ["l_extendedprice", *LINE_TIES])


def _line_rows(df):
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     *[rounded(F.col(c)).alias(c) for c in LINE_NUMBERS],
                     F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"), "l_returnflag", "l_linestatus")


# ------------------------------------------------------------------------ keys

@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity, 6) + 0.0 AS l_quantity,
  round(l_extendedprice, 6) + 0.0 AS l_extendedprice, round(l_discount, 6) + 0.0 AS l_discount,
  round(l_tax, 6) + 0.0 AS l_tax, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_returnflag, l_linestatus
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS r FROM lineitem)
WHERE r = 1""")
def dedup_keep_best(spark, folder):
    return _line_rows(keys.keep_best(lineitem(spark, folder), ["l_orderkey", "l_linenumber"], "l_extendedprice",
                                     LINE_TIES))


@query("""
SELECT doc_key, doc_id FROM (
  SELECT text AS doc_key, doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id DESC) AS r FROM documents)
WHERE r = 1""")
def dedup_keep_last(spark, folder):
    docs = table(spark, folder, "documents").select(F.col("text").alias("doc_key"), "doc_id")
    return keys.keep_best(docs, ["doc_key"], ties=["doc_id"])


@query("""
SELECT page_id, k AS url FROM (SELECT page_id, lower(trim(url)) AS k FROM pages)
WHERE k NOT IN ('', 'nan', 'none', 'null') AND (starts_with(k, 'http://') OR starts_with(k, 'https://'))""")
def url_normalise_filter(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return keys.keep_prefixes(keys.drop_bad_keys(keys.normalise_key(pages, "url"), "url"), "url")


@query("""
SELECT host, page_id, n_html FROM (
  SELECT host, page_id, n_html, row_number() OVER (PARTITION BY host ORDER BY n_html DESC, page_id DESC) AS r
  FROM (SELECT 'http://' || regexp_extract(lower(trim(url)), '^https?://([^/?#]+)', 1) AS host, page_id,
               length(html)::BIGINT AS n_html FROM pages))
WHERE r = 1""")
def url_host_best(spark, folder):
    pages = table(spark, folder, "pages").select(
        F.concat(F.lit("http://"), F.regexp_extract(F.lower(F.trim("url")), "^https?://([^/?#]+)", 1)).alias("host"),
        "page_id", F.length("html").cast("bigint").alias("n_html"))
    return keys.clean_keys(pages, "host", "n_html", ["page_id"])


@query("""
WITH k AS (SELECT CASE WHEN page_id % 11 = 0 THEN ' None ' ELSE regexp_replace(lower(trim(url)), '/[^/]*$', '') END AS k
           FROM pages),
f AS (SELECT lower(trim(k)) AS k FROM k)
SELECT 'bad_tokens' AS rule, count(*) FILTER (k IN ('', 'nan', 'none', 'null')) AS n FROM f
UNION ALL SELECT 'foreign_prefix', count(*) FILTER (k NOT IN ('', 'nan', 'none', 'null')
  AND NOT starts_with(k, 'https://')) FROM f
UNION ALL SELECT 'deduplicated', count(*) FILTER (starts_with(k, 'https://'))
  - count(DISTINCT k) FILTER (starts_with(k, 'https://')) FROM f""")
def url_key_report(spark, folder):
    pages = table(spark, folder, "pages").select(
        F.when(F.col("page_id") % 11 == 0, F.lit(" None "))
        .otherwise(F.regexp_replace(F.lower(F.trim("url")), "/[^/]*$", "")).alias("k"))
    return keys.key_report(pages, "k", prefixes=("https://",))


# ----------------------------------------------------------------------- types

def _part_text(spark, folder):
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("part"),
        F.regexp_replace("p_brand", "Brand#", "").alias("brand_no"), F.col("p_type").alias("kind"),
        F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" ")).alias("size_text"),
        F.when(F.col("p_size") % 7 == 0, F.col("p_type")).when(F.col("p_size") % 7 == 1, F.lit("1.5d"))
        .when(F.col("p_size") % 7 == 2, F.lit("nan"))
        .otherwise(F.concat(F.col("p_size").cast("string"), F.lit("e1"))).alias("mixed"))


PART_TEXT = """p AS (SELECT p_partkey::VARCHAR AS part, replace(p_brand, 'Brand#', '') AS brand_no, p_type AS kind,
  ' ' || p_size::VARCHAR || ' ' AS size_text,
  CASE WHEN p_size % 7 = 0 THEN p_type WHEN p_size % 7 = 1 THEN '1.5d' WHEN p_size % 7 = 2 THEN 'nan'
       ELSE p_size::VARCHAR || 'e1' END AS mixed FROM part)"""
TEXT_COLUMNS = ["brand_no", "kind", "size_text", "mixed"]


def _num(c):
    return f"CASE WHEN regexp_full_match(trim({c}), {NUMBER}) THEN TRY_CAST(trim({c}) AS DOUBLE) END"


@query(f"WITH {PART_TEXT} SELECT part, " + ", ".join(f"{_num(c)} AS {c}" for c in TEXT_COLUMNS) + " FROM p")
def coerce_numeric(spark, folder):
    return coerce.coerce_numeric(_part_text(spark, folder), ["part"])


@query(f"WITH {PART_TEXT} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", 'string' AS before_type, '{'string' if c == 'part' else 'double'}' AS after_type,
    {'0::BIGINT' if c == 'part' else f'count(*) FILTER ({c} IS NOT NULL AND {_num(c)} IS NULL)'} AS coerced,
    {'0.0::DOUBLE' if c == 'part' else
     f'round(100.0::DOUBLE * count(*) FILTER ({c} IS NOT NULL AND {_num(c)} IS NULL) / count(*), 6)'} AS coerced_pct,
    count(*) FILTER ({c} IS NULL) AS missing_before,
    count(*) FILTER ({c if c == 'part' else _num(c)} IS NULL) AS missing_after FROM p""" for c in ["part", *TEXT_COLUMNS]))
def coerce_summary(spark, folder):
    return round_all(coerce.coercion_summary(_part_text(spark, folder), ["part"]))


@query(f"WITH {PART_TEXT} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CASE WHEN count(*) FILTER ({c} IS NOT NULL AND {_num(c)} IS NULL) > 0
    THEN 'string' ELSE 'double' END AS type FROM p""" for c in ["part", *TEXT_COLUMNS]))
def coerce_ignore_types(spark, folder):
    return profile.column_types(coerce.coerce_numeric(_part_text(spark, folder), errors="ignore"))


@query(f"WITH {PART_TEXT} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL OR trim({c}) IN ('', 'nan')) AS missing,
    count({_num(c)}) AS numeric,
    count(*) FILTER ({c} IS NOT NULL AND trim({c}) NOT IN ('', 'nan') AND {_num(c)} IS NULL) AS text,
    count({_num(c)}) > 0 AND count(*) FILTER ({c} IS NOT NULL AND trim({c}) NOT IN ('', 'nan') AND {_num(c)} IS NULL) > 0
      AS mixed FROM p""" for c in ["part", *TEXT_COLUMNS]))
def mixed_types(spark, folder):
    return coerce.mixed_types(_part_text(spark, folder))


@query("""
WITH c AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'NA' WHEN 1 THEN ' nan ' WHEN 2 THEN '' WHEN 3 THEN 'none'
  ELSE c_mktsegment END AS segment FROM customer)
SELECT c_custkey, CASE WHEN trim(segment) NOT IN ('NA', 'nan', '') THEN segment END AS segment FROM c""")
def missing_tokens(spark, folder):
    k = F.col("c_custkey") % 5
    rows_ = table(spark, folder, "customer").select("c_custkey", F.when(k == 0, "NA").when(k == 1, " nan ").when(
        k == 2, "").when(k == 3, "none").otherwise(F.col("c_mktsegment")).alias("segment"))
    return coerce.missing_tokens_to_null(rows_)


# ----------------------------------------------------------------------- rules

@query("""
SELECT 'customer' AS side, c_custkey::BIGINT AS id, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acctbal FROM customer
UNION ALL
SELECT 'supplier', s_suppkey::BIGINT, CASE WHEN s_acctbal >= 0 THEN s_acctbal END FROM supplier""")
def null_negatives(spark, folder):
    rows_ = table(spark, folder, "customer").select(
        F.lit("customer").alias("side"), F.col("c_custkey").cast("bigint").alias("id"), F.col("c_acctbal").alias("acctbal")
    ).unionByName(table(spark, folder, "supplier").select(
        F.lit("supplier").alias("side"), F.col("s_suppkey").cast("bigint").alias("id"), F.col("s_acctbal").alias("acctbal")))
    return apply_rules(rows_, [NullNegative("negative", ("acctbal",))])


RANGE_RULES = [NullOutside("quantity_outside", ("l_quantity",), 2.0, 45.0),
               NullOutside("discount_outside", ("l_discount",), 0.0, 0.08)]
NULLED = """n AS (SELECT l_orderkey, l_linenumber, l_shipdate,
  CASE WHEN l_quantity BETWEEN 2 AND 45 THEN l_quantity END AS l_quantity, l_extendedprice,
  CASE WHEN l_discount BETWEEN 0 AND 0.08::DOUBLE THEN l_discount + 0.0 END AS l_discount, l_tax + 0.0 AS l_tax
  FROM lineitem)"""


def nulled(spark, folder):
    return apply_rules(lineitem(spark, folder), RANGE_RULES).select(
        "l_orderkey", "l_linenumber", "l_shipdate", *LINE_NUMBERS)


@query(f"""WITH {NULLED} SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM n""")
def null_out_of_range(spark, folder):
    return round_all(nulled(spark, folder).drop("l_shipdate"))


DAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]


def _weekday(spark, folder):
    return table(spark, folder, "orders").withColumn("day", F.weekday("o_orderdate"))


def _noisy_flags(spark, folder):
    noise = (F.col("o_orderkey") % 11 - 5).cast("double") * F.lit(0.03)
    return _weekday(spark, folder).select("o_orderkey", *[
        ((F.col("day") == i).cast("double") + noise).alias(d) for i, d in enumerate(DAYS)])


NOISY = "f AS (SELECT o_orderkey, " + ", ".join(
    f"((isodow(o_orderdate) = {i + 1})::INT::DOUBLE + (o_orderkey % 11 - 5)::DOUBLE * 0.03::DOUBLE) AS {d}"
    for i, d in enumerate(DAYS)) + " FROM orders)"


def _snap(c):
    return f"CASE WHEN {c} BETWEEN -0.1::DOUBLE AND 0.1::DOUBLE THEN 0.0 WHEN {c} BETWEEN 0.9::DOUBLE AND 1.1::DOUBLE THEN 1.0 END::DOUBLE"


@query(f"WITH {NOISY} SELECT o_orderkey, " + ", ".join(f"{_snap(d)} AS {d}" for d in DAYS) + " FROM f")
def snap_binaries(spark, folder):
    return apply_rules(_noisy_flags(spark, folder), [SnapBinary("snap", tuple(DAYS))])


def _double_flags(spark, folder):
    return _weekday(spark, folder).select("o_orderkey", *[
        F.when((F.col("o_orderkey") % 13 == 3) & F.lit(i == 2), F.lit(None)).otherwise(
            ((F.col("day") == i) | ((F.col("o_orderkey") + i) % 5 == 0)).cast("double")).alias(d)
        for i, d in enumerate(DAYS)])


DOUBLED = "f AS (SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN {'o_orderkey % 13 = 3' if i == 2 else 'false'} THEN NULL ELSE "
    f"(isodow(o_orderdate) = {i + 1} OR (o_orderkey + {i}) % 5 = 0)::INT::DOUBLE END AS {d}"
    for i, d in enumerate(DAYS)) + " FROM orders)"
SEVERAL = " + ".join(f"coalesce({d}, 0)" for d in DAYS)
FIRST = "CASE " + " ".join(f"WHEN {d} = 1 THEN {i}" for i, d in enumerate(DAYS)) + " END"


@query(f"WITH {DOUBLED} SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN {SEVERAL} > 1 THEN ({FIRST} = {i})::INT::DOUBLE ELSE {d} END AS {d}" for i, d in enumerate(DAYS)) + " FROM f")
def one_hot_repair(spark, folder):
    return apply_rules(_double_flags(spark, folder), [SingleOne("single", tuple(DAYS))])


@query(f"""WITH {NOISY}, s AS (SELECT o_orderkey, {_snap('sat')} AS sat, {_snap('sun')} AS sun FROM f)
SELECT o_orderkey, (coalesce(sat = 1, false) OR coalesce(sun = 1, false))::INT::DOUBLE AS weekend FROM s""")
def derived_flag(spark, folder):
    flags = _noisy_flags(spark, folder).withColumn("weekend", (F.col("o_orderkey") % 2).cast("double"))
    return apply_rules(flags, [SnapBinary("snap", ("sat", "sun")), AnyFlag("weekend", ("weekend", "sat", "sun"))]).select(
        "o_orderkey", "weekend")


WEIGHTS = ("l_quantity", "l_discount", "l_tax")
WEIGHT_SUM = "(coalesce(l_quantity, 0) + coalesce(l_discount, 0) + coalesce(l_tax, 0))"


@query(f"""WITH {NULLED} SELECT l_orderkey, l_linenumber, """ + ", ".join(
    f"round(CASE WHEN {WEIGHT_SUM} > 0 THEN {c} / {WEIGHT_SUM} ELSE {c} END, 6) + 0.0 AS {c}" for c in WEIGHTS) + " FROM n")
def simplex_renorm(spark, folder):
    return round_all(apply_rules(nulled(spark, folder), [Simplex("shares", WEIGHTS)]).select(
        "l_orderkey", "l_linenumber", *WEIGHTS))


PAIR_SUM = "(coalesce(l_discount, 0) + coalesce(l_tax, 0))"


@query(f"""WITH {NULLED} SELECT l_orderkey, l_linenumber, """ + ", ".join(
    f"round(CASE WHEN {PAIR_SUM} > 0 THEN {c} / {PAIR_SUM} ELSE 0.5 END, 6) + 0.0 AS {c}"
    for c in ("l_discount", "l_tax")) + " FROM n")
def simplex_exact(spark, folder):
    rule = Simplex("shares", ("l_discount", "l_tax"), uniform_fallback=True)
    return round_all(apply_rules(nulled(spark, folder), [rule]).select("l_orderkey", "l_linenumber", "l_discount", "l_tax"))


@query(f"""WITH {NULLED}, s AS (SELECT CASE WHEN {PAIR_SUM} > 0 THEN l_discount / {PAIR_SUM} ELSE 0.5 END AS a,
  CASE WHEN {PAIR_SUM} > 0 THEN l_tax / {PAIR_SUM} ELSE 0.5 END AS b FROM n)
SELECT round(avg((coalesce(a, 0) + coalesce(b, 0) BETWEEN 0.9999::DOUBLE AND 1.0001::DOUBLE)::INT), 6) AS ok_ratio FROM s""")
def simplex_ok_ratio(spark, folder):
    rule = Simplex("shares", ("l_discount", "l_tax"), uniform_fallback=True)
    exact = apply_rules(nulled(spark, folder), [rule])
    return exact.agg(rounded(F.avg(rows.total(["l_discount", "l_tax"]).between(0.9999, 1.0001).cast("int"))).alias("ok_ratio"))


@query("""
WITH t AS (SELECT c_custkey, c_acctbal AS b, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN c_acctbal
           ELSE abs(c_acctbal) END AS a FROM customer)
SELECT c_custkey, CASE WHEN b IS NOT NULL AND (a IS NULL OR NOT abs(a - abs(b)) <= 1e-8 + 1e-5 * abs(abs(b)))
  THEN abs(b) ELSE a END AS abs_balance FROM t""")
def dependent_abs(spark, folder):
    k = F.col("c_custkey") % 3
    rows_ = table(spark, folder, "customer").select("c_custkey", "c_acctbal", F.when(k == 1, F.col("c_acctbal")).when(
        k == 2, F.abs("c_acctbal")).alias("abs_balance"))
    return apply_rules(rows_, [AbsOf("abs", ("abs_balance", "c_acctbal"))]).select("c_custkey", "abs_balance")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE greatest(0.0, least(5000.0, c_acctbal)) END::DOUBLE
  AS acctbal FROM customer""")
def clip_range(spark, folder):
    rows_ = table(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("acctbal"))
    return apply_rules(rows_, [Clip("clip", ("acctbal",), 0.0, 5000.0)])


RESCUED = """CASE WHEN {c} IS NULL THEN NULL ELSE greatest(0, least(1,
  CASE WHEN (CASE WHEN {c} > 1 AND {c} <= 1000 THEN {c} / 1000 ELSE {c} END) > 1
       THEN {c} / 10 ELSE (CASE WHEN {c} > 1 AND {c} <= 1000 THEN {c} / 1000 ELSE {c} END) END)) END"""


@query("WITH p AS (SELECT p_partkey, (p_size - 5)::DOUBLE / 10 AS small, p_retailprice AS large FROM part) SELECT p_partkey, "
       + ", ".join(f"round({RESCUED.format(c=c)}, 6) + 0.0 AS {c}" for c in ("small", "large")) + " FROM p")
def scale_rescue(spark, folder):
    rows_ = table(spark, folder, "part").select(
        "p_partkey", ((F.col("p_size") - 5).cast("double") / 10).alias("small"), F.col("p_retailprice").alias("large"))
    return round_all(apply_rules(rows_, [RescueProportion("rescue", ("small", "large"))]))


ENFORCE = [*RANGE_RULES, NullNegative("negative", ("l_tax",)), Simplex("shares", ("l_discount", "l_tax"))]
_D, _T = "l_discount", "l_tax"


@query(f"""WITH {NULLED}, s AS (SELECT *, CASE WHEN {PAIR_SUM} > 0 THEN l_discount / {PAIR_SUM} ELSE l_discount END AS d2,
  CASE WHEN {PAIR_SUM} > 0 THEN l_tax / {PAIR_SUM} ELSE l_tax END AS t2 FROM n),
o AS (SELECT count(*) FILTER (NOT (l_quantity BETWEEN 2 AND 45)) AS q,
             count(*) FILTER (NOT (l_discount BETWEEN 0 AND 0.08::DOUBLE)) AS d, count(*) FILTER (l_tax < 0) AS t
      FROM lineitem)
SELECT 'enforcement' AS stage, 'quantity_outside' AS rule, 'l_quantity' AS "column", q AS nulled, 0::BIGINT AS changed,
  0::BIGINT AS filled FROM o
UNION ALL SELECT 'enforcement', 'discount_outside', 'l_discount', d, 0, 0 FROM o
UNION ALL SELECT 'enforcement', 'negative', 'l_tax', t, 0, 0 FROM o
UNION ALL SELECT 'enforcement', 'shares', 'l_discount', 0, count(*) FILTER (abs(d2 - l_discount) > 1e-9), 0 FROM s
UNION ALL SELECT 'enforcement', 'shares', 'l_tax', 0, count(*) FILTER (abs(t2 - l_tax) > 1e-9), 0 FROM s""")
def enforce_report(spark, folder):
    return rules_report(lineitem(spark, folder), ENFORCE, "enforcement")


@query(f"""WITH {NULLED} SELECT l_orderkey, l_linenumber, l_quantity,
  round(CASE WHEN {PAIR_SUM} > 0 THEN l_discount / {PAIR_SUM} ELSE l_discount END, 6) + 0.0 AS l_discount,
  round(CASE WHEN {PAIR_SUM} > 0 THEN l_tax / {PAIR_SUM} ELSE l_tax END, 6) + 0.0 AS l_tax FROM n""")
def enforce_rules(spark, folder):
    return round_all(apply_rules(lineitem(spark, folder), ENFORCE).select("l_orderkey", "l_linenumber", *WEIGHTS))


@query(f"""WITH {NULLED} SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM n
WHERE ((l_quantity IS NULL)::INT + (l_discount IS NULL)::INT + (l_tax IS NULL)::INT) * 100.0 <= 40.0 * 3""")
def drop_sparse_rows(spark, folder):
    kept = profile.drop_sparse_rows(nulled(spark, folder), 40.0, list(WEIGHTS))
    return round_all(kept.select("l_orderkey", "l_linenumber", *WEIGHTS))


@query(f"""WITH {NULLED} SELECT l_orderkey, round(l_quantity, 6) AS l_quantity, l_extendedprice, l_discount, l_tax,
  round(ln(1 + l_extendedprice), 6) AS log_price, round(exp(ln(1 + l_extendedprice)) - 1, 4) AS price_back FROM n
WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL AND l_tax IS NOT NULL AND l_extendedprice IS NOT NULL""")
def model_rows(spark, folder):
    kept = tables.model_rows(nulled(spark, folder).drop("l_linenumber", "l_shipdate"), "l_extendedprice", ["l_orderkey"])
    log = cells.target_forward(F.col("l_extendedprice"), "log1p")
    return round_all(kept.withColumns({
        "log_price": log, "price_back": rounded(cells.target_inverse(log, "log1p"), 4)}))


@query("SELECT o_orderkey, o_custkey FROM orders")
def select_numeric(spark, folder):
    orders = tables.drop_columns(table(spark, folder, "orders"), ["o_totalprice", "not_there"])
    return tables.select_features(orders, tables.numeric_columns(orders))


@query("""SELECT c_custkey, c_name FROM customer
ORDER BY md5('7|' || c_custkey::VARCHAR), c_custkey LIMIT 50""")
def sample_rows(spark, folder):
    return tables.sample_rows(table(spark, folder, "customer").select("c_custkey", "c_name"), "c_custkey", 50, seed=7)


# ------------------------------------------------------------------ imputation

def _gaps(spark, folder):
    gap = F.col("l_orderkey") % 9
    return nulled(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice",
        F.when(gap != 4, (F.col("l_linenumber") % 2).cast("double")).alias("odd"),
        F.when(gap != 5, (F.col("l_linenumber") > 5).cast("double")).alias("late"),
        F.when(gap != 6, (F.col("l_linenumber") % 2 == 0).cast("double")).alias("either"))


GAPS = f"""{NULLED}, g AS (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, l_extendedprice,
  CASE WHEN l_orderkey % 9 <> 4 THEN (l_linenumber % 2)::DOUBLE END AS odd,
  CASE WHEN l_orderkey % 9 <> 5 THEN (l_linenumber > 5)::INT::DOUBLE END AS late,
  CASE WHEN l_orderkey % 9 <> 6 THEN (l_linenumber % 2 = 0)::INT::DOUBLE END AS either FROM n)"""


def _mode(c):
    return f"(SELECT {c} FROM g WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


def _median(c):
    return f"(SELECT quantile_cont({c}, 0.5) FROM g)"


@query(f"""WITH {GAPS} SELECT l_orderkey, l_linenumber, coalesce(l_quantity, {_median('l_quantity')}) AS l_quantity,
  round(coalesce(l_discount, {_median('l_discount')}), 6) + 0.0 AS l_discount FROM g""")
def median_impute(spark, folder):
    df = _gaps(spark, folder)
    rule = impute.fit_median(df, ["l_quantity", "l_discount"])
    return round_all(apply_rules(df, [rule]).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"))


@query(f"""WITH {GAPS} SELECT l_orderkey, l_linenumber, coalesce(odd, {_mode('odd')}) AS odd,
  coalesce(late, {_mode('late')}) AS late FROM g""")
def mode_impute(spark, folder):
    df = _gaps(spark, folder)
    return apply_rules(df, [impute.fit_mode(df, ["odd", "late"])]).select("l_orderkey", "l_linenumber", "odd", "late")


@query(f"""WITH {GAPS} SELECT l_orderkey, l_linenumber,
  greatest(5.0, least(30.0, coalesce(l_quantity, {_median('l_quantity')})))::DOUBLE AS l_quantity FROM g""")
def bounded_impute(spark, folder):
    df = _gaps(spark, folder)
    rules = impute.fit_imputation(df, impute.ImputePolicy(bounded=((5.0, 30.0, ("l_quantity",)),)))
    return apply_rules(df, rules).select("l_orderkey", "l_linenumber", "l_quantity")


FILLED = f"""{GAPS}, m AS (SELECT *, coalesce(l_discount, {_median('l_discount')}) AS d,
  coalesce(l_tax, {_median('l_tax')}) AS t FROM g)"""


@query(f"""WITH {FILLED} SELECT l_orderkey, l_linenumber,
  round(CASE WHEN d + t > 0 THEN d / (d + t) ELSE d END, 6) + 0.0 AS l_discount,
  round(CASE WHEN d + t > 0 THEN t / (d + t) ELSE t END, 6) + 0.0 AS l_tax FROM m""")
def simplex_impute(spark, folder):
    df = _gaps(spark, folder)
    rules = impute.fit_imputation(df, impute.ImputePolicy(simplex=("l_discount", "l_tax")))
    return round_all(apply_rules(df, rules).select("l_orderkey", "l_linenumber", "l_discount", "l_tax"))


POLICY = impute.ImputePolicy(
    median=("l_extendedprice",), mode=("odd", "late"), flags=(("either", "odd", "late"),),
    simplex=("l_discount", "l_tax"), bounded=((5.0, 30.0, ("l_quantity",)),))
ALL_FILLED = f"""{FILLED}, a AS (SELECT *, coalesce(odd, {_mode('odd')}) AS o2, coalesce(late, {_mode('late')}) AS l2,
  coalesce(l_quantity, {_median('l_quantity')}) AS q2,
  CASE WHEN d + t > 0 THEN d / (d + t) ELSE d END AS d2, CASE WHEN d + t > 0 THEN t / (d + t) ELSE t END AS t2 FROM m)"""


@query(f"""WITH {ALL_FILLED} SELECT l_orderkey, l_linenumber, o2 AS odd, l2 AS late,
  (o2 = 1 OR l2 = 1)::INT::DOUBLE AS either, greatest(5.0, least(30.0, q2))::DOUBLE AS l_quantity,
  round(d2, 6) + 0.0 AS l_discount, round(t2, 6) + 0.0 AS l_tax FROM a""")
def impute_families(spark, folder):
    filled, _ = impute.impute(_gaps(spark, folder), POLICY)
    return round_all(filled.select("l_orderkey", "l_linenumber", "odd", "late", "either", "l_quantity", "l_discount", "l_tax"))


@query(f"""WITH {ALL_FILLED}
SELECT 'imputation' AS stage, 'continuous_median' AS rule, 'l_extendedprice' AS "column", 0::BIGINT AS nulled,
  0::BIGINT AS changed, count(*) FILTER (l_extendedprice IS NULL) AS filled FROM a
UNION ALL SELECT 'imputation', 'binary_mode', 'odd', 0, 0, count(*) FILTER (odd IS NULL) FROM a
UNION ALL SELECT 'imputation', 'binary_mode', 'late', 0, 0, count(*) FILTER (late IS NULL) FROM a
UNION ALL SELECT 'imputation', 'flag_realigned', 'either', 0,
  count(*) FILTER (either <> (o2 = 1 OR l2 = 1)::INT), count(*) FILTER (either IS NULL) FROM a
UNION ALL SELECT 'imputation', 'simplex_median', 'l_discount', 0, 0, count(*) FILTER (l_discount IS NULL) FROM a
UNION ALL SELECT 'imputation', 'simplex_median', 'l_tax', 0, 0, count(*) FILTER (l_tax IS NULL) FROM a
UNION ALL SELECT 'imputation', 'simplex_renormalised', 'l_discount', 0, count(*) FILTER (abs(d2 - d) > 1e-9), 0 FROM a
UNION ALL SELECT 'imputation', 'simplex_renormalised', 'l_tax', 0, count(*) FILTER (abs(t2 - t) > 1e-9), 0 FROM a
UNION ALL SELECT 'imputation', 'bounded_median', 'l_quantity', 0, 0, count(*) FILTER (l_quantity IS NULL) FROM a
UNION ALL SELECT 'imputation', 'bounded_clip', 'l_quantity', 0, count(*) FILTER (q2 < 5 OR q2 > 30), 0 FROM a""")
def impute_report(spark, folder):
    return impute.impute(_gaps(spark, folder), POLICY)[1]


# ----------------------------------------------------------------- calibration

ZCLIP = "greatest(m - {k} * s, least(m + {k} * s, {c}))"


def _z_stats(name, source, c):
    return f"{name} AS (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM {source})"


@query(f"""WITH {REF_CUR}, {_z_stats('z', 'ref', 'l_extendedprice')}
SELECT l_orderkey, l_linenumber, round({ZCLIP.format(k=1, c='l_extendedprice')}, 4) AS l_extendedprice FROM cur, z""")
def zclip_reference(spark, folder):
    ref, cur = reference_and_current(spark, folder)
    rule = ClipEach("z", ("l_extendedprice",), cal.z_bounds(ref, ["l_extendedprice"], 1.0))
    return apply_rules(cur, [rule]).select("l_orderkey", "l_linenumber",
                                           rounded(F.col("l_extendedprice"), 4).alias("l_extendedprice"))


@query(f"""WITH {REF_CUR}, r AS (SELECT quantile_cont(1.0 + 0 * l_quantity, 0.01) AS lo FROM ref)
SELECT l_orderkey, l_linenumber, greatest(lo, least(lo, l_quantity))::DOUBLE AS l_quantity FROM cur, r""")
def zclip_constant_reference(spark, folder):
    ref, cur = reference_and_current(spark, folder)
    flat = ref.select((F.lit(1.0) + 0 * F.col("l_quantity")).alias("l_quantity"))
    rule = ClipEach("z", ("l_quantity",), cal.z_bounds(flat, ["l_quantity"], 3.0))
    return apply_rules(cur, [rule]).select("l_orderkey", "l_linenumber", "l_quantity")


@query("""SELECT l_orderkey, l_linenumber, greatest(0.0, least(1.0, l_quantity / 40)) AS share FROM lineitem""")
def proportion_clip(spark, folder):
    df = lineitem(spark, folder).select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 40).alias("share"))
    return apply_rules(df, [Clip("share", ("share",), 0.0, 1.0)])


@query("""WITH b AS (SELECT quantile_cont(l_extendedprice, 0.01) AS lo, quantile_cont(l_extendedprice, 0.99) AS hi FROM lineitem)
SELECT l_orderkey, l_linenumber, round(greatest(lo, least(hi, l_extendedprice)), 4) AS l_extendedprice FROM lineitem, b""")
def winsorise(spark, folder):
    out = cal.winsorised(lineitem(spark, folder), ["l_extendedprice"])
    return out.select("l_orderkey", "l_linenumber", rounded(F.col("l_extendedprice"), 4).alias("l_extendedprice"))


SANE = f"""{REF_CUR}, d AS (SELECT CASE WHEN l_quantity <= 48 THEN l_quantity END AS q,
  greatest(0.0, least(0.07::DOUBLE, l_discount)) AS disc, l_extendedprice AS p FROM ref),
b AS (SELECT quantile_cont(p, 0.01) AS lo, quantile_cont(p, 0.99) AS hi FROM d),
sane AS (SELECT q, disc, greatest(lo, least(hi, p)) AS p FROM d, b)"""


def _sane(ref):
    return cal.sanitised_reference(ref, [(0.0, 0.07, ("l_discount",))], ["l_extendedprice"], [("l_quantity", 48.0)])


@query(f"""WITH {SANE} SELECT count(q) AS n_quantity, round(avg(q), 6) AS mean_quantity, round(avg(disc), 6) AS mean_discount,
  round(avg(p), 3) AS mean_price, round(stddev_samp(p), 3) AS sd_price FROM sane""")
def sanitised_reference(spark, folder):
    ref, _ = reference_and_current(spark, folder)
    return _sane(ref).agg(
        F.count("l_quantity").alias("n_quantity"), rounded(F.avg("l_quantity")).alias("mean_quantity"),
        rounded(F.avg("l_discount")).alias("mean_discount"), rounded(F.avg("l_extendedprice"), 3).alias("mean_price"),
        rounded(F.stddev_samp("l_extendedprice"), 3).alias("sd_price"))


CALIBRATION = cal.CalibrationConfig(
    zclip=(("zclip_counts", ("l_quantity",), 1.0), ("zclip_target", ("l_extendedprice",), 1.5)),
    clips=(("share_clipped", 0.0, 0.05, ("l_discount",)),), simplex=("l_discount", "l_tax"))
CALIBRATED = f"""{REF_CUR}, zq AS (SELECT avg(l_quantity) AS m, stddev_samp(l_quantity) AS s FROM ref),
zp AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM ref),
k AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  greatest(zq.m - zq.s, least(zq.m + zq.s, l_quantity)) AS q,
  greatest(zp.m - 1.5 * zp.s, least(zp.m + 1.5 * zp.s, l_extendedprice)) AS p,
  greatest(0.0, least(0.05::DOUBLE, l_discount)) AS d FROM cur, zq, zp),
c AS (SELECT *, CASE WHEN d + l_tax > 0 THEN d / (d + l_tax) ELSE d END AS d2,
  CASE WHEN d + l_tax > 0 THEN l_tax / (d + l_tax) ELSE l_tax END AS t2 FROM k)"""


@query(f"""WITH {CALIBRATED} SELECT l_orderkey, l_linenumber, round(q, 5) AS l_quantity, round(p, 3) AS l_extendedprice,
  round(d2, 6) + 0.0 AS l_discount, round(t2, 6) + 0.0 AS l_tax FROM c""")
def calibrate(spark, folder):
    ref, cur = reference_and_current(spark, folder)
    out, _ = cal.calibrate_to_reference(cur, ref, CALIBRATION)
    return out.select("l_orderkey", "l_linenumber", rounded(F.col("l_quantity"), 5).alias("l_quantity"),
                      rounded(F.col("l_extendedprice"), 3).alias("l_extendedprice"),
                      rounded(F.col("l_discount")).alias("l_discount"), rounded(F.col("l_tax")).alias("l_tax"))


@query(f"""WITH {CALIBRATED}
SELECT 'calibration' AS stage, 'zclip_counts' AS rule, 'l_quantity' AS "column", 0::BIGINT AS nulled,
  count(*) FILTER (abs(q - l_quantity) > 1e-9) AS changed, 0::BIGINT AS filled FROM c
UNION ALL SELECT 'calibration', 'zclip_target', 'l_extendedprice', 0, count(*) FILTER (abs(p - l_extendedprice) > 1e-9), 0 FROM c
UNION ALL SELECT 'calibration', 'share_clipped', 'l_discount', 0, count(*) FILTER (abs(d - l_discount) > 1e-9), 0 FROM c
UNION ALL SELECT 'calibration', 'simplex_renormalised', 'l_discount', 0, count(*) FILTER (abs(d2 - d) > 1e-9), 0 FROM c
UNION ALL SELECT 'calibration', 'simplex_renormalised', 'l_tax', 0, count(*) FILTER (abs(t2 - l_tax) > 1e-9), 0 FROM c""")
def calibrate_report(spark, folder):
    ref, cur = reference_and_current(spark, folder)
    return cal.calibrate_to_reference(cur, ref, CALIBRATION)[1]


FINAL = cal.CalibrationConfig(zclip=(("zclip_target", ("l_extendedprice",), 1.2),), rescue=("share",),
                              clips=(("share_clipped", 0.0, 0.9, ("share",)),), rescue_first=True)


@query(f"""WITH {SANE}, z AS (SELECT avg(p) AS m, stddev_samp(p) AS s FROM sane),
w AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity / 30 * CASE WHEN l_orderkey % 4 = 0 THEN 100 ELSE 1 END AS share
  FROM cur)
SELECT l_orderkey, l_linenumber, round(greatest(m - 1.2 * s, least(m + 1.2 * s, l_extendedprice)), 3) AS l_extendedprice,
  round(least(0.9, {RESCUED.format(c='share')}), 6) + 0.0 AS share FROM w, z""")
def calibrate_final(spark, folder):
    ref, cur = reference_and_current(spark, folder)
    scale = F.when(F.col("l_orderkey") % 4 == 0, 100).otherwise(1)
    shares = cur.select("l_orderkey", "l_linenumber", "l_extendedprice", (F.col("l_quantity") / 30 * scale).alias("share"))
    out = apply_rules(shares, cal.fit_calibration(_sane(ref), FINAL))
    return out.select("l_orderkey", "l_linenumber", rounded(F.col("l_extendedprice"), 3).alias("l_extendedprice"),
                      rounded(F.col("share")).alias("share"))


# ---------------------------------------------------------------- cleaning job

JOB = CleanJob(CleanConfig(
    keys=("l_orderkey", "l_linenumber"), score="l_extendedprice", ties=tuple(LINE_TIES), url_key=False,
    keep_text=("l_returnflag", "l_linestatus", "l_shipdate"), enforcement=lambda columns: RANGE_RULES,
    imputation=lambda columns: impute.ImputePolicy(median=("l_quantity",), bounded=((0.0, 0.08, ("l_discount",)),)),
    calibration=CALIBRATION))
CLEANED = f"""b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER})
  AS r FROM lineitem) WHERE r = 1),
rawref AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
e AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_tax, CASE WHEN l_quantity BETWEEN 2 AND 45 THEN l_quantity END AS q,
  CASE WHEN l_discount BETWEEN 0 AND 0.08::DOUBLE THEN l_discount END AS d FROM b),
f AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_tax, coalesce(q, (SELECT quantile_cont(q, 0.5) FROM e)) AS q,
  coalesce(d, (SELECT quantile_cont(d, 0.5) FROM e)) AS d FROM e),
zq AS (SELECT avg(l_quantity) AS m, stddev_samp(l_quantity) AS s FROM rawref),
zp AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM rawref),
k AS (SELECT l_orderkey, l_linenumber, greatest(zq.m - zq.s, least(zq.m + zq.s, q)) AS q,
  greatest(zp.m - 1.5 * zp.s, least(zp.m + 1.5 * zp.s, l_extendedprice)) AS p,
  greatest(0.0, least(0.05::DOUBLE, d)) AS d, l_tax AS t FROM f, zq, zp)"""


@query(f"""WITH {CLEANED} SELECT l_orderkey, l_linenumber, round(q, 5) AS l_quantity, round(p, 3) AS l_extendedprice,
  round(CASE WHEN d + t > 0 THEN d / (d + t) ELSE d END, 6) + 0.0 AS l_discount,
  round(CASE WHEN d + t > 0 THEN t / (d + t) ELSE t END, 6) + 0.0 AS l_tax FROM k""")
def clean_table(spark, folder):
    ref, _ = reference_and_current(spark, folder)
    clean = JOB.run(lineitem(spark, folder), ref).table
    return clean.select("l_orderkey", "l_linenumber", rounded(F.col("l_quantity"), 5).alias("l_quantity"),
                        rounded(F.col("l_extendedprice"), 3).alias("l_extendedprice"),
                        rounded(F.col("l_discount")).alias("l_discount"), rounded(F.col("l_tax")).alias("l_tax"))


# Every counter of the job, by rule, change and column; those that nothing touches are zero.
_TOUCHED = [("enforcement", "quantity_outside", ["l_quantity"]), ("enforcement", "discount_outside", ["l_discount"]),
            ("imputation", "continuous_median", ["l_quantity"]), ("imputation", "bounded_median", ["l_discount"]),
            ("imputation", "bounded_clip", ["l_discount"]), ("calibration", "zclip_counts", ["l_quantity"]),
            ("calibration", "zclip_target", ["l_extendedprice"]), ("calibration", "share_clipped", ["l_discount"]),
            ("calibration", "simplex_renormalised", ["l_discount", "l_tax"])]
COUNTERS = ", ".join(f"('{stage}', '{rule}:{change}', '{c}')" for stage, rule, columns in _TOUCHED for c in columns
                     for change in ("nulled", "changed", "filled"))
AUDIT = f"""WITH {CLEANED}, a AS (
SELECT 'keys' AS stage, 'deduplicated' AS rule, '*' AS "column",
  (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM b) AS n
UNION ALL SELECT 'enforcement', 'quantity_outside:nulled', 'l_quantity', count(*) FILTER (q IS NULL) FROM e
UNION ALL SELECT 'enforcement', 'discount_outside:nulled', 'l_discount', count(*) FILTER (d IS NULL) FROM e
UNION ALL SELECT 'imputation', 'continuous_median:filled', 'l_quantity', count(*) FILTER (q IS NULL) FROM e
UNION ALL SELECT 'imputation', 'bounded_median:filled', 'l_discount', count(*) FILTER (d IS NULL) FROM e
UNION ALL SELECT 'calibration', 'zclip_counts:changed', 'l_quantity', count(*) FILTER (f.q < m - s OR f.q > m + s) FROM f, zq
UNION ALL SELECT 'calibration', 'zclip_target:changed', 'l_extendedprice',
  count(*) FILTER (l_extendedprice < m - 1.5 * s OR l_extendedprice > m + 1.5 * s) FROM f, zp
UNION ALL SELECT 'calibration', 'share_clipped:changed', 'l_discount', count(*) FILTER (d > 0.05::DOUBLE) FROM f
UNION ALL SELECT 'calibration', 'simplex_renormalised:changed', 'l_discount',
  count(*) FILTER (d + t > 0 AND abs(d / (d + t) - d) > 1e-9) FROM k
UNION ALL SELECT 'calibration', 'simplex_renormalised:changed', 'l_tax',
  count(*) FILTER (d + t > 0 AND abs(t / (d + t) - t) > 1e-9) FROM k)
SELECT stage, rule, "column", n FROM a
UNION ALL SELECT s, r, c, 0 FROM (VALUES {COUNTERS}) AS z (s, r, c) WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.stage = s AND a.rule = r AND a."column" = c)
UNION ALL SELECT 'coercion', 'coerced', column_name, 0 FROM (DESCRIBE lineitem)"""


@query(AUDIT)
def clean_audit(spark, folder):
    ref, _ = reference_and_current(spark, folder)
    return JOB.run(lineitem(spark, folder), ref).audit


@query(AUDIT)
def clean_audit_on_write(spark, folder):
    """The audit as it lies beside the written table: the rules' counters are observed by the tasks that write."""
    from plumbline.catalog.storage import scratch

    ref, _ = reference_and_current(spark, folder)
    path = scratch(spark)
    JOB.run(lineitem(spark, folder), ref).write(f"{path}/lines.parquet")
    return files.read_table(spark, f"{path}/lines.audit.json").select("stage", "rule", "column", "n")


# ---------------------------------------------------------------------- checks

def line_checks():
    return (checks.negatives("negative", ["l_tax"]) + checks.outside("outside", ["l_quantity"], 2.0, 45.0)
            + checks.outside("outside", ["l_discount"], 0.0, 0.08)
            + checks.row_sum_off("sum_off", ["l_discount", "l_tax"], 0.01, 0.12))


@query("""
SELECT 'negative' AS rule, 'l_tax' AS "column", count(*) FILTER (l_tax < 0) AS n FROM lineitem
UNION ALL SELECT 'outside', 'l_quantity', count(*) FILTER (NOT l_quantity BETWEEN 2 AND 45) FROM lineitem
UNION ALL SELECT 'outside', 'l_discount', count(*) FILTER (NOT l_discount BETWEEN 0 AND 0.08::DOUBLE) FROM lineitem
UNION ALL SELECT 'sum_off', '*', count(*) FILTER (NOT l_discount + l_tax BETWEEN 0.01::DOUBLE AND 0.12::DOUBLE) FROM lineitem""")
def rule_violations(spark, folder):
    return checks.rule_violations(lineitem(spark, folder), line_checks())


def flag_checks():
    return (checks.not_binary("not_binary", DAYS) + checks.not_exactly_one("exactly_one", DAYS)
            + checks.more_than_one("at_most_one", DAYS) + checks.flag_mismatch("weekend", "weekend", ["sat", "sun"]))


@query(f"""WITH {NOISY}, w AS (SELECT *, (o_orderkey % 2)::DOUBLE AS weekend FROM f) """ + " UNION ALL ".join(
    f"""SELECT 'not_binary' AS rule, '{d}' AS "column", count(*) FILTER ({d} NOT IN (0, 1)) AS n FROM w""" for d in DAYS) + f"""
UNION ALL SELECT 'exactly_one', '*', count(*) FILTER ({SEVERAL} <> 1) FROM w
UNION ALL SELECT 'at_most_one', '*', count(*) FILTER ({SEVERAL} > 1) FROM w
UNION ALL SELECT 'weekend', 'weekend', count(*) FILTER (weekend <> (sat = 1 OR sun = 1)::INT) FROM w""")
def flag_violations(spark, folder):
    df = _noisy_flags(spark, folder).withColumn("weekend", (F.col("o_orderkey") % 2).cast("double"))
    return checks.rule_violations(df, flag_checks())


@query("""
WITH t AS (SELECT c_custkey, c_acctbal AS b, CASE c_custkey % 3 WHEN 0 THEN NULL ELSE c_acctbal END AS a FROM customer)
SELECT 'abs' AS rule, 'a' AS "column", count(*) FILTER (NOT abs(a - abs(b)) <= 1e-8 + 1e-5 * abs(abs(b))) AS n FROM t""")
def abs_violations(spark, folder):
    df = table(spark, folder, "customer").select(
        F.col("c_acctbal").alias("b"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")).alias("a"))
    return checks.rule_violations(df, checks.abs_mismatch("abs", "a", "b"))


@query(f"""WITH {NULLED}
SELECT 'outside' AS rule, 'l_quantity' AS "column", count(*) FILTER (NOT l_quantity BETWEEN 2 AND 45) AS n FROM n
UNION ALL SELECT 'outside', 'l_discount', count(*) FILTER (NOT l_discount BETWEEN 0 AND 0.08::DOUBLE) FROM n""")
def residual_violations(spark, folder):
    return checks.rule_violations(nulled(spark, folder), line_checks()[1:3])


@query(f"""WITH {NULLED}
SELECT 'negative' AS rule, 'l_tax' AS "column", bool_and(coalesce(l_tax >= 0, false)) AS passed FROM n
UNION ALL SELECT 'outside', 'l_quantity', bool_and(coalesce(l_quantity BETWEEN 2 AND 45, false)) FROM n
UNION ALL SELECT 'outside', 'l_discount', bool_and(coalesce(l_discount BETWEEN 0 AND 0.08::DOUBLE, false)) FROM n
UNION ALL SELECT 'sum_off', '*', bool_and(coalesce(l_discount, 0) + coalesce(l_tax, 0) BETWEEN 0.01::DOUBLE AND 0.12::DOUBLE) FROM n""")
def constraint_checks(spark, folder):
    return checks.constraint_checks(nulled(spark, folder), line_checks())
