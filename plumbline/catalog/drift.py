"""Drift between the reference period and the current one."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from plumbline.catalog.base import LINE_NUMBERS, REF_CUR, long_sql, query, reference_and_current, round_all, rounded, table
from plumbline.catalog.profiling import bins_sql
from plumbline.operators import drift, profile

STAT_SQL = {"mean": "avg({c})", "sd": "stddev_samp({c})", "min": "min({c})", "p50": "quantile_cont({c}, 0.5)",
            "p95": "quantile_cont({c}, 0.95)", "max": "max({c})"}


@query(f"WITH {REF_CUR} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", """ + ", ".join(
        f"(SELECT round({e.format(c=c)}, 4) + 0.0 FROM {side}) AS {side}_{s}" for s, e in STAT_SQL.items()
        for side in ("ref", "cur")) for c in LINE_NUMBERS))
def compare_stats(spark, folder):
    return round_all(drift.compare_stats(*reference_and_current(spark, folder), LINE_NUMBERS), 4)


KS = f"""{REF_CUR}, v AS (SELECT *, 1 AS r, 0 AS c FROM ({long_sql('ref', LINE_NUMBERS)})
  UNION ALL SELECT *, 0, 1 FROM ({long_sql('cur', LINE_NUMBERS)})),
d AS (SELECT "column", value, sum(r) AS r, sum(c) AS c FROM v GROUP BY 1, 2),
u AS (SELECT "column", sum(r) OVER w AS rr, sum(c) OVER w AS cc, sum(r) OVER (PARTITION BY "column") AS nr,
  sum(c) OVER (PARTITION BY "column") AS nc FROM d WINDOW w AS (PARTITION BY "column" ORDER BY value)),
k AS (SELECT "column", nr::DOUBLE AS nr, nc::DOUBLE AS nc, max(abs(rr::DOUBLE / nr - cc::DOUBLE / nc)) AS ks FROM u GROUP BY 1, 2, 3),
l AS (SELECT "column", ks, ks * sqrt(nr * nc / (nr + nc)) AS lam FROM k),
p AS (SELECT "column", ks, CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, (SELECT sum(
  CASE WHEN i % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0::DOUBLE * i * i * lam * lam)) FROM range(1, 101) t(i)))) END::DOUBLE AS p FROM l)"""


@query(f"""WITH {KS} SELECT "column", round(ks, 6) AS ks, round(p, 6) + 0.0 AS ks_p_asymptotic FROM p""")
def ks_drift(spark, folder):
    return round_all(drift.ks_statistic(*reference_and_current(spark, folder), LINE_NUMBERS))


# Every order of the pooled sample, as a mask of the places of the first side; the share of orders with at least the gap found.
@query("""WITH g AS (SELECT s_nationkey AS side, s_acctbal AS x FROM supplier WHERE s_nationkey IN (3, 4)),
z AS (SELECT count(*) FILTER (side = 3) AS n, count(*) FILTER (side = 4) AS m FROM g),
u AS (SELECT x, sum((side = 3)::INT) OVER w AS r, sum((side = 4)::INT) OVER w AS c FROM g WINDOW w AS (ORDER BY x)),
k AS (SELECT n, m, max(abs(r * m - c * n)) AS far FROM u, z GROUP BY n, m),
masks AS (SELECT mask, n, m, far FROM k, range(0, (1::BIGINT << (n + m))) t(mask) WHERE bit_count(mask) = n),
steps AS (SELECT mask, far, max(abs(bit_count(mask & ((1::BIGINT << i) - 1)) * m - (i - bit_count(mask & ((1::BIGINT << i) - 1))) * n)) AS gap
  FROM masks, range(1, n + m + 1) s(i) GROUP BY mask, far)
SELECT 's_acctbal' AS "column", n AS n_ref, m AS n_cur, round(far::DOUBLE / (n * m), 6) AS ks,
  CASE WHEN n * m > 0 THEN round((SELECT avg((gap >= far)::INT) FROM steps), 6) END AS ks_p_exact
FROM (SELECT z.n, z.m, max(k.far) AS far FROM z LEFT JOIN k ON true GROUP BY z.n, z.m)""")
def ks_exact_small(spark, folder):
    """Account balances of the suppliers of two nations: few rows, so the exact p-value."""
    rows = table(spark, folder, "supplier")
    out = drift.ks_small_samples(rows.filter("s_nationkey = 3"), rows.filter("s_nationkey = 4"), ["s_acctbal"])
    return round_all(out.select("column", "n_ref", "n_cur", "ks", "ks_p_exact"))


JSD = f"""{bins_sql('ref', LINE_NUMBERS, 50, 'a')}, {bins_sql('cur', LINE_NUMBERS, 50, 'b')},
ad AS (SELECT "column", bin, CASE WHEN n > 0 THEN n / (sum(n) OVER (PARTITION BY "column") * (hi - lo)) ELSE 1e-12::DOUBLE END AS d FROM a),
bd AS (SELECT "column", bin, CASE WHEN n > 0 THEN n / (sum(n) OVER (PARTITION BY "column") * (hi - lo)) ELSE 1e-12::DOUBLE END AS d FROM b),
ap AS (SELECT "column", bin, d / sum(d) OVER (PARTITION BY "column") AS p FROM ad),
bq AS (SELECT "column", bin, d / sum(d) OVER (PARTITION BY "column") AS q FROM bd),
j AS (SELECT ap."column", sqrt(greatest(0, (sum(p * ln(p / ((p + q) / 2))) + sum(q * ln(q / ((p + q) / 2)))) / 2)) AS jsd
  FROM ap JOIN bq ON ap."column" = bq."column" AND ap.bin = bq.bin GROUP BY 1)"""


@query(f"""WITH {REF_CUR}, {JSD} SELECT "column", round(jsd, 6) AS jsd FROM j""")
def jsd_drift(spark, folder):
    return round_all(drift.jensen_shannon(*reference_and_current(spark, folder), LINE_NUMBERS))


@query(f"""WITH {KS}, {JSD} SELECT p."column", round(ks, 6) AS ks, round(p, 6) + 0.0 AS ks_p_asymptotic, round(jsd, 6) AS jsd
FROM p JOIN j ON p."column" = j."column" """)
def drift_rank(spark, folder):
    return round_all(drift.drift_table(*reference_and_current(spark, folder), LINE_NUMBERS))


@query(f"""WITH {KS}, {JSD} SELECT p."column", round(ks, 6) AS ks, round(p, 6) + 0.0 AS ks_p_asymptotic, round(jsd, 6) AS jsd
FROM p JOIN j ON p."column" = j."column" ORDER BY jsd DESC, p, p."column" LIMIT 2""")
def drift_most_different(spark, folder):
    return round_all(drift.most_different(drift.drift_table(*reference_and_current(spark, folder), LINE_NUMBERS), 2))


@query(f"""WITH {REF_CUR}, {bins_sql('ref', ['l_extendedprice', 'l_quantity'], 40, 'a')},
{bins_sql('cur', ['l_extendedprice', 'l_quantity'], 40, 'b')}
SELECT a."column", a.bin, round(a.lo, 4) AS ref_lo, round(a.hi, 4) AS ref_hi, a.n AS ref_n, round(b.lo, 4) AS cur_lo,
  round(b.hi, 4) AS cur_hi, b.n AS cur_n FROM a JOIN b ON a."column" = b."column" AND a.bin = b.bin""")
def histogram_overlay(spark, folder):
    return round_all(profile.histogram_overlay(*reference_and_current(spark, folder), ["l_extendedprice", "l_quantity"], 40), 4)


@query(f"""WITH {REF_CUR}, d AS (""" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, abs((SELECT corr({a}, {b}) FROM ref) - (SELECT corr({a}, {b}) FROM cur)) AS g"
    for a, b in itertools.combinations(LINE_NUMBERS, 2)) + f""")
SELECT round(2 * sum(g) / {len(LINE_NUMBERS) ** 2}, 8) AS mean_abs_difference FROM d""")
def corr_diff(spark, folder):
    from plumbline.operators.correlation import matrix_difference

    out = matrix_difference(*reference_and_current(spark, folder), LINE_NUMBERS)
    return out.select(rounded(F.col("mean_abs_difference"), 8).alias("mean_abs_difference"))
