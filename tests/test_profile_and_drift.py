import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import calibrate, drift, profile


@pytest.fixture(scope="module")
def pair(spark):
    a = spark.range(500).select(F.sqrt(F.col("id").cast("double")).alias("x"), (F.col("id") % 2).cast("double").alias("f"))
    b = spark.range(300).select((F.col("id") / 10.0).alias("x"), (F.col("id") % 3 == 0).cast("double").alias("f"))
    return a, b, a.toPandas(), b.toPandas()


@pytest.mark.parametrize("bins", [7, 30])
def test_histogram_equals_numpy(pair, bins):
    for df, pdf in ((pair[0], pair[2]), (pair[1], pair[3])):
        got = profile.histogram(df, ["x"], bins).orderBy("bin").toPandas()
        counts, edges = np.histogram(pdf["x"], bins=bins)
        assert list(got["n"]) == list(counts)
        assert np.allclose(got["lo"], edges[:-1]) and np.allclose(got["hi"], edges[1:])


def test_histogram_of_a_constant_and_of_nothing(spark):
    df = spark.createDataFrame([(3.0, None), (3.0, None)], "x double, z double")
    got = profile.histogram(df, ["x", "z"], 4).orderBy("bin").collect()
    assert [(r["column"], r["lo"], r["n"]) for r in got] == [("x", 2.5, 0), ("x", 2.75, 0), ("x", 3.0, 2), ("x", 3.25, 0)]


def test_ks_equals_the_definition(pair):
    got = {r["column"]: r for r in drift.ks_statistic(pair[0], pair[1]).collect()}
    for c in ("x", "f"):
        p, q = np.sort(pair[2][c]), np.sort(pair[3][c])
        at = np.concatenate([p, q])
        want = np.abs(np.searchsorted(p, at, "right") / len(p) - np.searchsorted(q, at, "right") / len(q)).max()
        assert got[c]["ks"] == pytest.approx(want, abs=1e-12)
        assert 0.0 <= got[c]["ks_p_asymptotic"] <= 1.0


def test_jensen_shannon(pair):
    got = {r["column"]: r["jsd"] for r in drift.jensen_shannon(pair[0], pair[1]).collect()}
    for c in ("x", "f"):
        p, _ = np.histogram(pair[2][c], bins=50, density=True)
        q, _ = np.histogram(pair[3][c], bins=50, density=True)
        p, q = np.where(p == 0, 1e-12, p), np.where(q == 0, 1e-12, q)
        p, q = p / p.sum(), q / q.sum()
        m = (p + q) / 2
        assert got[c] == pytest.approx(np.sqrt((p * np.log(p / m)).sum() / 2 + (q * np.log(q / m)).sum() / 2))
    same = drift.jensen_shannon(pair[0], pair[0], shared_range=True).collect()
    assert all(r["jsd"] == pytest.approx(0.0, abs=1e-9) for r in same)


def test_density_integrates_to_one(pair):
    curve = profile.density_curve(pair[0], "x").orderBy("x").toPandas()
    assert len(curve) == 200 and 0.85 < np.trapezoid(curve["density"], curve["x"]) < 1.0


def test_box_plot(pair):
    row = profile.box_plot(pair[0], ["x"]).first()
    q1, q2, q3 = np.quantile(pair[2]["x"], [.25, .5, .75])
    assert (row["q1"], row["median"], row["q3"]) == pytest.approx((q1, q2, q3)) and row["outliers"] == 0


def test_missing_profiles(spark, rows):
    df = spark.createDataFrame([(1.0, None, "a"), (None, None, "b"), (3.0, 4.0, None)], "x double, y double, s string")
    assert [(r[0], r[1]) for r in profile.missing_by_column(df).collect()] == [("y", 2), ("s", 1), ("x", 1)]
    assert rows(profile.null_patterns(df)) == [("001", 1), ("010", 1), ("110", 1)]
    assert rows(profile.co_missing(df)) == [("x", "s", 0), ("x", "y", 1), ("y", "s", 0)]
    holes = spark.createDataFrame([(float("nan"), 1), (float("inf"), 2), (1.0, 3)], "x double, k int")
    assert profile.missing_by_column(holes).first()[:2] == ("x", 2)
    assert rows(profile.null_patterns(holes)) == [("00", 1), ("10", 2)]
    assert {r[0]: r[1] for r in profile.cardinality(holes).collect()} == {"x": 1, "k": 3}
    assert profile.drop_sparse_rows(df, 40.0).count() == 2
    assert profile.missing_overview(df).first()[2] == 4
    assert profile.duplicate_rows(df.unionAll(df)).first()[0] == 3
    assert {r[0]: r[1] for r in profile.cardinality(df).collect()} == {"x": 2, "s": 2, "y": 1}


def test_z_bounds_fall_back_to_percentiles(spark):
    ref = spark.createDataFrame([(2.0, float(i)) for i in range(101)], "flat double, wide double")
    bounds = calibrate.z_bounds(ref, ["flat", "wide", "gone"], 2.0)
    assert bounds["flat"] == (2.0, 2.0)
    spread = np.std(np.arange(101), ddof=1)
    assert bounds["wide"] == pytest.approx((50 - 2 * spread, 50 + 2 * spread))
    assert calibrate.tail_bounds(ref, ["wide"])["wide"] == pytest.approx((1.0, 99.0))


def plain_ks(a, b):
    both = np.concatenate((a, b))
    return max(abs(np.searchsorted(np.sort(a), both, "right") / len(a) - np.searchsorted(np.sort(b), both, "right") / len(b)))


def test_ks_opens_few_stretches_and_is_exact(spark, monkeypatch):
    monkeypatch.setattr(drift, "FEW_ROWS", 400)
    monkeypatch.setattr(drift, "CUTS", 40)
    r = np.random.default_rng(8)
    sides = []
    for shift, n in ((0.0, 3_000), (0.1, 2_000)):
        x = np.column_stack([r.normal(size=n) + shift, r.integers(0, 6, n) + (r.random(n) < shift), np.full(n, 5.0), r.exponential(size=n)])
        sides.append(x)
    build = lambda x: spark.createDataFrame(
        [tuple(float(v) for v in row) + (None,) for row in x], "a double, b double, c double, d double, e double")
    got = {row["column"]: row["ks"] for row in drift.ks_statistic(build(sides[0]), build(sides[1])).collect()}
    for i, c in enumerate("abcd"):
        assert got[c] == pytest.approx(plain_ks(sides[0][:, i], sides[1][:, i]), abs=1e-12)
    assert got["e"] is None


def test_exact_p_values_equal_enumeration():
    for n in range(1, 6):
        for m in range(1, 6):
            gaps = []
            for places in itertools.combinations(range(n + m), n):
                r = np.cumsum([i in places for i in range(n + m)])
                gaps.append(max(abs(r / n - (np.arange(1, n + m + 1) - r) / m)))
            for ks in set(gaps):
                assert drift.ks_exact_p(ks, n, m) == pytest.approx(np.mean([g >= ks - 1e-9 for g in gaps]))
    assert drift.ks_exact_p(1.0, 8, 8) == pytest.approx(2 / 12870)


def test_ks_of_like_sides_takes_few_passes(spark, monkeypatch):
    """Where the gap is as small as the rows between two cuts, nearly every stretch stays open after the first pass."""
    monkeypatch.setattr(drift, "FEW_ROWS", 400)
    monkeypatch.setattr(drift, "CUTS", 40)
    monkeypatch.setattr(drift, "SAMPLED", 2)
    passes, count = [], drift._side_counts
    monkeypatch.setattr(drift, "_side_counts", lambda *a: passes.append(1) or count(*a))
    r = np.random.default_rng(4)
    x = r.random(12_000)
    a, b = x[:9_000], x[9_000:]
    frames = [spark.createDataFrame([(float(v),) for v in side], "x double") for side in (a, b)]
    got, = drift.ks_statistic(*frames).collect()
    assert got["ks"] == pytest.approx(plain_ks(a, b), abs=1e-12)
    assert len(passes) <= 4
