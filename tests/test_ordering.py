import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import ordering as O


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value; the rest is spread, with gaps."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.sin(F.col("id").cast("double")) * F.col("id")).alias("x"),
        F.when(F.col("id") % 7 != 0, (F.col("id") % 4).cast("double")).alias("y"), F.lit(None).cast("double").alias("z"))
    return df, df.toPandas()


PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("limit", [100_000, 10])
def test_quantiles_are_exact_on_both_ways(skewed, limit):
    df, pdf = skewed
    found = O.quantiles(df, ["x", "y", "z"], PROBS, distinct_limit=limit)
    for c in ("x", "y"):
        assert np.allclose(found[c], np.quantile(pdf[c].dropna(), PROBS), rtol=1e-12, atol=1e-12)
    assert found["z"] == [None] * len(PROBS)


def test_order_statistics_inside_a_heavy_value(skewed):
    df, pdf = skewed
    ordered = np.sort(pdf["x"].to_numpy())
    ranks = [0, 1, 2999, 3000, 3500, 5999]
    found = O.order_statistics(df, {"x": ranks}, {"x": 6000}, row_limit=5)
    assert [found["x"][r] for r in ranks] == [ordered[r] for r in ranks]


def test_average_ranks(skewed, monkeypatch):
    df, pdf = skewed
    monkeypatch.setattr(O, "ROWS_PER_BUCKET", 100)
    got = O.average_ranks(df, ["x", "y"]).toPandas()
    for c in ("x", "y"):
        want = pdf[c].rank().groupby(pdf[c]).first()
        mine = got[got["column"] == c].set_index("value")["rank"].sort_index()
        assert np.array_equal(want.to_numpy(), mine.to_numpy())


@pytest.mark.parametrize("broadcast", [0, 200_000])
def test_look_up_with_heavy_values(skewed, monkeypatch, broadcast):
    df, pdf = skewed
    monkeypatch.setattr(O, "BROADCAST_VALUES", broadcast)
    table = O.average_ranks(df, ["x"])
    out = O.look_up(df.select("x"), "x", table, ["rank"], 4001, 6000).toPandas()
    assert len(out) == 6000 and out["rank"].notna().all()
    assert np.isclose(out["rank"].sum(), 6000 * 6001 / 2)


def test_modes_take_the_lowest_on_ties(spark):
    df = spark.createDataFrame([(0.0, "b"), (0.0, "a"), (1.0, "b"), (1.0, "a"), (None, None)], "x double, s string")
    assert O.modes(df.withColumn("n", F.lit(None).cast("double")), ["x", "s", "n"]) == {"x": 0.0, "s": "a", "n": None}
