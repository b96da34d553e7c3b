import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from plumbline.operators import correlation as C
from plumbline.operators import ordering as O
from plumbline.operators.selectors import DropColumns, DropHighCorrFeatures


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.normal(size=400), "b": rng.integers(0, 5, 400).astype(float)})
    pdf["c"] = pdf["a"] * 2 + rng.normal(size=400)
    pdf["d"] = np.where(rng.random(400) < 0.34, 1.0, rng.normal(size=400))   # a third in one value
    pdf.loc[::9, "b"] = np.nan
    pdf.loc[::11, "c"] = np.nan
    pdf["flat"] = 2.5
    text = pdf.astype(object).where(pdf.notna(), None)
    return spark.createDataFrame(list(text.itertuples(index=False, name=None)),
                                 ", ".join(f"{c} double" for c in pdf.columns)).repartition(3), pdf


def got(df):
    return {(r["column_i"], r["column_j"]): r["r"] for r in df.collect()}


def average_rank(s):
    return s.rank()


def test_pearson_is_pairwise_complete(table):
    df, pdf = table
    found = got(C.correlation(df, list(pdf.columns)))
    want = pdf.corr()
    for (i, j), r in found.items():
        if "flat" in (i, j):
            assert r is None
        else:
            assert r == pytest.approx(want.loc[i, j], abs=1e-10)
    assert len(found) == 10


def test_spearman_ranks_each_pair_over_its_own_rows(table, monkeypatch):
    df, pdf = table
    monkeypatch.setattr(O, "ROWS_PER_BUCKET", 40)
    monkeypatch.setattr(O, "BROADCAST_VALUES", 50)
    for (i, j), r in got(C.correlation(df, ["a", "b", "c", "d"], "spearman")).items():
        both = pdf[[i, j]].dropna()
        assert r == pytest.approx(both[i].rank().corr(both[j].rank()), abs=1e-10)


def tau_b(x, y):
    sx, sy = np.sign(x[:, None] - x[None, :]), np.sign(y[:, None] - y[None, :])
    return (sx * sy).sum() / np.sqrt((sx ** 2).sum() * (sy ** 2).sum())


def test_kendall_equals_all_pairs(table, monkeypatch):
    df, pdf = table
    monkeypatch.setattr(O, "ROWS_PER_BUCKET", 40)
    monkeypatch.setattr(O, "BROADCAST_VALUES", 50)
    found = got(C.correlation(df, ["a", "b", "c", "d"], "kendall"))
    for i, j in itertools.combinations(["a", "b", "c", "d"], 2):
        both = pdf[[i, j]].dropna().to_numpy()
        assert found[(i, j)] == pytest.approx(tau_b(both[:, 0], both[:, 1]), abs=1e-12)
    assert got(C.correlation(df, ["a", "flat"], "kendall")) == {("a", "flat"): None}


def test_later_column_of_a_pair_is_dropped(spark, tmp_path):
    df = spark.range(50).select(F.col("id").cast("double").alias("a"), F.col("id").cast("double").alias("b"),
                                F.sin(F.col("id") * 1.7).alias("c"), F.lit("t").alias("text"))
    assert C.redundant_columns(df) == ["b"]
    model = Pipeline(stages=[DropColumns(columns=["text", "gone"]), DropHighCorrFeatures(threshold=0.9)]).fit(df)
    assert model.transform(df).columns == ["a", "c"] and model.stages[1].kept() == ["a", "c"]
    model.write().overwrite().save(str(tmp_path / "m"))
    assert PipelineModel.load(str(tmp_path / "m")).transform(df).columns == ["a", "c"]
    with pytest.raises(ValueError):
        DropHighCorrFeatures(threshold=1.5)


def test_matrix_difference(table):
    df, pdf = table
    other = df.withColumn("c", F.col("c") + F.col("b"))
    mine = C.matrix_difference(df, other, ["a", "b", "c"]).first()[0]
    alt = pdf.assign(c=pdf["c"] + pdf["b"])
    assert mine == pytest.approx((pdf[["a", "b", "c"]].corr() - alt[["a", "b", "c"]].corr()).abs().mean().mean())
