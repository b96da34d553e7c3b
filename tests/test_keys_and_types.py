import pytest
from pyspark.sql import functions as F

from plumbline.operators import coerce, keys, tables


def urls(spark):
    return spark.createDataFrame(
        [("HTTP://X/A", 5.0), (" http://x/a ", None), ("http://x/a", 9.0), (None, 1.0), ("none", 2.0), ("ftp://x", 3.0)],
        "url string, shares double")


def test_url_cleaning_keeps_the_best_row(spark, rows):
    assert rows(keys.clean_keys(urls(spark), "url", "shares")) == [("http://x/a", 9.0)]
    assert rows(keys.key_report(urls(spark), "url")) == [("bad_tokens", 2), ("deduplicated", 2), ("foreign_prefix", 1)]


def test_missing_and_nan_scores_lose(spark, rows):
    df = spark.createDataFrame([("a", float("nan"), 1), ("a", 2.0, 2), ("b", None, 3), ("b", -1.0, 4)], "k string, s double, id int")
    assert rows(keys.keep_best(df, ["k"], "s").select("k", "id")) == [("a", 2), ("b", 4)]


def test_heavy_key_and_partitioning_do_not_matter(spark, rows):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 50).alias("k"),
                                  (F.col("id") * 7 % 11).cast("double").alias("s"), "id")
    want = rows(keys.keep_best(df, ["k"], "s", ["id"]))
    assert want == rows(keys.keep_best(df.repartition(7), ["k"], "s", ["id"]))
    assert len(want) == 51
    partial = keys.keep_best(df, ["k"], "s", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in partial


def test_coercion(spark):
    texts = [" 12 ", "1e3", "error", "", None, "nan", "1.5d", "inf", "0x1p3", "-.5", "1e999"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "k string, x string")
    out = [r["x"] for r in coerce.coerce_numeric(df, ["k"]).orderBy(F.col("k").cast("int")).collect()]
    assert out == [12, 1000, None, None, None, None, None, None, None, -.5, None]
    summary = {r["column"]: r for r in coerce.coercion_summary(df, ["k"]).collect()}
    assert (summary["x"]["coerced"], summary["x"]["missing_before"], summary["x"]["missing_after"]) == (7, 1, 8)
    assert summary["k"]["coerced"] == 0


def test_coercion_modes(spark):
    df = spark.createDataFrame([("1", "2"), ("x", "3")], "a string, b string")
    assert dict(coerce.coerce_numeric(df, errors="ignore").dtypes) == {"a": "string", "b": "double"}
    with pytest.raises(Exception, match="not a number in a"):
        coerce.coerce_numeric(df, errors="raise").collect()
    assert coerce.coerce_numeric(df.select("b"), errors="raise").count() == 2
    with pytest.raises(ValueError):
        coerce.coerce_numeric(df, errors="perhaps")


def test_model_rows_drop_text_and_incomplete_rows(spark):
    df = spark.createDataFrame([("http://a", 1.0, 10.0, 100), ("http://b", 2.0, None, 200), (None, 3.0, 30.0, None)],
                               "url string, f1 double, f2 double, shares int")
    out = tables.model_rows(df, "shares")
    assert out.columns == ["f1", "f2", "shares"] and out.count() == 1


def test_drop_and_select_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert tables.drop_columns(df, ["a", "z"]).columns == ["b"]
    with pytest.raises(KeyError):
        tables.drop_columns(df, ["z"], errors="raise")
    with pytest.raises(KeyError):
        tables.select_features(df, ["a", "z"])
