import pytest
from pyspark.sql import functions as F

from plumbline.functions import cells
from plumbline.operators import rules as R


def column(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def values(df, name="x"):
    return [r[name] for r in df.orderBy("i").collect()]


def test_snap_keeps_only_near_zero_and_near_one(spark):
    df = column(spark, [0.95, 1.1, 1.11, -0.1, 0.05, 0.5, None])
    assert values(R.apply_rules(df, [R.SnapBinary("s", ("x",))])) == [1, 1, None, 0, 0, None, None]


def test_clip_keeps_missing(spark):
    df = column(spark, [None, -0.2, 1.3, 0.4])
    assert values(R.apply_rules(df, [R.Clip("c", ("x",), 0.0, 1.0)])) == [None, 0, 1, 0.4]


def test_rescue(spark):
    df = column(spark, [0.4, 701.0, 5000.0, -1.0, None])
    assert values(R.apply_rules(df, [R.RescueProportion("r", ("x",))])) == [0.4, 0.701, 1, 0, None]


def test_null_outside_and_negative(spark):
    df = column(spark, [7.9, 8.0, 731.0, 731.1, None])
    assert values(R.apply_rules(df, [R.NullOutside("o", ("x",), 8.0, 731.0)])) == [None, 8, 731, None, None]
    assert values(R.apply_rules(column(spark, [-1.0, 0.0, 2.0]), [R.NullNegative("n", ("x",))])) == [None, 0, 2]


def test_weekend_flag_is_realigned(spark):
    df = spark.createDataFrame([(0, 1.0, 0.0, 0.0), (1, None, None, 1.0), (2, 0.0, 1.0, None)],
                               "i int, sat double, sun double, weekend double")
    rule = R.AnyFlag("w", ("weekend", "sat", "sun"))
    assert values(R.apply_rules(df, [rule]), "weekend") == [1, 0, 1]
    report = R.rules_report(df, [rule], "t").first()
    assert (report["changed"], report["filled"], report["nulled"]) == (2, 1, 0)


def test_simplex_variants(spark):
    names = [f"t{i}" for i in range(5)]
    df = spark.createDataFrame([(0, .5, .5, .5, .5, None), (1, *[None] * 5), (2, *[0.0] * 5)],
                               "i int, " + ", ".join(f"{n} double" for n in names))
    kept = R.apply_rules(df, [R.Simplex("s", tuple(names))]).orderBy("i").collect()
    assert list(kept[0])[1:] == [.25] * 4 + [None]
    assert list(kept[1])[1:] == [None] * 5 and list(kept[2])[1:] == [0.0] * 5
    even = R.apply_rules(df, [R.Simplex("s", tuple(names), uniform_fallback=True)]).orderBy("i").collect()
    assert list(even[1])[1:] == [.2] * 5 and list(even[2])[1:] == [.2] * 5


def test_one_hot_keeps_first_one_and_treats_missing_as_zero(spark):
    df = spark.createDataFrame([(0, 0.0, 1.0, 1.0), (1, None, 1.0, 1.0), (2, None, 1.0, 0.0)], "i int, a double, b double, c double")
    out = R.apply_rules(df, [R.SingleOne("o", ("a", "b", "c"))]).orderBy("i").collect()
    assert [list(r)[1:] for r in out] == [[0, 1, 0], [0, 1, 0], [None, 1, 0]]


def test_abs_repair_and_fill(spark):
    df = spark.createDataFrame([(0, -0.5, -0.5), (1, None, -0.3), (2, 0.2, None), (3, 0.7, 0.7)], "i int, a double, b double")
    assert values(R.apply_rules(df, [R.AbsOf("a", ("a", "b"))]), "a") == [0.5, 0.3, 0.2, 0.7]


def test_later_rules_see_earlier_results_and_report_counts_each(spark):
    df = spark.createDataFrame([(0, 0.5, 0.7), (1, 2.0, 0.5), (2, None, -1.0)], "i int, a double, b double")
    stage = [R.NullOutside("range", ("a", "b"), 0.0, 1.0), R.Fill("fill", ("a", "b"), {"a": 0.25, "b": 0.75}),
             R.Simplex("sum", ("a", "b"))]
    out = R.apply_rules(df, stage).orderBy("i").collect()
    assert [pytest.approx(r["a"] + r["b"]) for r in out] == [1.0] * 3
    counts = {(r["rule"], r["column"]): (r["nulled"], r["changed"], r["filled"])
              for r in R.rules_report(df, stage, "t").collect()}
    assert counts == {("range", "a"): (1, 0, 0), ("range", "b"): (1, 0, 0), ("fill", "a"): (0, 0, 2),
                      ("fill", "b"): (0, 0, 1), ("sum", "a"): (0, 2, 0), ("sum", "b"): (0, 2, 0)}


def test_rules_survive_json(spark):
    stage = [R.ClipEach("z", ("x",), {"x": (0.0, None)}), R.Fill("f", ("x",), {"x": 3.0}), R.Clip("c", ("x",), hi=2.0),
             R.Simplex("s", ("x", "y"), True)]
    assert R.rules_from_json(R.rules_to_json(stage)) == stage


def test_absent_columns_are_skipped(spark):
    df = column(spark, [1.0])
    assert R.apply_rules(df, [R.Clip("c", ("nope",), 0.0, 1.0), R.AnyFlag("w", ("x", "nope"))]).collect() == df.collect()
    assert R.rules_report(df, [R.Clip("c", ("nope",), 0.0, 1.0)], "t").count() == 0


def test_six_digits(spark):
    df = column(spark, [123456.789, 0.000123456789, -1.0, None]).withColumn("x", cells.six_digits(F.col("x")))
    assert values(df) == [123457.0, 0.000123457, -1.0, None]
