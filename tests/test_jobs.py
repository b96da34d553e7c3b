import math

import pytest
from pyspark.sql import functions as F

from plumbline.operators import checks
from plumbline.operators.calibrate import fit_calibration, sanitised_reference
from plumbline.operators.impute import ImputePolicy, fit_imputation
from plumbline.operators.rules import Clip, Fill, NullOutside, apply_rules
from plumbline.plans import articles, preprocess, train
from plumbline.plans.clean import CleanConfig, CleanJob, CleanModel
from plumbline.sources import files, runs
from plumbline.streaming import clean_stream

NAMES = ([*articles.TOPICS, *articles.FLAGS, *articles.KEYWORDS[:9], *articles.RATES, *articles.SUBJECTIVITY,
          *articles.POSITIVE, *articles.NEGATIVE, *articles.SIGNED, articles.ABS_POLARITY[0], *articles.SELF_REFERENCE,
          *articles.TOKEN_SHARES, *articles.COUNTS, articles.TARGET, articles.AGE, "mixed_type_col"])


def raw_articles(spark, n=120):
    """Text cells with gaps, noise, junk and repeated keys, as a raw export has them."""
    def cell(name, i, j):
        k = (i * 31 + j * 17) % 97
        if k == 3:
            return None
        if k == 5:
            return "error"
        if name in articles.TOPICS:
            return str(round(((i + j) % 7) / 10 + (1.5 if k == 7 else 0), 3))
        if name in articles.FLAGS:
            return str([0.0, 1.0, 0.04, 0.97, 0.5][(i + j * j) % 5])
        if name in articles.NEGATIVE:
            return str(-((i * j) % 12) / 10)
        if name in articles.SIGNED or name in articles.ABS_POLARITY:
            return str(((i * j) % 23 - 11) / 10)
        if name in articles.RATES + articles.SUBJECTIVITY + articles.POSITIVE + articles.TOKEN_SHARES:
            return str(((i * (j + 1)) % 12) / 10)
        if name == articles.AGE:
            return str(5 + (i * 7) % 740)
        if name == "mixed_type_col":
            return "text" if i % 2 else str(i)
        return str((i * (j + 3)) % 50 - 2)
    data = [(f" HTTP://site/{i % (n - 10)} " if i % 15 else "none", *[cell(c, i, j) for j, c in enumerate(NAMES)])
            for i in range(n)]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in ["url", *NAMES]))


JOB = CleanJob(CleanConfig(
    keys=("url",), score="shares", enforcement=articles.enforcement_rules, imputation=articles.imputation_policy,
    calibration=articles.calibration_config()))


@pytest.fixture(scope="module")
def cleaned(spark):
    raw = raw_articles(spark)
    reference = JOB.typed_rows(raw_articles(spark, 90))
    return raw, reference, JOB.run(raw, reference)


def test_clean_job_leaves_a_valid_table(cleaned):
    raw, _, result = cleaned
    table = result.table
    assert len(table.columns) == 62 and table.select("url").distinct().count() == table.count()
    failed = [r for r in checks.constraint_checks(table, articles.constraint_rules(table.columns)).collect() if not r["passed"]]
    assert failed == []
    still = checks.rule_violations(table, articles.violation_checks(table.columns)).filter("n > 0").collect()
    assert {r["rule"] for r in still} <= {"negative", "sentinel_negative", "weekday_exactly_one", "channel_at_most_one",
                                          "absolute_polarity", "age_outside"}
    assert table.filter(" OR ".join(f"{c} IS NULL" for c in table.columns)).count() == 0


def test_clean_job_audit(cleaned):
    raw, _, result = cleaned
    audit = {(r["stage"], r["rule"], r["column"]): r["n"] for r in result.audit.collect()}
    assert audit[("keys", "bad_tokens", "*")] == 8
    assert raw.count() - audit[("keys", "bad_tokens", "*")] - audit[("keys", "deduplicated", "*")] == result.typed.count()
    assert audit[("coercion", "coerced", "mixed_type_col")] > 40
    assert {s for s, _, _ in audit} == {"keys", "coercion", "enforcement", "imputation", "calibration"}


def test_clean_rules_are_idempotent_and_storable(cleaned, rows):
    _, _, result = cleaned
    rules = result.model.enforcement
    once = apply_rules(result.typed, rules)
    twice = apply_rules(once, rules)
    for a, b in zip(rows(once), rows(twice)):
        assert all(x == y or (x is not None and y is not None and not isinstance(x, str) and math.isclose(x, y, abs_tol=1e-12))
                   for x, y in zip(a, b))
    assert CleanModel.from_json(result.model.to_json()) == result.model


def test_clean_result_does_not_depend_on_partitioning(spark, cleaned, rows):
    raw, reference, result = cleaned
    again = JOB.run(raw.repartition(11), reference.repartition(2)).table
    for a, b in zip(rows(result.table), rows(again)):
        assert a[0] == b[0] and all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(a[1:], b[1:]))


def test_clean_write_and_package_policy(cleaned, spark, tmp_path):
    raw, _, result = cleaned
    result.write(str(tmp_path / "clean.csv"))
    assert files.load_dataset(spark, str(tmp_path / "clean.csv")).count() == result.table.count()
    assert spark.read.json(str(tmp_path / "clean.audit.json")).count() == result.audit.count()
    typed = result.typed
    rules = articles.enforcement_rules(typed.columns, repairs=False)
    fitted = fit_imputation(apply_rules(typed, rules), articles.imputation_policy(typed.columns, every_column=False))
    filled = {c for r in fitted if isinstance(r, Fill) for c in r.values}
    assert not filled & {*articles.SENTINEL_KEYWORDS, "mixed_type_col"} and "shares" in filled


def test_sparse_rows_are_dropped_when_asked(cleaned):
    raw, reference, result = cleaned
    strict = CleanJob(CleanConfig(keys=("url",), score="shares", enforcement=articles.enforcement_rules,
                                  imputation=articles.imputation_policy, max_missing_pct=6.0))
    assert 0 < strict.run(raw).table.count() < result.table.count()


def test_other_calibrations(cleaned):
    _, reference, result = cleaned
    sane = sanitised_reference(reference, articles.REFERENCE_DOMAINS, articles.REFERENCE_HEAVY, articles.REFERENCE_NULL_ABOVE)
    recon = apply_rules(result.table, fit_calibration(reference, articles.reconstruction_config()))
    final = apply_rules(recon, fit_calibration(sane, articles.final_config()))
    assert all(r["passed"] for r in checks.constraint_checks(final, articles.constraint_rules(final.columns)).collect())


def test_families(cleaned):
    raw, _, result = cleaned
    found = articles.FAMILIES.of(result.table)
    assert len(found["topic"]) == 5 and len(found["weekday"]) == 8 and found["key"] == ["url"]
    assert {"shares", "timedelta", "mixed_type_col"} <= set(found["other"]) and "url" not in found["other"]


def test_train_eval_writes_model_metrics_and_run(spark, tmp_path):
    df = spark.createDataFrame([(1, 10, "a", 100), (2, 20, "b", 200), (3, 30, "c", 300), (4, 40, "d", 400)],
                               "f1 int, f2 int, url string, shares bigint")
    model, metrics = train.train_eval(df, train.TrainConfig("url", "shares", "ridge", 0.25), str(tmp_path / "models"),
                                      str(tmp_path / "metrics"), str(tmp_path / "runs"))
    assert metrics.columns == ["r2", "rmse"]
    assert set(files.read_version(spark, str(tmp_path / "metrics")).columns) <= {"r2", "rmse"}
    assert runs.model_names(spark, str(tmp_path / "models")) == ["ridge"]
    assert runs.read_runs(spark, str(tmp_path / "runs")).first()["params"]["model"] == "ridge"
    with pytest.raises(ValueError):
        train.train_eval(df, train.TrainConfig("url", "shares", "magic"))


def test_experiment_from_config(spark, tmp_path):
    df = spark.range(200).select("id", *[F.sin(F.col("id") * (i + 1) * 0.37).alias(f"f{i}") for i in range(4)]).withColumn(
        "copy", F.col("f0") * 2 + 1).withColumn("y", F.exp(F.col("f0") + F.col("f1")) + 1).withColumn("text", F.lit("t"))
    config = train.ExperimentConfig.from_dict({
        "key": "id", "target": "y", "drop": ["f3"], "target_transform": "log1p", "baselines": ["linear", "random_forest"],
        "trees": 5, "rounds": 3, "depth": 3, "folds": 2})
    done = train.run_experiment(df, config, str(tmp_path))
    assert list(done.features) == ["f0", "f1", "f2"] and done.best() == done.board.first()["model"]
    assert files.read_features(spark, str(tmp_path / "features")) == ["f0", "f1", "f2"]
    assert {"model", "rmse_test", "mae_test", "r2_test"} <= set(files.read_version(spark, str(tmp_path / "leaderboard")).columns)
    assert runs.model_names(spark, str(tmp_path / "models")) == ["boosted", "linear", "random_forest"]
    logged = runs.read_runs(spark, str(tmp_path / "runs"))
    assert logged.filter("parent_run_id is not null").count() == 3
    scored = train.score_table(df, runs.load_model(str(tmp_path / "models"), "linear"), done.features, ["id"], "log1p")
    assert scored.columns == ["id", "prediction"] and scored.count() == 200


def test_preprocess(spark):
    done = preprocess.preprocess(spark.range(50).select(F.col("id").cast("double").alias("a"), (F.col("id") % 5).alias("b"),
                                                        F.lit("t").alias("s")), bins=5)
    assert done.shape.first()["n_rows"] == 50 and done.histograms.count() == 10 and done.correlations.count() == 1
    assert abs(done.scaled.agg(F.avg("a")).first()[0]) < 1e-12


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,x,t\n1,2.5,"say ""hi"""\n2,NA,\n')
    out = files.read_table(spark, str(tmp_path / "a.csv")).collect()
    assert [tuple(r) for r in out] == [("1", "2.5", 'say "hi"'), ("2", None, None)]
    (tmp_path / "list.json").write_text("[1.5, 2, 3]")
    assert [r[0] for r in files.read_table(spark, str(tmp_path / "list.json")).collect()] == [1.5, 2.0, 3.0]
    (tmp_path / "rec.json").write_text('[{"a": 1}, {"a": 2}]')
    assert files.read_table(spark, str(tmp_path / "rec.json")).count() == 2
    with pytest.raises(Exception):
        files.load_dataset(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(FileNotFoundError):
        files.read_version(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        files.read_table(spark, "x.pkl")


def test_frozen_rules_run_on_a_stream(spark, tmp_path):
    batch = spark.range(20).select(F.col("id"), (F.col("id") - 5.0).alias("x"))
    batch.write.parquet(str(tmp_path / "in"))
    rules = [NullOutside("range", ("x",), 0.0, 10.0), *fit_imputation(batch.filter("x >= 0"), ImputePolicy(median=("x",))),
             Clip("clip", ("x",), 1.0, 8.0)]
    stream = clean_stream(spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in")), rules)
    query = stream.writeStream.format("memory").queryName("cleaned").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(map(tuple, spark.table("cleaned").collect())) == sorted(map(tuple, apply_rules(batch, rules).collect()))
    with pytest.raises(ValueError):
        clean_stream(batch, rules)
