import threading

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.operators import knn, models, scale, score, split
from plumbline.operators.models import ModelSpec
from plumbline.sources import runs


def test_scaling_population_sd_constants_and_gaps(spark):
    df = spark.createDataFrame([(1.0, 7.0, None, "a"), (2.0, 7.0, 3.0, "b"), (3.0, 7.0, 5.0, "c")], "x double, k double, g double, s string")
    out = scale.scale_features(df).orderBy("x").collect()
    assert [r["x"] for r in out] == pytest.approx([-1.224744871, 0, 1.224744871])
    assert [r["k"] for r in out] == [0, 0, 0] and [r["g"] for r in out] == [None, -1, 1]
    low = scale.min_max_features(df).orderBy("x").collect()
    assert [r["x"] for r in low] == [0, .5, 1] and [r["k"] for r in low] == [0, 0, 0]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"id": np.arange(200), "a": rng.normal(size=200), "b": rng.normal(size=200) * 3})
    pdf["y"] = 4 + 2 * pdf["a"] - pdf["b"] + rng.normal(size=200)
    return spark.createDataFrame(list(pdf.itertuples(index=False, name=None)), "id bigint, a double, b double, y double"), pdf


def test_pca_equals_numpy(data):
    df, pdf = data
    found = scale.run_pca(df, 3, ["id"])
    z = pdf[["a", "b", "y"]]
    z = ((z - z.mean()) / z.std(ddof=0)).to_numpy()
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    assert np.allclose(found.explained, s ** 2 / (s ** 2).sum())
    assert np.allclose(np.abs(np.array(found.loadings)), np.abs(vt))
    got = found.data.orderBy("id").toPandas()
    assert np.allclose(np.abs(got[["PC1", "PC2", "PC3"]]), np.abs(z @ vt.T), atol=1e-8)
    assert len(scale.run_pca(df, 0.6, ["id"]).explained) < 3


def closed_form(pdf, alpha, z=False):
    x = pdf[["a", "b"]].to_numpy()
    if z:
        x = (x - x.mean(0)) / x.std(0)
    y = pdf["y"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(2), xc.T @ yc)
    return y.mean() + xc @ w


@pytest.mark.parametrize("spec,alpha,z", [
    (ModelSpec("linear", "linear"), 0.0, False), (ModelSpec("linear", "linear", scaled=True), 0.0, True),
    (ModelSpec("ridge", "ridge", {"alpha": 50.0}), 50.0, False),
    (ModelSpec("ridge", "ridge", {"alpha": 50.0}, scaled=True), 50.0, True)])
def test_linear_models_match_the_closed_form(data, spec, alpha, z):
    df, pdf = data
    got = models.predict(models.fit_model(df, spec, ["a", "b"], "y"), df).orderBy("id").toPandas()["prediction"]
    assert np.allclose(got, closed_form(pdf, alpha, z), atol=1e-6)


def test_lasso_optimality(data):
    df, pdf = data
    alpha = 0.4
    got = models.predict(models.fit_model(df, ModelSpec("l", "lasso", {"alpha": alpha}), ["a", "b"], "y"), df)
    residual = (pdf["y"] - got.orderBy("id").toPandas()["prediction"]).to_numpy()
    x = pdf[["a", "b"]].to_numpy()
    assert np.allclose(np.abs((x - x.mean(0)).T @ residual / len(x)), alpha, atol=1e-3)


def test_logistic_penalty_is_the_unit_inverse(data):
    df, pdf = data
    flagged = df.withColumn("t", (F.col("y") > 4).cast("int"))
    model = models.fit_model(flagged, ModelSpec("l", "logistic", scaled=True), ["a", "b"], "t").stages[-1]
    x = pdf[["a", "b"]].to_numpy()
    x = (x - x.mean(0)) / x.std(0)
    t = (pdf["y"] > 4).to_numpy().astype(float)
    w, b = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.allclose(x.T @ (p - t) + w, 0, atol=0.05)   # gradient of log loss + |w|^2 / 2


def test_split_is_exact_disjoint_and_stable(spark, rows, monkeypatch):
    monkeypatch.setattr(split, "PREFIX", 1)
    df = spark.range(1003).withColumn("s", F.col("id") % 7 == 0)
    fitted = split.fit_split(df, "id", 0.2, 1)
    test = rows(fitted.test(df))
    assert len(test) == 201 and len(rows(fitted.train(df))) == 802
    assert test == rows(split.fit_split(df.repartition(9), "id", 0.2, 1).test(df))
    by = split.fit_split(df, "id", 0.2, 1, "s").test(df).groupBy("s").count().collect()
    assert {r[0]: r[1] for r in by} == {True: 29, False: 172}
    folds = df.groupBy(split.fit_folds(df, "id", 5, 1).alias("f")).count().orderBy("f").collect()
    assert [r[1] for r in folds] == [201, 201, 201, 200, 200]


def test_split_with_a_heavy_key_keeps_it_on_one_side(spark):
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    for seed in range(3):
        fitted = split.fit_split(df, "k", 0.5, seed)
        sides = fitted.marked(df.filter("k = 0")).select("is_test").distinct().count()
        assert sides == 1 and fitted.test(df).count() >= 450


def test_split_of_many_strata(spark):
    df = spark.range(3_000).withColumn("s", F.col("id") % 600)
    fitted = split.fit_split(df, "id", 0.2, 3, "s")
    per = fitted.marked(df).groupBy("s").agg(F.sum(F.col("is_test").cast("int")).alias("t")).groupBy("t").count().collect()
    assert {r[0]: r[1] for r in per} == {1: 600}


def test_out_of_fold_covers_every_row_once(data):
    df, pdf = data
    out = models.out_of_fold(df, ModelSpec("linear", "linear"), ["a", "b"], "y", "id")
    assert sorted(r["id"] for r in out.collect()) == list(range(200))
    assert models.regression_metrics(out, "y").first()["r2"] > 0.8


def test_specs_and_scores(data):
    df, _ = data
    train, test = split.train_test(df, "id")
    board = models.train_and_evaluate(train, test, ["a", "b"], "y", models.baseline_specs(names=["dummy", "linear"]))
    assert [r["model"] for r in board.collect()] == ["linear", "dummy"]
    with pytest.raises(ValueError):
        models.baseline_specs(names=["nothing"])
    with pytest.raises(ValueError):
        models.baseline_specs("ranking")
    board, fitted = models.leaderboard(train, test, ["a", "b"], "y", "id", [
        ModelSpec("dummy", "mean"), ModelSpec("knn", "knn", {"k": 5}), ModelSpec("linear", "linear")], "none", folds=2)
    names = [r["model"] for r in board.collect()]
    assert names[0] == "linear" == models.best_model(board) and fitted["knn"].k == 5
    assert {"mae_train", "rmse_test", "r2_test"} <= set(board.columns)


def brute(q, t, ids, k):
    d = np.sqrt(((q[:, None, :] - t[None, :, :]) ** 2).sum(2))
    return [[ids[j] for j in np.lexsort((ids, row))[:k]] for row in d]


def test_knn_join_is_exact_with_copies_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(2)
    points = rng.normal(size=(180, 3)) * [1, 5, .1]
    points[::3] = points[0]     # a third of the rows are copies
    t = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "tid bigint, x double, y double, z double")
    queries = np.vstack([points[:20] + 0.01, points[:1]])
    q = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(queries)], "qid bigint, x double, y double, z double")
    got = knn.knn_join(q, t, ["x", "y", "z"], "qid", "tid", 7).orderBy("qid", "distance", "tid").toPandas()
    want = brute(queries, points, np.arange(180), 7)
    for i in range(len(queries)):
        assert list(got[got["qid"] == i]["tid"]) == want[i]


def test_a_stored_index_answers_as_the_fitted_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(knn, "ROWS_PER_CELL", 20)
    rng = np.random.default_rng(4)
    points = rng.normal(size=(400, 2)) * [1, 30]
    t = spark.createDataFrame([(i, *map(float, p), float(p[0])) for i, p in enumerate(points)], "id bigint, x double, z double, y double")
    q = spark.createDataFrame([(i, *map(float, p + 0.1)) for i, p in enumerate(points[:30])], "id bigint, x double, z double")
    fitted = models.fit_neighbours(t, ModelSpec("knn", "knn", {"k": 5}), ["x", "z"], "y", "id")
    assert len(fitted.index.sizes) > 8 and fitted.index.sizes.sum() == 400
    runs.save_model(fitted, str(tmp_path), "knn")
    loaded = runs.load_model(str(tmp_path), "knn", spark)
    scale = points.std(0)
    near = brute((points[:30] + 0.1) / scale, points / scale, np.arange(400), 5)
    for model in (fitted, loaded):
        got = {r["id"]: r["prediction"] for r in model.predict(q, "id").collect()}
        for i in range(30):
            d = np.linalg.norm((points[near[i]] - points[i] - 0.1) / scale, axis=1)
            assert got[i] == pytest.approx(np.average(points[near[i], 0], weights=1 / d))


def test_random_projections_reach_their_recall(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 8)) * 4
    points = centres[rng.integers(0, 30, 900)] + rng.normal(size=(900, 8))
    t = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "tid bigint, " + ", ".join(f"f{i} double" for i in range(8)))
    q = t.filter("tid % 10 = 0").withColumnRenamed("tid", "qid")
    features = [f"f{i}" for i in range(8)]
    got = knn.approximate_join(q, t, features, "qid", "tid", 5).toPandas()
    want = brute(points[::10], points, np.arange(900), 5)
    hits = sum(len(set(got[got["qid"] == 10 * i]["tid"]) & set(w)) for i, w in enumerate(want))
    assert hits >= 0.9 * 5 * len(want) and not got.duplicated(["qid", "tid"]).any()


def test_knn_regress_weights_and_exact_matches(spark):
    t = spark.createDataFrame([(0, 0.0, 10.0), (1, 1.0, 20.0), (2, 3.0, 50.0), (3, 1.0, 40.0)], "tid int, x double, y double")
    q = spark.createDataFrame([(0, 1.0), (1, 2.0)], "qid int, x double")
    got = {r[0]: r[1] for r in knn.knn_regress(q, t, ["x"], "qid", "tid", "y", 3).collect()}
    assert got[0] == pytest.approx(30.0) and got[1] == pytest.approx((20 + 40 + 50) / 3)


def test_alignment(spark, rows):
    truth = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "id int, target double")
    preds = spark.createDataFrame([(2, 2.5), (3, 3.0), (4, 1.0)], "id int, prediction double")
    assert rows(score.align_by_key(truth, preds, "id")) == [(2, 2.0, 2.5), (3, 3.0, 3.0)]
    with pytest.raises(ValueError, match="not unique"):
        score.align_by_key(truth.unionAll(truth), preds, "id")
    with pytest.raises(ValueError, match="no rows"):
        score.align_by_key(truth, preds.filter("id = 4"), "id")
    with pytest.raises(ValueError, match="number of rows"):
        score.align_by_order(truth, preds.limit(2), "id")
    assert score.evaluate_predictions(truth, preds, order="id").first()["mae"] == pytest.approx((1.5 + 1.0 + 2.0) / 3)


def test_order_alignment_keeps_large_ids_apart(spark):
    ids = spark.range(1000).select((F.lit(1 << 60) + F.col("id")).alias("id"), F.col("id").cast("double").alias("target"))
    got = score.align_by_order(ids, ids.withColumnRenamed("target", "prediction"), "id").collect()
    assert len(got) == 1000 and all(r["y"] == r["prediction"] for r in got)
    with pytest.raises(ValueError):
        score.align_by_order(ids.withColumn("id", F.when(F.col("target") > 0, F.col("id"))),
                             ids.withColumnRenamed("target", "prediction"), "id")


def test_classifiers_score_in_a_session_that_observed_something(spark):
    """A session that has had an observation cannot be sent to tasks, and a classifier's training summary holds its session."""
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 5
    rows = spark.createDataFrame([(float(i % 7), float(i % 3), int(i % 7 > 3)) for i in range(60)], "a double, b double, t int")
    for kind in ("logistic", "forest_classifier"):
        model = models.fit_model(rows, ModelSpec("m", kind, {"trees": 3, "depth": 3, "iterations": 20}, scaled=kind == "logistic"), ["a", "b"], "t")
        assert models.accuracy(models.predict(model, rows), "t").first()["accuracy"] == 1.0


def test_rows_are_few_at_once_where_centres_are_many():
    pdf = pd.DataFrame({"tid": range(10)}, index=range(5, 15))
    parts = list(knn._in_slices([pdf, pdf[:0]], knn.DISTANCES_AT_ONCE // 3))
    assert [len(p) for p in parts] == [3, 3, 3, 1] and [i for p in parts for i in p["tid"]] == list(range(10))
    assert all(list(p.index) == list(range(len(p))) for p in parts)
    assert [len(p) for p in knn._in_slices([pdf], 2 * knn.DISTANCES_AT_ONCE)] == [1] * 10


def test_trees_keep_each_rows_node_between_levels(spark):
    """Otherwise every row walks every tree from its root at every level; what is grown is the same."""
    rows = spark.createDataFrame([(float(i % 17), float(i * 7 % 29), i * 5 % 11 // 6) for i in range(300)], "a double, b double, t int")
    for kind in ("forest_classifier", "forest", "tree"):
        spec = ModelSpec("m", kind, {"trees": 5})
        kept = models.fit_model(rows, spec, ["a", "b"], "t")
        assert kept.stages[-1].getCacheNodeIds()
        plain = models._BUILDERS[kind](spec.params, None, "t").setCacheNodeIds(False).fit(kept.stages[0].transform(rows))
        assert plain.toDebugString.split("\n")[1:] == kept.stages[-1].toDebugString.split("\n")[1:]


def test_single_trees_of_all_folds_are_fitted_side_by_side(spark, monkeypatch):
    """Each fit is a chain of short jobs; one fold after the other was most of a sweep's time."""
    df = spark.createDataFrame([(i, float(i % 13), float(i % 13 > 6) + i % 3) for i in range(90)], "id long, a double, y double")
    together, fit = threading.Barrier(3), models.fit_model

    def waits(*args):
        together.wait(60)      # breaks unless all three fits are under way
        return fit(*args)

    folded = df.withColumn("_fold", F.col("id") % 2 + 1)
    spec = ModelSpec("tree", "tree", {"depth": 2})
    monkeypatch.setattr(models, "fit_model", waits)
    model, oof = models._fit_all(folded, spec, ["a"], "y", "id", 2)
    monkeypatch.undo()
    want = {r["id"]: r["prediction"] for i in (1, 2) for r in models.predict(
        fit(folded.filter(F.col("_fold") != i), spec, ["a"], "y"), folded.filter(F.col("_fold") == i)).collect()}
    assert {r["id"]: r["prediction"] for r in oof.collect()} == want and len(want) == 90
    assert [r["prediction"] for r in models.predict(model, df).orderBy("id").collect()] == [
        r["prediction"] for r in models.predict(fit(folded, spec, ["a"], "y"), df).orderBy("id").collect()]


def test_a_blocks_nearest_rows_are_exact_whatever_the_product_rounds():
    """Copies, far offsets, a reach, ids that occur twice and values whose squares overflow, against all distances."""
    rng = np.random.default_rng(8)
    for scale, shift in ((1, 0), (1e-3, 1e6), (1, 1e9), (1e200, 0)):
        rows = (rng.integers(0, 9, (700, 3)) * 1.0 + shift) * scale
        queries = (rng.integers(0, 9, (40, 3)) + 0.25 + shift) * scale
        numbers = rng.permutation(700)
        with np.errstate(over="ignore"):
            d = knn._distances(queries, rows)
            shelf = knn._Shelf.of([(pa.array(numbers[:300]), rows[:300], None), (pa.array(numbers[300:]), rows[300:], None)], 0, False)
            near = [np.lexsort((numbers, line))[:15] for line in d]
            reach = np.array([np.nan if i % 4 == 0 else line[n[i % 15]] for i, (line, n) in enumerate(zip(d, near))])
            for limit in (None, reach):
                row, pick, gap = shelf.closest(queries, 15, limit, None)
                for i, n in enumerate(near):
                    want = n if limit is None or np.isnan(limit[i]) else n[d[i][n] <= limit[i]]
                    assert pick[row == i].tolist() == want.tolist() and gap[row == i].tolist() == d[i][want].tolist()
            twice = knn._Shelf.of([(pa.array(numbers // 2), rows, None)], 0, True)
            row, pick, _ = twice.closest(queries, 15, None, None)
            for i, line in enumerate(d):
                least = pd.Series(line).groupby(numbers // 2).min().reset_index().sort_values([0, "index"])[:15]
                assert (numbers[pick[row == i]] // 2).tolist() == least["index"].tolist()


@pytest.mark.parametrize("tables, bits, probes, cells", [(6, 3, 3, 1), (6, 2, 1, 1), (3, 7, 2, 9)])
def test_projections_look_at_no_more_pairs_than_there_are(spark, monkeypatch, tables, bits, probes, cells):
    """Dense keys: each pair once instead of once per shared key; the rows found are those that share a key."""
    rng = np.random.default_rng(9)
    points, k = rng.normal(size=(400, 5)), 6
    t = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "tid bigint, " + ", ".join(f"f{i} double" for i in range(5)))
    q, search, asked = t.filter("tid % 8 = 0").withColumnRenamed("tid", "qid"), knn._search, []
    monkeypatch.setattr(knn, "BLOCK_ROWS", 64)
    monkeypatch.setattr(knn, "_search", lambda queries, *rest, **more: asked.append(
        queries.select(F.max(F.size("cells"))).head()[0]) or search(queries, *rest, **more))
    got = {(r["qid"], r["tid"]): r["distance"] for r in knn.approximate_join(
        q, t, [f"f{i}" for i in range(5)], "qid", "tid", k, tables, bits, probes, 3).collect()}
    assert asked == [cells]
    planes, want = np.random.default_rng(3).normal(size=(tables, 5, bits)), {}
    for i in range(0, 400, 8):
        shares = np.zeros(400, bool)
        for plane in planes:
            side = (points - points.mean(0)) @ plane
            differ = (side > 0) != (side[i] > 0)
            probed = np.isin(np.arange(bits), np.argsort(np.abs(side[i]))[:probes])
            shares |= (differ.sum(1) == 0) | ((differ.sum(1) == 1) & (differ & probed).any(1))
        d = np.linalg.norm(points - points[i], axis=1)
        want |= {(i, j): d[j] for j in sorted(np.flatnonzero(shares).tolist(), key=lambda j: (d[j], j))[:k]}
    assert got == pytest.approx(want)


def test_neighbours_send_no_table_of_rows_through_the_driver(spark, tmp_path):
    """Read from a small file, all rows pass for small: joins by their ids were broadcasts of the whole table."""
    x = np.random.default_rng(12).normal(size=(600, 2)) * [1, 9]
    rows = spark.createDataFrame([(i, *map(float, p), float(i % 5)) for i, p in enumerate(x)], "id bigint, a double, b double, y double")
    rows.write.parquet(str(tmp_path / "rows"))
    read = spark.read.parquet(str(tmp_path / "rows")).withColumn("_fold", (F.col("id") % 3).cast("int") + 1)
    spec, features = ModelSpec("knn", "knn", {"k": 4}), ["a", "b"]
    scored = models.fit_neighbours(read.filter("_fold != 1"), spec, features, "y", "id").predict(read.filter("_fold = 1"), "id")
    got = {r["id"]: r["prediction"] for r in scored.collect()}
    plan = scored._jdf.queryExecution().executedPlan().toString()       # as it was run
    joins = [line for line in plan.split("\n") if "HashJoin" in line]
    assert joins and all("cell#" in line for line in joins) and plan.count("SortMergeJoin") >= 3
    _, oof = models._fit_all(read, spec, features, "y", "id", 3, whole=False)
    assert "Join" not in oof._jdf.queryExecution().executedPlan().toString()        # each fold's search has been run by itself
    held = {r["id"]: r["prediction"] for r in oof.collect()}
    assert len(held) == 600 and {i: held[i] for i in got} == pytest.approx(got)
    for fold in range(3):
        train = np.array([i for i in range(600) if i % 3 != fold])
        near = brute(x[fold::3] / x[train].std(0), x[train] / x[train].std(0), train, 4)
        for i, n in zip(range(fold, 600, 3), near, strict=True):
            d = np.linalg.norm((x[n] - x[i]) / x[train].std(0), axis=1)
            assert held[i] == pytest.approx(np.average(np.array(n) % 5, weights=1 / d))
