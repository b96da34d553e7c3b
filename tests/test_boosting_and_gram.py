"""Histogram boosting and fold-wise moments against plain numpy."""

import gc

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from plumbline.operators import boosting, gram, models
from plumbline.operators.boosting import BoostSettings, fit_boosted
from plumbline.operators.models import ModelSpec


@pytest.fixture(scope="module")
def table(spark):
    r = np.random.default_rng(11)
    n = 1_500
    x = np.column_stack([r.integers(0, 40, n), r.normal(size=n).round(2), r.integers(0, 3, n), np.full(n, 7)]).astype(float)
    y = 2 * (x[:, 0] > 20) + np.sin(3 * x[:, 1]) + 0.5 * x[:, 2] + r.normal(size=n) * 0.1
    rows = [(i, *map(float, row), float(v), int(v > 1.5), 1 + i % 3) for i, (row, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, k double, y double, t int, fold int").repartition(5, "id")
    return df, x, y, np.array([row[-1] for row in rows])


FEATURES = ["a", "b", "c", "k"]


def plain_boost(x, g_of, base, s):
    """The same algorithm on all rows and columns, with sorted values in place of histograms."""
    margin, trees = np.full(len(x), base), []
    for _ in range(s.rounds):
        g, h = g_of(margin)
        node = {0: np.arange(len(x))}
        step = np.zeros(len(x))
        for _level in range(s.depth):
            following = {}
            for i, rows in node.items():
                gt, ht, best = g[rows].sum(), h[rows].sum(), (1e-12, None)
                for f in range(x.shape[1]):
                    for cut in np.unique(x[:, f])[:-1]:
                        left = x[rows, f] <= cut
                        gl, hl = g[rows][left].sum(), h[rows][left].sum()
                        if hl < s.least or ht - hl < s.least:
                            continue
                        gain = 0.5 * (gl**2 / (hl + s.penalty) + (gt - gl)**2 / (ht - hl + s.penalty) - gt**2 / (ht + s.penalty))
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, cut))
                if best[1] is None:
                    step[rows] = -s.rate * gt / (ht + s.penalty)
                    continue
                f, cut = best[1]
                for side, part in ((1, rows[x[rows, f] <= cut]), (2, rows[x[rows, f] > cut])):
                    step[part] = -s.rate * g[part].sum() / (h[part].sum() + s.penalty)
                    following[2 * i + side] = part
            node = following
        margin = margin + step
    return margin


@pytest.mark.parametrize("loss,block", [("squared", 200), ("logistic", 200), ("logistic", 1 << 16)])
def test_trees_equal_a_plain_fit(table, monkeypatch, loss, block):
    df, x, y, _ = table
    monkeypatch.setattr(boosting, "BLOCK_ROWS", block)
    monkeypatch.setattr(boosting, "SETTLE", 2)
    s = BoostSettings(rounds=3, rate=0.3, depth=2, subsample=1, columns=1, loss=loss, bins=256)
    fitted, = fit_boosted(df, FEATURES, "y" if loss == "squared" else "t", s)
    values = [sorted(set(x[:, f]))[:-1] for f in range(4)]
    few = [f for f in range(4) if len(values[f]) < 200]
    assert all(fitted.cuts[f] == values[f] for f in few) and fitted.cuts[3] == []
    x = np.column_stack([np.searchsorted(fitted.cuts[f], x[:, f], side="left") for f in range(4)]).astype(float)
    if loss == "squared":
        want = plain_boost(x, lambda m: (m - y, np.ones(len(y))), y.mean(), s)
    else:
        t = (y > 1.5).astype(float)
        p = lambda m: 1 / (1 + np.exp(-m))        # noqa: E731
        want = plain_boost(x, lambda m: (p(m) - t, p(m) * (1 - p(m))), np.log(t.mean() / (1 - t.mean())), s)
    raw = df.select(*FEATURES).toPandas()
    got = fitted.margins([raw[c].to_numpy() for c in FEATURES])
    assert np.allclose(np.sort(got), np.sort(want))


def test_folds_grow_with_the_whole(table):
    df, x, y, fold = table
    s = BoostSettings(rounds=4, rate=0.3, depth=3, subsample=1, columns=1)
    together = fit_boosted(df, ["a", "c"], "y", s, "fold", 3)         # every value is a cut, whatever fold is left out
    for i, model in enumerate(together):
        alone, = fit_boosted(df.filter(F.col("fold") != i) if i else df, ["a", "c"], "y", s)
        columns = [x[:, 0], x[:, 2]]
        assert np.allclose(model.margins(columns), alone.margins(columns))


def test_boosting_learns_samples_and_is_stored(table, spark, tmp_path):
    df, x, y, _ = table
    spec = ModelSpec("boosted", "boosted", {"rounds": 60, "rate": 0.2, "depth": 3, "subsample": 0.8, "columns": 0.5})
    model = models.fit_model(df, spec, FEATURES, "y")
    scored = models.predict(model, df)
    assert models.regression_metrics(scored, "y").first()["r2"] > 0.95
    model.write().overwrite().save(f"{tmp_path}/m")
    again = models.predict(PipelineModel.load(f"{tmp_path}/m"), df)
    assert again.exceptAll(scored).count() == 0
    trees = model.stages[0].model().trees
    used = [set(t[t >= 0].tolist()) for t in trees.feature]
    assert max(map(len, used)) <= 2 and set.union(*used) == {0, 1, 2}       # half of four columns a tree, the constant never
    flags = models.fit_model(df, ModelSpec("c", "boosted_classifier", {"rounds": 20, "rate": 0.3, "depth": 3}), FEATURES, "t")
    assert models.accuracy(models.predict(flags, df), "t").first()["accuracy"] > 0.95


def test_a_constant_target_and_odd_settings(table, spark):
    df, *_ = table
    flat = fit_boosted(df.withColumn("y", F.lit(3.0)), FEATURES, "y", BoostSettings(rounds=2, depth=2))[0]
    assert (flat.trees.feature == -1).all() and flat.base == 3.0
    with pytest.raises(ValueError):
        BoostSettings(loss="other")
    with pytest.raises(ValueError):
        fit_boosted(df.limit(0), FEATURES, "y", BoostSettings(rounds=1))
    with pytest.raises(Exception, match="complete rows"):
        fit_boosted(df.withColumn("a", F.when(F.col("id") > 3, F.col("a"))), FEATURES, "y", BoostSettings(rounds=1))


def closed(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    return np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)


def test_lines_of_all_folds_from_one_pass(table, monkeypatch):
    df, x, y, fold = table
    x = x[:, :3]
    for salts in (16, 2):
        monkeypatch.setattr(gram, "MERGERS", salts)
        for kind, alpha in (("linear", 0.0), ("ridge", 5.0)):
            lines = gram.fit_lines(df, FEATURES[:3], "y", kind, {"alpha": alpha}, False, "fold", 3)
            for i, line in enumerate(lines):
                use = fold != i if i else np.ones(len(y), bool)
                assert np.allclose(line.weights, closed(x[use], y[use], alpha))
                assert line.intercept == pytest.approx(y[use].mean() - x[use].mean(0) @ line.weights)
    oof = df.withColumn("prediction", gram.by_fold(lines, "fold")).orderBy("id").toPandas()["prediction"]
    want = [lines[f].intercept + row @ np.array(lines[f].weights) for row, f in zip(x, fold)]
    assert np.allclose(oof, want)


def test_collinear_constant_and_far_columns(spark):
    r = np.random.default_rng(1)
    a = r.normal(size=300)
    y = 3 * a + 1
    df = spark.createDataFrame([(float(v + 1e8), float(2 * v), 5.0, float(t)) for v, t in zip(a, y)], "a double, b double, k double, y double")
    for scaled in (False, True):
        line, = gram.fit_lines(df, ["a", "b", "k"], "y", "linear", scaled=scaled)
        got = np.array([line.intercept + row["a"] * line.weights[0] + row["b"] * line.weights[1] for row in df.collect()])
        assert np.allclose(got, y, atol=1e-5) and line.weights[2] == 0
    empty, = gram.fit_lines(df, [], "y", "linear")
    assert empty.intercept == pytest.approx(y.mean())
    with pytest.raises(ValueError):
        gram.fit_lines(df.limit(0), ["a"], "y", "linear")


def test_lasso_meets_its_conditions(table):
    df, x, y, _ = table
    line, = gram.fit_lines(df, FEATURES, "y", "lasso", {"alpha": 0.05})
    w = np.array(line.weights)
    pull = (x - x.mean(0)).T @ (y - y.mean() - (x - x.mean(0)) @ w) / len(y)
    assert np.allclose(np.abs(pull[w != 0]), 0.05, atol=1e-6) and (np.abs(pull[w == 0]) <= 0.05 + 1e-9).all() and w[3] == 0


def test_models_side_by_side_stop_at_a_failure(spark):
    import time

    def slow():
        spark.range(1).repartition(1).rdd.map(lambda x: time.sleep(120)).count()

    def bad():
        time.sleep(1)
        raise KeyError("no")

    start = time.monotonic()
    with pytest.raises(KeyError):
        models.side_by_side([slow, bad, slow], spark.range(1), most=3)
    assert time.monotonic() - start < 60
    assert models.side_by_side([lambda: 1, lambda: 2, lambda: 3], spark.range(1), most=2) == [1, 2, 3]


@pytest.mark.parametrize("gathered", [1 << 20, 0])
def test_a_level_is_one_job_and_gives_the_trees_of_one_task(table, spark, monkeypatch, gathered):
    df, x, y, _ = table
    s = BoostSettings(rounds=5, rate=0.3, depth=3, subsample=0.7, columns=0.75, loss="logistic")
    once = fit_boosted(df, FEATURES, "t", s, "fold", 3)
    monkeypatch.setattr(boosting, "TASK_ROWS", 100)
    monkeypatch.setattr(boosting, "SETTLE", 2)
    monkeypatch.setattr(boosting, "GATHERED_BYTES", gathered)
    tag = f"levels-{gathered}"
    spark.sparkContext.setJobGroup(tag, tag)
    again = fit_boosted(df, FEATURES, "t", s, "fold", 3)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(tag)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= s.rounds * s.depth + 12        # levels, and what cuts and settles the blocks
    for a, b in zip(once, again, strict=True):
        assert (a.trees.feature == b.trees.feature).all() and (a.trees.bin == b.trees.bin).all() and np.allclose(a.trees.value, b.trees.value)


def test_workers_of_level_jobs_set_aside_what_they_loaded(spark, monkeypatch):
    """Thousands of short jobs: a sweep of everything loaded after each task was much of their time."""
    monkeypatch.setattr(boosting, "TASK_ROWS", 10)
    df = spark.createDataFrame([(float(i % 7), float(i % 7 > 3)) for i in range(200)], "a double, y double").repartition(4)
    boosting.fit_boosted(df, ["a"], "y", boosting.BoostSettings(rounds=2, depth=2))
    frozen = spark.sparkContext.parallelize(range(4), 4).mapPartitions(lambda _: [gc.get_freeze_count()]).collect()
    assert max(frozen) > 0


def test_a_level_draws_the_rows_of_a_block_once_for_all_models(monkeypatch):
    r = np.random.default_rng(5)
    block = boosting.Block(r.integers(0, 9, (2, 300)).astype(np.uint8), r.normal(size=300), r.integers(1, 4, 300).astype(np.int32), np.zeros((4, 300)))
    s, drawn = BoostSettings(subsample=0.6, columns=1, depth=2), []
    take = boosting._sampled
    monkeypatch.setattr(boosting, "_sampled", lambda *a: drawn.append(a) or take(*a))
    growing, total = [boosting._seedling(s, 3, m, 2) for m in range(4)], {}
    boosting._add_sums(total, 7, block, growing, 3, s, True, [9, 9])
    assert len(drawn) == 1
    rows = take(s, 3, 7, 300)
    for m in range(4):
        inside = rows & (block.fold != m) if m else rows
        for f in range(2):
            g, h = total[m, f]
            assert np.allclose(g[0], np.bincount(block.bins[f][inside], -block.y[inside], 9)) and h.sum() == inside.sum()


def test_level_jobs_take_blocks_as_arrays(spark):
    """Every level of every tree reads all blocks: unpacking them each time was much of a level's work."""
    y = np.arange(6.0)
    block = boosting.Block(np.zeros((1, 6), np.uint8), y, np.zeros(6, np.int32), np.zeros((1, 6)))
    blocks = spark.createDataFrame([(2, bytearray(block.pack())), (1, bytearray(block.pack()))], boosting.BLOCK_SCHEMA).coalesce(1)
    first = boosting._unpacked(blocks, 1).persist(boosting.AS_ARRAYS)
    trees = [boosting.Trees.empty(0).with_tree(np.array([-1]), np.array([0]), np.array([0.5]))]
    carried = boosting._carried(first, first, trees, 1)
    held = carried.collect()
    assert first.getStorageLevel().deserialized and carried.getStorageLevel().deserialized
    assert [n for n, _ in held] == [1, 2]
    assert all(isinstance(b, boosting.Block) and (b.margins == 0.5).all() and (b.y == y).all() for _, b in held)


@pytest.mark.parametrize("depth", [0, 1, 3, 6, 7])
def test_rows_are_placed_alike_by_masks_and_by_steps(monkeypatch, depth):
    r = np.random.default_rng(depth)
    nodes = 2**(depth + 1) - 1
    feature, cut = np.full(nodes, -1, np.int32), r.integers(0, 256, nodes).astype(np.int32)
    for i in range(nodes // 2):      # inner nodes of a tree that may end early
        if (i == 0 or feature[(i - 1) // 2] >= 0) and (depth > 5 or r.random() < 0.8 or i == 0):
            feature[i] = r.integers(0, 4)
    bins = r.integers(0, 256, (4, 2_000)).astype(np.uint8)
    at = np.zeros(2_000, int)
    for _ in range(depth):
        inner = feature[at] >= 0
        right = bins[feature[at], np.arange(2_000)] > cut[at]
        at = np.where(inner, 2 * at + 1 + right, at)
    calls, by_masks = [], boosting._leaf_by_masks
    monkeypatch.setattr(boosting, "_leaf_by_masks", lambda *a: calls.append(a) or by_masks(*a))
    assert (boosting.leaf_of(feature, cut, bins) == at).all() and len(calls) == (depth < 7)
    monkeypatch.setattr(boosting, "MASKED_FEATURES", -1)
    assert (boosting.leaf_of(feature, cut, bins) == at).all() and len(calls) == (depth < 7)
