"""Splits, models, leaderboards and scoring."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plumbline.catalog.base import LINE_NUMBERS, lineitem, query, round_all, rounded, table
from plumbline.catalog.profiling import WIDTH, embeddings
from plumbline.operators import knn, models, score, split
from plumbline.operators.models import ModelSpec
from plumbline.plans import preprocess, train

ORDER_HASH = "md5('42|' || o_orderkey::VARCHAR)"


# ---------------------------------------------------------------------- splits

@query(f"""SELECT o_orderkey, row_number() OVER (ORDER BY {ORDER_HASH}, o_orderkey)
  <= ceil((SELECT count(*) FROM orders) * 0.2::DOUBLE) AS is_test FROM orders""")
def split_train_test(spark, folder):
    orders = table(spark, folder, "orders")
    return split.fit_split(orders, "o_orderkey", 0.2, 42).marked(orders).select("o_orderkey", "is_test")


@query("""
WITH s AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality),
t AS (SELECT sum(n) - ceil(sum(n) * 0.2::DOUBLE) AS want, sum(n) AS total FROM s),
x AS (SELECT quality, n, n * want / total AS exact, floor(n * want / total) AS given, want FROM s, t),
y AS (SELECT quality, n, given, want, row_number() OVER (ORDER BY exact - given DESC, quality::VARCHAR) AS r FROM x),
z AS (SELECT quality, n - given - (r <= want - (SELECT sum(given) FROM y))::INT AS tests FROM y)
SELECT doc_id, l.quality, row_number() OVER (PARTITION BY l.quality ORDER BY md5('42|' || doc_id::VARCHAR), doc_id) <= tests AS is_test
FROM labels l JOIN z ON l.quality = z.quality""")
def split_stratified(spark, folder):
    labels = table(spark, folder, "labels")
    fitted = split.fit_split(labels, "doc_id", 0.2, 42, "quality")
    return fitted.marked(labels).select("doc_id", "quality", "is_test")


@query("""
WITH s AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
t AS (SELECT (sum(n) - ceil(sum(n) * 0.2::DOUBLE))::HUGEINT AS want, sum(n)::HUGEINT AS total FROM s),
x AS (SELECT o_custkey, n, (n * want) // total AS given, (n * want) % total AS rest, want FROM s, t),
y AS (SELECT *, row_number() OVER (ORDER BY rest DESC, o_custkey::VARCHAR) AS r FROM x),
z AS (SELECT o_custkey, n - given - (r <= want - (SELECT sum(given) FROM y))::INT AS tests FROM y)
SELECT o_orderkey, row_number() OVER (PARTITION BY o.o_custkey ORDER BY md5('42|' || o_orderkey::VARCHAR), o_orderkey) <= tests AS is_test
FROM orders o JOIN z ON o.o_custkey = z.o_custkey""")
def split_many_strata(spark, folder):
    orders = table(spark, folder, "orders")
    return split.fit_split(orders, "o_orderkey", 0.2, 42, "o_custkey").marked(orders).select("o_orderkey", "is_test")


@query(f"SELECT o_orderkey, ntile(5) OVER (ORDER BY {ORDER_HASH}, o_orderkey)::INT AS fold FROM orders")
def kfold_assign(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select("o_orderkey", split.fit_folds(orders, "o_orderkey", 5, 42).alias("fold"))


# --------------------------------------------------------------------- metrics

@query("""WITH s AS (SELECT l_extendedprice AS y, l_quantity * 2000 AS p FROM lineitem)
SELECT round(avg(abs(y - p)), 4) AS mae, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
  round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2 FROM s""")
def regression_metrics(spark, folder):
    pairs = lineitem(spark, folder).select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2000).alias("prediction"))
    out = models.regression_metrics(pairs)
    return out.select(rounded(F.col("mae"), 4).alias("mae"), rounded(F.col("rmse"), 4).alias("rmse"), rounded(F.col("r2")).alias("r2"))


@query("""SELECT round(avg((quality = (CASE WHEN n_chars > 500 THEN 1 ELSE 0 END))::INT), 6) AS accuracy
FROM labels JOIN documents USING (doc_id)""")
def accuracy(spark, folder):
    joined = table(spark, folder, "labels").join(table(spark, folder, "documents"), "doc_id")
    guess = F.when(F.col("n_chars") > 500, 1).otherwise(0)
    return round_all(models.accuracy(joined.select(F.col("quality").alias("y"), guess.alias("prediction"))))


@query("""WITH p AS (SELECT o_orderkey, o_custkey * 100.0::DOUBLE AS p FROM orders WHERE o_orderkey % 3 <> 0)
SELECT round(avg(abs(o_totalprice - p)), 4) AS mae, round(sqrt(avg(pow(o_totalprice - p, 2))), 4) AS rmse,
  round(1 - sum(pow(o_totalprice - p, 2)) / (var_pop(o_totalprice) * count(*)), 6) AS r2 FROM orders JOIN p USING (o_orderkey)""")
def align_by_key(spark, folder):
    orders = table(spark, folder, "orders")
    predictions = orders.filter("o_orderkey % 3 <> 0").select(
        "o_orderkey", (F.col("o_custkey") * F.lit(100.0)).alias("prediction"))
    out = score.evaluate_predictions(orders, predictions, "o_totalprice", key="o_orderkey")
    return out.select(rounded(F.col("mae"), 4).alias("mae"), rounded(F.col("rmse"), 4).alias("rmse"), rounded(F.col("r2")).alias("r2"))


@query("""
WITH t AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS position, o_totalprice AS y FROM orders),
p AS (SELECT row_number() OVER (ORDER BY o_orderkey DESC) - 1 AS position, o_custkey::DOUBLE AS prediction FROM orders)
SELECT position, y, prediction FROM t JOIN p USING (position)""")
def align_by_order(spark, folder):
    orders = table(spark, folder, "orders")
    predictions = orders.select((-F.col("o_orderkey")).alias("o_orderkey"), F.col("o_custkey").cast("double").alias("prediction"))
    return score.align_by_order(orders, predictions, "o_orderkey", "o_totalprice")


@query("""
WITH t AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS position, o_totalprice AS y FROM orders),
p AS (SELECT row_number() OVER (ORDER BY o_orderkey DESC) - 1 AS position, o_custkey::DOUBLE AS prediction FROM orders)
SELECT position, y, prediction FROM t JOIN p USING (position)""")
def align_by_large_order(spark, folder):
    orders = table(spark, folder, "orders").withColumn("o_orderkey", F.col("o_orderkey") + F.lit(1 << 60))
    predictions = orders.select((-F.col("o_orderkey")).alias("o_orderkey"), F.col("o_custkey").cast("double").alias("prediction"))
    return score.align_by_order(orders, predictions, "o_orderkey", "o_totalprice")


# ---------------------------------------------------------------------- models

def _orders_split(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").cast("double").alias("x"),
                                                   F.col("o_totalprice").alias("y"))
    return split.train_test(orders, "o_orderkey", 0.2, 42)


ORDER_SPLIT = f"""o AS (SELECT o_orderkey, o_custkey::DOUBLE AS x, o_totalprice AS y, row_number() OVER (ORDER BY {ORDER_HASH}, o_orderkey)
  <= ceil((SELECT count(*) FROM orders) * 0.2::DOUBLE) AS test FROM orders), tr AS (SELECT * FROM o WHERE NOT test), te AS (SELECT * FROM o WHERE test)"""


def _scores(prediction):
    return f"""SELECT round(avg(abs(y - p)), 3) AS mae, round(sqrt(avg(pow(y - p, 2))), 3) AS rmse,
  round(1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*)), 6) AS r2 FROM (SELECT y, {prediction} AS p FROM te, f)"""


def _fit_and_score(spark, folder, spec):
    """``spec``, or what makes it from the training rows, fitted and scored on one split."""
    tr, te = _orders_split(spark, folder)
    spec = spec(tr) if callable(spec) else spec
    out = models.regression_metrics(models.predict(models.fit_model(tr, spec, ["x"], "y"), te))
    return out.select(rounded(F.col("mae"), 3).alias("mae"), rounded(F.col("rmse"), 3).alias("rmse"), rounded(F.col("r2")).alias("r2"))


@query(f"WITH {ORDER_SPLIT}, f AS (SELECT avg(y) AS m FROM tr) {_scores('m')}")
def dummy_mean(spark, folder):
    return _fit_and_score(spark, folder, ModelSpec("dummy", "mean"))


@query("""WITH m AS (SELECT quality FROM labels GROUP BY quality ORDER BY count(*) DESC, quality LIMIT 1)
SELECT round(avg((l.quality = m.quality)::INT), 6) AS accuracy FROM labels l, m""")
def dummy_most_frequent(spark, folder):
    labels = table(spark, folder, "labels")
    model = models.fit_model(labels, ModelSpec("dummy", "most_frequent"), ["toxic"], "quality")
    return round_all(models.accuracy(models.predict(model, labels), "quality"))


@query(f"WITH {ORDER_SPLIT}, f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM tr) {_scores('a + b * x')}")
def linear(spark, folder):
    return _fit_and_score(spark, folder, ModelSpec("linear", "linear", scaled=True))


ALPHA = 20000.0


@query(f"""WITH {ORDER_SPLIT}, f AS (SELECT covar_pop(y, x) * count(*) / (var_pop(x) * count(*) + {ALPHA} * count(*)) AS b,
  avg(y) AS my, avg(x) AS mx FROM tr) {_scores('my + b * (x - mx)')}""")
def ridge(spark, folder):
    return _fit_and_score(spark, folder, lambda tr: ModelSpec("ridge", "ridge", {"alpha": ALPHA * tr.count()}))


@query(f"""WITH {ORDER_SPLIT}, f AS (SELECT sign(covar_pop(y, x)) * greatest(0, abs(covar_pop(y, x)) - 100) / var_pop(x) AS b,
  avg(y) AS my, avg(x) AS mx FROM tr) {_scores('my + b * (x - mx)')}""")
def lasso(spark, folder):
    return _fit_and_score(spark, folder, ModelSpec("lasso", "lasso", {"alpha": 100.0}))


@query(f"""WITH {ORDER_SPLIT}, k AS (SELECT *, ntile(5) OVER (ORDER BY {ORDER_HASH}, o_orderkey) AS fold FROM tr),
s AS (SELECT a.fold, avg(b.y) AS p FROM (SELECT DISTINCT fold FROM k) a JOIN k b ON a.fold <> b.fold GROUP BY a.fold)
SELECT o_orderkey, y, round(p, 4) AS prediction FROM k JOIN s USING (fold)""")
def out_of_fold(spark, folder):
    tr, _ = _orders_split(spark, folder)
    out = models.out_of_fold(tr, ModelSpec("dummy", "mean"), ["x"], "y", "o_orderkey", 5, 42)
    return out.select("o_orderkey", "y", rounded(F.col("prediction"), 4).alias("prediction"))


NUMBERS = ["l_quantity", "l_discount", "l_tax"]


def _line_split(spark, folder):
    rows = lineitem(spark, folder).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_key"),
        *NUMBERS, F.col("l_extendedprice").alias("price"))
    return split.train_test(rows, "row_key", 0.2, 42)


PART_FEATURES = ["size", "brand", "name_length", "serial"]
PARTS = """p AS (SELECT p_partkey, p_retailprice AS y, p_size::DOUBLE AS size, regexp_extract(p_brand, '[0-9]+')::DOUBLE AS brand,
  length(p_name)::DOUBLE AS name_length, (p_partkey % 1000)::DOUBLE AS serial FROM part)"""
PART_SPLIT = PARTS + """, o AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || p_partkey::VARCHAR), p_partkey)
  <= ceil((SELECT count(*) FROM part) * 0.2::DOUBLE) AS test FROM p), tr AS (SELECT * FROM o WHERE NOT test), te AS (SELECT * FROM o WHERE test)"""


def _parts(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", F.col("p_retailprice").alias("y"), F.col("p_size").cast("double").alias("size"),
        F.regexp_extract("p_brand", "[0-9]+", 0).cast("double").alias("brand"), F.length("p_name").cast("double").alias("name_length"),
        (F.col("p_partkey") % 1000).cast("double").alias("serial"))


def _part_model(spark, folder, spec):
    """Fitted on the log of the price, scored on the price."""
    tr, te = split.train_test(_parts(spark, folder), "p_partkey", 0.2, 42)
    logged = tr.withColumn("label", F.log1p("y"))
    return models.regression_metrics(models.predict(models.fit_model(logged, spec, PART_FEATURES, "label"), te, "log1p"))


def _sweep(name):
    return next(s for s in models.sweep_specs() if s.name == name)


@query()
def tree(spark, folder):
    return _part_model(spark, folder, _sweep("tree"))


def _suppliers(spark, folder):
    rows = table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").cast("double").alias("nation"),
                                                   (F.col("s_suppkey") % 100).cast("double").alias("serial"), F.col("s_acctbal").alias("y"))
    return split.train_test(rows, "s_suppkey", 0.2, 42)


@query()
def forest(spark, folder):
    """300 trees without a depth limit, which grow thousands of nodes each on larger tables."""
    tr, te = _suppliers(spark, folder)
    return models.regression_metrics(models.predict(models.fit_model(tr, _sweep("random_forest"), ["nation", "serial"], "y"), te))


@query()
def boosted(spark, folder):
    return _part_model(spark, folder, models.boosting_specs()[0])


# The best first split by squared error, with the sums of y on both sides of it.
STUMP = f"""WITH {PARTS}, m AS (SELECT avg(y) AS m FROM p),
v AS (SELECT 1 AS f, size AS x, y FROM p UNION ALL SELECT 2, brand, y FROM p UNION ALL SELECT 3, name_length, y FROM p),
s AS (SELECT f, x, sum(m - y) AS g, count(*)::DOUBLE AS h FROM v, m GROUP BY f, x),
t AS (SELECT f, x, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY f) AS gt, sum(h) OVER (PARTITION BY f) AS ht
  FROM s WINDOW w AS (PARTITION BY f ORDER BY x)),
u AS (SELECT *, gl * gl / (hl + @L) + pow(gt - gl, 2) / (ht - hl + @L) - gt * gt / (ht + @L) AS gain FROM t WHERE hl >= 1 AND ht - hl >= 1),
best AS (SELECT * FROM u ORDER BY gain DESC, f, x LIMIT 1)
SELECT p_partkey, round(m - @R * CASE WHEN CASE best.f WHEN 1 THEN size WHEN 2 THEN brand ELSE name_length END <= best.x
  THEN gl / (hl + @L) ELSE (gt - gl) / (ht - hl + @L) END, 4) AS prediction FROM p, m, best"""


def _stump(spark, folder, spec):
    rows = _parts(spark, folder)
    out = models.predict(models.fit_model(rows, spec, PART_FEATURES[:3], "y"), rows)
    return out.select("p_partkey", rounded(F.col("prediction"), 4).alias("prediction"))


@query(STUMP.replace("@L", "1").replace("@R", "0.05::DOUBLE"))
def boosted_one_round(spark, folder):
    return _stump(spark, folder, ModelSpec("boosted", "boosted", {"rounds": 1, "depth": 1, "rate": 0.05}))


@query(STUMP.replace("@L", "0").replace("@R", "1"))
def tree_one_split(spark, folder):
    return _stump(spark, folder, ModelSpec("tree", "tree", {"depth": 1}))


def _beats_mean(scored, y="y"):
    """Rows, the mean absolute error of the best constant guess, and whether the model's is lower."""
    mean = scored.agg(F.avg(y)).first()[0]
    return scored.agg(F.count(F.lit(1)).alias("n"), rounded(F.avg(F.abs(F.col(y) - F.lit(mean))), 4).alias("mean_mae"),
                      (F.avg(F.abs(F.col(y) - F.col("prediction"))) < F.avg(F.abs(F.col(y) - F.lit(mean)))).alias("beats_mean"))


@query(f"""WITH {PART_SPLIT} SELECT count(*) AS n, round(avg(abs(y - m)), 4) AS mean_mae, true AS beats_mean
FROM te, (SELECT avg(y) AS m FROM te)""")
def boosted_beats_mean(spark, folder):
    tr, te = split.train_test(_parts(spark, folder), "p_partkey", 0.2, 42)
    return _beats_mean(models.predict(models.fit_model(tr, models.boosting_specs()[0], PART_FEATURES, "y"), te))


def _quality(spark, folder):
    docs = table(spark, folder, "documents").select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", " ")).cast("double").alias("n_words"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"))
    rows = table(spark, folder, "labels").join(docs, "doc_id")
    return *split.train_test(rows, "doc_id", 0.2, 42, "quality"), ["n_chars", "n_words", "n_lines"]


def _quality_model(spark, folder, spec):
    tr, te, features = _quality(spark, folder)
    return models.accuracy(models.predict(models.fit_model(tr, spec, features, "quality"), te), "quality")


@query()
def logistic(spark, folder):
    return _quality_model(spark, folder, ModelSpec("logistic", "logistic", scaled=True))


@query("""SELECT 'intercept' AS weight, 0.0::DOUBLE AS slope UNION ALL SELECT unnest(['n_chars', 'n_words', 'n_lines']), 0.0""")
def logistic_gradient(spark, folder):
    """At the optimum the mean gradient of log loss and penalty vanishes in every weight."""
    tr, _, features = _quality(spark, folder)
    model = models.fit_model(tr, ModelSpec("logistic", "logistic", scaled=True), features, "quality")
    weights = model.stages[-1].coefficients.toArray().tolist()
    scored = model.transform(tr).withColumn("e", vector_to_array("probability")[1] - F.col("quality"))
    means = scored.agg(F.avg("e").alias("intercept"), F.count(F.lit(1)).alias("n"), *[F.avg(F.col("e") * F.col(f"_z_{c}")).alias(c) for c in features])
    return means.select(F.explode(F.array(*[F.struct(F.lit(c).alias("weight"), rounded(F.col(c) + F.lit(w) / F.col("n"), 3).alias("slope"))
                                            for c, w in zip(["intercept", *features], [0.0, *weights])])).alias("r")).select("r.*")


@query()
def forest_classifier(spark, folder):
    return _quality_model(spark, folder, models.baseline_specs("classification", ["random_forest"])[0])


@query()
def boosted_classifier(spark, folder):
    return _quality_model(spark, folder, models.boosting_specs("classification")[0])


# Squared differences over the vector, on doubles, as the engine computes them.
_GAP = "sqrt(list_sum(list_transform(list_zip(q.embedding, t.embedding), lambda z: pow(z[1]::DOUBLE - z[2]::DOUBLE, 2))))"
NEIGHBOURS = f"""pairs AS (SELECT q.vec_id AS query_id, q.label AS truth, t.vec_id AS train_id, t.label AS y, {_GAP} AS d
  FROM embeddings q JOIN embeddings t ON q.vec_id % 5 = 0 AND t.vec_id % 5 <> 0),
near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, train_id) AS r FROM pairs) WHERE r <= 15)"""


def _vectors(spark, folder):
    rows = embeddings(spark, folder)
    return rows.filter("vec_id % 5 = 0"), rows.filter("vec_id % 5 <> 0"), [f"e{i}" for i in range(WIDTH)]


@query(f"WITH {NEIGHBOURS} SELECT query_id, train_id, round(d, 6) AS distance FROM near")
def knn_join(spark, folder):
    queries, rows, features = _vectors(spark, folder)
    out = knn.knn_join(queries.withColumnRenamed("vec_id", "query_id"), rows.withColumnRenamed("vec_id", "train_id"),
                       features, "query_id", "train_id", 15)
    return round_all(out)


@query(f"""WITH {NEIGHBOURS} SELECT query_id, round(coalesce(avg(y) FILTER (d = 0),
  sum(y / d) FILTER (d > 0) / sum(1 / d) FILTER (d > 0)), 6) AS prediction FROM near GROUP BY query_id""")
def knn_regress(spark, folder):
    queries, rows, features = _vectors(spark, folder)
    out = knn.knn_regress(queries.withColumnRenamed("vec_id", "query_id"), rows, features, "query_id", "vec_id", "label", 15)
    return round_all(out)


# ---------------------------------------------------------------- whole jobs

@query()
def model_scores(spark, folder):
    """The baselines at their settings: dummy, linear, forest of 200 trees."""
    tr, te = _suppliers(spark, folder)
    return models.train_and_evaluate(tr, te, ["nation", "serial"], "y", models.baseline_specs())


@query(f"""WITH {ORDER_SPLIT}, f AS (SELECT avg(ln(1 + y)) AS m FROM tr), g AS (SELECT exp(m) - 1 AS p FROM f),
k AS (SELECT *, ntile(5) OVER (ORDER BY {ORDER_HASH}, o_orderkey) AS fold FROM tr),
s AS (SELECT a.fold, exp(avg(ln(1 + b.y))) - 1 AS p FROM (SELECT DISTINCT fold FROM k) a JOIN k b ON a.fold <> b.fold GROUP BY a.fold),
oof AS (SELECT y, p FROM k JOIN s USING (fold)), t AS (SELECT y, p FROM te, g)
SELECT 'dummy' AS model, 1::INT AS features,
  (SELECT round(avg(abs(y - p)), 2) FROM oof) AS mae_train, (SELECT round(sqrt(avg(pow(y - p, 2))), 2) FROM oof) AS rmse_train,
  (SELECT round(1 - avg(pow(y - p, 2)) / var_pop(y), 4) + 0.0 FROM oof) AS r2_train,
  (SELECT round(avg(abs(y - p)), 2) FROM t) AS mae_test, (SELECT round(sqrt(avg(pow(y - p, 2))), 2) FROM t) AS rmse_test,
  (SELECT round(1 - avg(pow(y - p, 2)) / var_pop(y), 4) + 0.0 FROM t) AS r2_test""")
def leaderboard(spark, folder):
    tr, te = _orders_split(spark, folder)
    board, _ = models.leaderboard(tr, te, ["x"], "y", "o_orderkey", [ModelSpec("dummy", "mean")])
    return board


def _test_scores(name, prediction):
    return f"""SELECT '{name}' AS model, round(avg(abs(y - p)), 2) AS mae_test, round(sqrt(avg(pow(y - p, 2))), 2) AS rmse_test,
  round(1 - avg(pow(y - p, 2)) / var_pop(y), 4) + 0.0 AS r2_test FROM (SELECT y, {prediction} AS p FROM te, f)"""


@query(f"""WITH {ORDER_SPLIT}, f AS (SELECT avg(ln(1 + y)) AS m, regr_slope(ln(1 + y), x) AS b, regr_intercept(ln(1 + y), x) AS a FROM tr)
{_test_scores('dummy', 'exp(m) - 1')} UNION ALL {_test_scores('linear', 'exp(a + b * x) - 1')}""")
def train_family(spark, folder):
    tr, te = _orders_split(spark, folder)
    done = train.train_model(tr, te, ["x"], "y", "o_orderkey", "baseline", log_target=True, names=["dummy", "linear"])
    return done.board.select("model", "mae_test", "rmse_test", "r2_test")


@query()
def classification_scores(spark, folder):
    """The baselines at their settings: dummy, logistic, forest of 200 trees."""
    tr, te, features = _quality(spark, folder)
    return models.train_and_evaluate(tr, te, features, "quality", models.baseline_specs("classification"), "classification")


def _board_side(name, rows):
    return (f"SELECT '{name}' AS model, round(avg(abs(y - p)), 2) AS mae, round(sqrt(avg(pow(y - p, 2))), 2) AS rmse, "
            f"round(1 - avg(pow(y - p, 2)) / var_pop(y), 4) + 0.0 AS r2 FROM {rows}")


_SLOPES = """covar_pop(b.y, b.x) / var_pop(b.x) AS linear, covar_pop(b.y, b.x) / var_pop(b.x) * count(*) / (count(*) + 5) AS ridge,
  avg(b.x) AS mx, avg(b.y) AS my"""


@query(f"""WITH {ORDER_SPLIT}, k AS (SELECT *, ntile(5) OVER (ORDER BY {ORDER_HASH}, o_orderkey) AS fold FROM tr),
f AS (SELECT a.fold, {_SLOPES} FROM (SELECT DISTINCT fold FROM k) a JOIN k b ON a.fold <> b.fold GROUP BY a.fold),
w AS (SELECT {_SLOPES} FROM tr b),
train AS ({_board_side('linear', '(SELECT y, my + linear * (x - mx) AS p FROM k JOIN f USING (fold))')}
  UNION ALL {_board_side('ridge', '(SELECT y, my + ridge * (x - mx) AS p FROM k JOIN f USING (fold))')}),
test AS ({_board_side('linear', '(SELECT y, my + linear * (x - mx) AS p FROM te, w)')}
  UNION ALL {_board_side('ridge', '(SELECT y, my + ridge * (x - mx) AS p FROM te, w)')})
SELECT model, 1::INT AS features, train.mae AS mae_train, train.rmse AS rmse_train, train.r2 AS r2_train,
  test.mae AS mae_test, test.rmse AS rmse_test, test.r2 AS r2_test FROM train JOIN test USING (model)""")
def leaderboard_linear(spark, folder):
    """Five folds and two penalties from one pass over the rows."""
    tr, te = _orders_split(spark, folder)
    return models.leaderboard(tr, te, ["x"], "y", "o_orderkey", [s for s in models.sweep_specs() if s.name in ("linear", "ridge")], "none")[0]


@query()
def leaderboard_knn(spark, folder):
    tr, te = split.train_test(_parts(spark, folder), "p_partkey", 0.2, 42)
    return models.leaderboard(tr, te, PART_FEATURES, "y", "p_partkey", [ModelSpec("dummy", "mean"), _sweep("knn")])[0]


@query()
def leaderboard_sweep(spark, folder):
    """Five folds of linear, ridge, tree and 250 rounds of boosting, side by side."""
    tr, te = split.train_test(_parts(spark, folder), "p_partkey", 0.2, 42)
    specs = [s for s in models.sweep_specs() if s.name in ("linear", "ridge", "tree", "boosted")]
    return models.leaderboard(tr, te, PART_FEATURES, "y", "p_partkey", specs)[0]


@query("SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem), 5) + 0.0 AS {c}"
    for c in LINE_NUMBERS) + " FROM lineitem")
def preprocess_table(spark, folder):
    df = lineitem(spark, folder).select("l_orderkey", "l_linenumber", *LINE_NUMBERS)
    return round_all(preprocess.preprocess(df, ["l_orderkey", "l_linenumber"]).scaled, 5)


@query(f"""WITH {ORDER_SPLIT}, f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM tr)
SELECT r2, rmse FROM ({_scores('a + b * x')})""")
def train_eval(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").cast("double").alias("x"), "o_totalprice")
    _, metrics = train.train_eval(orders, train.TrainConfig("o_orderkey", "o_totalprice"))
    return metrics.select(rounded(F.col("r2")).alias("r2"), rounded(F.col("rmse"), 3).alias("rmse"))


@query()
def experiment(spark, folder):
    """The configured experiment: a redundant column to prune, 300 rounds of boosting and the linear baseline over five folds."""
    rows = _parts(spark, folder).withColumn("doubled", F.col("size") * 2 + F.col("brand") * 0.01)
    config = train.ExperimentConfig("p_partkey", "y", baselines=("linear",), target_transform="log1p")
    return train.run_experiment(rows, config).board


@query(f"""WITH {ORDER_SPLIT}, f AS (SELECT regr_slope(ln(1 + y), x) AS b, regr_intercept(ln(1 + y), x) AS a FROM tr)
SELECT o_orderkey, round(exp(a + b * x) - 1, 3) AS prediction FROM o, f""")
def score_batch(spark, folder):
    tr, te = _orders_split(spark, folder)
    model = models.fit_model(tr.withColumn("label", F.log1p("y")), ModelSpec("linear", "linear"), ["x"], "label")
    scored = train.score_table(tr.unionByName(te), model, ["x"], ["o_orderkey"], "log1p")
    return scored.select("o_orderkey", rounded(F.col("prediction"), 3).alias("prediction"))
