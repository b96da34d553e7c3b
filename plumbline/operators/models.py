"""Regression and classification models, cross-validation and leaderboards.

A model is a fitted ``PipelineModel`` that takes the raw feature columns, so
it can be saved, loaded and applied on its own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.cells import target_forward, target_inverse
from plumbline.operators.boosting import BoostedTrees, BoostSettings, Ensemble, fit_boosted
from plumbline.operators.gram import SOLVERS, Moments, by_fold, fit_lines, fold_moments
from plumbline.operators.knn import NeighbourIndex, build_index
from plumbline.operators.ordering import modes
from plumbline.operators.scale import Scaler, fit_standard
from plumbline.operators.split import fit_folds
from plumbline.session import materialised, side_by_side

MAX_DEPTH = 30   # the deepest tree Spark builds: stands for "no depth limit"


@dataclass(frozen=True)
class ModelSpec:
    """How to build one named model.

    ``kind`` names the algorithm; ``params`` its settings; ``scaled`` puts
    fitted standardisation in front.
    """

    name: str
    kind: str
    params: Mapping[str, float] = field(default_factory=dict)
    scaled: bool = False


def baseline_specs(task: str = "regression", names: Sequence[str] = (), seed: int = 42,
                   trees: int = 200) -> list[ModelSpec]:
    """The simple candidates of a task; ``names`` picks a subset."""
    by_task = {
        "regression": [
            ModelSpec("dummy", "mean"),
            ModelSpec("linear", "linear", scaled=True),
            ModelSpec("random_forest", "forest", {"trees": trees, "seed": seed}),
        ],
        "classification": [
            ModelSpec("dummy", "most_frequent"),
            ModelSpec("logistic", "logistic", {"iterations": 1000}, scaled=True),
            ModelSpec("random_forest", "forest_classifier", {"trees": trees, "seed": seed}),
        ],
    }
    return _picked(by_task, task, names)


def boosting_specs(task: str = "regression", names: Sequence[str] = (), seed: int = 42, rounds: int = 500,
                   rate: float = 0.05, depth: int = 6, subsample: float = 0.8, columns: float = 0.8,
                   penalty: float = 1.0) -> list[ModelSpec]:
    params = {"rounds": rounds, "rate": rate, "depth": depth, "subsample": subsample, "columns": columns, "penalty": penalty,
              "seed": seed}
    by_task = {"regression": [ModelSpec("boosted", "boosted", params)],
               "classification": [ModelSpec("boosted", "boosted_classifier", params)]}
    return _picked(by_task, task, names)


def sweep_specs(seed: int = 42, trees: int = 300, rounds: int = 250) -> list[ModelSpec]:
    """The full comparison, meant for a log target."""
    return [
        ModelSpec("linear", "linear", scaled=True),
        ModelSpec("ridge", "ridge", {"alpha": 5.0}, scaled=True),
        ModelSpec("knn", "knn", {"k": 15}),
        ModelSpec("random_forest", "forest", {"trees": trees, "min_leaf": 2, "seed": seed}),
        ModelSpec("tree", "tree", {"min_leaf": 3, "seed": seed}),
        ModelSpec("boosted", "boosted", {"rounds": rounds, "rate": 0.05, "depth": 6, "subsample": 0.8, "columns": 0.8,
                                         "seed": seed}),
    ]


def _picked(by_task: Mapping[str, list[ModelSpec]], task: str, names: Sequence[str]) -> list[ModelSpec]:
    if task not in by_task:
        raise ValueError("task must be 'regression' or 'classification'")
    picked = [s for s in by_task[task] if not names or s.name in names]
    if not picked:
        raise ValueError(f"no model selected by {list(names)}")
    return picked


# ------------------------------------------------------------------- fitting

def _tree_params(p):
    # each row's node is kept from level to level: without it every row walks all trees from the top at every level
    return {"maxDepth": int(p.get("depth", MAX_DEPTH)), "minInstancesPerNode": int(p.get("min_leaf", 1)),
            "seed": int(p.get("seed", 42)), "cacheNodeIds": True}


BOOSTED = {"boosted": "squared", "boosted_classifier": "logistic"}


def boost_settings(spec: ModelSpec) -> BoostSettings:
    p = spec.params
    return BoostSettings(int(p.get("rounds", 500)), p.get("rate", 0.05), int(p.get("depth", 6)), p.get("subsample", 1.0),
                         p.get("columns", 1.0), p.get("penalty", 1.0), p.get("least", 1.0), loss=BOOSTED[spec.kind],
                         seed=int(p.get("seed", 42)))


_BUILDERS: dict[str, Callable] = {
    "tree": lambda p, n, y: DecisionTreeRegressor(featuresCol="_features", labelCol=y, **_tree_params(p)),
    "forest": lambda p, n, y: RandomForestRegressor(
        featuresCol="_features", labelCol=y, numTrees=int(p.get("trees", 200)),
        featureSubsetStrategy="all", **_tree_params(p)),
    "logistic": lambda p, n, y: LogisticRegression(
        featuresCol="_features", labelCol=y, regParam=1.0 / (p.get("c", 1.0) * n), standardization=False,
        maxIter=int(p.get("iterations", 1000))),
    "forest_classifier": lambda p, n, y: RandomForestClassifier(
        featuresCol="_features", labelCol=y, numTrees=int(p.get("trees", 200)),
        featureSubsetStrategy="sqrt", **_tree_params(p)),
}


def _constant(df: DataFrame, spec: ModelSpec, label: str) -> float:
    if spec.kind == "mean":
        return df.agg(F.avg(label)).first()[0]
    return float(modes(df, [label])[label])


def fit_model(df: DataFrame, spec: ModelSpec, features: Sequence[str], label: str) -> PipelineModel:
    """Fit on complete rows. Scaling statistics come from ``df`` alone (the training rows)."""
    features = list(features)
    if spec.kind in ("mean", "most_frequent"):
        value = _constant(df, spec, label)
        return PipelineModel([SQLTransformer(statement=f"SELECT *, {float(value)!r}D AS prediction FROM __THIS__")])
    if spec.kind in SOLVERS:
        return fit_lines(df, features, label, spec.kind, spec.params, spec.scaled)[0].model()
    if spec.kind in BOOSTED:
        return _boosted_model(fit_boosted(df, features, label, boost_settings(spec))[0])
    if spec.kind not in _BUILDERS:
        raise ValueError(f"unknown model kind: {spec.kind}")
    stages = []
    inputs = features
    if spec.scaled:
        stages.append(SQLTransformer(statement=fit_standard(df, columns=features).sql("_z_")))
        inputs = [f"_z_{c}" for c in features]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="_features", handleInvalid="error"))
    n = df.count() if spec.kind == "logistic" else None     # its penalty is a share of the rows
    stages.append(_BUILDERS[spec.kind](spec.params, n, label))
    return _without_summary(Pipeline(stages=stages).fit(df))


def _without_summary(model: PipelineModel) -> PipelineModel:
    """Without the training summaries: tasks that score get the model's classifier, and a summary holds the session, which
    cannot be sent once something was observed in it."""
    for stage in model.stages:
        if getattr(stage, "hasSummary", False):
            stage._call_java("setSummary", SparkSession.active().sparkContext._jvm.scala.Option.empty())
    return model


def _boosted_model(ensemble: Ensemble) -> PipelineModel:
    return PipelineModel([BoostedTrees(ensemble=ensemble.to_json())])


def predict(model: PipelineModel, df: DataFrame, target_transform: str = "none") -> DataFrame:
    """Input columns plus ``prediction``, back on the original scale."""
    kept = df.columns
    scored = model.transform(df)
    return scored.select(*kept, target_inverse(F.col("prediction").cast("double"), target_transform).alias("prediction"))


# ------------------------------------------------------------------- metrics

def regression_metrics(df: DataFrame, truth: str = "y", prediction: str = "prediction") -> DataFrame:
    """``mae, rmse, r2`` in one pass: the spread of y comes from its population variance."""
    y, p = F.col(truth).cast("double"), F.col(prediction).cast("double")
    sums = df.agg(F.avg(F.abs(y - p)).alias("mae"), F.avg((y - p) * (y - p)).alias("mse"), F.var_pop(y).alias("var"))
    return sums.select("mae", F.sqrt("mse").alias("rmse"),
                       (1.0 - F.try_divide(F.col("mse"), F.col("var"))).alias("r2"))


def accuracy(df: DataFrame, truth: str = "y", prediction: str = "prediction") -> DataFrame:
    same = F.col(truth).cast("double") == F.col(prediction).cast("double")
    return df.agg(F.avg(same.cast("double")).alias("accuracy"))


# --------------------------------------------------------------- comparisons

def out_of_fold(df: DataFrame, spec: ModelSpec, features: Sequence[str], label: str, key: str,
                k: int = 5, seed: int = 42) -> DataFrame:
    """A prediction for every row by the model fitted on the other folds."""
    folded = materialised(df.withColumn("_fold", fit_folds(df, key, k, seed)))   # read once per fold and pass
    return _fit_all(folded, spec, features, label, key, k, whole=False)[1].drop("_fold")


def _fit_all(folded: DataFrame, spec: ModelSpec, features: Sequence[str], label: str, key: str, k: int,
             whole: bool = True, moments: dict[int, Moments] | None = None) -> tuple[PipelineModel | Neighbours | None, DataFrame | None]:
    """The model of all rows (if ``whole``) and, with ``k`` folds, every row's prediction by the model of the other folds.

    Linear models take all fits from one pass over the rows, boosted trees grow all folds in the same jobs; other models are
    fitted once per fold, single trees side by side.
    """
    if spec.kind in SOLVERS:
        lines = fit_lines(folded, features, label, spec.kind, spec.params, spec.scaled, "_fold" if k else None, k, moments)
        return lines[0].model(), folded.withColumn("prediction", by_fold(lines, "_fold")) if k else None
    if spec.kind in BOOSTED:
        found = [_boosted_model(e) for e in fit_boosted(folded, features, label, boost_settings(spec), "_fold" if k else None, k)]
        parts = [predict(m, folded.filter(F.col("_fold") == i)) for i, m in enumerate(found[1:], 1)]
        return found[0], union_boards(parts) if parts else None
    def held(i: int) -> DataFrame:
        scored = _held_out(folded.filter(F.col("_fold") != i), folded.filter(F.col("_fold") == i), spec, features, label, key)[0]
        # a search is a long plan: those of all folds in one query would be planned, sent and held by the driver together
        return materialised(scored) if spec.kind == "knn" else scored

    def all_rows() -> PipelineModel | Neighbours:
        return fit_neighbours(folded, spec, features, label, key) if spec.kind == "knn" else fit_model(folded, spec, features, label)

    fits = [partial(held, i) for i in range(1, k + 1)] + ([all_rows] if whole else [])
    # a single tree is a chain of short jobs, one per level; other models fill the cluster or its memory with one fit
    done = side_by_side(fits, folded) if spec.kind == "tree" else [fit() for fit in fits]
    return done[k] if whole else None, union_boards(done[:k]) if k else None


def _held_out(train: DataFrame, rows: DataFrame, spec: ModelSpec, features: Sequence[str], label: str,
              key: str) -> tuple[DataFrame, PipelineModel | Neighbours]:
    """``rows`` with a prediction on the label's scale, and what made it."""
    if spec.kind != "knn":
        model = fit_model(train, spec, features, label)
        return predict(model, rows), model
    model = fit_neighbours(train, spec, features, label, key)
    return model.predict(rows, key), model


@dataclass
class Neighbours:
    """A fitted k-NN regressor: the scaling of its features and an index of its training rows."""

    scaler: Scaler
    index: NeighbourIndex
    k: int

    def predict(self, rows: DataFrame, key: str) -> DataFrame:
        near = self.index.regress(self.scaler.transform(rows.select(key, *self.index.features)), key, self.k)
        return rows.join(near.hint("merge"), key)

    def save(self, path: str) -> None:
        self.index.save(f"{path}/index")
        head = [(self.k, list(self.scaler.columns), list(self.scaler.shift), list(self.scaler.width))]
        self.index.rows.sparkSession.createDataFrame(head, "k int, columns array<string>, shift array<double>, width array<double>").coalesce(
            1).write.mode("overwrite").parquet(f"{path}/scaler")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Neighbours:
        head = spark.read.parquet(f"{path}/scaler").head()
        return cls(Scaler(tuple(head["columns"]), tuple(head["shift"]), tuple(head["width"])), NeighbourIndex.load(spark, f"{path}/index"), head["k"])


def fit_neighbours(train: DataFrame, spec: ModelSpec, features: Sequence[str], label: str, key: str) -> Neighbours:
    scaler = fit_standard(train, columns=list(features))
    scaled = scaler.transform(train.select(key, *features, label))
    return Neighbours(scaler, build_index(scaled, features, key, label), int(spec.params.get("k", 15)))


def _inverted(scored: DataFrame, target_transform: str) -> DataFrame:
    return scored.withColumn("prediction", target_inverse(F.col("prediction"), target_transform))


def train_and_evaluate(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                       specs: Sequence[ModelSpec], task: str = "regression") -> DataFrame:
    """``model, score``: R² or accuracy on the test rows, best first."""
    if not specs:
        raise ValueError("no models to train")
    parts = []
    for spec in specs:
        scored = predict(fit_model(train, spec, features, label), test)
        if task == "regression":
            score = regression_metrics(scored, label).select(F.lit(spec.name).alias("model"), F.col("r2").alias("score"))
        else:
            score = accuracy(scored, label).select(F.lit(spec.name).alias("model"), F.col("accuracy").alias("score"))
        parts.append(score)
    return union_boards(parts).orderBy(F.col("score").desc(), "model")


def leaderboard(train: DataFrame, test: DataFrame, features: Sequence[str], target: str, key: str,
                specs: Sequence[ModelSpec], target_transform: str = "log1p", folds: int = 5,
                seed: int = 42) -> tuple[DataFrame, dict[str, PipelineModel | Neighbours]]:
    """Out-of-fold and hold-out metrics per model on the original scale, best RMSE first.

    ``folds=0`` leaves the out-of-fold columns empty.
    """
    label = "_label"
    with_label = train.withColumn(label, target_forward(F.col(target), target_transform))
    if folds:
        # Every model reads the same rows with the same folds, many times.
        with_label = materialised(with_label.withColumn("_fold", fit_folds(train, key, folds, seed)))
    lines = [s for s in specs if s.kind in SOLVERS]
    moments = fold_moments(with_label, [*features, label], "_fold" if folds else None) if lines else None

    def run(spec: ModelSpec) -> tuple[PipelineModel | Neighbours, list[tuple]]:
        model, oof = _fit_all(with_label, spec, features, label, key, folds, moments=moments if spec in lines else None)
        scored = model.predict(test, key) if isinstance(model, Neighbours) else predict(model, test)
        sides = [("test", scored)] + ([("train", oof)] if folds else [])
        return model, [_board_row(_inverted(rows, target_transform), target, spec.name, part, len(features)) for part, rows in sides]

    done = side_by_side([partial(run, spec) for spec in specs], with_label)
    models = {spec.name: model for spec, (model, _) in zip(specs, done, strict=True)}
    parts = train.sparkSession.createDataFrame([row for _, rows in done for row in rows], BOARD)
    board = parts.groupBy("model").agg(F.max("features").alias("features"), *[
        F.max(F.when(F.col("part") == part, F.col(m))).alias(f"{m}_{part}")
        for part in ("train", "test") for m in ("mae", "rmse", "r2")])
    return board.orderBy("rmse_test", "model"), models


BOARD = "model string, part string, features int, mae double, rmse double, r2 double"


def _board_row(scored: DataFrame, target: str, model: str, part: str, n_features: int) -> tuple:
    m = regression_metrics(scored, target).select(
        F.round("mae", 2).alias("mae"), F.round("rmse", 2).alias("rmse"), F.round("r2", 4).alias("r2")).first()
    return model, part, n_features, m["mae"], m["rmse"], m["r2"]


def union_boards(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def best_model(board: DataFrame, metric: str = "rmse_test") -> str:
    return board.orderBy(metric, "model").first()["model"]
