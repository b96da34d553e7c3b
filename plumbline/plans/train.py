"""Training jobs: one model with its metrics, or a configured comparison of several."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from plumbline.operators.correlation import redundant_columns
from plumbline.operators.models import (
    ModelSpec, baseline_specs, best_model, boosting_specs, fit_model, leaderboard, predict, regression_metrics)
from plumbline.operators.split import train_test
from plumbline.operators.tables import drop_columns, model_rows, numeric_columns, select_features
from plumbline.session import materialised
from plumbline.sources import files, runs

SIMPLE_MODELS = {
    "linear": ModelSpec("linear", "linear"),
    "ridge": ModelSpec("ridge", "ridge", {"alpha": 1.0}),
    "lasso": ModelSpec("lasso", "lasso", {"alpha": 1.0}),
}


@dataclass(frozen=True)
class TrainConfig:
    key: str
    target: str
    model: str = "linear"
    test_size: float = 0.2
    seed: int = 42


def train_eval(df: DataFrame, config: TrainConfig, model_dir: str | None = None, metrics_dir: str | None = None,
               runs_path: str | None = None) -> tuple[PipelineModel, DataFrame]:
    """Complete numeric rows → split → fit → ``r2, rmse`` on the hold-out; stored where paths are given."""
    if config.model not in SIMPLE_MODELS:
        raise ValueError(f"model must be one of {sorted(SIMPLE_MODELS)}")
    spark = df.sparkSession
    rows = model_rows(df, config.target, [config.key])
    features = [c for c in rows.columns if c not in (config.key, config.target)]
    train, test = train_test(rows, config.key, config.test_size, config.seed)
    model = fit_model(train, SIMPLE_MODELS[config.model], features, config.target)
    metrics = regression_metrics(predict(model, test), config.target).select("r2", "rmse")
    if model_dir:
        runs.save_model(model, model_dir, config.model)
    if metrics_dir:
        files.write_version(metrics, metrics_dir)
    if runs_path:
        found = metrics.first()
        runs.log_run(spark, runs_path, config.model,
                     {"model": config.model, "random_state": config.seed, "test_size": config.test_size},
                     {"r2": found["r2"], "rmse": found["rmse"]})
    return model, metrics


@dataclass(frozen=True)
class ExperimentConfig:
    key: str
    target: str
    drop: tuple[str, ...] = ()
    corr_threshold: float = 0.85
    target_transform: str = "none"
    test_size: float = 0.2
    seed: int = 42
    stratify: bool = False
    folds: int = 5
    baselines: tuple[str, ...] = ("linear", "random_forest")
    trees: int = 200
    boosting: bool = True
    rounds: int = 300
    rate: float = 0.05
    depth: int = 6
    subsample: float = 0.8
    columns: float = 0.8
    penalty: float = 1.0
    extra: tuple[ModelSpec, ...] = field(default_factory=tuple)

    @staticmethod
    def from_dict(values: dict) -> ExperimentConfig:
        return ExperimentConfig(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})

    def specs(self) -> list[ModelSpec]:
        found = baseline_specs("regression", self.baselines, self.seed, self.trees) if self.baselines else []
        if self.boosting:
            found = found + boosting_specs("regression", (), self.seed, self.rounds, self.rate, self.depth, self.subsample,
                                           self.columns, self.penalty)
        return [*found, *self.extra]


@dataclass(frozen=True)
class Experiment:
    features: Sequence[str]
    board: DataFrame
    models: dict[str, PipelineModel | None]

    def best(self) -> str:
        return best_model(self.board)


def run_experiment(df: DataFrame, config: ExperimentConfig, output: str | None = None) -> Experiment:
    """Split, prune, transform the target, train every model, rank by hold-out RMSE.

    With ``output`` the feature list, models, leaderboard and run log are
    stored beneath it.
    """
    spark = df.sparkSession
    pruned = drop_columns(df, config.drop)
    candidates = numeric_columns(pruned, [config.key, config.target])
    rows = pruned.select(config.key, *candidates, config.target).na.drop()
    train, test = train_test(rows, config.key, config.test_size, config.seed, config.target if config.stratify else None)
    redundant = redundant_columns(train, candidates, config.corr_threshold) if len(candidates) > 1 else []
    features = [c for c in candidates if c not in redundant]
    train = select_features(train, features, [config.key, config.target])
    test = select_features(test, features, [config.key, config.target])
    board, models = leaderboard(train, test, features, config.target, config.key, config.specs(),
                                config.target_transform, config.folds, config.seed)
    if output:
        _store(spark, output, config, features, board, models)
    return Experiment(features, board, models)


def _store(spark, output: str, config: ExperimentConfig, features, board: DataFrame, models) -> None:
    base = output.rstrip("/")
    files.write_features(spark, list(features), f"{base}/features")
    board = materialised(board)
    files.write_version(board, f"{base}/leaderboard", "json")
    files.write_version(board, f"{base}/leaderboard_csv", "csv")
    parent = runs.log_run(spark, f"{base}/runs", "experiment", {
        "seed": config.seed, "target": config.target, "drop_count": len(config.drop),
        "corr_threshold": config.corr_threshold, "folds": config.folds, "rounds": config.rounds},
        tags={"phase": "training"})
    for row in board.collect():   # one row per model
        if models[row["model"]] is not None:
            runs.save_model(models[row["model"]], f"{base}/models", row["model"])
        runs.log_run(spark, f"{base}/runs", row["model"], metrics={
            "rmse": row["rmse_test"], "mae": row["mae_test"], "r2": row["r2_test"]},
            tags={"model_name": row["model"]}, parent=parent)


MODEL_FAMILIES = {"baseline": baseline_specs, "boosted": boosting_specs}


def train_model(train: DataFrame, test: DataFrame, features: Sequence[str], target: str, key: str,
                family: str = "baseline", log_target: bool = False, names: Sequence[str] = (), seed: int = 42,
                **settings) -> Experiment:
    """Train one family of regressors by name, on the target or its log, and rank them on the hold-out."""
    if family not in MODEL_FAMILIES:
        raise ValueError(f"family must be one of {sorted(MODEL_FAMILIES)}")
    specs = MODEL_FAMILIES[family]("regression", names, seed, **settings)
    board, models = leaderboard(train, test, features, target, key, specs, "log1p" if log_target else "none", 0, seed)
    return Experiment(list(features), board, models)


def score_table(df: DataFrame, model: PipelineModel, features: Sequence[str], keep: Sequence[str] = (),
                target_transform: str = "none") -> DataFrame:
    """``keep`` columns and ``prediction`` for every row, by a stored model."""
    scored = predict(model, select_features(df, features, keep), target_transform)
    return scored.select(*keep, "prediction")
