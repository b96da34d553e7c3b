"""Alignment of truth and predictions, and their evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.models import regression_metrics
from plumbline.operators.ordering import ordered_positions
from plumbline.operators.tables import require_columns
from plumbline.session import materialised


def _require_unique(df: DataFrame, key: str, name: str) -> None:
    twice = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{key} is not unique in {name}: {twice[0][0]!r}")


def align_by_key(truth: DataFrame, predictions: DataFrame, key: str, target: str = "target",
                 prediction: str = "prediction") -> DataFrame:
    """One-to-one inner join on a key; an error for repeated keys or an empty result.

    Both sides meet in one aggregate by key, which also counts the repeats:
    one shuffle, and a repeated key is merged before it.
    """
    require_columns(truth, [key, target])
    require_columns(predictions, [key, prediction])
    both = truth.select(key, F.col(target).alias("y"), F.lit(1).alias("t"), F.lit(0).alias("p")).unionByName(
        predictions.select(key, F.col(prediction).alias("prediction"), F.lit(0).alias("t"), F.lit(1).alias("p")),
        allowMissingColumns=True).filter(F.col(key).isNotNull())
    met = materialised(both.groupBy(key).agg(F.max("y").alias("y"), F.max("prediction").alias("prediction"),
                                             F.sum("t").alias("t"), F.sum("p").alias("p")))
    pairs = (F.col("t") > 0) & (F.col("p") > 0)
    found = met.agg(F.max("t").alias("t"), F.max("p").alias("p"), F.count(F.when(pairs, 1)).alias("n")).first()
    for side, name in (("t", "truth"), ("p", "predictions")):
        if (found[side] or 0) > 1:
            raise ValueError(f"{key} is not unique in {name}")
    if not found["n"]:
        raise ValueError("the join produced no rows: check the key column")
    return met.filter(pairs).select(key, "y", "prediction")


def align_by_order(truth: DataFrame, predictions: DataFrame, order: str, target: str = "target",
                   prediction: str = "prediction") -> DataFrame:
    """Row i of one table against row i of the other, by a declared number or date column in its own type.

    Positions are counted per value range and shifted, not by one global
    window. The order column must be unique and present in each row.
    """
    sizes = truth.count(), predictions.count()
    if sizes[0] != sizes[1]:
        raise ValueError(f"different number of rows: {sizes[0]} and {sizes[1]}")
    for df, name in ((truth, "truth"), (predictions, "predictions")):
        _require_unique(df, order, name)

    def placed(df: DataFrame, value: str, alias: str) -> DataFrame:
        return ordered_positions(df.select(order, F.col(value).alias(alias)), order).select("position", alias)

    return placed(truth, target, "y").join(placed(predictions, prediction, "prediction"), "position")


def evaluate_predictions(truth: DataFrame, predictions: DataFrame, target: str = "target",
                         key: str | None = None, order: str | None = None) -> DataFrame:
    """``mae, rmse, r2`` of a prediction table against the truth."""
    if key is not None:
        aligned = align_by_key(truth, predictions, key, target)
    elif order is not None:
        aligned = align_by_order(truth, predictions, order, target)
    else:
        raise ValueError("name a key column, or an order column for row-by-row alignment")
    return regression_metrics(aligned, "y")
