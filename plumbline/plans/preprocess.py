"""The preprocessing job: shape, scaling, histograms, correlations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from plumbline.operators.correlation import correlation
from plumbline.operators.profile import histogram, table_shape
from plumbline.operators.scale import Scaler, fit_standard
from plumbline.operators.tables import numeric_columns


@dataclass(frozen=True)
class Preprocessed:
    shape: DataFrame
    scaled: DataFrame
    scaler: Scaler
    histograms: DataFrame
    correlations: DataFrame


def preprocess(df: DataFrame, exclude: Sequence[str] = (), bins: int = 30, method: str = "pearson") -> Preprocessed:
    """Standardise the numeric columns and describe them; nothing but the fit runs yet."""
    columns = numeric_columns(df, exclude)
    scaler = fit_standard(df, columns=columns)
    return Preprocessed(table_shape(df), scaler.transform(df), scaler,
                        histogram(df, columns, bins), correlation(df, columns, method))
