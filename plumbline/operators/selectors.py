"""Column selection as Spark ML stages, for use in a ``Pipeline``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from plumbline.operators.correlation import redundant_columns
from plumbline.operators.tables import drop_columns, numeric_columns


class DropColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Drop named columns; ``errors="raise"`` refuses names that do not exist."""

    columns = Param(Params._dummy(), "columns", "columns to drop", TypeConverters.toListString)
    errors = Param(Params._dummy(), "errors", "ignore or raise", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, columns: Sequence[str] = (), errors: str = "ignore"):
        super().__init__()
        self._setDefault(columns=[], errors="ignore")
        self._set(columns=list(columns), errors=errors)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return drop_columns(dataset, self.getOrDefault(self.columns), self.getOrDefault(self.errors))


class _CorrelationParams(Params):
    threshold = Param(Params._dummy(), "threshold", "correlation above which a column is redundant", TypeConverters.toFloat)
    method = Param(Params._dummy(), "method", "pearson, spearman or kendall", TypeConverters.toString)
    absolute = Param(Params._dummy(), "absolute", "compare the absolute value", TypeConverters.toBoolean)
    exclude = Param(Params._dummy(), "exclude", "columns that are not candidates", TypeConverters.toListString)


class DropHighCorrFeatures(Estimator, _CorrelationParams, DefaultParamsReadable, DefaultParamsWritable):
    """Finds the later column of every pair whose correlation exceeds the threshold."""

    @keyword_only
    def __init__(self, *, threshold: float = 0.9, method: str = "pearson", absolute: bool = True,
                 exclude: Sequence[str] = ()):
        super().__init__()
        if not 0.0 < threshold <= 1.0:
            raise ValueError("threshold must be in (0, 1]")
        self._setDefault(threshold=0.9, method="pearson", absolute=True, exclude=[])
        self._set(threshold=threshold, method=method, absolute=absolute, exclude=list(exclude))

    def _fit(self, dataset: DataFrame) -> DropHighCorrModel:
        columns = numeric_columns(dataset, self.getOrDefault(self.exclude))
        found = redundant_columns(dataset, columns, self.getOrDefault(self.threshold),
                                  self.getOrDefault(self.method), self.getOrDefault(self.absolute))
        return DropHighCorrModel(dropped=found, features=columns)


class DropHighCorrModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    dropped = Param(Params._dummy(), "dropped", "columns found redundant", TypeConverters.toListString)
    features = Param(Params._dummy(), "features", "candidate columns at fit time", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, dropped: Sequence[str] = (), features: Sequence[str] = ()):
        super().__init__()
        self._setDefault(dropped=[], features=[])
        self._set(dropped=list(dropped), features=list(features))

    def kept(self) -> list[str]:
        gone = set(self.getOrDefault(self.dropped))
        return [c for c in self.getOrDefault(self.features) if c not in gone]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.getOrDefault(self.dropped))
