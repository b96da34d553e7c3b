"""Standardising, min-max scaling and principal components."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.cells import target_forward
from plumbline.operators.tables import as_doubles, numeric_columns


@dataclass(frozen=True)
class Scaler:
    """Fitted shift and width per column: ``(x - shift) / width``, 0 when the width is 0."""

    columns: tuple[str, ...]
    shift: tuple[float | None, ...]
    width: tuple[float | None, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        fitted = dict(zip(self.columns, zip(self.shift, self.width)))
        out = []
        for c in df.columns:
            if c not in fitted or fitted[c][0] is None:
                out.append(F.col(c))
                continue
            shift, width = fitted[c]
            x = F.col(c).cast("double")
            scaled = (x - F.lit(shift)) / F.lit(width) if width else F.lit(0.0)
            out.append(F.when(x.isNotNull() & ~F.isnan(x), scaled).alias(c))
        return df.select(*out)

    def sql(self, prefix: str = "") -> str:
        """The same projection as a statement for ``SQLTransformer`` (storable with a model)."""
        parts = []
        for c, shift, width in zip(self.columns, self.shift, self.width):
            body = f"(CAST(`{c}` AS DOUBLE) - {shift!r}D) / {width!r}D" if width else "0.0D"
            parts.append(f"CASE WHEN `{c}` IS NOT NULL THEN {body} END AS `{prefix}{c}`")
        return f"SELECT *, {', '.join(parts)} FROM __THIS__"


def fit_standard(df: DataFrame, exclude: Sequence[str] = (), columns: Sequence[str] | None = None) -> Scaler:
    """Mean and population sd of the numeric columns."""
    used = list(columns or numeric_columns(df, exclude))
    if not used:
        return Scaler((), (), ())
    row = as_doubles(df, used).agg(*[F.avg(c) for c in used], *[F.stddev_pop(c) for c in used]).first()
    return Scaler(tuple(used), tuple(row[:len(used)]), tuple(row[len(used):]))


def fit_min_max(df: DataFrame, exclude: Sequence[str] = (), columns: Sequence[str] | None = None) -> Scaler:
    used = list(columns or numeric_columns(df, exclude))
    if not used:
        return Scaler((), (), ())
    row = as_doubles(df, used).agg(*[F.min(c) for c in used], *[F.max(c) for c in used]).first()
    low, high = row[:len(used)], row[len(used):]
    return Scaler(tuple(used), tuple(low), tuple(
        hi - lo if lo is not None else None for lo, hi in zip(low, high)))


def scale_features(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    return fit_standard(df, exclude).transform(df)


def min_max_features(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    return fit_min_max(df, exclude).transform(df)


@dataclass(frozen=True)
class Projection:
    data: DataFrame
    explained: tuple[float, ...]   # variance share of each kept component
    loadings: tuple[tuple[float, ...], ...]
    columns: tuple[str, ...]


def run_pca(df: DataFrame, n_components: float | int = 0.95, exclude: Sequence[str] = ()) -> Projection:
    """Components of the standardised numeric columns, with the excluded columns carried along.

    A fraction keeps the fewest components that reach that variance share; an
    integer keeps that many. Signs are fixed so that the largest loading of
    each component is positive.
    """
    columns = numeric_columns(df, exclude)
    if isinstance(n_components, int) and not 1 <= n_components <= len(columns):
        raise ValueError(f"n_components must be between 1 and {len(columns)}")
    scaled = fit_standard(df, columns=columns).transform(df.select(*columns, *[c for c in exclude if c in df.columns]))
    vectors = VectorAssembler(inputCols=columns, outputCol="_x", handleInvalid="error").transform(scaled)
    model = PCA(k=len(columns), inputCol="_x", outputCol="_pc").fit(vectors)
    shares = [float(v) for v in model.explainedVariance]
    if isinstance(n_components, int):
        keep = n_components
    else:
        reached, keep = 0.0, 0
        for share in shares:
            keep += 1
            reached += share
            if reached > n_components:
                break
    matrix = model.pc.toArray()
    signs = [1.0 if matrix[abs(matrix[:, i]).argmax(), i] >= 0 else -1.0 for i in range(keep)]
    projected = model.transform(vectors).withColumn("_pc", vector_to_array("_pc"))
    data = projected.select(*[(F.col("_pc")[i] * F.lit(signs[i])).alias(f"PC{i + 1}") for i in range(keep)],
                            *[c for c in exclude if c in df.columns])
    loadings = tuple(tuple(float(v) * signs[i] for v in matrix[:, i]) for i in range(keep))
    return Projection(data, tuple(shares[:keep]), loadings, tuple(columns))


def plane_projection(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> DataFrame:
    """The first two components with ``log1p(target)`` as colour."""
    projected = run_pca(df, 2, [target, *exclude]).data
    return projected.withColumn("colour", target_forward(F.col(target), "log1p"))


def scaled_with_target(df: DataFrame, target: str, drop: Sequence[str] = ()) -> DataFrame:
    """Standardised numeric features next to the untouched target."""
    kept = df.drop(*drop)
    features = numeric_columns(kept, [target])
    return scale_features(kept, [target]).select(*features, target)
