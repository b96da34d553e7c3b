"""Schema helpers and the one-pass per-column aggregate the profiles share."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def non_numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)]


def shared_numeric_columns(a: DataFrame, b: DataFrame) -> list[str]:
    return sorted(set(numeric_columns(a)) & set(numeric_columns(b)))


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")


def drop_columns(df: DataFrame, columns: Sequence[str], errors: str = "ignore") -> DataFrame:
    """Drop columns; ``errors="raise"`` refuses names that do not exist."""
    if errors not in ("ignore", "raise"):
        raise ValueError("errors must be 'ignore' or 'raise'")
    if errors == "raise":
        require_columns(df, columns)
    return df.drop(*columns)


def select_features(df: DataFrame, features: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """The saved feature list, in its order; a missing feature is an error."""
    require_columns(df, [*features, *extra])
    return df.select(*features, *extra)


def model_rows(df: DataFrame, target: str, keep: Sequence[str] = ()) -> DataFrame:
    """Numeric features and target (and ``keep``) of the rows without a missing cell."""
    require_columns(df, [target])
    features = numeric_columns(df, exclude=[target, *keep])
    return df.select(*keep, *features, target).na.drop(subset=[*features, target])


def finite(c: Column) -> Column:
    """NaN and infinity as null, the missing cell of every operator."""
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def without_nan(df: DataFrame) -> DataFrame:
    """Floating-point columns with NaN and infinity turned into null; other columns as they are."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.select(*[finite(F.col(f"`{c}`")).alias(c) if c in floats else F.col(f"`{c}`") for c in df.columns])


def as_doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles with NaN and infinity turned into null."""
    return df.select(*[finite(F.col(c).cast("double")).alias(c) for c in columns])


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A driver-made table of report size, as a local relation (no Python rows in the plan)."""
    fields = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    arrays = [pa.array(list(values), to_arrow_type(f.dataType)) for values, f in zip(columns, fields)]
    return spark.createDataFrame(pa.table(arrays, names=fields.names), fields)


def preview(df: DataFrame, k: int = 5) -> DataFrame:
    return df.limit(k)


def sample_rows(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """A seeded sample of ``k`` rows that does not depend on partitioning."""
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(order, F.col(key)).limit(k)


def per_column(df: DataFrame, columns: Sequence[str], metrics: Mapping[str, Callable[[Column], Column]],
               constants: Mapping[str, Mapping[str, object]] | None = None,
               constant_types: Mapping[str, str] | None = None) -> DataFrame:
    """One row per column from one wide aggregate (no row multiplication).

    ``constants`` adds fitted numbers per column next to the aggregated ones.
    """
    aggregates, structs = [], []
    for i, c in enumerate(columns):
        parts = [F.lit(c).alias("column")]
        for m, build in metrics.items():
            label = f"a{i}_{m}"
            aggregates.append(build(F.col(c)).alias(label))
            parts.append(F.col(label).alias(m))
        for m, t in (constant_types or {}).items():
            parts.append(F.lit((constants or {}).get(c, {}).get(m)).cast(t).alias(m))
        structs.append(F.struct(*parts))
    return df.agg(*aggregates).select(F.inline(F.array(*structs)))


def value_counts(df: DataFrame, columns: Sequence[str], as_type: str = "string") -> DataFrame:
    """``column, value, n`` over the non-missing cells of several columns."""
    types = dict(df.dtypes)
    df = without_nan(df.select(*columns))
    # Adding 0.0 merges the two zeros a double can hold.
    typed = df.select(*[(F.col(c) + F.lit(0.0) if types[c] in ("double", "float") else F.col(c))
                        .cast(as_type).alias(c) for c in columns])
    return (typed.unpivot([], list(columns), "column", "value")
            .filter(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
