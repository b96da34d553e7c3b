"""Text to numbers, with an audit of every cell that was lost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import cells
from plumbline.operators.tables import per_column


def _number(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, T.NumericType):
        return cells.finite_or_null(F.col(column).cast("double"))
    return cells.text_to_number(F.col(column).cast("string"))


def _lost(df: DataFrame, column: str) -> Column:
    return F.col(column).isNotNull() & _number(df, column).isNull()


def missing_tokens_to_null(df: DataFrame, tokens: Sequence[str] = cells.MISSING_TOKENS) -> DataFrame:
    """Every text cell that is a missing-value token becomes null."""
    return df.select(*[
        cells.missing_to_null(F.col(c), tokens).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def coerce_numeric(df: DataFrame, except_columns: Sequence[str] = (), errors: str = "coerce") -> DataFrame:
    """All columns but ``except_columns`` as doubles.

    A cell that is no number becomes null (``coerce``), fails the job
    (``raise``), or leaves its whole column untouched (``ignore``).
    """
    if errors not in ("coerce", "raise", "ignore"):
        raise ValueError("errors must be 'coerce', 'raise' or 'ignore'")
    convert = [c for c in df.columns if c not in except_columns]
    if errors == "ignore" and convert:
        lost = df.agg(*[F.count(F.when(_lost(df, c), 1)).alias(f"n{i}") for i, c in enumerate(convert)]).first()
        convert = [c for i, c in enumerate(convert) if lost[i] == 0]
    out = []
    for c in df.columns:
        if c not in convert:
            out.append(F.col(c))
            continue
        number = _number(df, c)
        if errors == "raise":
            text = F.concat(F.lit(f"not a number in {c}: "), F.col(c).cast("string"))
            number = F.when(_lost(df, c), F.raise_error(text).cast("double")).otherwise(number)
        out.append(number.alias(c))
    return df.select(*out)


def coercion_summary(df: DataFrame, except_columns: Sequence[str] = ()) -> DataFrame:
    """Per column: types, cells lost to coercion (count and %), missing before and after."""
    types = dict(df.dtypes)
    constants = {c: {"before_type": types[c], "after_type": types[c] if c in except_columns else "double"}
                 for c in df.columns}

    def converted(c: str) -> Column:
        return F.col(c) if c in except_columns else _number(df, c)

    # One wide select first, so that each text is parsed once.
    frame = df.select(*[F.struct(F.col(c).isNull().alias("before"), converted(c).isNull().alias("after")).alias(c)
                        for c in df.columns])
    report = per_column(frame, df.columns, {
        "coerced": lambda c: F.count(F.when(c["after"] & ~c["before"], 1)),
        "missing_before": lambda c: F.count(F.when(c["before"], 1)),
        "missing_after": lambda c: F.count(F.when(c["after"], 1)),
        "n_rows": lambda c: F.count(F.lit(1)),
    }, constants, {"before_type": "string", "after_type": "string"})
    pct = F.coalesce(F.try_divide(100.0 * F.col("coerced"), F.col("n_rows")), F.lit(0.0))
    return (report.select("column", "before_type", "after_type", "coerced", pct.alias("coerced_pct"),
                          "missing_before", "missing_after")
            .orderBy(F.col("coerced_pct").desc(), "column"))


def mixed_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: missing, numeric and text cells, and whether numbers and text mix."""
    columns = list(columns or df.columns)
    frame = df.select(*[F.struct(
        cells.missing_to_null(F.col(c).cast("string")).isNull().alias("missing"),
        _number(df, c).isNotNull().alias("numeric")).alias(c) for c in columns])
    report = per_column(frame, columns, {
        "missing": lambda c: F.count(F.when(c["missing"], 1)),
        "numeric": lambda c: F.count(F.when(c["numeric"], 1)),
        "text": lambda c: F.count(F.when(~c["missing"] & ~c["numeric"], 1)),
    })
    return report.withColumn("mixed", (F.col("numeric") > 0) & (F.col("text") > 0))
