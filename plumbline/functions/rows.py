"""Expressions over one row of a column family."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(columns: Sequence[str]) -> Column:
    """Row sum in which a missing cell counts as nothing."""
    acc = F.lit(0.0)
    for c in columns:
        acc = acc + F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return acc


def missing_cells(columns: Sequence[str]) -> Column:
    acc = F.lit(0)
    for c in columns:
        acc = acc + F.col(c).isNull().cast("int")
    return acc


def simplex(columns: Sequence[str], uniform_fallback: bool = False) -> dict[str, Column]:
    """Each row divided by its sum when that is positive.

    Otherwise the row is kept, or set to equal shares with ``uniform_fallback``.
    """
    row_sum = total(columns)
    out = {}
    for c in columns:
        fallback = F.lit(1.0 / len(columns)) if uniform_fallback else F.col(c)
        out[c] = F.when(row_sum > 0, F.col(c) / row_sum).otherwise(fallback)
    return out


def single_one(columns: Sequence[str]) -> dict[str, Column]:
    """Rows with several ones keep the first largest cell; a missing cell counts as 0."""
    filled = F.array(*[F.coalesce(F.col(c), F.lit(0.0)) for c in columns])
    several = total(columns) > 1.0
    winner = F.array_position(filled, F.array_max(filled))
    return {
        c: F.when(several, (winner == F.lit(i + 1)).cast("double")).otherwise(F.col(c))
        for i, c in enumerate(columns)
    }


def any_is_one(columns: Sequence[str]) -> Column:
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.col(c) == 1, F.lit(False))
    return hit.cast("double")


def null_pattern(columns: Sequence[str]) -> Column:
    return F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
