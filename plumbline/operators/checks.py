"""Counts of rule violations, and pass/fail constraint checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import cells, rows


@dataclass(frozen=True)
class Check:
    """``bad`` marks a violating row; missing cells are not violations.

    ``holds`` is the strict form for pass/fail: a missing cell fails it.
    """

    rule: str
    column: str
    bad: Column
    holds: Column


def negatives(rule: str, columns: Sequence[str]) -> list[Check]:
    return [Check(rule, c, F.col(c) < 0, F.col(c) >= 0) for c in columns]


def outside(rule: str, columns: Sequence[str], lo: float, hi: float) -> list[Check]:
    return [Check(rule, c, F.col(c).isNotNull() & ~cells.inside(F.col(c), lo, hi),
                  cells.inside(F.col(c), lo, hi)) for c in columns]


def not_binary(rule: str, columns: Sequence[str]) -> list[Check]:
    return [Check(rule, c, ~F.col(c).isin(0.0, 1.0), F.col(c).isin(0.0, 1.0)) for c in columns]


def row_sum_off(rule: str, columns: Sequence[str], lo: float = 0.95, hi: float = 1.05) -> list[Check]:
    ok = rows.total(columns).between(lo, hi)
    return [Check(rule, "*", ~ok, ok)]


def not_exactly_one(rule: str, columns: Sequence[str]) -> list[Check]:
    ok = rows.total(columns) == 1.0
    return [Check(rule, "*", ~ok, ok)]


def more_than_one(rule: str, columns: Sequence[str]) -> list[Check]:
    ok = rows.total(columns) <= 1.0
    return [Check(rule, "*", ~ok, ok)]


def abs_mismatch(rule: str, target: str, source: str) -> list[Check]:
    same = cells.close(F.col(target), F.abs(F.col(source)))
    return [Check(rule, target, ~same, same)]


def flag_mismatch(rule: str, flag: str, members: Sequence[str]) -> list[Check]:
    same = F.col(flag) == rows.any_is_one(members)
    return [Check(rule, flag, ~same, same)]


def rule_violations(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``rule, column, n`` for every check, from one pass over the table."""
    return _one_row_per_check(df, checks, [F.count(F.when(c.bad, 1)) for c in checks], "n")


def constraint_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``rule, column, passed``: a rule passes when it holds on every row."""
    return _one_row_per_check(
        df, checks, [F.coalesce(F.bool_and(F.coalesce(c.holds, F.lit(False))), F.lit(True)) for c in checks], "passed")


def _one_row_per_check(df: DataFrame, checks: Sequence[Check], results: Sequence[Column], name: str) -> DataFrame:
    structs = F.array(*[F.struct(F.lit(c.rule).alias("rule"), F.lit(c.column).alias("column"),
                                 F.col(f"r{i}").alias(name)) for i, c in enumerate(checks)])
    return df.agg(*[r.alias(f"r{i}") for i, r in enumerate(results)]).select(F.inline(structs))
