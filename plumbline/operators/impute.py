"""Fitting of fill-in rules by column family."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from plumbline.operators.ordering import modes, quantiles
from plumbline.operators.rules import AnyFlag, Clip, Fill, Rule, Simplex, apply_rules, rules_report


@dataclass(frozen=True)
class ImputePolicy:
    """Which families are filled, and how.

    ``flags`` are realigned after their members were filled; ``bounded`` maps a
    range to the columns that are filled by the median and clipped into it.
    """

    median: tuple[str, ...] = ()
    mode: tuple[str, ...] = ()
    flags: tuple[tuple[str, ...], ...] = ()
    simplex: tuple[str, ...] = ()
    bounded: tuple[tuple[float, float, tuple[str, ...]], ...] = ()


def fit_median(df: DataFrame, columns: Sequence[str], name: str = "median") -> Fill:
    found = [c for c in dict.fromkeys(columns) if c in df.columns]
    middle = quantiles(df, found, [0.5])
    return Fill(name, tuple(found), {c: middle[c][0] for c in found})


def fit_mode(df: DataFrame, columns: Sequence[str], name: str = "mode") -> Fill:
    found = [c for c in dict.fromkeys(columns) if c in df.columns]
    return Fill(name, tuple(found), modes(df, found))


def fit_imputation(df: DataFrame, policy: ImputePolicy) -> list[Rule]:
    """All statistics from ``df`` at once, frozen into rules in the order they apply."""
    present = set(df.columns)
    bounded = [c for _, _, columns in policy.bounded for c in columns]
    whole_simplex = policy.simplex if set(policy.simplex) <= present else ()
    medians = fit_median(df, [*policy.median, *whole_simplex, *bounded]).values
    most = fit_mode(df, policy.mode).values

    def fill(name: str, columns: Sequence[str], values: dict) -> Fill:
        return Fill(name, tuple(columns), {c: values[c] for c in dict.fromkeys(columns) if c in values})

    rules: list[Rule] = [fill("continuous_median", policy.median, medians), fill("binary_mode", policy.mode, most)]
    rules += [AnyFlag("flag_realigned", flag) for flag in policy.flags]
    if whole_simplex:
        rules += [fill("simplex_median", whole_simplex, medians), Simplex("simplex_renormalised", whole_simplex)]
    for lo, hi, columns in policy.bounded:
        rules += [fill("bounded_median", columns, medians), Clip("bounded_clip", tuple(columns), lo, hi)]
    return rules


def impute(df: DataFrame, policy: ImputePolicy) -> tuple[DataFrame, DataFrame]:
    """The filled table and the report of filled and changed cells."""
    rules = fit_imputation(df, policy)
    return apply_rules(df, rules), rules_report(df, rules, "imputation")
