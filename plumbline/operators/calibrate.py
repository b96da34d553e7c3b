"""Alignment of a table with a reference table."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.ordering import quantiles
from plumbline.operators.rules import (
    Clip, ClipEach, NullOutside, RescueProportion, Rule, Simplex, apply_rules, rules_report)
from plumbline.operators.tables import as_doubles


@dataclass(frozen=True)
class CalibrationConfig:
    """``zclip`` is a list of (name, columns, k): clip to mean ± k sd of the reference."""

    zclip: tuple[tuple[str, tuple[str, ...], float], ...] = ()
    rescue: tuple[str, ...] = ()
    clips: tuple[tuple[str, float, float, tuple[str, ...]], ...] = ()
    simplex: tuple[str, ...] = ()
    rescue_first: bool = False


def reference_spread(reference: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Centre and reach per column: (mean, sample sd), from one pass for all columns.

    A column whose sd is 0 or missing has no reach; ``z_bounds`` takes its
    percentiles instead.
    """
    columns = [c for c in dict.fromkeys(columns) if c in reference.columns]
    if not columns:
        return {}
    row = as_doubles(reference, columns).agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def z_bounds(reference: DataFrame, columns: Sequence[str], k: float) -> dict[str, tuple[float, float]]:
    """Mean ± k sample sd; the 1st and 99th percentile where the sd is 0 or missing."""
    return _z_bounds_each(reference, {c: k for c in columns})


def _z_bounds_each(reference: DataFrame, widths: dict[str, float]) -> dict[str, tuple[float, float]]:
    bounds, flat = {}, []
    for c, (mean, sd) in reference_spread(reference, list(widths)).items():
        if sd is None or math.isnan(sd) or sd == 0.0:
            flat.append(c)
        else:
            bounds[c] = (mean - widths[c] * sd, mean + widths[c] * sd)
    for c, (lo, hi) in quantiles(reference, flat, [0.01, 0.99]).items():
        bounds[c] = (lo, hi)
    return bounds


def tail_bounds(reference: DataFrame, columns: Sequence[str], lo: float = 0.01,
                hi: float = 0.99) -> dict[str, tuple[float, float]]:
    found = quantiles(reference, [c for c in columns if c in reference.columns], [lo, hi])
    return {c: (q[0], q[1]) for c, q in found.items()}


def winsorised(df: DataFrame, columns: Sequence[str], lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Columns clipped to their own lower and upper percentile."""
    return apply_rules(df, [ClipEach("winsorise", tuple(columns), tail_bounds(df, columns, lo, hi))])


def sanitised_reference(reference: DataFrame, domains: Sequence[tuple[float, float, tuple[str, ...]]],
                        heavy: Sequence[str], null_above: Sequence[tuple[str, float]] = ()) -> DataFrame:
    """The reference with impossible values clipped (or nulled) and heavy tails winsorised.

    Only for taking statistics; the percentiles come from the reference itself.
    """
    rules: list[Rule] = [NullOutside("anomaly", (c,), None, hi) for c, hi in null_above]
    rules += [Clip("domain", tuple(columns), lo, hi) for lo, hi, columns in domains]
    return winsorised(apply_rules(reference, rules), heavy)


def fit_calibration(reference: DataFrame, config: CalibrationConfig) -> list[Rule]:
    # Rules on different columns share one pass over the reference.
    repeated = len({c for _, cs, _ in config.zclip for c in cs}) < sum(len(cs) for _, cs, _ in config.zclip)
    if repeated:
        each = [z_bounds(reference, columns, k) for _, columns, k in config.zclip]
    else:
        bounds = _z_bounds_each(reference, {c: k for _, columns, k in config.zclip for c in columns})
        each = [{c: bounds[c] for c in columns if c in bounds} for _, columns, _ in config.zclip]
    zclips: list[Rule] = [ClipEach(name, tuple(columns), b) for (name, columns, _), b in zip(config.zclip, each)]
    ranges: list[Rule] = [RescueProportion("proportion_rescue", config.rescue)] if config.rescue else []
    ranges += [Clip(name, tuple(columns), lo, hi) for name, lo, hi, columns in config.clips]
    rules = ranges + zclips if config.rescue_first else zclips + ranges
    if config.simplex:
        rules.append(Simplex("simplex_renormalised", config.simplex))
    return rules


def calibrate_to_reference(df: DataFrame, reference: DataFrame,
                           config: CalibrationConfig) -> tuple[DataFrame, DataFrame]:
    rules = fit_calibration(reference, config)
    return apply_rules(df, rules), rules_report(df, rules, "calibration")
