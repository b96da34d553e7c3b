"""Row-local repair rules: frozen dataclasses that compile to projections.

A stage (enforcement, imputation, calibration) is a list of rules. Fitted
numbers live inside the rules, so a fitted stage can be stored as JSON and
replayed on another table or on a stream. Rules that touch different columns
share one projection; a rule that reads what an earlier one wrote starts the
next projection, which keeps every expression small.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import cells, rows
from plumbline.operators.tables import small_table

_KINDS: dict[str, type] = {}


def _kind(cls):
    _KINDS[cls.__name__] = cls
    return cls


@dataclass(frozen=True)
class Rule:
    name: str
    columns: tuple[str, ...]

    def written(self, present: set[str]) -> list[str]:
        return list(dict.fromkeys(c for c in self.columns if c in present))

    def read(self, present: set[str]) -> list[str]:
        return self.written(present)

    def outputs(self, present: set[str]) -> dict[str, Column]:
        return {c: self.cell(c) for c in self.written(present)}

    def cell(self, column: str) -> Column:
        raise NotImplementedError


@_kind
@dataclass(frozen=True)
class NullNegative(Rule):
    """Negative cells are missing (sentinels) or invalid: null either way."""

    def cell(self, column):
        return cells.null_negative(F.col(column))


@_kind
@dataclass(frozen=True)
class NullOutside(Rule):
    lo: float | None = None
    hi: float | None = None

    def cell(self, column):
        return cells.null_outside(F.col(column), self.lo, self.hi)


@_kind
@dataclass(frozen=True)
class SnapBinary(Rule):
    tolerance: float = 0.1

    def cell(self, column):
        return cells.snap_binary(F.col(column), self.tolerance)


@_kind
@dataclass(frozen=True)
class Clip(Rule):
    lo: float | None = None
    hi: float | None = None

    def cell(self, column):
        return cells.clip(F.col(column), self.lo, self.hi)


@_kind
@dataclass(frozen=True)
class ClipEach(Rule):
    """Fitted bounds, one pair per column."""

    bounds: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)

    def written(self, present):
        return [c for c in super().written(present) if c in self.bounds]

    def cell(self, column):
        return cells.clip(F.col(column), *self.bounds[column])


@_kind
@dataclass(frozen=True)
class RescueProportion(Rule):
    def cell(self, column):
        return cells.rescue_proportion(F.col(column))


@_kind
@dataclass(frozen=True)
class Fill(Rule):
    """Fitted constants for missing cells; a column without one stays as it is."""

    values: dict[str, float | str | None] = field(default_factory=dict)

    def written(self, present):
        return [c for c in super().written(present) if self.values.get(c) is not None]

    def cell(self, column):
        return F.coalesce(F.col(column), F.lit(self.values[column]))


@_kind
@dataclass(frozen=True)
class SingleOne(Rule):
    """At most one 1 in the family: the first largest wins."""

    def outputs(self, present):
        return rows.single_one(self.written(present))


@_kind
@dataclass(frozen=True)
class Simplex(Rule):
    uniform_fallback: bool = False
    complete: bool = False  # only when every column of the family exists

    def written(self, present):
        found = super().written(present)
        if self.complete and len(found) < len(set(self.columns)):
            return []
        return found

    def outputs(self, present):
        return rows.simplex(self.written(present), self.uniform_fallback)


@_kind
@dataclass(frozen=True)
class AnyFlag(Rule):
    """``columns[0]`` becomes 1 when one of the other columns is 1, else 0."""

    def written(self, present):
        return [self.columns[0]] if set(self.columns) <= present else []

    def read(self, present):
        return list(self.columns) if set(self.columns) <= present else []

    def cell(self, column):
        return rows.any_is_one(self.columns[1:])


@_kind
@dataclass(frozen=True)
class AbsOf(Rule):
    """``columns[0]`` repaired or filled with the absolute value of ``columns[1]``."""

    def written(self, present):
        return [self.columns[0]] if set(self.columns) <= present else []

    def read(self, present):
        return list(self.columns) if set(self.columns) <= present else []

    def cell(self, column):
        return cells.repaired_abs(F.col(self.columns[0]), F.col(self.columns[1]))


def rules_to_json(rules: Sequence[Rule]) -> str:
    return json.dumps([{"kind": type(r).__name__, **asdict(r)} for r in rules])


def rules_from_json(text: str) -> list[Rule]:
    loaded = []
    for item in json.loads(text):
        kind = _KINDS[item.pop("kind")]
        item["columns"] = tuple(item["columns"])
        if "bounds" in item:
            item["bounds"] = {c: tuple(b) for c, b in item["bounds"].items()}
        loaded.append(kind(**item))
    return loaded


def _layers(rules: Iterable[Rule], present: set[str]) -> list[list[Rule]]:
    layers: list[list[Rule]] = []
    written: set[str] = set()
    for rule in rules:
        if not rule.written(present):
            continue
        touched = set(rule.read(present)) | set(rule.written(present))
        if not layers or touched & written:
            layers.append([])
            written = set()
        layers[-1].append(rule)
        written |= set(rule.written(present))
    return layers


def _outputs(layer: Sequence[Rule], present: set[str]) -> dict[str, Column]:
    merged: dict[str, Column] = {}
    for rule in layer:
        merged.update(rule.outputs(present))
    return merged


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Apply the rules in order; columns that do not exist are skipped."""
    present = set(df.columns)
    for layer in _layers(rules, present):
        df = df.withColumns(_outputs(layer, present))
    return df


# How a cell can change under a rule.
_CHANGES: dict[str, Callable[[Column, Column], Column]] = {
    "nulled": lambda old, new: old.isNotNull() & new.isNull(),
    "changed": lambda old, new: old.isNotNull() & new.isNotNull() & (F.abs(old - new) > 1e-9),
    "filled": lambda old, new: old.isNull() & new.isNotNull(),
}


@dataclass
class Counted:
    """A table with rules applied, each counter as a named aggregate over its rows, and what the counters stand for."""

    frame: DataFrame                                   # the table's columns, and helper columns that the aggregates read
    columns: list[str]                                 # the table's own columns
    aggregates: list[Column] = field(default_factory=list)
    meaning: list[tuple[str, str, str, dict[str, str]]] = field(default_factory=list)    # stage, rule, column, counter by change

    def table(self) -> DataFrame:
        return self.frame.select(*[F.col(f"`{c}`") for c in self.columns])

    def report(self, counts: Mapping[str, int]) -> list[tuple]:
        """Rows ``stage, rule, column, nulled, changed, filled``."""
        return [(stage, rule, column, *[counts[labels[c]] for c in _CHANGES]) for stage, rule, column, labels in self.meaning]


REPORT_SCHEMA = "stage string, rule string, column string, nulled bigint, changed bigint, filled bigint"


def counted(df: DataFrame, stages: Sequence[tuple[str, Sequence[Rule]]], only_used: bool = False) -> Counted:
    """Apply the stages' rules in order and say how to count what each rule does to each column.

    Counters are cells nulled, changed and filled. A change of at most 1e-9 is rounding and not counted. Non-numeric cells
    (which only ``Fill`` touches) are never counted as changed. ``only_used`` leaves out columns that no rule reads or writes.
    """
    present = set(df.columns)
    numeric = {c for c, t in df.dtypes if t != "string"}
    layers = [(stage, layer) for stage, rules in stages for layer in _layers(rules, present)]
    used = {c for _, layer in layers for r in layer for c in (*r.read(present), *r.written(present))}
    columns = [c for c in df.columns if not only_used or c in used]
    frame = df.select(*[F.col(f"`{c}`") for c in columns])
    writes: dict[str, list[int]] = {}
    for depth, (_, layer) in enumerate(layers):
        outputs = _outputs(layer, present)
        for c in outputs:
            writes.setdefault(c, []).append(depth)
        kept = [F.col(c).alias(f"_before{depth}_{c}") for c in outputs]
        frame = frame.select("*", *kept).withColumns(outputs)

    def after(column: str, depth: int) -> Column:
        later = [d for d in writes[column] if d > depth]
        return F.col(f"_before{later[0]}_{column}") if later else F.col(column)

    out = Counted(frame, columns)
    for depth, (stage, layer) in enumerate(layers):
        for rule in layer:
            for c in rule.written(present):
                old, new = F.col(f"_before{depth}_{c}"), after(c, depth)
                labels = {}
                for change, test in _CHANGES.items():
                    hit = F.lit(False) if change == "changed" and c not in numeric else test(old, new)
                    labels[change] = f"n{len(out.aggregates)}"
                    out.aggregates.append(F.count(F.when(hit, 1)).alias(labels[change]))
                out.meaning.append((stage, rule.name, c, labels))
    return out


def rules_report(df: DataFrame, rules: Sequence[Rule], stage: str) -> DataFrame:
    """Cells nulled, changed and filled per rule and column (see :func:`counted`), in one pass.

    Schema: ``stage, rule, column, nulled, changed, filled``.
    """
    return report_of(df, [(stage, rules)])


def report_of(df: DataFrame, stages: Sequence[tuple[str, Sequence[Rule]]]) -> DataFrame:
    """The counters of several stages, the later ones on what the earlier ones left, in one pass."""
    found = counted(df, stages, only_used=True)
    if not found.aggregates:
        return small_table(df.sparkSession, [], REPORT_SCHEMA)
    structs = [F.struct(F.lit(stage).alias("stage"), F.lit(rule).alias("rule"), F.lit(c).alias("column"),
                        *[F.col(label).alias(change) for change, label in labels.items()])
               for stage, rule, c, labels in found.meaning]
    return found.frame.agg(*found.aggregates).select(F.inline(F.array(*structs)))
