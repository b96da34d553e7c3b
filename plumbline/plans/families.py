"""Column families resolved against a table's columns by prefix and by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from plumbline.operators.tables import numeric_columns


@dataclass(frozen=True)
class Family:
    prefixes: tuple[str, ...] = ()
    names: tuple[str, ...] = ()


@dataclass(frozen=True)
class ColumnFamilies:
    """Named families; ``rest`` names the family of the numeric columns in no other."""

    families: Mapping[str, Family] = field(default_factory=dict)
    rest: str | None = "other"

    def resolve(self, columns: Sequence[str], numeric: Sequence[str] | None = None) -> dict[str, list[str]]:
        found = {}
        taken: set[str] = set()
        for name, family in self.families.items():
            found[name] = [c for c in columns if c in family.names
                           or (family.prefixes and c.startswith(family.prefixes))]
            taken |= set(found[name])
        if self.rest:
            found[self.rest] = [c for c in (columns if numeric is None else numeric) if c not in taken]
        return found

    def of(self, df: DataFrame) -> dict[str, list[str]]:
        return self.resolve(df.columns, numeric_columns(df))
