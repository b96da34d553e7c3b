"""The cleaning job: keys, types, rules, imputation, calibration, audit."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from plumbline.operators.calibrate import CalibrationConfig, fit_calibration
from plumbline.operators.coerce import coerce_numeric, coercion_summary
from plumbline.operators.impute import ImputePolicy, fit_imputation
from plumbline.operators.keys import HTTP_PREFIXES, clean_keys, keep_best, key_report
from plumbline.operators.profile import drop_sparse_rows
from plumbline.operators.rules import REPORT_SCHEMA, Rule, apply_rules, counted, report_of, rules_from_json, rules_to_json
from plumbline.operators.tables import small_table
from plumbline.session import materialised
from plumbline.sources.files import write_audit, write_table


@dataclass(frozen=True)
class CleanConfig:
    """Settings of one cleaning job.

    ``url_key`` normalises and filters the key; otherwise ``keys`` are taken as
    they are. ``enforcement`` and ``imputation`` may depend on the columns.
    """

    keys: tuple[str, ...]
    score: str | None = None
    ties: tuple[str, ...] = ()
    url_key: bool = True
    prefixes: tuple[str, ...] = HTTP_PREFIXES
    keep_text: tuple[str, ...] = ()
    enforcement: Callable[[list[str]], Sequence[Rule]] = lambda columns: ()
    imputation: Callable[[list[str]], ImputePolicy] = lambda columns: ImputePolicy()
    calibration: CalibrationConfig = field(default_factory=CalibrationConfig)
    max_missing_pct: float | None = None


@dataclass(frozen=True)
class CleanModel:
    """Frozen rules of the three row-local stages."""

    enforcement: tuple[Rule, ...]
    imputation: tuple[Rule, ...]
    calibration: tuple[Rule, ...]

    @property
    def rules(self) -> tuple[Rule, ...]:
        return self.enforcement + self.imputation + self.calibration

    def transform(self, typed: DataFrame) -> DataFrame:
        """Rules on a table that already has one row per key and numeric columns."""
        return apply_rules(typed, self.rules)

    @property
    def stages(self) -> list[tuple[str, tuple[Rule, ...]]]:
        return [("enforcement", self.enforcement), ("imputation", self.imputation), ("calibration", self.calibration)]

    def report(self, typed: DataFrame) -> DataFrame:
        """Cells touched per stage, rule and column, zeros included, in one pass."""
        return report_of(typed, self.stages)

    def to_json(self) -> str:
        import json

        return json.dumps({s: rules_to_json(getattr(self, s)) for s in ("enforcement", "imputation", "calibration")})

    @staticmethod
    def from_json(text: str) -> CleanModel:
        import json

        loaded = json.loads(text)
        return CleanModel(*(tuple(rules_from_json(loaded[s])) for s in ("enforcement", "imputation", "calibration")))


@dataclass(frozen=True)
class CleanJob:
    """``typed_rows`` → ``fit`` → ``run``; each step can be used on its own."""

    config: CleanConfig

    def typed_rows(self, raw: DataFrame) -> DataFrame:
        """One row per key, numbers as doubles.

        The score is made numeric before the rows of a key are compared, so
        that it is not compared as text.
        """
        c = self.config
        typed = coerce_numeric(raw, [*c.keys, *c.keep_text])
        if c.url_key:
            return clean_keys(typed, c.keys[0], c.score, c.ties, c.prefixes)
        return keep_best(typed, c.keys, c.score, c.ties)

    def enforced(self, typed: DataFrame) -> DataFrame:
        rules = list(self.config.enforcement(self._values(typed)))
        out = apply_rules(typed, rules)
        if self.config.max_missing_pct is not None:
            out = drop_sparse_rows(out, self.config.max_missing_pct)
        return out

    def fit(self, typed: DataFrame, reference: DataFrame | None = None) -> CleanModel:
        values = self._values(typed)
        rules = tuple(self.config.enforcement(values))
        filled = fit_imputation(self.enforced(typed), self.config.imputation(values))
        bounds = fit_calibration(coerce_numeric(reference, [c for c in (*self.config.keys, *self.config.keep_text)
                                                            if c in reference.columns]),
                                 self.config.calibration) if reference is not None else []
        return CleanModel(rules, tuple(filled), tuple(bounds))

    def run(self, raw: DataFrame, reference: DataFrame | None = None) -> CleanResult:
        """Fit and apply all stages.

        The deduplicated rows are computed once: fitting, cleaning and the
        report all read them.
        """
        typed = materialised(self.typed_rows(raw))
        if self.config.max_missing_pct is not None:
            typed = self._without_sparse(typed)
        return CleanResult(self, raw, typed, self.fit(typed, reference))

    def audit(self, raw: DataFrame, typed: DataFrame, model: CleanModel, report: DataFrame | None = None) -> DataFrame:
        """``stage, rule, column, n`` over all stages; ``report``: the rules' counters if they are known already."""
        c = self.config
        none = F.lit("*").alias("column")
        parts = []
        if c.url_key:
            parts.append(key_report(raw, c.keys[0], c.prefixes).select(F.lit("keys").alias("stage"), "rule", none, "n"))
        else:
            parts.append(raw.groupBy(*c.keys).agg(F.count(F.lit(1)).alias("n")).agg(
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")).select(
                F.lit("keys").alias("stage"), F.lit("deduplicated").alias("rule"), none, "n"))
        parts.append(coercion_summary(raw, [*c.keys, *c.keep_text]).select(
            F.lit("coercion").alias("stage"), F.lit("coerced").alias("rule"), "column", F.col("coerced").alias("n")))
        changes = (model.report(typed) if report is None else report).select("stage", "column", "rule", F.explode(F.create_map(*[
            x for k in ("nulled", "changed", "filled") for x in (F.lit(k), F.col(k))])).alias("change", "n"))
        parts.append(changes.select("stage", F.concat_ws(":", "rule", "change").alias("rule"), "column", "n"))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def _values(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if c not in (*self.config.keys, *self.config.keep_text)]

    def _without_sparse(self, typed: DataFrame) -> DataFrame:
        """Raw rows whose enforced form has too many missing cells are dropped."""
        rules = list(self.config.enforcement(self._values(typed)))
        kept = typed.select(*typed.columns, *[F.col(c).alias(f"_raw_{c}") for c in typed.columns])
        checked = apply_rules(kept, rules)
        dense = drop_sparse_rows(checked, self.config.max_missing_pct, typed.columns)
        return dense.select(*[F.col(f"_raw_{c}").alias(c) for c in typed.columns])


@dataclass(frozen=True)
class CleanResult:
    job: CleanJob
    raw: DataFrame
    typed: DataFrame
    model: CleanModel

    @property
    def table(self) -> DataFrame:
        return self.model.transform(self.typed)

    @property
    def audit(self) -> DataFrame:
        return self.job.audit(self.raw, self.typed, self.model)

    def write(self, path: str, fmt: str = "infer") -> None:
        """The clean table, with its audit as JSON beside it.

        The rules' counters are observed while the table is written, in the tasks that write it: a task that is run again
        after a lost executor counts once, and no second pass applies the rules.
        """
        found = counted(self.typed, self.model.stages)
        seen = Observation()
        if found.aggregates:
            found.frame = found.frame.observe(seen, *found.aggregates)
        write_table(found.table(), path, fmt)
        rows = found.report(seen.get) if found.aggregates else []
        report = small_table(self.typed.sparkSession, rows, REPORT_SCHEMA)
        write_audit(self.job.audit(self.raw, self.typed, self.model, report), path)
