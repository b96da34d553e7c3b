"""Linear, ridge and lasso regression from sums of products, for all rows and for every fold, in one pass.

A task multiplies its Arrow batches into centred second moments per fold; moments of one fold are merged in two steps on the
cluster, so the driver receives one small matrix per fold. The fit without a fold merges the other folds' moments (nothing is
subtracted, so no digits are lost), and every penalty and fold is solved on the driver from the same matrices.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MERGERS = 16               # tasks that merge one fold's moments before the last one does


@dataclass
class Moments:
    """Rows, means and centred sums of products of some columns."""

    n: float
    mean: np.ndarray
    products: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        """``x``: [rows, columns]."""
        mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        centred = x - mean
        return cls(float(len(x)), mean, centred.T @ centred)

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        gap = other.mean - self.mean
        return Moments(n, self.mean + gap * (other.n / n),
                       self.products + other.products + np.outer(gap, gap) * (self.n * other.n / n))

    def row(self) -> list[bytes | float]:
        return [self.n, self.mean.tobytes(), self.products.tobytes()]

    @classmethod
    def from_row(cls, n: float, mean: bytes, products: bytes) -> Moments:
        mean = np.frombuffer(mean)
        return cls(n, mean, np.frombuffer(products).reshape(len(mean), len(mean)))


MOMENTS = "fold int, salt int, n double, mean binary, products binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=["fold", "salt", "n", "mean", "products"])


def fold_moments(df: DataFrame, columns: Sequence[str], fold: str | None = None) -> dict[int, Moments]:
    """Moments of the complete rows per value of ``fold`` (0 for all rows without one)."""
    source = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)],
                       (F.col(fold).cast("int") if fold else F.lit(0)).alias("fold"))

    def add_up(batches):
        from pyspark import TaskContext

        held: dict[int, Moments] = {}
        for batch in batches:
            x = np.column_stack([np.asarray(batch.column(i).fill_null(np.nan), np.float64) for i in range(len(columns))])
            folds = np.asarray(batch.column(len(columns)))
            whole = np.isfinite(x).all(axis=1)
            for f in np.unique(folds[whole]):
                part = Moments.of(x[whole & (folds == f)])
                held[int(f)] = held[int(f)] + part if int(f) in held else part
        if held:
            yield _batch([(f, TaskContext.get().partitionId() % MERGERS, *m.row()) for f, m in sorted(held.items())])

    def merge(batches):
        held: dict[tuple, Moments] = {}
        for batch in batches:
            for f, salt, n, mean, products in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                m = Moments.from_row(n, mean, products)
                held[f, salt] = held[f, salt] + m if (f, salt) in held else m
        if held:
            yield _batch([(f, salt, *m.row()) for (f, salt), m in sorted(held.items())])

    parts = source.mapInArrow(add_up, MOMENTS)
    if source.rdd.getNumPartitions() > MERGERS:
        parts = parts.repartition("fold", "salt").mapInArrow(merge, MOMENTS)
    found: dict[int, Moments] = {}
    for r in sorted(parts.collect(), key=lambda r: (r["fold"], r["salt"])):      # at most MERGERS small matrices per fold
        m = Moments.from_row(r["n"], r["mean"], r["products"])
        found[r["fold"]] = found[r["fold"]] + m if r["fold"] in found else m
    return found


def without(moments: dict[int, Moments], fold: int | None = None) -> Moments:
    """All folds' moments but one's."""
    kept = [m for f, m in sorted(moments.items()) if f != fold]
    if not kept:
        raise ValueError("no complete rows to fit on")
    total = kept[0]
    for m in kept[1:]:
        total = total + m
    return total


# ---- solving ----------------------------------------------------------------------------------------------------------

def _least_squares(a: np.ndarray, b: np.ndarray, n: float, params) -> np.ndarray:
    """Smallest solution of the normal equations; directions without spread get no weight."""
    values, vectors = np.linalg.eigh(a)
    keep = values > 1e-12 * max(values.max(initial=0), 1e-300)
    return vectors[:, keep] @ ((vectors[:, keep].T @ b) / values[keep])


def _ridge(a: np.ndarray, b: np.ndarray, n: float, params) -> np.ndarray:
    alpha = float(params.get("alpha", 1.0))
    return _least_squares(a, b, n, params) if alpha == 0 else np.linalg.solve(a + alpha * np.eye(len(a)), b)


def _lasso(a: np.ndarray, b: np.ndarray, n: float, params) -> np.ndarray:
    """Coordinate descent on |y - x w|^2 / 2n + alpha |w|_1, until no weight moves the fit any more."""
    threshold = float(params.get("alpha", 1.0)) * n
    w, residual = np.zeros(len(b)), b.astype(float).copy()             # residual: x' (y - x w)
    spread = np.diag(a)
    for _ in range(int(params.get("iterations", 1000))):
        moved = 0.0
        for j in np.flatnonzero(spread > 0):
            old = w[j]
            pull = residual[j] + spread[j] * old
            w[j] = np.sign(pull) * max(abs(pull) - threshold, 0.0) / spread[j]
            if w[j] != old:
                residual -= a[:, j] * (w[j] - old)
                moved = max(moved, abs(w[j] - old) * np.sqrt(spread[j]))
        if moved <= 1e-10 * np.sqrt(max(float(b @ b) / max(spread.max(initial=1.0), 1e-300), 1e-300)):
            break
    return w


SOLVERS: dict[str, Callable] = {"linear": _least_squares, "ridge": _ridge, "lasso": _lasso}


@dataclass(frozen=True)
class Line:
    """``intercept`` + sum of ``weights`` * columns."""

    columns: tuple[str, ...]
    intercept: float
    weights: tuple[float, ...]

    def sql(self) -> str:
        parts = [f"({self.intercept!r}D)"] + [f"({w!r}D) * CAST(`{c}` AS DOUBLE)" for c, w in zip(self.columns, self.weights)]
        return " + ".join(parts)

    def column(self) -> Column:
        return F.expr(self.sql())

    def model(self) -> PipelineModel:
        """The line as a storable pipeline; a missing feature gives a missing prediction."""
        return PipelineModel([SQLTransformer(statement=f"SELECT *, {self.sql()} AS prediction FROM __THIS__")])


def solve(moments: Moments, columns: Sequence[str], kind: str, params, scaled: bool) -> Line:
    """``moments`` of the features and, last, the target. ``scaled``: penalties weigh features of unit population sd."""
    p = len(columns)
    spread = np.diag(moments.products)[:p]
    width = np.sqrt(spread / moments.n) if scaled else np.ones(p)
    used = np.flatnonzero(spread > 1e-18 * moments.n * np.maximum(1.0, moments.mean[:p] ** 2)) if p else np.zeros(0, int)
    weights = np.zeros(p)
    if len(used):
        w = width[used]
        a = moments.products[np.ix_(used, used)] / np.outer(w, w)
        b = moments.products[used, p] / w
        weights[used] = SOLVERS[kind](a, b, moments.n, params) / w
    intercept = float(moments.mean[p] - weights @ moments.mean[:p])
    return Line(tuple(columns), intercept, tuple(float(x) for x in weights))


def fit_lines(df: DataFrame, features: Sequence[str], label: str, kind: str, params=None, scaled: bool = False,
              fold: str | None = None, folds: int = 0, moments: dict[int, Moments] | None = None) -> list[Line]:
    """The fit on all rows, then for each fold 1..``folds`` the fit on the rows outside it; ``moments`` saves the pass."""
    if kind not in SOLVERS:
        raise ValueError(f"unknown linear model: {kind}")
    found = fold_moments(df, [*features, label], fold) if moments is None else moments
    return [solve(without(found, f), list(features), kind, params or {}, scaled) for f in [None, *range(1, folds + 1)]]


def by_fold(lines: Sequence[Line], fold: str) -> Column:
    """Each row's prediction by the line fitted without its fold; ``lines`` as from :func:`fit_lines`."""
    out = F.lit(None).cast("double")
    for i, line in enumerate(lines[1:], 1):
        out = F.when(F.col(fold) == i, line.column()).otherwise(out)
    return out
