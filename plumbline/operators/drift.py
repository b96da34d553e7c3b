"""Comparison of a current table with a reference table, column by column."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.profile import bin_ranges, describe, histogram
from plumbline.operators.tables import as_doubles, shared_numeric_columns, small_table

STATS = ("mean", "sd", "min", "p50", "p95", "max")
CUTS = 1_024               # cut values per pass over a column, at least
CUTS_EACH = 16             # and for each open stretch,
MOST_CUTS = 32_768         # but not more than these
SAMPLED = 8                # rows that are looked at for each cut value
FEW_ROWS = 20_000          # rows whose values are all cuts


def compare_stats(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """mean, sd, min, median, 95th percentile and max of both tables side by side."""
    columns = list(columns or shared_numeric_columns(reference, current))

    def side(df: DataFrame, name: str) -> DataFrame:
        return describe(df, columns, {"p50": 0.5, "p95": 0.95}).select(
            "column", *[F.col(s).alias(f"{name}_{s}") for s in STATS])

    joined = side(reference, "ref").join(F.broadcast(side(current, "cur")), "column")
    return joined.select("column", *[f"{name}_{s}" for s in STATS for name in ("ref", "cur")])


def ks_p_value(ks: Column, n_ref: Column, n_cur: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value (the Kolmogorov series)."""
    scaled = ks * F.sqrt(n_ref * n_cur / (n_ref + n_cur))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * scaled * scaled))
    return F.when(scaled < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


@dataclass
class _Steps:
    """Search for the greatest gap of one column: rows per side, the gap so far, and the stretches that may hold a greater one.

    A stretch is (low, high, rows of both sides at most low, rows of both sides strictly inside).
    """

    n: int
    m: int
    best: float = 0.0
    open: list[tuple[float, float, int, int, int, int]] = field(default_factory=list)

    def gap(self, r: int, c: int) -> float:
        return abs(r / self.n - c / self.m)

    def take(self, stretches: list[tuple[float, float, int, int, int, int]]) -> None:
        """Keep the stretches in which the gap can exceed the greatest one known: one side's rows might all come first."""
        for _, _, r0, c0, r, c in stretches:
            self.best = max(self.best, self.gap(r0, c0), self.gap(r0 + r, c0 + c))
        self.open = [s for s in stretches if s[4] + s[5] > 0 and
                     max(self.gap(s[2] + s[4], s[3]), self.gap(s[2], s[3] + s[5])) > self.best]


def _inner_values(both: DataFrame, stretches: dict[str, list], share: float, seed: int) -> dict[str, np.ndarray]:
    """Ascending values strictly inside the stretches of each column, of a random ``share`` of the rows (all at 1)."""
    columns = list(stretches)
    lows, highs = ({c: np.array([x[side] for x in stretches[c]]) for c in columns} for side in (0, 1))

    def run(batches):
        for batch in batches:
            for i, c in enumerate(columns):
                x = np.asarray(batch.column(c).drop_null(), np.float64)
                at = np.searchsorted(lows[c], x, side="left") - 1         # the last stretch that begins below the value
                x = x[(at >= 0) & (x < highs[c][at])]
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([x.tobytes()], pa.binary())], names=["i", "x"])

    rows = both.select(*columns)
    rows = (rows.sample(share, seed) if share < 1 else rows).mapInArrow(run, "i long, x binary").collect()     # some ten thousand values
    return {c: np.sort(np.concatenate([np.empty(0), *[np.frombuffer(r["x"]) for r in rows if r["i"] == i]])) for i, c in enumerate(columns)}


def _side_counts(both: DataFrame, edges: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Per column rows of both sides between and at its ascending edges: [2, 2 * edges + 1], odd places are the edges."""
    columns = list(edges)

    def run(batches):
        total = {c: np.zeros((2, 2 * len(e) + 1), np.int64) for c, e in edges.items()}
        for batch in batches:
            side = np.asarray(batch.column("_ref"))
            for i, c in enumerate(columns):
                x = np.asarray(batch.column(c).fill_null(np.nan), np.float64)
                known = ~np.isnan(x)
                x, width = x[known], total[c].shape[1]
                at = np.searchsorted(edges[c], x, side="left")
                hit = (at < len(edges[c])) & (edges[c][np.minimum(at, len(edges[c]) - 1)] == x)
                total[c] += np.bincount(side[known] * width + 2 * at + hit, minlength=2 * width).reshape(2, width)
        for i, c in enumerate(columns):
            s, place = np.nonzero(total[c])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), i)), pa.array(s), pa.array(place), pa.array(total[c][s, place])],
                                             names=["i", "side", "place", "n"])

    rows = both.select(*columns, "_ref").mapInArrow(run, "i long, side long, place long, n long").groupBy("i", "side", "place").agg(F.sum("n").alias("n"))
    out = {c: np.zeros((2, 2 * len(e) + 1), np.int64) for c, e in edges.items()}
    found = rows.toArrow()                           # two numbers per edge and side
    i, side, place, n = (np.asarray(found.column(c)) for c in ("i", "side", "place", "n"))
    for at, c in enumerate(columns):
        mine = i == at
        out[c][side[mine], place[mine]] = n[mine]
    return out


def ks_statistic(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per column, over all distinct values: ``column, ks, ks_p_asymptotic``.

    Counts at some cut values give the gap there and bound it in between; only stretches that can hold a greater gap are cut
    again, each by several values from inside it, until few rows lie in them, which then are all cuts. The cuts come from a
    random sample of the rows inside, the counts from every row, so the result is exact whatever the cuts. What a pass shuffles
    depends on the cuts, not on the rows or their distinct values. A side without values gives nulls.
    """
    columns = list(columns or shared_numeric_columns(reference, current))
    both = (as_doubles(reference, columns).withColumn("_ref", F.lit(1))
            .unionByName(as_doubles(current, columns).withColumn("_ref", F.lit(0)))
            .select("_ref", *[(F.col(c) + F.lit(0.0)).alias(c) for c in columns]))
    sizes = both.agg(*[F.count(F.when(F.col("_ref") == side, F.col(c))).alias(f"n{side}_{i}") for i, c in enumerate(columns) for side in (1, 0)]).first()
    steps = {c: _Steps(sizes[f"n1_{i}"], sizes[f"n0_{i}"]) for i, c in enumerate(columns)}
    for s in steps.values():
        if s.n and s.m:
            s.open = [(-math.inf, math.inf, 0, 0, s.n, s.m)]
    seed, lift = 0, 1
    while any(s.open for s in steps.values()):
        stretches = {c: s.open for c, s in steps.items() if s.open}
        inner = max(sum(x[4] + x[5] for x in found) for found in stretches.values())
        most = max(CUTS, min(MOST_CUTS, CUTS_EACH * max(map(len, stretches.values()))))
        share = min(1.0, lift * SAMPLED * most / inner) if inner > FEW_ROWS else 1.0
        values = _inner_values(both, stretches, share, seed)
        edges = {}
        for c, found in stretches.items():
            x = np.unique(values[c] if share == 1 else values[c][::max(1, len(values[c]) // most)])
            edges[c] = np.union1d([b for s in found for b in s[:2] if math.isfinite(b)], x)
        counts = _side_counts(both, edges)
        for c, found in stretches.items():
            steps[c].take(_cut(found, edges[c], counts[c]))
        lift = lift if any(map(len, values.values())) else 2 * lift       # a sample may miss them
        seed += 1
    rows = [(c, s.best if s.n and s.m else None, float(s.n), float(s.m)) for c, s in steps.items()]
    table = small_table(both.sparkSession, rows, "column string, ks double, n_ref double, n_cur double")
    return table.select("column", "ks", ks_p_value(F.col("ks"), F.col("n_ref"), F.col("n_cur")).alias("ks_p_asymptotic"))


def _cut(stretches: list, edges: np.ndarray, counts: np.ndarray) -> list[tuple[float, float, int, int, int, int]]:
    """The stretches, cut at the edges inside them; counts as from :func:`_side_counts` (side 1 is the reference)."""
    out = []
    for low, high, r, c, _, _ in stretches:
        first = int(np.searchsorted(edges, low, side="right"))
        for i in range(first, len(edges) + 1):
            end = edges[i] if i < len(edges) else math.inf
            inner = counts[:, 2 * i]
            out.append((low, float(min(end, high)), r, c, int(inner[1]), int(inner[0])))
            if end >= high:
                break
            r, c = r + int(inner[1] + counts[1, 2 * i + 1]), c + int(inner[0] + counts[0, 2 * i + 1])
            low = float(end)
    return out


def ks_exact_p(ks: float, n: int, m: int) -> float:
    """Exact two-sided p-value of the two-sample statistic without ties: the share of lattice paths from (0, 0) to (n, m)
    that somewhere come as far from the diagonal as ``ks``. Integer arithmetic, n * m steps."""
    far = round(ks * n * m)                          # |i m - j n| is a whole number
    ways = [0] * (m + 1)                             # paths to (i, j) that stayed nearer
    for i in range(n + 1):
        for j in range(m + 1):
            if i == j == 0:
                ways[0] = int(far > 0)
            elif abs(i * m - j * n) >= far:
                ways[j] = 0
            elif i == 0:
                ways[j] = ways[j - 1]
            elif j > 0:
                ways[j] += ways[j - 1]
    total = math.comb(n + m, n)
    return (total - ways[m]) / total


def ks_small_samples(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None, most: int = 10_000) -> DataFrame:
    """``column, n_ref, n_cur, ks, ks_p_asymptotic, ks_p_exact``; the exact p-value where n_ref * n_cur is at most ``most``."""
    columns = list(columns or shared_numeric_columns(reference, current))
    count = lambda df: df.agg(*[F.count(F.col(c)).alias(c) for c in columns]).first()        # noqa: E731
    n, m = count(as_doubles(reference, columns)), count(as_doubles(current, columns))
    rows = [(r["column"], n[r["column"]], m[r["column"]], r["ks"], r["ks_p_asymptotic"],
             ks_exact_p(r["ks"], n[r["column"]], m[r["column"]]) if r["ks"] is not None and n[r["column"]] * m[r["column"]] <= most else None)
            for r in ks_statistic(reference, current, columns).collect()]                     # one row per column
    return small_table(reference.sparkSession, rows, "column string, n_ref long, n_cur long, ks double, ks_p_asymptotic double, ks_p_exact double")


def jensen_shannon(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None,
                   bins: int = 50, shared_range: bool = False) -> DataFrame:
    """Jensen-Shannon distance of two histograms per column: ``column, jsd``.

    Each side is binned over its own range, which compares shapes;
    ``shared_range`` compares values. Empty bins count as density 1e-12. A
    column with fewer than two values on a side has no distance.
    """
    columns = list(columns or shared_numeric_columns(reference, current))
    a, b = bin_ranges(reference, columns), bin_ranges(current, columns)
    if shared_range:
        a = b = {c: (min(a[c][0], b[c][0]), max(a[c][1], b[c][1])) for c in a if c in b}

    def mass(df: DataFrame, ranges, name: str) -> DataFrame:
        # Windows over the bins of one column: the histogram is computed once.
        whole = Window.partitionBy("column")
        n, total = F.col("n").cast("double"), F.sum("n").over(whole)
        density = F.when(n > 0, F.try_divide(n, total * (F.col("hi") - F.col("lo")))).otherwise(F.lit(1e-12))
        h = histogram(df, columns, bins, ranges).select("column", "bin", density.alias("d"), total.alias(f"n{name}"))
        return h.select("column", "bin", f"n{name}", (F.col("d") / F.sum("d").over(whole)).alias(name))

    joined = mass(reference, a, "p").join(F.broadcast(mass(current, b, "q")), ["column", "bin"])
    p, q = F.col("p"), F.col("q")
    m = (p + q) / 2.0
    inner = (F.sum(p * F.ln(p / m)) + F.sum(q * F.ln(q / m))) / 2.0
    found = joined.groupBy("column").agg(
        F.sqrt(F.greatest(inner, F.lit(0.0))).alias("jsd"), F.min("np").alias("np"), F.min("nq").alias("nq"))
    names = small_table(reference.sparkSession, [(c,) for c in columns], "column string")
    return names.join(F.broadcast(found), "column", "left").select(
        "column", F.when((F.col("np") >= 2) & (F.col("nq") >= 2), F.col("jsd")).alias("jsd"))


def drift_table(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None,
                bins: int = 50) -> DataFrame:
    """KS and Jensen-Shannon per column, most similar first."""
    joined = ks_statistic(reference, current, columns).join(
        F.broadcast(jensen_shannon(reference, current, columns, bins)), "column")
    return joined.orderBy(F.col("jsd").asc_nulls_last(), F.col("ks_p_asymptotic").desc(), "column")


def most_similar(drift: DataFrame, k: int = 12) -> DataFrame:
    return drift.orderBy(F.col("jsd").asc_nulls_last(), F.col("ks_p_asymptotic").desc(), "column").limit(k)


def most_different(drift: DataFrame, k: int = 12) -> DataFrame:
    return drift.orderBy(F.col("jsd").desc_nulls_first(), F.col("ks_p_asymptotic").asc(), "column").limit(k)
