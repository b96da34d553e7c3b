"""Exact quantiles, order statistics and ranks that no single task has to hold.

Spark's exact ``percentile`` keeps one map entry per distinct value in one
task. That is fine for flags and counts and fatal for a continuous column of
a very large table. Here the distinct count of each column is measured first;
columns above the limit are answered by narrowing a bracket around the wanted
rank: sketch, count exactly, repeat. Every pass is an aggregate with a
map-side combine, so the rows themselves are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.ml.feature import Bucketizer

from plumbline.operators.tables import as_doubles, finite

DISTINCT_LIMIT = 100_000   # value map one aggregate buffer may hold
BLOCK_LIMIT = 1_000_000    # the same, over all columns of one job
SKETCH_ACCURACY = 10_000
ROWS_PER_BUCKET = 1_000_000
BROADCAST_VALUES = 200_000  # a looked-up table of a few megabytes


# ---------------------------------------------------------------- quantiles

def _blocks(columns: Sequence[str], distinct: Mapping[str, int]) -> list[list[str]]:
    blocks, load = [[]], 0
    for c in columns:
        if blocks[-1] and load + distinct[c] > BLOCK_LIMIT:
            blocks.append([])
            load = 0
        blocks[-1].append(c)
        load += distinct[c]
    return [b for b in blocks if b]


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
              distinct_limit: int = DISTINCT_LIMIT) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation; a column without values gives nulls."""
    columns = list(dict.fromkeys(columns))
    if not columns:
        return {}
    data = as_doubles(df, columns)
    sizes = data.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)],
                     *[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    counts = {c: sizes[f"n{i}"] for i, c in enumerate(columns)}
    distinct = {c: sizes[f"d{i}"] for i, c in enumerate(columns)}
    found: dict[str, list[float | None]] = {}
    few = [c for c in columns if distinct[c] <= distinct_limit]
    points = F.array(*[F.lit(float(p)) for p in probs])
    for block in _blocks(few, distinct):
        row = data.agg(*[F.percentile(c, points).alias(f"q{i}") for i, c in enumerate(block)]).first()
        for i, c in enumerate(block):
            found[c] = list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(probs)
    many = [c for c in columns if c not in found]
    if many:
        wanted = {}
        for c in many:
            spots = [p * (counts[c] - 1) for p in probs]
            wanted[c] = sorted({math.floor(s) for s in spots} | {math.ceil(s) for s in spots})
        values = order_statistics(data, wanted, counts, distinct_limit)
        for c in many:
            found[c] = []
            for p in probs:
                spot = p * (counts[c] - 1)
                lo, hi = values[c][math.floor(spot)], values[c][math.ceil(spot)]
                found[c].append(lo + (hi - lo) * (spot - math.floor(spot)))
    return found


@dataclass
class _Bracket:
    column: str
    rank: int                  # wanted position, from 0
    lo: float | None = None    # inclusive bounds around the wanted value
    hi: float | None = None
    below: int = 0             # rows smaller than lo
    inside: int = 0            # rows between the bounds
    slack: float = 2.0 / SKETCH_ACCURACY

    def cell(self) -> Column:
        c = F.col(self.column)
        keep = c.isNotNull()
        if self.lo is not None:
            keep = keep & (c >= F.lit(self.lo))
        if self.hi is not None:
            keep = keep & (c <= F.lit(self.hi))
        return F.when(keep, c)

    def settled(self, limit: int) -> bool:
        return self.inside <= limit or (self.lo is not None and self.lo == self.hi)


def order_statistics(df: DataFrame, ranks: Mapping[str, Sequence[int]], counts: Mapping[str, int],
                     row_limit: int = DISTINCT_LIMIT) -> dict[str, dict[int, float]]:
    """The values at 0-based sorted positions of double columns, by narrowing brackets.

    A sketch proposes each bracket; it is used only once exact counts confirm it.
    """
    brackets = [_Bracket(c, r, inside=counts[c]) for c, rs in ranks.items() for r in rs]
    while True:
        active = [b for b in brackets if not b.settled(row_limit)]
        if not active:
            break
        _cut(df, active, _sketched(df, active))
    values: dict[str, dict[int, float]] = {c: {} for c in ranks}
    last = [b for b in brackets if not (b.lo is not None and b.lo == b.hi)]
    for b in brackets:
        if b not in last:
            values[b.column][b.rank] = b.lo
    for start in range(0, len(last), 16):
        group = last[start:start + 16]
        picked = df.select(*[b.cell().alias(f"v{i}") for i, b in enumerate(group)])
        row = picked.agg(*[
            # Half a row past the wanted one: the first value whose share reaches it.
            F.expr(f"percentile_disc({(b.rank - b.below + 0.5) / b.inside!r}D) WITHIN GROUP (ORDER BY v{i})")
            .alias(f"q{i}") for i, b in enumerate(group)]).first()
        for i, b in enumerate(group):
            values[b.column][b.rank] = row[f"q{i}"]
    return values


def _sketched(df: DataFrame, brackets: Sequence[_Bracket]) -> list[tuple[float, float]]:
    """New bounds around each wanted rank; brackets over the same rows share one sketch."""
    groups: dict[tuple, list[int]] = {}
    for i, b in enumerate(brackets):
        groups.setdefault((b.column, b.lo, b.hi), []).append(i)
    cells, sketches, places = [], [], {}
    for g, members in enumerate(groups.values()):
        cells.append(brackets[members[0]].cell().alias(f"v{g}"))
        shares = []
        for i in members:
            b = brackets[i]
            at = (b.rank - b.below + 0.5) / b.inside
            places[i] = (f"q{g}", len(shares))
            shares += [max(0.0, at - b.slack), min(1.0, at + b.slack)]
        sketches.append(F.percentile_approx(f"v{g}", F.array(*[F.lit(x) for x in shares]), SKETCH_ACCURACY).alias(f"q{g}"))
    row = df.select(*cells).agg(*sketches).first()
    return [(row[q][k], row[q][k + 1]) for q, k in (places[i] for i in range(len(brackets)))]


def _cut(df: DataFrame, brackets: Sequence[_Bracket], ends: Sequence[tuple[float, float]]) -> None:
    """Count the rows below and inside the proposed bounds; keep them only if they hold the rank."""
    exact = df.agg(*[
        F.count(F.when(F.col(b.column) < F.lit(lo), 1)).alias(f"b{i}") for i, (b, (lo, _)) in enumerate(zip(brackets, ends))
    ], *[
        F.count(F.when(F.col(b.column).between(F.lit(lo), F.lit(hi)), 1)).alias(f"w{i}")
        for i, (b, (lo, hi)) in enumerate(zip(brackets, ends))]).first()
    for i, b in enumerate(brackets):
        below, within = exact[f"b{i}"], exact[f"w{i}"]
        if below <= b.rank < below + within and within < b.inside:
            b.lo, b.hi, b.below, b.inside = ends[i][0], ends[i][1], below, within
            b.slack = 2.0 / SKETCH_ACCURACY
        elif below <= b.rank < below + within:
            # Nothing was cut off: a few heavy values fill the bracket. Halve by value instead.
            _halve(df, b, ends[i])
        else:
            b.slack *= 16.0   # the bounds missed; the counts say so, look wider


def _halve(df: DataFrame, b: _Bracket, ends: Sequence[float]) -> None:
    """Split a bracket of heavy values in two at a value and keep the right part."""
    lo, hi = ends
    middle = lo / 2.0 + hi / 2.0
    c = F.col(b.column)
    part = df.filter(c.between(F.lit(lo), F.lit(hi))).agg(
        F.count(F.when(c <= F.lit(middle), 1)).alias("left"),
        F.max(F.when(c <= F.lit(middle), c)).alias("left_end"),
        F.min(F.when(c > F.lit(middle), c)).alias("right_start")).first()
    if b.rank < b.below + part["left"]:
        b.lo, b.hi, b.inside = lo, part["left_end"], part["left"]
    else:
        b.lo, b.hi = part["right_start"], hi
        b.below, b.inside = b.below + part["left"], b.inside - part["left"]


# -------------------------------------------------------------------- modes

def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, float | str | None]:
    """Most frequent value per column, the lowest on ties; None when all cells are missing."""
    columns = list(dict.fromkeys(columns))
    types = dict(df.dtypes)
    found: dict[str, float | str | None] = {}
    for as_type, group in (("double", [c for c in columns if types[c] != "string"]),
                           ("string", [c for c in columns if types[c] == "string"])):
        if not group:
            continue
        data = as_doubles(df, group) if as_type == "double" else df.select(*group)
        counted = (data.unpivot([], group, "column", "value").filter(F.col("value").isNotNull())
                   .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
        best = counted.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
        found.update({r["column"]: r["mode"] for r in best.collect()})
    return {c: found.get(c) for c in columns}


# ------------------------------------------------- cumulative counts and ranks

def bucket_splits(df: DataFrame, columns: Sequence[str]) -> dict[str, list[float]]:
    """Range boundaries per column with about ``ROWS_PER_BUCKET`` rows between them."""
    n = df.count()
    buckets = int(max(n // ROWS_PER_BUCKET, 8))
    probs = [i / buckets for i in range(1, buckets)]
    found = df.approxQuantile(list(columns), probs, 0.25 / buckets)
    return {c: [-math.inf, *sorted(set(inner)), math.inf] if inner else [-math.inf, 0.0, math.inf]
            for c, inner in zip(columns, found)}


def ordered_counts(df: DataFrame, columns: Sequence[str], weights: Mapping[str, Column] | None = None,
                   splits: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """Distinct values in order with running totals, per column.

    ``weights`` names the totals (default: one row count ``n``). The result has
    ``column, value``, each total and ``<total>_before``: the total over all
    smaller values. The running sum is taken inside value ranges and shifted
    by the sums of the ranges before, so no task sees a whole column; equal
    values are merged before they are shuffled, so a heavy value costs one row.
    """
    columns = list(columns)
    weights = dict(weights or {"n": F.lit(1)})
    data = df.select(*[finite(F.col(c).cast("double")).alias(c) for c in columns],
                     *[w.alias(f"_w_{m}") for m, w in weights.items()])
    if splits is None:
        splits = bucket_splits(data, columns)
    bucketed = Bucketizer(inputCols=columns, outputCols=[f"_b_{c}" for c in columns],
                          splitsArray=[list(splits[c]) for c in columns], handleInvalid="keep").transform(data)
    # Never null, so that both readers of the counts below keep the same filters and share one shuffle.
    bucket = {c: F.coalesce(F.col(f"_b_{c}").cast("int"), F.lit(-1)) for c in columns}
    cells = F.array(*[F.struct(F.lit(c).alias("column"), bucket[c].alias("bucket"),
                               (F.col(c) + F.lit(0.0)).alias("value")) for c in columns])
    long = (bucketed.select(F.inline(cells), *[F.col(f"_w_{m}") for m in weights])
            .filter(F.col("value").isNotNull()))
    counted = long.groupBy("column", "bucket", "value").agg(*[F.sum(f"_w_{m}").alias(m) for m in weights])
    totals = counted.groupBy("column", "bucket").agg(*[F.sum(m).alias(m) for m in weights])
    earlier = Window.partitionBy("column").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("column", "bucket", *[
        F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_o_{m}") for m in weights])
    inside = Window.partitionBy("column", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    running = counted.select("column", "bucket", "value", *weights, *[
        F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"_r_{m}") for m in weights])
    # One row per ROWS_PER_BUCKET rows and column: Spark broadcasts it while it is small.
    return (running.join(offsets, ["column", "bucket"])
            .select("column", "bucket", "value", *weights,
                    *[(F.col(f"_r_{m}") + F.col(f"_o_{m}")).alias(f"{m}_before") for m in weights]))


def ordered_positions(df: DataFrame, order: str) -> DataFrame:
    """The rows with ``position`` from 0 by a unique column, compared in its own type.

    Only the ranges are cut by the value as a double, which keeps the order but may merge neighbours; inside a range the
    column itself decides. Types without an order that a double keeps are refused, as are missing values.
    """
    kind = df.schema[order].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"{order} is {kind.simpleString()}: rows are ordered by a number or a date")
    place = (F.datediff(F.col(order), F.lit("1970-01-01")) if isinstance(kind, (T.DateType, T.TimestampNTZType))
             else F.col(order)).cast("double")
    keyed = df.withColumn("_at", place)
    absent = keyed.filter(F.col("_at").isNull() | F.isnan("_at")).limit(1).count()
    if absent:
        raise ValueError(f"{order} has missing values: they have no position")
    splits = bucket_splits(keyed.select("_at"), ["_at"])["_at"]
    ranged = Bucketizer(inputCol="_at", outputCol="_range", splits=splits, handleInvalid="keep").transform(keyed)
    inside = Window.partitionBy("_range").orderBy(order)
    earlier = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per value range.
    offsets = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    return (ranged.withColumn("_row", F.row_number().over(inside) - 1).join(F.broadcast(offsets), "_range")
            .select(*df.columns, (F.col("_offset") + F.col("_row")).alias("position")))


def average_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value, n, rank``: the average 1-based rank of each distinct value."""
    counted = ordered_counts(df, columns)
    rank = F.col("n_before") + (F.col("n") + 1) / 2.0
    return counted.select("column", "value", "n", rank.alias("rank"))


def look_up(df: DataFrame, column: str, table: DataFrame, payload: Sequence[str], n_values: int, n_rows: int,
            heavy_share: float = 0.005) -> DataFrame:
    """Look up ``payload`` for each row's value in a per-value table with counts ``n``.

    A table of at most ``BROADCAST_VALUES`` values is broadcast. Beyond that,
    values that own more than ``heavy_share`` of the rows (at most
    1/heavy_share of them) are looked up in a broadcast; the rest is an
    ordinary join on the value. Heavy rows get a missing join key with a
    spread second key, so they do not pile up in one shuffle partition.
    """
    if n_values <= BROADCAST_VALUES:
        small = table.select(F.col("value").alias("_v"), *payload)
        return df.join(F.broadcast(small), F.col(column) == F.col("_v"), "left").select(*df.columns, *payload)
    threshold = max(int(n_rows * heavy_share), 1)
    heavy = table.filter(F.col("n") > threshold).select(
        F.col("value").alias("_hv"), *[F.col(p).alias(f"_h_{p}") for p in payload])
    light = table.filter(F.col("n") <= threshold).select(
        F.col("value").alias("_lv"), F.lit(0).alias("_ls"), *[F.col(p).alias(f"_l_{p}") for p in payload])
    marked = df.join(F.broadcast(heavy), F.col(column) == F.col("_hv"), "left")
    skip = F.col("_hv").isNotNull() | F.col(column).isNull()
    keyed = marked.withColumns({
        "_k": F.when(~skip, F.col(column)),
        "_s": F.when(skip, 1 + F.pmod(F.monotonically_increasing_id(), F.lit(1024))).otherwise(F.lit(0)).cast("int")})
    joined = keyed.join(light, (F.col("_k") == F.col("_lv")) & (F.col("_s") == F.col("_ls")), "left")
    return joined.select(*df.columns, *[
        F.coalesce(F.col(f"_h_{p}"), F.col(f"_l_{p}")).alias(p) for p in payload])
