"""Table and column profiles as small result tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.rows import missing_cells, null_pattern
from plumbline.operators.ordering import quantiles
from plumbline.operators.tables import as_doubles, numeric_columns, per_column, small_table, value_counts, without_nan


def _percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(100.0 * part, whole), F.lit(0.0))


# ---------------------------------------------------------------- missing cells

def missing_by_column(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    report = per_column(without_nan(df), list(columns or df.columns), {
        "missing": lambda c: F.count(F.when(c.isNull(), 1)), "n_rows": lambda c: F.count(F.lit(1))})
    return (report.select("column", "missing", _percent(F.col("missing"), F.col("n_rows")).alias("missing_pct"))
            .orderBy(F.col("missing").desc(), "column"))


def missing_overview(df: DataFrame, over_pct: float = 5.0) -> DataFrame:
    """Columns with any and with many missing cells, and the total."""
    return missing_by_column(df).agg(
        F.count(F.when(F.col("missing") > 0, 1)).alias("columns_with_missing"),
        F.count(F.when(F.col("missing_pct") > over_pct, 1)).alias("columns_over_pct"),
        F.sum("missing").alias("missing_cells"))


def missing_by_family(df: DataFrame, families: Mapping[str, Sequence[str]], over_pct: float = 5.0) -> DataFrame:
    present = {f: [c for c in cols if c in df.columns] for f, cols in families.items()}
    pairs = [(f, c) for f, cols in present.items() for c in cols]
    members = small_table(df.sparkSession, pairs, "family string, column string")
    per = missing_by_column(df, list(dict.fromkeys(c for _, c in pairs)))
    # One row per family member: bounded by the number of columns.
    return (per.join(F.broadcast(members), "column").groupBy("family").agg(
        F.count(F.lit(1)).alias("n_cols"), F.avg("missing_pct").alias("avg_missing_pct"),
        F.max("missing_pct").alias("max_missing_pct"),
        F.count(F.when(F.col("missing_pct") > over_pct, 1)).alias("cols_over_pct"))
        .orderBy(F.col("avg_missing_pct").desc(), F.col("max_missing_pct").desc(), "family"))


def missing_per_row(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distribution of the missing cells per row; a row count can take few values only."""
    m = F.col("m")
    row = without_nan(df).select(missing_cells(list(columns or df.columns)).alias("m")).agg(
        F.count(m).alias("n_rows"), F.avg(m).alias("mean"), F.stddev_samp(m).alias("sd"), F.min(m).alias("min"),
        F.percentile(m, F.array(*[F.lit(p) for p in (0.5, 0.9, 0.95, 0.99)])).alias("p"), F.max(m).alias("max"))
    return row.select("n_rows", "mean", "sd", "min", *[
        F.col("p")[i].alias(name) for i, name in enumerate(("p50", "p90", "p95", "p99"))], "max")


def drop_sparse_rows(df: DataFrame, max_missing_pct: float, columns: Sequence[str] | None = None) -> DataFrame:
    used = list(columns or df.columns)
    return without_nan(df).filter(missing_cells(used) * 100.0 <= F.lit(max_missing_pct * len(used)))


def sparse_rows(df: DataFrame, max_missing_pct: float, columns: Sequence[str] | None = None) -> DataFrame:
    """How many rows ``drop_sparse_rows`` would drop."""
    used = list(columns or df.columns)
    over = missing_cells(used) * 100.0 > F.lit(max_missing_pct * len(used))
    return without_nan(df).agg(F.count(F.when(over, 1)).alias("sparse_rows"), F.count(F.lit(1)).alias("n_rows"))


def null_patterns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows per combination of missing columns (1 = missing, in column order)."""
    return without_nan(df).groupBy(null_pattern(list(columns or df.columns)).alias("pattern")).agg(
        F.count(F.lit(1)).alias("n"))


def co_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_i, column_j, n``: rows in which both columns are missing, for every pair (i before j)."""
    columns = list(columns or df.columns)
    position = F.array(*[F.lit(c) for c in columns])
    bits = null_patterns(df, columns).select("n", F.filter(
        F.sequence(F.lit(1), F.lit(len(columns))), lambda i: F.substring("pattern", i, F.lit(1)) == "1").alias("hit"))
    # Expanded per pattern, not per row.
    pairs = (bits.select("n", "hit", F.explode("hit").alias("i")).select("n", "i", F.explode("hit").alias("j"))
             .filter("i < j"))
    every = small_table(df.sparkSession, [(i + 1, j + 1) for i in range(len(columns)) for j in range(i + 1, len(columns))],
                        "i int, j int")
    # One row per pair of columns on either side.
    return every.join(pairs.groupBy("i", "j").agg(F.sum("n").alias("n")), ["i", "j"], "left").select(
        position[F.col("i") - 1].alias("column_i"), position[F.col("j") - 1].alias("column_j"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


# ------------------------------------------------------------------- profiles

def table_shape(df: DataFrame) -> DataFrame:
    df = without_nan(df)
    nulls = F.lit(0)
    for c in df.columns:
        nulls = nulls + F.col(c).isNull().cast("int")
    numeric = numeric_columns(df)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(nulls), F.lit(0)).alias("null_cells")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"), "null_cells",
        F.lit(len(numeric)).cast("bigint").alias("numeric_columns"),
        F.lit(len(df.columns) - len(numeric)).cast("bigint").alias("other_columns"))


def column_types(df: DataFrame) -> DataFrame:
    return small_table(df.sparkSession, df.dtypes, "column string, type string")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column."""
    return (df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows")))


def describe(df: DataFrame, columns: Sequence[str] | None = None,
             probs: Mapping[str, float] | None = None) -> DataFrame:
    """count, mean, sample sd, min, exact quantiles, max: one row per numeric column."""
    probs = dict(probs or QUARTILES)
    return _described(df, columns, probs).select("column", "n", "mean", "sd", "min", *probs, "max")


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def _described(df: DataFrame, columns: Sequence[str] | None, probs: Mapping[str, float]) -> DataFrame:
    columns = list(columns or numeric_columns(df))
    found = quantiles(df, columns, list(probs.values()))
    constants = {c: dict(zip(probs, found[c])) for c in columns}
    return per_column(as_doubles(df, columns), columns, {
        "n": F.count, "mean": F.avg, "sd": F.stddev_samp, "min": F.min, "max": F.max,
        "n_rows": lambda c: F.count(F.lit(1)),
    }, constants, {p: "double" for p in probs})


def cardinality(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct values per column, most varied first."""
    columns = list(columns or df.columns)
    df = without_nan(df)
    if approximate:
        report = per_column(df, columns, {"unique_values": F.approx_count_distinct})
    else:
        counted = value_counts(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("unique_values"))
        names = small_table(df.sparkSession, [(c,) for c in columns], "column string")
        report = names.join(F.broadcast(counted), "column", "left").select(
            "column", F.coalesce("unique_values", F.lit(0)).alias("unique_values"))
    return report.orderBy(F.col("unique_values").desc(), "column")


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """``describe`` with the missing share and the distinct count."""
    columns = list(columns or numeric_columns(df))
    described = _described(df, columns, QUARTILES).withColumn(
        "missing_pct", _percent(F.col("n_rows") - F.col("n"), F.col("n_rows")))
    # One row per column on both sides.
    return described.join(F.broadcast(cardinality(df, columns, approximate)), "column").select(
        "column", "n", "mean", "sd", "min", *QUARTILES, "max", "missing_pct", "unique_values")


def categorical_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct values, the most frequent one (lowest on ties) and the missing share."""
    columns = list(columns or [c for c in df.columns if c not in numeric_columns(df)])
    ranked = value_counts(df, columns).groupBy("column").agg(
        F.count(F.lit(1)).alias("unique_values"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("most_frequent"))
    missing = missing_by_column(df, columns).select("column", "missing_pct")
    return missing.join(F.broadcast(ranked), "column", "left").select(
        "column", F.coalesce("unique_values", F.lit(0)).alias("unique_values"), "most_frequent", "missing_pct")


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Numeric columns whose present cells are all equal."""
    columns = list(columns or numeric_columns(df))
    return (per_column(as_doubles(df, columns), columns, {"lo": F.min, "hi": F.max})
            .filter(F.col("lo") == F.col("hi")).select("column", F.col("lo").alias("value")))


# ---------------------------------------------------------------- distributions

def bin_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Minimum and maximum per column; a constant column gets half a unit on both sides."""
    data = as_doubles(df, columns)
    row = data.agg(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(columns)],
                   *[F.max(c).alias(f"hi{i}") for i, c in enumerate(columns)]).first()
    found = {}
    for i, c in enumerate(columns):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if lo is not None:
            found[c] = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
    return found


def _bin(c: Column, lo: float, hi: float, bins: int) -> Column:
    """Bin number from 0; the last bin is closed, and edges decide over the division."""
    step = (hi - lo) / bins
    guess = F.least(F.floor((c - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)), F.lit(bins - 1))
    low = c < F.lit(lo) + guess * F.lit(step)
    high = (c >= F.lit(lo) + (guess + 1) * F.lit(step)) & (guess < F.lit(bins - 1))
    return F.when(low, guess - 1).when(high, guess + 1).otherwise(guess).cast("int")


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30,
              ranges: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """Equal-width bins from minimum to maximum: ``column, bin, lo, hi, n``, empty bins included."""
    ranges = dict(ranges or bin_ranges(df, columns))
    used = [c for c in columns if c in ranges]
    frame = as_doubles(df, used)
    marks = F.array(*[F.struct(F.lit(c).alias("column"),
                               F.when(F.col(c).between(*ranges[c]), _bin(F.col(c), *ranges[c], bins)).alias("bin"))
                      for c in used])
    counted = (frame.select(F.inline(marks)).filter(F.col("bin").isNotNull())
               .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n")))
    edges = [(c, b, ranges[c][0] + b * ((ranges[c][1] - ranges[c][0]) / bins),
              ranges[c][0] + (b + 1) * ((ranges[c][1] - ranges[c][0]) / bins)) for c in used for b in range(bins)]
    grid = small_table(df.sparkSession, edges, "column string, bin int, lo double, hi double")
    # One row per column and bin.
    return grid.join(F.broadcast(counted), ["column", "bin"], "left").select(
        "column", "bin", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n"))


def log_histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    return histogram(df.select(F.log1p(column).alias(column)), [column], bins)


def histogram_overlay(reference: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 50,
                      shared_range: bool = False) -> DataFrame:
    """Two histograms side by side, each over its own range or both over a shared one."""
    a, b = bin_ranges(reference, columns), bin_ranges(current, columns)
    if shared_range:
        both = {c: (min(a[c][0], b[c][0]), max(a[c][1], b[c][1])) for c in a if c in b}
        a = b = both

    def named(df, ranges, side):
        h = histogram(df, columns, bins, ranges)
        return h.select("column", "bin", *[F.col(x).alias(f"{side}_{x}") for x in ("lo", "hi", "n")])

    return named(reference, a, "ref").join(F.broadcast(named(current, b, "cur")), ["column", "bin"], "full")


def box_plot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges and the number of points beyond."""
    found = quantiles(df, columns, [0.25, 0.5, 0.75])
    used = [c for c in columns if found[c][0] is not None]
    frame, constants = as_doubles(df, used), {}
    shaped = []
    for c in used:
        q1, q2, q3 = found[c]
        reach = 1.5 * (q3 - q1)
        constants[c] = {"q1": q1, "median": q2, "q3": q3}
        shaped.append(F.struct(F.col(c).alias("v"), F.col(c).between(q1 - reach, q3 + reach).alias("near")).alias(c))
    report = per_column(frame.select(*shaped), used, {
        "whisker_lo": lambda c: F.min(F.when(c["near"], c["v"])),
        "whisker_hi": lambda c: F.max(F.when(c["near"], c["v"])),
        "outliers": lambda c: F.count(F.when(~c["near"], 1)),
    }, constants, {"q1": "double", "median": "double", "q3": "double"})
    return report.select("column", "q1", "median", "q3", "whisker_lo", "whisker_hi", "outliers")


def density_curve(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """Gaussian density estimate on an even grid from minimum to maximum: ``x, density``.

    The bandwidth is sd * n^(-1/5). A task adds its rows up on the grid and
    emits one grid, so only grids are shuffled.
    """
    data = as_doubles(df, [column]).select(F.col(column).alias("v")).filter(F.col("v").isNotNull())
    s = data.agg(F.count("v").alias("n"), F.stddev_samp("v").alias("sd"), F.min("v").alias("lo"),
                 F.max("v").alias("hi")).first()
    if not s["n"] or not s["sd"]:
        return small_table(df.sparkSession, [], "x double, density double")
    width = s["sd"] * s["n"] ** (-0.2)
    step = (s["hi"] - s["lo"]) / (points - 1)
    scale = 1.0 / (s["n"] * width * (2.0 * 3.141592653589793) ** 0.5)
    grid = s["lo"] + step * np.arange(points)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(points)
        for batch in batches:
            values, n = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_counts=True)
            for at in range(0, len(values), 4096):
                z = (grid[:, None] - values[at:at + 4096]) / width
                total += np.exp(-0.5 * z * z) @ n[at:at + 4096]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(points, dtype=np.int32)), pa.array(total)], names=["g", "t"])

    return (data.mapInArrow(sums, "g int, t double").groupBy("g").agg((F.sum("t") * F.lit(scale)).alias("density"))
            .select((F.lit(s["lo"]) + F.col("g") * F.lit(step)).alias("x"), "density"))
