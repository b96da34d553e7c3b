"""Pairwise correlations in long form: ``column_i, column_j, r`` with i before j.

Every coefficient is pairwise-complete: a pair uses the rows in which both
columns are present. A pair with a constant column has a null coefficient.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.ordering import average_ranks, bucket_splits, look_up, ordered_counts
from plumbline.operators.tables import as_doubles, numeric_columns
from plumbline.session import materialised


def correlation(df: DataFrame, columns: Sequence[str] | None = None, method: str = "pearson") -> DataFrame:
    columns = list(columns or numeric_columns(df))
    if method == "pearson":
        return _pearson(as_doubles(df, columns), columns)
    if method == "spearman":
        return _spearman(as_doubles(df, columns), columns)
    if method == "kendall":
        parts = [kendall_pair(df, a, b) for a, b in itertools.combinations(columns, 2)]
        return _union(parts)
    raise ValueError("method must be 'pearson', 'spearman' or 'kendall'")


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# ------------------------------------------------------------------- pearson

def _pearson(data: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each task multiplies its Arrow batches into pair sums, for tables of any width.

    A task emits one row per pair, whatever its number of rows; the sums are
    taken around a common shift (the column means), so they do not cancel.
    Each side's least and greatest value tell exactly whether it is constant.
    """
    k = len(columns)
    means = data.agg(*[F.avg(c) for c in columns]).first()
    shift = np.array([m if m is not None else 0.0 for m in means])
    upper_i, upper_j = np.triu_indices(k, 1)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sx, sy, sxx, syy, sxy = (np.zeros((k, k)) for _ in range(6))
        low, high = np.full((k, k), np.inf), np.full((k, k), -np.inf)       # of column i where column j is present
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(k)])
            here = ~np.isnan(x)
            mask = here.astype(float)
            if len(x):
                _extremes(x, here, low, high)
            x = np.where(here, x - shift, 0.0)
            n += mask.T @ mask
            sx += x.T @ mask
            sxx += (x * x).T @ mask
            sxy += x.T @ x
        sy[:], syy[:] = sx.T, sxx.T
        if n.any():
            yield _pair_rows(upper_i, upper_j, (n, sx, sy, sxx, syy, sxy, low, high, low.T, high.T))

    return _coefficients(data.mapInArrow(sums, PAIR_SUMS), columns)


PAIR_SUMS = ("i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double, "
             "lx double, hx double, ly double, hy double")


def _pair_rows(i: np.ndarray, j: np.ndarray, matrices: Sequence[np.ndarray]) -> pa.RecordBatch:
    names = [field.split()[0] for field in PAIR_SUMS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                       *[pa.array(m[i, j]) for m in matrices]], names=names)


def _coefficients(partial: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The pair sums of all tasks as coefficients; null where either side is constant."""
    total = partial.groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")],
        *[F.min(c).alias(c) for c in ("lx", "ly")], *[F.max(c).alias(c) for c in ("hx", "hy")])
    n = F.col("n")
    cov = F.try_divide(F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n), n)
    var_x = F.try_divide(F.col("sxx") - F.try_divide(F.col("sx") * F.col("sx"), n), n)
    var_y = F.try_divide(F.col("syy") - F.try_divide(F.col("sy") * F.col("sy"), n), n)
    names = F.array(*[F.lit(c) for c in columns])
    varies = (F.col("lx") < F.col("hx")) & (F.col("ly") < F.col("hy"))
    return total.select(names[F.col("i")].alias("column_i"), names[F.col("j")].alias("column_j"),
                        F.when(varies, F.try_divide(cov, F.sqrt(var_x) * F.sqrt(var_y))).alias("r"))


def _extremes(x: np.ndarray, here: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
    """Take a batch into the least and greatest value of every column i over the rows that have column j."""
    least, most = np.where(here, x, np.inf), np.where(here, x, -np.inf)
    whole = here.all(axis=0)
    np.minimum(low, least.min(axis=0)[:, None], out=low, where=whole[None, :])
    np.maximum(high, most.max(axis=0)[:, None], out=high, where=whole[None, :])
    for j in np.flatnonzero(~whole):
        rows = here[:, j]
        if rows.any():
            low[:, j] = np.minimum(low[:, j], least[rows].min(axis=0))
            high[:, j] = np.maximum(high[:, j], most[rows].max(axis=0))


# ------------------------------------------------------------------ spearman

def ranked(data: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each present cell replaced by the average rank of its value within its column."""
    ranks = materialised(average_ranks(data, columns))   # read once per column below
    sizes = {r["column"]: (r["values"], r["rows"]) for r in ranks.groupBy("column").agg(
        F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows")).collect()}
    out = data
    for c in columns:
        table = ranks.filter(F.col("column") == c).select("value", "n", F.col("rank").alias(f"_rank_{c}"))
        values, rows = sizes.get(c, (0, 0))
        out = look_up(out, c, table, [f"_rank_{c}"], values, rows)
    return out.select(*[F.col(f"_rank_{c}").alias(c) for c in columns])


def _spearman(data: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = data.agg(*[F.count(F.when(F.col(c).isNull(), 1)) for c in columns]).first()
    if not any(missing):
        return _pearson(ranked(data, columns), columns)
    return _spearman_with_gaps(data, columns)


def _spearman_with_gaps(data: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A pair with gaps is ranked over its own complete rows.

    One count per value and partner (the rows that have the partner, too) gives a column's ranks under every partner at
    once, so the number of jobs does not grow with the number of pairs. A row then looks up one array of ranks per column.
    """
    k = len(columns)
    counts = materialised(ordered_counts(data, columns, {f"w{j}": F.col(c).isNotNull().cast("long") for j, c in enumerate(columns)}))
    sizes = {r["column"]: r for r in counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("values"), *[F.sum(f"w{j}").alias(f"w{j}") for j in range(k)]).collect()}
    shift = np.array([[(sizes[a][f"w{j}"] + 1) / 2 if a in sizes else 0.0 for j in range(k)] for a in columns])
    out = data
    for i, c in enumerate(columns):
        ranks = F.array(*[F.col(f"w{j}_before") + (F.col(f"w{j}") + 1) / 2.0 for j in range(k)])
        table = counts.filter(F.col("column") == c).select("value", F.col(f"w{i}").alias("n"), ranks.alias(f"_rank_{i}"))
        values, rows = (sizes[c]["values"], sizes[c][f"w{i}"]) if c in sizes else (0, 0)
        out = look_up(out, c, table, [f"_rank_{i}"], values, rows)
    upper_i, upper_j = np.triu_indices(k, 1)
    step = max(1, 1_000_000 // (k * k))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sx, sy, sxx, syy, sxy = (np.zeros((k, k)) for _ in range(6))
        low, high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                x = np.full((batch.num_rows, k, k), np.nan)
                for i in range(k):
                    here = np.asarray(batch.column(i).is_valid())
                    flat = batch.column(i).flatten().to_numpy(zero_copy_only=False)
                    x[here, i] = flat.reshape(-1, k)
                here = ~np.isnan(x[:, :, 0])
                both = here[:, :, None] & here[:, None, :]
                x = np.where(both, x - shift, 0.0)
                y = x.transpose(0, 2, 1)
                n += both.sum(axis=0)
                sx += x.sum(axis=0)
                sxx += (x * x).sum(axis=0)
                sxy += (x * y).sum(axis=0)
                np.minimum(low, np.where(both, x, np.inf).min(axis=0), out=low)
                np.maximum(high, np.where(both, x, -np.inf).max(axis=0), out=high)
        sy[:], syy[:] = sx.T, sxx.T
        if n.any():
            yield _pair_rows(upper_i, upper_j, (n, sx, sy, sxx, syy, sxy, low, high, low.T, high.T))

    return _coefficients(out.select(*[f"_rank_{i}" for i in range(k)]).mapInArrow(sums, PAIR_SUMS), columns)


# ------------------------------------------------------------------- kendall

def kendall_pair(df: DataFrame, x: str, y: str) -> DataFrame:
    """Kendall's tau-b of two columns without comparing all pairs of rows.

    Rows are merged into distinct (x, y) cells. The distinct x values get
    consecutive numbers; on each binary digit of that number the cells split
    into a lower and an upper half, and every pair with different x is split
    exactly once. Within a split, cells are counted by running totals over y.
    That is one row per cell and digit instead of one per pair. Large splits
    are cut into value ranges of y so that no task holds one alone.
    """
    data = as_doubles(df, [x, y]).toDF("x", "y").na.drop()
    cells = materialised(data.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")))   # read by every part below
    cuts = bucket_splits(data, ["x", "y"])
    per_x = cells.groupBy("x").agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("rows"))
    numbers = ordered_counts(per_x, ["x"], {"d": F.lit(1), "n": F.col("cells")}, {"x": cuts["x"]}).select(
        "value", "n", F.col("d_before").alias("id"))   # consecutive numbers in the order of x
    sizes = per_x.agg(F.count(F.lit(1)).alias("x"), F.coalesce(F.sum("cells"), F.lit(0)).alias("cells")).first()
    digits = max(1, (sizes["x"] - 1).bit_length())
    placed = look_up(cells, "x", numbers, ["id"], sizes["x"], sizes["cells"])
    ranged = Bucketizer(inputCol="y", outputCol="range", splits=cuts["y"]).transform(placed)
    split = ranged.select("id", "y", "n", F.col("range").cast("int").alias("range"),
                          F.explode(F.sequence(F.lit(0), F.lit(digits - 1))).alias("digit")).select(
        "digit", F.expr("shiftright(id, digit + 1)").alias("part"), "range", "y",
        F.when(F.expr("shiftright(id, digit) % 2 = 0"), F.col("n")).otherwise(0).alias("lower"),
        F.when(F.expr("shiftright(id, digit) % 2 = 1"), F.col("n")).otherwise(0).alias("upper"))
    by_y = split.groupBy("digit", "part", "range", "y").agg(F.sum("lower").alias("lower"), F.sum("upper").alias("upper"))
    by_range = by_y.groupBy("digit", "part", "range").agg(F.sum("lower").alias("lower"), F.sum("upper").alias("upper"))
    inside = Window.partitionBy("digit", "part", "range").orderBy("y").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("digit", "part").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)

    def concordant(frame: DataFrame, window) -> DataFrame:
        before = F.coalesce(F.sum("lower").over(window), F.lit(0)).cast("double")
        return (frame.select((before * F.col("upper")).alias("pairs"))
                .agg(F.lit("concordant").alias("name"), F.sum("pairs").alias("pairs")))

    def ties(frame: DataFrame, count: str, name: str) -> DataFrame:
        t = F.col(count).cast("double")
        return frame.agg(F.lit(name).alias("name"), F.sum(t * (t - 1) / 2).alias("pairs"))

    counts = _union([
        concordant(by_y, inside), concordant(by_range, across),
        ties(per_x, "rows", "tied_x"), ties(cells.groupBy("y").agg(F.sum("n").alias("rows")), "rows", "tied_y"),
        ties(cells, "n", "tied_both"), ties(cells.agg(F.sum("n").alias("rows")), "rows", "all")])
    named = counts.agg(*[F.coalesce(F.sum(F.when(F.col("name") == name, F.col("pairs"))), F.lit(0.0)).alias(name)
                         for name in ("concordant", "tied_x", "tied_y", "tied_both", "all")])
    c = F.col
    untied = c("all") - c("tied_x") - c("tied_y") + c("tied_both")
    root = F.sqrt(c("all") - c("tied_x")) * F.sqrt(c("all") - c("tied_y"))
    return named.select(F.lit(x).alias("column_i"), F.lit(y).alias("column_j"),
                        F.try_divide(2 * c("concordant") - untied, root).alias("r"))


# ------------------------------------------------------------------ selections

def target_correlation(df: DataFrame, target: str, columns: Sequence[str] | None = None,
                       method: str = "pearson") -> DataFrame:
    """Correlation of each numeric column with the target, strongest positive first."""
    columns = [c for c in (columns or numeric_columns(df)) if c != target]
    if method == "pearson":
        found = _pearson(as_doubles(df, [*columns, target]), [*columns, target]).filter(F.col("column_j") == target)
    else:
        found = _union([correlation(df, [c, target], method) for c in columns])
    return found.select(F.col("column_i").alias("column"), "r").orderBy(F.col("r").desc_nulls_last(), "column")


def top_and_bottom(report: DataFrame, k: int = 12) -> DataFrame:
    """The ``k`` highest and ``k`` lowest coefficients of a target correlation."""
    present = report.filter(F.col("r").isNotNull())
    high = present.orderBy(F.col("r").desc(), "column").limit(k).withColumn("end", F.lit("top"))
    low = present.orderBy(F.col("r").asc(), "column").limit(k).withColumn("end", F.lit("bottom"))
    return high.unionByName(low)


def high_pairs(matrix: DataFrame, threshold: float = 0.85, k: int | None = 10) -> DataFrame:
    """Pairs above a threshold in absolute value, strongest first."""
    found = (matrix.filter(F.abs("r") > threshold)
             .orderBy(F.abs(F.col("r")).desc(), "column_i", "column_j"))
    return found.limit(k) if k else found


def redundant_columns(df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 0.9,
                      method: str = "pearson", absolute: bool = True) -> list[str]:
    """The later column of every pair above the threshold, whether or not its partner stays."""
    if not 0.0 < threshold <= 1.0:
        raise ValueError("threshold must be in (0, 1]")
    matrix = correlation(df, columns, method)
    strength = F.abs("r") if absolute else F.col("r")
    return sorted(r[0] for r in matrix.filter(strength > threshold).select("column_j").distinct().collect())


def matrix_difference(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean absolute difference of two correlation matrices, diagonal included.

    The mean is taken per column over its defined entries, then over the columns.
    """
    a = correlation(reference, columns).withColumnRenamed("r", "ra")
    b = correlation(current, columns).withColumnRenamed("r", "rb")
    # A matrix has one row per column pair.
    gap = a.join(F.broadcast(b), ["column_i", "column_j"]).select(
        "column_i", "column_j", F.abs(F.col("ra") - F.col("rb")).alias("gap")).filter(F.col("gap").isNotNull())
    both = F.array(F.struct(F.col("column_i").alias("column"), F.col("gap").alias("gap")),
                   F.struct(F.col("column_j").alias("column"), F.col("gap").alias("gap")))
    per = gap.select(F.inline(both)).groupBy("column").agg(
        # The diagonal adds one zero to each column.
        (F.sum("gap") / (F.count(F.lit(1)) + 1)).alias("gap"))
    return per.agg(F.avg("gap").alias("mean_abs_difference"))
