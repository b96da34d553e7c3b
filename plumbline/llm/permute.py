"""Pseudorandom permutations and dense numbers as column expressions.

A number x below ``rows * columns`` is a pair (x mod rows, x div rows). A Feistel network whose halves count in these two
radices permutes the pairs; with rows = ceil(sqrt(n)) the domain exceeds n by less than one column. A value that falls
outside n walks on along its cycle until it is inside, which keeps the map a permutation of 0 .. n - 1. Fewer than ``rows``
values lie outside, so a walk ends; ``WALK`` steps suffice for certain up to n = 4,096, and beyond that a longer walk has
a probability below n^-32.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 4
WALK = 64


def _network(x: Column, rows: Column, columns: Column, key: Column) -> Column:
    left, right = F.pmod(x, rows), F.floor(x / rows).cast("long")
    for round_ in range(ROUNDS):
        radix = rows if round_ % 2 == 0 else columns
        left, right = right, F.pmod(left + F.pmod(F.xxhash64(key, F.lit(round_), right), radix), radix)
    return left + right * rows


def permuted(x: Column, n: Column, key: Column) -> Column:
    """Where x (0 .. n - 1) goes in the permutation of n values that ``key`` names."""
    rows = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("long"), F.lit(1))
    columns = F.greatest(F.floor((n + rows - 1) / rows).cast("long"), F.lit(1))
    once = _network(x.cast("long"), rows, columns, key)
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), once,
                       lambda at, _: F.when(at < n, at).otherwise(_network(at, rows, columns, key)))
    return F.when(once < n, once).otherwise(walk)


def numbered(rows: DataFrame, within: list[str], order: list[str], number: str, running: str | None = None,
             total: str = "before") -> DataFrame:
    """Dense numbers from 0 within ``within`` (all rows if empty), and optionally the running sum of a column before each row.

    Rows are dealt by the hash of ``order``'s first column into about sqrt(rows) parts; parts are numbered by their totals
    and rows inside their part, so a group that holds most rows is spread over as many tasks as the rest. The order is
    that of (part, ``order``): the same for the same rows under any partitioning. Rows equal in ``order`` may change places.
    """
    count = rows.count()
    parts = max(1, int(count ** 0.5))
    dealt = rows.withColumn("__part", F.pmod(F.xxhash64(order[0]), F.lit(parts)))
    weight = F.sum(running).alias("__w") if running else F.lit(0).cast("long").alias("__w")
    totals = dealt.groupBy(*within, "__part").agg(F.count(F.lit(1)).alias("__n"), weight)
    before = Window.partitionBy(*within).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*within, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__at"),
                           F.coalesce(F.sum("__w").over(before), F.lit(0)).alias("__sum"))
    keys = [F.xxhash64(order[0]).asc(), *[F.col(c).asc_nulls_last() for c in order]]
    inside = Window.partitionBy(*within, "__part").orderBy(*keys)
    ranked = dealt.withColumn("__row", F.row_number().over(inside) - 1)
    if running:
        ranked = ranked.withColumn("__run", F.coalesce(F.sum(running).over(
            inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    s = starts.select(*[F.col(c).alias(f"__{c}") for c in within], F.col("__part").alias("__p"), "__at", "__sum")
    match = F.col("__part") == F.col("__p")
    for c in within:
        match = match & F.col(c).eqNullSafe(F.col(f"__{c}"))
    out = ranked.join(s, match).withColumn(number, (F.col("__at") + F.col("__row")).cast("long"))
    if running:
        out = out.withColumn(total, (F.col("__sum") + F.col("__run")).cast("long"))
    return out.select(*rows.columns, number, *([total] if running else []))
