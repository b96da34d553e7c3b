"""Seeded train/test splits and folds that do not depend on partitioning.

Rows are ordered by the md5 of seed and key, inside each stratum if one is named. The hashes at the wanted positions are
found without ranking the table: counts per stratum and hash prefix give the prefix that holds a position, and only the
rows of such prefixes are looked at hash by hash. Cuts are a table with one row per stratum; a split is then a comparison
per row, so the same row always lands on the same side.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import materialised

PREFIX = 4      # leading hex digits of a hash: 65,536 ranges per stratum


def row_hash(seed: int, key: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))


def hash_cuts(df: DataFrame, key: str, seed: int, wanted: DataFrame, stratum: str | None = None) -> DataFrame:
    """``wanted`` (s, position) with ``cut``: the largest hash among the first ``position`` rows of the stratum.

    Equal hashes are merged before they meet, so a key with very many rows is one row here.
    """
    hashed = df.select(row_hash(seed, key).alias("h"), (F.col(stratum) if stratum else F.lit(None).cast("string")).alias("s"))
    prefix = F.substring("h", 1, PREFIX)
    ranges = hashed.groupBy("s", prefix.alias("p")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("s").orderBy("p")
    ranges = ranges.withColumn("end", F.sum("n").over(upto)).withColumn("before", F.col("end") - F.col("n"))
    want = wanted.filter("position > 0").withColumnRenamed("s", "ws")
    held = materialised(ranges.join(want, F.col("s").eqNullSafe(F.col("ws")) & (F.col("before") < F.col("position"))
                                    & (F.col("position") <= F.col("end"))).select("s", "p", "before", "position"))
    spots = held.select(F.col("s").alias("hs"), F.col("p").alias("hp"), "before").distinct()
    near = hashed.join(spots, F.col("s").eqNullSafe(F.col("hs")) & (prefix == F.col("hp")), "left_semi")
    counted = near.groupBy("s", prefix.alias("p"), "h").agg(F.count(F.lit(1)).alias("n"))
    reached = counted.withColumn("reach", F.sum("n").over(Window.partitionBy("s", "p").orderBy("h")))
    spot = held.select(F.col("s").alias("hs"), F.col("p").alias("hp"), "before", "position")
    return (reached.join(spot, F.col("s").eqNullSafe(F.col("hs")) & (F.col("p") == F.col("hp")))
            .filter(F.col("before") + F.col("reach") >= F.col("position"))
            .groupBy("s", "position").agg(F.min("h").alias("cut")))


@dataclass(frozen=True)
class Split:
    """A fitted split. ``cut`` is the single cut of an unstratified one, ``cuts`` the table (s, cut) of a stratified one."""

    key: str
    seed: int
    stratum: str | None
    cut: str = ""
    cuts: DataFrame | None = None

    def marked(self, df: DataFrame, name: str = "is_test") -> DataFrame:
        """``df`` with a boolean column that tells the test rows."""
        h = row_hash(self.seed, self.key)
        if self.stratum is None:
            return df.withColumn(name, h <= F.lit(self.cut))
        cuts = self.cuts.select(F.col("s").alias("__stratum"), F.col("cut").alias("__cut"))
        joined = df.join(cuts, F.col(self.stratum).eqNullSafe(F.col("__stratum")), "left")
        return joined.select(*df.columns, F.coalesce(h <= F.col("__cut"), F.lit(False)).alias(name))

    def train(self, df: DataFrame) -> DataFrame:
        return self.marked(df, "__test").filter(~F.col("__test")).drop("__test")

    def test(self, df: DataFrame) -> DataFrame:
        return self.marked(df, "__test").filter("__test").drop("__test")


def _test_sizes(sizes: DataFrame, test_size: float) -> DataFrame:
    """``sizes`` (s, n) to (s, position): test rows per stratum.

    Training rows are shared in proportion to ``n``; leftovers go by largest remainder, then order. Remainders are exact
    integers. The order of strata is one window over a table with one row per stratum.
    """
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    train = total - math.ceil(total * test_size)
    shared = sizes.withColumn("given", F.expr(f"cast(n as decimal(19,0)) * {train} div {max(total, 1)}").cast("long"))
    rest = F.expr(f"cast(n as decimal(19,0)) * {train} - cast(given as decimal(19,0)) * {max(total, 1)}")
    order = Window.partitionBy(F.lit(0)).orderBy(rest.desc(), F.col("s").cast("string").asc_nulls_first())
    left = F.lit(train) - F.sum("given").over(Window.partitionBy(F.lit(0)))
    return shared.select("s", (F.col("n") - F.col("given") - (F.row_number().over(order) <= left).cast("int")).alias("position"))


def fit_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42, stratum: str | None = None) -> Split:
    """A hold-out of ceil(n * test_size) rows, with equal shares per stratum if one is named.

    ``key`` should identify rows: rows with the same key stay on the same side.
    """
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must be between 0 and 1")
    if stratum is None:
        return Split(key, seed, None, _plain_cuts(df, key, seed, [math.ceil(df.count() * test_size)])[0])
    sizes = materialised(df.groupBy(F.col(stratum).alias("s")).agg(F.count(F.lit(1)).alias("n")))
    cuts = hash_cuts(df, key, seed, _test_sizes(sizes, test_size), stratum)
    return Split(key, seed, stratum, cuts=materialised(cuts.select("s", "cut")))


def _plain_cuts(df: DataFrame, key: str, seed: int, positions: Sequence[int]) -> list[str]:
    """The cuts of a table without strata, one string per position."""
    wanted = df.sparkSession.createDataFrame([(None, p) for p in sorted(set(positions))], "s string, position long")
    found = {r["position"]: r["cut"] for r in hash_cuts(df, key, seed, wanted).collect()}
    return [found.get(p, "") for p in positions]


def train_test(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42,
               stratum: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides, with the rows and their side computed once for the passes that follow."""
    marked = materialised(fit_split(df, key, test_size, seed, stratum).marked(df, "_test"))
    return marked.filter(~F.col("_test")).drop("_test"), marked.filter("_test").drop("_test")


def fit_folds(df: DataFrame, key: str, k: int = 5, seed: int = 42) -> Column:
    """Fold number 1..k per row; the first n mod k folds hold one row more."""
    n = df.count()
    ends, at = [], 0
    for i in range(k - 1):
        at += n // k + (1 if i < n % k else 0)
        ends.append(at)
    cuts = _plain_cuts(df, key, seed, ends)
    h = row_hash(seed, key)
    fold = F.lit(1)
    for cut in cuts:
        fold = fold + (h > F.lit(cut)).cast("int")
    return fold
