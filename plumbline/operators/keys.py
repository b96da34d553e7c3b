"""Key normalisation, key filters and deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import cells

HTTP_PREFIXES = ("http://", "https://")


def normalise_key(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(key, cells.normalised_key(F.col(key)))


def drop_bad_keys(df: DataFrame, key: str, tokens: Sequence[str] = cells.BAD_KEYS) -> DataFrame:
    return df.filter(~cells.is_bad_key(F.col(key), tokens))


def keep_prefixes(df: DataFrame, key: str, prefixes: Sequence[str] = HTTP_PREFIXES) -> DataFrame:
    return df.filter(cells.has_prefix(F.col(key), prefixes))


def keep_best(df: DataFrame, keys: Sequence[str], score: str | None = None,
              ties: Sequence[str] = ()) -> DataFrame:
    """One row per key: the highest score, a missing score losing to any other.

    ``ties`` decide between equal scores (greatest wins); without a score they
    play the part of "last row". What is left equal is decided by the other
    columns in their order, so the result does not depend on partitioning. The
    best row is the maximum of one struct: an aggregate with a map-side
    combine, so a key that owns a large share of the rows sends one row per
    task to the shuffle instead of its whole group to one task.
    """
    ranking = ([score] if score else []) + list(ties)
    types = dict(df.dtypes)
    # NaN is missing here; left alone it would beat every number.
    ranked = {c: F.nanvl(F.col(c), F.lit(None).cast(types[c])).alias(c) if types[c] in ("double", "float")
              else F.col(c) for c in ranking}
    rest = [F.col(c) for c in df.columns if c not in keys and c not in ranked]
    if not ranked and not rest:
        return df.distinct()
    best = F.max(F.struct(*ranked.values(), *rest)).alias("_best")
    return (df.groupBy(*keys).agg(best)
            .select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns]))


def clean_keys(df: DataFrame, key: str, score: str | None = None, ties: Sequence[str] = (),
               prefixes: Sequence[str] = HTTP_PREFIXES,
               tokens: Sequence[str] = cells.BAD_KEYS) -> DataFrame:
    """Normalise, drop bad and foreign keys, keep the best row of each key."""
    kept = keep_prefixes(drop_bad_keys(normalise_key(df, key), key, tokens), key, prefixes)
    return keep_best(kept, [key], score, ties)


def key_report(df: DataFrame, key: str, prefixes: Sequence[str] = HTTP_PREFIXES,
               tokens: Sequence[str] = cells.BAD_KEYS) -> DataFrame:
    """Rows removed per rule: ``rule, n`` for bad tokens, foreign prefixes, duplicates."""
    k = F.col("k")
    per_key = (df.select(cells.normalised_key(F.col(key)).alias("k"))
               .groupBy("k").agg(F.count(F.lit(1)).alias("n")))
    bad = cells.is_bad_key(k, tokens)
    foreign = ~bad & ~cells.has_prefix(k, prefixes)
    valid = ~bad & cells.has_prefix(k, prefixes)
    counted = per_key.agg(
        F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)).alias("bad_tokens"),
        F.coalesce(F.sum(F.when(foreign, F.col("n"))), F.lit(0)).alias("foreign_prefix"),
        F.coalesce(F.sum(F.when(valid, F.col("n") - 1)), F.lit(0)).alias("deduplicated"),
    )
    return counted.unpivot([], ["bad_tokens", "foreign_prefix", "deduplicated"], "rule", "n")
