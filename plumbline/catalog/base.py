"""Registry of bound queries and the small helpers they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bound:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Bound] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with the SQL that gives the same rows."""

    def register(fn):
        REGISTRY[fn.__name__] = Bound(fn, sql)
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(c: Column, places: int = 6) -> Column:
    """Rounded for comparison; adding 0.0 clears a negative zero."""
    return F.round(c, places) + F.lit(0.0)


def round_all(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[rounded(F.col(c), places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CUT = "1998-01-01"   # rows shipped before are the reference, the rest is current


def lineitem(spark, folder) -> DataFrame:
    return table(spark, folder, "lineitem")


def reference_and_current(spark, folder) -> tuple[DataFrame, DataFrame]:
    rows = lineitem(spark, folder)
    cut = F.lit(CUT).cast("timestamp_ntz")
    return rows.filter(F.col("l_shipdate") < cut), rows.filter(F.col("l_shipdate") >= cut)


REF_CUR = f"""ref AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{CUT}'),
cur AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{CUT}')"""


def long_sql(source: str, columns: list[str], keep: str = "") -> str:
    """SQL that stacks numeric columns into ``column, value`` rows."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", ({c})::DOUBLE + 0.0 AS value{keep} FROM {source}" for c in columns)
