"""Sharding by a Feistel permutation of global row numbers.

Rows get dense numbers 0 .. n - 1 in an order that depends on the rows alone; the number goes through a Feistel network with
cycle walking to its place; place mod shards is the shard and place div shards the slot. Shard and slot of a number can be
computed without the table, shards differ by one row at most, and slots have no gaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import settled
from plumbline.llm.permute import numbered, permuted

SHARDS = 8


def sharded(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = 11) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    A null text has size 1 and the checksum of no bytes. Null ids, repeated rows and equal texts are rows like others;
    equal rows may change places with one another, which does not change the result. An empty table gives no rows.
    """
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = settled(docs.select(F.col(id_column).alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"),
                               F.crc32(raw).cast("long").alias("text_crc32")))
    n = F.lit(rows.count()).cast("long")
    placed = numbered(rows, [], ["doc_id", "text_crc32", "size"], "number")
    place = permuted(F.col("number"), n, F.lit(seed))
    return placed.withColumn("place", place).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("place") / shards).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
