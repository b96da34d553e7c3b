"""Mixing sources to target weights, in DataFrame operations only.

Per source the documents stand in a pseudorandom order and their words are packed into blocks of ``block`` words. The
output consists of slots of one block each. Slot p of N draws its source by inverse distribution from the uniform value
(p + u) / N, with u from a hash: a multinomial draw stratified over the slots, so that each source's total is within two
slots of its target. The slots then go through one permutation of 0 .. N - 1, which deals them to output shards; the
counts per shard and source are those of a multinomial draw for that shard. The k-th slot of a source takes block
permutation(k mod blocks), one permutation per source and epoch k div blocks, and blocks join slots by their index.
No block is taken more often than ``repeats`` times, and so no document by more than that times its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import row_digest, settled
from plumbline.llm.permute import numbered, permuted

BLOCK = 64
REPEATS = 3
WEIGHTS = (1, 2, 3)
SHARD_SLOTS = 1_024
RANGE = 4_096
WORD = "[^\\x20\\x09-\\x0D]+"
GAP = "[\\x20\\x09-\\x0D]+"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``sizes`` (source, size) per document to one row per source: source, source_no, source_size, weight, target.

    Sources in code point order, null last, take the weights in turn. Targets share the total by weight; what exceeds
    ``repeats`` times a source's size is shared again among the others. That is target = min(cap, weight * level) with one
    level: the first, in order of cap / weight, at which the remaining total fits under the next cap. Source 'totals' are
    one row each; the window over them is the only one without a partition.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    totals = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
              .withColumn("source_no", F.row_number().over(by_name) - 1)
              .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                                 (F.pmod("source_no", F.lit(len(weights))) + 1).cast("int")))
              .withColumn("cap", F.lit(repeats) * F.col("source_size"))
              .withColumn("total", F.sum("source_size").over(everything)))
    by_cap = everything.orderBy(F.col("cap") / F.col("weight"), "source_no")
    level = (F.col("total") - F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        / F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    leveled = (totals.withColumn("level", level).withColumn("order", F.row_number().over(by_cap))
               .withColumn("fits", F.col("level") <= F.col("cap") / F.col("weight")))
    first = F.min(F.when(F.col("fits"), F.struct("order", "level"))).over(everything)["level"]
    return (leveled.withColumn("first", first)
            .select("source", "source_no", "source_size", "weight",
                    F.coalesce(F.least(F.col("cap").cast("double"), F.col("weight") * F.col("first")), F.lit(0.0)).alias("target")))


def slot_ranges(targets: DataFrame, block: int, repeats: int, seed: int) -> DataFrame:
    """Sources with their slots: source_no, blocks, first (stratum of the first slot), slots, all_slots."""
    everything = Window.partitionBy(F.lit(0)).orderBy("source_no")
    upper = F.sum("target").over(everything) / block

    def cut(bound: Column) -> Column:
        """Strata whose draw falls below the bound."""
        whole = F.floor(bound).cast("long")
        u = F.pmod(F.xxhash64(F.lit(seed), whole), F.lit(1 << 30)) / F.lit(float(1 << 30))
        return whole + F.when(u < bound - whole, 1).otherwise(0)

    ranged = (targets.withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
              .withColumn("last", cut(F.round(upper, 6))).withColumn("first", F.coalesce(F.lag("last").over(everything), F.lit(0))))
    held = F.least(F.col("last") - F.col("first"), repeats * F.col("blocks"))
    return (ranged.withColumn("slots", held)
            .withColumn("first", F.sum("slots").over(everything) - F.col("slots"))
            .withColumn("all_slots", F.sum("slots").over(Window.partitionBy(F.lit(0)))))


def slots_of(ranges: DataFrame, seed: int, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """Every output slot: shard, slot, source_no, block."""
    step = F.greatest(F.lit(RANGE), F.ceil(F.sqrt(F.col("slots").cast("double"))).cast("long"))
    parts = (ranges.filter("slots > 0").withColumn("step", step)
             .withColumn("low", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.col("step"))))
             .repartition("source_no", "low"))
    slots = parts.withColumn("k", F.explode(F.sequence("low", F.least(F.col("low") + F.col("step"), F.col("slots")) - 1)))
    place = permuted(F.col("first") + F.col("k"), F.col("all_slots"), F.lit(seed))
    epoch = F.floor(F.col("k") / F.col("blocks")).cast("long")
    block = permuted(F.pmod("k", "blocks"), F.col("blocks"), F.xxhash64(F.lit(seed + 1), "source_no", epoch))
    return (slots.select("source_no", place.alias("place"), block.alias("block"))
            .select(F.floor(F.col("place") / shard_slots).cast("long").alias("shard"),
                    F.pmod("place", F.lit(shard_slots)).alias("slot"), "source_no", "block"))


def shard_counts(slots: DataFrame) -> DataFrame:
    """The draw: how many slots of each output shard go to each source."""
    return slots.groupBy("shard", "source_no").agg(F.count(F.lit(1)).alias("slots"))


class Mix:
    """The plan of a mix over ``docs``; ``slots``, ``pieces`` and ``documents`` are its tables.

    Null text: no words. Null source: a source of its own, last. Repeated rows and equal ids are rows of their own. An
    empty table gives empty tables. Extra columns do not take part; all names used here are internal.
    """

    def __init__(self, docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
                 weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK, repeats: int = REPEATS, seed: int = 7,
                 key: Column | None = None):
        self.docs = docs
        own = [] if key is None else ["key"]
        base = docs.select(F.col(id_column).alias("doc_id"), F.col(source).alias("source"), words_in(F.col(text)).alias("size"),
                           F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("tie"),
                           *[key.alias(k) for k in own])
        rows = settled(base)
        targets = settled(source_targets(rows, weights, repeats))
        self.ranges = settled(slot_ranges(targets, block, repeats, seed))
        self.slots = slots_of(self.ranges, seed)
        known = rows.join(targets.select(F.col("source").alias("__s"), "source_no", "source_size", "target"),
                          F.col("source").eqNullSafe(F.col("__s"))).drop("__s", "source")
        self.placed = settled(numbered(known, ["source_no"], ["doc_id", "tie", "size", *own], "row", "size", "start"))
        low, high = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
        self.pieces = (self.placed.filter("size > 0").select("source_no", "row", "start", "size", F.explode(
            F.sequence(low.cast("long"), high.cast("long"))).alias("block")).select(
            "source_no", "row", "block", F.greatest(F.col("block") * block - F.col("start"), F.lit(0)).alias("from"),
            F.least((F.col("block") + 1) * block - F.col("start"), F.col("size")).alias("to")))
        times = self.slots.groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("times"))
        self.taken_pieces = self.pieces.join(times, ["source_no", "block"])

    def documents(self) -> DataFrame:
        """Per document: doc_id, size, source_size, target, taken."""
        taken = self.taken_pieces.groupBy("source_no", "row").agg(
            F.sum((F.col("to") - F.col("from")) * F.col("times")).alias("taken"))
        return self.placed.join(taken, ["source_no", "row"], "left").select(
            "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
                    length: str = "n_chars", **options) -> DataFrame:
    """The mix as documents: a row per document and repetition, with the words that this repetition takes.

    Where it takes the whole document the text stays as it is; otherwise the words of the taken blocks stand in their
    order with one space between. Documents that no slot takes, and those without words, are not part of the mix.
    Plans find their rows by a digest of all columns, so rows without an id and rows that share one are rows like others;
    of rows equal in every column each has its own plan.
    """
    keyed = docs.withColumn("__key", F.unhex(row_digest(docs)))
    mix = Mix(keyed, id_column, text, source, key=F.col("__key"), **options)
    plan = (mix.taken_pieces.groupBy("source_no", "row").agg(
        F.sort_array(F.collect_list(F.struct("from", "to", "times"))).alias("__pieces"))
        .join(mix.placed.select("source_no", "row", F.col("key").alias("__key"), F.col("size").alias("__size")),
              ["source_no", "row"]).select("__key", "__size", "__pieces"))
    words = F.filter(F.split(text, GAP), lambda w: w != "")
    # the words are cut out below the repetition, or each piece would cut the text anew
    rows = keyed.dropDuplicates(["__key"]).join(plan, "__key").withColumn("__words", words).withColumn(
        "__round", F.explode(F.sequence(F.lit(1), F.array_max(F.transform("__pieces", lambda p: p["times"])).cast("int"))))
    kept = rows.withColumn("__kept", F.filter("__pieces", lambda p: p["times"] >= F.col("__round")))
    whole = F.aggregate("__kept", F.lit(0).cast("long"), lambda n, p: n + p["to"] - p["from"]) == F.col("__size")
    parts = F.flatten(F.transform("__kept", lambda p: F.slice("__words", (p["from"] + 1).cast("int"), (p["to"] - p["from"]).cast("int"))))
    out = kept.withColumn(text, F.when(whole, F.col(text)).otherwise(F.array_join(parts, " ")))
    if length in docs.columns:
        out = out.withColumn(length, F.char_length(text).cast(docs.schema[length].dataType))
    return out.select(*docs.columns)
