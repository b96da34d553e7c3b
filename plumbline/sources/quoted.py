"""Quoted CSV split over tasks: cells may hold line breaks, and still a large file is read by many tasks.

Whether a line begins a record depends on all quotes before it. Quotes are doubled inside quoted cells, so a line begins
inside a cell exactly if the number of quotes before it is odd. Three steps, none of which holds a file:

1. each split of a file reports how many quotes it holds; a running sum over the splits tells in which state each begins;
2. each split, knowing its state, joins its lines to records. Lines before its first record start, and a record that is
   still open at its end, are *pieces*;
3. the pieces of a record, from as many splits as it spans, are put together. Only splits that begin or end inside a cell
   are read for that.

Records are parsed by the engine's own CSV functions. A quote inside an unquoted cell would turn the count around, so a
record that is not made of whole cells fails and is never shifted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Options that keep the meaning of a quote and of a line; any other sends a file to the engine's own reader.
UNDERSTOOD = {"header", "quote", "escape", "sep", "delimiter", "nullValue", "emptyValue", "mode", "multiLine",
              "ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace", "recursiveFileLookup", "pathGlobFilter"}
MOST_BROADCAST = 100_000       # splits; one is a path and two numbers

WHOLE, PIECE = 0, 1
SPLIT = ["__file", "__start"]


def understood(options: dict[str, str]) -> bool:
    quote = options.get("quote", '"')
    return (set(options) <= UNDERSTOOD and len(quote) == 1 and options.get("escape") == quote
            and options.get("mode", "PERMISSIVE").upper() != "DROPMALFORMED")


def _lines(spark: SparkSession, path: str, options: dict[str, str]) -> DataFrame:
    """value, the split's file and offset, and the columns that folders give; the rows of a split in the order of the file."""
    kept = {k: v for k, v in options.items() if k in ("recursiveFileLookup", "pathGlobFilter")}
    text = spark.read.options(**kept, lineSep="\n").text(str(path))
    return text.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"))


def split_states(lines: DataFrame, quote: str) -> DataFrame:
    """Per split: whether it begins and whether it ends inside a cell."""
    held = F.length("value") - F.length(F.replace(F.col("value"), F.lit(quote), F.lit("")))
    counted = lines.groupBy(*SPLIT).agg(F.sum(held).alias("quotes"))
    before = Window.partitionBy("__file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    states = counted.select(*SPLIT, (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("begins"), "quotes")
    return states.select(*SPLIT, "begins", ((F.col("quotes") + F.col("begins").cast("long")) % 2 == 1).alias("ends"))


def _with_states(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Lines with their split's state, still split by split and in order."""
    bound = lines.rdd.getNumPartitions() + len(lines.inputFiles())       # splits, known without a job
    if bound <= MOST_BROADCAST:
        return lines.join(F.broadcast(states), SPLIT)
    placed = lines.withColumn("__at", F.monotonically_increasing_id()).join(states, SPLIT)
    return placed.repartition(*SPLIT).sortWithinPartitions(*SPLIT, "__at").drop("__at")


def _assemble(quote: str, extra: list[str]):
    """Lines of splits -> whole records and pieces; ``order`` numbers a split's pieces, ``opens`` marks the start of a record."""

    def rows(split: dict, kinds, texts: pa.Array, opens, first, order, like: pa.RecordBatch) -> pa.RecordBatch:
        n = len(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([split["file"]] * n, pa.string()), pa.array(np.full(n, split["start"])), pa.array(np.asarray(kinds, np.int32)),
             pa.array(np.asarray(opens, bool)), pa.array(np.asarray(first, bool)), pa.array(np.asarray(order, np.int32)),
             texts.cast(pa.string()), *[pa.array(like.column(c)[:1].to_pylist() * n, like.column(c).type) for c in extra]],
            names=["file", "start", "kind", "opens", "first", "order", "record", *extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = last = None
        held: list[str] = []           # lines of the record that is open
        inside = True                  # whether the open record began in an earlier split
        state = fresh = False          # state at the next line; whether the next record is the first of a file

        def close(closed: bool):
            """What is open when the split ends, or its continuation of an earlier split's record."""
            text = pa.array(["\n".join(held)])
            if inside or not closed:
                return rows(current, [PIECE], text, [not inside], [fresh], [0 if inside else 1], last)
            return rows(current, [WHOLE], text, [True], [fresh], [0], last)

        for batch in batches:
            if not batch.num_rows:
                continue
            files, starts = batch.column("__file"), np.asarray(batch.column("__start"))
            change = (np.diff(starts) != 0) | np.asarray(pc.not_equal(files[1:], files[:-1]).cast(pa.int8()), bool)
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(a, b - a)
                split = {"file": files[a].as_py(), "start": int(starts[a])}
                if split != current:
                    if current is not None and held:
                        yield close(not state)
                    current, held = split, []
                    state = inside = part.column("begins")[0].as_py()
                    fresh = current["start"] == 0
                last = part
                values = part.column("value")
                odd = np.asarray(pc.count_substring(values, quote)) % 2
                after = (np.cumsum(odd) + state) % 2 == 1                   # inside a cell after each line
                ends = np.flatnonzero(~after)                               # lines that end a record
                state = bool(after[-1])
                if not len(ends):
                    held += values.to_pylist()
                    continue
                held += values.slice(0, int(ends[0]) + 1).to_pylist()
                yield close(True)
                fresh, inside = fresh and not "".join(held).strip("\r"), False      # blank lines may stand before the header
                if len(ends) > 1:
                    offsets = pa.array((ends + 1).astype(np.int32))
                    records = pc.binary_join(pa.ListArray.from_arrays(offsets, values), "\n")
                    n, first = len(records), np.zeros(len(records), bool)
                    if fresh:
                        said = np.flatnonzero(~np.asarray(pc.is_in(records, pa.array(["", "\r"]))))
                        first[said[:1]], fresh = True, not len(said)
                    yield rows(current, [WHOLE] * n, records, [True] * n, first, [0] * n, last)
                held = values.slice(int(ends[-1]) + 1).to_pylist()
        if current is not None and held:
            yield close(not state)

    return run


def records(spark: SparkSession, path: str, options: dict[str, str]) -> DataFrame:
    """One row per record: ``record`` as it stands in the file, ``first`` for the first of a file, and folder columns."""
    quote = options.get("quote", '"')
    lines = _lines(spark, path, options)
    extra = [c for c in lines.columns if c not in ("value", *SPLIT)]
    states = split_states(lines, quote)
    kinds = dict(lines.dtypes)
    schema = "file string, start long, kind int, opens boolean, first boolean, `order` int, record string" + "".join(
        f", `{c}` {kinds[c]}" for c in extra)
    joined = _with_states(lines, states)
    whole = joined.mapInArrow(_assemble(quote, extra), schema).filter(F.col("kind") == WHOLE)
    pieces = _with_states(lines, states.filter("begins or ends")).mapInArrow(_assemble(quote, extra), schema).filter(
        F.col("kind") == PIECE)
    # a piece that does not open a record continues the one opened last
    so_far = Window.partitionBy("file").orderBy("start", "order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = pieces.withColumn("owner", F.sum(F.col("opens").cast("long")).over(so_far))
    mended = owned.groupBy("file", "owner", *extra).agg(
        F.sort_array(F.collect_list(F.struct("start", "order", "record", "first"))).alias("parts"))
    mended = mended.select(F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"),
                           F.get("parts", 0)["first"].alias("first"), *extra)
    return whole.select("record", "first", *extra).unionByName(mended).withColumn(
        "record", F.regexp_replace("record", r"\r\z", "")).filter("record <> ''")


def read_quoted(spark: SparkSession, path: str, options: dict[str, str]) -> DataFrame:
    """A CSV table of text columns, of any number of files, each split over tasks. See the module's docstring."""
    quote, sep = options.get("quote", '"'), options.get("sep", options.get("delimiter", ","))
    found = records(spark, path, options)
    extra = [c for c in found.columns if c not in ("record", "first")]
    names = [c for c in spark.read.options(**{**options, "multiLine": "true"}).csv(str(path)).columns if c not in extra]
    q, s = (_literal(x) for x in (quote, sep))
    cell = f"(?:{q}[^{q}]*+{q})++|[^{q}{s}]*+" if len(sep) == 1 else None
    rows = found.filter("not first") if options.get("header", "false").lower() == "true" else found
    if cell:
        broken = F.contains("record", F.lit(quote)) & ~F.col("record").rlike(rf"\A(?:{cell})(?:{s}(?:{cell}))*+\z")
        rows = rows.withColumn("record", F.when(broken, F.raise_error(F.concat(
            F.lit("a quote stands outside of a quoted cell; read this file with split=False: "), F.substring("record", 1, 200))))
            .otherwise(F.col("record")))
    schema = ", ".join(f"`c{i}` string" for i in range(len(names)))
    parsing = {k: v for k, v in options.items() if k not in ("header", "recursiveFileLookup", "pathGlobFilter")}
    cells = rows.select(F.from_csv("record", schema, {**parsing, "multiLine": "true"}).alias("r"), *extra)
    return cells.select(*[F.col(f"r.c{i}").alias(name) for i, name in enumerate(names)], *extra)


def _literal(text: str) -> str:
    return "".join(f"\\x{{{ord(ch):x}}}" for ch in text)
