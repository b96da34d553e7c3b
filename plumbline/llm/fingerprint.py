"""Document fingerprints: invertible Bloom lookup sketches of a document's paragraphs.

A paragraph beyond ``LEAST`` code points is cut further, after words that end in certain letters, so that an edit moves the
cuts beside it only. A paragraph's digest is 40 bits of its hash and its length. The sketch has a power of two of cells at
or above ``ROOM`` times the number of digests; every digest goes to three cells, where counts add up and digests and their
checks are XORed. Joining its halves folds a sketch to half its cells, so sketches of different sizes subtract. Peeling
cells that hold a single digest recovers the digests that differ. It starts with half the cells of the smaller sketch and, on
failure, retries with twice as many, up to that sketch's; beyond that, larger sketches are built from the digests.

The likeness of two documents is the share of code points (both texts together) in paragraphs that do not differ.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from plumbline.llm.common import power_of_two, slices

LEAST, MOST = 64, 448
FIRST = 16
ROOM = 2.0
LENGTH_BITS = 24
MOST_CELLS = 1 << 21        # of one level; three positions come from one 64-bit value

_PIECE = re.compile(r"[^\n]{%d,%d}?[dnrt][^\w\s]?[ \t\n]|[^\n]{1,%d}\n?|\n" % (LEAST, MOST, MOST))
_MASK = (1 << 64) - 1


def paragraphs(text: str) -> list[str]:
    """The text's paragraphs and their parts; together they are the text."""
    return _PIECE.findall(text)


def digests(text: str) -> list[int]:
    """Digests of the paragraphs, a repeated one with its number, so that all are different."""
    seen: dict[str, int] = {}
    out = []
    for piece in paragraphs(text):
        nth = seen[piece] = seen.get(piece, -1) + 1
        h = xxhash.xxh64_intdigest(piece.encode("utf-8", "surrogatepass"), seed=nth) >> LENGTH_BITS
        out.append(h << LENGTH_BITS | len(piece))
    return out


@lru_cache(maxsize=1 << 14)
def _spread(digest: int) -> tuple[int, int]:
    """Positions (three times 21 bits) and a check of a digest."""
    h = (digest ^ digest >> 29) * 0xBF58476D1CE4E5B9 & _MASK
    h = (h ^ h >> 32) * 0x94D049BB133111EB & _MASK
    h ^= h >> 31
    return h, (h * 0xD6E8FEB86659FD93 & _MASK) >> 32


class Sketch:
    """Cells of counts, XORed digests and XORed checks, and the code points of the text."""

    def __init__(self, cells: int, length: int):
        self.counts, self.keys, self.checks, self.length = [0] * cells, [0] * cells, [0] * cells, length

    @classmethod
    def of(cls, values: list[int], length: int, cells: int | None = None) -> Sketch:
        self = cls(min(MOST_CELLS, cells or power_of_two(ROOM * len(values), FIRST)), length)
        for value in values:
            self.put(value, 1)
        return self

    def cells_of(self, h: int) -> tuple[int, int, int]:
        mask = len(self.counts) - 1
        return h & mask, h >> 21 & mask, h >> 42 & mask

    def put(self, value: int, sign: int) -> None:
        h, check = _spread(value)
        counts, keys, checks = self.counts, self.keys, self.checks
        mask = len(counts) - 1
        for at in (h & mask, h >> 21 & mask, h >> 42 & mask):
            counts[at] += sign
            keys[at] ^= value
            checks[at] ^= check

    def less(self, other: Sketch, cells: int) -> Sketch:
        """Folded to ``cells`` and subtracted."""
        out = Sketch(cells, 0)
        mask = cells - 1
        for sketch, sign in ((self, 1), (other, -1)):
            for i, (n, k, c) in enumerate(zip(sketch.counts, sketch.keys, sketch.checks, strict=True)):
                if n or k or c:
                    at = i & mask
                    out.counts[at] += sign * n
                    out.keys[at] ^= k
                    out.checks[at] ^= c
        return out

    def peeled(self) -> tuple[list[int], list[int]] | None:
        """Digests only in the first and only in the second sketch of a difference; None if peeling gets stuck. Consumes it."""
        sides: tuple[list[int], list[int]] = ([], [])
        due = [i for i, n in enumerate(self.counts) if n]
        steps = 0
        while due:
            at = due.pop()
            key, n = self.keys[at], self.counts[at]
            # positions of one digest may coincide, so that it counts three times in one cell; twice leaves no trace there
            if n not in (1, -1, 3, -3) or _spread(key)[1] != self.checks[at]:
                continue
            sign = 1 if n > 0 else -1
            h = _spread(key)[0]
            if at not in self.cells_of(h):
                continue
            self.put(key, -sign)
            sides[sign < 0].append(key)
            due.extend(self.cells_of(h))
            steps += 1
            if steps > 4 * len(self.counts):
                return None
        if any(self.counts) or any(self.keys) or any(self.checks):
            return None
        return sides

    def text(self) -> str:
        """Length and cells as compressed base64: equal for equal texts."""
        n = len(self.counts)
        raw = struct.pack(f"<Q{n}i{n}Q{n}I", self.length, *self.counts, *self.keys, *self.checks)
        return base64.b64encode(zlib.compress(raw, 1)).decode()

    @classmethod
    def parse(cls, value: str) -> Sketch:
        raw = zlib.decompress(base64.b64decode(value))
        n = (len(raw) - 8) // 16
        got = struct.unpack(f"<Q{n}i{n}Q{n}I", raw)
        self = cls(0, got[0])
        self.counts, self.keys, self.checks = list(got[1:n + 1]), list(got[n + 1:2 * n + 1]), list(got[2 * n + 1:])
        return self


def difference(a: Sketch, b: Sketch) -> tuple[list[int], list[int]] | None:
    """Differing digests from two sketches, with more cells after each failure; None if the smaller sketch is too small."""
    most = min(len(a.counts), len(b.counts))
    cells = max(FIRST, most // 2)
    while cells <= most:
        got = a.less(b, cells).peeled()
        if got is not None:
            return got
        cells *= 2
    return None


def likeness(a: Sketch, b: Sketch, digests_a: list[int], digests_b: list[int]) -> float:
    """Share of code points in common paragraphs; two empty texts are alike."""
    got = difference(a, b)
    cells = 2 * max(len(a.counts), len(b.counts))
    while got is None:
        if cells > MOST_CELLS:
            got = list(set(digests_a) - set(digests_b)), list(set(digests_b) - set(digests_a))
            break
        got = Sketch.of(digests_a, a.length, cells).less(Sketch.of(digests_b, b.length, cells), cells).peeled()
        cells *= 2
    total = a.length + b.length
    differs = sum(value & (1 << LENGTH_BITS) - 1 for side in got for value in side)
    return max(0.0, 1.0 - differs / total) if total else 1.0


def followed(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """Rows by ranges of the id, in order, each range followed by a copy of the next range's first row (``copy`` = 1).

    The ranges' bounds are quantiles of the id, one per range; a text moves once, and one more per range does.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = source.filter("doc_id is not null").approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges))
    bounds = np.unique(np.array(cuts, np.float64))

    @F.pandas_udf(IntegerType())
    def range_of(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        at = np.searchsorted(bounds, ids.where(known, 0).astype("float64"), "right")
        return pd.Series(np.where(known, at, len(bounds) + 1), dtype="int32")

    rows = source.withColumn("range", range_of("doc_id"))
    firsts = (rows.groupBy("range").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id",
                                                       F.xxhash64("text").alias("h"))).alias("f")).collect())   # one per range
    order = sorted(firsts, key=lambda r: r.range)
    heads = spark.createDataFrame([(order[i - 1].range, r.f.doc_id, r.f.h) for i, r in enumerate(order)],
                                  "range int, id long, h long")
    copies = (source.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("h")))
              .dropDuplicates(["range"]).select("doc_id", "text", "range", F.lit(1).alias("copy")))
    return (rows.withColumn("copy", F.lit(0)).unionByName(copies).repartition("range")
            .sortWithinPartitions("range", "copy", F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), "text"))


def compared(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The edited text has the last floor(n / 4) code points replaced by the first as many of the next row's text (by
    ascending id, null ids last, rows of one id by their texts; after the last row the first one). A null text is empty; an
    empty text's edited text is itself. A single row is its own next. Repeated rows follow one another. Other columns are
    ignored, whatever their names.
    """
    def run(batches):
        before = None       # (range, copy, id, text, digests, sketch)
        for batch in slices(batches, "text"):
            out = []
            for range_, copy, id_, words in zip(*(batch.column(c).to_pylist() for c in ("range", "copy", "doc_id", "text")),
                                                strict=True):
                own = digests(words)
                this = (range_, copy, id_, words, own, Sketch.of(own, len(words)))
                if before is not None and before[0] == range_ and not before[1]:
                    out.append(_compare(before, this))
                before = this
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    kinds = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
             ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    schema = pa.schema(kinds)
    return followed(docs, id_column, text).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")


def _compare(row: tuple, following: tuple) -> dict:
    _, _, id_, text, own, sketch = row
    n = len(text)
    edited = text[:n - n // 4] + following[3][:n // 4]
    edited_own = digests(edited)
    edited_sketch = Sketch.of(edited_own, len(edited))
    return {"doc_id": id_, "n_chars": n, "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": sketch.text(), "edited_fingerprint": edited_sketch.text(),
            "near_edited": likeness(sketch, edited_sketch, own, edited_own),
            "near_next": likeness(sketch, following[5], own, following[4])}
