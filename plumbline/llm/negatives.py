"""Hard negatives by exact scores: the method of the Four Russians on bit planes.

Vectors are integers: floor(scale * x) per component. An anchor's components are cut into groups of eight dimensions, and a
table of all 256 subset sums is made per group. A candidate is packed as bit planes (two's complement): per plane one byte
per group tells which of its eight components have that bit. The inner product is then, per plane, the sum of one look-up
per group, shifted into place and added (the top plane subtracted): no multiplication, and exact.

Two passes over blocks. Positives meet label by label: only rows of an anchor's label can be among them. Negatives meet in a
grid of candidate blocks and anchor blocks, with the positives' scores known, so that a cell sends on at most ``negatives``
rows per anchor and positive. A label that holds most rows, and any number of anchors, is many blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import groups, settled, whole_groups

CANDIDATES = 1 << 14       # rows of a candidate block
ANCHORS = 1 << 13          # rows of an anchor block
ANCHORS_AT_ONCE = 256
CANDIDATES_AT_ONCE = 1_024
LARGEST = 2 ** 27          # components of at least this size have no exact 64-bit score and take no part

VECTOR_SCHEMA = "row long, id long, label long, vector binary"
NO_ID = np.iinfo(np.int64).max


def integer_rows(vectors: DataFrame, id_column: str, label: Column, vector: str, scale: int) -> DataFrame:
    """row (a number of its own), id, label and components floor(scale * x) as little-endian int32 of each row that takes part."""
    source = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("id"),
                            label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"))

    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.compute.and_(pa.compute.is_valid(batch.column("vector")),
                                                 pa.compute.is_valid(batch.column("label"))))
            if batch.num_rows == 0:
                continue
            lists = batch.column("vector")
            sizes = np.asarray(pa.compute.list_value_length(lists), np.int64)
            flat = lists.flatten()
            raw = np.floor(scale * np.asarray(flat.fill_null(np.nan), np.float64))
            bad = ~(np.abs(raw) < LARGEST)                          # missing and infinite ones, too
            owner = np.repeat(np.arange(len(sizes)), sizes)
            fit = np.ones(len(sizes), bool)
            fit[owner[bad]] = False
            whole = np.where(bad, 0, raw).astype("<i4")
            cut = np.concatenate(([0], np.cumsum(sizes)))
            packed = [whole[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), batch.column("label"),
                                              pa.array(packed, pa.binary())], names=["row", "id", "label", "vector"]
                                             ).filter(pa.array(fit))

    return source.mapInArrow(run, VECTOR_SCHEMA)


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Vectors as rows of a matrix, filled with zeros up to ``dims``."""
    values = column.to_pylist()
    if all(len(v) == 4 * dims for v in values):
        return np.frombuffer(b"".join(values), "<i4").reshape(len(values), dims)
    out = np.zeros((len(values), dims), np.int32)
    for i, v in enumerate(values):
        out[i, :len(v) // 4] = np.frombuffer(v, "<i4")
    return out


def _width(*columns: pa.ChunkedArray) -> int:
    """Dimensions of the longest vector, in whole groups of eight."""
    most = max((pa.compute.max(pa.compute.binary_length(c)).as_py() or 0 for c in columns if len(c)), default=0) // 4
    return max(8, -(-most // 8) * 8)


def bit_planes(vectors: np.ndarray) -> np.ndarray:
    """[planes, groups, rows] bytes of integer rows [rows, dims] in two's complement; the last plane is the sign."""
    planes = max(int(vectors.max(initial=0)).bit_length(), int(-1 - vectors.min(initial=0)).bit_length()) + 1
    return np.stack([np.packbits((vectors >> b & 1).astype(bool), axis=1, bitorder="little").T for b in range(planes)])


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """[groups, 256, anchors]: for each eight components and each subset of them, their sum, by doubling."""
    dims = anchors.shape[1]
    sums = np.zeros((dims // 8, 256, len(anchors)), kind)
    for bit in range(8):
        sums[:, 1 << bit:2 << bit] = sums[:, :1 << bit] + anchors.T[bit::8, None, :].astype(kind)
    return sums


def scores(planes: np.ndarray, sums: np.ndarray, wide: bool) -> np.ndarray:
    """Exact inner products [rows, anchors] of packed candidates and an anchors' table of subset sums."""
    count, groups_, rows = planes.shape
    total = np.zeros((rows, sums.shape[2]), np.int64 if wide else np.int32)
    plane, part = (np.empty(total.shape, sums.dtype) for _ in range(2))
    for b in range(count - 1, -1, -1):
        np.take(sums[0], planes[b, 0], axis=0, out=plane, mode="clip")
        for g in range(1, groups_):
            np.take(sums[g], planes[b, g], axis=0, out=part, mode="clip")
            plane += part
        if b == count - 1:
            total -= plane                                          # the sign's plane
        else:
            total += plane
        if b:
            total <<= 1
    return total


class Tables:
    """Subset sums of some anchors, in the narrowest type that holds every sum over a plane."""

    def __init__(self, anchors: np.ndarray):
        self.most = int(np.abs(anchors.astype(np.int64)).sum(axis=1).max(initial=0))
        self.sums = subset_sums(anchors, np.int16 if self.most < 2 ** 15 else np.int32 if self.most < 2 ** 31 else np.int64)

    def of(self, planes: np.ndarray) -> np.ndarray:
        return scores(planes, self.sums, self.most << len(planes) >= 2 ** 31)


def _best(of: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray, most: int) -> np.ndarray:
    """Positions of the first ``most`` entries of each ``of``: higher scores, then smaller ids, then row numbers."""
    order = np.lexsort((row, ids, -score, of))
    ranked = of[order]
    head = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, bool)
    at = np.arange(len(ranked))
    return order[at - np.maximum.accumulate(np.where(head, at, 0)) < most]


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return np.asarray(column.combine_chunks().fill_null(NO_ID), np.int64)


def _parts(n: int, size: int) -> Iterator[slice]:
    for a in range(0, n, size):
        yield slice(a, min(n, a + size))


def best_positives(rows: DataFrame, anchors: DataFrame, most: int, block: int = CANDIDATES) -> DataFrame:
    """anchor (its row), id, row and score of the ``most`` best other rows of each anchor's label; rank from 1.

    A label's rows are dealt into blocks of about ``block``; each block sees all anchors of the label, in runs.
    """
    sizes = anchors.select("label").distinct().join(rows, "label").groupBy("label").agg(
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = rows.join(sizes, "label").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    asked = anchors.join(sizes, "label").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    both = dealt.select(F.xxhash64("label", "block").alias("task"), F.lit(0).alias("side"), "row", "id", "label", "vector"
                        ).unionByName(asked.select(F.xxhash64("label", "block").alias("task"), F.lit(1).alias("side"),
                                                   "row", "id", "label", "vector"))

    def run(batches):
        for group in groups(batches, "task"):
            side, label = np.asarray(group.column("side")), np.asarray(group.column("label"))
            dims = _width(group.column("vector"))
            all_ids, all_rows = _ids(group.column("id")), np.asarray(group.column("row"))
            matrix = _matrix(group.column("vector"), dims)
            mine, ask = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if not len(mine) or not len(ask):
                continue
            packed = [bit_planes(matrix[mine[c]]) for c in _parts(len(mine), CANDIDATES_AT_ONCE)]
            for a in _parts(len(ask), ANCHORS_AT_ONCE):
                part = ask[a]
                table = Tables(matrix[part])
                held = [np.zeros(0, np.int64) for _ in range(4)]     # anchor, score, id, row
                for c, planes in zip(_parts(len(mine), CANDIDATES_AT_ONCE), packed, strict=True):
                    s = table.of(planes).astype(np.int64)
                    other = (all_rows[mine[c]][:, None] != all_rows[part]) & (label[mine[c]][:, None] == label[part])
                    top = max(0, len(s) - most)
                    least = np.partition(np.where(other, s, np.iinfo(np.int64).min), top, axis=0)[top]
                    i, j = np.nonzero(other & (s >= least))
                    held = [np.concatenate(x) for x in zip(held, (j, s[i, j], all_ids[mine[c]][i], all_rows[mine[c]][i]), strict=True)]
                    keep = _best(held[0], held[1], held[2], held[3], most)
                    held = [h[keep] for h in held]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(all_rows[part][held[0]]), pa.array(held[2], mask=held[2] == NO_ID), pa.array(held[3]),
                     pa.array(held[1])], names=["anchor", "id", "row", "score"])

    found = whole_groups(both, "task", "side", "row").mapInArrow(run, "anchor long, id long, row long, score long")
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def mined(vectors: DataFrame, anchor: Column, id_column: str = "vec_id", label: Column | str = "label",
          vector: str = "embedding", positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
          scale: int = 256, candidate_block: int = CANDIDATES, anchor_block: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor``: condition on the id that makes a row an anchor. Per anchor its first ``positives`` other rows of equal label,
    and for each of them the first ``negatives`` rows of another label whose score s has
    low * positive score <= 100 * s <= high * positive score. Higher scores come first, ties by smaller id.

    Rows with a null label or vector or a missing, infinite or oversized (``LARGEST``) component take no part. A shorter
    vector counts as filled up with zeros, an empty one as all zeros. Repeated rows are rows of their own: each is a positive
    or negative of its own, and an anchor's copy is not the anchor. A null id is no anchor, and the last of equal scores.
    Anchors without positives, and pairs without negatives, give no rows, as does an empty table. Other columns are ignored.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = settled(integer_rows(vectors, id_column, label, vector, scale))
    anchors = rows.filter(anchor)
    known = settled(best_positives(rows, anchors, positives, candidate_block))
    asked = anchors.join(known.groupBy(F.col("anchor").alias("row")).agg(
        F.sort_array(F.collect_list("score"), asc=False).alias("bars")), "row")      # at most ``positives`` numbers each
    counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(anchor, 1)).alias("anchors")).head()
    tall, wide = -(-counts["rows"] // candidate_block) or 1, -(-counts["anchors"] // anchor_block) or 1
    dealt = (rows.withColumn("i", F.pmod(F.xxhash64("row"), F.lit(tall)).cast("int"))
             .withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(wide - 1)))).withColumn("bars", F.lit(None).cast("array<long>")))
    grid = (asked.withColumn("j", F.pmod(F.xxhash64("row"), F.lit(wide)).cast("int"))
            .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(tall - 1)))))
    columns = [(F.col("i").cast("long") * wide + F.col("j")).alias("task"), "row", "id", "label", "vector", "bars"]
    cells = dealt.select(*columns).unionByName(grid.select(*columns)).repartition(min(tall * wide, 1 << 14), "task")

    def run(batches):
        for group in groups(batches, "task"):
            asks = np.asarray(pa.compute.is_valid(group.column("bars")))
            label_ = np.asarray(group.column("label"))
            all_ids, all_rows = _ids(group.column("id")), np.asarray(group.column("row"))
            matrix = _matrix(group.column("vector"), _width(group.column("vector")))
            mine, ask = np.flatnonzero(~asks), np.flatnonzero(asks)
            if not len(mine) or not len(ask):
                continue
            bars = np.full((len(ask), positives), np.iinfo(np.int64).min)
            for at, b in enumerate(group.column("bars").filter(pa.array(asks)).to_pylist()):
                bars[at, :len(b)] = b
            packed = [bit_planes(matrix[mine[c]]) for c in _parts(len(mine), CANDIDATES_AT_ONCE)]
            for a in _parts(len(ask), ANCHORS_AT_ONCE):
                part, bar = ask[a], bars[a]
                table = Tables(matrix[part])
                usable = bar >= 0                   # a positive with a score below 0 admits nothing
                floor_ = np.where(usable, -(-low * bar // 100), np.iinfo(np.int64).max).min(axis=1)
                held = [np.zeros(0, np.int64) for _ in range(4)]     # anchor and positive, score, id, row
                for c, planes in zip(_parts(len(mine), CANDIDATES_AT_ONCE), packed, strict=True):
                    s = table.of(planes)
                    i, j = np.nonzero(s >= (floor_ if s.dtype == np.int64 else np.minimum(floor_, 2 ** 31 - 1).astype(np.int32)))
                    score, row = s[i, j].astype(np.int64), mine[c][i]
                    keep = label_[row] != label_[part[j]]
                    j, score, row = j[keep], score[keep], row[keep]
                    for k in range(positives):
                        fits = usable[j, k] & (100 * score >= low * bar[j, k]) & (100 * score <= high * bar[j, k])
                        more = (j[fits] * positives + k, score[fits], all_ids[row[fits]], all_rows[row[fits]])
                        held = [np.concatenate(x) for x in zip(held, more, strict=True)]
                    keep = _best(*held, negatives)
                    held = [h[keep] for h in held]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(all_rows[part][held[0] // positives]), pa.array((held[0] % positives + 1).astype(np.int32)),
                     pa.array(held[2], mask=held[2] == NO_ID), pa.array(held[3]), pa.array(held[1])],
                    names=["anchor", "place", "negative_id", "negative", "negative_score"])

    found = cells.sortWithinPartitions("task", "row").mapInArrow(
        run, "anchor long, place int, negative_id long, negative long, negative_score long")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"), "negative")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    pairs = known.join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor").select(
        "anchor", "anchor_id", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return best.join(pairs, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                                        "negative_score")
