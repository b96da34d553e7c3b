"""Near-duplicate documents: MinHash bands propose, odd sketches estimate, full shingle sets decide.

A document's set holds its distinct five-word shingles. Documents of equal sets are one *class* from the start. Per class:

* ``BANDS`` x ``ROWS`` MinHash values make the band keys. A pair at the threshold of 0.85 shares no band with probability
  (1 - 0.85^5)^25 = 4e-7.
* One MinHash value for each of ``BINS`` hash ranges (one-permutation hashing) is folded into a bitmap of ``BITS`` parities:
  an odd sketch. The population count of two sketches' XOR estimates how many samples differ, most precisely where few do.

Classes that share a band and whose sketches do not rule the pair out (estimate within ``MARGIN``, six standard errors, of
the threshold) form clusters; each cluster's full sets meet in a task that confirms links exactly. A cluster beyond
``BLOCK`` classes is dealt into blocks, and each pair of blocks is a task, so no task grows with a cluster. Within a task
pairs that earlier links already connect are skipped; components need one link only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import (SLICE_BYTES, Buffer, groups, mix, release_memory, row_digest, sequence_hashes, settled,
                                  slices, texts_of, whole_groups, words_of)

SHINGLE = 5
ROWS, BANDS = 5, 25
BINS = 1_024
BITS = 1_024
MARGIN = 0.10
BLOCK = 1_024
SET_BYTES = 2 << 20        # text whose sets a task makes at once
PAIRS_AT_ONCE = 1 << 17

_FACTORS = mix(np.arange(1, ROWS * BANDS + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: list[bytes], width: int = SHINGLE) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, ascending. Fewer words than ``width``: the whole sequence as one shingle."""
    words = words_of(Buffer.of(texts))
    rolled = sequence_hashes(words.hashes, width)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        n = int(b - a)
        if n >= width:
            out.append(np.unique(rolled[a:b - width + 1]))
        elif n:
            out.append(mix(sequence_hashes(words.hashes[a:b], n) + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _class_key(values: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return (np.bitwise_xor.reduce(mix(values + np.uint64(17))).tobytes()
            + np.add.reduce(mix(values + np.uint64(29))).tobytes())


def _signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Band keys [sets, BANDS] and odd sketches [sets, BITS / 64] of sets that are not empty."""
    flat = np.concatenate(sets)
    starts = np.zeros(len(sets), np.int64)
    np.cumsum([len(s) for s in sets[:-1]], out=starts[1:])
    keys = np.zeros((len(sets), BANDS), np.uint64)
    for band in range(BANDS):
        h = np.full(len(sets), np.uint64(band + 1))
        for factor in _FACTORS[band * ROWS:(band + 1) * ROWS]:
            h = mix(h + np.minimum.reduceat(flat * factor, starts))
        keys[:, band] = h
    sketches = np.zeros((len(sets), BITS // 64), np.uint64)
    shift = np.uint64(64 - BINS.bit_length() + 1)
    for row, values in enumerate(sets):
        bins = (values >> shift)
        first = np.ones(len(values), bool)          # values ascend, so a bin's first value is its minimum
        first[1:] = bins[1:] != bins[:-1]
        bit = mix(values[first] + np.uint64(101)) % np.uint64(BITS)
        odd = np.flatnonzero(np.bincount(bit.astype(np.int64), minlength=BITS) & 1)
        np.bitwise_or.at(sketches[row], odd >> 6, np.uint64(1) << (odd & 63).astype(np.uint64))
    return keys, sketches


def estimates(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Similarity of sets from their odd sketches and sizes."""
    odd = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    load = np.clip(2.0 * odd / BITS, 0, 1 - 1 / BITS)
    differ = -0.5 * BITS * np.log1p(-load)                      # samples in one sketch only
    taken = lambda n: BINS * -np.expm1(-n / BINS)               # noqa: E731  bins that n values fill
    both = (taken(size_a) + taken(size_b) - differ) / 2         # bins with the same minimum
    j = np.full(len(odd), 0.85)
    for _ in range(4):
        j = np.clip(both / taken((size_a + size_b) / (1 + j)), 0, 1)
    return j


class _Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _pairs(left: np.ndarray, right: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within ``left``, or between ``left`` and ``right``, a bounded number at once."""
    step = max(1, PAIRS_AT_ONCE // max(1, len(left if right is None else right)))
    for at in range(0, len(left), step):
        part = left[at:at + step]
        other = left if right is None else right
        i, j = np.repeat(part, len(other)), np.tile(other, len(part))
        if right is None:
            keep = i < j
            i, j = i[keep], j[keep]
        yield i, j


def _candidates(sketches: np.ndarray, sizes: np.ndarray, low: float, left: np.ndarray,
                right: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose sketches estimate at least ``low``, best first."""
    found = []
    for i, j in _pairs(left, right):
        small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
        fit = small >= (low * large)                           # the similarity is at most small / large
        i, j = i[fit], j[fit]
        e = estimates(sketches[i], sketches[j], sizes[i].astype(float), sizes[j].astype(float))
        keep = e >= low
        found.append((i[keep], j[keep], e[keep]))
    i, j, e = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((j, i, -e))
    return i[order], j[order]


def _binary_matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def _kind(docs: DataFrame, id_column: str) -> str:
    """Ids are numbers; keys made from rows are bytes."""
    return "binary" if dict(docs.dtypes)[id_column] == "binary" else "long"


def sets_of(docs: DataFrame, id_column: str, text: str, width: int = SHINGLE) -> DataFrame:
    """One row per document: id, n_shingles, class key, and for sets that are not empty band keys and odd sketch."""
    kind = _kind(docs, id_column)
    source = docs.select(F.col(id_column).cast(kind).alias("doc"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in slices(batches, "text", SET_BYTES):
            sets = shingle_sets(texts_of(batch.column("text")), width)
            full = [s for s in sets if len(s)]
            keys, sketches = _signatures(full) if full else (None, None)
            at, rows = 0, {"n": [], "class": [], "bands": [], "sketch": []}
            for s in sets:
                rows["n"].append(len(s))
                rows["class"].append(_class_key(s) if len(s) else None)
                rows["bands"].append(keys[at].view(np.int64).tolist() if len(s) else None)
                rows["sketch"].append(sketches[at].tobytes() if len(s) else None)
                at += len(s) > 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(rows["n"], pa.int64()), pa.array(rows["class"], pa.binary()),
                 pa.array(rows["bands"], pa.list_(pa.int64())), pa.array(rows["sketch"], pa.binary())],
                names=["doc", "n", "class", "bands", "sketch"])
        release_memory()

    return source.mapInArrow(run, f"doc {kind}, n long, class binary, bands array<long>, sketch binary")


def components(edges: DataFrame) -> DataFrame:
    """``edges``: (a, b) of a comparable type. Each node with the smallest node that it is connected to: (node, root).

    Every round each node takes the smallest label among its neighbours' and its own, then labels are followed one step
    (label of the label), so chains halve; each round is settled in the shared folder. A node sends its label once per
    link, and labels are reduced before the shuffle, so a hub is no hot key.
    """
    both = settled(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = settled(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("root")))
    while True:
        heard = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                 .agg(F.min("root").alias("heard")))
        near = labels.join(heard, "node").select("node", F.col("root").alias("old"), F.least("root", "heard").alias("new"))
        # the old root hears of the smaller one, too, and so takes its whole tree along
        offers = near.select("node", "new").unionByName(
            near.filter("new < old").select(F.col("old").alias("node"), "new")).groupBy("node").agg(F.min("new").alias("new"))
        hop = offers.select(F.col("node").alias("new"), F.col("new").alias("root"))
        after = settled(offers.join(hop, "new").select("node", F.least("new", "root").alias("root")))
        moved = after.join(labels.withColumnRenamed("root", "old"), "node").filter("root <> old").limit(1).count()
        labels = after
        if not moved:
            return labels


def link_classes(classes: DataFrame, docs: DataFrame, id_column: str, text: str, percent: int = 85,
                 width: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """Confirmed links between classes (class, rep, n, bands, sketch): (a, b) by class key, enough to connect components."""
    low = percent / 100 - MARGIN
    rows = classes.select("class", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    banded = (rows.join(shared, "band")
              .withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
              .withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select(F.xxhash64("band", F.least("own", "other"), F.greatest("own", "other")).alias("task"), "class",
                      F.col("own"), (F.col("own") == F.col("other")).alias("alone"))
              .join(classes.select("class", "n", "sketch"), "class"))

    def propose(batches):
        for group in groups(batches, "task"):
            edges = _links(group, low)
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*edges, strict=True)],
                                                 names=["a", "b"])

    proposed = settled(whole_groups(banded, "task", "class").mapInArrow(propose, "a binary, b binary"))
    clusters = settled(components(proposed))
    sizes = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    needed = clusters.join(sizes, "root").join(classes, clusters["node"] == classes["class"]).select(
        "class", "rep", "n", "sketch", "root", "members")
    source = docs.select(F.col(id_column).cast(_kind(docs, id_column)).alias("rep"), F.col(text).cast("string").alias("text"))
    picked = source.join(needed.select("rep", F.col("class").alias("want")).hint("shuffle_hash"), "rep")

    def resolve(batches):
        for batch in slices(batches, "text", SLICE_BYTES):
            sets = shingle_sets(texts_of(batch.column("text")), width)
            want = batch.column("want").to_pylist()
            hit = [(w, s.tobytes()) for w, s in zip(want, sets, strict=True) if len(s) and _class_key(s) == w]
            if hit:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*hit, strict=True)],
                                                 names=["class", "values"])

    values = picked.mapInArrow(resolve, "class binary, values binary").groupBy("class").agg(F.first("values").alias("values"))
    dealt = (needed.withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
             .join(values, "class")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other")).alias("task"), "class", "n",
                     "sketch", "values", "own", (F.col("own") == F.col("other")).alias("alone")))

    def confirm(batches):
        for group in groups(batches, "task"):
            edges = _links(group, low, percent)
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*edges, strict=True)],
                                                 names=["a", "b"])

    return whole_groups(dealt, "task", "class").mapInArrow(confirm, "a binary, b binary")


def _links(group: pa.Table, low: float, percent: int | None = None) -> list[tuple[bytes, bytes]]:
    """Links that connect a group's candidates; with ``percent``, only such as full sets confirm."""
    if group.num_rows < 2:
        return []
    keys, sizes = group.column("class").to_pylist(), np.asarray(group.column("n"))
    sketches, own = _binary_matrix(group.column("sketch")), np.asarray(group.column("own"))
    sides = np.unique(own)
    if np.asarray(group.column("alone")).any():     # a block with itself
        i, j = _candidates(sketches, sizes, low, np.arange(len(keys)), None)
    elif len(sides) == 2:
        i, j = _candidates(sketches, sizes, low, np.flatnonzero(own == sides[0]), np.flatnonzero(own == sides[1]))
    else:
        return []
    sets = [np.frombuffer(v, np.uint64) for v in group.column("values").to_pylist()] if percent else None
    forest, out = _Forest(len(keys)), []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        if forest.root(a) == forest.root(b):
            continue
        if percent:
            both = len(sets[a]) + len(sets[b])
            merged = np.concatenate((sets[a], sets[b]))
            merged.sort()
            common = int(np.count_nonzero(merged[1:] == merged[:-1]))
            if 100 * common < percent * (both - common):
                continue
        forest.join(a, b)
        out.append((keys[a], keys[b]))
    return out


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = 85,
                    width: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """Per document: its id, ``n_shingles``, ``component_id`` (smallest id reachable over links) and ``kept``.

    Links join documents whose shingle sets have 100 * intersection >= ``percent`` * union. A null or empty text has an
    empty set and links with nothing. Repeated rows link with each other; rows of one id but different texts are told
    apart by their sets. A null id never is the smallest of a group unless all its ids are null: then ``component_id`` is
    null and ``kept`` false. Other columns are ignored, whatever their names.
    """
    found = settled(sets_of(docs, id_column, text, width))
    classes = settled(found.filter("n > 0").groupBy("class", "n")
                      .agg(F.min("doc").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
    links = settled(link_classes(classes, docs, id_column, text, percent, width, block))
    reps = classes.select("class", "rep")
    by_root = components(links).withColumnRenamed("node", "class")
    smallest = (by_root.join(reps, "class").groupBy("root").agg(F.min("rep").alias("smallest")))
    moved = by_root.join(smallest, "root").select("class", "smallest")
    final = reps.join(moved, "class", "left").select("class", F.coalesce("smallest", "rep").alias("component_id"))
    out = found.select("doc", "n", "class").join(final, "class", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc"))
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc") == component, F.lit(False)).alias("kept"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """The documents without near copies: of each group the row with the smallest id stays, and of its rows without an id one.

    Rows are told apart by a key of their id and all their columns, not by the id alone: different texts of one id are
    documents of their own. Of rows equal in every column one stays.
    """
    id_ = F.col(id_column).cast("long")
    order = F.lpad(F.hex(F.coalesce(id_, F.lit(0)).bitwiseXOR(F.lit(-2**63))), 16, "0")       # bytes in the order of the ids
    keyed = docs.withColumn("__key", F.unhex(F.concat(F.when(id_.isNull(), "01").otherwise("00"), order, row_digest(docs))))
    rows = settled(near_duplicates(keyed, "__key", text, percent).select("doc_id", "component_id", "kept"))
    nameless = rows.filter(F.substring(F.hex("doc_id"), 1, 2) == "01")
    marks = (rows.filter("kept").select(F.col("doc_id").alias("__key"))
             .unionByName(nameless.groupBy("component_id").agg(F.min("doc_id").alias("__key")).select("__key")).distinct())
    return keyed.join(marks, "__key", "left_semi").dropDuplicates(["__key"]).select(*docs.columns)
