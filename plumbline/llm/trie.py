"""Jaccard join of n-gram sets by prefix trees.

A document's set holds its distinct n-word shingles; documents of equal sets are one *class*, and one row stands for it.
Shingles are globally ordered: by the number of sets that hold them, then by hash. Two sets with intersection >= t * union
share one of their first n - ceil(t n) + 1 shingles in that order, the rarest ones, and mostly none of those occurs twice.

* Counts: a chunk of texts asks for the counts of its classes' shingles, one row per chunk and key range; a range's task
  adds up and answers (2 bytes a shingle). No count goes through the driver.
* Classes that share a leading shingle, with sizes in one or in neighbouring size steps, are joined to *clusters*; every
  link lies inside one. A shingle that many sets lead with is salted, so it is no hot key.
* A cluster's sets meet in a task as a trie: each set is a path of its shingles, in the one order of the cluster. One
  traversal per set carries the partial overlap down shared paths, counts what each set could still gain from what remains
  on both sides, and leaves a subtree when that falls short, when no size in it fits, or when all of it is connected to the
  set already. A cluster of more than ``BLOCK_TOKENS`` shingles is many blocks; see :func:`_large`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import (clip_range, gaps, groups, pack, pack_documents, power_of_two, release_memory, settled, total_bytes,
                                  undo_gaps, unpack, unpack_documents, whole_groups)
from plumbline.llm.near import _class_key, components, shingle_sets

SHINGLE = 4
RANGE_KEYS = 2 << 20       # shingles that a range's task is meant to hold
LEAST_RANGES = 64
COUNT_BITS = 48            # bits of a shingle's hash that are counted; a clash of two only moves them in the order
MOST = 65_535              # larger counts are alike in the order
SALTS = 32
BLOCK_TOKENS = 2 << 20     # shingles of a block
HUBS = 16                  # sets that every block of a large cluster sees
SET_BYTES = 1 << 20        # text whose sets a task makes at once
EDGE = 64                  # shingles of a path that are looked at before the bound is tested again


# ---- the trie ---------------------------------------------------------------------------------------------------------

class Links:
    """Union-find over sets."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


class Trie:
    """Paths of ascending numbers with shared beginnings; a node's edge is a slice of one of the paths."""

    def __init__(self, paths: list[np.ndarray], sizes: np.ndarray, members: list[int]):
        """``sizes``: whole set sizes by member; ``members``: which paths to hold."""
        self.size_of = sizes.tolist()
        self.edge: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.children: list[list[int]] = [[]]
        self.ends: list[list[int]] = [[]]                # members whose path ends at the node
        ordered = sorted(members, key=lambda m: (paths[m].astype(">u4").tobytes(), m))
        stack, depth, held = [0], [0], np.zeros(0, np.int64)
        for m in ordered:
            path = paths[m]
            short = min(len(path), len(held))
            differ = np.flatnonzero(path[:short] != held[:short])
            common = int(differ[0]) if len(differ) else short
            while depth[-1] > common:
                node = stack.pop()
                depth.pop()
                if depth[-1] < common:                   # the edge is split where the new path leaves it
                    top = self._node(self.edge[node][:common - depth[-1]])
                    self.edge[node] = self.edge[node][common - depth[-1]:]
                    self.children[top].append(node)
                    self.children[stack[-1]][-1] = top
                    stack.append(top)
                    depth.append(common)
            if len(path) > common:
                leaf = self._node(path[common:])
                self.children[stack[-1]].append(leaf)
                stack.append(leaf)
                depth.append(len(path))
            self.ends[stack[-1]].append(m)
            held = path
        count = len(self.edge)
        self.least, self.most = [0] * count, [0] * count       # set sizes below a node
        self.rest = [0] * count                                # longest way from a node's top to an end
        self.one = [-1] * count                                # a member, if all below are known to be connected
        for node in self._bottom_up():
            low = [int(sizes[m]) for m in self.ends[node]] + [self.least[c] for c in self.children[node]]
            high = [int(sizes[m]) for m in self.ends[node]] + [self.most[c] for c in self.children[node]]
            self.least[node], self.most[node] = min(low, default=0), max(high, default=0)
            self.rest[node] = len(self.edge[node]) + max((self.rest[c] for c in self.children[node]), default=0)

    def _node(self, edge: np.ndarray) -> int:
        self.edge.append(edge)
        self.children.append([])
        self.ends.append([])
        return len(self.edge) - 1

    def _bottom_up(self) -> list[int]:
        order, stack = [], [0]
        while stack:
            node = stack.pop()
            order.append(node)
            stack.extend(self.children[node])
        return order[::-1]

    def connect(self, member: int, path: np.ndarray, size: int, left: np.ndarray, percent: int, links: Links) -> Iterator[int]:
        """Members that make a link with ``member`` and were not connected to it, in the order found.

        ``left``: shape of the numbers' range + 1; scratch, all zero before and after.
        """
        inside = left                                    # 1 where the path holds the number
        inside[path] = 1
        stack: list[tuple[int, int]] = [(0, 0)]
        while stack:
            node, overlap = stack.pop()
            if node < 0:
                self._settle(~node, links)
                continue
            one = self.one[node]
            if one >= 0 and links.root(one) == links.root(member):
                continue
            low, high = self.least[node], self.most[node]
            if 100 * high < percent * size or 100 * size < percent * low:
                continue
            # |x & y| >= p / (100 + p) * (|x| + |y|), at the smallest size below that may still fit
            need = -(-percent * (size + max(low, -(-percent * size // 100))) // (100 + percent))
            edge, rest, at, short = self.edge[node], self.rest[node], 0, False
            while at < len(edge):
                part = edge[at:at + EDGE]
                ahead = len(path) - int(np.searchsorted(path, part[0]))
                if overlap + min(ahead, rest - at) < need:
                    short = True
                    break
                overlap += int(inside[part].sum())
                at += len(part)
            if short:
                continue
            for m in self.ends[node]:
                if m != member and 100 * overlap >= percent * (size + self.size_of[m] - overlap) and links.root(m) != links.root(member):
                    links.join(m, member)
                    yield m
            children = self.children[node]
            if children:
                stack.append((~node, 0))
                stack.extend((c, overlap) for c in children)
            elif self.one[node] < 0:
                self._settle(node, links)
        inside[path] = 0

    def _settle(self, node: int, links: Links) -> None:
        """Mark a node whose members are all connected."""
        if self.one[node] >= 0:
            return
        ones = self.ends[node] + [self.one[c] for c in self.children[node]]
        if ones and min(ones) >= 0 and len({links.root(m) for m in ones}) == 1:
            self.one[node] = ones[0]


def join_sets(sets: list[np.ndarray], percent: int, stored: list[int] | None = None, asking: list[int] | None = None,
              known: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that connect what is linked: pairs of positions in ``sets`` (ascending hashes, none empty).

    ``stored``: positions that the trie holds; ``asking``: those that traverse it (both: all). ``known``: a group number per
    set; sets of one group count as connected from the start.
    """
    count = len(sets)
    everyone = list(range(count))
    stored, asking = everyone if stored is None else stored, everyone if asking is None else asking
    sizes = np.array([len(s) for s in sets], np.int64)
    values, inverse, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # one order for the cluster: what most sets hold comes first, so that beginnings are shared. A shingle of one set alone
    # overlaps with nothing: it counts in the set's size and needs no place in the trie
    place = np.full(len(values), -1, np.int32)
    shared = np.flatnonzero(times > 1)
    place[shared[np.argsort(-times[shared], kind="stable")]] = np.arange(len(shared))
    cut = np.cumsum(np.concatenate(([0], sizes)))
    numbers = place[inverse]
    del values, inverse, times, place
    paths = []
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        path = numbers[a:b]
        paths.append(np.sort(path[path >= 0]))
    links = Links(count)
    if known is not None:
        first: dict[int, int] = {}
        for i, k in enumerate(known):
            links.join(first.setdefault(k, i), i)
    trie = Trie(paths, sizes, stored)
    scratch = np.zeros(len(shared) + 1, np.uint8)
    return [(m, i) for i in asking for m in trie.connect(i, paths[i], int(sizes[i]), scratch, percent, links)]


# ---- classes and counts -----------------------------------------------------------------------------------------------

def _classes(chunks: DataFrame, width: int) -> DataFrame:
    """(chunk, at, doc, n, class) of every document; an empty set has no class."""
    def run(batches):
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                ids, sets = _sets(blob, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), chunk)), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids, pa.int64()),
                     pa.array(np.fromiter(map(len, sets), np.int64, len(sets))),
                     pa.array([_class_key(s) if len(s) else None for s in sets], pa.binary())],
                    names=["chunk", "at", "doc", "n", "class"])
                del ids, sets
        release_memory()

    return chunks.select("chunk", "blob").mapInArrow(run, "chunk long, at int, doc long, n long, class binary")


def _sets(blob: bytes, width: int, wanted: set[int] | None = None) -> tuple[list, list[np.ndarray]]:
    ids, buffer = unpack_documents(blob)
    ends = buffer.starts + buffer.lengths
    if wanted is not None:
        keep = sorted(wanted)
        texts = [buffer.data[buffer.starts[i]:ends[i]].tobytes() for i in keep]
        return keep, _in_runs(texts, width)
    return ids, _in_runs([buffer.data[a:b].tobytes() for a, b in zip(buffer.starts, ends, strict=True)], width)


def _in_runs(texts: list[bytes], width: int, most: int = SET_BYTES) -> list[np.ndarray]:
    """Sets of texts, a megabyte of them at once: hashing takes tens of bytes a character."""
    out, held, size = [], [], 0
    for t in texts:
        if held and size + len(t) > most:
            out += shingle_sets(held, width)
            held, size = [], 0
        held.append(t)
        size += len(t)
    return out + (shingle_sets(held, width) if held else [])


def _with_rows(chunks: DataFrame, rows: DataFrame) -> DataFrame:
    """Chunks with the positions (``at``) of ``rows`` in them as an array, bounded by a chunk's documents."""
    return chunks.join(rows.groupBy("chunk").agg(F.sort_array(F.collect_list("at")).alias("rows")), "chunk")


def _short(values: np.ndarray) -> np.ndarray:
    return values >> np.uint64(64 - COUNT_BITS)


def _counted(chunks: DataFrame, width: int, bits: int) -> DataFrame:
    """Per chunk and key range the counts of the distinct shingles of the chunk's classes, in the order of their keys."""
    def ask(batches):
        for batch in batches:
            for chunk, blob, rows in zip(*(batch.column(c).to_pylist() for c in ("chunk", "blob", "rows")), strict=True):
                _, sets = _sets(blob, width, set(rows))
                unique, count = np.unique(_short(np.concatenate(sets)), return_counts=True)
                for at, part in clip_range(unique << np.uint64(64 - COUNT_BITS), bits):
                    yield pa.RecordBatch.from_pylist(
                        [{"range": at, "chunk": chunk, "blob": pack(k=gaps(unique[part]), c=count[part].astype(np.uint32))}],
                        pa.schema([("range", pa.int64()), ("chunk", pa.int64()), ("blob", pa.binary())]))
                del sets, unique, count
        release_memory()

    def answer(batches):
        for group in groups(batches, "range"):
            asked = [unpack(b) for b in group.column("blob").to_pylist()]
            held = [undo_gaps(a["k"]) for a in asked]
            unique, at = np.unique(np.concatenate(held), return_inverse=True)
            total = np.bincount(at, weights=np.concatenate([a["c"] for a in asked]), minlength=len(unique))
            total = np.minimum(total, MOST).astype(np.uint16)
            cut = np.cumsum([0] + [len(h) for h in held])
            for i, (chunk, range_) in enumerate(zip(group.column("chunk").to_pylist(), group.column("range").to_pylist(), strict=True)):
                yield pa.RecordBatch.from_pylist([{"chunk": chunk, "range": range_, "blob": pack(c=total[at[cut[i]:cut[i + 1]]])}],
                                                 pa.schema([("chunk", pa.int64()), ("range", pa.int64()), ("blob", pa.binary())]))
            del asked, held, unique, at, total
        release_memory()

    questions = chunks.select("chunk", "blob", "rows").mapInArrow(ask, "range long, chunk long, blob binary")
    return whole_groups(questions, "range", "chunk").mapInArrow(answer, "chunk long, range long, blob binary")


def _leading(chunks: DataFrame, answers: DataFrame, width: int, percent: int) -> DataFrame:
    """(token, chunk, at, n): the leading shingles of each class that occur in another class, too."""
    both = chunks.select("chunk", F.lit(-1).cast("long").alias("range"), "blob", "rows").unionByName(
        answers.select("chunk", "range", "blob", F.lit(None).cast("array<int>").alias("rows")))

    def run(batches):
        for group in groups(batches, "chunk"):
            blobs = group.column("blob").to_pylist()
            rows, sets = _sets(blobs[0], width, set(group.column("rows")[0].as_py()))
            counts = np.concatenate([unpack(b)["c"] for b in blobs[1:]])
            flat = np.concatenate(sets)
            unique, at = np.unique(_short(flat), return_inverse=True)
            if len(unique) != len(counts):
                raise ValueError("a chunk's answers do not cover its shingles")
            n = np.array([len(s) for s in sets], np.int64)
            owner = np.repeat(np.arange(len(sets)), n)
            times = counts[at]
            order = np.lexsort((flat, times, owner))
            place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
            lead = n - (percent * n + 99) // 100 + 1
            use = order[(place < lead[owner]) & (times[order] > 1)]      # ``owner`` ascends, so ``order`` keeps it
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat[use].view(np.int64)), pa.array(np.full(len(use), group.column("chunk")[0].as_py(), np.int64)),
                 pa.array(np.array(rows, np.int32)[owner[use]]), pa.array(n[owner[use]])], names=["token", "chunk", "at", "n"])
            del blobs, sets, flat, unique, at, owner, times, order, place, use
        release_memory()

    return whole_groups(both, "chunk", "range").mapInArrow(run, "token long, chunk long, at int, n long")


# ---- clusters ---------------------------------------------------------------------------------------------------------

def _candidate_edges(leading: DataFrame, percent: int) -> DataFrame:
    """(a, b) of class keys (chunk, at): connects all classes that share a leading shingle and may fit in size.

    Sizes that fit differ by a factor of at most 100 / percent, so they lie in one step or in neighbouring ones. Members of a
    shingle and step follow the smallest of their salt, salts follow the smallest of all, steps follow the step below.
    """
    step = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + 1e-9).cast("int")
    rows = leading.select("token", step.alias("step"), F.struct("chunk", "at").alias("node"),
                          F.pmod(F.xxhash64("chunk", "at"), F.lit(SALTS)).cast("int").alias("salt"))
    salted = rows.groupBy("token", "step", "salt").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("members"))
    least = settled(salted.groupBy("token", "step").agg(F.min("first").alias("least")))
    to_first = rows.join(salted.filter("members > 1"), ["token", "step", "salt"]).select(F.col("node").alias("a"), F.col("first").alias("b"))
    to_least = salted.join(least, ["token", "step"]).select(F.col("first").alias("a"), F.col("least").alias("b"))
    below = least.select("token", (F.col("step") + 1).alias("step"), F.col("least").alias("under"))
    to_below = least.join(below, ["token", "step"]).select(F.col("least").alias("a"), F.col("under").alias("b"))
    return to_first.unionByName(to_least).unionByName(to_below).filter("a <> b").distinct()


def _member_sets(chunks: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """(chunk, at, values) of the classes in ``members``."""
    def run(batches):
        for batch in batches:
            for chunk, blob, wanted in zip(*(batch.column(c).to_pylist() for c in ("chunk", "blob", "rows")), strict=True):
                rows, sets = _sets(blob, width, set(wanted))
                for a in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows[a:a + 256]), chunk)), pa.array(rows[a:a + 256], pa.int32()),
                         pa.array([s.tobytes() for s in sets[a:a + 256]], pa.binary())], names=["chunk", "at", "values"])
                del rows, sets
        release_memory()

    return _with_rows(chunks, members).select("chunk", "blob", "rows").mapInArrow(run, "chunk long, at int, values binary")


def _joined(tasks: DataFrame, percent: int) -> DataFrame:
    """Links within each task: rows (task, stored, asking, known, chunk, at, values) -> (a, b)."""
    node = pa.struct([("chunk", pa.int64()), ("at", pa.int32())])

    def run(batches):
        for group in groups(batches, "task"):
            sets = [np.frombuffer(v, np.uint64) for v in group.column("values").to_pylist()]
            stored, asking = (np.flatnonzero(np.asarray(group.column(c))).tolist() for c in ("stored", "asking"))
            known = group.column("known").to_pylist()
            found = join_sets(sets, percent, stored, asking, [k if k is not None else ~i for i, k in enumerate(known)])
            del sets
            if found:
                chunk, at = np.asarray(group.column("chunk")), np.asarray(group.column("at"))
                i, j = np.array(found).T
                yield pa.RecordBatch.from_arrays(
                    [pa.StructArray.from_arrays([pa.array(chunk[k]), pa.array(at[k])], fields=list(node)) for k in (i, j)],
                    names=["a", "b"])
            del group, found
        release_memory()

    return whole_groups(tasks, "task", "chunk", "at").mapInArrow(
        run, "a struct<chunk: bigint, at: int>, b struct<chunk: bigint, at: int>")


def _large(members: DataFrame, percent: int) -> DataFrame:
    """Links of clusters that are many blocks: ``members`` (root, node, chunk, at, blocks, values).

    Each block is a task, which also sees the cluster's first ``HUBS`` sets; that connects most of what is linked. What lies
    outside a cluster's largest part then is compared with all blocks: its own blocks as askers, the block as the trie. Sets
    of one part are not compared again. So a group of near copies costs one pass, however large it is.
    """
    dealt = settled(members.withColumn("own", F.pmod(F.xxhash64("chunk", "at"), F.col("blocks")).cast("int"))
                    .withColumn("size", F.length("values")))
    hubs = dealt.groupBy("root").agg(F.slice(F.sort_array(F.collect_set(
        F.when(F.pmod(F.xxhash64("at", "chunk"), F.col("blocks") * 8) == 0, F.col("node")))), 1, HUBS).alias("hubs"))
    hub_rows = (dealt.join(hubs, "root").filter(F.expr("array_contains(hubs, node)"))
                .withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("b <> own"))
    columns = [F.lit(True).alias("stored"), F.lit(True).alias("asking"), F.lit(None).cast("long").alias("known"), "chunk", "at", "values"]
    first = settled(_joined(dealt.select(F.xxhash64("root", "own").alias("task"), *columns).unionByName(
        hub_rows.select(F.xxhash64("root", "b").alias("task"), *columns)), percent))
    part = components(first)
    labelled = dealt.join(part.select("node", F.col("root").alias("part")), "node", "left").withColumn("part", F.coalesce("part", "node"))
    weights = labelled.groupBy("root", "part").agg(F.sum("size").alias("w"))
    giant = weights.groupBy("root").agg(F.max(F.struct("w", "part")).alias("g"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    open_ = settled(labelled.join(giant.select("root", F.col("g.part").alias("giant")), "root").select(
        "root", "chunk", "at", "values", "size", "own", "blocks", (F.col("part") == F.col("giant")).alias("inner"),
        F.xxhash64("part.chunk", "part.at").alias("known")))
    outer = open_.filter("not inner")
    counts = outer.groupBy("root").agg(F.ceil(F.sum("size") / (8 * BLOCK_TOKENS)).cast("int").alias("outer"))
    outer = outer.join(counts, "root").withColumn("mine", F.pmod(F.xxhash64("at", "chunk"), F.col("outer")).cast("int"))
    # the largest part's blocks stand, each asked by every block of outsiders
    standing = (open_.filter("inner").join(counts, "root").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("outer") - 1)))
                .select(F.xxhash64("root", F.lit("i"), "own", "o").alias("task"), F.lit(True).alias("stored"),
                        F.lit(False).alias("asking"), "known", "chunk", "at", "values"))
    asking = (outer.withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select(F.xxhash64("root", F.lit("i"), "b", "mine").alias("task"), F.lit(False).alias("stored"),
                      F.lit(True).alias("asking"), "known", "chunk", "at", "values"))
    # outsiders among themselves: each pair of their blocks
    among = (outer.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("outer") - 1)))
             .select(F.xxhash64("root", F.lit("o"), F.least("mine", "o"), F.greatest("mine", "o")).alias("task"),
                     (F.col("mine") <= F.col("o")).alias("stored"), (F.col("mine") >= F.col("o")).alias("asking"), "known",
                     "chunk", "at", "values"))
    return first.unionByName(_joined(standing.unionByName(asking).unionByName(among), percent))


def joined(docs: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = 85, width: int = SHINGLE,
           block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Per row: doc_id, n_shingles (size of its set) and component_id, the smallest id reachable over links, its own included.

    Two rows link when 100 * intersection >= ``percent`` * union of their sets. With fewer words than ``width`` the whole
    sequence is the one shingle; a null or empty text, or one of white space, has an empty set and links with nothing.
    Repeated rows link with each other; rows are told apart by their place, not by their id, so rows of one id or without
    one link by their texts, and a null id is the smallest of a group only if the group has no other (then it is null).
    An empty table gives no rows; other columns are ignored whatever their names. A text of any length is one set in one task.
    """
    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    chunks = pack_documents(source, "id", "text")
    rows = settled(_classes(chunks, width))
    classes = settled(rows.filter("n > 0").groupBy("class", "n").agg(
        F.min(F.struct("chunk", "at")).alias("node"), F.min("doc").alias("doc")))
    firsts = _with_rows(chunks, classes.select("node.chunk", "node.at"))
    bits = power_of_two(total_bytes(chunks) / 6 / RANGE_KEYS, LEAST_RANGES).bit_length() - 1
    leading = settled(_leading(firsts, settled(_counted(firsts, width, bits)), width, percent))
    clusters = settled(components(settled(_candidate_edges(leading, percent))).join(classes.select("node", "n"), "node")
                       .select("node", F.col("node.chunk").alias("chunk"), F.col("node.at").alias("at"), "root", "n"))
    weights = clusters.groupBy("root").agg(F.ceil(F.sum("n") / block_tokens).cast("int").alias("blocks"))
    sets = _member_sets(chunks, clusters, width)
    members = settled(sets.join(clusters, ["chunk", "at"]).join(weights, "root").select(
        "root", "node", "chunk", "at", "blocks", "values"))
    small = members.filter("blocks = 1").select(F.xxhash64("root").alias("task"), F.lit(True).alias("stored"), F.lit(True).alias("asking"),
                                                F.lit(None).cast("long").alias("known"), "chunk", "at", "values")
    links = settled(_joined(small, percent).unionByName(_large(members.filter("blocks > 1"), percent)))
    reach = components(links)
    least = reach.join(classes, "node").groupBy("root").agg(F.min("doc").alias("least"))
    final = classes.join(reach.join(least, "root").select("node", "least"), "node", "left").select(
        "class", "n", F.coalesce("least", "doc").alias("component_id"))
    return rows.join(final, ["class", "n"], "left").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"))
