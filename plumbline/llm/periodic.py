"""Runs: maximal periodic stretches of words, by suffix trees.

A run of smallest period q is found from a Lyndon root of it: the longest Lyndon word that starts at some position, for the
order of the words or the opposite one, is a root of every run (each run has such a position). In a Ukkonen suffix tree of
the words, leaves in lexicographic order rank the suffixes; the longest Lyndon word at i ends before the next suffix of
smaller (opposite order: greater) rank. Two positions' longest common extension is the string depth of their lowest common
ancestor, a range minimum over the tree's Euler tour in constant time; a second tree, of the reversal, extends to the left.
So each of the 2 n candidates (i, end of its Lyndon word) is extended in both directions by two look-ups.

Trees are built only where a run can be. A run of length L >= max(least, times * q) repeats at distance q each of its grams
of ``width`` words but those of the last q, so it lies inside the union of [i, i + d + width) over places i whose gram comes
again d words later, with times * d at most the length of that stretch. Everything outside is proven free of runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Buffer, mix, sequence_hashes, slices, texts_of, words_of

LEAST, TIMES = 24, 3
BLOCK = 16                 # tour entries per block of the range minimum
TEXT_BYTES = 2 << 20       # text whose words a task holds as arrays at once (a longer document alone)


class SuffixTree:
    """Ukkonen's tree of a word sequence, closed by an end that is smaller than every word."""

    def __init__(self, words: np.ndarray):
        """``words``: numbers from 1 on; equal words have equal numbers."""
        self.n = len(words)
        text = words.tolist() + [0]
        total, step = len(text), int(words.max(initial=0)) + 1
        start, end, link, parent = [0], [0], [0], [-1]
        to: dict[int, int] = {}            # node * step + first word of the edge -> child
        active = edge = length = pending = 0
        for i, word in enumerate(text):
            pending += 1
            fresh = 0                      # inner node of this phase that still lacks its suffix link
            while pending:
                if length == 0:
                    edge = i
                key = active * step + text[edge]
                child = to.get(key)
                if child is None:
                    to[key] = len(start)
                    start.append(i), end.append(total), link.append(0), parent.append(active)
                    if fresh:
                        link[fresh] = active
                        fresh = 0
                else:
                    at = start[child]
                    span = (end[child] if end[child] <= i else i + 1) - at
                    if length >= span:
                        active, edge, length = child, edge + span, length - span
                        continue
                    if text[at + length] == word:
                        length += 1
                        if fresh:
                            link[fresh] = active
                        break
                    inner = len(start)
                    to[key] = inner
                    start.append(at), end.append(at + length), link.append(0), parent.append(active)
                    to[inner * step + word] = inner + 1
                    start.append(i), end.append(total), link.append(0), parent.append(inner)
                    start[child], parent[child] = at + length, inner
                    to[inner * step + text[at + length]] = child
                    if fresh:
                        link[fresh] = inner
                    fresh = inner
                pending -= 1
                if active == 0 and length:
                    length -= 1
                    edge = i - pending + 1
                elif active:
                    active = link[active]
        self._tour(np.append(words, 0), np.array(start), np.array(end), np.array(parent))

    def _tour(self, text: np.ndarray, start: np.ndarray, end: np.ndarray, parent: np.ndarray) -> None:
        """Euler tour in lexicographic order: string depths, where each suffix's leaf stands, and the suffixes' ranks."""
        nodes = len(start)
        order = np.lexsort((text[start], parent))[1:]              # children by parent and first word, without the root
        first = np.searchsorted(parent[order], np.arange(nodes + 1)).tolist()
        children, size = order.tolist(), (end - start).tolist()
        tour: list[int] = []
        leaf = [0] * (self.n + 1)
        ranked: list[int] = []
        depth = [0] * nodes
        stack = [0]
        while stack:
            v = stack.pop()
            if v < 0:
                tour.append(depth[~v])
                continue
            d = depth[v]
            a, b = first[v], first[v + 1]
            if a == b:
                suffix = self.n + 1 - d
                leaf[suffix] = len(tour)
                ranked.append(suffix)
            tour.append(d)
            for k in range(b - 1, a - 1, -1):
                c = children[k]
                depth[c] = d + size[c]
                stack.append(~v)
                stack.append(c)
        self.leaf = np.array(leaf)
        self.rank = np.empty(self.n + 1, np.int64)
        self.rank[ranked] = np.arange(self.n + 1)
        blocks = -(-len(tour) // BLOCK)
        rows = np.full(blocks * BLOCK, np.iinfo(np.int32).max, np.int32)
        rows[:len(tour)] = tour
        self.flat, rows = rows, rows.reshape(blocks, BLOCK)
        self.ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
        self.behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        self.levels = [rows.min(axis=1)]
        while 2 ** len(self.levels) <= blocks:
            low = self.levels[-1]
            half = 2 ** (len(self.levels) - 1)
            self.levels.append(np.minimum(low[:-half], low[half:]))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at i and at j (different positions, the end included)."""
        a, b = self.leaf[i], self.leaf[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        out = np.minimum(self.behind[a], self.ahead[b])
        left, right = a // BLOCK + 1, b // BLOCK                     # whole blocks between the two
        count = right - left
        wide = np.flatnonzero(count > 0)
        level = np.frexp(count[wide])[1] - 1
        for at in np.unique(level):
            mine = wide[level == at]
            row = self.levels[at]
            out[mine] = np.minimum(out[mine], np.minimum(row[left[mine]], row[right[mine] - 2 ** at]))
        same = np.flatnonzero(count < 0)
        if len(same):
            at = a[same, None] + np.arange(BLOCK)
            inside = np.where(at <= b[same, None], self.flat[np.minimum(at, len(self.flat) - 1)], np.iinfo(np.int32).max)
            out[same] = inside.min(axis=1)
        return out.astype(np.int64)


def _next_smaller_and_greater(rank: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each place the next one of smaller and of greater value; the length where there is none."""
    n = len(rank)
    smaller, greater = [n] * n, [n] * n
    low: list[int] = []
    high: list[int] = []
    for i in range(n - 1, -1, -1):
        r = rank[i]
        while low and rank[low[-1]] > r:
            low.pop()
        if low:
            smaller[i] = low[-1]
        low.append(i)
        while high and rank[high[-1]] < r:
            high.pop()
        if high:
            greater[i] = high[-1]
        high.append(i)
    return np.array(smaller, np.int64), np.array(greater, np.int64)


def runs_of(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Runs [start, length, period] of a sequence of word numbers (from 1 on), by start, then period.

    Smallest period q, length at least ``least`` and ``times`` * q (``times`` is at least 2), not extendable either way.
    """
    n = len(words)
    if n < max(least, times):
        return np.zeros((0, 3), np.int64)
    tree, mirror = SuffixTree(words), SuffixTree(words[::-1])
    smaller, greater = _next_smaller_and_greater(tree.rank.tolist())
    i = np.concatenate((np.arange(n), np.flatnonzero(greater[:n] < n)))
    j = np.concatenate((smaller[:n], greater[:n][greater[:n] < n]))
    near = (j - i) * times <= n
    i, j = i[near], j[near]
    right = tree.common(i, j)
    left = np.zeros(len(i), np.int64)
    inner = i > 0
    left[inner] = mirror.common(n - i[inner], n - j[inner])          # words before i and before j
    period = j - i
    length = left + period + right
    keep = (length >= least) & (length >= times * period)
    return np.unique(np.stack((i - left, length, period), axis=1)[keep], axis=0)[:, [0, 1, 2]] if keep.any() \
        else np.zeros((0, 3), np.int64)


def gram_width(least: int, times: int) -> int:
    """Words of the longest gram that every run repeats at the distance of its period."""
    short = least // times
    return max(1, min(least - short, (times - 1) * (short + 1)))


def stretches(hashes: np.ndarray, first: np.ndarray, least: int, times: int) -> np.ndarray:
    """[document, start, end) in words of all parts of documents that may hold a run (see the module's docstring)."""
    width = gram_width(least, times)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    grams = sequence_hashes(hashes, width)
    at = np.flatnonzero(owner[:len(grams)] == owner[width - 1:]) if len(grams) else np.zeros(0, np.int64)
    key = mix(grams[at] ^ mix(owner[at].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    again = key[order][1:] == key[order][:-1]
    place, later = at[order[:-1][again]], at[order[1:][again]]
    rank = np.argsort(place)
    place, later = place[rank], later[rank]
    size = np.diff(first)[owner[place]]
    while len(place):
        keep = (later - place) * times <= size
        place, later = place[keep], later[keep]
        if not len(place):
            break
        reach = np.maximum.accumulate(later + width)                 # documents ascend, and no gram leaves its own
        head = np.ones(len(place), bool)
        head[1:] = place[1:] >= reach[:-1]
        part = np.cumsum(head) - 1
        starts = place[head]
        ends = reach[np.append(np.flatnonzero(head)[1:] - 1, len(place) - 1)]
        size = (ends - starts)[part]
        if (keep.all() and ((later - place) * times <= size).all()):
            long = ends - starts >= least
            return np.stack((owner[starts], starts, ends), axis=1)[long]
    return np.zeros((0, 3), np.int64)


def runs_in(texts: list[bytes], least: int = LEAST, times: int = TIMES) -> tuple[list[np.ndarray], list[bytes]]:
    """Per text its runs [start, length, period] in words, and the words that stay, joined by one space."""
    buffer = Buffer.of(texts)
    words = words_of(buffer, lower=False)
    found: list[list[np.ndarray]] = [[] for _ in texts]
    dropped = np.zeros(len(words.starts) + 1, np.int64)
    data = buffer.data
    for doc, a, b in stretches(words.hashes, words.first, least, times).tolist():
        known: dict[bytes, int] = {}
        part = data[words.starts[a]:words.ends[b - 1]].tobytes()
        offset = words.starts[a]
        numbers = np.array([known.setdefault(part[s:e], len(known) + 1) for s, e in
                            zip((words.starts[a:b] - offset).tolist(), (words.ends[a:b] - offset).tolist(), strict=True)])
        runs = runs_of(numbers, least, times)
        if len(runs):
            np.add.at(dropped, a + runs[:, 0] + runs[:, 2], 1)
            np.add.at(dropped, a + runs[:, 0] + runs[:, 1], -1)
            runs[:, 0] += a - words.first[doc]
            found[doc].append(runs)
    stays = np.cumsum(dropped[:-1]) == 0
    # a byte stays if its word does; the byte after a word becomes the space before the next one
    out, change = data.copy(), np.zeros(len(data) + 1, np.int8)
    change[words.starts[stays]] += 1
    change[words.ends[stays] + 1] -= 1
    keep = np.cumsum(change[:-1], dtype=np.int8) > 0
    out[words.ends[stays]] = 0x20
    doc_of = np.repeat(np.arange(len(texts)), np.diff(words.first))[stays]
    last = np.ones(len(doc_of), bool)
    last[:-1] = doc_of[1:] != doc_of[:-1]
    keep[words.ends[stays][last]] = False
    cut = np.concatenate(([0], np.cumsum(keep)))
    ends = buffer.starts + buffer.lengths
    flat = out[keep].tobytes()
    kept = [flat[cut[a]:cut[b]] for a, b in zip(buffer.starts.tolist(), ends.tolist(), strict=True)]
    return [np.concatenate(f) if f else np.zeros((0, 3), np.int64) for f in found], kept


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: int = LEAST,
                  times: int = TIMES) -> DataFrame:
    """Per row: its id as ``doc_id``, ``runs`` array<struct<start, length, period>> by start, then period, and ``collapsed``,
    the text without the words that a run holds after its first period.

    A null or empty text, or one of white space, has no runs and an empty ``collapsed``. Each row is judged on its own, so
    repeated rows, ties and null ids change nothing; an empty table gives no rows; other columns are ignored whatever their
    names. A text of any length is one piece of one task: arrays of its words, and trees over the stretches that may hold
    a run (some 500 bytes a word there).
    """
    source = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_BYTES):
            found, kept = runs_in(texts_of(batch.column("text")), least, times)
            flat = np.concatenate(found)
            cells = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(run_type))
            offsets = np.cumsum([0] + [len(f) for f in found]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.ListArray.from_arrays(pa.array(offsets), cells),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])

    return source.mapInArrow(
        run, f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run of greatest length / period, compared exactly; of ties the smallest start, then period. Null without runs."""
    return F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, 0), lambda best, r: F.when(
        r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def periodic_tails(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, text, with the words of every tenth document periodic from some word on, as crc32 of the id decides.

    With h that checksum, g = floor(h / 10) and n words: where h mod 10 is 0 and n > 0, words from a = g mod n on repeat with
    the period 1 + floor((n - a) / (3 + g mod 8)). A null id has no checksum and keeps its text.
    """
    h = F.crc32(F.col(id_column).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    some = docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").alias("text"),
                       F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    n = F.size("w")
    a = (F.col("g") % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("g") % 8))).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", a + 1, p), F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    return some.select("doc_id", F.when(F.col("w").isNotNull() & (n > 0), F.array_join(F.concat(F.slice("w", F.lit(1), a), tail), " "))
                       .otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run's numbers, and hashes of all runs and of the collapsed text."""
    best = found.withColumn("best", strongest(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
