"""Language-model scoring by deleted interpolation.

Tokens are words (lower-cased over A-Z) and one end per text. Maximum-likelihood estimates of orders 1 to ``ORDER`` and a
uniform one over V + 1 tokens are mixed; the weights depend on the bucket that the frequency of the longest context falls
into (powers of two). They are learned by expectation-maximisation on held-out counts: training texts of one remainder are
deleted from the counts, the rest predicts them, and EM runs per bucket over a table of how often each combination of
component probabilities occurs (in steps of 1/8 octave). The table stays on the cluster: with order 3 it has millions of
rows, each round is one pass over it, and only the rounds' sums, a number per bucket and component, reach the driver.
Scores use the counts of all training texts.

Counts never leave the cluster as a whole. A chunk of texts asks for its distinct n-grams, one row per key range; the task
of a range adds up what all chunks hold and answers each chunk's question; a chunk's answers meet its texts again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import (Buffer, clip_range, gaps, groups, mix, pack, pack_documents, power_of_two, release_memory, settled,
                                  sequence_hashes, total_bytes, undo_gaps, unpack, unpack_documents, whole_groups, words_of)

ORDER = 2
HELD_OUT, DELETED, KEPT = 0, 1, 2
START, END = np.uint64(0x5374617274), np.uint64(0x456E64)
KEY_BITS = ~np.uint64(0xFF)             # 56-bit keys
RANGE_KEYS = 2 << 20                    # n-grams that a range's task is meant to hold
LEAST_RANGES = 64
BUCKETS = 24
STEP = 8                                # component probabilities per octave in the EM table
LEVELS = 512
ROUNDS = 60
WORD_BYTES = 1 << 20                    # text whose words are hashed at once
TOKENS_AT_ONCE = 1 << 18                # tokens whose components a task holds at once
EM_CELLS = 1 << 17                      # cells that a task turns into arrays at once


def role(id_column: str) -> Column:
    """HELD_OUT where crc32 of the id as text is 0 modulo 10, DELETED where it is 1, KEPT elsewhere and for a null id."""
    rest = F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(10))
    return F.when(rest == 0, HELD_OUT).when(rest == 1, DELETED).otherwise(KEPT).cast("int")


def _words(buffer: Buffer) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and how many words each text has. A few texts are hashed at once, as that takes
    tens of bytes a character; a hash does not depend on the place of its word."""
    ends = buffer.starts + buffer.lengths + 1
    hashes, counts, a = [], [], 0
    while a < len(ends):
        at = buffer.starts[a]
        b = max(a + 1, int(np.searchsorted(ends, at + WORD_BYTES, side="right")))
        words = words_of(Buffer(buffer.data[at:ends[b - 1]], buffer.starts[a:b] - at, buffer.lengths[a:b]))
        hashes.append(words.hashes)
        counts.append(np.diff(words.first))
        a = b
    return np.concatenate(hashes), np.concatenate(counts)


class Grams:
    """The tokens of some texts and, per order, the key of the n-gram that ends at each token."""

    def __init__(self, buffer: Buffer, order: int):
        hashes, n = _words(buffer)
        texts, pads = len(n), order - 1
        self.first = np.zeros(texts + 1, np.int64)              # first token of each text
        np.cumsum(n + 1, out=self.first[1:])
        stride = np.arange(texts) * (pads + 1)
        line = np.full(len(hashes) + texts * (pads + 1), START, np.uint64)
        owner = np.repeat(np.arange(texts), n)
        line[np.arange(len(hashes)) + stride[owner] + pads] = hashes
        line[np.cumsum(n) + stride + pads] = END
        where = np.arange(self.first[-1]) + np.repeat((np.arange(texts) + 1) * pads, n + 1)
        self.keys = [mix(sequence_hashes(line, k)[where - k + 1] + np.uint64(k)) & KEY_BITS for k in range(1, order + 1)]
        #: token before each token, or the text's end where there is none: starts are as many as ends
        before = np.arange(self.first[-1]) - 1
        before[self.first[:-1]] = self.first[1:] - 1
        self.before = before
        self.starts = np.zeros(self.first[-1], bool)
        self.starts[self.first[:-1]] = True


def _questions(chunks: DataFrame, order: int, bits: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for chunk, role_, blob in zip(*(batch.column(c).to_pylist() for c in ("chunk", "role", "blob")), strict=True):
                grams = Grams(unpack_documents(blob)[1], order)
                rows: dict[int, dict] = {}
                for k, values in enumerate(grams.keys):
                    unique, count = np.unique(values, return_counts=True)
                    for at, part in clip_range(unique, bits):
                        rows.setdefault(at, {}).update({f"k{k}": gaps(unique[part]), f"c{k}": count[part].astype(np.uint32)})
                del grams
                for at, arrays in rows.items():
                    yield pa.RecordBatch.from_pylist([{"range": at, "chunk": chunk, "role": role_, "blob": pack(**arrays)}],
                                                     schema)
                del rows
        release_memory()

    schema = pa.schema([("range", pa.int64()), ("chunk", pa.int64()), ("role", pa.int32()), ("blob", pa.binary())])
    return chunks.mapInArrow(run, "range long, chunk long, role int, blob binary")


def _answers(questions: DataFrame, order: int) -> DataFrame:
    """Per question the kept and deleted counts of its n-grams; and a row of totals per range, with a null chunk."""
    def run(batches):
        for group in groups(batches, "range"):
            rows = list(zip(*(group.column(c).to_pylist() for c in ("range", "chunk", "role", "blob")), strict=True))
            asked = [unpack(r[3]) for r in rows]
            replies: list[dict] = [{} for _ in rows]
            totals = {"tokens": 0, "kept": 0, "distinct": 0}
            for k in range(order):
                held = [undo_gaps(a[f"k{k}"]) if f"k{k}" in a else np.zeros(0, np.uint64) for a in asked]
                count = [a.get(f"c{k}", np.zeros(0)) for a in asked]
                unique, at = np.unique(np.concatenate(held), return_inverse=True)
                cut = np.cumsum([0] + [len(h) for h in held])
                kept, gone = np.zeros(len(unique)), np.zeros(len(unique))
                for i, r in enumerate(rows):
                    if r[2] != HELD_OUT:
                        (kept if r[2] == KEPT else gone)[at[cut[i]:cut[i + 1]]] += count[i]
                for i in range(len(rows)):
                    mine = at[cut[i]:cut[i + 1]]
                    replies[i].update({f"k{k}": kept[mine].astype(np.uint32), f"d{k}": gone[mine].astype(np.uint32)})
                if k == 0:
                    totals = {"tokens": int(kept.sum() + gone.sum()), "kept": int(kept.sum()),
                              "distinct": int(((kept + gone) > 0).sum())}
            yield pa.RecordBatch.from_pylist([{"chunk": None, "role": None, "range": rows[0][0], "blob": None, **totals}], schema)
            del asked
            for r, reply in zip(rows, replies, strict=True):
                yield pa.RecordBatch.from_pylist([{"chunk": r[1], "role": r[2], "range": r[0], "blob": pack(**reply)}], schema)
            del rows, replies, held, count, unique, at, kept, gone
        release_memory()

    schema = pa.schema([("chunk", pa.int64()), ("role", pa.int32()), ("range", pa.int64()), ("blob", pa.binary()),
                        ("tokens", pa.int64()), ("kept", pa.int64()), ("distinct", pa.int64())])
    return whole_groups(questions, "range", "chunk").mapInArrow(
        run, "chunk long, role int, range long, blob binary, tokens long, kept long, distinct long")


def _with_answers(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """Chunks and their answers together: the chunk's row first (range -1), then its ranges in order."""
    both = chunks.select("chunk", "role", F.lit(-1).cast("long").alias("range"), "blob").unionByName(
        answers.filter("chunk is not null").select("chunk", "role", "range", "blob"))
    return whole_groups(both, "chunk", "range")


def _counts(group: pa.Table, order: int) -> tuple[int, list, Grams, list[tuple[np.ndarray, np.ndarray]]]:
    """Role, ids, tokens, and per order the kept and deleted counts of the n-gram at each token."""
    blobs = group.column("blob").to_pylist()
    ids, buffer = unpack_documents(blobs[0])
    grams = Grams(buffer, order)
    replies = [unpack(b) for b in blobs[1:]]
    out = []
    for k, values in enumerate(grams.keys):
        unique, at = np.unique(values, return_inverse=True)
        parts = [np.concatenate([r[f"{kind}{k}"] for r in replies if f"{kind}{k}" in r] or [np.zeros(0, np.uint32)])
                 for kind in "kd"]
        if len(parts[0]) != len(unique):
            raise ValueError("a chunk's answers do not cover its n-grams")
        out.append((parts[0][at], parts[1][at]))
    return group.column("role")[0].as_py(), ids, grams, out


def _some_tokens(grams: Grams, most: int) -> Iterator[tuple[slice, slice]]:
    """Texts, so many at once that they have at most ``most`` tokens (a longer one alone), and their tokens."""
    a = 0
    while a < len(grams.first) - 1:
        b = max(a + 1, int(np.searchsorted(grams.first, grams.first[a] + most, side="right")) - 1)
        yield slice(a, b), slice(int(grams.first[a]), int(grams.first[b]))
        a = b


def _components(grams: Grams, counts: list[np.ndarray], tokens: float, distinct: int, part: slice) -> tuple[np.ndarray, np.ndarray]:
    """Context bucket of each token of ``part``, and its probabilities [orders from long to short, then uniform; tokens].

    A text's tokens are in one part; ``counts`` are those of the part's tokens."""
    order = len(counts)
    before, starts = grams.before[part] - part.start, grams.starts[part]
    rows, context = [], np.full(len(before), tokens)
    for k in range(order - 1, 0, -1):
        seen = counts[k - 1][before]
        # at a text's start every context is that of the start itself, which occurs once per text, as the end does
        seen = np.where(starts, counts[0][before], seen)
        rows.append(np.divide(counts[k], seen, out=np.zeros(len(seen)), where=seen > 0))
        if k == order - 1:
            context = seen
    rows.append(counts[0] / max(tokens, 1))
    rows.append(np.full(len(before), 1 / (distinct + 1)))
    bucket = np.minimum(np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))) + 1, 0), BUCKETS - 1).astype(np.int64)
    return bucket, np.minimum(np.stack(rows), 1.0)


def _em_table(joined: DataFrame, order: int, tokens: float, distinct: int) -> DataFrame:
    def run(batches):
        for group in groups(batches, "chunk"):
            _, _, grams, counts = _counts(group, order)
            cells = []
            for _, part in _some_tokens(grams, TOKENS_AT_ONCE):
                cell, p = _components(grams, [c[0][part].astype(np.float64) for c in counts], tokens, distinct, part)
                for row in p[:-1]:
                    level = np.where(row > 0, np.clip(np.rint(-STEP * np.log2(np.maximum(row, 1e-300))), 0, LEVELS - 2), LEVELS - 1)
                    cell = cell * LEVELS + level.astype(np.int64)
                cells.append(cell)
            values, n = np.unique(np.concatenate(cells), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n)], names=["cell", "n"])
            del grams, counts, cells, values, n
        release_memory()

    return joined.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def expected_counts(cells: np.ndarray, n: np.ndarray, weights: np.ndarray, order: int, distinct: int) -> np.ndarray:
    """How many of the held-out tokens each component is expected to have made, per bucket: [BUCKETS, order + 1]."""
    rest, rows = cells, [np.full(len(cells), 1 / (distinct + 1))]
    steps = np.append(2.0 ** (-np.arange(LEVELS - 1) / STEP), 0.0)
    for _ in range(order):
        rows.insert(0, steps[rest % LEVELS])
        rest = rest // LEVELS
    share = weights[rest].T * np.stack(rows)
    share *= n / share.sum(axis=0)
    return np.stack([np.bincount(rest, row, BUCKETS) for row in share], axis=1)


def learn_weights(expected: Callable[[np.ndarray], np.ndarray], order: int) -> np.ndarray:
    """Mixture weights [BUCKETS, order + 1] by EM, from a uniform start; ``expected`` gives a round's expected counts.

    A bucket without held-out tokens takes its lower neighbour's weights; without any held-out token all weights are equal.
    """
    weights = np.full((BUCKETS, order + 1), 1 / (order + 1))
    known = np.zeros(BUCKETS, bool)
    for _ in range(ROUNDS):
        counts = expected(weights)
        known = counts.sum(axis=1) > 0
        if not known.any():
            return weights
        counts = counts[known] + 1e-3
        weights[known] = counts / counts.sum(axis=1, keepdims=True)
    for bucket in range(1, BUCKETS):
        if not known[bucket] and known[:bucket].any():
            weights[bucket] = weights[bucket - 1]
    return weights


def _expected_on_cluster(table: DataFrame, order: int, distinct: int) -> Callable[[np.ndarray], np.ndarray]:
    """A round's expected counts as one job over the settled table: BUCKETS * (order + 1) numbers come back per task."""
    def expected(weights: np.ndarray) -> np.ndarray:
        def run(batches):
            total = np.zeros((BUCKETS, order + 1))
            for batch in batches:
                cells, n = (np.asarray(batch.column(c), np.int64) for c in ("cell", "n"))
                for i in range(0, len(cells), EM_CELLS):
                    total += expected_counts(cells[i:i + EM_CELLS], n[i:i + EM_CELLS], weights, order, distinct)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.reshape(-1)[at])], names=["at", "count"])

        total = np.zeros(BUCKETS * (order + 1))
        for at, count in table.mapInArrow(run, "at long, count double").groupBy("at").agg(F.sum("count")).collect():
            total[at] = count
        return total.reshape(BUCKETS, order + 1)

    return expected


def scored(docs: DataFrame, id_column: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    A null text is an empty one: its only token is the end. A null id is a training row. Repeated rows count and are scored
    each on their own. An empty table gives no rows; without training texts the model is uniform. Extra columns are ignored.
    """
    marked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                         role(id_column).alias("role"))
    chunks = pack_documents(marked, "doc_id", "text", "role")
    ranges = power_of_two(total_bytes(chunks) * order / 8 / RANGE_KEYS, LEAST_RANGES)
    answers = settled(_answers(_questions(chunks, order, ranges.bit_length() - 1), order))
    total = answers.filter("chunk is null").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c)
                                                  for c in ("tokens", "kept", "distinct")]).head()
    tokens, kept, distinct = total.tokens, total.kept, total.distinct
    deleted = _with_answers(chunks.filter(F.col("role") == DELETED), answers.filter(F.col("role") == DELETED))
    table = settled(_em_table(deleted, order, float(kept), distinct))
    weights = learn_weights(_expected_on_cluster(table, order, distinct), order)

    def run(batches):
        for group in groups(batches, "chunk"):
            role_, ids, grams, counts = _counts(group, order)
            for texts, part in _some_tokens(grams, TOKENS_AT_ONCE):
                every = [c[0][part].astype(np.float64) + c[1][part] for c in counts]
                bucket, p = _components(grams, every, float(tokens), distinct, part)
                log = np.log10((weights[bucket].T * p).sum(axis=0))
                base = np.log10((every[0] + 0.1) / (tokens + 0.1 * (distinct + 1)))
                first = grams.first[texts] - part.start
                n = np.diff(first, append=part.stop - part.start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[texts], pa.int64()), pa.array(np.full(len(n), role_ == HELD_OUT)), pa.array(n),
                     pa.array(np.add.reduceat((every[0] > 0).astype(np.int64), first)), pa.array(np.full(len(n), tokens, np.int64)),
                     pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(log, first))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
            del ids, grams, counts
        release_memory()

    return _with_answers(chunks, answers).mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
