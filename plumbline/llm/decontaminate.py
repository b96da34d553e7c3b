"""Benchmark decontamination: CGK embedding, repeated bit-sampling LSH over item-sized windows, exact edit verification.

Texts and items are sequences of words (runs of letters and digits, lower-cased over A-Z). An item of L words is found where
a stretch of a text is within floor((1 - ``SIMILARITY``) * L) word edits of it.

* The CGK random walk copies the word under its pointer to the output and moves on, or stays, by a random bit of (step,
  word). Edit distance becomes Hamming distance: after an edit the walks of both sequences soon meet again.
* ``SAMPLED`` output positions form one LSH key. Walk and positions are drawn anew ``repetitions`` times; the number is
  chosen so that items at the edit limit, simulated on the longest ones, share a key with probability ``RECALL``.
* Windows are all stretches of L words that can match at all: by the q-gram lemma a match within d edits shares at least
  L - q + 1 - q d of the item's word q-grams, and windows with fewer pairs or triples of any item are skipped without loss.
* Windows whose key equals an item's are verified by the exact edit distance of the item to any stretch around them.

The items are the stated query set: they go to the tasks in blocks of at most ``BLOCK_BYTES`` of text, one pass per block.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import LOWER, Buffer, mix, prefix_sums, sequence_hashes, slices, span_hashes, texts_of
from plumbline.llm.toxicity import LETTER

SIMILARITY = 0.8
RECALL = 0.995
SAMPLED = 3
TRIALS = 200                # simulated matches from which the repetitions are chosen
MOST_REPETITIONS = 64
BLOCK_BYTES = 16 << 20
GRAMS = (2, 3)               # word q-grams of the filters
FILTER_BITS = 20
STEPS = 2                   # output positions per word of an item


@dataclass
class Sequence:
    """The words of some texts."""

    hashes: np.ndarray
    starts: np.ndarray          # byte offsets in the buffer
    ends: np.ndarray
    first: np.ndarray           # first word of each text, and the end
    base: np.ndarray            # where each text begins in the buffer


def sequence(texts: list[bytes]) -> Sequence:
    buffer = Buffer.of(texts)
    data = LOWER[buffer.data]
    inside = LETTER[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    return Sequence(span_hashes(prefix_sums(data), starts, ends), starts, ends,
                    np.append(np.searchsorted(starts, buffer.starts), len(starts)), buffer.starts)


def allowed(length: int, similarity: float = SIMILARITY) -> int:
    return int((1 - similarity) * length + 1e-9)


def sampled_steps(length: int, repetition: int) -> list[int]:
    steps = STEPS * length
    return sorted(np.random.default_rng([repetition, length]).choice(steps, min(SAMPLED, steps), replace=False).tolist())


def keys(hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, repetition: int) -> np.ndarray:
    """LSH keys for one repetition of the windows of ``lengths`` words at ``starts``; windows of all lengths walk together."""
    kinds, kind = np.unique(lengths, return_inverse=True)
    sampled = np.zeros((len(kinds), STEPS * int(kinds[-1]) + 1 if len(kinds) else 1), bool)
    for i, length in enumerate(kinds.tolist()):
        sampled[i, sampled_steps(length, repetition)] = True
    last = sampled.shape[1] - 1 - np.argmax(sampled[:, ::-1], axis=1)
    out = mix(lengths.astype(np.uint64) + np.uint64(repetition * 65_537))
    live, at = np.argsort(-last[kind], kind="stable"), np.zeros(len(starts), np.int64)
    ends = -last[kind][live]                                # ascending, so the windows still walking are a prefix
    for step in range(int(last.max()) + 1 if len(kinds) else 0):
        live = live[:np.searchsorted(ends, -step, "right")]
        length, place = lengths[live], at[live]
        word = hashes[starts[live] + np.minimum(place, length - 1)]
        word[place >= length] = 0
        take = sampled[kind[live], step]
        chosen = live[take]
        out[chosen] = mix(out[chosen] * np.uint64(0x9E3779B97F4A7C15) + word[take])
        bit = (word + np.uint64(repetition * 1_000_003 + step * 2 + 1)) * np.uint64(0xD1342543DE82EF95)
        at[live] = place + ((bit ^ (bit << np.uint64(29))) >> np.uint64(63)).astype(np.int64)
    return out


def nearest(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the stretch of ``text`` nearest to ``item``; of equals the one that ends first."""
    n = len(text)
    row, origin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    place = np.arange(n + 1)
    for i, word in enumerate(item):
        up, diagonal = row + 1, np.concatenate(([i + 1], row[:-1] + (text != word)))
        take = diagonal <= up
        take[0] = False
        best = np.where(take, diagonal, up)
        best[0] = i + 1
        source = np.where(take, np.concatenate(([0], origin[:-1])), origin)
        reach = np.minimum.accumulate(best - place)          # insertions: best[k] + (j - k) for some k <= j
        lead = np.maximum.accumulate(np.where(best - place == reach, place, 0))
        row, origin = reach + place, source[lead]
    end = int(np.argmin(row))
    return int(row[end]), int(origin[end]), end


@dataclass
class Benchmark:
    """A block of items, prepared for the search."""

    ids: list
    words: list[np.ndarray]
    similarity: float = SIMILARITY
    repetitions: int = 0
    grams: dict = field(default_factory=dict)               # q -> hashes of the items' word q-grams, ascending
    filters: dict = field(default_factory=dict)             # q -> which leading bits occur among them
    often: np.ndarray = field(default_factory=lambda: np.zeros(1, bool))    # by 1 + pair: some item holds it repeatedly
    of_length: dict = field(default_factory=dict)           # item length -> by 1 + pair: an item of this length holds it
    lengths: list[int] = field(default_factory=list)
    tables: list = field(default_factory=list)              # per repetition ({key: [item, ...]}, keys)

    @classmethod
    def of(cls, ids: list, texts: list[bytes], similarity: float = SIMILARITY, recall: float = RECALL) -> Benchmark:
        s = sequence(texts)
        words = [s.hashes[a:b] for a, b in zip(s.first[:-1], s.first[1:], strict=True)]
        known = [i for i, w in enumerate(words) if len(w)]
        self = cls([ids[i] for i in known], [words[i] for i in known], similarity)
        if not self.words:
            return self
        for q in GRAMS:
            self.grams[q] = np.unique(np.concatenate([sequence_hashes(w, q) for w in self.words]))
            self.filters[q] = np.zeros(1 << FILTER_BITS, bool)
            self.filters[q][(self.grams[q] >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        own = [np.unique(sequence_hashes(w, GRAMS[0]), return_counts=True) for w in self.words]
        self.often = np.zeros(len(self.grams[GRAMS[0]]) + 1, bool)
        for w, (values, count) in zip(self.words, own, strict=True):
            self.of_length.setdefault(len(w), np.zeros(len(self.often), bool))[
                1 + np.searchsorted(self.grams[GRAMS[0]], values)] = True
            self.often[1 + np.searchsorted(self.grams[GRAMS[0]], values[count > 1])] = True
        self.repetitions = self._repetitions(recall)
        flat, lengths = np.concatenate(self.words), np.array([len(w) for w in self.words])
        self.lengths = np.unique(lengths).tolist()
        for repetition in range(self.repetitions):
            held = defaultdict(list)
            for i, key in enumerate(keys(flat, np.cumsum(lengths) - lengths, lengths, repetition).tolist()):
                held[key].append(i)
            self.tables.append((dict(held), np.array(sorted(held), np.uint64)))
        return self

    def _repetitions(self, recall: float) -> int:
        """How many repetitions find items with as many edits as are allowed, each among other words, with ``recall``."""
        r = np.random.default_rng(3)
        # long items are the hardest: they are allowed the most edits before the sampled positions
        longest = sorted(range(len(self.words)), key=lambda i: -len(self.words[i]))[:max(1, len(self.words) // 4)]
        trials = [self.words[i] for i in r.choice(longest, TRIALS)]
        items, texts, starts, lengths, owner, at = [], [], [], [], [], 0
        for t, w in enumerate(trials):
            d = allowed(len(w), self.similarity)
            text, noise = w.tolist(), r.integers(1, 2**63, 4 * d + 2, dtype=np.uint64).tolist()
            for k in range(d):
                place, kind = int(r.integers(len(text) + 1)), int(r.integers(3))
                if kind == 0:
                    text.insert(place, noise.pop())
                elif place < len(text):
                    text[place:place + 1] = [noise.pop()] if kind == 1 else []
            around = [*noise[:d], *text, *noise[d:2 * d], *noise[:d]]
            own = np.arange(at, at + max(1, min(2 * d + 1, len(around) - len(w) + 1)))
            items.append(w)
            texts.append(np.array(around, np.uint64))
            starts.append(own)
            lengths.append(np.full(len(own), len(w)))
            owner.append(np.full(len(own), t))
            at += len(around)
        flat, line = np.concatenate(items), np.concatenate([*texts, np.zeros(len(max(trials, key=len)), np.uint64)])
        sizes = np.array([len(w) for w in items])
        starts, lengths, owner = np.concatenate(starts), np.concatenate(lengths), np.concatenate(owner)
        found = np.zeros(TRIALS, bool)
        for repetition in range(MOST_REPETITIONS):
            own = keys(flat, np.cumsum(sizes) - sizes, sizes, repetition)
            np.logical_or.at(found, owner, keys(line, starts, lengths, repetition) == own[owner])
            if repetition >= 3 and found.mean() >= recall:
                return repetition + 1
        return MOST_REPETITIONS

    def matches(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, start byte, end byte, edits) of every stretch that matches an item."""
        if not self.words:
            return []
        s = sequence(texts)
        n = len(s.hashes)
        if not n:
            return []
        shared = {q: self._shared(s.hashes, q) for q in GRAMS}
        ids = self._ids(s.hashes)
        found = []
        for lengths in self._classes():
            span = max(self._span(length) for length in lengths)
            here = np.arange(n)
            for q in GRAMS:
                need = min(self._need(length, q) for length in lengths)
                if need > 0:
                    here = here[shared[q][np.minimum(here + span, n)] - shared[q][here] >= need]
            if not len(here):
                continue
            text = np.searchsorted(s.first, here, "right") - 1
            floor, last = s.first[text], s.first[text + 1]
            for length in lengths:
                own = here + length - allowed(length, self.similarity) <= last
                reach = np.minimum(here + self._span(length), last)
                for q in GRAMS:
                    own &= shared[q][reach] - shared[q][here] >= max(0, self._need(length, q))
                start = here[own]
                enough = self._distinct(ids, start, length) >= self._need(length, GRAMS[0])
                if not enough.any():
                    continue
                # the windows around may share a key where this one does not; those beyond their text's end are shifted back
                near = np.arange(-allowed(length, self.similarity), allowed(length, self.similarity) + 1)
                low, high = floor[own][enough][:, None], last[own][enough][:, None] - length
                begin = np.unique(np.maximum(np.minimum(start[enough][:, None] + near, high), low))
                found.append((begin, np.full(len(begin), length)))
        if not found:
            return []
        out = []
        for item, begins in self._collide(s.hashes, *(np.concatenate(x) for x in zip(*found, strict=True))).items():
            out.extend(self._verified(s, item, np.unique(begins)))
        return sorted(out)

    def _classes(self) -> list[list[int]]:
        """Lengths in runs that differ by a quarter at most, which share a first filter."""
        runs: list[list[int]] = []
        for length in self.lengths:
            if not runs or length > 1.25 * runs[-1][0]:
                runs.append([])
            runs[-1].append(length)
        return runs

    def _span(self, length: int) -> int:
        return length + allowed(length, self.similarity)

    def _need(self, length: int, q: int) -> int:
        """Word q-grams of an item that a match shares at least (q-gram lemma)."""
        return length - q + 1 - q * allowed(length, self.similarity)

    def _shared(self, hashes: np.ndarray, q: int) -> np.ndarray:
        """Entry i: how many q-grams before word i are an item's; q-grams across two texts count too, which only adds."""
        n, grams, known = len(hashes), sequence_hashes(hashes, q), self.grams[q]
        hit = np.zeros(n + 1, np.int32)
        if len(grams) and len(known):
            maybe = np.flatnonzero(self.filters[q][(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            at = np.minimum(np.searchsorted(known, grams[maybe]), len(known) - 1)
            hit[1 + maybe[known[at] == grams[maybe]]] = 1
        return np.cumsum(hit, dtype=np.int32)

    def _ids(self, hashes: np.ndarray) -> np.ndarray:
        """1 + number of the item pair at every word, 0 where there is none; padded by the longest window."""
        grams, known = sequence_hashes(hashes, GRAMS[0]), self.grams[GRAMS[0]]
        out = np.zeros(len(hashes) + max(map(self._span, self.lengths)), np.int32)
        if len(grams) and len(known):
            maybe = np.flatnonzero(self.filters[GRAMS[0]][(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            at = np.minimum(np.searchsorted(known, grams[maybe]), len(known) - 1)
            hit = known[at] == grams[maybe]
            out[maybe[hit]] = at[hit] + 1
        return out

    def _distinct(self, ids: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
        """Pairs of items of this length in each window; one that no item repeats counts once, as repeats alone are no match."""
        held = ids[begin[:, None] + np.arange(self._span(length))]
        held = np.sort(held * self.of_length[length][held], axis=1)
        again = held[:, 1:] == held[:, :-1]
        return (held[:, 0] > 0) + ((held[:, 1:] > 0) & (~again | self.often[held[:, 1:]])).sum(axis=1)

    def _collide(self, hashes: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> dict[int, list[int]]:
        """Per item the windows whose key in some repetition is the item's."""
        rolled = lengths.astype(np.uint64)
        for k in range(int(lengths.max(initial=0))):        # equal windows are looked up once
            on = lengths > k
            rolled[on] = mix(rolled[on] + hashes[begin[on] + k])
        _, one, same = np.unique(rolled, return_index=True, return_inverse=True)
        hit: dict[int, set[int]] = defaultdict(set)
        for repetition, (table, own) in enumerate(self.tables):
            got = keys(hashes, begin[one], lengths[one], repetition)
            for k in np.flatnonzero(np.isin(got, own)).tolist():
                for item in table[int(got[k])]:
                    hit[item].add(k)
        order = np.argsort(same, kind="stable")
        first = np.append(np.searchsorted(same[order], np.arange(len(one))), len(same))
        return {item: np.concatenate([begin[order[first[k]:first[k + 1]]] for k in sorted(windows)]).tolist()
                for item, windows in hit.items()}

    def _verified(self, s: Sequence, item: int, begins: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        word, length = self.words[item], len(self.words[item])
        d = allowed(length, self.similarity)
        text = np.searchsorted(s.first, begins, "right") - 1
        cut = np.flatnonzero((np.diff(begins) > length + 3 * d) | (np.diff(text) > 0)) + 1     # regions share no word
        out = []
        for part in np.split(np.arange(len(begins)), cut):
            t = int(text[part[0]])
            low = max(int(begins[part[0]]) - d, int(s.first[t]))
            high = min(int(begins[part[-1]]) + length + 2 * d, int(s.first[t + 1]))
            rests = [(low, high)]                           # other copies may stand on either side of a match
            while rests:
                low, high = rests.pop()
                if high - low < length - d or np.count_nonzero(np.isin(word, s.hashes[low:high])) < length - d:
                    continue                                # too few of its words occur at all
                edits, a, b = nearest(word, s.hashes[low:high])
                if edits > d or b <= a:
                    continue
                base = int(s.base[t])
                out.append((t, item, int(s.starts[low + a]) - base, int(s.ends[low + b - 1]) - base, edits))
                rests += [(low + b, high), (low, low + a)]
        return out


def blocks_of(items: DataFrame, id_column: str, text: str, similarity: float) -> list[Benchmark]:
    """The items as prepared blocks; each block is read and prepared on its own."""
    rows = items.select(F.col(id_column).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    for block in range(blocks):
        got = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).orderBy("id", "text").collect()
        yield Benchmark.of([r.id for r in got], [r.text.encode() for r in got], similarity)


def leaks(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", item_column: str = "item_id",
          item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Every match: doc_id, item_id, start, end (bytes of the text), edits, similarity.

    Null and empty texts and items without a word match nothing. Repeated rows and items match each on their own. An empty
    table on either side gives no rows. Other columns are ignored.
    """
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kinds = [source.schema["doc_id"].dataType.simpleString(), items.schema[item_column].dataType.simpleString()]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, start long, end long, edits int, similarity double"
    out = None
    for block in blocks_of(items, item_column, item_text, similarity):
        shared = docs.sparkSession.sparkContext.broadcast(block)        # at most BLOCK_BYTES of items

        def run(batches, shared=shared):
            b = shared.value
            for batch in slices(batches, "text"):
                got = b.matches(texts_of(batch.column("text")))
                if got:
                    t, item, start, end, edits = zip(*got, strict=True)
                    like = [1 - e / len(b.words[i]) for e, i in zip(edits, item, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(t)), pa.array([b.ids[i] for i in item]), pa.array(start, pa.int64()),
                         pa.array(end, pa.int64()), pa.array(edits, pa.int32()), pa.array(like, pa.float64())],
                        names=["doc_id", "item_id", "start", "end", "edits", "similarity"])

        part = source.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_column: str = "item_id",
                  item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows that match no item, with their columns."""
    for block in blocks_of(items, item_column, item_text, similarity):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for batch in slices(batches, text):
                keep = np.ones(batch.num_rows, bool)
                keep[[m[0] for m in shared.value.matches(texts_of(batch.column(text)))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
