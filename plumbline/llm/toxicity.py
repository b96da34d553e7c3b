"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs, in numpy.

A text is cut into runs of letters and digits, lower-cased over A-Z. Each distinct word becomes one input vector: its word
embedding plus the mean embedding of its character pieces (four bytes long, and the first six bytes, with marks for the
word's borders). Words and pieces that fewer than ``LEAST_TEXTS`` fitting texts hold share one vector. Windows of ``WINDOW``
words overlap by ``WINDOW - STRIDE`` and cover the whole text; in a window two GRUs read in both directions, attention
pools their states and a logistic unit scores. A document's score is its highest window's, calibrated on fitting documents
that the weights were not learned from, such that 0.7 is the cut that separates the labels best.

Only fitting is bounded: ``FIT_ROWS`` labelled rows, those with the smallest hash of their id. Labels are per document and
most windows of a toxic document are clean, so fitting alternates between choosing the windows that stand for a toxic
document (at first those with the most telling words) and learning from them.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import LOWER, Buffer, mix, prefix_sums, release_memory, slices, span_hashes, texts_of

FIT_ROWS = 4_000
LEAST_TEXTS = 4
WINDOW, STRIDE = 48, 32
DIM, HIDDEN, ATTEND = 16, 8, 8
EPOCHS, BATCH, RATE = 10, 128, 0.01
HARD_SHARE = 0.2          # of the clean windows, those that an epoch looks through for hard ones
THRESHOLD = 0.7
WINDOWS_AT_ONCE = 1_024
WORDS_AT_ONCE = 1 << 15
FILTER_BYTES = 2 << 20    # text that a filtering task scores at once

LETTER = np.zeros(256, bool)
LETTER[ord("a"):ord("z") + 1] = True
LETTER[ord("0"):ord("9") + 1] = True
LETTER[128:] = True


def held_out(id_column: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


@dataclass
class Tokens:
    """Words of some texts: distinct words' hashes and spans, the distinct word at each place, and where texts begin."""

    data: np.ndarray
    starts: np.ndarray         # of each distinct word
    ends: np.ndarray
    hashes: np.ndarray         # ascending
    at: np.ndarray             # distinct word of every word
    first: np.ndarray          # first word of every text, and the end


def tokens(texts: list[bytes]) -> Tokens:
    buffer = Buffer.of(texts)
    data = LOWER[buffer.data]
    inside = LETTER[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    hashes, where, at = np.unique(span_hashes(prefix_sums(data), starts, ends), return_index=True, return_inverse=True)
    return Tokens(data, starts[where], ends[where], hashes, at, np.append(np.searchsorted(starts, buffer.starts), len(starts)))


def pieces(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(distinct word, hash) of every character piece."""
    lengths = t.ends - t.starts
    first = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1] + 2, out=first[1:])
    framed = np.full(int((lengths + 2).sum()), ord("^"), np.uint8)
    word = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    framed[first[word] + 1 + inside] = t.data[t.starts[word] + inside]
    framed[first + lengths + 1] = ord("$")
    sums = prefix_sums(framed)
    n = np.maximum(lengths - 1, 1)                         # four-byte pieces of a framed word, or the word itself
    owner = np.repeat(np.arange(len(n)), n)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    begin = first[owner] + offset
    end = np.minimum(begin + 4, first[owner] + lengths[owner] + 2)
    head = np.minimum(first + 7, first + lengths + 2)
    return (np.concatenate((owner, np.arange(len(n)))),
            np.concatenate((span_hashes(sums, begin, end), mix(span_hashes(sums, first, head) + np.uint64(7)))))


def find(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """1 + place of each value in the ascending ``known``, 0 where it is missing."""
    if not len(known):
        return np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[at] == values, at + 1, 0)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, first word) of every window; a text without words has one empty window."""
    n = np.diff(first)
    count = np.maximum(1, -(-(n - (WINDOW - STRIDE)) // STRIDE))
    text = np.repeat(np.arange(len(n)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return text, first[:-1][text] + nth * STRIDE


@dataclass
class Network:
    words: np.ndarray          # known words' hashes
    parts: np.ndarray          # known pieces' hashes
    p: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0

    @classmethod
    def fresh(cls, words: np.ndarray, parts: np.ndarray, seed: int = 5) -> Network:
        r = np.random.default_rng(seed)
        draw = lambda *s, by: (r.normal(size=s) * by).astype(np.float32)       # noqa: E731
        p = {"word": draw(len(words) + 1, DIM, by=0.1), "part": draw(len(parts) + 1, DIM, by=0.1),
             "wx": draw(2, DIM, 3 * HIDDEN, by=DIM ** -0.5), "bx": np.zeros((2, 1, 3 * HIDDEN), np.float32),
             "wh": draw(2, HIDDEN, 3 * HIDDEN, by=HIDDEN ** -0.5),
             "wa": draw(2 * HIDDEN, ATTEND, by=0.3), "va": draw(ATTEND, by=0.3),
             "wo": draw(2 * HIDDEN, by=0.3), "bo": np.zeros(1, np.float32)}
        return cls(words, parts, p)

    def inputs(self, t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per distinct word: known word, (owner, number) of its known pieces in the owners' order, and one piece's share."""
        owner, h = pieces(t)
        part = find(self.parts, h)
        share = (1 / np.maximum(np.bincount(owner, minlength=len(t.hashes)), 1)).astype(np.float32)
        known = np.flatnonzero(part)
        known = known[np.argsort(owner[known], kind="stable")]
        return find(self.words, t.hashes), owner[known], part[known], share

    def vectors(self, word: np.ndarray, owner: np.ndarray, part: np.ndarray, share: np.ndarray) -> np.ndarray:
        x = self.p["word"][word].copy()
        if len(owner):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            own = owner[first]
            x[own] += np.add.reduceat(self.p["part"][part], first, axis=0) * share[own][:, None] * 3
        return x

    def projected(self, word: np.ndarray, owner: np.ndarray, part: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Inputs of both readings per distinct word, [2, words, 3H], made some words at a time."""
        out = np.empty((2, max(1, len(word)), 3 * HIDDEN), np.float32)
        out[:] = self.p["bx"]
        for i in range(0, len(word), WORDS_AT_ONCE):
            low, high = np.searchsorted(owner, (i, i + WORDS_AT_ONCE))
            block = slice(i, i + WORDS_AT_ONCE)
            out[:, block] += self.vectors(word[block], owner[low:high] - i, part[low:high], share[block]) @ self.p["wx"]
        return out

    def forward(self, xs: np.ndarray, at: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows. xs: projected inputs of distinct words [2, words, 3H]; at, mask: [windows, WINDOW]."""
        p, (b, steps), h = self.p, at.shape, HIDDEN
        both = np.stack((at, at[:, ::-1]))
        on = np.stack((mask, mask[:, ::-1]))[..., None].astype(np.float32)
        state, states, saved = np.zeros((2, b, h), np.float32), np.zeros((2, b, steps, h), np.float32), []
        for s in range(steps):
            x = np.stack((xs[0][both[0, :, s]], xs[1][both[1, :, s]]))
            g = state @ p["wh"]
            zr = 0.5 + 0.5 * np.tanh(0.5 * (x[..., :2 * h] + g[..., :2 * h]))
            z, r = zr[..., :h], zr[..., h:]
            new = np.tanh(x[..., 2 * h:] + r * g[..., 2 * h:])
            nxt = state + on[:, :, s] * z * (new - state)
            if keep:
                saved.append((state, z, r, new, g[..., 2 * h:]))
            state = nxt
            states[:, :, s] = state
        hidden = np.concatenate((states[0], states[1][:, ::-1]), axis=2)
        u = np.tanh(hidden @ p["wa"])
        e = np.where(mask, u @ p["va"], -1e9)
        a = np.exp(e - e.max(axis=1, keepdims=True)) * mask
        a /= np.maximum(a.sum(axis=1, keepdims=True), 1e-9)
        pooled = (a[..., None] * hidden).sum(axis=1)
        logit = pooled @ p["wo"] + p["bo"][0]
        return (logit, (both, on, saved, hidden, u, a, pooled)) if keep else logit

    def gradients(self, x: np.ndarray, at: np.ndarray, mask: np.ndarray, target: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
        """Of the mean log loss: of the weights, and of the distinct words' vectors; and the logits."""
        p, h, steps = self.p, HIDDEN, at.shape[1]
        xs = x @ p["wx"] + p["bx"]
        logit, (both, on, saved, hidden, u, a, pooled) = self.forward(xs, at, mask, keep=True)
        d = ((1 / (1 + np.exp(-logit)) - target) / len(target)).astype(np.float32)
        g = {"wo": pooled.T @ d, "bo": d.sum(keepdims=True)}
        dp = d[:, None] * p["wo"]
        da = (hidden * dp[:, None]).sum(axis=2)
        de = a * (da - (a * da).sum(axis=1, keepdims=True))
        du = de[..., None] * p["va"] * (1 - u * u)
        g["va"] = (u * de[..., None]).sum(axis=(0, 1))
        g["wa"] = np.einsum("bth,bta->ha", hidden, du)
        dh = a[..., None] * dp[:, None] + du @ p["wa"].T
        dstates = np.stack((dh[..., :h], dh[:, ::-1, h:]))
        back, gwh, dxs = np.zeros_like(saved[0][0]), np.zeros_like(p["wh"]), np.zeros_like(xs)
        for s in range(steps - 1, -1, -1):
            state, z, r, new, gn = saved[s]
            d_next = (back + dstates[:, :, s])
            step = d_next * on[:, :, s]
            dz = step * (new - state) * z * (1 - z)
            dn = step * z * (1 - new * new)
            dr = dn * gn * r * (1 - r)
            dgate = np.concatenate((dz, dr, dn * r), axis=2)
            dx = np.concatenate((dz, dr, dn), axis=2)
            gwh += state.transpose(0, 2, 1) @ dgate
            back = d_next - step * z + dgate @ p["wh"].transpose(0, 2, 1)
            for way in (0, 1):
                np.add.at(dxs[way], both[way, :, s], dx[way])
        g["wh"] = gwh
        g["wx"] = x.T @ dxs
        g["bx"] = dxs.sum(axis=1, keepdims=True)
        return g, (dxs @ p["wx"].transpose(0, 2, 1)).sum(axis=0), logit

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """The highest window logit of each text."""
        t = tokens(texts)
        text, start = windows(t.first)
        out = np.full(len(texts), -np.inf)
        xs = self.projected(*self.inputs(t))
        for i in range(0, len(text), WINDOWS_AT_ONCE):
            own, at = text[i:i + WINDOWS_AT_ONCE], start[i:i + WINDOWS_AT_ONCE]
            np.maximum.at(out, own, self.forward(xs, *places(t, own, at)))
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(texts) + self.shift, -40, 40)))


def places(t: Tokens | Corpus, text: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of windows, and which places hold a word."""
    where = start[:, None] + np.arange(WINDOW)
    mask = where < t.first[text + 1][:, None]
    if not len(t.at):
        return np.zeros(where.shape, np.int64), mask
    return t.at[np.minimum(where, len(t.at) - 1)], mask


def _parts_of(texts: list[bytes], most: int = 1 << 20):
    """Runs of texts of at most ``most`` bytes, or a single one: what is turned into arrays at once."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > most:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def _telling(texts: list[bytes], toxic: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For words and for pieces: the keys that enough texts hold, and their log odds of standing in toxic texts."""
    seen: list[list[tuple]] = [[], []]
    done = 0
    for part in _parts_of(texts):
        t = tokens(part)
        pair = np.unique(t.at.astype(np.int64) + len(t.hashes) * np.repeat(np.arange(len(part)), np.diff(t.first)))
        word, text = (pair % len(t.hashes), pair // len(t.hashes)) if len(t.hashes) else (pair, pair)
        owner, h = pieces(t)
        order = np.argsort(owner, kind="stable")
        n = np.bincount(owner, minlength=len(t.hashes))
        begin = np.cumsum(n) - n
        flat = np.repeat(begin[word] - (np.cumsum(n[word]) - n[word]), n[word]) + np.arange(n[word].sum())
        values, at = np.unique(h[order], return_inverse=True)
        held = np.unique(at[flat] + len(values) * np.repeat(text, n[word])) if len(values) else np.zeros(0, np.int64)
        for kind, keys, use, own in ((0, t.hashes, word, text), (1, values, held % max(len(values), 1), held // max(len(values), 1))):
            yes = np.bincount(use, toxic[done + own].astype(float), len(keys))
            seen[kind].append((keys, yes, np.bincount(use, minlength=len(keys))))
        done += len(part)
    out = []
    for kind in seen:
        keys, at = np.unique(np.concatenate([k for k, _, _ in kind]), return_inverse=True)
        yes = np.bincount(at, np.concatenate([y for _, y, _ in kind]), len(keys))
        every = np.bincount(at, np.concatenate([e for _, _, e in kind]), len(keys))
        odds = np.log((yes + 0.2) / (toxic.sum() + 1)) - np.log((every - yes + 0.5) / ((~toxic).sum() + 1))
        out.append((keys[every >= LEAST_TEXTS], odds[every >= LEAST_TEXTS]))
    return out


@dataclass
class Corpus:
    """The fitting texts as inputs of their distinct words, and the word at every place."""

    word: np.ndarray
    owner: np.ndarray
    part: np.ndarray
    share: np.ndarray
    at: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, net: Network, texts: list[bytes]) -> Corpus:
        known: dict[int, int] = {}
        rows, places_ = [], 0
        for run in _parts_of(texts):
            t = tokens(run)
            numbers = np.array([known.setdefault(h, len(known)) for h in t.hashes.tolist()], np.int32)
            fresh = np.flatnonzero(numbers >= len(known) - (new := len(known) - (rows[-1][-1] if rows else 0)))
            word, owner, part, share = net.inputs(t)
            order = np.argsort(numbers[fresh])
            fresh = fresh[order]
            rank = np.full(len(word), -1, np.int64)
            rank[fresh] = len(known) - new + np.arange(len(fresh))
            mine = np.flatnonzero(rank[owner] >= 0)
            mine = mine[np.argsort(rank[owner[mine]], kind="stable")]
            rows.append((word[fresh].astype(np.int32), rank[owner[mine]].astype(np.int32), part[mine].astype(np.int32),
                         share[fresh], numbers[t.at] if len(t.at) else np.zeros(0, np.int32), t.first[:-1] + places_, len(known)))
            places_ += len(t.at)
        columns = [np.concatenate(c) for c in list(zip(*rows, strict=True))[:6]]
        return cls(*columns[:5], np.append(columns[5], places_))


def fit(texts: list[bytes], labels: list[int], seed: int = 5) -> Network:
    """A network for labelled texts. Without both labels among them it scores everything 0."""
    toxic = np.array(labels, bool)
    if not toxic.any() or toxic.all():
        net = Network.fresh(np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        net.scale, net.shift = 0.0, -8.0
        return net
    r = np.random.default_rng(seed)
    (words, odds), (parts, part_odds) = _telling(texts, toxic)
    net = Network.fresh(words, parts, seed)
    t = Corpus.of(net, texts)
    word, owner, part, share = t.word, t.owner, t.part, t.share
    telling = np.maximum(np.append(-9.0, odds)[word], 0)
    np.maximum.at(telling, owner, np.append(0.0, part_odds)[part] * 0.8)
    text, start = windows(t.first)
    learn = r.random(len(texts)) < 0.8
    rank = np.zeros(len(text))
    for i in range(0, len(text), 4096):
        at, mask = places(t, text[i:i + 4096], start[i:i + 4096])
        rank[i:i + 4096] = np.sort(telling[at] * mask, axis=1)[:, -3:].sum(axis=1)
    clean = np.flatnonzero(~toxic[text] & learn[text])
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    count = 0
    for epoch in range(EPOCHS):
        look = r.choice(clean, max(1, int(HARD_SHARE * len(clean))), replace=False)
        if epoch >= 2:
            xs = net.projected(word, owner, part, share)
            due = np.concatenate((np.flatnonzero(toxic[text]), look))
            for i in range(0, len(due), WINDOWS_AT_ONCE):
                s = due[i:i + WINDOWS_AT_ONCE]
                rank[s] = net.forward(xs, *places(t, text[s], start[s]))
        best = np.lexsort((-rank, text))
        lead = np.ones(len(best), bool)
        lead[1:] = text[best][1:] != text[best][:-1]
        chosen = best[lead & toxic[text[best]] & learn[text[best]]]
        if epoch >= 3 and (rank[chosen] > 0).any():     # toxic texts whose every window still looks clean teach noise
            chosen = chosen[rank[chosen] > 0]
        hard = look[np.argsort(-rank[look])[:len(chosen)]]
        other = r.choice(clean, min(len(clean), 5 * len(chosen) + 64), replace=False)
        use = np.concatenate((chosen, hard, other))
        target = np.concatenate((np.ones(len(chosen)), np.zeros(len(hard) + len(other)))).astype(np.float32)
        for part_of in np.array_split(r.permutation(len(use)), max(1, len(use) // BATCH)):
            at, mask = places(t, text[use[part_of]], start[use[part_of]])
            seen, local = np.unique(at, return_inverse=True)
            held = np.zeros(len(word), np.int64)
            held[seen] = np.arange(len(seen)) + 1
            mine = held[owner] > 0
            o, q = held[owner[mine]] - 1, part[mine]
            x = net.vectors(word[seen], o, q, share[seen])
            g, gx, _ = net.gradients(x, local.reshape(at.shape), mask, target[part_of])
            g["word"], g["part"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["part"])
            np.add.at(g["word"], word[seen], gx)
            np.add.at(g["part"], q, gx[o] * share[seen][o][:, None] * 3)
            count += 1
            for k, v in g.items():
                m, s = moments[k]
                v = v + 3e-5 * net.p[k]
                m += 0.1 * (v - m)
                s += 0.001 * (v * v - s)
                net.p[k] -= (RATE * (m / (1 - 0.9 ** count)) / (np.sqrt(s / (1 - 0.999 ** count)) + 1e-8)).astype(np.float32)
    xs = net.projected(word, owner, part, share)
    top = np.full(len(texts), -np.inf)
    for i in range(0, len(text), WINDOWS_AT_ONCE):
        s = slice(i, i + WINDOWS_AT_ONCE)
        np.maximum.at(top, text[s], net.forward(xs, *places(t, text[s], start[s])))
    check = ~learn if toxic[~learn].any() and (~toxic[~learn]).any() else np.ones(len(texts), bool)
    cut = _best_cut(top[check], toxic[check])
    net.scale, net.shift = 0.5, float(np.log(THRESHOLD / (1 - THRESHOLD)) - 0.5 * cut)
    return net


def _best_cut(logits: np.ndarray, toxic: np.ndarray) -> float:
    """The cut with the best F-measure at a weight of 0.5 (precision before recall), in the middle of its gap."""
    order = np.argsort(-logits)
    values, hits = logits[order], np.cumsum(toxic[order])
    measure = 1.25 * hits / (np.arange(len(values)) + 1 + 0.25 * toxic.sum())
    best = int(np.argmax(measure))
    below = values[best + 1] if best + 1 < len(values) else values[best] - 1
    return float((values[best] + below) / 2)


def fitted(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic",
           rows: int = FIT_ROWS) -> Network:
    """A network learned from at most ``rows`` labelled rows that are not held out; rows without a label or id are skipped.

    It is fitted in one task, which holds the sample's texts whole, however long they are.
    """
    known = labels.filter(F.col(label).isNotNull() & ~held_out(id_column)).select(
        F.col(id_column).alias("id"), F.col(label).cast("int").alias("y")).dropDuplicates(["id"])
    order = F.xxhash64("id")
    picked = known.join(docs.select(F.col(id_column).alias("id")).distinct(), "id", "left_semi").orderBy(order, "id").limit(rows)
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text")).join(
        F.broadcast(picked), "id")              # at most ``rows`` rows of two numbers
    few = chosen.select("y", "text", order.alias("first"), F.col("id").cast("string").alias("second"),
                        F.xxhash64("text").alias("third")).orderBy("first", "second", "third").limit(rows)

    def learn(batches):
        """The one task that holds the sample: the driver sees neither texts nor gradients."""
        texts, labels, keys = [], [], []
        for batch in batches:
            texts += texts_of(batch.column("text"))
            labels += batch.column("y").to_pylist()
            keys += zip(*(batch.column(c).to_pylist() for c in ("first", "second", "third")), strict=True)
        at = sorted(range(len(keys)), key=keys.__getitem__)
        network = fit([texts[i] for i in at], [labels[i] for i in at])
        out = pa.RecordBatch.from_arrays([pa.array([pickle.dumps(network)], pa.binary())], names=["network"])
        del texts, labels, keys, network
        release_memory()
        yield out

    row = few.coalesce(1).mapInArrow(learn, "network binary").head()        # none where no row was found
    return pickle.loads(row["network"]) if row else fit([], [])


def scored(docs: DataFrame, network: Network, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row; a null or empty text has the score of an empty window.

    Each row is scored on its own, so repeated rows, ties and null ids change nothing; other columns are ignored.
    """
    source = docs.select(F.col(id_column).alias("doc_id"), held_out(id_column).alias("held_out"),
                         F.col(text).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(network)   # at most LEAST_TEXTS-frequent words of FIT_ROWS texts

    def run(batches):
        for batch in slices(batches, "text"):
            s = shared.value.scores(texts_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64()),
                                              pa.array((s >= THRESHOLD).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that the network does not predict toxic, with their columns."""
    network = fitted(docs, labels, id_column, text)
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        for batch in slices(batches, text, FILTER_BYTES):
            keep = shared.value.scores(texts_of(batch.column(text))) < THRESHOLD
            yield batch.filter(pa.array(keep))
        release_memory()

    return docs.mapInArrow(run, docs.schema)
