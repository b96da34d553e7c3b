"""Personal data: generators propose, boosted trees judge, calibrated thresholds select.

Base rules find plain e-mail addresses, IPv4 addresses, payment cards and international phone numbers; their spans always
stay. Generators of high recall propose further, overlapping spans: written-out and bracketed addresses, cards and phones
with other separators or without a plus, defanged and version 6 IP addresses. Gradient-boosted trees score each proposal
from its format and its context; per kind the lowest threshold that keeps the wanted precision on examples apart selects.
Of overlapping selected spans the best scored one stays, and none that overlaps a base span.

No table marks personal data, so the trees are fitted on examples made here: values in many formats, and look-alikes (dates,
versions, order numbers, hashes, cards with a wrong check digit), each between words of a bounded sample of the corpus.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import hashlib
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import slices

KINDS = ("email", "ip", "card", "phone")
FIT_TEXTS = 300             # texts whose words surround the examples
EXAMPLES = 6_000
PRECISION = 0.98
TREES, DEPTH, RATE, BINS, LEAF = 60, 3, 0.2, 16, 12
CONTEXT = 24

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

# Generators: what a span of each kind may look like, with bounded repetition so that scans stay linear.
_WORD = r"[A-Za-z0-9_%+-]{1,40}(?:\.[A-Za-z0-9_%+-]{1,40}){0,3}"
_PROPOSE = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])" + _WORD + r" ?(?:@|＠|[\[({<] ?(?:at|AT|@) ?[\])}>]| (?:at|AT) ) ?"
                        r"[A-Za-z0-9-]{1,40}(?: ?(?:\.|[\[({<] ?(?:dot|DOT|\.) ?[\])}>]| (?:dot|DOT) ) ?[A-Za-z0-9-]{1,20}){1,4}"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)| \. |\.) ?[0-9]{1,3}){3}(?![0-9])"
                     r"|(?<![0-9A-Fa-f:])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Fa-f:])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[ ._/–‐-]{0,2}[0-9]){12,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9A-Za-z+])(?:\+ ?|00)?\(?[0-9]{1,4}\)?(?:[ ./–-]{1,2}\(?[0-9]{2,5}\)?){1,5}(?![0-9A-Za-z])"
                        r"|(?<![0-9A-Za-z+])(?:00|0)[0-9]{8,13}(?![0-9A-Za-z])"),
}
# Words that stand before personal data, per kind.
_HINTS = {
    "email": ("mail", "email", "e-mail", "contact", "write", "reach"),
    "ip": ("ip", "host", "address", "server", "addr", "from"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "cc"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell"),
}
_AGAINST = ("version", "order", "no", "isbn", "id", "invoice", "ref", "section", "date", "build", "release")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of what the base rules find, by kind and start."""
    out = []
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text, start - 1):
            start -= 1
        got = _DOMAIN.match(text, at + 1) if start < at else None
        if got:
            out.append((0, start, got.end()))
            last = got.end()
        else:
            last = max(last, start)
        at = text.find("@", max(at + 1, last))
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def proposals(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of every proposal; they may overlap one another."""
    out = []
    digits = bool(_DIGIT.search(text))
    for kind, name in enumerate(KINDS):
        if name == "email" or digits or (name == "ip" and ":" in text):
            out.extend((kind, m.start(), m.end()) for m in _PROPOSE[name].finditer(text))
    return out


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a span."""
    value = text[start:end]
    digits = "".join(c for c in value if "0" <= c <= "9")
    parts = re.findall("[0-9]+", value)
    names = re.findall("[A-Za-z]+", value)
    before, after = text[max(0, start - CONTEXT):start], text[end:end + 8]
    words = [w.lower() for w in re.findall("[A-Za-z-]+", before)[-3:]]
    separators = re.sub("[0-9A-Za-z]", "", value)
    sizes = [len(p) for p in parts] or [0]
    return [
        kind, len(value), len(digits), float(len(digits) > 11 and luhn(digits)), len(parts), max(sizes), min(sizes),
        len(names), len(names[-1]) if names else 0, len(set(separators)), separators.count("-"), separators.count("."),
        separators.count(" "), separators.count("/"), separators.count(":"), float("(" in value or "[" in value),
        float("@" in value or "＠" in value), float(bool(re.search(r"\b(?:at|AT)\b", value))),
        float(bool(re.search(r"\b(?:dot|DOT)\b", value))),
        float(value.startswith("+")), float(value.startswith("00")), float(value.startswith("0")),
        float(all(len(p) <= 3 and int(p) <= 255 for p in parts) if parts else 0),
        float(bool(parts) and len(parts) == 3 and any(len(p) == 4 and p[:2] in ("19", "20") for p in parts)),
        float(any(w in _HINTS[KINDS[kind]] for w in words)), float(any(w in _AGAINST for w in words)),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in "#$=-_/."), len(set(digits)),
        sizes[-1], sizes[0], float("4444" in digits or digits[:1] in "3456"), float(digits[:1] in "456"),
        float("::" in value), float(any(c in "ghijklmnopqrstuvwxyz" for c in value.lower()))]


@dataclass
class Trees:
    """Boosted regression trees on binned features, for log odds."""

    edges: list[np.ndarray]
    splits: np.ndarray          # [trees, nodes, 2]: feature and bin
    values: np.ndarray          # [trees, leaves]
    start: float

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Trees:
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        start = float(np.log((y.sum() + 1) / ((1 - y).sum() + 1)))
        self = cls(edges, np.zeros((TREES, 2 ** DEPTH - 1, 2), np.int64), np.zeros((TREES, 2 ** DEPTH)), start)
        b = self._binned(x)
        score = np.full(len(y), start)
        for t in range(TREES):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            for level in range(DEPTH):
                for n in range(2 ** level):
                    mine = node == n
                    self.splits[t, 2 ** level - 1 + n] = self._best(b[mine], g[mine], h[mine])
                f, cut = self.splits[t, 2 ** level - 1 + node].T
                node = 2 * node + (b[np.arange(len(y)), f] > cut)
            self.values[t] = RATE * np.bincount(node, g, 2 ** DEPTH) / (np.bincount(node, h, 2 ** DEPTH) + 1)
            score += self.values[t][node]
        return self

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(self.edges)], axis=1)

    @staticmethod
    def _best(b: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[int, int]:
        best, gain = (0, BINS), 1e-9
        if len(g) < 2 * LEAF:
            return best
        whole = g.sum() ** 2 / (h.sum() + 1)
        for f in range(b.shape[1]):
            left_g, left_h = np.cumsum(np.bincount(b[:, f], g, BINS)), np.cumsum(np.bincount(b[:, f], h, BINS))
            left_n = np.cumsum(np.bincount(b[:, f], minlength=BINS))
            value = left_g ** 2 / (left_h + 1) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + 1) - whole
            value[(left_n < LEAF) | (len(g) - left_n < LEAF)] = 0
            if value.max() > gain:
                best, gain = (f, int(value.argmax())), float(value.max())
        return best

    def score(self, x: np.ndarray) -> np.ndarray:
        b, out = self._binned(x), np.full(len(x), self.start)
        rows = np.arange(len(x))
        for splits, values in zip(self.splits, self.values, strict=True):
            node = np.zeros(len(x), np.int64)
            for level in range(DEPTH):
                f, cut = splits[2 ** level - 1 + node].T
                node = 2 * node + (b[rows, f] > cut)
            out += values[node]
        return 1 / (1 + np.exp(-out))


def _examples(texts: list[str], n: int, seed: int = 3) -> list[tuple[str, int, int, int, bool]]:
    """(text, kind, start, end, personal) of made examples."""
    r = random.Random(seed)
    words = [w for t in texts for w in t.split()] or ["and", "the", "of", "in"]
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))            # noqa: E731

    def card(valid: bool) -> str:
        body = r.choice("3456") + digits(r.choice((12, 14, 14, 14)))
        check = next(c for c in "0123456789" if luhn(body + c) == valid)
        return body + check

    def grouped(value: str, sizes: list[int], separator: str) -> str:
        out, at = [], 0
        for s in sizes:
            out.append(value[at:at + s])
            at += s
        return separator.join(p for p in [*out, value[at:]] if p)

    def name() -> str:
        return re.sub("[^a-z]", "", r.choice(words).lower()) or "info"

    def good(kind: int) -> str:
        if kind == 0:
            at = r.choice((" at ", " (at) ", "(at)", "[at]", " [at] ", " @ ", "＠", "@", " AT "))
            dot = r.choice((" dot ", " (dot) ", "(dot)", "[dot]", " [dot] ", "." if at not in ("@", " at ", " AT ") else "[dot]"))
            return name() + r.choice(("", ".", "_")) + digits(r.choice((0, 2))) + at + name() + dot + r.choice(("com", "org", "net", "de", "example", "io"))
        if kind == 1:
            if r.random() < 0.4:
                return ":".join(f"{r.randrange(1, 65536):x}" for _ in range(r.choice((8, 8, 4)))).replace(":", "::" if r.random() < 0.2 else ":", 1)
            return r.choice(("[.]", "(.)", "[dot]", " . ", "(dot)")).join(str(r.randrange(1, 256)) for _ in range(4))
        if kind == 2:
            return grouped(card(True), [4, 4, 4], r.choice((".", "/", "_", "  ", "–", ". ")))
        value = r.choice("23456789") + digits(9)
        return r.choice((f"({value[:3]}) {value[3:6]}-{value[6:]}", f"{value[:3]}-{value[3:6]}-{value[6:]}",
                         f"{value[:3]}.{value[3:6]}.{value[6:]}", f"({value[:3]}) {value[3:6]} {value[6:]}",
                         f"00{value[:2]} {value[2:5]} {value[5:]}", f"0{value[:2]} {value[2:6]} {value[6:]}", f"+ {value[:2]} {value[2:]}"))

    def bad(kind: int) -> str:
        if kind == 0:
            return r.choice((f"{name()} at {name()} . {name()}", f"{name()} @ {name()}.{digits(2)}", f"{name()}@{digits(1)}.{digits(1)}",
                             f"{name()} at {name()}. {name().title()}"))
        if kind == 1:
            return r.choice((".".join(str(r.randrange(0, 999)) for _ in range(4)), f"{r.randrange(24)}:{digits(2)}:{digits(2)}",
                             ". ".join(str(r.randrange(1, 40)) for _ in range(4)), f"{digits(2)}:{digits(2)}:{digits(2)}:{digits(2)}"))
        if kind == 2:
            return r.choice((card(False), digits(r.choice((13, 14, 15, 16, 17, 18))), grouped(card(False), [4, 4, 4], r.choice((".", "/", "_", " "))),
                             grouped(digits(13), [3, 1, 4, 4], "-"), grouped(digits(16), [8], ".")))
        return r.choice((f"20{digits(2)}-{r.randrange(10, 13)}-{r.randrange(10, 29)}", f"{r.randrange(10, 29)}.{r.randrange(10, 13)}.20{digits(2)}",
                         f"{digits(3)}-{digits(2)}", f"{digits(1)}.{digits(2)}.{digits(2)}", f"{digits(4)} {digits(4)}", f"{digits(2)}/{digits(2)}",
                         f"{digits(2)} {digits(3)} {digits(2)}", f"{digits(1)}, {digits(2)}", grouped(digits(12), [4, 4], " "), f"20{digits(2)}-20{digits(2)}"))

    out = []
    for i in range(n):
        kind, personal = i % 4, r.random() < 0.4
        value = (good if personal else bad)(kind)
        hint = r.random()
        lead = [r.choice(words) for _ in range(4)]
        if hint < (0.4 if personal else 0.05):
            lead.append(r.choice(_HINTS[KINDS[kind]]) + r.choice((":", "", " is")))
        elif hint > (0.98 if personal else 0.6):
            lead.append(r.choice(_AGAINST) + r.choice((":", "", " no.")))
        left = " ".join(lead) + " "
        out.append((left + value + r.choice((" ", ", ", ". ", "\n")) + " ".join(r.choice(words) for _ in range(4)),
                    kind, len(left), len(left) + len(value), personal))
    return out


@dataclass
class Judge:
    trees: Trees
    thresholds: list[float]
    unproposed: list[int]       # personal examples per kind that neither a base rule nor a generator finds
    missed: list[int]           # these, and the proposed ones below the threshold

    @classmethod
    def fit(cls, texts: list[str], n: int = EXAMPLES) -> Judge:
        rows, labels, kinds = [], [], []
        unproposed, right = [0] * len(KINDS), []
        for text, kind, start, end, personal in _examples(texts, n):
            covered = {(k, s, e) for k, s, e in base_spans(text)}
            first = len(labels)
            for k, s, e in proposals(text):
                if (k, s, e) in covered:
                    continue
                overlap = max(0, min(e, end) - max(s, start)) / (max(e, end) - min(s, start))
                rows.append(features(text, k, s, e))
                labels.append(personal and k == kind and overlap > 0.85)
                kinds.append(k)
            if personal and (kind, start, end) not in covered:
                mine = [i for i in range(first, len(labels)) if labels[i]]
                unproposed[kind] += not mine
                if mine:
                    right.append((kind, mine))
        x, y, kinds = np.array(rows), np.array(labels, float), np.array(kinds)
        learn = np.arange(len(y)) % 4 != 3
        trees = Trees.fit(x[learn], y[learn])
        score = trees.score(x[~learn])
        thresholds = [_threshold(score[kinds[~learn] == k], y[~learn][kinds[~learn] == k]) for k in range(len(KINDS))]
        score, missed = trees.score(x), list(unproposed)
        for kind, mine in right:
            missed[kind] += bool(score[mine].max() < thresholds[kind])
        return cls(trees, thresholds, unproposed, missed)

    def added(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Selected proposals that overlap neither a base span nor a better one."""
        spans = sorted((s, e) for _, s, e in base)
        starts = [s for s, _ in spans]
        free = []
        for k, s, e in proposals(text):
            i = np.searchsorted(starts, e) - 1          # base spans of different kinds may overlap: look back over all near
            while i >= 0 and spans[i][1] <= s and i > 0 and spans[i - 1][1] > s:
                i -= 1
            if i < 0 or spans[i][1] <= s:
                free.append((k, s, e))
        if not free:
            return []
        score = self.trees.score(np.array([features(text, *f) for f in free]))
        chosen: list[tuple[int, int, int]] = []
        for i in sorted(range(len(free)), key=lambda i: (-score[i], free[i])):
            k, s, e = free[i]
            if score[i] >= self.thresholds[k] and all(e <= a or b <= s for _, a, b in chosen):
                chosen.append((k, s, e))
        return chosen


def _threshold(score: np.ndarray, y: np.ndarray) -> float:
    """The lowest score from which on the precision is ``PRECISION``; above 1 if there is none."""
    order = np.argsort(-score)
    precision = np.cumsum(y[order]) / (np.arange(len(y)) + 1)
    good = np.flatnonzero(precision >= PRECISION)
    return max(0.5, float(score[order][good[-1]])) if len(good) else 2.0


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def fitted(docs: DataFrame, text: str = "text", texts: int = FIT_TEXTS) -> Judge:
    """Trees fitted between the words of at most ``texts`` texts: those with the smallest hashes."""
    known = docs.select(F.col(text).cast("string").alias("t")).filter("t is not null").withColumn("h", F.xxhash64("t"))
    last = known.select("h").orderBy("h").limit(texts).agg(F.max("h")).head()[0]       # hashes alone are compared
    got = known.filter(F.col("h") <= last).dropDuplicates(["h"]).orderBy("h").limit(texts).collect() if last is not None else []
    return Judge.fit([r.t for r in got])


def found(docs: DataFrame, judge: Judge, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added of every row.

    A null or empty text has no spans. Rows are judged on their own: repeated rows, ties and null ids change nothing; other
    columns are ignored.
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(judge)        # TREES small trees
    schema = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()),
                        ("spans", pa.string()), ("n_added", pa.int64())])

    def run(batches):
        for batch in slices(batches, "text"):
            out = []
            for id_, words in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                base = base_spans(words) if words else []
                more = shared.value.added(words, base) if words else []
                out.append({"doc_id": id_, **{f"n_{k}": sum(s[0] == i for s in base) for i, k in enumerate(KINDS)},
                            "base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(), "spans": joined(base + more),
                            "n_added": len(more)})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    return source.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
                                  "spans string, n_added long")


def redacted(text: str, spans: str) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first one counts."""
    out, at = [], 0
    for kind, start, end in sorted((s.split(":") for s in spans.split(",") if s), key=lambda s: (int(s[1]), int(s[2]))):
        if int(start) >= at:
            out += [text[at:int(start)], f"[{kind}]"]
            at = int(end)
    return "".join(out) + text[at:]
