"""Periodic runs, hard negatives and the prefix-tree join against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import negatives, periodic, trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---------------------------------------------------------------------------------------------------------------- runs

def brute_runs(words, least, times):
    out, seen = [], set()
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(least, times * q) and (start, length) not in seen:
                seen.add((start, length))
                out.append((start, length, q))
            if i == start:
                i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("least,times", [(24, 3), (4, 2), (8, 2), (6, 3), (12, 4)])
def test_runs_equal_brute_force(least, times):
    r = random.Random(least)
    for _ in range(400):
        words = [r.randrange(r.choice([1, 2, 3, 4])) for _ in range(r.randrange(0, 70))]
        if r.random() < 0.5 and len(words) > 6:
            a, p = r.randrange(len(words)), r.randrange(1, 6)
            words = [words[i] if i < a or a + (i - a) % p >= len(words) else words[a + (i - a) % p] for i in range(len(words))]
        want = brute_runs(words, least, times)
        if words:
            assert [tuple(x) for x in periodic.runs_of(np.array(words) + 1, least, times).tolist()] == want
        text = "  ".join(f"w{x}" for x in words).encode()
        found, kept = periodic.runs_in([b"other words", text, b""], least, times)
        assert [tuple(x) for x in found[1].tolist()] == want and not len(found[0]) and not len(found[2])
        assert kept[1].decode() == collapsed([f"w{x}" for x in words], want)


def test_longest_common_extensions_equal_brute_force():
    r = random.Random(4)
    for _ in range(60):
        words = np.array([r.randrange(1, 4) for _ in range(r.randrange(2, 120))])
        tree = periodic.SuffixTree(words)
        suffixes = [tuple(words[i:]) for i in range(len(words) + 1)]
        assert sorted(range(len(words) + 1), key=lambda i: suffixes[i]) == np.argsort(tree.rank).tolist()
        i, j = np.array(list(itertools.combinations(range(len(words) + 1), 2))).T
        want = [next((k for k, (a, b) in enumerate(zip(suffixes[x], suffixes[y])) if a != b), min(len(suffixes[x]), len(suffixes[y])))
                for x, y in zip(i, j)]
        assert tree.common(i, j).tolist() == want


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_run_query_equals_brute_force(make, texts):
    r = random.Random(2)
    phrase = "the same few words again and again\n"
    more = [phrase * 9 + "then more", "x " * 24, "x " * 23, "a b " * 12 + "a", "Äö ß " * 30, phrase * 5 + "break " + phrase * 6]
    rows = [(i, t, "s") for i, t in enumerate(texts + more + [" ".join(r.choice("ab") for _ in range(300)) for _ in range(10)])]
    rows += [(None, phrase * 7, None), (None, None, None), (3, phrase * 7, "s"), (3, phrase * 7, "s")]
    got = sorted(map(tuple, periodic.digests(periodic.periodic_runs(periodic.periodic_tails(make(rows)))).collect()), key=str)
    want = []
    for doc_id, text, _ in rows:
        words = planted(doc_id, text)
        runs = brute_runs(words, 24, 3)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2])) if runs else (None, None, None)
        want.append((doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                     hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest(),
                     hashlib.sha256(collapsed(words, runs).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert sum(w[1] > 0 for w in want) > 10


def test_runs_of_an_empty_table_and_a_very_long_text(make):
    assert periodic.periodic_runs(make([])).count() == 0
    long = " ".join(f"u{i}" for i in range(60_000)) + " " + "tick tock " * 40_000
    row, = periodic.periodic_runs(make([(1, long, "s")])).collect()
    assert [tuple(x) for x in row.runs] == [(60_000, 80_000, 2)] and row.collapsed.endswith("u59999 tick tock")


# ----------------------------------------------------------------------------------------------------------- negatives

def brute_negatives(rows, positives=5, most=5, low=80, high=100):
    used = []
    for at, (vec_id, label, vector) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        used.append((at, vec_id, label, [math.floor(256 * x) for x in vector]))
    order = lambda x: (-x[0], math.inf if x[1] is None else x[1])          # noqa: E731
    out = []
    for at, vec_id, label, vector in used:
        if vec_id is None or vec_id % 100:
            continue
        scored = [(sum(a * b for a, b in zip(vector, v)), i, lab == label) for other, i, lab, v in used if other != at]
        for p in sorted([s for s in scored if s[2]], key=order)[:positives]:
            fits = [s for s in scored if not s[2] and low * p[0] <= 100 * s[0] <= high * p[0]]
            out += [(vec_id, p[1], k + 1, s[1], p[0], s[0]) for k, s in enumerate(sorted(fits, key=order)[:most])]
    return sorted(out, key=str)


@pytest.mark.parametrize("blocks", [(1 << 16, 1 << 10), (7, 2)])
def test_negatives_equal_brute_force(spark, blocks):
    r = random.Random(9)
    rows = []
    for i in range(600):
        base = [1.0 if k % 3 == i % 3 else 0.2 for k in range(12)]
        rows.append((i, r.choice([1, 1, 1, 2, 3]), [b + r.choice([-0.5, -0.25, 0.0, 0.25, 0.3]) for b in base]))
    rows += [(700, 4, [1.0] * 12), (701, None, [1.0] * 12), (702, 1, None), (703, 1, [None] + [1.0] * 11), (704, 1, [math.nan] * 12),
             (705, 2, [math.inf] + [1.0] * 11), (800, 1, []), (801, 2, [0.5] * 3), (900, 2, [-1.0] * 12), (None, 2, [0.9] * 12)]
    rows += [rows[0], rows[0], rows[101], (None, 3, [0.9] * 12)]
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], "vec_id long, label int, embedding array<float>, row string, score int")
    rows = [(a, b, None if c is None else [None if x is None else float(np.float32(x)) for x in c]) for a, b, c in rows]
    got = negatives.mined(df.repartition(5), F.col("id") % 100 == 0, candidate_block=blocks[0], anchor_block=blocks[1])
    got = sorted(map(tuple, got.collect()), key=str)
    assert got == brute_negatives(rows) and len(got) > 100
    assert negatives.mined(df.limit(0), F.col("id") % 100 == 0).count() == 0


def test_look_ups_give_exact_products():
    r = np.random.default_rng(3)
    for low, high, dims in ((-300, 300, 64), (-5, 6, 16), (-2**26, 2**26, 24), (0, 1, 8), (-1, 0, 8), (-20_000, 20_000, 64)):
        c, a = (r.integers(low, high, (n, dims), dtype=np.int32) for n in (200, 40))
        assert (negatives.Tables(a).of(negatives.bit_planes(c)) == c.astype(np.int64) @ a.astype(np.int64).T).all()


# ---------------------------------------------------------------------------------------------------------------- trie

def shingles(text, width=4):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def brute_groups(sets, percent):
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            a, b = root(i), root(j)
            up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(sets))]


def test_trie_links_connect_what_is_linked():
    r = np.random.default_rng(5)
    number = lambda n: r.integers(0, 2**63, int(n), dtype=np.uint64)        # noqa: E731
    for _ in range(150):
        percent = int(r.choice([50, 80, 85, 100]))
        base = [number(r.integers(1, 60)) for _ in range(r.integers(1, 5))]
        sets = []
        for _ in range(r.integers(1, 40)):
            b = base[r.integers(len(base))]
            b = np.unique(np.concatenate((b[r.random(len(b)) > r.choice([0, .05, .15])], number(r.integers(0, 5)))))
            if len(b):
                sets.append(b)
        if not sets:
            continue
        plain = [set(s.tolist()) for s in sets]
        links = trie.Links(len(sets))
        for i, j in trie.join_sets(sets, percent):
            assert links.root(i) != links.root(j)
            assert 100 * len(plain[i] & plain[j]) >= percent * len(plain[i] | plain[j])
            links.join(i, j)
        assert [links.root(i) for i in range(len(sets))] == brute_groups(plain, percent)


@pytest.mark.parametrize("block", [trie.BLOCK_TOKENS, 600])
def test_prefix_tree_join_equals_brute_force(make, texts, block):
    r = random.Random(8)
    base = texts[8].split()
    near = []
    for _ in range(30):          # a chain of copies, the ends of which are far apart
        k = r.randrange(len(base))
        base = base[:k] + ["changed"] + base[k + 1:]
        near.append(" ".join(base))
    wide = [" ".join(w if r.random() > 0.07 else "other" + w for w in base) for _ in range(20)]
    rows = [(i, t, "s") for i, t in enumerate(texts + near + wide)]
    rows += [(None, near[3], None), (None, "a text of nobody at all", None), (5, near[10], "s"), (rows[-1][0], rows[-1][1], "s")]
    sets = [shingles(t) for _, t, _ in rows]
    group = brute_groups(sets, 85)
    least = {}
    for (i, _, _), g in zip(rows, group):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    want = sorted(((i, len(s), least.get(g) if s else i) for (i, _, _), s, g in zip(rows, sets, group)), key=str)
    got = sorted(map(tuple, trie.joined(make(rows), block_tokens=block).collect()), key=str)
    assert got == want
    assert len({w[2] for w in want}) < len(want) - 30


def test_prefix_tree_join_of_an_empty_table(make):
    assert trie.joined(make([])).count() == 0


def test_sets_of_long_chunks_are_made_a_megabyte_at_once():
    """What hashing holds follows the text hashed at once, and stays with the task; the sets are the same."""
    from plumbline.llm import common
    from plumbline.llm.near import shingle_sets

    common.release_memory()
    texts = [(f"word{i} other{i % 7} " * 5000).encode() for i in range(40)]
    runs = trie._in_runs(texts, 4)
    assert len(common._POWERS["up"]) <= 2 << 20
    assert all((a == b).all() for a, b in zip(runs, shingle_sets(texts, 4), strict=True))
