"""Near-duplicates and repeated strings against brute force."""

import hashlib
import itertools
import re
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import near, repeats
from plumbline.llm.common import Buffer


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + width]) for k in range(len(words) - width + 1)}


def roots(sets, percent):
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}


@pytest.mark.parametrize("block", [near.BLOCK, 3])
def test_components_equal_brute_force(make, texts, block):
    docs = make(list((i, t, "s") for i, t in enumerate(texts)))
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    want = roots(sets, 85)
    got = near.near_duplicates(docs, block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {
        i: (len(s), want[i], want[i] == i) for i, s in sets.items()}


def test_null_ids_repeated_rows_and_empty_tables(make):
    docs = make([(1, "a b c d e f", "s"), (1, "a b c d e f", "s"), (None, "a b c d e f", "s"), (None, None, "s"), (3, None, "s")])
    got = sorted(((r.doc_id or 0, r.component_id, r.kept) for r in near.near_duplicates(docs).collect()), key=str)
    assert got == [(0, 1, False), (0, None, False), (1, 1, True), (1, 1, True), (3, 3, True)]
    assert near.near_duplicates(make([]).limit(0)).count() == 0
    assert sorted(r.doc_id or 0 for r in near.one_of_each(docs).collect()) == [0, 0, 1, 3]


def test_one_of_each_tells_rows_apart(make):
    base, other, third = (" ".join(f"{c}{i}" for i in range(120)) for c in "abc")
    docs = make([(4, base, "s"), (4, other, "s"), (2, base + " tail", "s"), (-1, third, "s"), (6, third, "t"), (7, "x y", "s"), (7, "x y", "s"),
                 (None, "n " + " ".join(f"n{i}" for i in range(120)), "s"), (None, " ".join(f"n{i}" for i in range(120)), "s"), (8, None, "s")])
    got = Counter((r.doc_id, (r.text or "").split(" ")[0][:1]) for r in near.one_of_each(docs).collect())
    assert got == Counter([(2, "a"), (4, "b"), (-1, "c"), (7, "x"), (None, "n"), (8, "")])


def test_sketches_estimate_high_similarity():
    r = np.random.default_rng(1)
    for size, share in ((300, 0.9), (3000, 0.85), (20000, 0.85)):
        common = int(size * 2 * share / (1 + share))
        pool = np.unique(r.integers(1, 2**64 - 1, 2 * size, dtype=np.uint64))
        r.shuffle(pool)
        a, b = np.sort(pool[:size]), np.sort(np.concatenate((pool[:common], pool[size:2 * size - common])))
        _, sketches = near._signatures([a, b])
        guess = near.estimates(sketches[:1], sketches[1:], np.array([float(size)]), np.array([float(size)]))[0]
        assert abs(guess - share) < near.MARGIN / 2


def brute_repeats(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + 200] for b in data for i in range(len(b) - 199))
    out = []
    for b in data:
        cover = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                cover[i:i + 200] = True
        kept = bytes(x for x, c in zip(b, cover) if not c)
        out.append((len(b), int(cover.sum()), int((np.diff(cover.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [repeats.HOT, 1])
def test_repeats_equal_brute_force(make, texts, hot, monkeypatch):
    level = repeats._answers
    monkeypatch.setattr(repeats, "HOT", hot)        # read on the driver: the tasks get the module by import
    docs = make(list((i, t, "s") for i, t in enumerate(texts)))
    got = {r.doc_id: r[1:] for r in repeats.without_repeats(docs).collect()}
    assert level is repeats._answers and [got[i] for i in range(len(texts))] == brute_repeats(texts)


def test_frequent_anchors_are_split_without_loss(texts):
    buffer = Buffer.of([(t or "").encode() for t in texts])
    start, count, at, keys = repeats.runs(buffer)
    s, n, a, k = repeats._split_hot(start, count, at, keys, np.ones(len(start), bool))
    whole = np.sort(np.concatenate([np.arange(x, x + y) for x, y in zip(start, count)]))
    assert (np.sort(np.concatenate([np.arange(x, x + y) for x, y in zip(s, n)])) == whole).all()
    assert ((a - s) // repeats.HOT_STEP == (a - s - n + 1) // repeats.HOT_STEP).all()


def test_repeats_of_odd_tables(make):
    assert repeats.without_repeats(make([]).limit(0)).count() == 0
    long = "x" * 450
    got = repeats.without_repeats(make([(None, long, "s"), (2, None, "s"), (2, "y" * 199, "s")]), keep_text=True).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed, bytes(r.kept)) for r in got) == [
        (0, 450, 450, b""), (2, 0, 0, b""), (2, 199, 0, b"y" * 199)]


def test_sql_gives_the_same_groups(spark, make):
    import os

    import duckdb

    from plumbline.llm.queries import QUERIES, SQL

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    name = "op3_minhash_odd_sketch"
    assert sorted(con.sql(SQL[name]).fetchall()) == sorted(map(tuple, QUERIES[name](spark, folder).collect()))
