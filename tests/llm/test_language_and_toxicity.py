"""Language-model scores against brute force, and the classifier on separable labels."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import language, toxicity


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["</s>"]


def test_scores_equal_a_plain_model(make, texts, monkeypatch):
    docs = make([(i, t, "s") for i, t in enumerate(texts)])
    learned = {}
    plain = language.learn_weights
    monkeypatch.setattr(language, "learn_weights", lambda *a: learned.setdefault("w", plain(*a)))
    got = {r.doc_id: r for r in language.scored(docs).collect()}
    lines = [tokens(t) for t in texts]
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    one, two = Counter(), Counter()
    for line, out in zip(lines, held):
        if not out:
            one.update(line)
            two.update(zip(["<s>", *line], line))
    n, v, starts = sum(one.values()), len(one), held.count(False)
    weights = learned["w"]
    assert np.allclose(weights.sum(axis=1), 1)
    for i, line in enumerate(lines):
        r = got[i]
        base = sum(math.log10((one[w] + 0.1) / (n + 0.1 * (v + 1))) for w in line)
        score = 0.0
        for before, w in zip([None, *line], line):
            context = starts if before is None else one[before]
            bucket = min(int(math.log2(context)) + 1, language.BUCKETS - 1) if context else 0
            a, b, c = weights[bucket]
            pair = two[("<s>" if before is None else before, w)] / context if context else 0
            score += math.log10(a * pair + b * one[w] / n + c / (v + 1))
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(line), sum(one[w] > 0 for w in line), n)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)


def test_bound_query_mixes_trigrams(spark, make, texts, monkeypatch, tmp_path):
    from plumbline.llm.queries import QUERIES

    few = [t for t in texts if len(t or "") < 3000] * 2
    make([(i, t, "s") for i, t in enumerate(few)]).write.parquet(f"{tmp_path}/documents.parquet")
    learned = {}
    plain = language.learn_weights
    monkeypatch.setattr(language, "learn_weights", lambda *a: learned.setdefault("w", plain(*a)))
    got = {r.doc_id: r.score for r in QUERIES["op2_deleted_interpolation"](spark, str(tmp_path)).collect()}
    counts = [Counter(), Counter(), Counter()]
    lines = [["<s>", "<s>", *tokens(t)] for t in few]
    for i, line in enumerate(lines):
        if zlib.crc32(str(i).encode()) % 10:
            for k in range(3):
                counts[k].update(tuple(line[j - k:j + 1]) for j in range(2, len(line)))
    n, v, starts = sum(counts[0].values()), len(counts[0]), counts[0][("</s>",)]
    for i, line in enumerate(lines):
        score = 0.0
        for j in range(2, len(line)):
            seen = [n, *[starts if j == 2 else counts[k - 1][tuple(line[j - k:j])] for k in (1, 2)]]
            p = [counts[k][tuple(line[j - k:j + 1])] / seen[k] if seen[k] else 0 for k in (2, 1, 0)]
            bucket = min(int(math.log2(seen[2])) + 1, language.BUCKETS - 1) if seen[2] else 0
            score += math.log10(sum(a * b for a, b in zip(learned["w"][bucket], [*p, 1 / (v + 1)], strict=True)))
        assert got[i] == pytest.approx(score)


def test_em_finds_the_mixture():
    r = np.random.default_rng(2)
    cells = []
    for _ in range(20_000):
        first = r.random() < 0.7        # 70 % of the tokens come from the first component
        level = (8, 40) if first else (60, 20)
        cells.append((5 * language.LEVELS + level[0]) * language.LEVELS + level[1])
    values, n = np.unique(cells, return_counts=True)
    w = language.learn_weights(lambda weights: language.expected_counts(values, n, weights, 2, 10**6), 2)[5]
    assert w[0] == pytest.approx(0.7, abs=0.1) and w[1] > 0.2 and w[2] < 0.02


def test_higher_order_and_odd_tables(make):
    docs = make([(i, t, "s") for i, t in enumerate(["a b c a b c a b d", "a b c", None, "", "x y"] * 12)])
    assert language.scored(docs, order=3).filter("score is null or score > 0").count() == 0
    assert language.scored(make([]).limit(0)).count() == 0
    got = language.scored(make([(None, "a a", "s"), (None, "a a", "s")])).collect()
    assert [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in got] == [(None, 3, 3, 6)] * 2


@pytest.fixture(scope="module")
def labelled():
    r = random.Random(3)
    words = ["".join(r.choice("aeioulmnrst") for _ in range(r.randrange(2, 8))) for _ in range(400)]
    rows = []
    for i in range(900):
        text = [r.choice(words) for _ in range(r.randrange(3, 160))]
        bad = i % 4 == 0
        if bad:
            for _ in range(r.randrange(1, 4)):
                text.insert(r.randrange(len(text) + 1), r.choice(("grobble", "snarkit", "GROBBLE!!", "zorgface", "zorgmouth")))
        rows.append((i, " ".join(text), int(bad)))
    return rows


def test_held_out_labels(spark, make, labelled):
    docs = make([(i, t, "s") for i, t, _ in labelled])
    labels = spark.createDataFrame([(i, y) for i, _, y in labelled] + [(None, 1), (5000, None), (6000, 1)], "doc_id long, toxic int")
    network = toxicity.fitted(docs, labels)
    got = {r.doc_id: r for r in toxicity.scored(docs, network).collect()}
    out = [(got[i].score, y, got[i].predicted) for i, _, y in labelled if got[i].held_out]
    assert {i for i, r in got.items() if r.held_out} == {i for i, _, _ in labelled if zlib.crc32(str(i).encode()) % 3 == 1}
    hits = sum(p == y for _, y, p in out) / len(out)
    assert hits > 0.93
    again = toxicity.scored(docs.repartition(7), network).collect()
    assert {r.doc_id: r.score for r in again} == pytest.approx({i: r.score for i, r in got.items()}, abs=1e-5)
    odd = make([(None, None, "s"), (1, "", "s"), (2, "a " * 50_000, "s")])
    assert all(0 <= r.score <= 1 for r in toxicity.scored(odd, network).collect())
    kept = toxicity.without_toxic(odd, labels.limit(0))
    assert kept.columns == odd.columns and kept.count() == 3
    assert toxicity.scored(make([]).limit(0), network).count() == 0


def test_gradients_agree_with_differences(labelled):
    t = toxicity.tokens([x.encode() for _, x, _ in labelled[:6]])
    net = toxicity.Network.fresh(t.hashes, np.unique(toxicity.pieces(t)[1]))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    text, start = toxicity.windows(t.first)
    at, mask = toxicity.places(t, text, start)
    x = net.vectors(*net.inputs(t)).astype(np.float64)
    y = np.arange(len(at)) % 2.0

    def loss():
        z = net.forward(x @ net.p["wx"] + net.p["bx"], at, mask)
        return np.mean(np.log1p(np.exp(z)) - y * z)

    g, gx, _ = net.gradients(x, at, mask, y)
    for name in ("wx", "bx", "wh", "wa", "va", "wo", "bo"):
        flat = net.p[name].reshape(-1)
        for i in (0, len(flat) // 2, len(flat) - 1):
            keep = flat[i]
            flat[i] = keep + 1e-4
            up = loss()
            flat[i] = keep - 1e-4
            down = loss()
            flat[i] = keep
            assert g[name].reshape(-1)[i] == pytest.approx((up - down) / 2e-4, abs=2e-5)


def test_windows_cover_every_word():
    for n in (0, 1, 47, 48, 49, 80, 81, 500):
        text, start = toxicity.windows(np.array([0, n]))
        seen = {i for s in start for i in range(s, min(n, s + toxicity.WINDOW))}
        assert seen == set(range(n)) and len(text) >= 1


def test_words_of_long_chunks_are_hashed_a_megabyte_at_once():
    """What hashing holds follows the text hashed at once, and stays with the task; hashes and counts are the same."""
    from plumbline.llm import common

    common.release_memory()
    buffer = common.Buffer.of([(f"Word{i} other{i % 7} " * 5000).encode() if i % 3 else b"" for i in range(40)])
    hashes, counts = language._words(buffer)
    assert len(common._POWERS["up"]) <= 2 << 20
    words = common.words_of(buffer)
    assert (hashes == words.hashes).all() and (counts == np.diff(words.first)).all()
