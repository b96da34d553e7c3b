"""Personal data, pages and fingerprints against plain versions."""

import hashlib
import random
import re

import pytest

from plumbline.llm import fingerprint, pages, private

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])               # noqa: E731
    out = [(0, m) for m in re.finditer(EMAIL, text)]
    out += [(1, m) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, m) for m in re.finditer(CARD, text) if 13 <= len(digits(m)) <= 19 and private.luhn(digits(m))]
    out += [(3, m) for m in re.finditer(PHONE, text) if 9 <= len(digits(m)) <= 15]
    return [(k, m.start(), m.end()) for k, m in out]


def test_base_rules_equal_their_patterns():
    r = random.Random(5)
    for alphabet in ("a@.-b1", "0123456789.- ", "+1234567890() .-x", "aB1.%+-@ ()0123_é"):
        for _ in range(3000):
            text = "".join(r.choice(alphabet) for _ in range(r.randrange(60)))
            assert private.base_spans(text) == plain(text)


def test_long_runs_stay_linear():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "a@" * 150_000):
        private.base_spans(text)


def test_added_spans(make):
    judge = private.Judge.fit(["the quick brown fox and others of this kind went home"] * 5)
    hit = ["write to john (at) example (dot) com please", "call (415) 555-0123 today", "host 10[.]1[.]2[.]3 is down"]
    miss = ["order no 4111.1111.1111.1112 shipped", "on 2024-10-12 we met", "at home. And so on", "version 1.2.3 of it", ""]
    assert all(judge.added(t, private.base_spans(t)) for t in hit)
    assert not any(judge.added(t, private.base_spans(t)) for t in miss)
    docs = make([(1, "a@b.org and call (415) 555-0123", "s"), (None, None, "s"), (2, "", "s")])
    rows = {r.doc_id: r for r in private.found(docs, judge).collect()}
    assert rows[1].n_email == 1 and rows[1].spans.startswith("email:0:7") and "phone:" in rows[1].spans
    assert rows[1].base_sha256 == hashlib.sha256(b"email:0:7").hexdigest() and rows[2].spans == "" and rows[None].n_card == 0
    assert private.redacted("a@b.org and", "email:0:7") == "[email] and"
    assert private.found(make([]).limit(0), judge).count() == 0


def test_written_forms_stand_alone(monkeypatch):
    words = ["the quick brown fox and others of this kind went home"] * 5
    judge = private.Judge.fit(words)
    for value in ("john (at) example.com", "john [at] example.com"):        # nothing else stands in the text
        for text in (value, f"write to {value} please"):
            at = text.index("john")
            assert judge.added(text, private.base_spans(text)) == [(0, at, at + len(value))]
    text = "john AT example.com"
    assert (0, 0, len(text)) in private.proposals(text)
    text = "host fade:cafe:beef:abba:dead:face:bead:deaf is down"
    assert (1, 5, 44) in private.proposals(text)
    assert all(m >= u for m, u in zip(judge.missed, judge.unproposed, strict=True))
    monkeypatch.setitem(private._PROPOSE, "email", re.compile("(?!)"))
    blind = private.Judge.fit(words, 400)
    assert blind.missed[0] == blind.unproposed[0] == sum(k == 0 and personal for _, k, _, _, personal in private._examples(words, 400))


def page(body):
    return f"<html><head><title>t</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_marks_and_templates(spark, make):
    box = "<div><p>Read our terms today</p></div>"
    rows = [(i, f"https://h.example/{i}", page(f"<nav><ul><li>menu</ul></nav>{box}<div class='ad x'>buy</div>"
                                               f"<p>Story {i} &amp; more<br>text<p>second\n  part <b>bold</b> {i}</p><footer>foot</footer>"), 0)
            for i in range(8)]
    rows += [(100, None, None, 0), (101, "https://h.example/x", "", 0), (None, "ftp://u@Other.example:21/a", "plain <b>text", 0),
             (102, "https://one.example/", page("<header>top</header><article><header><h1>Title</h1></header><p>a &lt; b</p>"
              "<aside>side</aside><form>f</form><script>var x='<p>no</p>'</script><div id='comments'><p>me too</p></div></article><p>out</p>"), 0)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in pages.extracted(table).collect()}
    for i in range(8):
        text = f"Story {i} & more text\nsecond part bold {i}"
        assert got[i] == (f"https://h.example/{i}", text, len(text))
    assert got[100] == (None, "", 0) and got[101][1] == "" and got[None][1] == "plain text" and got[102][1] == "Title\na < b"
    assert pages.extracted(table.limit(0)).count() == 0


def test_host_names():
    assert [pages.host_of(u) for u in ("http://A.b:80/x", "https://u:p@c.d?q", None, "/rel")] == ["a.b", "c.d", "", ""]


def test_peeling_recovers_differences():
    r = random.Random(4)
    for a, b in ((0, 0), (3, 3), (40, 39), (200, 10), (5, 400)):
        common = [r.getrandbits(64) for _ in range(100)]
        left, right = common + [r.getrandbits(64) for _ in range(a)], common + [r.getrandbits(64) for _ in range(b)]
        cells = 4096
        got = fingerprint.Sketch.of(left, 1, cells).less(fingerprint.Sketch.of(right, 1, cells), cells).peeled()
        assert tuple(map(set, got)) == (set(left) - set(common), set(right) - set(common))


def test_fingerprint_texts_and_round_trips(texts):
    for t in texts:
        assert "".join(fingerprint.paragraphs(t or "")) == (t or "")
        own = fingerprint.digests(t or "")
        sketch = fingerprint.Sketch.of(own, len(t or ""))
        again = fingerprint.Sketch.parse(sketch.text())
        assert (again.counts, again.keys, again.checks, again.length) == (sketch.counts, sketch.keys, sketch.checks, sketch.length)
        assert fingerprint.likeness(sketch, again, own, own) == 1.0


def test_edited_texts(make, texts):
    docs = make([(i * 3, t, "s") for i, t in enumerate(texts)], parts=5)
    got = {r.doc_id: r for r in fingerprint.compared(docs).collect()}
    for i, t in enumerate(texts):
        t, following = t or "", texts[(i + 1) % len(texts)] or ""
        edited = t[:len(t) - len(t) // 4] + following[:len(t) // 4]
        r = got[i * 3]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if len(t) > 1500 and "same" not in t:
            assert r.near_edited > 0.5
    assert fingerprint.compared(make([]).limit(0)).count() == 0
    one = fingerprint.compared(make([(7, "alone here", "s")])).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(7, pytest.approx(1.0))]
    twice = fingerprint.compared(make([(1, "b", "s"), (1, "b", "s"), (None, "c", "s")])).collect()
    assert sorted(str(r.doc_id) for r in twice) == ["1", "1", "None"]
