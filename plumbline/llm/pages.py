"""Main text of web pages: templates of a site go, then everything that its marks call no article.

A page is read into a tree of block elements. Each subtree has a hash of its tags, classes and text. Spark counts, per host,
on how many pages a subtree stands; one that recurs on at least ``SHARE`` of the host's pages, and on at least ``LEAST_PAGES``, is
part of the site's template and is deleted. Of the rest, elements whose tag, role or class marks them as menus, headers, footers, sidebars,
notices, adverts, forms, scripts or reader comments are left out, and the text is that of the article (else of the main
element, else of the body).

Counting goes by chunks of pages: a chunk asks each range of hashes once for its distinct (host, subtree) pairs, and the
answers meet the chunk again, so a host with most of the pages is no hot key.
"""

from __future__ import annotations

import html as references
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import (clip_range, gaps, groups, pack, pack_documents, power_of_two, total_bytes, undo_gaps, unpack,
                                  unpack_documents, whole_groups)

SHARE = 0.5
LEAST_PAGES = 5
RANGE_BYTES = 32 << 20
LEAST_RANGES = 64

# Elements of HTML and marks in use on the web.
BLOCKS = frozenset("html body head title article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
                   "caption blockquote pre figure figcaption address details summary fieldset legend hr center nav header footer aside "
                   "form button select option optgroup textarea label dialog menu iframe object canvas svg audio video noscript template".split())
RAW = frozenset(("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("head title script style nav footer aside form button select option optgroup textarea label dialog menu iframe "
                    "object canvas svg audio video noscript template xmp noembed noframes".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
MARKS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar side-bar rail menu nav navbar "
                  "navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices banner alert popup "
                  "modal overlay newsletter subscribe subscription signup sign-up login share sharing social comment comments respond "
                  "discussion disqus related recommended widget toolbar pagination pager skip-link paywall".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "thead": ("tbody", "tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"),
          "tfoot": ("tbody", "tr", "td", "th")}
WALLS = frozenset(("table", "ul", "ol", "dl", "menu", "article", "section", "div", "main", "body", "select"))

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


class Node:
    __slots__ = ("tag", "marks", "role", "items", "up", "hash")

    def __init__(self, tag: str, attributes: str, up: int):
        self.tag, self.up, self.hash = tag, up, 0
        self.items: list = []           # text, or the number of a child
        self.marks, self.role = "", ""
        if attributes:
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
            self.marks = f"{found.get('class', '')} {found.get('id', '')}".lower().strip()
            self.role = found.get("role", "").lower()


def tree(page: str) -> list[Node]:
    """Block elements in page order, the first one the page itself; a child's number is greater than its parent's."""
    nodes = [Node("html", "", -1)]
    stack, open_ = [0], {"html": 1}
    at = 0

    def pop() -> None:
        open_[nodes[stack.pop()].tag] -= 1

    def text(value: str) -> None:
        if value:
            nodes[stack[-1]].items.append(references.unescape(value) if "&" in value else value)

    while True:
        m = _TAG.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if open_.get(tag, 0) and tag != "html":
                while nodes[stack[-1]].tag != tag:
                    pop()
                pop()
            continue
        if tag in RAW:
            end = re.compile(f"</{tag}[^>]*>|\\Z", re.I).search(page, at)
            at = end.end()
            continue
        if tag not in BLOCKS:
            if tag == "br":
                nodes[stack[-1]].items.append(" ")
            continue
        if tag in ("html", "body"):
            continue
        if open_.get("p", 0):           # a block ends an open paragraph
            while nodes[stack[-1]].tag == "p":
                pop()
        for other in CLOSES.get(tag, ()):
            if open_.get(other, 0):
                for depth in range(len(stack) - 1, 0, -1):
                    found = nodes[stack[depth]].tag
                    if found == other:
                        while len(stack) > depth:
                            pop()
                        break
                    if found in WALLS:
                        break
        node = Node(tag, m[3], stack[-1])
        nodes[stack[-1]].items.append(len(nodes))
        if tag not in VOID and not m[3].endswith("/"):
            stack.append(len(nodes))
            open_[tag] = open_.get(tag, 0) + 1
        nodes.append(node)
    for node in reversed(nodes):
        content = [f"{nodes[i].hash:x}" if isinstance(i, int) else " ".join(i.split()) for i in node.items]
        node.hash = xxhash.xxh64_intdigest("\x01".join([node.tag, node.marks, *content]).encode("utf-8", "surrogatepass"))
    return nodes


def _left_out(node: Node, inside: bool) -> bool:
    """Whether an element is no part of an article; ``inside``: within the article, where a header is its own."""
    if node.tag in DROPPED or node.role in ROLES or (node.tag == "header" and not inside):
        return True
    marks = set(re.split(r"\s+", node.marks)) if node.marks else ()
    hit = {m for m in marks if m in MARKS} | {p for m in marks for p in re.split("[-_]+", m) if p in MARKS}
    if inside:
        hit.discard("header")
    return bool(hit) and node.tag not in ("article", "main") or "comment" in hit or "comments" in hit


def main_text(nodes: list[Node], template: set[int]) -> str:
    """Blocks of the article, one per line."""
    inside, gone = [False] * len(nodes), [False] * len(nodes)
    for i, node in enumerate(nodes):
        if i:
            inside[i] = inside[node.up] or node.tag in ("article", "main") or node.role in ("main", "article")
            gone[i] = gone[node.up] or node.hash in template or _left_out(node, inside[node.up])
    for wanted in ("article", "main", "html"):
        roots = [i for i, node in enumerate(nodes) if not gone[i] and (node.tag == wanted or node.role == wanted)
                 and not any(nodes[u].tag == wanted for u in _above(nodes, i))]
        blocks: list[str] = []
        for root in roots:
            _collect(nodes, gone, root, blocks)
        if blocks:
            return "\n".join(blocks)
    return ""


def _above(nodes: list[Node], i: int):
    i = nodes[i].up
    while i >= 0:
        yield i
        i = nodes[i].up


def _collect(nodes: list[Node], gone: list[bool], root: int, blocks: list[str]) -> None:
    held: list[str] = []

    def flush() -> None:
        block = " ".join("".join(held).split())
        held.clear()
        if block:
            blocks.append(block)

    stack = [iter(nodes[root].items)]
    while stack:
        for item in stack[-1]:
            if isinstance(item, int):
                flush()
                if not gone[item]:
                    stack.append(iter(nodes[item].items))
                    break
            else:
                held.append(item)
        else:
            flush()
            stack.pop()


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def _key(host: str, value: int) -> int:
    """A (host, subtree) pair; subtree 0 stands for the host's pages. 56 bits."""
    return xxhash.xxh64_intdigest(f"{value:x} {host}".encode("utf-8", "surrogatepass")) & ~0xFF


def _pages(blob: bytes):
    """Id, url and html of a chunk's pages."""
    ids, buffer = unpack_documents(blob)
    data = buffer.data.tobytes()
    for id_, a, n in zip(ids, buffer.starts.tolist(), buffer.lengths.tolist(), strict=True):
        size, _, rest = data[a:a + n].decode("utf-8", "replace").partition(" ")
        yield id_, rest[:int(size)] if int(size) >= 0 else None, rest[max(0, int(size)):]


def extracted(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html", share: float = SHARE,
              least_pages: int = LEAST_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    Null or empty html has no text. Pages without a host count as those of one nameless host. Repeated rows are pages of
    their own and count as such. An empty table gives no rows; other columns are ignored.
    """
    packed = F.concat(F.coalesce(F.char_length(F.col(url)), F.lit(-1)).cast("string"), F.lit(" "), F.coalesce(F.col(url), F.lit("")),
                      F.coalesce(F.col(html).cast("string"), F.lit("")))
    chunks = pack_documents(pages.select(F.col(id_column).cast("long").alias("page_id"), packed.alias("page")), "page_id", "page")
    bits = power_of_two(total_bytes(chunks) / RANGE_BYTES, LEAST_RANGES).bit_length() - 1
    asked = pa.schema([("range", pa.int64()), ("chunk", pa.int64()), ("blob", pa.binary())])
    answered = pa.schema([("chunk", pa.int64()), ("range", pa.int64()), ("blob", pa.binary())])
    result = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def count(batches):
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                keys: list[int] = []
                for _, address, page in _pages(blob):
                    host = host_of(address)
                    keys.extend({_key(host, v) for v in {node.hash for node in tree(page)[1:]}})
                    keys.append(_key(host, 0))
                unique, n = np.unique(np.array(keys, np.uint64), return_counts=True)
                for r, part in clip_range(unique, bits):
                    yield pa.RecordBatch.from_pylist([{"range": r, "chunk": chunk, "blob": pack(
                        keys=gaps(unique[part]), n=n[part].astype(np.uint32))}], asked)

    def add(batches):
        for group in groups(batches, "range"):
            parts = [unpack(b) for b in group.column("blob").to_pylist()]
            held = [undo_gaps(p["keys"]) for p in parts]
            unique, at = np.unique(np.concatenate(held), return_inverse=True)
            total = np.bincount(at, np.concatenate([p["n"] for p in parts]), len(unique)).astype(np.uint32)
            cut = np.cumsum([0] + [len(h) for h in held])
            for i, (chunk, r) in enumerate(zip(group.column("chunk").to_pylist(), group.column("range").to_pylist(), strict=True)):
                yield pa.RecordBatch.from_pylist([{"chunk": chunk, "range": r, "blob": pack(
                    keys=gaps(held[i]), n=total[at[cut[i]:cut[i + 1]]])}], answered)

    def extract(batches):
        for group in groups(batches, "chunk"):
            blobs = group.column("blob").to_pylist()
            replies = [unpack(b) for b in blobs[1:]]
            keys = np.concatenate([undo_gaps(r["keys"]) for r in replies] or [np.zeros(0, np.uint64)])
            total = np.concatenate([r["n"] for r in replies] or [np.zeros(0, np.uint32)])
            often = dict(zip(*(x[total >= least_pages].tolist() for x in (keys, total)), strict=True))
            rows = []
            for id_, address, page in _pages(blobs[0]):
                host = host_of(address)
                nodes = tree(page)
                least = max(least_pages, share * often.get(_key(host, 0), 0))
                template = {n.hash for n in nodes[1:] if often.get(_key(host, n.hash), 0) >= least} if often.get(_key(host, 0)) else set()
                words = main_text(nodes, template)
                rows.append({"page_id": id_, "url": address, "text": words, "n_chars": len(words)})
                if len(rows) == 500:
                    yield pa.RecordBatch.from_pylist(rows, result)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, result)

    answers = whole_groups(chunks.mapInArrow(count, "range long, chunk long, blob binary"), "range", "chunk").mapInArrow(
        add, "chunk long, range long, blob binary")
    both = chunks.select("chunk", F.lit(-1).cast("long").alias("range"), "blob").unionByName(answers)
    return whole_groups(both, "chunk", "range").mapInArrow(extract, "page_id long, url string, text string, n_chars long")
