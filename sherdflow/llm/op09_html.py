"""HTML extraction by wrapper induction.

Pages of one host are made by one wrapper. Each host's wrapper is one of its pages (no longer than max_wrapper
characters if there is such a page; the least hash of those). The DOM tree of every page is aligned to its host's
wrapper by simple tree matching: the mapping of greatest weight that keeps levels and the order of siblings, between
nodes of equal tags; subtrees that are equal, text included, weigh double among their siblings. What alignment tells
over all pages of a host decides:

* Text nodes that nearly always have one text are template.
* From the root, the container that holds most of its parent's text over all pages is followed down, until most pages
  have varying paragraphs or headings right there: that wrapper node is the host's main slot. Text outside goes.

Meaning comes second: inside the slot, elements that are boilerplate by tag, role, class or id go, too. It decides by
itself only for hosts of fewer than min_pages pages and for pages whose alignment leaves nothing in the slot: there,
text outside an article or main element goes, if the page fills one.

An article may be a copy of the wrapper's: a page whose largest block of text equals the wrapper's by more than
`copied` of its characters says nothing about what is template inside the slot and isn't counted there, and a text
that would go altogether is kept.

Matching is exact and not recursive: weights of two different subtrees are kept by their shapes, equal siblings at
both ends are paired at once, rows of the table are vectors, and tables of over MAX_CELLS are halved (memory is then
in proportion to one list of siblings).

Hot hosts: counts are combined before the shuffle and pages are never grouped by host. Wrappers join pages by
broadcast while all of them are less than BROADCAST_CHARS, beyond that by a shuffle that may be split.

Cases: null or empty html: empty text; null url or one without a host: the host is empty, such pages share a wrapper;
unclosed or cut-off markup is repaired (p, li and the like end at the next block, an end tag ends what is open inside
it); very long, deep or wide pages are read and aligned whole; ties and repeated rows: each row alone, equal pages of
a host give equal texts; hosts with fewer than min_pages pages have no wrapper; empty table: empty result; extra
columns: only the three named ones are read.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._io import checkpoint, table
from ._text import batches
from .op01_urls import host_of

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)", re.S)
ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
RAW = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in ("script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: a start tag of the second kind ends an open element of the first, within the nearest of the third
P_END = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
ENDS = {"p": P_END, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}}
SCOPE = frozenset("ul ol dl table select body html article section div td th".split())
BOILER_TAGS = frozenset("nav footer aside form script style noscript template head title iframe svg button select textarea option menu dialog object canvas math noembed noframes xmp".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog".split())
BOILER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu menus nav navbar navigation breadcrumb breadcrumbs sidebar footer header masthead "
    "cookie cookies consent notice notices gdpr popup modal overlay comment comments disqus respond replies share sharing social related recommended newsletter subscribe subscription signup login pagination pager widget toolbar skip".split()
)
MAIN_TAGS = frozenset(["article", "main"])
MEANT = BOILER_TAGS | MAIN_TAGS | {"header"}
#: elements that hold others, and elements that are text
CONTAINERS = frozenset("#root html body div section article main center table tbody tr td".split())
TEXT_BLOCKS = frozenset("#text p h1 h2 h3 h4 h5 h6 blockquote pre".split())
WORDS = re.compile(r"[a-z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """An element, or a text of its block (`#text`); plain: characters of a text that are in no link."""

    __slots__ = ("label", "kids", "text", "kind", "order", "plain", "shape", "content", "size")

    def __init__(self, label: str, kind: str):
        self.label, self.kids, self.text, self.kind, self.order, self.plain = label, [], "", kind, -1, 0


def _kind(tag: str, attrs: str, inside: str) -> str:
    """boiler (by itself), main (by itself or one above) or open, from an element's meaning."""
    if not attrs and tag not in MEANT:
        return "main" if inside == "main" else "open"
    a = {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTR.finditer(attrs)} if "=" in attrs else {}
    if tag in BOILER_TAGS:
        return "boiler"
    role = a.get("role", "").lower()
    if tag in MAIN_TAGS or role == "main":
        own = "main"
    else:
        own = "main" if inside == "main" else "open"
    if role in BOILER_ROLES or "hidden" in attrs and re.search(r"(?<![\w-])hidden(?![\w-])", ATTR.sub("", attrs)) or a.get("aria-hidden") == "true" or HIDDEN.search(a.get("style", "")):
        return "boiler"
    if tag == "header" and inside != "main":
        return "boiler"
    if tag not in ("body", "html", "main"):
        for name in (a.get("class", "") + " " + a.get("id", "")).lower().split():
            words = WORDS.findall(name)
            if words and (words[0] in BOILER_NAMES or words[-1] in BOILER_NAMES):
                return "boiler"
    return own


def parse(page: str) -> Node:
    """A tree of blocks: text of inline elements belongs to the block around it, in `#text` children."""
    root = Node("#root", "open")
    stack: list[tuple[str, Node]] = [("#root", root)]  # inline elements share their block's node
    buf: list[str] = []
    links = linked = 0  # open links, characters of buf inside of them

    def flush() -> None:
        nonlocal linked
        if buf:
            text = " ".join(entities.unescape("".join(buf)).split())
            buf.clear()
            if text:
                leaf = Node("#text", "main" if stack[-1][1].kind == "main" else "open")
                leaf.text, leaf.plain = text, max(0, len(text) - linked)
                stack[-1][1].kids.append(leaf)
            linked = 0

    def close(depth: int) -> None:
        nonlocal links
        while len(stack) > depth:
            tag, node = stack[-1]
            links -= tag == "a"
            if node is not stack[-2][1]:
                flush()
            stack.pop()

    at = 0
    n = len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            buf.append(page[at:])
            break
        if lt > at:
            buf.append(page[at:lt])
            linked += (lt - at) if links else 0
        m = TOKEN.match(page, lt)
        if not m:
            buf.append("<")
            at = lt + 1
            continue
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
                if stack[i][0] in SCOPE and tag not in SCOPE and tag != "p":
                    break
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                buf.append(" ")
                if tag == "hr":
                    flush()
            continue
        if tag in INLINE:
            boiler = ("=" in m[3] or "hidden" in m[3]) and _kind(tag, m[3], stack[-1][1].kind) == "boiler"
            links += tag == "a"
            if not boiler:
                stack.append((tag, stack[-1][1]))
                continue
        for i in range(len(stack) - 1, 0, -1):
            if tag in ENDS.get(stack[i][0], ()):
                close(i)
                break
            if stack[i][0] in SCOPE:
                break
        flush()
        node = Node(tag, _kind(tag, m[3], stack[-1][1].kind))
        stack[-1][1].kids.append(node)
        if tag in RAW:
            end = RAW[tag].search(page, at)
            at = end.start() if end else n
            gt = page.find(">", at)
            at = gt + 1 if gt >= 0 else n
            continue
        stack.append((tag, node))
    close(1)
    flush()
    return root


def number(root: Node) -> list[Node]:
    """Nodes in page order; sets their numbers, sizes, shapes (tags alone) and contents (with texts)."""
    out: list[Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        node.order = len(out)
        out.append(node)
        stack.extend(reversed(node.kids))
    for node in reversed(out):
        node.size = 1 + sum(x.size for x in node.kids)
        node.shape = hash((node.label, *[x.shape for x in node.kids]))
        node.content = hash((node.label, node.text, *[x.content for x in node.kids]))
    return out


def _ends(p: list[int], q: list[int]) -> tuple[int, int]:
    """How many neighbours at the front and at the back are equal; some best alignment pairs them."""
    n = min(len(p), len(q))
    head = next((i for i in range(n) if p[i] != q[i]), n)
    n -= head
    tail = next((i for i in range(n) if p[-1 - i] != q[-1 - i]), n)
    return head, tail


class Matcher:
    """Simple tree matching of two numbered trees."""

    MAX_CELLS = 4 << 20
    MEMORY = 100_000

    def __init__(self):
        self.known: dict[tuple[int, int], int] = {}  # weights of pairs of shapes

    # --- weights by shapes ------------------------------------------------------------------------------------
    def _now(self, a: Node, b: Node) -> int | None:
        """The weight of a pair by shapes, if it needs no table."""
        if a.label != b.label:
            return 0
        if a.shape == b.shape:
            return a.size
        if not a.kids or not b.kids:
            return 1
        return self.known.get((a.shape, b.shape))

    def weight(self, a: Node, b: Node) -> int:
        """Nodes in the largest mapping of two trees, by tags alone."""
        stack = [(a, b)]
        while stack:
            x, y = stack[-1]
            if self._now(x, y) is not None:
                stack.pop()
                continue
            ps, qs = [k.shape for k in x.kids], [k.shape for k in y.kids]
            head, tail = _ends(ps, qs)
            p, q = x.kids[head : len(ps) - tail], y.kids[head : len(qs) - tail]
            sure = sum(k.size for k in x.kids[:head]) + sum(k.size for k in x.kids[len(ps) - tail :])
            up, uq = {k.shape: k for k in p}, {k.shape: k for k in q}
            table = {(s, t): self._now(k, m) for s, k in up.items() for t, m in uq.items()}
            open_ = [(up[s], uq[t]) for (s, t), w in table.items() if w is None]
            if open_:
                stack += open_
                continue
            best = 0
            if p and q:
                ip, iq = {s: i for i, s in enumerate(up)}, {t: i for i, t in enumerate(uq)}
                w = np.array([[table[s, t] for t in uq] for s in up])
                best = int(self._last(w, np.array([ip[k.shape] for k in p]), np.array([iq[k.shape] for k in q]))[-1])
            self.known[x.shape, y.shape] = 1 + sure + best
            stack.pop()
        return self._now(a, b)

    @staticmethod
    def _last(w: np.ndarray, p: np.ndarray, q: np.ndarray, twin: tuple | None = None) -> np.ndarray:
        """Last row of the alignment table: best weight of all of p with each front of q (0 to len(q))."""
        row = np.zeros(len(q) + 1, np.int64)
        for i in range(len(p)):
            row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + Matcher._row(w, p, q, twin, i)))
        return row

    @staticmethod
    def _row(w: np.ndarray, p: np.ndarray, q: np.ndarray, twin: tuple | None, i: int) -> np.ndarray:
        own = w[p[i]][q]
        return own if twin is None else np.where(twin[1] == twin[0][i], 2 * twin[2][i], own)

    # --- alignment --------------------------------------------------------------------------------------------
    def siblings(self, p: list[Node], q: list[Node]) -> list[tuple[Node, Node]]:
        """Pairs of the best alignment of two lists of siblings; equal subtrees weigh double."""
        head, tail = _ends([k.content for k in p], [k.content for k in q])
        out = list(zip(p[:head], q[:head])) + (list(zip(p[-tail:], q[-tail:])) if tail else [])
        p, q = p[head : len(p) - tail], q[head : len(q) - tail]
        if not p or not q:
            return out
        up, uq = {k.shape: k for k in p}, {k.shape: k for k in q}
        if len(up) == len(uq) == 1 and up.keys() == uq.keys() and {k.content for k in p}.isdisjoint(k.content for k in q):
            return out + list(zip(p, q))  # all pairs weigh the same
        ip, iq = {s: i for i, s in enumerate(up)}, {t: i for i, t in enumerate(uq)}
        w = np.array([[self.weight(k, m) for m in uq.values()] for k in up.values()])
        sp, sq = np.array([ip[k.shape] for k in p]), np.array([iq[k.shape] for k in q])
        twin = np.array([k.content for k in p]), np.array([k.content for k in q]), np.array([k.size for k in p])
        return out + [(p[i], q[j]) for i, j in self._pairs(w, sp, sq, twin)]

    def _pairs(self, w: np.ndarray, p: np.ndarray, q: np.ndarray, twin: tuple) -> list[tuple[int, int]]:
        out, todo = [], [(0, len(p), 0, len(q))]
        while todo:
            a, z, b, y = todo.pop()
            if a == z or b == y:
                continue
            part = lambda a, z, b, y: (w, p[a:z], q[b:y], (twin[0][a:z], twin[1][b:y], twin[2][a:z]))
            if (z - a) * (y - b) > self.MAX_CELLS and z - a > 1:
                mid = (a + z) // 2
                front = self._last(*part(a, mid, b, y))
                _, p2, q2, (t0, t1, t2) = part(mid, z, b, y)
                back = self._last(w, p2[::-1], q2[::-1], (t0[::-1], t1[::-1], t2[::-1]))[::-1]
                cut = b + int(np.argmax(front + back))
                todo += [(a, mid, b, cut), (mid, z, cut, y)]
                continue
            args = part(a, z, b, y)
            rows = np.zeros((z - a + 1, y - b + 1), np.int64)
            for i in range(z - a):
                rows[i + 1, 1:] = np.maximum.accumulate(np.maximum(rows[i, 1:], rows[i, :-1] + self._row(*args, i)))
            i, j = z - a, y - b
            while i and j:
                if rows[i, j] == rows[i - 1, j]:
                    i -= 1
                elif rows[i, j] == rows[i, j - 1]:
                    j -= 1
                else:
                    out.append((a + i - 1, b + j - 1))
                    i, j = i - 1, j - 1
        return out

    def __call__(self, a: Node, b: Node) -> list[tuple[Node, Node]]:
        """Pairs of the mapping, parents before children."""
        if len(self.known) > self.MEMORY:
            self.known.clear()
        pairs, stack = [], [(a, b)] if a.label == b.label else []
        while stack:
            x, y = stack.pop()
            pairs.append((x, y))
            if len(x.kids) == len(y.kids) == 1:
                stack += zip(x.kids, y.kids) if x.kids[0].label == y.kids[0].label else ()
            elif x.kids and y.kids:
                stack += self.siblings(x.kids, y.kids)
        return pairs


def slots(root: Node) -> list[Node]:
    """Text nodes below root in page order, without boilerplate elements (root itself may be one)."""
    out, stack = [], [root]
    while stack:
        x = stack.pop()
        if x.text:
            out.append(x)
        stack.extend(k for k in reversed(x.kids) if k.kind != "boiler")
    return out


def plain_chars(nodes: list[Node]) -> list[int]:
    """Of numbered nodes: characters below each that are in no link."""
    out = [x.plain for x in nodes]
    for x in reversed(nodes):
        out[x.order] += sum(out[k.order] for k in x.kids)
    return out


def largest_block(nodes: list[Node], chars: list[int]) -> Node:
    """From the root down the container with most of the text, until there is text right there."""
    x = nodes[0]
    while not any(k.label in TEXT_BLOCKS and chars[k.order] for k in x.kids):
        k = next((k for k in x.kids if k.label in CONTAINERS and 2 * chars[k.order] > chars[x.order]), None)
        if k is None:
            break
        x = k
    return x


@dataclass
class Wrapper:
    """A host's wrapper page, numbered, with what alignment told: the main slot and the template texts."""

    nodes: list[Node]
    slot: int | None = None
    template: frozenset = frozenset()
    match: Matcher = field(default_factory=Matcher)


class _Wrappers:
    """Wrappers of the hosts met last. Weights of shapes are kept for the wrapper they belong to."""

    def __init__(self, op: HtmlText):
        self.op, self.held = op, {}

    def __call__(self, page: str | None, told: list | None = None) -> Wrapper | None:
        if page is None:
            return None
        if page not in self.held:
            if len(self.held) >= 64:
                self.held.clear()
            nodes = number(parse(page))
            self.held[page] = self.op.decide(nodes, told) if told is not None else Wrapper(nodes)
        return self.held[page]


@dataclass
class HtmlText:
    min_pages: int = 3
    constant: float = 0.8
    max_wrapper: int = 200_000
    copied: float = 0.5
    BROADCAST_CHARS = 8 << 20

    def text(self, page: str | None, wrapper: Wrapper | None = None) -> str:
        """Main text of a page, aligned to its host's wrapper."""
        if not page:
            return ""
        nodes = number(parse(page))
        constant: set[int] = set()
        if wrapper is not None:
            pairs = wrapper.match(wrapper.nodes[0], nodes[0])
            constant = {y.order for x, y in pairs if x.order in wrapper.template and x.text == y.text}
            slot = next((y for x, y in pairs if x.order == wrapper.slot), None)
            if slot is not None:
                inside = slots(slot)
                varying = [x for x in inside if x.order not in constant]
                if varying or inside:
                    return " ".join(x.text for x in varying or inside)
        found = slots(nodes[0])
        if any(x.kind == "main" for x in found):
            found = [x for x in found if x.kind == "main"]
        varying = [x for x in found if x.order not in constant]
        if varying or found and found[0].kind != "main":
            found = varying
        return " ".join(x.text for x in found)

    def told(self, known: Wrapper, root: Node) -> tuple[bool, list[tuple[int, int, int, int]]]:
        """Whether the page counts for the template inside the slot; of the wrapper's nodes that it has: number, 1
        for a text that is the same (for a container: that has varying text right there), the same if the page
        counts, plain characters."""
        nodes = number(root)
        chars = plain_chars(nodes)
        pairs = known.match(known.nodes[0], root)
        block = largest_block(nodes, chars)
        inside = range(block.order, block.order + block.size)
        full = sum(len(nodes[i].text) for i in inside)
        same = sum(len(y.text) for x, y in pairs if y.order in inside and x.text == y.text)
        counts = 0 < full and same <= self.copied * full
        equal = {y.order for x, y in pairs if x.content == y.content}
        out = []
        for x, y in pairs:
            if x.text:
                if x.text == y.text:
                    out.append((x.order, 1, int(counts), 0))
            elif x.label in CONTAINERS:
                varies = any(k.label in TEXT_BLOCKS and chars[k.order] and k.order not in equal for k in y.kids)
                out.append((x.order, int(varies), 0, chars[y.order]))
        return counts, out

    def decide(self, nodes: list[Node], told: list[dict]) -> Wrapper:
        """The main slot and the template, from sums over the host's pages (node -1: pages, pages that count)."""
        of = {t["node"]: t for t in told}
        k, k_counts = of[-1]["same"], of[-1]["counted"]
        often = lambda n, k: n >= self.min_pages and n >= self.constant * k
        share = lambda x: of.get(x.order, {"chars": 0})["chars"]
        x, slot = nodes[0], None
        while 2 * of.get(x.order, {"same": 0})["same"] < k:  # most pages don't have varying text right there
            nxt = next((c for c in x.kids if c.label in CONTAINERS and 2 * share(c) > share(x)), None)
            if nxt is None:
                break
            x = slot = nxt
        inside = range(slot.order, slot.order + slot.size) if slot is not None else range(len(nodes))
        template = frozenset(i for i, t in of.items() if i >= 0 and nodes[i].text and (often(t["counted"], k_counts) if i in inside else often(t["same"], k)))
        return Wrapper(nodes, slot.order if slot is not None else None, template)

    def count_rows(self, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of `told` by host and wrapper node; node -1: pages, pages that count."""
        n: dict = defaultdict(lambda: [0, 0, 0])
        wrappers = _Wrappers(self)
        for b in batches(it, 500):
            for host, page, wrapper in zip(*(b.column(i).to_pylist() for i in range(3))):
                known = wrappers(wrapper)
                if known is None or not page:
                    continue
                counts, rows = self.told(known, parse(page))
                for node, *values in [(-1, 1, int(counts), 0), *rows]:
                    own = n[host, node]
                    for i, v in enumerate(values):
                        own[i] += v
            if len(n) > 200_000:
                yield self._counted(n)
                n.clear()
        yield self._counted(n)

    @staticmethod
    def _counted(n: dict) -> pa.RecordBatch:
        cols = [[k[0] for k in n], [k[1] for k in n], *([v[i] for v in n.values()] for i in range(3))]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i else pa.string()) for i, c in enumerate(cols)], ["host", "node", "same", "counted", "chars"])

    def with_wrapper(self, pages: DataFrame, wrappers: DataFrame) -> DataFrame:
        size = wrappers.agg(F.sum(F.length("wrapper") + 32 * F.size("told"))).first()[0] or 0
        return pages.join(F.broadcast(wrappers) if size <= self.BROADCAST_CHARS else wrappers, "host", "left")

    def induce(self, pages: DataFrame) -> DataFrame:
        """host, wrapper (a page), told (sums by its nodes), of hosts with enough pages."""
        mark = F.struct(F.length("page") > self.max_wrapper, F.xxhash64("page").alias("mark"))
        hosts = pages.where("page != ''").groupBy("host").agg(F.count("*").alias("k"), F.min(mark).alias("least")).where(F.col("k") >= self.min_pages)
        hosts = checkpoint(hosts.select("host", F.col("least.mark").alias("mark")))
        few = hosts.count() <= 100_000
        chosen = pages.withColumn("mark", F.xxhash64("page")).join(F.broadcast(hosts) if few else hosts, ["host", "mark"])
        wrappers = checkpoint(chosen.groupBy("host").agg(F.max("page").alias("wrapper")).withColumn("told", F.array().cast(self.TOLD)))
        counts = self.with_wrapper(pages, wrappers).select("host", "page", "wrapper").mapInArrow(self.count_rows, "host string, node long, same long, counted long, chars long")
        counts = counts.groupBy("host", "node").agg(*(F.sum(c).alias(c) for c in ("same", "counted", "chars")))
        counts = counts.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("node", "same", "counted", "chars"))).alias("told"))
        return checkpoint(wrappers.select("host", "wrapper").join(counts, "host"))

    TOLD = "array<struct<node: long, same: long, counted: long, chars: long>>"

    def rows(self, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrappers = _Wrappers(self)
        for b in batches(it, 500):
            out = [self.text(page, wrappers(w, t)) for page, w, t in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], ["key", "url", "text"])

    def __call__(self, df: DataFrame, key: str, url: str, page: str) -> DataFrame:
        """key, url and main text of each row."""
        pages = df.select(df[key].cast("long").alias("key"), df[url].alias("url"), host_of(df[url]).alias("host"), df[page].cast("string").alias("page"))
        full = self.with_wrapper(pages, self.induce(pages.select("host", "page")))
        return full.select("key", "url", "page", "wrapper", "told").mapInArrow(self.rows, "key long, url string, text string")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    out = HtmlText()(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    return out.select(F.col("key").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))
