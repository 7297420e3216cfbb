"""Main text of web pages by wrapper induction over the pages of a host.

A page becomes a tree of its block elements in which alike siblings (by simple tree matching) are one list
node. Every different tree (shape) of a host is aligned by simple tree matching with the host's centre, the
shape that stands for most nodes of its pages. Summed over all pages of the host, and over those of each layout
(the labels of the upper levels), an aligned node's texts that stay the same are template, and what varies
is a slot. The part of the centre that holds nearly all varying text outside links is the content slot;
elements that name an article, a menu, a footer and the like decide before it. Then each page's content
blocks are written out in order.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import new_work_dir
from .links import hub_join
from .spans import text_slices, worker_cache
from .url_filter import url_host

TEXTS = "page_id long, url string, text string"
STATS = "key long, base long, kind int, host string, shape string, pages long, words long, linked long"
SPOTS = "place long, host string, scope long, spot long, centre int, scope_pages long"
#: Kinds of counts: of a shape of a host, of a node in it, of a text at the node.
SHAPE, NODE, TEXT = 0, 1, 2
#: Share of the pages, of a scope or of those with the node, that a text must be on to be template, and the fewest pages to tell.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.5, 4
#: The fewest pages with a template text.
LEAST_PAGES = int(TEMPLATE_SHARE * TEMPLATE_PAGES) + 1
#: Levels of the tree whose labels make a page's layout: html, body, and two below.
LAYOUT_DEPTH = 4
#: Siblings are one list if this share of their nodes matches.
ALIKE = 0.9
#: Share of the varying text outside links that a part of the centre must hold for the rest to be no content.
DOMINANT = 0.8
MOST_LINKED = 0.5
MOST_DEPTH = 150
#: A name marks no element that holds more than this share of a page's varying text outside links: of a class or id that is
#: only in part a listed name (no-sidebar), and of one that is wholly made of them, without and with an article inside.
PART_SHARE, WHOLE_SHARE, WHOLE_ARTICLE_SHARE = 0.5, 0.9, 0.5

#: Fixed values of HTML: void elements, elements whose content is not markup, and inline elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
#: Start tags that end an open element of the group they name.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",)}
#: Elements, roles and name parts that mark what is not main text.
CHROME_TAGS = frozenset("head nav footer aside form noscript select button svg object canvas dialog menu datalist fieldset audio video map".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
CHROME_NAMES = frozenset(
    """nav navbar navigation menu menubar footer sidebar aside ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored
    cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended
    recommendations comment comments commentlist disqus replies breadcrumb breadcrumbs pagination pager widget copyright skip toolbar search""".split()
)
HEADER_NAMES = frozenset("header masthead topbar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.DOTALL)
NAMES = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
WORD_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
DIGITS = re.compile(r"\d+")


class Node:
    """An element, and after folding a list of alike sibling elements."""

    __slots__ = ("label", "parent", "children", "kinds", "size", "into", "fixed", "named", "chrome", "main", "lead", "articles", "index", "depth")

    def __init__(self, label: str, parent: Node | None, fixed: bool = False, named: int = 0, main: bool = False, lead: bool = False):
        """``fixed``: inside what its tag, role or style marks; ``named``: how far its own names do (0 to 2); ``chrome`` is settled per page."""
        self.label, self.parent, self.fixed, self.named, self.main, self.lead = label, parent, fixed, named, main, lead
        self.chrome, self.articles = fixed, 0
        self.children: list[Node] = []
        self.kinds: dict[str, list[Node]] = {}
        self.size, self.into, self.index = 1, None, -1
        self.depth = parent.depth + 1 if parent else 0

    def take(self, child: Node) -> None:
        """Add a folded child: to the first child like it, else as a new one."""
        alike = self.kinds.setdefault(child.label, [])
        for held in alike:
            if similar(held, child):
                child.into = held
                held.articles += child.articles
                for grandchild in child.children:
                    held.take(grandchild)
                held.size = 1 + sum(c.size for c in held.children)
                return
        child.parent = self
        self.children.append(child)
        alike.append(child)

    def fold(self) -> None:
        """Make one list of alike children, the deepest first."""
        children, self.children = self.children, []
        for child in children:
            child.fold()
            self.take(child)
        self.size = 1 + sum(c.size for c in self.children)


def matching(a: Node, b: Node, held: dict[tuple[int, int], int] | None = None) -> int:
    """Simple tree matching: the most nodes of two trees that pair up with equal labels, under paired parents and in order.

    ``held`` keeps the results of numbered nodes.
    """
    if a.label != b.label:
        return 0
    if not a.children or not b.children:
        return 1
    known = (a.index, b.index)
    if held is None or known not in held:
        found = 1 + pairings(a, b, held)[-1][-1]
        if held is None:
            return found
        held[known] = found
    return held[known]


def pairings(a: Node, b: Node, held: dict[tuple[int, int], int] | None) -> list[list[int]]:
    """By first i children of ``a`` and first j of ``b``: the most nodes that match below."""
    table = [[0] * (len(b.children) + 1)]
    for x in a.children:
        above, row = table[-1], [0]
        for j, y in enumerate(b.children):
            row.append(max(row[j], above[j + 1], above[j] + matching(x, y, held)))
        table.append(row)
    return table


def similar(a: Node, b: Node) -> bool:
    """Whether two trees of one label match in most of their nodes."""
    both = a.size + b.size
    return 2 * min(a.size, b.size) >= ALIKE * both and 2 * matching(a, b) >= ALIKE * both


def partners(a: Node, b: Node) -> dict[int, int]:
    """The pairs of a best matching of two numbered trees with equal root labels, by index."""
    held: dict[tuple[int, int], int] = {}
    out, todo = {}, [(a, b)]
    while todo:
        x, y = todo.pop()
        out[x.index] = y.index
        table = pairings(x, y, held)
        i, j = len(x.children), len(y.children)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                todo.append((x.children[i], y.children[j]))
    return out


def key_of(*parts: object) -> int:
    """A 64-bit hash of values, the same in every process."""
    return int.from_bytes(hashlib.blake2b("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def joined(a: int, b: int) -> int:
    """One key of two."""
    h = (a * 0x9E3779B97F4A7C15 + b) & 0xFFFFFFFFFFFFFFFF
    h = ((h ^ (h >> 32)) * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF
    return h - (1 << 64) if h >> 63 else h


class Page:
    """A parsed page: tree, and blocks (node, text, words, linked words) in page order."""

    def __init__(self, html: str):
        self.root = Node("#root", None)
        self.blocks: list[tuple[Node, str, int, int]] = []
        self.parse(html)
        self.root.fold()
        self.nodes = number(self.root)
        self.blocks = [(self.listed(node), *rest) for node, *rest in self.blocks]
        self.shape = "\n".join(f"{n.depth} {n.label}" for n in self.nodes)

    @staticmethod
    def listed(node: Node) -> Node:
        """The list that an element became part of."""
        while node.into is not None:
            node = node.into
        return node

    def parse(self, html: str) -> None:
        stack: list[tuple[str, Node]] = [("#root", self.root)]
        parts: list[str] = []
        linked: list[str] = []
        links = 0

        def flush() -> None:
            nonlocal parts, linked
            if parts:
                text = " ".join(entities.unescape("".join(parts)).split())
                if text:
                    node = stack[-1][1]
                    self.blocks.append((node, text, text.count(" ") + 1, sum(len(x.split()) for x in linked)))
                parts, linked = [], []

        at, end = 0, len(html)
        while at < end:
            m = TOKEN.search(html, at)
            stop = m.start() if m else end
            if stop > at:
                piece = html[at:stop]
                parts.append(piece)
                if links:
                    linked.append(piece)
            if not m:
                break
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                if m[0].startswith("<![CDATA["):
                    parts.append(entities.escape(m[0][9:-3]))
                continue
            closing, attributes = m[1] or m[4], m[3] or m[6] or ""
            if closing:
                if tag == "a":
                    links = max(0, links - 1)
                if tag in INLINE:
                    continue
                held = [i for i, (name, _) in enumerate(stack) if name == tag]
                if held:
                    flush()
                    links = 0
                    del stack[held[-1] :]
                continue
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(html, at)
                at = close.start() if close else end
                continue
            if tag == "br":
                parts.append(" ")
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                continue
            if tag in INLINE:
                if tag == "a":
                    links += 1
                if "class" not in attributes or not any(describe(tag, attributes)[1:3]):
                    continue
            flush()
            links = 0
            if stack[-1][0] == "p" and tag not in INLINE:
                stack.pop()
            for group in CLOSES.get(tag, ()):
                held = [i for i, (name, _) in enumerate(stack) if name == group]
                if held and not any(name in ("ul", "ol", "dl", "table", "select") for name, _ in stack[held[-1] :]):
                    del stack[held[-1] :]
            if len(stack) > MOST_DEPTH or attributes.rstrip().endswith("/") and tag in ("svg", "path", "use"):
                continue
            label, chrome, named, main, header, headed = describe(tag, attributes)
            parent = stack[-1][1]
            inside = parent.main or main
            own = 0 if tag in ("html", "body") else named if inside else max(named, headed)
            node = Node(label, parent, parent.fixed or chrome or (header and not inside), own, inside, main and tag != "article")
            parent.children.append(node)
            if tag == "article" and named < 2 and not node.fixed:
                node.articles += 1
            stack.append((tag, node))
        flush()

    def settle(self, varying: list[tuple[Node, str, int, int]]) -> None:
        """Set ``chrome`` of each node: a name marks it unless the page's main element, its only article or most of its varying text is inside."""
        nodes = self.nodes
        plain, lead, articles = [0] * len(nodes), [n.lead and not n.fixed for n in nodes], [n.articles for n in nodes]
        for node, _, words, linked in varying:
            if not node.fixed:
                plain[node.index] += max(words - linked, 0)
        for node in reversed(nodes[1:]):
            up, at = node.parent.index, node.index
            plain[up] += plain[at]
            lead[up] |= lead[at]
            articles[up] += articles[at]
        for node in nodes[1:]:
            at = node.index
            stands = node.named > 0 and not lead[at]
            if stands and node.named == 1:
                stands = plain[at] <= PART_SHARE * plain[0] and not articles[at] == articles[0] == 1
            elif stands:
                stands = plain[at] <= (WHOLE_ARTICLE_SHARE if articles[at] else WHOLE_SHARE) * plain[0]
            node.chrome = node.fixed or node.parent.chrome or stands


def marked(values: list[str], listed: frozenset[str]) -> int:
    """2 if a class or id is made of listed names, 1 if a part of one is listed, else 0."""
    parts = [[p.lower() for p in WORD_PARTS.findall(v)] for x in values for v in x.split()]
    return max((2 if listed.issuperset(p) else int(not listed.isdisjoint(p)) for p in parts if p), default=0)


def describe(tag: str, attributes: str) -> tuple[str, bool, int, bool, bool, int]:
    """(label, whether it marks no main text, how far its names do, whether it marks main text, whether it is a header, how far its names say so)."""
    cache = worker_cache("wrapper").setdefault("elements", {})
    key = (tag, attributes)
    if key not in cache:
        found = {}
        for m in NAMES.finditer(attributes):
            found.setdefault(m[1].lower(), (m[2] or "").strip("\"'"))
        names = [found.get("class", ""), found.get("id", "")]
        role = found.get("role", "").lower()
        hidden = "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", ""))
        other = bool(role in CHROME_ROLES or hidden)
        named, headed = marked(names, CHROME_NAMES), marked(names, HEADER_NAMES)
        # what is marked is another list than its unmarked siblings of the same tag and class
        label = ".".join([tag, *sorted(DIGITS.sub("#", c) for c in found.get("class", "").split())]) + "!" * bool(other or named or headed)
        if len(cache) > 50_000:
            cache.clear()
        cache[key] = label, tag in CHROME_TAGS or other, named, tag in ("article", "main") or role == "main", tag == "header", headed
    return cache[key]


def number(root: Node) -> list[Node]:
    """The tree's nodes in order, numbered."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        node.index = len(out)
        out.append(node)
        stack.extend(reversed(node.children))
    return out


def tree_of(shape: str) -> list[Node]:
    """The numbered nodes of a page's ``shape``."""
    nodes: list[Node] = []
    path: list[Node] = []
    for line in shape.split("\n"):
        depth, label = line.split(" ", 1)
        del path[int(depth) :]
        node = Node(label, path[-1] if path else None)
        if path:
            path[-1].children.append(node)
        path.append(node)
        node.index = len(nodes)
        nodes.append(node)
    return nodes


class Aligned(NamedTuple):
    """A shape of a host beside the host's centre, by node: its key in the union of all shapes, its partner in the centre
    (-1: none), and the partner of the lowest node above or at it that has one; and the keys of host and layout."""

    keys: list[int]
    partner: list[int]
    within: list[int]
    scopes: tuple[int, int]


def aligned(host: str, shape: str, centre: str) -> Aligned:
    """Nodes that the matching pairs have the key of their partner, others one of their parent's key, label and place among such siblings."""
    nodes = tree_of(shape)
    pairs = partners(nodes[0], tree_of(centre)[0])
    keys, within, paths = [], [], []
    alone: dict[tuple[int, str], int] = {}
    for node in nodes:
        up = node.parent.index if node.parent else -1
        partner = pairs.get(node.index, -1)
        if partner < 0:
            # unpaired siblings of one label: the order tells them apart
            order = alone[up, node.label] = alone.get((up, node.label), -1) + 1
            keys.append(key_of(keys[up], node.label, order))
        else:
            keys.append(key_of(partner))
        within.append(partner if partner >= 0 else within[up])
        paths.append(f"{paths[up]} {node.label}" if node.parent else node.label)
    upper = sorted({p for node, p in zip(nodes, paths, strict=True) if node.depth <= LAYOUT_DEPTH})
    return Aligned(keys, [pairs.get(n.index, -1) for n in nodes], within, (key_of(host), key_of(host, *upper)))


def unzip(payload: bytes | None) -> str:
    return zstandard.ZstdDecompressor().decompress(payload).decode("utf-8", "replace") if payload else ""


def packed(pages: DataFrame) -> DataFrame:
    """The columns of ``pages`` with ``payload`` (compressed) in place of ``html``, the last one."""
    kept = pages.schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for whole in batches:
            for batch in text_slices(whole, "html"):
                payload = [pack.compress(h.as_buffer() if h.is_valid else b"") for h in batch.column("html")]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(payload, pa.binary())], [*kept, "payload"])

    return pages.mapInArrow(run, T.StructType([*(pages.schema[c] for c in kept), T.StructField("payload", T.BinaryType())]))


def weighed_pages(read: DataFrame, folder: str) -> DataFrame:
    """``host, weight, payload`` with which each different html of a host counts as one page, however many rows hold it.

    Every row has weight 1; of html that n rows hold, one more row takes n - 1 off. So only copies move, one
    of each and task, and their counts alone tell which these are.
    """
    spark = read.sparkSession
    keyed = read.select(F.md5(F.concat_ws("\0", F.col("host"), F.coalesce("html", F.lit("")))).alias("content"), "host", "html")
    copied = keyed.groupBy("content").agg(F.count("*").alias("n")).where("n > 1")
    copied.withColumn("weight", 1 - F.col("n")).write.parquet(f"{folder}/copies")
    once = hub_join(keyed, spark.read.parquet(f"{folder}/copies"), "content").dropDuplicates(["content"])
    return packed(read.select("host", F.lit(1).cast("bigint").alias("weight"), "html").union(once.select("host", "weight", "html")))


def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``STATS`` of ``host, weight, payload``: pages of each shape of a host; per node of it pages, words, linked words; the same per text of the node, whose key is of host and text."""
    for whole in batches:
        for at in range(0, whole.num_rows, 2000):
            batch = whole.slice(at, 2000)
            sums: dict[tuple, list[int]] = {}
            for host, weight, payload in zip(batch.column("host").to_pylist(), batch.column("weight").to_pylist(), batch.column("payload"), strict=True):
                page = Page(unzip(payload.as_py()))
                shape = key_of(host, page.shape)
                own: dict[tuple, list[int]] = {(shape, 0, SHAPE, host, page.shape): [1, 0, 0]}
                for node, text, words, linked in page.blocks:
                    place = joined(shape, node.index)
                    for name in ((place, shape, NODE, None, None), (key_of(host, text), place, TEXT, None, None)):
                        row = own.setdefault(name, [1, 0, 0])
                        row[1] += words
                        row[2] += linked
                for name, row in own.items():
                    total = sums.setdefault(name, [0, 0, 0])
                    for i in range(3):
                        total[i] += weight * row[i]
            columns = list(zip(*((*k, *v) for k, v in sums.items()), strict=True)) or [()] * 8
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            names = ["key", "base", "kind", "host", "shape", "pages", "words", "linked"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``SPOTS`` of ``key, host, shape, pages, centre_shape``: where each node of a shape belongs among the host's pages and those of its layout."""
    for batch in batches:
        for row in batch.to_pylist():
            found = aligned(row["host"], row["shape"], row["centre_shape"])
            place = [joined(row["key"], i) for i in range(len(found.keys))]
            for scope in found.scopes:
                of_host = scope == found.scopes[0]
                n = len(place)
                columns = [place, [row["host"]] * n, [scope] * n, [joined(scope, k) for k in found.keys], found.partner if of_host else [-1] * n, [row["pages"]] + [0] * (n - 1)]
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["place", "host", "scope", "spot", "centre", "scope_pages"])


def wrappers_of(counted: DataFrame, folder: str) -> DataFrame:
    """``host, centre_shape, marks, slots``: a host's centre, its template texts (``spot, text``) and menu nodes (text 0), and the centre's nodes with varying text (``centre, plain`` words outside links)."""
    spark = counted.sparkSession

    def write(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    sums = write(counted.groupBy("key", "base", "kind", "host", "shape").agg(*(F.sum(c).alias(c) for c in ("pages", "words", "linked"))), "sums")
    shapes = sums.where(F.col("kind") == SHAPE).select("key", "host", "shape", "pages")
    covers = F.struct(F.col("pages") * F.size(F.split("shape", "\n")), "key")
    centres = write(shapes.groupBy("host").agg(F.max_by("shape", covers).alias("centre_shape")), "centres")
    spots = write(shapes.join(centres, "host").mapInArrow(align, SPOTS), "spots")
    scope = spots.groupBy("scope").agg(F.sum("scope_pages").alias("all_pages"))
    totals = [F.sum(c).alias(c) for c in ("pages", "words", "linked")]
    here = sums.where(F.col("kind") == NODE).select(F.col("key").alias("place"), "pages", "words", "linked").join(spots, "place")
    node = write(here.groupBy("scope", "spot", "host", "centre").agg(*totals).join(scope, "scope"), "nodes")
    menus = node.where((F.col("linked") > MOST_LINKED * F.col("words")) & ((F.col("pages") >= LEAST_PAGES) | (F.col("all_pages") < TEMPLATE_PAGES)))
    # what is on too few pages of the host to be template is most of all texts
    texts = sums.where(F.col("kind") == TEXT).select("key", F.col("base").alias("place"), "pages", "words", "linked")
    common = texts.groupBy("key").agg(F.sum("pages").alias("n")).where(F.col("n") >= LEAST_PAGES)
    there = texts.join(common.select("key"), "key", "left_semi").join(spots.select("place", "spot"), "place").groupBy("spot", "key").agg(*totals)
    often = F.lit(False)
    for total in ("all_pages", "node_pages"):
        often = often | ((F.col(total) >= TEMPLATE_PAGES) & (F.col("pages") > TEMPLATE_SHARE * F.col(total)))
    place = node.select("spot", "host", "all_pages", F.col("pages").alias("node_pages"))
    template = write(there.where(F.col("pages") >= LEAST_PAGES).join(place, "spot").where(often).select("host", "spot", F.col("key").alias("text"), "words", "linked"), "template")
    fixed = template.groupBy("spot").agg(F.sum(F.col("words") - F.col("linked")).alias("fixed"))
    plain = F.col("words") - F.col("linked") - F.coalesce("fixed", F.lit(0))
    slots = node.where("centre >= 0").join(fixed, "spot", "left").select("host", F.struct("centre", plain.alias("plain")).alias("slot")).where("slot.plain > 0")
    marks = template.select("host", F.struct("spot", "text").alias("mark")).union(menus.select("host", F.struct("spot", F.lit(0).cast("long").alias("text"))))
    both = marks.select("host", "mark", F.lit(None).cast("struct<centre:int,plain:bigint>").alias("slot")).union(slots.select("host", F.lit(None).cast("struct<spot:bigint,text:bigint>"), "slot"))
    return centres.join(both.groupBy("host").agg(F.collect_list("mark").alias("marks"), F.collect_list("slot").alias("slots")), "host", "left")


def content_part(centre: str, plain: dict[int, int]) -> set[int]:
    """The centre's nodes of the content slot: from the root down, the element that holds nearly all varying text outside links, and headings beside the way.

    An element whose own text is most of that is a list of paragraphs: its parent is the slot.
    """
    nodes = tree_of(centre)
    below = [plain.get(n.index, 0) for n in nodes]
    for node in reversed(nodes[1:]):
        below[node.parent.index] += below[node.index]
    at, kept = nodes[0], []
    while at.children:
        best = max(at.children, key=lambda n: below[n.index])
        if below[best.index] < DOMINANT * max(below[at.index], 1) or 2 * plain.get(best.index, 0) > below[best.index]:
            break
        kept += [n for n in at.children if n.label.split(".")[0].rstrip("!") in HEADINGS]
        at = best
    out, kept = set(), [at, *kept]
    while kept:
        node = kept.pop()
        out.add(node.index)
        kept.extend(node.children)
    return out


class Wrapper:
    """What the pages of a host have in common: centre, keys of template texts and menu nodes, and the centre's content slot."""

    def __init__(self, host: str, centre: str, marks: Iterable[tuple[int, int]], slots: Iterable[tuple[int, int]]):
        self.host, self.centre = host, centre
        self.marks = {joined(spot, text) if text else spot for spot, text in marks}
        self.part = content_part(centre, dict(slots))
        self.known: dict[str, tuple[list[tuple[int, int]], list[bool]]] = {}

    def places(self, shape: str) -> tuple[list[tuple[int, int]], list[bool]]:
        """For each node of a shape its keys in host and layout, and whether it is in the content slot."""
        if shape not in self.known:
            if len(self.known) > 300:
                self.known.clear()
            found = aligned(self.host, shape, self.centre)
            keys = [(joined(found.scopes[0], k), joined(found.scopes[1], k)) for k in found.keys]
            self.known[shape] = keys, [w in self.part for w in found.within]
        return self.known[shape]


def main_text(page: Page, wrapper: Wrapper) -> str:
    """The page's content blocks, one a line."""
    keys, inside = wrapper.places(page.shape)
    varying = []
    for block in page.blocks:
        node, text = block[:2]
        name = key_of(wrapper.host, text)
        if not any((not node.main and spot in wrapper.marks) or joined(spot, name) in wrapper.marks for spot in keys[node.index]):
            varying.append(block)
    page.settle(varying)
    kept = [(node, text) for node, text, words, linked in varying if not node.chrome and (node.main or linked <= MOST_LINKED * words)]
    chosen = [text for node, text in kept if node.main] or [text for node, text in kept if inside[node.index]]
    return "\n".join(chosen or [text for _, text in kept])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text``.

    Blocks are joined by one line break, white space inside a block is one space; nothing is cut. A null
    or empty page has an empty text. Pages without a host share the empty host. Repeated rows, and
    rows of a host with equal html, are extracted each, and count as one page; with fewer than four different
    pages of a host nothing counts as template. Elements deeper than
    150 levels belong to the one above. An empty table gives no rows; other columns are not read.

    Counts are summed per batch and shuffled by shape, node and text; a host's shapes are aligned one by one
    with its centre, which is one page's tree. The join gives each page row its host's wrapper (that tree,
    template texts as pairs of keys) and splits skewed hosts.
    """
    folder = new_work_dir(pages.sparkSession, "wrapper")
    read = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), url_host(F.col(url)).alias("host"), F.col(html).alias("html"))
    rows = packed(read)
    wrappers_of(weighed_pages(read, folder).mapInArrow(count, STATS), folder).write.parquet(f"{folder}/wrappers")
    wrappers = pages.sparkSession.read.parquet(f"{folder}/wrappers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Wrapper] = {}
        for batch in batches:
            out = []
            for host, payload, centre, marks, slots in zip(*(batch.column(c) for c in ("host", "payload", "centre_shape", "marks", "slots")), strict=True):
                name = host.as_py()
                if name not in known:
                    if len(known) > 300:
                        known.clear()
                    pairs = ([tuple(x.values()) for x in column.as_py() or ()] for column in (marks, slots))
                    known[name] = Wrapper(name, centre.as_py(), *pairs)
                out.append(main_text(Page(unzip(payload.as_py())), known[name]))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])

    return rows.select("page_id", "url", "host", "payload").join(wrappers, "host", "left").mapInArrow(run, TEXTS)
