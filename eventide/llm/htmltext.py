"""Main text of web pages by wrapper induction over pages of one host (operator 13).

A page is parsed into blocks of text and a tree of its containers (body, div, nav,
article, lists, ...), in which alike neighbours share a slot. The trees of a host's
pages are aligned by simple tree matching (the largest order-keeping match of two
trees with equal tags from the root down) and merged into the host's template. For
every slot of the template the values that the pages put there are counted against
the pages' main blocks (their longest ones): a slot whose values come back beside
many different main blocks is template (a constant footer, menus and adverts that
take turns); a slot that changes with the main block is content. Within content a
block that most of the host's pages repeat is template, too.

Where a host has too few different pages to tell, and for what varies on every page
without being content, the marks that pages give themselves decide: nav, footer,
aside, form, role, and words of class and id such as "sidebar" or "comments". Text
in an article (else in main, else in the part of the template that holds nearly all
varying text) is the main text, less the template and the marked parts.

Templates are merged in rounds of bounded groups and counted with map-side
aggregates, so a host with a third of all pages is no task of its own. Only one
small row a host meets the pages again.

Defined results: null or empty html has the empty text, 0 characters; pages
without a host (no or odd url) count as one host; null ids and repeated rows are
each returned; html may be cut off anywhere; an empty table gives no rows. Only the
columns page_id, url and html are read. A page is held in memory some times over.
"""

from __future__ import annotations

import functools
import html as html_entities
import json
import re
import sys
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import scope, stored

#: Different main blocks a slot must have been seen beside, and on average beside each of its values, to be template.
LEAST_MAINS, MAINS_A_VALUE = 8, 4
#: Share of the host's main blocks beside which a block of a content slot is template.
ITEM_SHARE = 0.6
#: Share of the varying text that the main part of a template holds.
MAIN_SHARE = 0.8
#: Groups of distinct page trees a host in each round of merging.
ROUNDS = (1024, 32, 1)

# Names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript textarea title svg template object canvas select".split())
CONTAINERS = frozenset("body div section article main aside nav header footer form center ul ol dl table menu fieldset dialog".split())
BLOCKS = CONTAINERS | frozenset("""address blockquote caption dd details dir dt figcaption figure frameset h1 h2 h3 h4 h5 h6 head hgroup
    hr html legend li optgroup option p pre search summary tbody td tfoot th thead tr""".split())
#: An element that ends an open one of these kinds, up to the nearest of the others.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"})}
#: Marks of what is no main text.
MARKED_TAGS = frozenset("nav footer aside form button dialog menu".split())
MARKED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
MARKED_WORDS = frozenset("""ad ads adv alert alerts advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs consent cookie cookies
    footer gdpr login masthead menu menubar modal nav navbar navigation navigator newsletter notice notices notification outbrain pagination
    pager popup promo promos promotion recommended related share sharing sidebar signup skip social sponsor sponsored subscribe subscription
    taboola toolbar widget widgets""".split())
COMMENT_WORDS = frozenset("comment comments commentlist discussion disqus replies reply respond".split())
HEADER_WORDS = frozenset("header topbar".split())
MAIN_ROLES, MAIN_PROPS = frozenset(["main", "article"]), frozenset(["articlebody"])

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z>][^>]*(?:>|\Z)|</>
    |<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*(?:"[^"]*"|'[^']*')?)*)(?:>|\Z)""", re.S | re.X)
_ATTR = re.compile(r"""(class|id|role|itemprop|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/"'>]|\Z)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


# --- pages -------------------------------------------------------------------

@dataclass
class Container:
    """An element that may hold blocks: its place in the tree and its marks."""

    parent: int
    tag: str
    label: str
    marked: bool = False
    word_marked: bool = False
    main: int = 0  # 2 an article, 1 another main part
    slot: int = -1


@dataclass
class Page:
    """Blocks (container, text, characters in links) in page order, and the tree."""

    containers: list[Container] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)
    slots: list[tuple[int, str]] = field(default_factory=list)  # (parent slot, label), parents first

    def marked_slot(self, c: int) -> bool:
        while c >= 0:
            if self.containers[c].marked:
                return True
            c = self.containers[c].parent
        return False


@functools.lru_cache(maxsize=4096)
def _marks(tag: str, attrs: str) -> tuple[str, bool, bool, bool | str, int, bool]:
    """(label, marked, marked by words alone, header (by tag, or "header" by
    a word), main, unseen) of a start tag."""
    got: dict[str, str] = {}
    for m in _ATTR.finditer(attrs):
        got.setdefault(m[1].lower(), html_entities.unescape(m[2] or m[3] or m[4] or ""))
    words: list[str] = []
    for name in got.get("class", "").split() + [got.get("id", "")]:
        own = [w.lower() for w in _WORD.findall(name)]
        # "with-sidebar" and the like say what stands beside
        words += [w for k, w in enumerate(own) if not (k and own[k - 1] in ("with", "has", "no", "without", "is"))]
    role = got.get("role", "").strip().lower()
    whole = tag in ("html", "body", "main")
    by_word = not whole and any(w in MARKED_WORDS for w in words)
    comments = not whole and any(w in COMMENT_WORDS for w in words)
    header = tag == "header" or (not whole and any(w in HEADER_WORDS for w in words) and "header")
    by_tag = tag in MARKED_TAGS or role in MARKED_ROLES
    main = 0
    if not by_tag and not comments:
        main = 2 if tag == "article" or got.get("itemprop", "").strip().lower() in MAIN_PROPS or role == "article" else int(
            tag == "main" or role in MAIN_ROLES)
    unseen = "hidden" in got and tag != "body" or got.get("aria-hidden", "").lower() == "true" or bool(_UNSEEN.search(got.get("style", "")))
    label = ".".join([tag, *sorted({w for w in words})])
    return label, by_tag or comments, by_word, header, main, unseen


def parse(text: str) -> Page:
    """The blocks and containers of a page. Lenient: unclosed, crossing and cut-off
    elements are taken as browsers take the common cases."""
    page = Page()
    page.containers.append(Container(-1, "body", "body"))
    open_tags: list[tuple[str, int]] = []  # (tag, container that holds its content)
    here, held, links, in_link, unseen = 0, [], 0, 0, 0
    inside_main = 0

    def flush():
        nonlocal held, links
        if held:
            block = " ".join("".join(held).split())
            if block:
                page.blocks.append((here, block, links))
            held, links = [], 0

    def add(raw: str):
        nonlocal links
        if unseen or not raw:
            return
        s = html_entities.unescape(raw) if "&" in raw else raw
        held.append(s)
        if in_link:
            links += len(s.strip())

    def close(to: int):
        """End the open elements from place ``to`` on."""
        nonlocal here, in_link, unseen, inside_main
        if any(tag in BLOCKS for tag, _ in open_tags[to:]):
            flush()
        while len(open_tags) > to:
            tag, state = open_tags.pop()
            in_link -= tag == "a"
            if state < -1:  # an unseen or marked inline element
                unseen -= 1
            elif state >= 0:
                inside_main -= page.containers[here].main > 0
                here = state

    at, n = 0, len(text)
    while at < n:
        m = _TAG.search(text, at)
        if not m:
            add(text[at:])
            break
        if m.start() > at:
            add(text[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "br":
                add(" ")
            block = tag in BLOCKS
            for k in range(len(open_tags) - 1, -1, -1):
                if open_tags[k][0] == tag:
                    close(k)
                    break
                if not block and open_tags[k][0] in BLOCKS:
                    break  # a crossing inline end; its element ends with the block
            else:
                if block:
                    flush()
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                add(" ")
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(text, at)
            if not m[3].rstrip().endswith("/") or tag != "svg":
                at = end.end() if end else (n if tag not in ("select", "object", "svg", "canvas") else at)
            continue
        block = tag in BLOCKS
        if block:
            flush()
            ends, stop = ENDS.get(tag, ({"p"}, {"button"}))
            for k in range(len(open_tags) - 1, -1, -1):
                if open_tags[k][0] in stop or (open_tags[k][0] in CONTAINERS and tag not in ENDS):
                    break
                if open_tags[k][0] in ends:
                    close(k)
                    break
        label, marked, by_word, header, main, hidden = _marks(tag, m[3] or "")
        state = -1
        if tag == "head":
            state, unseen = -2, unseen + 1
        elif not block:
            if tag == "a":
                in_link += 1
            if marked or by_word or hidden:
                state, unseen = -2, unseen + 1
        elif tag == "body" and here == 0 and not page.containers[0].main and len(page.containers) == 1:
            page.containers[0].label, page.containers[0].main = label, main
            for k, (t, s) in enumerate(open_tags):  # an unclosed head ends here
                if t == "head" and s < -1:
                    open_tags[k], unseen = (t, -1), unseen - 1
        elif tag in CONTAINERS or marked or by_word or hidden or header or main:
            bad = marked or hidden or (header is True and not inside_main)
            by_word |= header == "header" and not inside_main
            page.containers.append(Container(here, tag, label, bad, by_word, 0 if bad else main))
            state, here = here, len(page.containers) - 1
            inside_main += page.containers[here].main > 0
        open_tags.append((tag, state))
    flush()
    _settle_marks(page)
    _number_slots(page)
    return page


def _settle_marks(page: Page) -> None:
    """Words of class and id mark a container, unless it holds an article or a main
    part that is not itself in a marked one."""
    cs = page.containers
    mains = [c for k, c in enumerate(cs) if c.main and not page.marked_slot(k)]
    if all(c.word_marked for c in mains):  # the page's only articles
        for c in mains:
            c.word_marked = False
    holds = [False] * len(cs)
    for k, c in enumerate(cs):
        if c.main and not c.word_marked and not page.marked_slot(k):
            p = c.parent
            while p >= 0 and not holds[p]:
                holds[p] = True
                p = cs[p].parent
    for k, c in enumerate(cs):
        if c.word_marked and not holds[k]:
            c.marked = True
        if c.marked:
            c.main = 0


def _number_slots(page: Page) -> None:
    """Give alike neighbours one slot; their children go through the slot's children
    once more. A marked container is a slot without children."""
    children: dict[int, list[int]] = {-1: []}
    cursor: dict[int, int] = {-1: 0}
    order: list[tuple[int, str]] = []
    for c in page.containers:
        above = page.containers[c.parent] if c.parent >= 0 else None
        if above is not None and (above.marked or above.slot < 0):
            c.slot, c.marked = above.slot, True
            continue
        parent = above.slot if above else -1
        own, at = children[parent], cursor[parent]
        if at and order[own[at - 1]][1] == c.label:
            c.slot = own[at - 1]
        else:
            found = next((k for k in range(at, len(own)) if order[own[k]][1] == c.label), None)
            if found is None:
                order.append((parent, c.label))
                own.insert(at, len(order) - 1)
                children[len(order) - 1] = []
                found = at
            c.slot = own[found]
            cursor[parent] = found + 1
        cursor[c.slot] = 0
    # parents first, in page order
    number: dict[int, int] = {}
    walk = [0] if order else []
    while walk:
        s = walk.pop()
        number[s] = len(number)
        page.slots.append((number.get(order[s][0], -1), order[s][1]))
        walk += reversed(children[s])
    for c in page.containers:
        c.slot = number[c.slot]


def tree_text(slots: list[tuple[int, str]]) -> str:
    """The slots as one line: depth and label of each, parents first."""
    depth: list[int] = []
    for parent, _ in slots:
        depth.append(depth[parent] + 1 if parent >= 0 else 0)
    return " ".join(f"{d}:{label}" for d, (_, label) in zip(depth, slots, strict=True))


# --- trees and templates -----------------------------------------------------

def _deep() -> None:
    """Pages may be nested deeper than Python recurses by default."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 1 << 20))


class Node:
    """A node of a tree or template: its label, its children, how many pages have it."""

    __slots__ = ("children", "count", "label", "number", "size", "tag")

    def __init__(self, label: str, count: int = 1):
        self.label, self.tag, self.count = label, label.partition(".")[0], count
        self.children: list[Node] = []
        self.size, self.number = 1, -1

    @staticmethod
    def read(line: str, count: int | None = None) -> Node:
        """The tree of ``tree_text``; with counts if the labels carry them (depth:label:count)."""
        path: list[Node] = []
        for part in line.split(" "):
            depth, label, *more = part.split(":")
            node = Node(label, count if count is not None else int(more[0]))
            del path[int(depth):]
            if path:
                path[-1].children.append(node)
            path.append(node)
        return path[0]

    def walk(self):
        """(node, depth) of all nodes, parents first."""
        todo = [(self, 0)]
        while todo:
            node, depth = todo.pop()
            yield node, depth
            todo += [(c, depth + 1) for c in reversed(node.children)]

    def written(self) -> str:
        return " ".join(f"{depth}:{n.label}:{n.count}" for n, depth in self.walk())

    def numbered(self) -> int:
        """Number the nodes, parents first, and note the size of every subtree."""
        nodes = [n for n, _ in self.walk()]
        for k, n in enumerate(nodes):
            n.number = k
        for n in reversed(nodes):
            n.size = 1 + sum(c.size for c in n.children)
        return len(nodes)


def match(a: Node, b: Node, memo: dict) -> tuple[float, list[tuple[Node, Node]]]:
    """Simple tree matching: the score of the largest match of two trees that keeps
    order and ancestors, and the matched pairs of children. Equal class words count
    half a node more, so that alike containers find each other."""
    if a.tag != b.tag:
        return 0.0, []
    key = (id(a), id(b))
    if key not in memo:
        x, y = a.children, b.children
        best = [[0.0] * (len(y) + 1) for _ in range(len(x) + 1)]
        got = [[0.0] * len(y) for _ in x]
        for i, p in enumerate(x):
            for j, q in enumerate(y):
                got[i][j] = match(p, q, memo)[0]
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + got[i][j])
        pairs, i, j = [], len(x), len(y)
        while i and j:
            if got[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + got[i - 1][j - 1]:
                i, j = i - 1, j - 1
                pairs.append((x[i], y[j]))
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
        memo[key] = (1.0 + 0.5 * (a.label == b.label) + best[-1][-1], pairs[::-1])
    return memo[key]


def merge(into: Node, other: Node, memo: dict | None = None) -> None:
    """Add a tree to a template: matched nodes count up, the others join at their place."""
    memo = {} if memo is None else memo
    into.count += other.count
    pairs = match(into, other, memo)[1]
    twin = {id(q): p for p, q in pairs}
    at = 0
    for q in other.children:
        if id(q) in twin:
            p = twin[id(q)]
            at = next(k for k in range(at, len(into.children)) if into.children[k] is p) + 1
            merge(p, q, memo)
        else:
            into.children.insert(at, q)
            at += 1


def slot_numbers(template: Node, tree: Node) -> list[int]:
    """For each node of a page's tree, parents first, its node of the template (-1: none)."""
    memo: dict = {}
    out: list[int] = []

    def walk(t: Node, p: Node | None):
        out.append(p.number if p else -1)
        twin = {id(q): r for r, q in match(p, t, memo)[1]} if p else {}
        for c in t.children:
            walk(c, twin.get(id(c)))

    walk(tree, template if template.tag == tree.tag else None)
    return out


# --- what a host's pages say -------------------------------------------------

def digest(s: str) -> int:
    d = xxhash.xxh3_64_intdigest(s)
    return d - (1 << 64) if d >> 63 else d


def _survey_rows(batches):
    """tree, main block, values of the slots, and their blocks, a row a page."""
    for b in batches:
        cols: list[list] = [[], [], [], [], []]
        for host, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            page = parse(text)
            own: dict[int, list[str]] = {}
            longest = ""
            for c, block, _ in page.blocks:
                box = page.containers[c]
                own.setdefault(box.slot, []).append(block)
                if not box.marked and len(block) > len(longest):
                    longest = block
            if not longest:
                continue
            for col, v in zip(cols, (
                    host, tree_text(page.slots), digest(longest),
                    [{"slot": s, "value": digest("\n".join(v)), "chars": sum(map(len, v))} for s, v in own.items()],
                    [{"slot": s, "item": digest(x)} for s, v in own.items() for x in dict.fromkeys(v)]), strict=True):
                col.append(v)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (
            pa.string(), pa.string(), pa.int64(),
            pa.list_(pa.struct([("slot", pa.int32()), ("value", pa.int64()), ("chars", pa.int32())])),
            pa.list_(pa.struct([("slot", pa.int32()), ("item", pa.int64())]))), strict=True)],
            ["host", "tree", "main", "slots", "items"])


def _merged(first: bool):
    """Merge the trees (or templates) of a group, most frequent first."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        _deep()
        part = part.sort_values(["n", "tree"], ascending=[False, True])
        read = (Node.read(t, n if first else None) for t, n in zip(part["tree"], part["n"].tolist(), strict=True))
        out = next(read)
        for tree in read:
            merge(out, tree)
        return pd.DataFrame({"host": [part["host"].iloc[0]], "tree": [out.written()], "n": [int(part["n"].sum())]})
    return run


def host_templates(trees: DataFrame) -> DataFrame:
    """host, template: the merged tree of each host (trees: host, tree, n)."""
    for k, groups in enumerate(ROUNDS):
        trees = (trees.groupBy("host", F.pmod(F.xxhash64("tree"), F.lit(groups)).alias("g"))
                 .applyInPandas(_merged(k == 0), "host string, tree string, n long"))
    return trees.select("host", F.col("tree").alias("template"))


def _numbered(batches):
    """host, tree, numbers: the template's node of each slot of a page tree."""
    _deep()
    known: dict[str, Node] = {}
    for b in batches:
        out = []
        for template, tree in zip(b.column(2).to_pylist(), b.column(1).to_pylist(), strict=True):
            if template not in known:
                if len(known) >= 200:
                    known.clear()
                known[template] = Node.read(template)
                known[template].numbered()
            out.append(slot_numbers(known[template], Node.read(tree, 1)))
        yield pa.record_batch([b.column(0), b.column(1), pa.array(out, pa.list_(pa.int32()))], ["host", "tree", "numbers"])


def learn_templates(pages: DataFrame) -> DataFrame:
    """host, template, nodes: one row a host. nodes is JSON, by the number of a
    template node: whether its slot is template, how many characters vary there, and
    the digests of the blocks that are template (pages: host, html)."""
    with scope(pages.sparkSession):
        survey = stored(pages.mapInArrow(_survey_rows, "host string, tree string, main long, "
                                         "slots array<struct<slot:int,value:long,chars:int>>, items array<struct<slot:int,item:long>>"),
                        "page-survey")
        trees = stored(survey.groupBy("host", "tree").agg(F.count("*").alias("n")), "page-trees")
        templates = stored(host_templates(trees), "page-templates")
        numbers = trees.join(templates, "host").select("host", "tree", "template").mapInArrow(
            _numbered, "host string, tree string, numbers array<int>")
        rows = survey.join(numbers, ["host", "tree"])
        node = lambda s: F.element_at("numbers", F.col(f"{s}.slot") + 1).alias("node")
        values = (rows.select("host", "main", "numbers", F.explode("slots").alias("s"))
                  .select("host", node("s"), F.col("s.value").alias("value"), "main", F.col("s.chars").alias("chars"))
                  .groupBy("host", "node", "value", "main").agg(F.max("chars").alias("chars"))
                  .groupBy("host", "node", "value").agg(F.count("*").alias("n"), F.max("chars").alias("chars"))
                  .groupBy("host", "node").agg(F.sum("n").alias("mains"), F.count("*").alias("values"), F.sum("chars").alias("chars")))
        fixed = (F.col("mains") >= LEAST_MAINS) & (F.col("mains") >= MAINS_A_VALUE * F.col("values"))
        items = (rows.select("host", "main", "numbers", F.explode("items").alias("s"))
                 .select("host", node("s"), F.col("s.item").alias("item"), "main").distinct()
                 .groupBy("host", "node", "item").agg(F.count("*").alias("n")).where(F.col("n") >= ITEM_SHARE * LEAST_MAINS))
        common = (items.join(values.select("host", "node", "mains"), ["host", "node"])
                  .where((F.col("mains") >= LEAST_MAINS) & (F.col("n") >= ITEM_SHARE * F.col("mains")))
                  # a page's blocks that most pages share: bounded by a page's blocks
                  .groupBy("host", "node").agg(F.sort_array(F.collect_list("item")).alias("items")))
        said = (values.join(common, ["host", "node"], "left").where("node >= 0")
                .select("host", F.struct("node", fixed.alias("fixed"), "chars", "items").alias("s"))
                .groupBy("host").agg(F.to_json(F.sort_array(F.collect_list("s"))).alias("nodes")))
        return stored(templates.join(said, "host"), "host-templates", outlives=True)


# --- main text ---------------------------------------------------------------

class Wrapper:
    """A host's template, ready to be applied to pages."""

    def __init__(self, template: str | None, nodes: str | None):
        self.root = Node.read(template) if template else None
        self.known: dict[str, list[int]] = {}
        self.fixed: set[int] = set()
        self.items: dict[int, set[int]] = {}
        self.main_part: tuple[int, int] | None = None
        if not self.root:
            return
        size = self.root.numbered()
        varying = [0] * size
        for s in json.loads(nodes):
            if s["fixed"]:
                self.fixed.add(s["node"])
            else:
                varying[s["node"]] = s["chars"]
            if s.get("items"):
                self.items[s["node"]] = set(s["items"])
        self._find_main_part(varying)

    def _find_main_part(self, varying: list[int]) -> None:
        """The deepest node below which nearly all varying text stands."""
        upto = [0]
        for v in varying:
            upto.append(upto[-1] + v)
        below = lambda p: upto[p.number + p.size] - upto[p.number]
        now = self.root
        while deeper := next((c for c in now.children if below(c) >= MAIN_SHARE * upto[-1] > 0), None):
            now = deeper
        self.main_part = (now.number, now.number + now.size)

    def numbers(self, slots: list[tuple[int, str]]) -> list[int]:
        """The template's node of each slot of a page; -1 where it has none."""
        if not self.root:
            return [-1] * len(slots)
        line = tree_text(slots)
        if line not in self.known:
            if len(self.known) >= 1000:
                self.known.clear()
            self.known[line] = slot_numbers(self.root, Node.read(line, 1))
        return self.known[line]

    def blocks(self, page: Page) -> list[str]:
        """The page's main text, block by block."""
        number = self.numbers(page.slots)
        lists: dict[int, list[int]] = {}
        for c, text, links in page.blocks:
            lists.setdefault(c, []).append(links * 10 >= len(text) * 8)
        kept: list[tuple[int, str]] = []
        for c, text, _ in page.blocks:
            box = page.containers[c]
            node = number[box.slot]
            if box.marked or node in self.fixed or (node in self.items and digest(text) in self.items[node]):
                continue
            kept.append((c, text))
        rank = [0] * len(page.containers)
        for k, box in enumerate(page.containers):
            rank[k] = max(box.main, rank[box.parent] if box.parent >= 0 else 0)
        for level in (2, 1):
            if any(rank[c] >= level for c, _ in kept):
                return [t for c, t in kept if rank[c] >= level]
        kept = [(c, t) for c, t in kept if len(lists[c]) < 3 or not all(lists[c])] or kept  # no menus of links alone
        if self.main_part:
            lo, hi = self.main_part
            return [t for c, t in kept if lo <= number[page.containers[c].slot] < hi] or [t for _, t in kept]
        return [t for _, t in kept]


def host_of(url: F.Column) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def main_text(pages: DataFrame) -> DataFrame:
    """One row a page: page_id, url, text, n_chars (code points)."""
    base = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    templates = learn_templates(base.select("host", "html"))

    def run(batches):
        _deep()
        known: dict[str, Wrapper] = {}
        for b in batches:
            texts = []
            for host, text, template, nodes in zip(*(b.column(k).to_pylist() for k in range(2, 6)), strict=True):
                if host not in known:
                    if len(known) >= 200:
                        known.clear()
                    known[host] = Wrapper(template, nodes)
                texts.append("\n".join(known[host].blocks(parse(text))))
            yield pa.record_batch([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                  ["page_id", "url", "text", "n_chars"])

    id_type = base.schema["page_id"].dataType.simpleString()
    return (base.join(templates, "host", "left").select("page_id", "url", "host", "html", "template", "nodes")
            .mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long"))
