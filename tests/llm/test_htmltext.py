"""Operator 13: tree matching against brute force, whole table against a plain
article reader, and pages without any marks, where only the wrapper can tell."""
import itertools
import random
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventide.llm import htmltext
from eventide.llm.htmltext import Node, Wrapper, main_text, parse, slot_numbers, tree_text
from eventide.llm.queries import op13_htmltext


class Article(HTMLParser):
    """Blocks between <article> and its end, for the tags that the tables have."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.inside, self.blocks, self.held = False, [], ""

    def edge(self, tag):
        if tag in ("article", "p", "h1", "br"):
            if tag == "br":
                self.held += " "
                return
            if self.inside and self.held.split():
                self.blocks.append(" ".join(self.held.split()))
            self.held = ""

    def handle_starttag(self, tag, attrs):
        self.edge(tag)
        self.inside |= tag == "article"

    def handle_endtag(self, tag):
        self.edge(tag)
        self.inside &= tag != "article"

    def handle_data(self, data):
        self.held += data

    def handle_entityref(self, name):
        raise AssertionError("decoded beforehand")


def article_text(html):
    import html as h
    import re
    body = re.sub(r"<script>.*?</script>|<style>.*?</style>", "", html, flags=re.S)
    p = Article()
    # references stay out of the parser's way: & as a private character
    p.feed(body.replace("&", ""))
    p.edge("article")
    return "\n".join(" ".join(h.unescape(b.replace("", "&")).split()) for b in p.blocks)


def test_whole_table(spark, sf):
    rows = pq.read_table(f"{sf}/pages.parquet").to_pylist()
    got = {r["page_id"]: r for r in op13_htmltext(spark, sf).collect()}
    assert len(got) == len(rows)
    for r in rows:
        want = article_text(r["html"])
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want) and got[r["page_id"]]["url"] == r["url"]


WORDS = "amber basin cedar delta ember fjord grove haven inlet juniper kelp lagoon meadow nectar orchid pebble quartz river summit tundra".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(1000)) for _ in range(n))


def unmarked_pages(host, n, seed):
    """Pages of plain divs: menu, advert and footer take turns, one line is on every
    page within the text, and the text sits in nested divs of changing shape."""
    rng = random.Random(seed)
    menus, adverts = [[prose(rng, 1) for _ in range(4)] for _ in range(3)], [prose(rng, 6) for _ in range(3)]
    out = []
    for k in range(n):
        paras = [prose(rng, rng.randrange(5, 40)) for _ in range(rng.randrange(1, 6))]
        extra = prose(rng, 8) if k % 3 == 0 else None
        html = ("<html><head><title>x</title></head><body><div class='q7'><div>" + "".join(f"<span>{m} </span>" for m in menus[k % 3])
                + f"</div></div><div>{adverts[k * 7 % 3]}</div><div class='z{k % 2}'><div>" + "".join(f"<p>{p}</p>" for p in paras)
                + "<p>Sign up for our letter</p>" + (f"<div>{extra}</div>" if extra else "")
                + "</div></div><div>All made by us &copy; 2024</div></body></html>")
        out.append((f"http://{host}/{k}", html, "\n".join(paras + ([extra] if extra else []))))
    return out


def table(spark, rows):
    df = spark.createDataFrame([(k, u, h) for k, (u, h, *_) in enumerate(rows)], "page_id long, url string, html string")
    for name in ("host", "tree", "text", "node", "template", "nodes", "n"):
        df = df.withColumn(name, F.lit("x"))
    return df


def test_wrapper_alone_finds_the_text(spark):
    rows = unmarked_pages("plain.example.org", 40, 1) + unmarked_pages("other.example.org", 30, 2)
    got = {r["page_id"]: r["text"] for r in main_text(table(spark, rows)).collect()}
    assert [got[k] for k in range(len(rows))] == [t for _, _, t in rows]


def test_copies_do_not_make_an_article_template(spark):
    one = "<body><div>menu a</div><div><p>the same article on every page of the host</p><p>second part</p></div></body>"
    rows = [(f"http://copies.example.org/{k}", one) for k in range(50)]
    got = {r["text"] for r in main_text(table(spark, rows)).collect()}
    assert got == {"menu a\nthe same article on every page of the host\nsecond part"}


MARKED = [
    ("<body><header><h1>Site</h1></header><nav>m</nav><main><div id='cookie-notice'>we use cookies</div><article><header><h1>T</h1></header>"
     "<p>one<p>two <b>bold</b> end<aside>side</aside><form>mail <input> <button>go</button></form><div class='share-buttons'>tweet</div>"
     "<section class='comments'><article>first!</article></section></article></main><footer>f</footer>", "T\none\ntwo bold end"),
    ("<div class='with-sidebar'><article class='post'><p>a &amp; b &lt;c&gt; &#233;&nbsp;x</p><ul><li>l1<li>l2</ul><table><tr><td>c1<td>c2</table>"
     "</article></div><div class=sidebar>s</div>", "a & b <c> é x\nl1\nl2\nc1\nc2"),
    ("<main><p>only main</p><script>if (a < b) { '</p>' }</script><style>p{}</style><noscript>no</noscript></main><p>outside</p>", "only main"),
    ("<p>no marks <i>at</i> all<br>next line</p><p hidden>h</p><p style='display: none'>i</p><textarea>t</textarea>", "no marks at all next line"),
    ("<article><p>cut off <b>in the mid", "cut off in the mid"),
    ("<article><p>a tag cut <a href='x", "a tag cut"),
    ("<article class='ad-free promo'>its only article</article>", "its only article"),
    ("<article><p>1 < 2 and 3 > 2 <!-- no --> <![CDATA[gone]]> don't <a title=it's>x</a> isn't</p></article>", "1 < 2 and 3 > 2 don't x isn't"),
    ("<p>text</p><ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul>", "text"),
    ("", ""), (None, ""), ("   ", ""), ("just text", "just text"), ("<nav>only a menu</nav>", ""),
    ("<article><div><div><b><p>x</b>y</p></div>z</article> after", "xy\nz"),
    ("<ARTICLE><P>upper</P><SCRIPT>x</SCRIPT></ARTICLE>", "upper"),
]


def test_marked_pages_and_edges(spark):
    rows = [(None if k % 2 else f"https://h{k}.example.org/", h) for k, (h, _) in enumerate(MARKED)]
    got = {r["page_id"]: r for r in main_text(table(spark, rows)).collect()}
    assert [got[k]["text"] for k in range(len(MARKED))] == [t for _, t in MARKED]
    assert all(got[k]["n_chars"] == len(t) and got[k]["url"] == rows[k][0] for k, (_, t) in enumerate(MARKED))


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "u", "<p>a</p>"), (None, "u", "<p>a</p>"), (1, None, None)], "page_id long, url string, html string")
    assert sorted((r["page_id"] is None, r["text"]) for r in main_text(df).collect()) == [(False, ""), (True, "a"), (True, "a")]
    assert main_text(df.limit(0)).collect() == []


def test_deep_and_long_pages(spark):
    deep = "<div>" * 5000 + "bottom"
    long = "<article>" + "<p>para</p>" * 200000 + "</article>"
    got = {r["page_id"]: r["text"] for r in main_text(table(spark, [("http://a/", deep), ("http://b/", long)])).collect()}
    assert got[0] == "bottom" and got[1] == "\n".join(["para"] * 200000)


# --- trees -------------------------------------------------------------------

trees = st.recursive(st.sampled_from("abc").map(lambda t: (t, ())),
                     lambda kids: st.tuples(st.sampled_from("abc"), st.lists(kids, max_size=3).map(tuple)), max_leaves=7)


def node(t):
    n = Node(t[0])
    n.children = [node(c) for c in t[1]]
    return n


def brute_match(s, t):
    """The most nodes (a node and a half each, as labels are equal) over all choices of child pairs."""
    if s[0] != t[0]:
        return 0.0
    best = 0.0
    n = min(len(s[1]), len(t[1]))
    for k in range(n + 1):
        for x in itertools.combinations(s[1], k):
            for y in itertools.combinations(t[1], k):
                best = max(best, sum(brute_match(p, q) for p, q in zip(x, y)))
    return 1.5 + best


@settings(max_examples=150, deadline=None)
@given(trees, trees)
def test_simple_tree_matching(s, t):
    assert htmltext.match(node(s), node(t), {})[0] == pytest.approx(brute_match(s, t))


@settings(max_examples=150, deadline=None)
@given(trees, trees)
def test_merged_template_holds_both_trees(s, t):
    t = (s[0], t[1])
    template = node(s)
    htmltext.merge(template, node(t))
    again = Node.read(template.written())
    assert again.written() == template.written() and again.count == 2
    size = again.numbered()
    assert size <= node(s).numbered() + node(t).numbered() - 1
    for tree in (s, t):
        numbers = slot_numbers(again, node(tree))
        assert -1 not in numbers and len(set(numbers)) == len(numbers)


def test_alike_neighbours_share_a_slot():
    page = parse("<div class=c><ul><li>a</ul><div>b</div></div><div class=c><div>c</div></div><div class=d>e</div>")
    assert tree_text(page.slots) == "0:body 1:div.c 2:ul 2:div 1:div.d"
    assert Wrapper(None, None).blocks(page) == ["a", "b", "c", "e"]
