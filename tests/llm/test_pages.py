from __future__ import annotations

import html
import math
import re
import time
from collections import Counter

import pytest

from loanscope.llm import style_tree
from loanscope.llm.style_tree import main_text, main_texts

CASES = {
    "<body><header>Top</header><article><header><h1>T &amp; &lt;x&gt;</h1></header><p>a  b<b>c</b>\n d<p>e<span class=\"ad\">buy</span> f<br>g"
    "<div class=comments><p>nice</p></div><ul><li>1<li>2</ul></article><footer>x</footer>": "T & <x>\na bc d\ne f g\n1\n2",
    '<div id="x"><p>hello <a href="y">you</a></p><script>if(a<b)"</p>"</script>tail</div>': "hello you\ntail",
    "": "",
    "plain < text &amp": "plain < text &",
    "<article><p>open <b>bold<p>next": "open bold\nnext",
    "<p>one<!-- <p>no</p> -->two<![CDATA[x]]></p><style>p{}</style><textarea>t</textarea>": "onetwo",
    "<main><h1>H</h1><form><p>f</p></form><aside>s</aside><p class='x cookie-notice'>c</p><p>yes&nbsp;so</p></main><p>out</p>": "H\nyes so",
    "<title>t</title><table><tr><td>a<td>b<tr><td>c</table>": "a\nb\nc",
    "<p title='a>b' hidden>q</p><a href=\"unclosed>z": "q\nz",
    "<article></article><p>out</p>": "",
    "<script>never closed <p>x": "",
    "<DIV><P>Upper</P></DIV>": "Upper",
}


@pytest.mark.parametrize("page", CASES)
def test_blocks(page):
    assert main_text(page) == CASES[page]


def test_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r.page_id: r for r in main_texts(pages).collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    for r in rows:
        inside = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>|<br>", inside)]
        text = "\n".join(p for p in parts if p)
        assert (found[r.page_id].text, found[r.page_id].n_chars, found[r.page_id].url) == (text, len(text), r.url)


def test_repeated_branches_without_hints_go(spark):
    """No tag or class tells what is what here; only how nodes vary over the pages of a host."""
    page = "<div class=a1><p>Home | About | Contact</p></div><div class=b2><p>Story {0} tells of {0} things</p></div><div class=c3><p>All rights reserved</p></div>"
    rows = [(n, f"https://u@One.example:80/{n}", page.format(n), "x") for n in range(30)]
    rows += [(100 + n, f"http://two.example/{n}", page.format(n), "x") for n in range(2)]  # too few to tell
    rows += [(200, None, page.format(1), None), (201, "", None, None), (None, "http://three.example", "", None), (0, rows[0][1], rows[0][2], "x")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, node string")
    found = [(r.page_id, r.text, r.n_chars) for r in main_texts(table).collect()]
    assert len(found) == len(rows)
    texts = {i: t for i, t, _ in found}
    assert all(texts[n] == f"Story {n} tells of {n} things" for n in range(30))
    assert texts[100].startswith("Home") and texts[200].startswith("Home") and texts[201] == texts[None] == ""
    assert all(n == len(t) for _, t, n in found)
    nodes = {r.node: r for r in style_tree.importance(table).filter("host = 'one.example'").collect()}
    assert nodes["body/div.a#/p"].importance == pytest.approx(0) and nodes["body/div.b#/p"].importance > 0.8


def test_same_words_in_many_articles_stay(spark):
    rows = [(n, f"http://h.example/{n}", "<nav>N</nav><article><p>Same opening line.</p></article>") for n in range(20)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in main_texts(table).collect()} == {"Same opening line."}


def test_repeated_branches_inside_articles_go(spark):
    page = "<article><h1>Daily</h1><p>Same opening line.</p><div class=k7><p>Get our letter</p></div><p>Story {0} tells of {0} things</p><p class=q>Buy now</p></article>"
    rows = [(n, f"http://h.example/{n}", page.format(n)) for n in range(20)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in main_texts(table).collect()} == {n: f"Daily\nSame opening line.\nStory {n} tells of {n} things" for n in range(20)}


@pytest.mark.parametrize("page, text", [
    ("<div><p>text</p></div><script>x = '<article>'</script><!-- <main> -->", "text"),
    ("<div><p>text</p></div><article class=comment><p>nice</p></article><article class='card related'>teaser</article>", "text"),
    ("<div><p>text</p></div><div class=comments><article>nice</article></div><aside><article>teaser</article></aside>", "text"),
    ("<div><p>text</p></div><article><div class=share>send</div></article>", "text"),
    ('<div class="content-sidebar-wrap"><article><p>text</p><div class=share>send</div></article></div>', "text"),
    ('<form id=page><header><main><p>text</p></main></header></form><div class=related><article>teaser</article></div>', "text"),
    ('<div class="related"><article><p>text</p></article></div>', "text"),
    ('<article><div class="article-header"><h1>title</h1></div><p>text</p></article>', "title\ntext"),
])
def test_articles_are_found_by_parsing(page, text):
    assert main_text(page) == text


def test_entropies_overrule_class_names(spark):
    page = "<div class='search wide'>Find</div><div id=sidebar-left><p>Story {0} of {0}</p></div><div class=comments>I like {0}</div><div class=header>Top</div>"
    rows = [(n, f"http://h.example/{n}", page.format(n)) for n in range(20)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in main_texts(table).collect()} == {n: f"Story {n} of {n}" for n in range(20)}


def test_empty_table(spark):
    assert main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_importance_is_the_plain_entropies(spark):
    """Nodes, presentations and features of each page by hand, entropies by their definition."""
    pages = []  # per page: leaf path -> (features in order); the body's other nodes follow from these
    for n in range(12):
        page = {"body/nav/a-list": ["Home", "About", f"Story {n}"], "body/div": ["Opening.", f"Line {n}.", "Opening."] if n % 3 else ["Opening."]}
        if n < 5:
            page["body/footer"] = ["All rights reserved", f"Seen {n % 2} times"]
        pages.append(page)
    html_of = lambda page: (
        "<nav><a-list>" + "".join(f"<a>{x}</a> " for x in page["body/nav/a-list"]) + "</a-list></nav><div>" + " ".join(page["body/div"]) + "</div>"
        + ("<footer>" + " | ".join(page["body/footer"]) + "</footer>" if "body/footer" in page else "")
    )
    entropy = lambda counts: -sum(c / sum(counts) * math.log(c / sum(counts)) for c in counts)
    want, leaves = {}, {leaf for page in pages for leaf in page}
    for node in {"/".join(leaf.split("/")[:k]) for leaf in leaves for k in range(1, 4)}:
        below = [leaf for leaf in leaves if f"{leaf}/".startswith(f"{node}/")]
        looks = Counter(tuple(leaf for leaf in page if leaf in below) for page in pages if any(leaf in page for leaf in below))
        m, total, weight = sum(looks.values()), 0.0, 0
        for leaf in below:
            having = [Counter(page[leaf]) for page in pages if leaf in page]
            for feature in set().union(*having):
                counts = [c[feature] for c in having if feature in c]
                total += sum(counts) * (1 - entropy(counts) / math.log(len(having)))
                weight += sum(counts)
        want[node] = (m, style_tree.CONTENT * total / weight + (1 - style_tree.CONTENT) * entropy(looks.values()) / math.log(m))
    table = spark.createDataFrame([(f"http://h.example/{n}", html_of(page)) for n, page in enumerate(pages)], "url string, html string")
    found = {r.node: (r.pages, r.importance) for r in style_tree.importance(table).collect()}
    assert found.keys() == want.keys()
    assert all(found[n][0] == want[n][0] and found[n][1] == pytest.approx(want[n][1], abs=1e-9) for n in want)


def test_one_varying_link_does_not_keep_a_menu(spark):
    menu = "".join(f"<li><a>{x}</a></li>" for x in ("Home", "News", "Sport", "Weather", "Contact", "Team", "Jobs", "Press"))
    page = "<div class=k1><ul>" + menu + "<li><a>Now: {0}</a></li></ul></div><div class=k2>Story {0} tells of {0} things</div>"
    rows = [(n, f"http://h.example/{n}", page.format(n)) for n in range(30)]  # both have the style div.k#
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in main_texts(table).collect()} == {n: f"Story {n} tells of {n} things" for n in range(30)}


@pytest.mark.parametrize("page, text", [
    ("<b>" * 100_000 + "deep" + "</i>" * 100_000 + "<p>end", "deep\nend"),
    ("<div>x" * 50_000, "\n".join("x" * 50_000)),
    ("<ul>" + "<div>" * 50_000 + "<li>y" * 50_000, "\n".join("y" * 50_000)),
    ("<div class=sidebar>" * 50_000 + "gone", ""),
    (f"<div class='{'c' * 100_000}'>" * 50 + "z" + "</p>" * 50_000, "z"),
])
def test_deep_pages(page, text):
    start = time.perf_counter()
    assert main_text(page) == text
    looks, _ = style_tree.node_features(page)
    assert len(looks) <= style_tree.DEPTH + 1 and sum(map(len, looks)) < 10_000_000
    assert time.perf_counter() - start < 60
